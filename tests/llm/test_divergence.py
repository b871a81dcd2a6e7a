import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from cadence.llm import divergence as D

SF = "/root/testdata/sf0.001"
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def brute(rows, min_docs=D.MIN_DOCS, top=D.TOP):
    """The result by nested loops over exact integers; rows are (lang, source, text)."""
    words = [(l or "", s or "", TERM.findall((t or "").translate(LOWER))) for l, s, t in rows]
    out = []
    for lang in {w[0] for w in words}:
        df, by, whole = Counter(), defaultdict(Counter), Counter()
        for l, s, t in words:
            if l == lang:
                df.update(set(t))
                by[s].update(t)
                whole.update(t)
        kept = [t for t in df if df[t] >= min_docs]
        v = len(kept)

        def p(c, kept=kept, v=v):
            n = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 5) // (n + 5 * v) for t in kept}

        q = p(whole)
        for s in by:
            ps = p(by[s])
            parts = {
                "pair": [(sum(abs(ps[t] - p(by[o])[t]) for t in kept), o) for o in by if o != s],
                "term": [(ps[t] - q[t], t) for t in kept if by[s][t] and ps[t] > q[t]],
            }
            for part, found in parts.items():
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                for r, (value, item) in enumerate(found[: None if part == "pair" else top], 1):
                    out.append((lang, s, part, item, value, r))
    return sorted(out)


def got(df):
    return sorted(tuple(r) for r in df.collect())


def test_query_matches_sql(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    con = duckdb.connect()
    con.sql(f"create view documents as from '{SF}/documents.parquet'")
    out = D.source_divergence(docs)
    assert out.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert got(out) == sorted(con.sql(D.ORACLE_SQL).fetchall())


@pytest.mark.parametrize(("block", "tile"), [(4, 3), (1024, 32), (1, 1)])
def test_blocks_and_tiles_against_brute_force(spark, monkeypatch, block, tile):
    monkeypatch.setattr(D, "BLOCK", block)
    monkeypatch.setattr(D, "TILE", tile)
    rng = random.Random(5)
    rows = [("en" if i % 3 else "fr", f"s{rng.randrange(9)}", " ".join(f"w{chr(97 + int(rng.paretovariate(0.7)) % 26)}É" for _ in range(rng.randrange(40)))) for i in range(300)]
    docs = spark.createDataFrame(rows, "lang string, source string, text string")
    assert got(D.source_divergence(docs, min_docs=5, top=7)) == brute(rows, 5, 7)


def test_edges(spark):
    rows = [(None, None, None, 1), ("", "b", "", 2), ("en", "a", "Tie tie É x1y", None), ("en", "b", "tie TIE ß", 4), ("en", "b", "tie TIE ß", 4), ("en", "c", None, 5), ("xx", "only", "word", 6)]
    docs = spark.createDataFrame(rows, "lang string, source string, text string, rank int")
    plain = [r[:3] for r in rows]
    assert got(D.source_divergence(docs, min_docs=1, top=50)) == brute(plain, 1)
    assert got(D.source_divergence(docs, min_docs=100)) == brute(plain, 100)
    assert got(D.source_divergence(docs.where("false"))) == []
    assert got(D.source_divergence(docs.select("text", "lang"), min_docs=1)) == brute([(r[0], None, r[2]) for r in rows], 1)


@pytest.mark.parametrize("chunk", [1, 7, 50, 1 << 20])
def test_long_text_is_read_in_chunks(monkeypatch, chunk):
    text = "alpha Beta, gammaÄ日\n" * 500 + "x" * 300 + " end_END"
    monkeypatch.setattr(D, "CHUNK", chunk)
    assert [t.decode() for part in D.terms_of(text.encode()) for t in part] == TERM.findall(text.translate(LOWER))


def test_shares_are_exact():
    rng = random.Random(1)
    for _ in range(200):
        total = rng.randrange(1, 9 * 10**15)
        c = [0, total, *[rng.randrange(total + 1) for _ in range(5)]]
        assert D.shares(np.array(c), total).tolist() == [1 + 10**9 * x // total for x in c]


def test_equal_subtrees_are_one_node():
    trees = D.Trees(np.array([[1, 2, 1, 2, 0, 0, 0, 0], [0, 0, 0, 0, 1, 2, 1, 2]]))
    assert [len(c) for c in trees.children] == [2, 2, 2]
    p = np.array([0, 5, 7, 11])
    assert trees.price(0, 1, p, p) == 2 * (2 * 2 + 2 * 6)
    assert trees.price(0, 0, p, p) == 0
