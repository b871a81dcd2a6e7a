import hashlib
import random
import zlib
from collections import defaultdict

import duckdb
import pytest

from cadence.llm import trie as T

SF = "/root/testdata/sf0.001"


def brute(rows):
    """The nodes by a dictionary of paths; rows are (conv_id, turn, role, text)."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()
            own[c].append(((turn is not None, turn or 0, digest[:16]), (role, text)))
    own = {c: [t for _, t in sorted(v, key=lambda x: x[0])] for c, v in own.items()}
    members = defaultdict(list)
    whole = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = int(c - (abs(c) % 100) * (1 if c >= 0 else -1))
        whole[c] = tuple(own.get(base, [])[:h] + turns[h:])
        for d in range(len(whole[c]) + 1):
            members[whole[c][:d]].append(c)
    out = []
    for path, who in members.items():
        under = [p for p in members if p[: len(path)] == path]
        kids = [p for p in under if len(p) == len(path) + 1]
        leaves = [p for p in under if not any(len(q) == len(p) + 1 and q[: len(p)] == p for q in under)]
        saved = sum((len(members[p]) - 1) * len(p[-1][1]) for p in under if p)
        ended = ",".join(map(str, sorted(c for c in who if len(whole[c]) == len(path))))
        parent = min(members[path[:-1]]) if path else None
        out.append((min(who), len(path), parent, len(who), len(kids), len(leaves), saved, hashlib.sha256(ended.encode()).hexdigest()))
    return sorted(out, key=str)


def got(df):
    assert df.columns == T.COLUMNS
    return sorted((tuple(r) for r in df.collect()), key=str)


def table(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def test_query_matches_sql(spark):
    con = duckdb.connect()
    con.sql(f"create view conversations as from '{SF}/conversations.parquet'")
    want = sorted(con.sql(T.ORACLE_SQL).fetchall(), key=str)
    assert got(T.prefix_trie(spark.read.parquet(f"{SF}/conversations.parquet"))) == want


@pytest.mark.parametrize("limit", [2, 30, 10**6])
def test_copies_and_deep_paths_against_brute_force(spark, limit):
    """Groups of copies, prefixes of one another, long conversations, at several container sizes."""
    rng = random.Random(limit)
    rows = []
    for c in range(0, 420, 3):
        kind = rng.randrange(4)
        n = rng.randrange(1, 9) if kind else rng.choice([14, 15, 16])
        for t in range(n):
            text = {0: f"same {t}", 1: f"copy {t}", 2: f"copy {t if t < 3 else c % 5}", 3: f"own {c % 7} {t}"}[kind]
            rows.append((c, t, "user" if t % 2 else "assistant", text))
    rng.shuffle(rows)
    assert got(T.prefix_trie(table(spark, rows), limit)) == brute(rows)


@pytest.mark.parametrize("limit", [1, 10**6])
def test_edges(spark, limit):
    rows = [
        (0, None, None, None), (0, 1, "a", "x"), (0, 1, "a", "x"), (0, 1, "b", "é日"), (0, 2, "", ""),
        (7, 5, "a", "own"), (107, 1, "a", "no base"), (-3, 1, None, "negative"), (-3, 2, "a", "x" * 50_000),
        (None, 1, "a", "lost"), (300, None, "a", "1"), (300, None, "a", "2"), (301, 0, "a", "short"), (302, 0, "a", "short"),
        *[(400 + i, t, "r", "copy") for i in range(30) for t in range(8)],
    ]
    assert got(T.prefix_trie(table(spark, rows), limit)) == brute(rows)
    wide = table(spark, rows).selectExpr("*", "turn as depth", "text as n_convs", "1 as pos")
    assert got(T.prefix_trie(wide, limit)) == brute(rows)
    assert got(T.prefix_trie(table(spark, rows).where("false"))) == []


def test_numbering_across_ranges(spark, monkeypatch):
    """A conversation longer than a range, with many equal rows, and windows of few positions."""
    monkeypatch.setattr(T, "RANGE_ROWS", 10)
    monkeypatch.setattr(T, "SPAN", 7)
    rows = [(1, t // 3, "u", f"t{t % 2}") for t in range(90)] + [(2, 0, "u", "same")] * 50 + [(3, t, "u", f"x{t}") for t in range(40)]
    assert got(T.prefix_trie(table(spark, rows), 20)) == brute(rows)


def test_ends_of_a_large_group(spark, monkeypatch):
    ended = spark.range(20_000).selectExpr("1L as pos", "id % 2 as k1", "0L as k2", "id * 7 - 5000 as conv_id").repartition(8)
    found = {r.k1: r.ends_sha256 for r in T.end_digests(ended).collect()}
    for k in (0, 1):
        assert found[k] == hashlib.sha256(",".join(str(i * 7 - 5000) for i in range(k, 20_000, 2)).encode()).hexdigest()
