import random
import re

import numpy as np

from cadence.llm import outliers

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    w = WORD.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    grams, covered = {}, set()
    for i in range(len(w) - 7):
        grams.setdefault(tuple(w[i : i + 8]), []).append(i)
    for at in grams.values():
        if len(at) > 1:
            for i in at:
                covered.update(range(i, i + 8))
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(covered)


def test_statistics_match_brute_force(spark):
    rng = random.Random(2)
    rows = [(i, "".join(rng.choice(["a ", "b ", "é", "日", "\n", " ", "#", "|", "a b a b a b a b a b ", "x y ", "\r\n", "line\n"]) for _ in range(rng.randrange(40)))) for i in range(200)]
    docs = spark.createDataFrame([(*r, None, "s") for r in rows], "doc_id long, text string, lang string, source string")
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang", "source")
    for df in (docs, table):
        want = {r.doc_id: brute(r.text) for r in df.collect()}
        got = {r.doc_id: tuple(r[s] for s in outliers._STATS) for r in outliers.quality_rules(df).collect()}
        assert got == want


def mcd(x):
    """Minimum covariance determinant by many random starts on all rows, then reweighting."""
    rng, h = np.random.default_rng(1), int(np.ceil(outliers.CORE * len(x)))
    best = (np.inf,)
    for _ in range(60):
        some = x[rng.choice(len(x), 6, replace=False)]
        center, cov = some.mean(axis=0), np.cov(some.T)
        for _ in range(12):
            core = x[np.argsort(outliers._distance(x, center, cov))[:h]]
            center, cov = core.mean(axis=0), np.cov(core.T, bias=True)
        best = min(best, (np.linalg.slogdet(cov + np.diag(outliers.FLOOR))[1], tuple(center), tuple(cov.ravel())))
    center, cov = np.array(best[1]), np.array(best[2]).reshape(5, 5) * outliers.CONSISTENCY
    near = x[outliers._distance(x, center, cov) <= outliers.REWEIGHT]
    return outliers._distance(x, near.mean(axis=0), np.cov(near.T, bias=True))


def corpus(n=700, seed=7):
    rng, rows = random.Random(seed), []
    for i in range(n):
        words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 9))) for _ in range(int(rng.lognormvariate(4.5, 0.6)) + 20)]
        if i % 10 == 0:
            words = [w + rng.choice(["###", "***"]) for w in words]
        if i % 17 == 1:
            words = [w * 4 for w in words]
        rows.append((i, " ".join(words), "en", f"s{i % 2}"))
    return rows


def test_distances_match_a_direct_estimate(spark):
    rows = corpus()
    got = {r.doc_id: r for r in outliers.quality_rules(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    for s in ("s0", "s1"):
        ids = [i for i, _, _, source in rows if source == s and not got[i].base_failed]
        b = np.array([[getattr(got[i], c) for c in outliers._STATS] for i in ids], dtype=float)
        x = np.column_stack([np.log(b[:, 1] / b[:, 0]), np.log(b[:, 0]), *(np.log(1 + 100 * b[:, c] / b[:, 0]) for c in (2, 3, 4))])
        want = mcd(x)
        assert np.allclose([got[i].distance for i in ids], want, rtol=0.1)
    bad = {i for i, *_ in rows if i % 10 == 0 or i % 17 == 1}
    assert {i for i in got if not got[i].kept} >= bad
    assert sum(not got[i].kept for i in got if i not in bad) <= 2


def test_table_keeps_clean_documents(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    rows = outliers.quality_rules(docs).join(labels, "doc_id").where("not base_failed").groupBy("quality", "kept").count().collect()
    n = {(r.quality, r.kept): r["count"] for r in rows}
    assert n.get((1, False), 0) <= 0.01 * n[1, True] and n[0, False] >= 0.9 * (n[0, False] + n.get((0, True), 0))


def test_edges(spark):
    schema = "doc_id long, text string, lang string, source string, cell string, distance double"
    word = "plain words in a row that make up one text of more than twenty words so that it passes the base rules here"
    rows = [(1, None, None, None), (2, "", "en", "a"), (None, word, None, "b"), (3, word, "en", None), (3, word, "en", None), (4, "a b c d e f g h " * 30, "en", "a"), (5, "word" * 300_000, "en", "a")]
    df = spark.createDataFrame([(*r, "x", 1.0) for r in rows], schema)
    got = sorted(((r.doc_id, r.base_failed, r.kept) for r in outliers.quality_rules(df).collect()), key=str)
    assert got == sorted([(1, True, False), (2, True, False), (None, False, True), (3, False, True), (3, False, True), (4, True, False), (5, True, False)], key=str)
    same = spark.createDataFrame([(i, word, "en", "a") for i in range(200)], "doc_id long, text string, lang string, source string")
    assert outliers.quality_rules(same).where("kept").count() == 200
    assert outliers.quality_rules(df.limit(0)).collect() == []
