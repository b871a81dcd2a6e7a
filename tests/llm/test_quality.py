import numpy as np

from cadence.llm import quality


def test_context_sums_match_a_plain_loop():
    rng = np.random.default_rng(3)
    bounds = np.array([0, 5, 5, 6, 20])
    word, form = rng.integers(256, 400, 20), rng.integers(0, 40, 20)
    want = np.zeros((quality.VOCABULARY, quality.DIM))
    for lo, hi in zip(bounds[:-1], bounds[1:]):
        for i in range(lo, hi):
            for j in range(max(lo, i - quality.REACH), min(hi, i + quality.REACH + 1)):
                if i != j:
                    for mine in (word[i], form[i]):
                        for other in (word[j], form[j]):
                            for k in range(quality.NONZERO):
                                want[mine, quality.PLACE[k][other]] += quality.SIGN[k][other]
    assert np.array_equal(quality.context_sums(word, form, bounds), want)


def test_network_learns_and_is_calibrated():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(3000, 6))
    p = 1 / (1 + np.exp(-3 * x[:, 0] * x[:, 1]))  # not linear in x
    y = (rng.random(3000) < p).astype(float)
    net = quality.fit(x[:2000], y[:2000])
    s = net.score(x[2000:])
    assert ((s > 0.5) == (p[2000:] > 0.5)).mean() > 0.85
    for lo, hi in ((0.0, 0.3), (0.3, 0.7), (0.7, 1.0)):
        part = (s >= lo) & (s <= hi)
        assert abs(s[part].mean() - y[2000:][part].mean()) < 0.12


def test_one_class_and_no_rows():
    x = np.zeros((4, 3))
    assert quality.fit(x, np.ones(4)).score(x).min() > 0.9
    assert quality.fit(x[:0], np.ones(0)).score(x).tolist() == [0.5] * 4


def test_held_out_accuracy_on_the_table(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    rows = quality.predictions(docs, labels).cache()
    assert rows.count() == docs.count() and rows.where("score < 0 or score > 1 or predicted <> cast(score >= 0.3 as int)").count() == 0
    n = {(r.quality, r.predicted): r["count"] for r in rows.where("held_out").join(labels, "doc_id").groupBy("quality", "predicted").count().collect()}
    assert (n[0, 0] + n[1, 1]) / sum(n.values()) > 0.97


def test_edges(spark):
    docs = spark.createDataFrame([(1, None, 1.0), (2, "", 1.0), (None, "a b", 1.0), (3, "Long word! " * 40_000, 1.0), (3, "x ### y", 1.0), (4, "plain words here", 1.0)], "doc_id long, text string, score double")
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, None), (None, 1), (4, 1), (9, 0)], "doc_id long, quality int")
    rows = quality.predictions(docs, labels).collect()
    assert len(rows) == 6 and all(0 <= r.score <= 1 for r in rows)
    assert quality.predictions(docs.limit(0), labels).collect() == []
    assert {r.score for r in quality.predictions(docs, labels.limit(0)).collect()} == {0.5}
