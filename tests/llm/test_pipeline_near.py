import corpus_pipeline

from cadence.llm import minhash
from llm_brute import near_components


def test_near_dedup_drops_pairs_from_similarity_0_8_on(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    wide, narrow = near_components(rows, 80), near_components(rows, 85)
    want = {i for i in wide if wide[i][1] == i}
    assert want < {i for i in narrow if narrow[i][1] == i}
    assert {r.doc_id for r in corpus_pipeline.keep_one_of_near_copies(spark, docs, "").collect()} == want


def test_bands_and_slack_follow_the_threshold():
    for percent in (50, 70, 80, 85, 95):
        rows, bands = minhash.banding(percent / 100)
        assert (1 - (percent / 100) ** rows) ** bands <= minhash.MISS and rows * bands <= minhash.MINIMA
    assert minhash.banding(0.85) == (7, 28) and minhash.banding(0.8) == (6, 36)
    assert minhash.banding(1.0)[1] == 1
    assert abs(0.85 - minhash._least(0.85) - 0.075) < 1e-3 < 0.8 - minhash._least(0.8) - 0.08
