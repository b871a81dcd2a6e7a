import corpus_pipeline
import public_tokenizers

from cadence.llm import toxicity
from llm_brute import WORD, near_components
from test_leakage import brute as brute_leaks
from test_lines import brute as brute_lines
from test_packing import check as check_packing

SF = "/root/testdata/sf0.01"


def rows(df):
    return sorted((r.doc_id, r.text) for r in df.collect())


def test_every_stage_against_brute_force_on_its_own_input(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "line_dedup", "near_dedup", "decontamination", "packing"]
    for name, stage in corpus_pipeline.STAGES:
        out = corpus_pipeline.stored(stage(spark, docs, SF), f"test-{name}")
        before = dict(rows(docs))
        if name == "toxicity":
            bad = {r.doc_id for r in toxicity.predictions(docs, spark.read.parquet(f"{SF}/labels.parquet")).where("predicted = 1").collect()}
            assert bad and rows(out) == sorted((i, t) for i, t in before.items() if i not in bad)
        if name == "line_dedup":
            want = brute_lines(list(before.items()))
            left = {i: w[0] for i, w in want.items() if w[0] == before[i] or WORD.search(w[0])}
            assert rows(out) == sorted(left.items()) and len(left) < len(before)
            assert out.where("n_chars <> length(text)").count() == 0
        if name == "near_dedup":
            found = near_components(list(before.items()), 80)
            assert rows(out) == sorted((i, t) for i, t in before.items() if found[i][1] == i)
        if name == "decontamination":
            items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
            left = {i for i, _ in rows(out)}
            gone = set(before) - left
            assert {i for i, t in before.items() if any(x in t for x in items)} <= gone
            assert gone == {i for i, _ in brute_leaks([(i, before[i]) for i in gone], list(enumerate(items)))}
        if name == "packing":
            check_packing(out.collect(), list(before.items()))
            assert len(before) > 500 and public_tokenizers.path("word_bpe_49k.json")
        else:
            assert out.columns == columns and out.schema == docs.schema
        docs = out


def test_edges(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    long = "word " * 30_000
    docs = spark.createDataFrame([(1, None, None, None, None), (2, "", "en", "a", 0), (3, long, "en", "a", len(long)), (3, long, "en", "a", len(long)), (4, long, "en", "a", len(long)), (None, "x", None, None, 1), (None, "x", None, None, 1)], schema)
    for name, stage in corpus_pipeline.STAGES:
        empty = stage(spark, docs.limit(0), SF)
        assert empty.collect() == []
        docs = corpus_pipeline.stored(stage(spark, docs, SF), f"edge-{name}")
        if name == "near_dedup":
            assert sorted((r.doc_id for r in docs.collect()), key=str) == [1, 2, 3, None, None]
    assert {r.doc_id for r in docs.collect()} == {1, 2, 3, None}


def test_unlike_texts_of_one_id_all_stay(spark):
    """Rows of one id with unlike texts are kept, each once; a near copy under a larger id goes."""
    text = " ".join(f"w{i}" for i in range(30))
    other = " ".join(f"v{i}" for i in range(30))
    rows = [(1, text), (1, other), (1, other), (2, "q r s t u v w x"), (3, text + " more"), (4, None), (4, ""), (None, text), (None, text)]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, _kept string").repartition(4)
    out = corpus_pipeline.keep_one_of_near_copies(spark, docs, "")
    assert out.columns == docs.columns
    got = sorted(((r.doc_id, r.text) for r in out.collect()), key=str)
    assert got == sorted([(1, text), (1, other), (2, "q r s t u v w x"), (4, None), (4, ""), (None, text), (None, text)], key=str)


def test_extra_columns_pass_through_the_filters(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").selectExpr("*", "doc_id as n_lines", "lang as row", "source as label", "1 as n_removed", "text as rep", "lang as score").repartition(3)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = corpus_pipeline.stored(stage(spark, docs, SF), f"extra-{name}")
        assert out.dtypes == docs.dtypes and out.where("n_lines <> doc_id or row <> lang or label <> source or n_removed <> 1 or score <> lang").count() == 0
        docs = out
