"""The corpus pipeline: toxicity, line dedup, near-duplicate removal, benchmark decontamination, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each stage's result as Parquet to the
shared folder and the next stage reads it from there. The first four return the columns of ``documents``."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadence.llm import leakage, lines, minhash, packing, toxicity
from cadence.llm.tables import stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score stays below 0.5, by a model trained on the labels of these documents.

    Edges: null and empty texts have no insults and stay; rows with a null doc_id and repeated rows are judged by their
    text; further columns, of any name, are passed on; no rows give no rows."""
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.reject_toxic(docs, model)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without the lines that repeat an earlier three-line window; n_chars follows the text.

    A document all of whose lines are repeats has nothing left and goes: it is a copy, line by line, of documents that
    come before it.

    Edges: a text that was null or empty before stays so, and its row stays; texts of fewer than three lines and rows
    with a null doc_id stay as they are; repeated rows of one id and text get one result; columns named n_lines or
    n_removed keep their values; no rows give no rows."""
    out = lines.deduplicate_lines(docs.select("doc_id", "text", F.struct(*docs.columns).alias("row")))
    emptied = (F.col("n_removed") > 0) & ~F.col("text").rlike("[^\\x20\\x09-\\x0D]")
    length = F.length("text")
    kept = {c: F.col("row").getField(c) for c in docs.columns} | {"text": F.col("text")}
    if "n_chars" in docs.columns:
        kept["n_chars"] = F.when(F.col("n_removed") > 0, length.cast(dict(docs.dtypes)["n_chars"])).otherwise(kept["n_chars"])
    return out.where(~F.coalesce(emptied, F.lit(False))).select(*[kept[c].alias(c) for c in docs.columns])


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (similarity 0.8 or more on five-word shingles): the one with the
    smallest doc_id. Every different text of that id stays, once.

    Edges: rows with a null doc_id, and null, empty and blank texts, are in no group and stay (repeated rows of one
    id and text once); further columns, of any name, are passed on; no rows give no rows."""
    mark = "_kept"
    while mark in docs.columns:
        mark += "_"
    kept = minhash.near_duplicates(docs, percent=80).where("kept and doc_id is not null").select(F.col("doc_id").alias(mark)).distinct()
    named = docs.where("doc_id is not null")
    single = named.hint("merge").join(kept, F.col("doc_id") == F.col(mark), "left_semi").dropDuplicates(["doc_id", "text"])
    return single.unionAll(docs.where("doc_id is null"))


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no test item.

    Edges: null and empty texts contain none and stay; rows with a null doc_id and repeated rows are judged by their
    text; further columns, of any name, are passed on; no rows give no rows, and an empty benchmark drops nothing."""
    return leakage.drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all remaining documents with their places in sequences of 4096 tokens.

    Edges: a null or empty text is one piece of the end id alone; rows with a null doc_id and repeated rows are packed
    like others; further columns end here; no rows give no rows."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", keep_one_of_near_copies),
    ("decontamination", drop_benchmark_leaks),
    ("packing", pack_sequences),
]

# A learned classifier and a packing search cannot be written in SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
