"""Quality rules by robust multivariate outliers: minimum-covariance-determinant estimates per language and source."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadence.llm import textkit as tk
from cadence.llm.tables import begin, narrow, small, stored

SYMBOLS = b"#*$%&|<>"
WINDOW = 8  # words in a window that may repeat
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30

DIMS = 5
CORE = 0.75  # share of a cell's rows that the estimate rests on
CUT = 25.74  # chi-square quantiles with 5 degrees of freedom: 0.9999 rejects,
REWEIGHT = 12.83  # 0.975 is the reach of the reweighted estimate
CONSISTENCY = 1.412  # 0.75 / P(chi2 with 7 degrees <= the 0.75 quantile with 5)
FLOOR = np.array([0.1, 0.5, 0.25, 0.5, 1.0]) ** 2  # variance added to each statistic: most are 0 in most texts, and a repeat or a short text is no outlier
MIN_CELL = 50  # rows below which a source is pooled with the small sources of its language, then with all small ones
SAMPLE = 600  # rows of a cell that the starting estimates are searched on
STARTS, STEPS = 40, 3  # random starts on that sample; concentration steps on all rows
BINS = 64  # bins of squared distance an octave


def statistics(raw: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of each text of a buffer."""

    def per_text(flag: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(flag, dtype=np.int64)])
        return total[offsets[1:]] - total[offsets[:-1]]

    n = len(offsets) - 1
    in_word = ~tk.SPACE[raw]
    symbol = np.zeros(256, dtype=bool)
    symbol[list(SYMBOLS)] = True
    starts, ends, bounds = tk.words(raw, offsets)
    # Lines that hold a word and equal an earlier one of the same text.
    ls, le, line_bounds = tk.runs(raw != 10, offsets)
    total = np.concatenate([[0], np.cumsum(in_word, dtype=np.int64)])
    line_text = np.repeat(np.arange(n), np.diff(line_bounds))
    keep = total[le] > total[ls]
    line_text = line_text[keep]
    keys = tk.combine(line_text.astype(np.uint64), tk.hash_spans(raw, ls[keep], le[keep]))
    _, first = np.unique(keys, return_index=True)
    dup = np.bincount(line_text, minlength=n) - np.bincount(line_text[first], minlength=n)
    # Words inside windows that the text holds at least twice.
    grams, gram_bounds = tk.windows(tk.hash_spans(raw, starts, ends), bounds, WINDOW)
    gram_text = np.repeat(np.arange(n), np.diff(gram_bounds))
    _, inverse, count = np.unique(tk.combine(gram_text.astype(np.uint64), grams), return_inverse=True, return_counts=True)
    twice = np.flatnonzero(count[inverse] > 1) if len(grams) else np.zeros(0, dtype=np.int64)
    at = twice - gram_bounds[gram_text[twice]] + bounds[gram_text[twice]]
    cover = np.zeros(len(starts) + 1, dtype=np.int32)
    np.add.at(cover, at, 1)
    np.add.at(cover, at + WINDOW, -1)
    covered = np.concatenate([[0], np.cumsum(np.cumsum(cover[:-1]) > 0, dtype=np.int64)])
    return {
        "n_words": np.diff(bounds),
        "word_chars": per_text(in_word & ((raw & 0xC0) != 0x80)),
        "n_symbols": per_text(symbol[raw]),
        "n_dup_lines": dup,
        "n_repeat_words": covered[bounds[1:]] - covered[bounds[:-1]],
    }


_STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def base_statistics(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source and the five statistics of every row (null text: no words)."""
    begin(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = tk.utf8(batch.column("text"))
            for lo, hi in tk.blocks(offsets):
                got = statistics(raw[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
                yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(lo, hi - lo) for c in ("doc_id", "lang", "source")), *(pa.array(got[s].astype(np.int64)) for s in _STATS)], names=["doc_id", "lang", "source", *_STATS])

    return narrow(docs, "lang", "source", "text").mapInArrow(run, "doc_id long, lang string, source string, " + ", ".join(f"{s} long" for s in _STATS))


# The vector judged: word length, text length, and symbols, repeated lines and repeated words per 100 words, in logs.
_VECTOR = "array(ln(word_chars / n_words), ln(n_words), ln(1 + 100 * n_symbols / n_words), ln(1 + 100 * n_dup_lines / n_words), ln(1 + 100 * n_repeat_words / n_words))"
_PARAMS = "cell string, center array<double>, inverse array<double>"


def _estimate(center: np.ndarray, cov: np.ndarray) -> tuple[list[float], list[float]]:
    return center.tolist(), np.linalg.inv(cov + np.diag(FLOOR)).ravel().tolist()


def _distance(x: np.ndarray, center: np.ndarray, cov: np.ndarray) -> np.ndarray:
    d = x - center
    return np.einsum("ij,jk,ik->i", d, np.linalg.inv(cov + np.diag(FLOOR)), d)


def first_estimate(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The start with the least determinant: random small subsets, each concentrated on the sample's core."""
    rng, h = np.random.default_rng(7), max(DIMS + 1, int(np.ceil(CORE * len(x))))
    best = (np.inf, x.mean(axis=0), np.cov(x.T) if len(x) > 1 else np.zeros((DIMS, DIMS)))
    for _ in range(STARTS):
        some = x[rng.choice(len(x), min(len(x), DIMS + 1), replace=False)]
        center, cov = some.mean(axis=0), np.cov(some.T)
        for _ in range(6):
            core = x[np.argsort(_distance(x, center, cov), kind="stable")[:h]]
            center, cov = core.mean(axis=0), np.cov(core.T)
        size = np.linalg.slogdet(cov + np.diag(FLOOR))[1]
        if size < best[0] - 1e-9:
            best = (size, center, cov)
    return best[1], best[2] * CONSISTENCY


def _starts(table: pa.Table) -> pa.Table:
    order = np.lexsort((table.column("doc_id").fill_null(0).to_numpy(), table.column("h").to_numpy()))
    x = np.array(table.column("x").to_pylist(), dtype=float)[order][:SAMPLE]
    center, inverse = _estimate(*first_estimate(x))
    return pa.table({"cell": [table.column("cell")[0].as_py()], "center": [center], "inverse": [inverse]}, pa.schema([("cell", pa.string()), ("center", pa.list_(pa.float64())), ("inverse", pa.list_(pa.float64()))]))


_MOMENTS = [(i, j) for i in range(DIMS) for j in range(i, DIMS)]


def _from_bins(core: float | None):
    """A cell's estimate from the moments of its rows by bin of distance: the bins nearest the centre up to the core
    share, or (reweighting, None) all that were given."""

    def run(table: pa.Table) -> pa.Table:
        order = np.argsort(table.column("bin").to_numpy(), kind="stable")
        n = table.column("n").to_numpy()[order].astype(float)
        s = np.column_stack([table.column(f"s{i}").to_numpy()[order] for i in range(DIMS)])
        q = np.column_stack([table.column(f"q{i}{j}").to_numpy()[order] for i, j in _MOMENTS])
        take = len(n) if core is None else int(np.searchsorted(np.cumsum(n), core * n.sum())) + 1
        share = n[:take].sum() / n.sum()
        total = n[:take].sum()
        center = s[:take].sum(axis=0) / total
        cov = np.zeros((DIMS, DIMS))
        for (i, j), v in zip(_MOMENTS, q[:take].sum(axis=0) / total, strict=True):
            cov[i, j] = cov[j, i] = v - center[i] * center[j]
        cov = (cov + np.diag(np.maximum(0, -np.diag(cov)))) * (CONSISTENCY if core is not None and share < 0.99 else 1.0)
        center, inverse = _estimate(center, cov)
        return pa.table({"cell": [table.column("cell")[0].as_py()], "center": [center], "inverse": [inverse]}, pa.schema([("cell", pa.string()), ("center", pa.list_(pa.float64())), ("inverse", pa.list_(pa.float64()))]))

    return run


def _with_distance(rows: DataFrame, params: DataFrame) -> DataFrame:
    terms = " + ".join(f"(x[{i}] - center[{i}]) * inverse[{i * DIMS + j}] * (x[{j}] - center[{j}])" for i in range(DIMS) for j in range(DIMS))
    return rows.join(params, "cell", "left").withColumn("distance", F.expr(terms)).drop("center", "inverse")


def _moments(rows: DataFrame, bin_expr: str) -> DataFrame:
    sums = [F.sum(F.expr(f"x[{i}]")).alias(f"s{i}") for i in range(DIMS)] + [F.sum(F.expr(f"x[{i}] * x[{j}]")).alias(f"q{i}{j}") for i, j in _MOMENTS]
    return rows.groupBy("cell", F.expr(bin_expr).alias("bin")).agg(F.count(F.lit(1)).alias("n"), *sums)


def quality_rules(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept and distance of every
    row of ``docs`` (doc_id, text, lang, source).

    A row fails the base rules with fewer than 20 words or with over 30 % of its words in repeated eight-word windows. The
    others are judged in their cell, a language and source: five log statistics, whose centre and covariance are the
    minimum-covariance-determinant estimate on three quarters of the cell. As in the fast algorithm the search
    starts on a bounded sample of each cell (its 600 smallest hashes) with 40 random subsets; the concentration steps
    and the reweighting that give the estimate then run over all rows, as sums by cell and bin of distance that are
    combined before the shuffle, so no cell is gathered. A row whose squared Mahalanobis distance exceeds the
    0.9999 quantile of chi-square is rejected.

    Edges: null, empty and blank texts have no words and fail the base rules; a null language or source is a value
    like any other; cells under 50 rows are pooled by language, then over all languages, and a pool under 50 rows
    rejects nothing; repeated rows count each; a null id is judged like others; statistics that are constant in a
    cell get a variance floor; other columns are ignored; no rows give no rows."""
    stats = base_statistics(docs)
    stats = stats.withColumn("base_failed", F.expr(f"n_words < {MIN_WORDS} or 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words"))
    stats = stored(stats.withColumn("x", F.expr(f"if(base_failed, null, {_VECTOR})")).withColumn("lang", F.coalesce("lang", F.lit("\x00"))).withColumn("source", F.coalesce("source", F.lit("\x00"))), "stats")
    size = stats.where("not base_failed").groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n"))
    few = size.where(F.col("n") < MIN_CELL)
    by_lang = few.groupBy("lang").agg(F.sum("n").alias("pool"))
    cells = size.join(by_lang, "lang", "left").select(
        "lang", "source",
        F.when(F.col("n") >= MIN_CELL, F.concat_ws("\x01", F.lit("s"), "lang", "source")).when(F.col("pool") >= MIN_CELL, F.concat_ws("\x01", F.lit("l"), "lang")).otherwise(F.lit("all")).alias("cell"),
    )
    rows = stored(stats.where("not base_failed").select("doc_id", "lang", "source", "x").join(cells, ["lang", "source"]).select("doc_id", "cell", "x"), "vectors")
    counts = stored(rows.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= MIN_CELL), "counts")
    # About twice the sample is let through by a hash rate, before rows are dealt by cell; the start keeps the SAMPLE smallest hashes.
    hashed = rows.withColumn("h", F.xxhash64("doc_id", "x")).join(small(counts), "cell")
    some = hashed.where(F.pmod(F.col("h"), F.lit(1 << 30)) * F.col("n") < F.lit(2 * SAMPLE * (1 << 30))).withColumn("h", F.pmod(F.col("h"), F.lit(1 << 30)))
    params = stored(some.select("doc_id", "cell", "x", "h").dropDuplicates(["cell", "h"]).groupBy("cell").applyInArrow(_starts, _PARAMS), "starts")
    for _ in range(STEPS):
        binned = _moments(_with_distance(rows, params).where("distance is not null"), f"floor(log2(distance + 1e-6) * {BINS})")
        # Stored, so that sums are dealt by cell and bin first and a cell's task gets one row for each bin.
        params = stored(stored(binned, "bins").groupBy("cell").applyInArrow(_from_bins(CORE), _PARAMS), "core")
    near = _moments(_with_distance(rows, params).where(F.col("distance") <= REWEIGHT), "0")
    params = stored(near.groupBy("cell").applyInArrow(_from_bins(None), _PARAMS), "estimates")
    judged = _with_distance(stats.join(cells, ["lang", "source"], "left"), params)
    return judged.select("doc_id", *_STATS, "base_failed", (~F.col("base_failed") & F.coalesce(F.col("distance") <= CUT, F.lit(True))).alias("kept"), "distance")
