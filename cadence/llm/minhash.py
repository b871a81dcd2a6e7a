"""Near-duplicate documents: universal-hash minima, banding, signature verification, connected components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadence.llm import textkit as tk
from cadence.llm.components import components
from cadence.llm.tables import begin, drop, narrow, stored

MINIMA = 240  # minima that the bands of any threshold may take
MISS = 2e-5  # at the threshold all bands miss a pair at most with this probability
CHECKS = 512  # further minima, one byte of each, for the documents that share a band bucket
DEVIATIONS = 4.75  # the estimate from them may lie this many deviations below the threshold
BLOCK = 256  # members of a bucket that one task compares with as many others


def banding(threshold: float) -> tuple[int, int]:
    """(minima in a band, bands): the longest bands with which MINIMA minima miss a pair at the threshold at most with
    probability MISS: 7 in 28 at 0.85, 6 in 36 at 0.8."""
    best = None
    for rows in range(1, 17):
        share = threshold**rows
        bands = 1 if share >= 1 else int(np.ceil(np.log(MISS) / np.log1p(-share)))
        if rows * bands <= MINIMA:
            best = rows, bands
    if best is None:
        raise ValueError(f"{MINIMA} minima are too few for a similarity of {threshold}")
    return best


def _least(threshold: float) -> float:
    """The estimated similarity below which a pair is taken to miss the threshold."""
    return threshold - DEVIATIONS * np.sqrt(threshold * (1 - threshold) / CHECKS)


ROWS, BANDS = banding(0.85)
_MUL = tk.random_u64(MINIMA + CHECKS, 101) | np.uint64(1)
_ADD = tk.random_u64(MINIMA + CHECKS, 102)


def shingle_sets(raw: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, concatenated, and their bounds."""
    s, e, bounds = tk.words(raw, offsets)
    hashes = tk.hash_spans(raw, s, e, lower=True)
    grams, gram_bounds = tk.windows(hashes, bounds, k)
    out = []
    for i in range(len(offsets) - 1):
        n = bounds[i + 1] - bounds[i]
        if n >= k:
            out.append(np.unique(grams[gram_bounds[i] : gram_bounds[i + 1]]))
        elif n:
            whole = np.uint64(n)
            for h in hashes[bounds[i] : bounds[i + 1]]:
                whole = tk.combine(np.array([whole]), np.array([h]))[0]
            out.append(np.array([whole], dtype=np.uint64))
        else:
            out.append(np.zeros(0, dtype=np.uint64))
    return (np.concatenate(out) if out else np.zeros(0, np.uint64)), np.concatenate([[0], np.cumsum([len(x) for x in out], dtype=np.int64)]).astype(np.int64)


def minima(grams: np.ndarray, starts: np.ndarray, functions: range) -> np.ndarray:
    """Minimum of each universal hash (a x + b modulo 2**64, upper half kept) over each non-empty set."""
    out = np.empty((len(starts), len(functions)), dtype=np.uint32)
    for n, i in enumerate(functions):
        out[:, n] = np.minimum.reduceat(grams * _MUL[i] + _ADD[i], starts) >> np.uint64(32)
    return out


_SIGNED = "doc_id long, version long, n_shingles long, fp1 long, fp2 long, bands array<long>"


def _sign(k: int, n_rows: int, n_bands: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = tk.utf8(batch.column(1))
            for lo, hi in tk.blocks(offsets):
                part = raw[offsets[lo] : offsets[hi]]
                grams, bounds = shingle_sets(part, offsets[lo : hi + 1] - offsets[lo], k)
                size = np.diff(bounds)
                full = np.flatnonzero(size)
                fp = np.zeros((2, hi - lo), dtype=np.uint64)
                bands, band_bounds = np.zeros(0, dtype=np.uint64), np.zeros(hi - lo + 1, dtype=np.int64)
                if len(full):
                    starts = bounds[:-1][full]
                    for j in (0, 1):
                        fp[j, full] = np.add.reduceat(tk.splitmix(grams ^ _ADD[j]), starts)
                    low = minima(grams, starts, range(n_rows * n_bands))
                    keys = np.empty((len(full), n_bands), dtype=np.uint64)
                    for b in range(n_bands):
                        keys[:, b] = tk.combine(np.full(len(full), b, dtype=np.uint64), *low[:, b * n_rows : (b + 1) * n_rows].T.astype(np.uint64))
                    bands = keys.ravel()
                    band_bounds = np.concatenate([[0], np.cumsum(np.where(size > 0, n_bands, 0))])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), batch.column(2).slice(lo, hi - lo), pa.array(size, pa.int64()), tk.signed(fp[0]), tk.signed(fp[1]), tk.longs(bands, band_bounds)],
                    names=["doc_id", "version", "n_shingles", "fp1", "fp2", "bands"],
                )

    return run


def _checked(k: int):
    """Add the verification signature to the texts of candidates."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = tk.utf8(batch.column("text"))
            for lo, hi in tk.blocks(offsets):
                grams, bounds = shingle_sets(raw[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], k)
                sig = np.zeros((hi - lo, CHECKS), dtype=np.uint8)
                full = np.flatnonzero(np.diff(bounds))
                if len(full):
                    sig[full] = minima(grams, bounds[:-1][full], range(MINIMA, MINIMA + CHECKS)).astype(np.uint8)
                yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(lo, hi - lo) for c in ("rep", "text")), tk.binaries(sig)], names=["rep", "text", "sig"])

    return run


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), -1)


def _similarity(same: np.ndarray) -> np.ndarray:
    """Estimated similarity from the share of equal signature bytes."""
    return (same - 1 / 256) / (1 - 1 / 256)


def _likely(threshold: float):
    """Keep the pairs whose signatures agree often enough for the threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 4096):
                part = batch.slice(lo, 4096)
                same = (_matrix(part.column("sig_a")) == _matrix(part.column("sig_b"))).mean(axis=1)
                yield part.select(["a", "b"]).filter(pa.array(_similarity(same) >= _least(threshold)))

    return run


def _across(threshold: float):
    """Likely pairs of one block of members outside a bucket's largest component with one block of its members:
    of different components, not met through the pivot, and reported in the first bucket that both share."""

    def run(table: pa.Table) -> pa.Table:
        left = table.column("left").to_numpy(zero_copy_only=False)
        rep, root = table.column("rep").to_numpy(), table.column("root").to_numpy()
        pivot, largest, band = (table.column(c)[0].as_py() for c in ("pivot", "largest", "band"))
        sig, bands = _matrix(table.column("sig")), np.array(table.column("bands").to_pylist(), dtype=np.int64)
        x, y = np.flatnonzero(left & (rep != pivot)), np.flatnonzero(~left & (rep != pivot))
        out_a, out_b = [], []
        for i in x.tolist():
            js = y[(root[y] != root[i]) & ((root[y] == largest) | (rep[y] > rep[i]))]
            js = js[_similarity((sig[js] == sig[i]).mean(axis=1)) >= _least(threshold)] if len(js) else js
            if len(js):
                common = bands[js] == bands[i]
                js = js[bands[i][np.argmax(common, axis=1)] == band]
            out_a += np.minimum(rep[js], rep[i]).tolist()
            out_b += np.maximum(rep[js], rep[i]).tolist()
        return pa.table({"a": pa.array(out_a, pa.int64()), "b": pa.array(out_b, pa.int64())})

    return run


def _linked(k: int, percent: int):
    """Keep the pairs with 100 * intersection >= percent * union, on full shingle sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, last_set = None, None

        def shingles(text: str) -> np.ndarray:
            data = text.encode("utf-8", "surrogatepass")
            return shingle_sets(np.frombuffer(data, np.uint8), np.array([0, len(data)]), k)[0]

        for batch in batches:
            keep = np.zeros(batch.num_rows, dtype=bool)
            left, ta, tb = batch.column("a").to_pylist(), batch.column("text_a"), batch.column("text_b")
            for i in range(batch.num_rows):
                if left[i] != last:
                    last, last_set = left[i], shingles(ta[i].as_py())
                other = shingles(tb[i].as_py())
                both = len(np.intersect1d(last_set, other, assume_unique=True))
                keep[i] = 100 * both >= percent * (len(last_set) + len(other) - both)
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    return run


def _classes_of_one_id(nodes: DataFrame, reps: DataFrame, key: list[str]) -> DataFrame:
    """Links (u, v) between all classes that hold one doc_id."""
    several = nodes.groupBy("doc_id").agg(F.min(F.struct(*key)).alias("lo"), F.max(F.struct(*key)).alias("hi")).where("lo <> hi").select("doc_id")
    held = nodes.join(several, "doc_id", "left_semi").select("doc_id", *key).join(reps.select(*key, "rep"), key).select("doc_id", "rep").distinct()
    pivots = held.groupBy("doc_id").agg(F.min("rep").alias("u"))
    return held.join(pivots, "doc_id").where("rep <> u").select("u", F.col("rep").alias("v")).distinct()


def _some_id_has_blank_rows(signed: DataFrame) -> bool:
    """Whether an id has a row without shingles beside one with some."""
    of_id = signed.where("doc_id is not null").groupBy("doc_id").agg(F.min("n_shingles").alias("lo"), F.max("n_shingles").alias("hi"))
    return not of_id.where("lo = 0 and hi > 0").isEmpty()


def near_duplicates(docs: DataFrame, shingle_words: int = 5, percent: int = 85) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``docs`` (doc_id, text).

    Method. One pass makes each document's signature: band keys (28 of 7 minima each at 85 percent, see ``banding``) of
    universal hashes over its distinct word shingles, and a 128-bit fingerprint of the set. Documents of equal sets become one class, a
    node of its own; classes that hold one id are linked. Classes that share a band bucket are candidates. First each member meets its bucket's
    smallest; components follow. Then, where a bucket still holds several components, its members outside the
    largest one meet all members of other components, block against block, so that no link is lost, large groups of
    near copies never become all their pairs, and pairs are compared in place instead of being shipped. Candidates
    are verified on 512 further minima, then exactly on full sets; links become components by alternating
    large-star and small-star.

    Joins that carry texts are sort-merge joins at every size, so the plan does not change as tables grow.

    Edges: a text with fewer words than a shingle is one shingle; null, empty or blank texts have none and link with
    nothing; repeated rows of one id are one node; an id with several texts links by each of them, so
    all its rows and what they link are one component; a null id is linked with nothing, has a null component and is
    kept; other columns are ignored; no rows give no rows."""
    begin(docs)
    k, threshold = shingle_words, percent / 100
    rows = narrow(docs, "text").withColumn("version", F.xxhash64("text"))
    signed = stored(rows.mapInArrow(_sign(k, *banding(threshold)), _SIGNED), "minhash")
    nodes = signed.where("doc_id is not null and n_shingles > 0")
    key = ["fp1", "fp2", "n_shingles"]
    # Equal sets have equal bands, so any row of a class supplies them; its smallest (doc_id, version) supplies the text.
    classes = nodes.groupBy(*key).agg(F.min(F.struct("doc_id", "version")).alias("of"), F.any_value("bands").alias("bands"))
    reps = stored(classes.select(*key, "of", "bands", F.monotonically_increasing_id().alias("rep")), "classes")
    same_id = stored(_classes_of_one_id(nodes, reps, key), "same-id")
    buckets = reps.select(F.explode("bands").alias("band"), "rep", F.col("of.doc_id").alias("least"))
    # The class of the smallest id, so that the buckets of a group of near copies mostly have one pivot.
    pivot = F.min(F.struct("least", "rep")).alias("p")
    shared = buckets.groupBy("band").agg(F.count(F.lit(1)).alias("n"), pivot).where("n > 1").select("band", F.col("p.rep").alias("pivot"))
    members = stored(buckets.drop("least").join(shared, "band"), "buckets")
    wanted = reps.join(members.select("rep").distinct(), "rep").select("rep", F.col("of.doc_id").alias("doc_id"), F.col("of.version").alias("version"))
    picked = rows.where("doc_id is not null").hint("merge").join(wanted, ["doc_id", "version"]).dropDuplicates(["rep"])
    texts = stored(picked.select("rep", "text").mapInArrow(_checked(k), "rep long, text string, sig binary"), "candidates")

    def side(name: str, *columns: str) -> DataFrame:
        return texts.select(F.col("rep").alias(name), *[F.col(c).alias(f"{c}_{name}") for c in columns])

    def links(likely: DataFrame) -> DataFrame:
        """The true links among likely pairs (a, b)."""
        full = likely.hint("merge").join(side("b", "text"), "b").hint("merge").join(side("a", "text"), "a")
        found = full.select("a", "b", "text_a", "text_b").mapInArrow(_linked(k, percent), "a long, b long")
        return stored(found.select(F.col("a").alias("u"), F.col("b").alias("v")).distinct(), "links")

    pairs = members.where("rep <> pivot").select(F.col("pivot").alias("a"), F.col("rep").alias("b")).distinct()
    signatures = pairs.join(side("b", "sig"), "b").join(side("a", "sig"), "a").select("a", "b", "sig_a", "sig_b")
    likely = stored(signatures.mapInArrow(_likely(threshold), "a long, b long"), "likely")
    star = stored(links(likely).unionAll(same_id), "star")
    first = stored(components(star), "components")
    # Buckets that still hold several components.
    named = members.join(first.withColumnRenamed("node", "rep"), "rep", "left").withColumn("root", F.coalesce("root", "rep"))
    per = named.groupBy("band", "root").agg(F.count(F.lit(1)).alias("n"))
    still = per.groupBy("band").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("roots"), F.max_by("root", F.struct("n", "root")).alias("largest"), F.max("n").alias("most")).where("roots > 1")
    blocks = still.select("band", "largest", F.ceil((F.col("n") - F.col("most")) / BLOCK).alias("left_blocks"), F.ceil(F.col("n") / BLOCK).alias("right_blocks"))
    meet = named.join(blocks, "band").join(texts.select("rep", "sig"), "rep").join(reps.select("rep", "bands"), "rep")
    mine = {s: F.pmod(F.xxhash64("rep", F.lit(s)), F.col(f"{s}_blocks")).cast("long") for s in ("left", "right")}
    every = {s: F.explode(F.sequence(F.lit(0).cast("long"), F.col(f"{s}_blocks") - 1)) for s in ("left", "right")}
    columns = ["band", "rep", "root", "pivot", "largest", "sig", "bands"]
    lefts = meet.where("root <> largest").select(*columns, F.lit(True).alias("left"), mine["left"].alias("i"), every["right"].alias("j"))
    rights = meet.select(*columns, F.lit(False).alias("left"), every["left"].alias("i"), mine["right"].alias("j"))
    met = stored(lefts.unionAll(rights).groupBy("band", "i", "j").applyInArrow(_across(threshold), "a long, b long").distinct(), "met")
    more = links(met)
    last = components(star.unionAll(more)) if more.limit(1).count() else first
    drop(members, texts, likely, star, met, more, same_id)
    # A component is named by the smallest id in it.
    found = last.join(reps.select(F.col("rep").alias("node"), F.col("of.doc_id").alias("least")), "node")
    named = found.join(found.groupBy("root").agg(F.min("least").alias("component")), "root").select(F.col("node").alias("rep"), "component")
    classes_of = reps.select(*key, "rep", F.col("of.doc_id").alias("least")).join(named, "rep", "left").select(*key, F.coalesce("component", "least").alias("component"))
    by_row = signed.select("doc_id", "n_shingles", "fp1", "fp2").join(classes_of, key, "left")
    # Rows without shingles link with nothing; if their id has other texts, they follow those.
    if _some_id_has_blank_rows(signed):
        other = by_row.where("doc_id is not null and n_shingles > 0").groupBy("doc_id").agg(F.min("component").alias("other"))
        by_row = by_row.join(other, "doc_id", "left").withColumn("component", F.coalesce("component", "other"))
    component = F.when(F.col("doc_id").isNull(), F.lit(None)).otherwise(F.coalesce("component", "doc_id"))
    return by_row.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"))
