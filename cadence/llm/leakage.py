"""Benchmark decontamination: a BM25 index of test items, searched with every training passage by block-max WAND."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadence.llm import textkit as tk
from cadence.llm.pretokens import lower_case, split
from cadence.llm.tables import begin, stored

SHARD_BYTES = 8_000_000  # test items are indexed in shards of about this size, each small enough to broadcast
K1, B = 1.2, 0.75
BLOCK = 8  # postings in a block
THRESHOLD = 0.5  # part of an item's own BM25 score that a passage must reach
OVERLAP = 0.8  # part of the question, and of the answer, that must stand in the passage in order


def word_hashes(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words (runs of letters, single digits) of each text, case folded, and their bounds."""
    low = lower_case(raw)
    starts, ends, _ = split(low, offsets, "word")
    lead = low[starts] if len(starts) else np.zeros(0, np.uint8)
    keep = (lead >= 128) | ((lead >= 97) & (lead <= 122)) | ((lead >= 48) & (lead <= 57))
    starts, ends = starts[keep], ends[keep]
    return tk.hash_spans(low, starts, ends), np.searchsorted(starts, offsets)


def _words(text: str) -> list[int]:
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    return word_hashes(raw, np.array([0, len(raw)]))[0].tolist()


def question_and_answer(text: str) -> tuple[list[int], list[int]]:
    """An item's words in two parts: the last sentence is the answer; of a single sentence its last third is."""
    parts = [w for w in map(_words, re.split(r"(?<=[.!?])\s+", text)) if w]
    if len(parts) > 1:
        return [w for p in parts[:-1] for w in p], parts[-1]
    words = parts[0] if parts else []
    cut = len(words) - max(1, len(words) // 3)
    return (words[:cut], words[cut:]) if len(words) > 1 else (words, words)


def in_order(part: list[int], passage: list[int]) -> float:
    """The share of ``part`` that stands in ``passage`` in the same order (longest common subsequence, bit by bit)."""
    at: dict[int, int] = {}
    for i, w in enumerate(part):
        at[w] = at.get(w, 0) | 1 << i
    full = (1 << len(part)) - 1
    row = full
    for w in passage:
        hit = row & at.get(w, 0)
        if hit:
            row = (row + hit | row - hit) & full
    return (len(part) - row.bit_count()) / len(part)


class Index:
    """Posting lists of test items with impacts as shares of each item's own score, cut into blocks with maxima."""

    def __init__(self, items: list[tuple[int, str]], threshold: float = THRESHOLD, counts: tuple[int, float, dict[int, int]] | None = None):
        """``counts``: items, mean words of an item and items holding each word, of the whole benchmark if these are a
        part of it."""
        self.threshold = threshold
        self.items = [(i, t) for i, t in items if t and _words(t)]
        texts = [_words(t) for _, t in self.items]
        self.parts = [question_and_answer(t) for _, t in self.items]
        self.longest = max(map(len, texts), default=1)
        n, mean, held = counts or count_words(texts)
        self.postings: dict[int, tuple[list[int], list[float], list[float], float]] = {}
        lists: dict[int, list[tuple[int, float]]] = {}
        essential: list[tuple[int, int, float]] = []
        self.rest = np.zeros(len(texts))
        self.sizes = list(map(len, texts))
        self.shares: list[dict[int, float]] = []
        for j, t in enumerate(texts):
            tf: dict[int, int] = {}
            for w in t:
                tf[w] = tf.get(w, 0) + 1
            score = {w: np.log(1 + (n - held[w] + 0.5) / (held[w] + 0.5)) * f * (K1 + 1) / (f + K1 * (1 - B + B * len(t) / mean)) for w, f in tf.items()}
            own = sum(score.values())
            self.shares.append({w: v / own for w, v in score.items()})
            for w in sorted(score, key=lambda w: (-held[w], w)):
                share = score[w] / own
                lists.setdefault(w, []).append((j, share))
                # The commonest words, up to half the threshold, cannot lift a passage over it by themselves.
                if self.rest[j] + share <= threshold / 2:
                    self.rest[j] += share
                else:
                    essential.append((w, j, share))
        for w, posts in lists.items():
            ids, shares = [p[0] for p in posts], [p[1] for p in posts]
            self.postings[w] = ids, shares, [max(shares[i : i + BLOCK]) for i in range(0, len(shares), BLOCK)], max(shares)
        essential.sort()
        self.terms, first = np.unique(np.array([e[0] for e in essential], dtype=np.uint64), return_index=True)
        self.term_bounds = np.append(first, len(essential)).astype(np.int64)
        self.term_items = np.array([e[1] for e in essential], dtype=np.int64)
        self.term_shares = np.array([e[2] for e in essential])

    def candidates(self, hashes: np.ndarray, halves: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Passages (half-passage numbers; passage p is the halves p and p + 1) in which the essential words of some
        item weigh enough to reach the threshold if all its other words were there too. first and last bound the
        passages that a word's half belongs to."""
        if not len(self.terms) or not len(hashes):
            return np.zeros(0, dtype=np.int64)
        at = np.minimum(np.searchsorted(self.terms, hashes), len(self.terms) - 1)
        hit = np.flatnonzero(self.terms[at] == hashes)
        v = len(self.terms)
        here, before = halves[hit] <= last[hit], halves[hit] - 1 >= first[hit]
        keys = [halves[hit[here]] * v + at[hit[here]], (halves[hit[before]] - 1) * v + at[hit[before]]]
        pairs = np.unique(np.concatenate(keys))
        passage, term = pairs // v, pairs % v
        n = np.diff(self.term_bounds)[term]
        index = np.arange(n.sum()) + np.repeat(self.term_bounds[:-1][term] - np.concatenate([[0], np.cumsum(n)[:-1]]), n)
        key = np.repeat(passage, n) * len(self.items) + self.term_items[index]
        order = np.argsort(key, kind="stable")
        key = key[order]
        if not len(key):
            return np.zeros(0, dtype=np.int64)
        start = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        total = np.add.reduceat(self.term_shares[index][order], start)
        key = key[start]
        return np.unique(key[total + self.rest[key % len(self.items)] >= self.threshold - 1e-9] // len(self.items))

    def search(self, words: set[int]) -> list[tuple[int, float]]:
        """All items whose score for a passage's words reaches the threshold, by block-max WAND."""
        lists = [[p[0][0], 0, *p] for w in sorted(words) if (p := self.postings.get(w))]
        need, out = self.threshold - 1e-9, []

        def move(cursor: list, item: int) -> None:
            ids, at = cursor[2], cursor[1]
            while at < len(ids) and ids[at] < item:
                at = at + BLOCK if at + BLOCK < len(ids) and ids[at + BLOCK] < item else at + 1
            cursor[1] = at
            cursor[0] = ids[at] if at < len(ids) else 1 << 60

        while lists:
            lists.sort(key=lambda c: c[0])
            while lists and lists[-1][0] == 1 << 60:
                lists.pop()
            total, pivot = 0.0, -1
            for i, c in enumerate(lists):
                total += c[5]
                if total >= need:
                    pivot = i
                    break
            if pivot < 0:
                break
            item = lists[pivot][0]
            while pivot + 1 < len(lists) and lists[pivot + 1][0] == item:
                pivot += 1
            bound, ends = 0.0, []
            for c in lists[: pivot + 1]:
                ids, block = c[2], c[1] // BLOCK
                while (block + 1) * BLOCK < len(ids) and ids[(block + 1) * BLOCK] <= item:
                    block += 1
                last = ids[min(len(ids), (block + 1) * BLOCK) - 1]
                if last >= item:
                    bound += c[4][block]
                    ends.append(last)
            if bound < need:
                # No item up to the nearest block end can reach the threshold with these lists.
                after = min([*ends, *([lists[pivot + 1][0] - 1] if pivot + 1 < len(lists) else [])], default=item) + 1
                for c in lists[: pivot + 1]:
                    move(c, max(after, item + 1))
            elif lists[0][0] == item:
                score = sum(c[3][c[1]] for c in lists[: pivot + 1])
                if score >= need:
                    out.append((item, score))
                for c in lists[: pivot + 1]:
                    move(c, item + 1)
            else:
                for c in lists[:pivot]:
                    move(c, item)
        return out

    def matches(self, hashes: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[int, int, float, float, float, int]]:
        """(text number, item number, score, question overlap, answer overlap, first word) of verified passages, given
        the words of texts. An item's passages are twice its own words long and start at multiples of its length; they
        lie whole in one of the wider windows that are searched."""
        half = 2 * self.longest
        sizes = np.diff(bounds)
        count = -(-sizes // half)
        base = np.concatenate([[0], np.cumsum(count)])
        doc = np.repeat(np.arange(len(sizes)), sizes)
        halves = base[doc] + (np.arange(len(hashes)) - bounds[doc]) // half
        final = base[:-1] + np.maximum(count - 2, 0)
        for p in self.candidates(hashes, halves, base[doc], final[doc]).tolist():
            d = int(np.searchsorted(base, p, side="right")) - 1
            at = (p - int(base[d])) * half
            lo = int(bounds[d]) + at
            words = hashes[lo : min(int(bounds[d + 1]), lo + 2 * half)].tolist()
            for j, _ in self.search(set(words)):
                n, share = self.sizes[j], self.shares[j]
                for first in range(-(-at // n) * n, at + len(words), n):
                    passage = words[first - at : first - at + 2 * n]
                    score = sum(share[w] for w in share.keys() & set(passage))
                    if score >= self.threshold - 1e-9:
                        q, a = (in_order(part, passage) for part in self.parts[j])
                        if q >= OVERLAP and a >= OVERLAP:
                            yield d, j, score, q, a, first


def count_words(texts: list[list[int]]) -> tuple[int, float, dict[int, int]]:
    """The number of texts, their mean words and the texts holding each word."""
    held: dict[int, int] = {}
    for t in texts:
        for w in set(t):
            held[w] = held.get(w, 0) + 1
    return len(texts), sum(map(len, texts)) / max(1, len(texts)), held


class Shard:
    """One index for each class of items by length (powers of two), so that windows follow the items' lengths."""

    def __init__(self, items: list[tuple[int, str]], counts: tuple[int, float, dict[int, int]] | None = None):
        sizes = [(i, t, _words(t)) for i, t in items if t]
        counts = counts or count_words([w for *_, w in sizes if w])
        classes: dict[int, list[tuple[int, str]]] = {}
        for i, t, w in sizes:
            if w:
                classes.setdefault((len(w) - 1).bit_length(), []).append((i, t))
        self.groups = [Index(classes[c], THRESHOLD, counts) for c in sorted(classes)]
        self.items = [item for g in self.groups for item in g.items]

    def matches(self, raw: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int, float, float, float, int]]:
        """As of ``Index.matches``, with numbers in ``items``."""
        hashes, bounds = word_hashes(raw, offsets)
        before = 0
        for g in self.groups:
            for d, j, *more in g.matches(hashes, bounds):
                yield d, before + j, *more
            before += len(g.items)


def _word_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        raw, offsets = tk.utf8(batch.column(1))
        hashes, bounds = word_hashes(raw, offsets)
        held = [np.unique(hashes[lo:hi]) for lo, hi in zip(bounds[:-1], bounds[1:], strict=True)]
        words = tk.longs(np.concatenate([*held, np.zeros(0, np.uint64)]), np.concatenate([[0], np.cumsum([len(h) for h in held], dtype=np.int64)]))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.diff(bounds).astype(np.int64)), words], names=["shard", "n_words", "words"])


def indexes(benchmark: DataFrame, shard_bytes: int = SHARD_BYTES) -> Iterator[Shard]:
    """Indexes of the test items, shard by shard; only one shard is on the driver at a time. Scores rest on counts over
    the whole benchmark, taken in Spark where there are several shards; a shard gets those of its own words."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where("text is not null")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = -(-size // shard_bytes)
    counts = None
    if shards > 1:
        begin(benchmark)
        held = stored(items.select(F.pmod(F.xxhash64("text"), F.lit(shards)).cast("long").alias("shard"), "text").mapInArrow(_word_rows, "shard long, n_words long, words array<long>").where("n_words > 0"), "item-words")
        n, mean = held.agg(F.count(F.lit(1)), F.avg("n_words")).first()
        each = held.select("shard", F.explode("words").alias("word"))
        total = stored(each.groupBy("word").agg(F.count(F.lit(1)).alias("n")), "item-counts")
    for s in range(shards):
        rows = items.where(F.pmod(F.xxhash64("text"), F.lit(shards)) == s).collect()
        if shards > 1:
            own = each.where(F.col("shard") == s).select("word").distinct().join(total, "word").collect()
            counts = n, mean, {r.word % (1 << 64): r.n for r in own}
        yield Shard(sorted(((r.item_id, r.text) for r in rows), key=lambda r: (r[0] is None, r[0] or 0, r[1])), counts)


_FOUND = "doc_id long, item_id long, score double, question_overlap double, answer_overlap double, first_word long"


def find_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row for each document and test item it contains: doc_id, item_id, score, question_overlap,
    answer_overlap, first_word (of the best passage).

    An item's passages are overlapping windows of twice its own words, so its text lies whole in one, whatever other
    items there are. An item's impacts are shares of the BM25 score it has for itself; every passage whose words reach half of it is
    retrieved; word counts and mean length are those of the whole benchmark. Passages without enough of an item's essential (rarer) words are passed over in bulk first, as no
    item can reach the threshold in them. A retrieved pair counts when at least 0.8 of the question and of the
    answer (see ``question_and_answer``) stand in the passage in order. Items are indexed in shards of bounded size,
    each broadcast for one pass over the documents.

    Edges: null, empty and word-free texts and items match nothing; repeated rows give repeated matches; a null id
    is reported as null; equal items are all reported; other columns are ignored; empty tables give no rows."""
    spark = begin(docs)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = []
    for index in indexes(benchmark):
        shared = spark.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = shared.value
            for batch in batches:
                names = batch.column(0).to_pylist()
                raw, offsets = tk.utf8(batch.column(1))
                best: dict[tuple[int, int], tuple] = {}
                for lo, hi in tk.blocks(offsets):
                    for d, j, score, q, a, first in index.matches(raw[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]):
                        best[lo + d, j] = max(best.get((lo + d, j), (0.0,)), (score, q, a, -first))
                out = [(names[d], index.items[j][0], s, q, a, -first) for (d, j), (s, q, a, first) in best.items()]
                columns = list(zip(*out, strict=True)) or [[]] * 6
                types = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types, strict=True)], names=[c.split()[0] for c in _FOUND.split(", ")])

        found.append(rows.mapInArrow(run, _FOUND))
    if not found:
        return spark.createDataFrame([], _FOUND)
    out = found[0]
    for f in found[1:]:
        out = out.unionAll(f)
    return out


def drop_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the documents that contain a test item (see ``find_leaks``); the columns stay as they are."""
    spark = begin(docs)
    for index in indexes(benchmark):
        shared = spark.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keep = np.ones(batch.num_rows, dtype=bool)
                raw, offsets = tk.utf8(batch.column("text"))
                for lo, hi in tk.blocks(offsets):
                    for d, *_ in shared.value.matches(raw[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]):
                        keep[lo + d] = False
                yield batch.filter(pa.array(keep))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
