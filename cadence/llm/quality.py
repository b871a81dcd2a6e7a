"""Quality classifier: random-indexing vectors pooled per document, then a two-layer network with calibrated scores."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadence.llm import textkit as tk
from cadence.llm.pretokens import _CLASS, DIGIT, LETTER, lower_case, split
from cadence.llm.tables import begin, fold, narrow, stored, training_labels

DIM = 32  # dimensions of a vector
SHAPES = 256  # codes of a word's form
VOCABULARY = 1 << 14  # vectors: the forms, then hashed words; fixed, so the table stays 4 MB for any corpus
REACH = 2  # words to either side that make up a context
NONZERO = 2  # entries of an index vector
HIDDEN = 32

# Index vectors: NONZERO random places with random signs, one for each entry of the vocabulary.
_DRAW = tk.random_u64(VOCABULARY * NONZERO, 301).reshape(NONZERO, VOCABULARY)
PLACE = (_DRAW % np.uint64(DIM)).astype(np.int64)
SIGN = 1.0 - 2.0 * ((_DRAW >> np.uint64(32)) & np.uint64(1)).astype(np.float64)


def items(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Vocabulary entries of the words and marks of each text: (hashed word, form), and each text's bounds.

    A form is the class (letters, digit, mark), the case, the length, whether it is glued to what precedes it, and
    whether it repeats the word before."""
    low = lower_case(raw)
    starts, ends, bounds = split(low, offsets, "word")
    if not len(starts):
        return starts, starts, bounds
    hashes = tk.hash_spans(low, starts, ends)
    word = (SHAPES + hashes % np.uint64(VOCABULARY - SHAPES)).astype(np.int64)
    cls = _CLASS[low[starts]].astype(np.int64)
    word[cls == DIGIT] = SHAPES
    size = ends - starts
    upper = np.concatenate([[0], np.cumsum((raw >= 65) & (raw <= 90), dtype=np.int64)])
    capitals = upper[ends] - upper[starts]
    case = np.where((capitals > 1) & (2 * capitals > size), 2, np.where(capitals > 0, 1, 0))
    glued = np.zeros(len(starts), dtype=np.int64)
    glued[1:] = (starts[1:] == ends[:-1]) & ~np.isin(starts[1:], offsets)
    # The word before: the last run of letters, whatever stands between.
    letters = np.flatnonzero(cls == LETTER)
    again = np.zeros(len(starts), dtype=np.int64)
    again[letters[1:]] = (hashes[letters[1:]] == hashes[letters[:-1]]) & (np.searchsorted(offsets, starts[letters[1:]], "right") == np.searchsorted(offsets, starts[letters[:-1]], "right"))
    length = np.digitize(size, [4, 8, 13])
    form = cls | length << 2 | glued << 4 | again << 5 | np.minimum(case, 2) << 6
    return word, form, bounds


def context_sums(word: np.ndarray, form: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """For each vocabulary entry, the sum of the index vectors of what stands near it in its texts."""
    out = np.zeros(VOCABULARY * DIM)
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    for step in range(1, REACH + 1):
        near = np.flatnonzero(text[step:] == text[:-step])
        for here, there in ((near, near + step), (near + step, near)):
            for mine in (word, form):
                for other in (word, form):
                    target, source = mine[here] * DIM, other[there]
                    for j in range(NONZERO):
                        out += np.bincount(target + PLACE[j][source], weights=SIGN[j][source], minlength=VOCABULARY * DIM)
    return out.reshape(VOCABULARY, DIM)


def _blocks(batch: pa.RecordBatch):
    raw, offsets = tk.utf8(batch.column("text"))
    for lo, hi in tk.blocks(offsets):
        yield lo, hi, raw[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]


_SUMS = [f"c{i}" for i in range(DIM)]


def _partial_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros((VOCABULARY, DIM))
    for batch in batches:
        for _, _, raw, offsets in _blocks(batch):
            total += context_sums(*items(raw, offsets))
    used = np.flatnonzero(total.any(axis=1))
    yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), *(pa.array(total[used, i].astype(np.int64)) for i in range(DIM))], names=["entry", *_SUMS])


def learn_vectors(docs: DataFrame) -> np.ndarray:
    """The vector of each vocabulary entry: its context sum over all documents, damped and scaled to length one.

    Each task adds up its own texts and ships at most one row for an entry; sums are integers, so the result does
    not depend on the order of tasks."""
    begin(docs)
    sums = narrow(docs, "text").mapInArrow(_partial_sums, "entry int, " + ", ".join(f"{c} long" for c in _SUMS))
    rows = sums.groupBy("entry").agg(*(F.sum(c).alias(c) for c in _SUMS)).collect()
    table = np.zeros((VOCABULARY, DIM))
    for r in rows:
        table[r.entry] = r[1:]
    table = np.sign(table) * np.sqrt(np.abs(table))
    return (table / np.maximum(np.linalg.norm(table, axis=1, keepdims=True), 1e-12)).astype(np.float32)


def pooled(vectors: np.ndarray, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Mean word vector and mean form vector of each text; zeros for a text without words."""
    word, form, bounds = items(raw, offsets)
    size = np.diff(bounds)
    out = np.zeros((len(size), 2 * DIM))
    some = np.flatnonzero(size)
    if len(some):
        at = bounds[:-1][some]
        for k, entries in enumerate((word, form)):
            out[some, k * DIM : (k + 1) * DIM] = np.add.reduceat(vectors[entries], at, axis=0) / size[some][:, None]
    return out


@dataclass
class Network:
    """Two layers over standardized features; scores are the logistic of the output over the temperature."""

    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def output(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.mean) / self.scale @ self.w1 + self.b1) @ self.w2 + self.b2

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.output(x) / self.temperature, -30, 30)))


def fit(x: np.ndarray, y: np.ndarray, epochs: int = 40, rate: float = 0.01, decay: float = 1e-4) -> Network:
    """Adam on the cross-entropy of four fifths of the rows; the temperature is the one that serves the last fifth
    best. Without both labels the score is the share of label 1 (0.5 if there are no rows)."""
    dim = x.shape[1]
    rng = np.random.default_rng(11)
    share = float(y.mean()) if len(y) else 0.5
    if not len(y) or not 0 < share < 1:
        return Network(np.zeros(dim), np.ones(dim), np.zeros((dim, HIDDEN)), np.zeros(HIDDEN), np.zeros(HIDDEN), float(np.clip(np.log((share + 1e-6) / (1 - share + 1e-6)), -6, 6)))
    order = rng.permutation(len(x))
    cut = max(1, len(x) // 5)
    check, learn = order[:cut], order[cut:] if len(x) > 5 else order
    net = Network(x[learn].mean(axis=0), x[learn].std(axis=0) + 1e-4, rng.normal(0, dim**-0.5, (dim, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, HIDDEN**-0.5, HIDDEN), 0.0)
    z, t = (x[learn] - net.mean) / net.scale, y[learn]
    parts = [net.w1, net.b1, net.w2, np.zeros(1)]
    first, second = [np.zeros_like(p) for p in parts], [np.zeros_like(p) for p in parts]
    step = 0
    for _ in range(epochs):
        for lo in range(0, len(z), 256):
            pick = rng.integers(0, len(z), min(256, len(z)))
            zb, tb = z[pick], t[pick]
            h = np.tanh(zb @ parts[0] + parts[1])
            error = (1 / (1 + np.exp(-np.clip(h @ parts[2] + parts[3][0], -30, 30))) - tb) / len(pick)
            back = np.outer(error, parts[2]) * (1 - h * h)
            grads = [zb.T @ back + decay * parts[0], back.sum(axis=0), h.T @ error + decay * parts[2], np.array([error.sum()])]
            step += 1
            for p, g, m, v in zip(parts, grads, first, second, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    net.w1, net.b1, net.w2, net.b2 = parts[0], parts[1], parts[2], float(parts[3][0])
    out, truth = net.output(x[check]), y[check]
    losses = [(np.logaddexp(0, -np.where(truth > 0, 1, -1) * out / temp).mean(), temp) for temp in np.geomspace(0.25, 8, 41)]
    net.temperature = float(min(losses)[1])
    return net


def train(docs: DataFrame, labels: DataFrame, limit: int = 20_000) -> tuple[np.ndarray, Network]:
    """Vectors from all documents; the network from at most about ``limit`` labelled documents outside the held-out
    fold (the documented bound of this classifier), whose pooled vectors come to the driver."""
    vectors = learn_vectors(docs)
    wanted = training_labels(labels, "quality", limit)
    sample = narrow(docs, "text").join(F.broadcast(wanted), "doc_id").select("doc_id", "text", "label")
    shared = docs.sparkSession.sparkContext.broadcast(vectors)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, raw, offsets in _blocks(batch):
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(lo, hi - lo), batch.column("label").slice(lo, hi - lo), pa.array(list(pooled(shared.value, raw, offsets)), pa.list_(pa.float64()))], names=["doc_id", "label", "x"]
                )

    rows = stored(sample.mapInArrow(run, "doc_id long, label double, x array<double>"), "features").orderBy("doc_id").collect()
    x = np.array([r.x for r in rows]).reshape(len(rows), 2 * DIM)
    return vectors, fit(x, np.array([float(r.label > 0) for r in rows]))


def predictions(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted of every document (score: 0 to 1, higher where label 1 is likelier).

    Edges: null, empty and blank texts pool to zeros and are scored so; a null id and repeated rows are scored like
    others; a null label or id does not train; other columns are ignored; no rows give no rows."""
    vectors, net = train(docs, labels)
    shared = docs.sparkSession.sparkContext.broadcast((vectors, net))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors, net = shared.value
        for batch in batches:
            for lo, hi, raw, offsets in _blocks(batch):
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(lo, hi - lo), pa.array(net.score(pooled(vectors, raw, offsets)))], names=["doc_id", "score"])

    scored = narrow(docs, "text").mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", F.coalesce(fold() == 0, F.lit(False)).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
