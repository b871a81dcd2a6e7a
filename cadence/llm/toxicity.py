"""Toxicity by a weighted finite-state grammar over clauses, with its insult lexicon and weights learned from labels."""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadence.llm import textkit as tk
from cadence.llm.pretokens import lower_case, split
from cadence.llm.tables import begin, fold, narrow, stored, training_labels

# Symbols that the grammar reads, one for each word or mark.
PLAIN, INSULT, THREAT, TARGET, NEGATION, REPORT, QUOTE = range(7)

# Closed word classes of the four languages.
WORDS = {
    THREAT: "kill killing hurt destroy murder stab shoot strangle töten umbringen erschießen verprügeln tuer frapper égorger étrangler matar golpear degollar",
    TARGET: "you your yours yourself u they them those these people du dich dir dein deine ihr euch euer sie tu toi te ton ta vous votre vos ils eux tú ti tus usted ustedes vosotros vuestro ellos esos",
    NEGATION: "not no never none isn aren wasn weren don doesn didn cannot won nicht kein keine keinen nie niemals pas jamais aucun aucune nunca jamás ningún ninguna tampoco",
    REPORT: "said says say told tells wrote writes called calls claimed quoted reported according sagte sagt schrieb nannte behauptete laut dit disait écrit appelé selon raconte dijo dice escribió llamó según afirmó",
}
CLAUSE_ENDS = b".!?;\n"
PREFIXES = (4, 5, 6, 7)  # bytes of a word's beginning that may be a learned stem

NEAR = 4  # words between a target and an insult, or a negation and what it denies


@dataclass
class Transducer:
    """A deterministic transducer over the symbols: ``step(state, symbol)`` gives the next state and what it writes."""

    start: tuple
    step: object
    table: dict = field(default_factory=dict)

    def __call__(self, state: tuple, symbol: int) -> tuple:
        key = state, symbol
        if key not in self.table:
            self.table[key] = self.step(state, symbol)
        return self.table[key]


def compose(*parts: Transducer) -> Transducer:
    """All parts read the same symbols in step; the result writes the tuple of what they write."""

    def step(state: tuple, symbol: int) -> tuple:
        moves = [p(s, symbol) for p, s in zip(parts, state, strict=True)]
        return tuple(m[0] for m in moves), tuple(m[1] for m in moves)

    return Transducer(tuple(p.start for p in parts), step)


def _countdown(opens: int, reach: int) -> Transducer:
    """Writes whether the symbol ``opens`` stood within the last ``reach`` symbols."""

    def step(state: tuple, symbol: int) -> tuple:
        (left,) = state
        return ((reach,), True) if symbol == opens else ((max(0, left - 1),), left > 0)

    return Transducer((0,), step)


def _hostile() -> Transducer:
    """Writes the insult or threat it reads, or 0."""
    return Transducer((), lambda state, symbol: (state, symbol if symbol in (INSULT, THREAT) else 0))


def _reported() -> Transducer:
    """Writes whether a reporting verb came earlier in the clause, or a quotation is open."""

    def step(state: tuple, symbol: int) -> tuple:
        verb, quoted = state
        if symbol == REPORT:
            verb = True
        if symbol == QUOTE:
            quoted = not quoted
        return (verb, quoted), verb or quoted

    return Transducer((False, False), step)


GRAMMAR = compose(_hostile(), _countdown(TARGET, NEAR), _countdown(NEGATION, NEAR), _reported())
PATTERNS = list(itertools.product((INSULT, THREAT), ("bare", "aimed"), ("said", "negated", "reported")))
_COLUMN = {p: i for i, p in enumerate(PATTERNS)}
# Weights before any label is seen, which the fit is drawn to: aimed counts more, denied and quoted less.
PRIOR = np.array([(1.0 if p[1] == "bare" else 1.5) * {"said": 1.0, "negated": 0.3, "reported": 0.3}[p[2]] * (1.0 if p[0] == INSULT else 0.6) for p in PATTERNS])


def match(symbols: list[int]) -> list[int]:
    """The patterns (column numbers) matched in one clause, in order; a target may also follow what it is hit with."""
    state, out, since = GRAMMAR.start, [], 99
    for s in symbols:
        state, (hostile, aimed, negated, reported) = GRAMMAR(state, s)
        since += 1
        if hostile:
            out.append(_COLUMN[hostile, "aimed" if aimed else "bare", "reported" if reported else "negated" if negated else "said"])
            since = 0
        elif s == TARGET and since < NEAR:
            kind, _, manner = PATTERNS[out[-1]]
            out[-1] = _COLUMN[kind, "aimed", manner]
    return out


def _hash_words(text: str) -> np.ndarray:
    raw = np.frombuffer(text.encode(), np.uint8)
    s, e, _ = tk.words(raw, np.array([0, len(raw)]))
    return np.sort(tk.hash_spans(raw, s, e))


_FIXED = {kind: _hash_words(text) for kind, text in WORDS.items()}


def _among(values: np.ndarray, table: np.ndarray) -> np.ndarray:
    if not len(table):
        return np.zeros(len(values), dtype=bool)
    at = np.minimum(np.searchsorted(table, values), len(table) - 1)
    return table[at] == values


class Reader:
    """Words of a block of texts with the hashes that lexicon features are made of."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray):
        self.low = lower_case(raw)
        self.starts, self.ends, self.bounds = split(self.low, offsets, "word")
        self.hashes = tk.hash_spans(self.low, self.starts, self.ends)
        lead = self.low[self.starts] if len(self.starts) else np.zeros(0, np.uint8)
        self.word = (lead >= 128) | ((lead >= 97) & (lead <= 122))
        self.doc = np.repeat(np.arange(len(offsets) - 1), np.diff(self.bounds))

    def features(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(kind, which words, their hashes): kind 0 is the whole word, n a stem of n bytes."""
        which = np.flatnonzero(self.word)
        yield 0, which, self.hashes[which]
        for n in PREFIXES:
            which = which[self.ends[which] - self.starts[which] > n]
            yield n, which, tk.hash_spans(self.low, self.starts[which], self.starts[which] + n)

    def symbols(self, lexicon: dict[int, np.ndarray]) -> np.ndarray:
        out = np.zeros(len(self.starts), dtype=np.int8)
        for kind, table in _FIXED.items():
            out[self.word & _among(self.hashes, table)] = kind
        for kind, which, hashes in self.features():
            out[which[_among(hashes, lexicon[kind])]] = INSULT
        lead = self.low[self.starts] if len(self.starts) else np.zeros(0, np.uint8)
        out[lead == ord('"')] = QUOTE
        return out

    def counts(self, lexicon: dict[int, np.ndarray], n: int) -> np.ndarray:
        """How often each pattern is matched in each text."""
        out = np.zeros((n, len(PATTERNS)))
        symbols = self.symbols(lexicon)
        hits = np.flatnonzero((symbols == INSULT) | (symbols == THREAT))
        if not len(hits):
            return out
        ends = np.zeros(256, dtype=bool)
        ends[list(CLAUSE_ENDS)] = True
        passed = np.cumsum(ends[self.low])[self.starts]
        cut = np.flatnonzero((np.diff(passed) > 0) | (np.diff(self.doc) > 0)) + 1
        edges = np.concatenate([[0], cut, [len(symbols)]])
        for c in np.unique(np.searchsorted(edges, hits, side="right") - 1).tolist():
            lo, hi = edges[c], edges[c + 1]
            for p in match(symbols[lo:hi].tolist()):
                out[self.doc[lo], p] += 1
        return out


def _blocks(batch: pa.RecordBatch):
    raw, offsets = tk.utf8(batch.column("text"))
    for lo, hi in tk.blocks(offsets):
        yield lo, hi, raw[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]


def _document_counts(of: dict[int, np.ndarray] | None):
    """(kind, feature, documents, toxic documents) of a batch; only the features in ``of``, if given."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            toxic = batch.column("label").to_numpy(zero_copy_only=False) > 0
            for lo, hi, raw, offsets in _blocks(batch):
                reader = Reader(raw, offsets)
                for kind, which, hashes in reader.features():
                    if of is not None:
                        keep = _among(hashes, of[kind])
                        which, hashes = which[keep], hashes[keep]
                    doc = reader.doc[which]
                    order = np.lexsort((doc, hashes))
                    h, d = hashes[order], doc[order]
                    first = np.ones(len(h), dtype=bool)
                    first[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
                    h, d = h[first], d[first]
                    if not len(h):
                        continue
                    at = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
                    n = np.diff(np.append(at, len(h)))
                    bad = np.add.reduceat(toxic[lo:hi][d].astype(np.int64), at)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), kind, np.int32)), tk.signed(h[at]), pa.array(n.astype(np.int64)), pa.array(bad)], names=["kind", "feature", "docs", "bad"])

    return run


_COUNTED = "kind int, feature long, docs long, bad long"


def learn_lexicon(sample: DataFrame, n_docs: int, n_toxic: int, entries: int = 20_000) -> dict[int, np.ndarray]:
    """Words and word stems that mark toxic documents, by kind, as sorted hashes.

    Candidates are features of toxic sample documents (at most ``entries``, the most frequent); their documents are
    then counted in the whole sample. A feature is kept if at least four fifths of its documents (and two more, for caution) are toxic and that share
    is beyond chance: documents times the divergence from the base rate exceeds the log of the number of candidates
    by 5."""

    def total(df: DataFrame) -> DataFrame:
        return df.groupBy("kind", "feature").agg(F.sum("docs").alias("docs"), F.sum("bad").alias("bad"))

    first = total(sample.where("label > 0").mapInArrow(_document_counts(None), _COUNTED)).where("bad >= 3")
    rows = first.orderBy(F.desc("bad"), "kind", "feature").limit(entries).select("kind", "feature").collect()
    wanted = {k: np.sort(np.array([r.feature for r in rows if r.kind == k], dtype=np.int64).view(np.uint64)) for k in (0, *PREFIXES)}
    lexicon = {k: np.zeros(0, dtype=np.uint64) for k in wanted}
    if not rows or not 0 < n_toxic < n_docs:
        return lexicon
    base = n_toxic / n_docs
    counted = total(sample.mapInArrow(_document_counts(wanted), _COUNTED)).collect()
    for k in wanted:
        found = []
        for r in counted:
            if r.kind == k and r.bad >= 0.8 * (r.docs + 2):
                p = min(r.bad / r.docs, 1 - 1e-9)
                if p > base and r.docs * (p * np.log(p / base) + (1 - p) * np.log((1 - p) / (1 - base))) > np.log(len(rows)) + 5:
                    found.append(r.feature)
        lexicon[k] = np.sort(np.array(found, dtype=np.int64).view(np.uint64))
    return lexicon


def _pattern_rows(lexicon: dict[int, np.ndarray], weights: np.ndarray | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, raw, offsets in _blocks(batch):
                x = Reader(raw, offsets).counts(lexicon, hi - lo)
                if weights is None:
                    yield pa.RecordBatch.from_arrays([batch.column("label").slice(lo, hi - lo), pa.array(x.tolist(), pa.list_(pa.float64()))], names=["label", "x"])
                else:
                    score = 1 / (1 + np.exp(-np.clip(weights[0] + np.log1p(x) @ weights[1:], -30, 30)))
                    yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(lo, hi - lo), pa.array(score)], names=["doc_id", "score"])

    return run


def fit_weights(x: np.ndarray, y: np.ndarray, pull: float = 1.0) -> np.ndarray:
    """Logistic weights (intercept first) of log pattern counts, drawn to the prior; the patterns never count
    against toxicity."""
    x = np.log1p(x)
    mean = np.concatenate([[-3.0], 2.5 * PRIOR])
    z = np.column_stack([np.ones(len(x)), x])
    w = mean.copy()
    tie = np.concatenate([[1e-3], np.full(x.shape[1], pull)])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        grad = z.T @ (p - y) + tie * (w - mean)
        hess = (z * (p * (1 - p))[:, None]).T @ z + np.diag(tie + 1e-6)
        step = np.linalg.solve(hess, grad)
        w -= step * min(1.0, 4.0 / (np.abs(step).max() + 1e-12))
        if np.abs(step).max() < 1e-8:
            break
    w[1:] = np.maximum(w[1:], 0.0)
    return w


_KEYS = ["k1", "k2", "k3"]
_KEY_MULTIPLIERS = tk.random_u64(len(_KEYS), 401) | np.uint64(1)


def _copy_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Three minima over hashed five-word shingles of each text: near copies mostly share one. A text of fewer words
    has keys of its own bytes, so that only equal texts share them, however the rows are cut into batches."""
    for batch in batches:
        for lo, hi, raw, offsets in _blocks(batch):
            starts, ends, bounds = tk.words(raw, offsets)
            grams, gram_bounds = tk.windows(tk.hash_spans(raw, starts, ends, lower=True), bounds, 5)
            keys = np.zeros((len(_KEYS), hi - lo), dtype=np.uint64)
            full = np.flatnonzero(np.diff(gram_bounds))
            short = tk.hash_spans(raw, offsets[:-1], offsets[1:], lower=True)  # a text without a shingle is its own
            for k, m in enumerate(_KEY_MULTIPLIERS):
                keys[k] = short * m
                if len(full):
                    keys[k, full] = np.minimum.reduceat(grams * m, gram_bounds[:-1][full])
            yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(lo, hi - lo) for c in ("doc_id", "label")), *map(tk.signed, keys)], names=["doc_id", "label", *_KEYS])


def independent(sample: DataFrame) -> DataFrame:
    """The sample with one document of each group of near copies, as copies are no further evidence for a word."""
    keys = stored(sample.mapInArrow(_copy_keys, "doc_id long, label double, k1 long, k2 long, k3 long"), "keys")
    for k in _KEYS:
        keys = keys.join(keys.groupBy("label", k).agg(F.min("doc_id").alias("doc_id")).select("doc_id"), "doc_id", "left_semi")
    return sample.join(keys.select("doc_id"), "doc_id", "left_semi")


@dataclass
class Model:
    lexicon: dict[int, np.ndarray]
    weights: np.ndarray


def train(docs: DataFrame, labels: DataFrame, limit: int = 20_000) -> Model:
    """Lexicon and weights from at most about ``limit`` labelled documents outside the held-out fold.

    The sample is the documented bound of this classifier; everything gathered on the driver (lexicon entries,
    pattern counts of sample documents) is bounded by it and by ``entries``. Without labels the lexicon is empty
    and the prior weights stand."""
    begin(docs)
    wanted = training_labels(labels, "toxic", limit)
    sample = stored(narrow(docs, "text").join(F.broadcast(wanted), "doc_id").select("doc_id", "text", "label"), "sample")
    single = stored(independent(sample), "single")
    n, toxic = single.agg(F.count(F.lit(1)), F.coalesce(F.sum((F.col("label") > 0).cast("long")), F.lit(0))).first()
    lexicon = learn_lexicon(single, n, toxic)
    rows = sample.mapInArrow(_pattern_rows(lexicon, None), "label double, x array<double>").collect()
    x = np.array([r.x for r in rows], dtype=float).reshape(len(rows), len(PATTERNS))
    weights = fit_weights(x, np.array([r.label > 0 for r in rows], dtype=float))
    return Model(lexicon, weights)


def scores(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score (0 to 1) of every row of ``docs`` (doc_id, text).

    A clause is what stands between . ! ? ; and line ends. The composed transducer reads one symbol for each word
    and writes the insults and threats it meets, each with whether a target is near, a negation governs it, or the
    clause reports speech; a document's score is the logistic of its weighted log counts of these twelve patterns.

    Edges: null, empty and insult-free texts score the intercept alone; a null id and repeated rows are scored
    like others; other columns are ignored; no rows give no rows."""
    begin(docs)
    return narrow(docs, "text").mapInArrow(_pattern_rows(model.lexicon, model.weights), "doc_id long, score double")


def predictions(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    scored = scores(docs, train(docs, labels))
    return scored.select("doc_id", F.coalesce(fold() == 0, F.lit(False)).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def reject_toxic(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """``docs`` without the documents whose score reaches ``threshold``; rows with a null id are judged by their
    text like any other."""
    begin(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for lo, hi, raw, offsets in _blocks(batch):
                x = Reader(raw, offsets).counts(model.lexicon, hi - lo)
                keep.append(model.weights[0] + np.log1p(x) @ model.weights[1:] < np.log(threshold / (1 - threshold)))
            yield batch.filter(pa.array(np.concatenate(keep) if keep else np.zeros(0, dtype=bool)))

    return docs.mapInArrow(run, docs.schema)
