"""Exact token counts at every prefix of a text, by dynamic programming over byte-pair tokens."""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadence.llm import textkit as tk
from cadence.llm.encoders import byte_alphabet, only
from cadence.llm.pretokens import PieceTable, gather, plain_texts, split
from cadence.llm.tables import begin, narrow

# Fixed value: the byte-level split of the public vocabulary.
PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
BLANKS = regex.compile(r"\s{2,}")
DOUBLE = regex.compile(r"(?<! )'(?:re|ve|ll)")


class PrefixCounter:
    """Token counts of all prefixes of pieces and texts under a byte-level BPE vocabulary file.

    For a piece, ``count[i] = count[j] + 1`` where the bytes j..i form the one token that can stand last in the
    encoding of the first i bytes: the token before it (the last of the first j bytes) and it stay apart when the
    two are encoded together. Whether a pair of tokens stays apart is remembered."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        byte = byte_alphabet()
        model = spec["model"]
        self.vocab = {bytes(byte[c] for c in t) for t in model["vocab"] if all(c in byte for c in t)}
        self.rank = {}
        for i, m in enumerate(model["merges"]):
            a, b = m.split(" ") if isinstance(m, str) else m
            self.rank[bytes(byte[c] for c in a), bytes(byte[c] for c in b)] = i
        self.made = {a + b: (a, b) for a, b in reversed(self.rank)}
        self.ends: dict[bytes, tuple[list, list]] = {}
        self.longest = max(map(len, self.vocab))
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.special_at = regex.compile("|".join(map(regex.escape, self.special))) if self.special else None
        self.apart: dict[tuple[bytes, bytes], bool] = {}
        self.alone: dict[bytes, bool] = {}
        self.table = PieceTable(lambda pieces: [self.piece(p) for p in pieces])

    def merge(self, data: bytes) -> list[bytes]:
        """The encoding of a short byte string by its merges, lowest rank first."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 1:
            best = min(range(len(parts) - 1), key=lambda i: self.rank.get((parts[i], parts[i + 1]), 1 << 30))
            if (parts[best], parts[best + 1]) not in self.rank:
                break
            parts[best : best + 2] = [parts[best] + parts[best + 1]]
        return parts

    def borders(self, token: bytes) -> tuple[list, list]:
        """What stands at a token's left and right border while it is being merged: (symbol, rank of the merge that
        swallows it), from the border byte up to the token itself."""
        found = self.ends.get(token)
        if found is None:
            if token in self.made:
                a, b = self.made[token]
                r = self.rank[a, b]
                left = [*self.borders(a)[0][:-1], (a, r), (token, 1 << 30)]
                right = [*self.borders(b)[1][:-1], (b, r), (token, 1 << 30)]
                found = left, right
            else:
                found = [(token, 1 << 30)], [(token, 1 << 30)]
            self.ends[token] = found
        return found

    def stay_apart(self, a: bytes, b: bytes) -> bool:
        """Whether encoding a + b leaves the tokens a and b: at no time does a merge across the border come before
        the next merge on either side (of equal merges the left one comes first)."""
        right, left = self.borders(a)[1], self.borders(b)[0]
        i = j = 0
        rank = self.rank.get
        while True:
            (x, tx), (y, ty) = right[i], left[j]
            r = rank((x, y), 1 << 30)
            if r < tx and r <= ty and r < 1 << 30:
                return False
            if tx == ty == 1 << 30:
                return True
            if tx <= ty:
                i += 1
            else:
                j += 1

    def piece(self, data: bytes) -> list[int]:
        """The count at each byte prefix of one piece."""
        n, vocab, longest, apart, alone = len(data), self.vocab, self.longest, self.apart, self.alone
        if len(apart) > 1_000_000:
            apart.clear()
        count, last = [0] * (n + 1), [b""] * (n + 1)
        for i in range(1, n + 1):
            for j in range(max(0, i - longest), i):
                token = data[j:i]
                if token not in vocab:
                    continue
                if j:
                    pair = (last[j], token)
                    fits = apart.get(pair)
                    if fits is None:
                        fits = apart[pair] = self.stay_apart(*pair)
                else:
                    fits = alone.get(token)
                    if fits is None:
                        fits = alone[token] = self.merge(token) == [token]
                if fits:
                    count[i], last[i] = count[j] + 1, token
                    break
        return count[1:]

    def plain(self, text: str) -> np.ndarray:
        """The count at each byte prefix of a text without special strings (index 0: the empty prefix)."""
        data = text.encode("utf-8", "surrogatepass")
        out = np.zeros(len(data) + 1, dtype=np.int64)
        starts, at, total = [], 0, 0
        for m in PIECES.finditer(text):
            counts = self.piece(m.group().encode("utf-8", "surrogatepass"))
            out[at + 1 : at + 1 + len(counts)] = total + np.array(counts)
            starts.append(at)
            at, total = at + len(counts), total + counts[-1]
        self._mend(text, data, out)
        return out

    def _mend(self, text: str, data: bytes, out: np.ndarray) -> None:
        """Prefixes that end inside a run of blanks, or between the letters of a contraction, split differently
        from the whole text: a run cut short is one piece, and the apostrophe and the letter are two."""
        at = np.cumsum([0, *(len(c.encode("utf-8", "surrogatepass")) for c in text)]) if not text.isascii() else range(len(text) + 1)
        for m in BLANKS.finditer(text):
            a, b = at[m.start()], at[m.end()]
            out[a + 1 : b + 1] = out[a] + np.array(self.piece(data[a:b]))
        for m in DOUBLE.finditer(text):
            a = at[m.start()]
            if out[a + 3] != out[a] + 1 or m.start() and PIECES.fullmatch(text[m.start() - 1 : m.start() + 1]):
                continue
            out[a + 2] = out[a] + 2

    def prefixes(self, text: str) -> np.ndarray:
        """The count at each byte prefix of any text; special strings count as one token each."""
        if not self.special_at or not self.special_at.search(text):
            return self.plain(text)
        parts, total, at = [np.zeros(1, dtype=np.int64)], 0, 0
        for m in [*self.special_at.finditer(text), None]:
            before = self.plain(text[at : m.start() if m else len(text)])
            parts.append(total + before[1:])
            if m:
                for n in range(1, len(m.group())):
                    parts.append(np.array([total + self.plain(text[at : m.start() + n])[-1]] * len(m.group()[n - 1].encode())))
                total += before[-1] + 1
                parts.append(np.array([total]))
                at = m.end()
        return np.concatenate(parts)

    def totals(self, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """The count of each text of a buffer: the last entry of its prefix counts, piece by piece."""
        plain = plain_texts(raw, offsets)
        kept, kept_at = only(raw, offsets, plain)
        starts, ends, bounds = split(kept, kept_at, "byte")
        out = np.zeros(len(offsets) - 1, dtype=np.int64)
        if len(starts):
            flat, at, length = self.table.look_up(kept, starts, ends)
            total = np.concatenate([[0], np.cumsum(flat[at + length - 1], dtype=np.int64)])
            out[plain] = total[bounds[1:]] - total[bounds[:-1]]
        for i in np.flatnonzero(~plain):
            text = raw[offsets[i] : offsets[i + 1]].tobytes().decode("utf-8", "surrogatepass")
            out[i] = self._total(text)
        return out

    def _total(self, text: str) -> int:
        n, at = 0, 0
        for m in [*(self.special_at.finditer(text) if self.special_at else ()), None]:
            pieces = [p.encode("utf-8", "surrogatepass") for p in PIECES.findall(text[at : m.start() if m else len(text)])]
            if pieces:
                raw = np.frombuffer(b"".join(pieces), np.uint8)
                ends = np.cumsum([len(p) for p in pieces])
                flat, where, length = self.table.look_up(raw, ends - np.diff(ends, prepend=0), ends)
                n += int(flat[where + length - 1].sum())
            if m:
                n, at = n + 1, m.end()
        return n

    def rows(self, raw: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
        """The prefix counts of each text of a buffer."""
        plain = plain_texts(raw, offsets)
        starts, ends, bounds = split(raw, offsets, "byte")
        flat, at, length = self.table.look_up(raw, starts, ends) if len(starts) else (np.zeros(0, np.uint32), starts, ends)
        counts, _ = gather(flat, at, length)
        total = np.concatenate([[0], np.cumsum(flat[at + length - 1], dtype=np.int64)]) if len(starts) else np.zeros(1, np.int64)
        every = counts.astype(np.int64) + np.repeat(total[:-1], length)
        out = []
        for i in range(len(offsets) - 1):
            text = raw[offsets[i] : offsets[i + 1]].tobytes()
            if plain[i]:
                row = np.concatenate([[0], every[offsets[i] : offsets[i + 1]] - total[bounds[i]]])
                self._mend(text.decode(), text, row)
            else:
                row = self.prefixes(text.decode("utf-8", "surrogatepass"))
            out.append(row)
        return out


_counters: dict[str, PrefixCounter] = {}


def counter(path: str) -> PrefixCounter:
    """The counter of a vocabulary file, made once in each Python worker."""
    if path not in _counters:
        _counters[path] = PrefixCounter(path)
    return _counters[path]


def token_counts(docs: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id, n_bytes, n_tokens of every row: the last entry of the text's prefix counts.

    ``vocabulary`` is a byte-level BPE file, present at that path on every executor. Pieces met lately are
    remembered (at most about 500,000 a worker), so their dynamic programme runs once. A null text is empty (0, 0); a null id and repeated rows
    stay as they are; other columns are ignored; no rows give no rows."""
    begin(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = counter(vocabulary)
        for batch in batches:
            raw, offsets = tk.utf8(batch.column(1))
            n = [c.totals(raw[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]) for lo, hi in tk.blocks(offsets)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.diff(offsets)), pa.array(np.concatenate(n) if n else np.zeros(0, np.int64))], names=["doc_id", "n_bytes", "n_tokens"])

    return narrow(docs, "text").mapInArrow(run, "doc_id long, n_bytes long, n_tokens long")


def prefix_counts(docs: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id, n_bytes, n_tokens and ``steps``: one signed byte for each byte of the text, the change of the token
    count from one prefix to the next (counts fall where a longer prefix merges better). ``count_at`` and
    ``longest_within`` answer questions from it without encoding again. Edges as in ``token_counts``; a change
    beyond a signed byte raises an error."""
    begin(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = counter(vocabulary)
        for batch in batches:
            raw, offsets = tk.utf8(batch.column(1))
            for lo, hi in tk.blocks(offsets):
                rows = c.rows(raw[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
                steps = [np.diff(r) for r in rows]
                if any(len(s) and np.abs(s).max() > 127 for s in steps):
                    raise ValueError("a prefix changes the token count by more than 127")
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array(np.diff(offsets[lo : hi + 1])), pa.array([int(r[-1]) for r in rows], pa.int64()), pa.array([s.astype(np.int8).tobytes() for s in steps], pa.binary())],
                    names=["doc_id", "n_bytes", "n_tokens", "steps"],
                )

    return narrow(docs, "text").mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, steps binary")


def count_at(steps: bytes, n_bytes: int) -> int:
    """Tokens of the prefix of ``n_bytes`` bytes (a character boundary)."""
    return int(np.frombuffer(steps, np.int8)[:n_bytes].sum(dtype=np.int64))


def longest_within(steps: bytes, budget: int) -> int:
    """Bytes of the longest prefix with at most ``budget`` tokens (cut back to a character boundary by the caller)."""
    fits = np.flatnonzero(np.concatenate([[0], np.cumsum(np.frombuffer(steps, np.int8), dtype=np.int64)]) <= budget)
    return int(fits[-1])


def over_limit(counts: DataFrame, limit: int) -> DataFrame:
    """``counts`` with over_limit: more than ``limit`` tokens."""
    return counts.withColumn("over_limit", F.col("n_tokens") > limit)
