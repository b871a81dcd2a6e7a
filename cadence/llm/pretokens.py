"""Splitting texts into the pieces that byte-pair encoders treat separately, on whole Arrow buffers.

Two splits are covered: ``byte`` (a space belongs to what follows it, every byte is covered) and ``word`` (lower
case, white space dropped). The vectorized pass holds for texts of printable ASCII, ASCII white space and the
letters U+00C0-U+00FF; ``plain_texts`` says which texts those are, and callers use the library for the others."""

from __future__ import annotations

import numpy as np

from cadence.llm import textkit as tk

REMEMBERED = 500_000  # pieces whose sequences a worker keeps
LETTER, DIGIT, OTHER, BLANK = 1, 2, 3, 0
_CLASS = np.full(256, OTHER, dtype=np.uint8)
_CLASS[[32, *range(9, 14)]] = BLANK
_CLASS[48:58] = DIGIT
_CLASS[65:91] = _CLASS[97:123] = LETTER
_CLASS[128:] = LETTER
_ODD = np.zeros(256, dtype=bool)
_ODD[:9] = _ODD[14:32] = _ODD[127] = True
_ODD[192:] = True
_ODD[0xC3] = False


def _earlier(a: np.ndarray, fill) -> np.ndarray:
    out = np.empty_like(a)
    out[:1] = fill
    out[1:] = a[:-1]
    return out


def _later(a: np.ndarray, fill) -> np.ndarray:
    out = np.empty_like(a)
    out[-1:] = fill
    out[:-1] = a[1:]
    return out


def plain_texts(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """For each text, whether the vectorized pass holds for it. Texts with ``<|`` may hold special strings and the
    signs U+00D7 and U+00F7 are no letters, so both are left to the library."""
    odd = _ODD[raw]
    if len(raw):
        before = _earlier(raw, 0)
        odd |= (before == 0xC3) & ((raw == 0x97) | (raw == 0xB7))
        odd |= (before == ord("<")) & (raw == ord("|"))
    total = np.concatenate([[0], np.cumsum(odd)])
    return total[offsets[1:]] == total[offsets[:-1]]


def lower_case(raw: np.ndarray) -> np.ndarray:
    """Lower case of plain texts, byte for byte."""
    out = raw.copy()
    out[(raw >= 65) & (raw <= 90)] += 32
    if len(raw):
        out[(_earlier(raw, 0) == 0xC3) & (raw >= 0x80) & (raw <= 0x9E)] += 32
    return out


def split(raw: np.ndarray, offsets: np.ndarray, kind: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and per-text bounds of the pieces (kind ``byte`` or ``word``; texts already lower-cased for
    ``word``)."""
    n = len(raw)
    if not n:
        empty = np.zeros(0, dtype=np.int64)
        return empty, empty, np.zeros(len(offsets), dtype=np.int64)
    cls = _CLASS[raw]
    head = np.zeros(n + 1, dtype=bool)
    head[offsets] = True
    first, last = head[:-1], head[1:]
    blank = cls == BLANK
    start = ~blank & ((cls != _earlier(cls, 255)) | first)
    if kind == "word":
        start |= cls == DIGIT
    joined = (_earlier(raw, 0) == 32) & ~first if kind == "byte" else np.zeros(n, dtype=bool)
    # 's 't 'm 'd 're 've 'll: an apostrophe that begins a piece and is followed at once by those letters.
    mark = np.flatnonzero(start & (raw == 39) & ~joined & ~last)
    mark = mark[cls[mark + 1] == LETTER]
    if len(mark):
        one = np.isin(raw[mark + 1], np.frombuffer(b"stmd", np.uint8))
        inside = ~last[mark + 1]
        nxt = raw[np.minimum(mark + 2, n - 1)]
        r1 = raw[mark + 1]
        two = inside & (((nxt == ord("e")) & ((r1 == ord("r")) | (r1 == ord("v")))) | ((nxt == ord("l")) & (r1 == ord("l"))))
        took = np.where(one, 1, np.where(two, 2, 0))
        mark, took = mark[took > 0], took[took > 0]
        start[mark + 1] = False
        after = mark + 1 + took
        ok = (after < n) & ~first[np.minimum(after, n - 1)]
        after = after[ok]
        start[after[cls[after] == LETTER]] = True
    if kind == "word":
        stops = np.flatnonzero(start | first | (blank & ~_earlier(blank, True)))
        starts = np.flatnonzero(start)
    else:
        moved = np.flatnonzero(start & joined)
        start[moved] = False
        start[moved - 1] = True
        start |= blank & (~_earlier(blank, False) | first)
        start |= blank & ~_later(blank, True) & ~last
        starts = stops = np.flatnonzero(start)
    ends = np.append(stops, n)[np.searchsorted(stops, starts) + 1]
    return starts, ends, np.searchsorted(starts, offsets)


class PieceTable:
    """What each distinct piece is worth (a short integer sequence), remembered by the piece's hash up to a bound.

    ``work`` maps a list of byte strings to their sequences; only pieces not seen lately reach it. Hashes, places and
    lengths are sorted numpy arrays (about 20 bytes a piece beside its sequence); beyond ``limit`` pieces or
    ``limit_values`` numbers the older half is forgotten, and worked out again if it comes back."""

    def __init__(self, work, limit: int = REMEMBERED, limit_values: int = 6 * REMEMBERED):
        self.work, self.limit, self.limit_values = work, limit, limit_values
        self.worked = 0
        self._clear()

    def _clear(self) -> None:
        self.keys = np.zeros(0, dtype=np.uint64)
        self.at = np.zeros(0, dtype=np.int64)
        self.length = np.zeros(0, dtype=np.int64)
        self.flat = np.zeros(1 << 16, dtype=np.uint32)
        self.used = 0

    def _forget_older_half(self) -> None:
        if not len(self.at):
            return
        cut = int(np.partition(self.at, len(self.at) // 2)[len(self.at) // 2])
        keep = self.at >= cut
        if keep.all():
            self._clear()
            return
        self.keys, self.at, self.length = self.keys[keep], self.at[keep] - cut, self.length[keep]
        self.flat = self.flat[cut : self.used].copy()
        self.used -= cut

    def _add(self, hashes: np.ndarray, seqs: list) -> None:
        length = np.fromiter(map(len, seqs), dtype=np.int64, count=len(seqs))
        need = int(length.sum())
        if self.used + need > len(self.flat):
            self.flat = np.concatenate([self.flat[: self.used], np.zeros(max(need, self.used), dtype=np.uint32)])
        at = self.used + np.cumsum(length) - length
        for a, n, seq in zip(at.tolist(), length.tolist(), seqs, strict=True):
            self.flat[a : a + n] = seq
        self.used += need
        keys = np.concatenate([self.keys, hashes])
        order = np.argsort(keys, kind="stable")
        self.keys, self.at, self.length = keys[order], np.concatenate([self.at, at])[order], np.concatenate([self.length, length])[order]

    def _known(self, keys: np.ndarray) -> np.ndarray:
        place = np.searchsorted(self.keys, keys)
        inside = place < len(self.keys)
        inside[inside] = self.keys[place[inside]] == keys[inside]
        return inside

    def look_up(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(flat, at, length): piece i has the sequence flat[at[i] : at[i] + length[i]]."""
        hashes = tk.hash_spans(raw, starts, ends)
        distinct, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        new = np.flatnonzero(~self._known(distinct))
        if len(self.keys) and (len(self.keys) + len(new) > self.limit or self.used > self.limit_values):
            self._forget_older_half()
            new = np.flatnonzero(~self._known(distinct))
        if len(new):
            data = raw.tobytes()
            seqs: list = []
            for lo in range(0, len(new), 4096):
                part = first[new[lo : lo + 4096]]
                seqs += self.work([data[a:b] for a, b in zip(starts[part].tolist(), ends[part].tolist(), strict=True)])
            self.worked += len(new)
            self._add(distinct[new], seqs)
        place = np.searchsorted(self.keys, distinct)
        return self.flat, self.at[place][inverse], self.length[place][inverse]


def gather(flat: np.ndarray, at: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sequences one after another, and the bounds of each among them."""
    bounds = np.concatenate([[0], np.cumsum(length)])
    index = np.arange(bounds[-1]) + np.repeat(at - bounds[:-1], length)
    return flat[index], bounds
