"""Token ids of whole texts under a public vocabulary file: distinct pieces are encoded once by the tokenizers library."""

from __future__ import annotations

import json

import numpy as np
import tiktoken
from tokenizers import Tokenizer

from cadence.llm.pretokens import REMEMBERED, PieceTable, gather, lower_case, plain_texts, split


def only(raw: np.ndarray, offsets: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The buffer and offsets of the chosen texts."""
    if chosen.all():
        return raw, offsets
    size = np.diff(offsets)
    return raw[np.repeat(chosen, size)], np.concatenate([[0], np.cumsum(size[chosen])])


def byte_alphabet() -> dict[str, int]:
    """The printable stand-in of each byte in byte-level vocabularies (its published rule)."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def merger(path: str):
    """The ids of one piece under a byte-level vocabulary file, from its text; None where the file does not suit.

    tiktoken merges the pair whose token has the least id, the tokenizers library the pair whose merge comes first;
    the two agree if every byte is a token and the merges of the file make tokens of rising ids, which is checked."""
    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    byte, vocab = byte_alphabet(), model["vocab"]
    made = [vocab.get("".join(m.split(" ") if isinstance(m, str) else m), -1) for m in model["merges"]]
    rising = all(a < b for a, b in zip([-1, *made], made, strict=False))
    if not rising or not all(c in vocab for c in byte) or not all(c in byte for t in vocab for c in t) or len(made) + 256 != len(vocab):
        return None
    ranks = {bytes(byte[c] for c in t): i for t, i in vocab.items()}
    return tiktoken.Encoding("pieces", pat_str=r"(?s).+", mergeable_ranks=ranks, special_tokens={}).encode_ordinary


class TextEncoder:
    """Ids of texts; ``kind`` is the vocabulary's split: ``byte`` (byte level) or ``word`` (lower case, word ends).

    Plain texts are split here and each distinct piece is encoded once, by the library or, for byte-level files that
    ``merger`` takes, by tiktoken with the same merges; other texts go to the library whole. Special strings inside
    texts are read as the library's default reads them."""

    def __init__(self, path: str, kind: str, remembered: int = REMEMBERED):
        self.library = Tokenizer.from_file(path)
        self.library.no_padding()
        self.library.no_truncation()
        self.kind = kind
        self.merge = merger(path) if kind == "byte" else None
        self.table = PieceTable(self._encode, remembered, 6 * remembered)

    def _encode(self, pieces: list[bytes]) -> list[list[int]]:
        if self.merge:
            return [self.merge(p.decode()) for p in pieces]
        return [e.ids for e in self.library.encode_batch_fast([p.decode() for p in pieces], add_special_tokens=False)]

    def ids(self, raw: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
        """The ids of each text of a buffer."""
        plain = plain_texts(raw, offsets)
        low, at = only(raw, offsets, plain)
        if self.kind == "word":
            low = lower_case(low)
        starts, ends, bounds = split(low, at, self.kind)
        if len(starts):
            flat, places = gather(*self.table.look_up(low, starts, ends))
        else:
            flat, places = np.zeros(0, np.uint32), np.zeros(1, np.int64)
        cuts = places[bounds]
        out, k = [], 0
        for i in range(len(offsets) - 1):
            if plain[i]:
                out.append(flat[cuts[k] : cuts[k + 1]])
                k += 1
            else:
                text = raw[offsets[i] : offsets[i + 1]].tobytes().decode("utf-8", "surrogatepass")
                out.append(np.array(self.library.encode(text, add_special_tokens=False).ids, dtype=np.uint32))
        return out


_encoders: dict[tuple[str, str, int], TextEncoder] = {}


def encoder(path: str, kind: str, remembered: int = REMEMBERED) -> TextEncoder:
    """The encoder of a vocabulary file that remembers so many pieces, made once in each Python worker."""
    if (path, kind, remembered) not in _encoders:
        _encoders[path, kind, remembered] = TextEncoder(path, kind, remembered)
    return _encoders[path, kind, remembered]
