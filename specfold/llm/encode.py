"""Token ids of whole texts, by the tokenizers library, in Arrow batches.

A text is cut where pre-tokenizers of the kinds used here always break: before a single space
that a printable Latin character follows, around a lone line end between such characters, and
between a Latin letter and a stop. So the ids of a text are the ids of its pieces in a row; each
distinct piece of a batch is looked up once in a bounded table that the library fills. Texts are cut only if
the tokenizer's file names parts that are known to break there; for any other they are encoded whole.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: The piece table starts anew beyond so many entries.
MOST_PIECES = 1_200_000
#: Bytes of text that are encoded at once.
CHUNK_BYTES = 4_000_000
#: As above, where the piece table serves.
ENCODE_BYTES = 8_000_000

_LETTER, _STOP, _FOLLOW, _LEAD, _PRINT = (np.zeros(256, bool) for _ in range(5))
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_STOP[[*b".,;:!?"]] = True
_LEAD[0xC3:0xCA] = True  # first bytes of the letters from U+00C0 to U+024F
_PRINT[0x21:0x7F] = True
_FOLLOW[:] = _LEAD | _PRINT


def cuts(raw: np.ndarray) -> np.ndarray:
    """Whether a piece may begin at each byte of UTF-8 text."""
    out = np.zeros(len(raw) + 1, bool)
    if len(raw) < 3:
        return out
    follow, spaced = _FOLLOW[raw], raw == 0x20
    out[1:-2] |= spaced[1:-1] & follow[2:]
    line = (raw[1:-1] == 0x0A) & _PRINT[raw[:-2]] & follow[2:]
    out[1:-2] |= line
    out[2:-1] |= line
    stop = _STOP[raw]
    out[1:-1] |= stop[1:] & _LETTER[raw[:-1]]
    two = _LEAD[raw[:-2]] & ~((raw[:-2] == 0xC3) & ((raw[1:-1] == 0x97) | (raw[1:-1] == 0xB7)))
    out[2:-1] |= stop[2:] & two
    return out


#: Parts of tokenizers, as their files name them, that break at the cuts and look at nothing beyond them (fixed values).
NORMALIZERS = (None, ["NFC", "Replace \\s+ to  ", "Lowercase"])
PRE_TOKENIZERS = (["ByteLevel True"], ["Split 's|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+ Removed", "ByteLevel False"])


def _named(part: dict | None) -> list[str] | None:
    if part is None:
        return None
    kind = part["type"]
    if kind == "Sequence":
        return [n for p in part.get("normalizers", part.get("pretokenizers", [])) for n in _named(p)]
    detail = {"Replace": lambda: f" {part['pattern'].get('Regex')} to {part['content']}", "Split": lambda: f" {part['pattern'].get('Regex')} {part['behavior']}", "ByteLevel": lambda: f" {part['use_regex'] and not part['add_prefix_space']}"}
    return [kind + (detail[kind]() if kind in detail else "")]


def can_cut(spec: dict) -> bool:
    """Whether the ids of a text are the ids of its pieces, by the normalizer and pre-tokenizer that a tokenizer's file names."""
    return spec["model"]["type"] == "BPE" and spec.get("post_processor") is None and _named(spec.get("normalizer")) in NORMALIZERS and _named(spec.get("pre_tokenizer")) in PRE_TOKENIZERS


class PieceEncoder:
    """encode(texts) gives the ids of all texts in a row, and where each text's ids end."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.cut = can_cut(json.loads(self.tokenizer.to_str()))
        self.pieces = pa.array([], pa.large_string())
        self.ids = np.zeros(1 << 16, np.int32)
        self.ends = np.zeros(1 << 14, np.int64)
        self.uses = np.zeros(1 << 14, np.int32)
        self.used = 0

    def _forget(self) -> None:
        """Keeps the half of the table that was used most."""
        n = len(self.pieces)
        keep = np.sort(np.argsort(-self.uses[:n], kind="stable")[: MOST_PIECES // 2])
        sizes = np.diff(self.ends[: n + 1])[keep]
        ends = np.cumsum(sizes)
        self.ids[: ends[-1]] = self.ids[np.arange(ends[-1]) + np.repeat(self.ends[keep] - ends + sizes, sizes)]
        self.pieces = self.pieces.take(pa.array(keep))
        self.ends[1 : len(keep) + 1] = ends
        self.uses[: len(keep)] = self.uses[keep] // 2
        self.uses[len(keep) :] = 0
        self.used = int(ends[-1])

    def _add(self, pieces: pa.Array) -> None:
        found = self.tokenizer.encode_batch_fast(pieces.to_pylist(), add_special_tokens=False)
        flat = np.array([i for e in found for i in e.ids], np.int32)
        need, first = self.used + len(flat), len(self.pieces)
        while need > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        while first + len(pieces) + 1 > len(self.ends):
            self.ends = np.concatenate([self.ends, np.zeros_like(self.ends)])
            self.uses = np.concatenate([self.uses, np.zeros_like(self.uses)])
        self.ids[self.used : need] = flat
        self.ends[first + 1 : first + 1 + len(pieces)] = self.used + np.cumsum([len(e.ids) for e in found])
        self.pieces = pa.concat_arrays([self.pieces, pieces])
        self.used = need

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """texts: no nulls. Returns ids (int32) and the ends (int64) of each text's ids."""
        if not len(texts):
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        texts = texts.cast(pa.large_string())
        if len(self.pieces) > MOST_PIECES:
            self._forget()
        bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        raw = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[bounds[0] : bounds[-1]]
        bounds = bounds - bounds[0]
        mark = cuts(raw) if self.cut else np.zeros(len(raw) + 1, bool)
        mark[bounds] = True
        at = np.flatnonzero(mark)
        pieces = pa.LargeStringArray.from_buffers(len(at) - 1, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(raw))
        coded = pieces.dictionary_encode()
        rank = pc.fill_null(pc.index_in(coded.dictionary, self.pieces), -1).to_numpy(zero_copy_only=False).copy()
        new = np.flatnonzero(rank < 0)
        if len(new):
            rank[new] = len(self.pieces) + np.arange(len(new))
            self._add(coded.dictionary.take(pa.array(new)))
        self.uses[rank] += 1
        of = rank[coded.indices.to_numpy()]
        begin, size = self.ends[of], self.ends[of + 1] - self.ends[of]
        ends = np.cumsum(size)
        place = np.arange(ends[-1] if len(ends) else 0, dtype=np.int32)
        place += np.repeat((begin - ends + size).astype(np.int32), size)
        ids = self.ids[place]
        return ids, np.concatenate([[0], ends])[np.searchsorted(at, bounds[1:])]


@lru_cache(2)
def encoder(path: str) -> PieceEncoder:
    """The process's own encoder: its piece table serves all tasks that run there."""
    return PieceEncoder(path)


def chunks(batch: pa.RecordBatch, column: str, most: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about `most` bytes in the column; a longer text is a slice of its own."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy()
    start, total = 0, 0
    for i, n in enumerate(sizes):
        if total and total + n > most:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += int(n)
    if start < len(sizes):
        yield batch.slice(start)
