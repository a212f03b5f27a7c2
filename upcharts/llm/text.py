"""Word and shingle hashes of many texts at once, computed inside Arrow tasks.

The texts of an Arrow batch lie in one buffer; everything here works on slices of
that buffer, so no Python object is made per word. A word is a run of bytes other
than space and 09-0D. Hashes are 64 bits wide and depend on content alone.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

SLICE_BYTES = 1 << 20
NULL_ID = -(1 << 63)

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_STEP = 0x9E3779B97F4A7C15
_U = np.uint64


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit (xor, shift, multiply)."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _U(0xD6E8FEB86659FD93))
_POWER = _powers(_STEP, SLICE_BYTES + 1)
_INVERSE = _powers(pow(_STEP, -1, 1 << 64), SLICE_BYTES + 1)


@dataclass
class Words:
    """Words of a run of texts: hashes, byte ranges, and where each text's words begin."""

    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray  # text i owns words bounds[i]:bounds[i+1]

    def room(self, words: int) -> np.ndarray:
        """Whether a run of ``words`` words starts at each word and stays in its text."""
        last = np.repeat(self.bounds[1:], np.diff(self.bounds))
        return np.arange(len(self.hashes)) + words <= last


def words_of(data: np.ndarray, offsets: np.ndarray, lower: bool = False) -> Words:
    """Words of the texts ``data[offsets[i]:offsets[i+1]]``."""
    base, end = int(offsets[0]), int(offsets[-1])
    data = data[base:end]
    offsets = offsets - base
    solid = ~_SPACE[data]
    first, last = solid.copy(), solid.copy()
    cut = np.zeros(len(data) + 1, bool)
    cut[offsets] = True
    first[1:] &= ~solid[:-1] | cut[1:-1]
    last[:-1] &= ~solid[1:] | cut[1:-1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    hashes = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        # whole words up to the slice size; a longer word is hashed on its own
        origin = starts[at]
        stop = max(at + 1, int(np.searchsorted(ends, origin + SLICE_BYTES, "right")))
        hashes[at:stop] = _hash_ranges(data, starts[at:stop], ends[at:stop], lower)
        at = stop
    return Words(hashes, starts, ends, np.searchsorted(starts, offsets))


def _hash_ranges(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool) -> np.ndarray:
    origin, stop = int(starts[0]), int(ends[-1])
    if stop - origin > SLICE_BYTES:
        # one very long word: chain the hashes of its slices
        value = np.zeros(1, np.uint64)
        for at in range(origin, stop, SLICE_BYTES):
            to = min(stop, at + SLICE_BYTES)
            part = _hash_ranges(data, np.array([at]), np.array([to]), lower)
            value = mix(value * _U(_STEP) + part)
        return value
    part = data[origin:stop]
    if lower:
        part = _LOWER[part]
    total = np.zeros(len(part) + 1, np.uint64)
    np.cumsum(_BYTE[part] * _POWER[: len(part)], out=total[1:], dtype=np.uint64)
    low, high = starts - origin, ends - origin
    return mix((total[high] - total[low]) * _INVERSE[low] + (high - low).astype(np.uint64))


def run_hashes(hashes: np.ndarray, words: int, seed: int = 1) -> np.ndarray:
    """Hash of every run of ``words`` consecutive words, by doubling.

    Entry i covers words i to i+words-1; there are len-words+1 entries (none if shorter).
    """
    if len(hashes) < words:
        return np.empty(0, np.uint64)
    odd = _U(_STEP + 2 * seed)
    span, level = 1, mix(hashes + _U(seed))
    done, out = 0, None
    while True:
        if words & span:
            if out is None:
                out = level
            else:
                n = len(hashes) - done - span + 1
                out = mix(out[:n] * odd + level[done : done + n])
            done += span
        if done == words:
            return out[: len(hashes) - words + 1]
        level = mix(level[:-span] * odd + level[span:])
        span *= 2


def text_slices(column: pa.Array, budget: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of rows of about ``budget`` bytes.

    Null texts are empty. A single longer text is a run of its own.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, values = column.buffers()
    kind = np.int64 if wide else np.int32
    offsets = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(values, np.uint8) if values is not None else np.empty(0, np.uint8)
    row = 0
    while row < len(column):
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + budget, "right")) - 1)
        end = min(end, len(column))
        yield row, end, data, offsets[row : end + 1]
        row = end


def signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def row_key(doc_id: str | Column = "doc_id", text: str | Column = "text") -> list[Column]:
    """(id, check): tells rows apart even where a doc_id is null or occurs twice.

    Rows that agree in both have the same id and text, so they get the same answer.
    """
    doc_id = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    text = F.col(text) if isinstance(text, str) else text
    return [
        F.coalesce(doc_id, F.lit(NULL_ID)).alias("_id"),
        F.xxhash64(F.coalesce(text, F.lit("")), doc_id.isNull()).alias("_check"),
    ]
