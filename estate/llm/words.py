"""Words, shingles and batches of text: shared by the operators of this package.

A word is ``[^\\x20\\x09-\\x0D]+``.  Everything here works on the byte buffers of Arrow string
arrays, a few megabytes of text at a time, so a task holds neither a partition nor a copy of
its texts as Python objects.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: bytes of text that are worked on at once; arrays of 8 bytes a byte are made of it, several at a time
SLICE_BYTES = 1 << 20

WORD = r"[^\x20\x09-\x0D]+"

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True

_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
#: odd, so that it can be inverted modulo 2**64
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTES = np.random.default_rng(20240501).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers: dict[int, np.ndarray] = {}
_model: dict[tuple, object] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer of splitmix64: a bijection that spreads all bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * _MIX[0]
    x ^= x >> np.uint64(27)
    x = x * _MIX[1]
    x ^= x >> np.uint64(31)
    return x


def _power(base: int, n: int) -> np.ndarray:
    """``base**0 .. base**(n-1)`` modulo 2**64; kept for slices, which are of one size, and made anew for a longer text."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, SLICE_BYTES + 2), np.uint64(base))
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        if len(have) == SLICE_BYTES + 2:
            _powers[base] = have
    return have[:n]


def worker_model(build: Callable, *key):
    """``build(*key)``, kept while tasks of one operator follow each other.

    A worker process is used again by later stages: it holds one model, not those of all stages before.
    """
    name = (build, *key)
    if name not in _model:
        _model.clear()
        _model[name] = build(*key)
    return _model[name]


def drop_model() -> None:
    """For tasks that need none: what another operator has left in the worker goes before they start."""
    _model.clear()


def span_hashes(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit fingerprints of ``values[start:end]``: a polynomial modulo 2**64, then mixed with the length."""
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * _power(_BASE, len(values)), out=total[1:])
    raw = (total[end] - total[start]) * _power(_INVERSE, len(values) + 1)[start]
    return mix(raw + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def text_slices(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about ``limit`` bytes of text, of at least one row."""
    offsets = string_buffers(batch.column(column))[0]
    at = 0
    while at < batch.num_rows:
        end = int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1
        end = min(max(end, at + 1), batch.num_rows)
        yield batch.slice(at, end - at)
        at = end


def string_buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets, from 0, and bytes of a string array; nulls are empty."""
    if texts.null_count:
        texts = texts.fill_null("")
    if pa.types.is_null(texts.type):
        texts = pa.array([""] * len(texts), pa.string())
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    if not len(texts):
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return offsets - offsets[0], data[offsets[0] : offsets[-1]]


class Words:
    """The words of a string array, as offsets into the bytes that are no white space.

    ``first[i]`` is the number of words before text ``i``; word ``j`` is
    ``data[offsets[j]:offsets[j + 1]]``.
    """

    def __init__(self, texts: pa.Array, space: np.ndarray = SPACE):
        bounds, raw = string_buffers(texts)
        inside = ~space[raw]
        start, end = inside.copy(), inside.copy()
        start[1:] &= ~inside[:-1]
        end[:-1] &= ~inside[1:]
        edges = bounds[(bounds > 0) & (bounds < len(raw))]
        start[edges], end[edges - 1] = inside[edges], inside[edges - 1]
        self.bounds, self.raw = bounds, raw
        #: places of the words in ``raw``
        self.start, self.end = np.flatnonzero(start), np.flatnonzero(end) + 1
        self.first = np.searchsorted(self.start, bounds)
        self.data = raw[inside]
        self.offsets = np.zeros(len(self.start) + 1, np.int64)
        np.cumsum(self.end - self.start, out=self.offsets[1:])

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def array(self) -> pa.Array:
        """The words as an Arrow string array that shares ``data``."""
        return pa.Array.from_buffers(
            pa.large_string(), len(self), [None, pa.py_buffer(self.offsets), pa.py_buffer(np.ascontiguousarray(self.data))]
        )

    def hashes(self, lower: bool = False) -> np.ndarray:
        """A 64-bit fingerprint per word; ``lower`` folds A-Z only."""
        data = self.data
        if lower:
            data = np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)
        return span_hashes(_BYTES[data], self.offsets[:-1], self.offsets[1:])


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices ``starts[i] .. starts[i] + lengths[i] - 1`` for all ``i``, one after the other."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths)


class Memo:
    """Number lists by 64-bit fingerprint, in flat arrays; forgets all when they pass ``limit`` entries.

    Keys are sorted runs, each at least four times as long as the next, so adding a few does not copy them all.
    It spares work only: what it forgets is computed again.
    """

    def __init__(self, dtype: type, limit: int = 8 << 20):
        self.dtype, self.limit = dtype, limit
        self.clear()

    def clear(self) -> None:
        self.runs: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.values, self.used = np.empty(1 << 16, self.dtype), 0

    def missing(self, keys: np.ndarray) -> np.ndarray:
        """Which of the keys it doesn't hold."""
        out = np.ones(len(keys), bool)
        for known, _, _ in self.runs:
            out &= known[np.minimum(np.searchsorted(known, keys), len(known) - 1)] != keys
        return out

    def add(self, keys: np.ndarray, lengths: np.ndarray, values: np.ndarray) -> None:
        """Lists of keys that it doesn't hold."""
        if not len(keys):
            return
        end = self.used + len(values)
        if end > len(self.values):
            grown = np.empty(max(end, len(self.values) * 2), self.dtype)
            grown[: self.used] = self.values[: self.used]
            self.values = grown
        self.values[self.used : end] = values
        starts = (self.used + np.cumsum(lengths) - lengths).astype(np.int32)
        self.used = end
        order = np.argsort(keys, kind="stable")
        self.runs.append((keys[order], starts[order], lengths[order].astype(np.int32)))
        while len(self.runs) > 1 and len(self.runs[-2][0]) < 4 * len(self.runs[-1][0]):
            last, before = self.runs.pop(), self.runs.pop()
            keys = np.concatenate([before[0], last[0]])
            order = np.argsort(keys, kind="stable")
            self.runs.append((keys[order], *(np.concatenate([before[k], last[k]])[order] for k in (1, 2))))

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where in ``values`` their lists start and how long they are; it must hold all keys."""
        starts, lengths = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
        for known, first, size in self.runs:
            at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
            here = np.flatnonzero(known[at] == keys)
            starts[here], lengths[here] = first[at[here]], size[at[here]]
        return starts, lengths

    def full(self) -> bool:
        return self.used > self.limit


def word_count(text: Column) -> Column:
    """Number of words, without Python; null counts as empty."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have."""
    have = {c.lower() for c in df.columns}
    while name.lower() in have:
        name += "_"
    return name


def partitions(df: DataFrame) -> int:
    """The number of shuffle partitions, which the user sizes with the data."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
