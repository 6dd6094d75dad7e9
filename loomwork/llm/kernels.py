"""NumPy kernels over Arrow string batches, shared by the operators of this subpackage.

Words are hashed straight from the Arrow byte buffer: a prefix sum of
``byte * X**i`` (mod 2**64) gives the polynomial hash of any byte range in constant
time, so no Python string is made for a word. Prefix sums are taken chunk by chunk, so a
text takes about ten times its bytes, however long it is. All hashes are fixed functions
of the bytes: they do not depend on the partition, the process or the run.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

_X = 0x9E3779B97F4A7C15 | 1
_XINV = pow(_X, -1, 1 << 64)
_MIX = np.uint64(0xFF51AFD7ED558CCD)
#: Bytes hashed at once, and bytes of an Arrow batch.
_CHUNK, BATCH_BYTES = 1 << 15, 8 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: 0: white space, 1: letters, digits and every byte of a multi-byte character, 2: other.
_CLASS = np.full(256, 2, dtype=np.uint8)
_CLASS[[32, *range(9, 14)]] = 0
_CLASS[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = 1
_KINDS = {"class": _CLASS, "space": np.minimum(_CLASS, 1), "alnum": np.where(_CLASS == 1, _CLASS, 0)}

def mix(h: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values so that every bit of the result depends on all bits."""
    h = h ^ (h >> np.uint64(33))
    h = h * _MIX
    return h ^ (h >> np.uint64(29))


@cache
def _powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers of X and of its inverse, for two chunks."""
    up, down = np.full(2 * _CHUNK + 1, _X, dtype=np.uint64), np.full(2 * _CHUNK + 1, _XINV, dtype=np.uint64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def map_arrow(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str | StructType) -> DataFrame:
    """``mapInArrow`` over batches bounded in bytes too.

    Sets the session's ``spark.sql.execution.arrow.maxBytesPerBatch`` where nobody has;
    a batch has ``BATCH_BYTES`` or so then, or one longer row.
    """
    conf = df.sparkSession.conf
    if conf.get("spark.sql.execution.arrow.maxBytesPerBatch", None) is None:
        conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return df.mapInArrow(run, schema)


def pieces(batch: pa.RecordBatch, column: str, limit: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Cuts a batch into runs of rows of about ``limit`` bytes of text; one longer text stays whole."""
    col = batch.column(batch.schema.get_field_index(column))
    if len(col) == 0:
        return
    ends = offsets(col)[1:].astype(np.int64)
    at, base = 0, int(offsets(col)[0])
    while at < len(col):
        to = max(at + 1, int(np.searchsorted(ends, base + limit, "right")))
        yield batch.slice(at, to - at)
        at, base = to, int(ends[to - 1])


def offsets(col: pa.Array) -> np.ndarray:
    kind = np.int64 if pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type) else np.int32
    buffer = col.buffers()[1]
    return np.frombuffer(buffer, dtype=kind)[col.offset : col.offset + len(col) + 1]


def text_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts of an Arrow column, and where each begins (one more entry than texts)."""
    offs = offsets(col).astype(np.int64)
    raw = np.frombuffer(col.buffers()[2] or b"", dtype=np.uint8)[offs[0] : offs[-1]] if len(col) else np.zeros(0, np.uint8)
    return raw, offs - (offs[0] if len(offs) else 0)


class Words:
    """The words of every text of one Arrow column; null texts have none.

    ``hash``: a 64-bit hash for each word, all texts one after another;
    ``first``: where each text's words begin (one more entry than texts);
    ``start``/``end``: byte places in the batch's buffer, relative to its first text.
    """

    def __init__(self, col: pa.Array, lower: bool = True, split: str = "space"):
        if col.null_count:
            col = col.fill_null("")
        self.raw, self.offs = text_bytes(col)
        raw, offs, n = self.raw, self.offs, len(self.raw)
        kind = _KINDS[split][raw]
        edge = np.ones(n + 1, dtype=bool)
        if n:
            np.not_equal(kind[1:], kind[:-1], out=edge[1:n])
            edge[offs] = True
        cut = np.flatnonzero(edge)
        token = kind[cut[:-1]] > 0 if n else np.zeros(0, bool)
        self.start, self.end = cut[:-1][token], cut[1:][token]
        self.punct = kind[self.start] == 2
        self.first = np.searchsorted(self.start, offs)
        self._value = _LOWER if lower else np.arange(256, dtype=np.uint8)
        self.hash = self._range(self.start, self.end)

    def _range(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes of byte ranges; both arrays ascend."""
        out, at = np.empty(len(start), dtype=np.uint64), 0
        up, down = _powers()
        while at < len(start):
            base = start[at]
            to = max(at + 1, int(np.searchsorted(end, base + 2 * _CHUNK, "right")))
            if end[to - 1] - base > 2 * _CHUNK:
                out[at] = self._long(int(base), int(end[at]))
            else:
                value = self._value[self.raw[base : end[to - 1]]].astype(np.uint64) + np.uint64(1)
                total = np.zeros(len(value) + 1, dtype=np.uint64)
                np.cumsum(value * up[: len(value)], out=total[1:])
                a = start[at:to] - base
                out[at:to] = (total[end[at:to] - base] - total[a]) * down[a]
            at = to
        return mix(out)

    def _long(self, start: int, end: int) -> np.uint64:
        """The unmixed hash of one range longer than two chunks."""
        total, up = 0, _powers()[0]
        for at in range(start, end, _CHUNK):
            value = self._value[self.raw[at : min(end, at + _CHUNK)]].astype(np.uint64) + np.uint64(1)
            total += int((value * up[: len(value)]).sum()) * pow(_X, at - start, 1 << 64)
        return np.uint64(total & ((1 << 64) - 1))

    def prefix(self, size: int, some: slice = slice(None)) -> tuple[np.ndarray, np.ndarray]:
        """Which of some words have at least ``size`` bytes, and the hashes of their first ``size`` bytes."""
        start = self.start[some]
        long = np.flatnonzero(self.end[some] - start >= size)
        start = start[long]
        return long, self._range(start, start + size)

    @property
    def row(self) -> np.ndarray:
        """The text each word belongs to."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def shingles(h: np.ndarray, k: int) -> np.ndarray:
    """A hash for every run of ``k`` consecutive words, over text borders too."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = np.zeros(n, dtype=np.uint64)
    for j in range(k):
        out = out * np.uint64(_X) + h[j : j + n]
    return mix(out)


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """The least of every ``w`` consecutive values, by doubling."""
    out, have = x, 1
    while have < w:
        step = min(have, w - have)
        out = np.minimum(out[:-step], out[step:])
        have += step
    return out


def binary(arrays: list[np.ndarray]) -> pa.Array:
    return pa.array([a.tobytes() for a in arrays], type=pa.binary())
