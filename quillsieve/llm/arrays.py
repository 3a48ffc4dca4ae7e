"""Arrow and numpy helpers that the corpus operators share."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bytes of text that one numpy step handles; a longer text is one step by itself.
STEP_BYTES = 4 << 20

_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def bound_batches(spark: SparkSession) -> None:
    """Arrow batches of STEP_BYTES, if the session leaves their size at Spark's default; so a
    batch of whole texts is no larger in the JVM than a step is here."""
    key, default = "spark.sql.execution.arrow.maxBytesPerBatch", ("67108864b", "64m", "64MB")
    if spark.conf.get(key) in default:
        spark.conf.set(key, str(STEP_BYTES))


def quoted(name: str):
    """A column by its literal name."""
    return F.col("`" + name.replace("`", "``") + "`")


def add_columns(df: DataFrame, source, make: Callable[[pa.Array], list[pa.Array]], fields: list[T.StructField]) -> DataFrame:
    """df with columns that ``make`` computes from ``source``, slice by slice.

    ``make`` gets an array of at most STEP_BYTES (or one value) and returns an array for each
    of ``fields``. A column of df with the name of a new one is replaced.
    """
    bound_batches(df.sparkSession)
    new = {f.name.lower() for f in fields}
    keep = [f for f in df.schema.fields if f.name.lower() not in new]
    plain = df.select(*[quoted(f.name).alias(f"c{i}") for i, f in enumerate(keep)], source.alias("source"))
    out = T.StructType([T.StructField(f"c{i}", f.dataType) for i, f in enumerate(keep)] + [T.StructField(f"n{i}", f.dataType) for i, f in enumerate(fields)])
    n = len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in steps(batch, n):
                made = make(part.column(n))
                yield pa.RecordBatch.from_arrays([*part.columns[:n], *made], [f.name for f in out.fields])

    made = plain.mapInArrow(run, out)
    return made.select(*[F.col(f"c{i}").alias(f.name) for i, f in enumerate(keep)], *[F.col(f"n{i}").alias(f.name) for i, f in enumerate(fields)])


def steps(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about STEP_BYTES in the given column each."""
    if batch.num_rows == 0:
        return
    sizes = np.diff(bounds(batch.column(column))[0])
    group = np.cumsum(sizes) // STEP_BYTES
    cuts = np.flatnonzero(np.diff(group)) + 1
    lo = 0
    for hi in [*cuts.tolist(), batch.num_rows]:
        if hi > lo:
            yield batch.slice(lo, hi - lo)
        lo = hi
    release()


def release() -> None:
    """Give freed memory back to the system: a worker outlives its tasks."""
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)


def bounds(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets (from 0) and bytes of a string or binary array; a null is empty."""
    if arr.null_count:
        arr = arr.fill_null(b"" if pa.types.is_binary(arr.type) or pa.types.is_large_binary(arr.type) else "")
    wide = pa.types.is_large_string(arr.type) or pa.types.is_large_binary(arr.type)
    _, offs, data = arr.buffers()
    if len(arr) == 0 or offs is None:
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    off = np.frombuffer(offs, np.int64 if wide else np.int32)[arr.offset : arr.offset + len(arr) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[off[0] : off[-1]] if data is not None else np.zeros(0, np.uint8)
    return off - off[0], raw


def binary(off: np.ndarray, data: np.ndarray) -> pa.Array:
    """A binary array from offsets and bytes."""
    if off[-1] < 2**31:
        return pa.Array.from_buffers(pa.binary(), len(off) - 1, [None, pa.py_buffer(off.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))])
    return pa.Array.from_buffers(pa.large_binary(), len(off) - 1, [None, pa.py_buffer(off.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))])


def pieces(arr: pa.Array) -> list[bytes]:
    """The values of a binary array; cut from one string, which is quicker than ``to_pylist``."""
    off, data = bounds(arr)
    data, at = data.tobytes(), off.tolist()
    return [data[a:b] for a, b in zip(at, at[1:])]


def remember(known: dict, words: list[bytes], limit: int, make: Callable[[list[bytes]], list]) -> None:
    """Put ``make``'s results for new words into ``known``. When it is full, the words that came
    again stay and the others go, so it holds at most ``limit`` and one slice's words."""
    fresh = [w for w in words if w not in known]
    if len(known) + len(fresh) > limit:
        again = {w: known[w] for w in words if w in known}
        known.clear()
        known.update(again)
    if fresh:
        known.update(zip(fresh, make(fresh)))


class Words:
    """The words ``[^\\x20\\x09-\\x0D]+`` of some texts.

    off: the first word of each text, and the end; array: all words, in order (binary).
    """

    def __init__(self, arr: pa.Array, lower: bool = False):
        off, data = bounds(arr)
        if lower:
            data = _LOWER[data]
        space = _SPACE[data]
        word = ~space
        start, end = word.copy(), word.copy()
        start[1:] &= space[:-1]
        end[:-1] &= space[1:]
        some = off[:-1][off[:-1] < off[1:]]
        start[some] = word[some]
        last = off[1:][off[:-1] < off[1:]] - 1
        end[last] = word[last]
        starts = np.flatnonzero(start)
        lens = np.flatnonzero(end) + 1 - starts
        self.off = np.searchsorted(starts, off)
        self.ends = np.concatenate([[0], np.cumsum(lens)])
        self.data = data[word]

    def __len__(self) -> int:
        return len(self.ends) - 1

    @property
    def array(self) -> pa.Array:
        return binary(self.ends, self.data)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.off)

    def coded(self) -> tuple[np.ndarray, pa.Array]:
        """The number of each word in an array of the distinct words, and that array."""
        if not len(self):
            return np.zeros(0, np.int64), pa.array([], pa.binary())
        coded = self.array.dictionary_encode()
        return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary

    def codes(self) -> tuple[np.ndarray, list[bytes]]:
        """The number of each word in a list of the distinct words, and that list."""
        codes, distinct = self.coded()
        return codes, pieces(distinct)


def ragged(starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """The indices starts[0] .. starts[0] + lens[0] - 1, starts[1] .. and so on."""
    total = int(lens.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lens)
    return np.repeat(starts - (ends - lens), lens) + np.arange(total)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words whose output bits depend on all input bits."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))
