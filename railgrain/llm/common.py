"""What the operators of this package share: reading, written intermediates, and byte kernels for Arrow batches."""

from __future__ import annotations

import ctypes
import sys
import types
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

#: ASCII white space, the separators of words: space and \t \n \v \f \r.
SPACE = "[\\x20\\x09-\\x0D]"
WORD = "[^\\x20\\x09-\\x0D]+"

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def save(df: DataFrame, path: str, by: tuple[str, ...] = (), rows: int | None = None, **options: str) -> None:
    """Write ``df`` once as parquet, in folders by ``by``; its shuffle files go as soon as it is written.

    Functions on Arrow batches get at most ``rows`` rows at once, if given.
    """
    spark = df.sparkSession
    held = {_CLEANUP: "true"} | ({_BATCH: str(rows)} if rows else {})
    before = {k: spark.conf.get(k) for k in held}
    for k, v in held.items():
        spark.conf.set(k, v)
    try:
        df.write.options(**{"compression": "zstd"} | options).partitionBy(*by).parquet(path)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def written(df: DataFrame, label: str, rows: int | None = None) -> DataFrame:
    """``df`` written to the shared folder and read back: a cut lineage of which no executor holds the only copy."""
    path = scratch_path(df.sparkSession, label)
    save(df, path, rows=rows)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def n_words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def once_per_process(name: str, make: Callable[[], object]) -> object:
    """What ``make`` gives, kept in a Python worker from task to task; functions that travel by value have no module to keep it in."""
    kept = sys.modules.setdefault("_railgrain_worker", types.ModuleType("_railgrain_worker"))
    if not hasattr(kept, name):
        setattr(kept, name, make())
    return getattr(kept, name)


def mapped(df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str, keep: str = "") -> DataFrame:
    """``df.mapInArrow`` whose tasks first drop what the worker has kept for others than ``keep``, and leave no free memory in it.

    A worker serves one stage after the other, and without this holds the most that any of them needed.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = vars(sys.modules.get("_railgrain_worker", types.SimpleNamespace()))
        for name in [k for k in kept if not k.startswith("__") and k != keep]:
            del kept[name]
        try:
            yield from function(batches)
        finally:
            pa.default_memory_pool().release_unused()
            if hasattr(libc := ctypes.CDLL(None), "malloc_trim"):
                libc.malloc_trim(0)

    return df.mapInArrow(run, schema)


# -- Arrow batches -----------------------------------------------------------------------------------


def slices(batch: pa.RecordBatch, column: int, limit: int = 1 << 19) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that a piece has about ``limit`` bytes of text, or a single longer row.

    Pieces are small because their arrays, eight times as large, are gone over many times and ought to stay in a cache.
    """
    if not batch.num_rows:
        return
    _, ends = text_bytes(batch.column(column))
    first = 0
    while first < batch.num_rows:
        last = int(np.searchsorted(ends, ends[first] + limit, side="right")) - 1
        last = max(first + 1, last)
        yield batch.slice(first, last - first)
        first = last


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all rows, one after the other, and the places where rows begin (one more than rows)."""
    column = column.fill_null(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if not len(column):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(offsets, np.int64 if large else np.int32, len(column) + 1, column.offset * (8 if large else 4))
    whole = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return whole[at[0]:at[-1]], (at - at[0]).astype(np.int64)


def lists(values: np.ndarray, starts: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(values))


# -- hashes of byte strings --------------------------------------------------------------------------

_M = np.uint64(0x9E3779B97F4A7C15)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: A random number for each byte value, so that sums of few bytes differ.
_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _M)


def word_spans(data: np.ndarray, ends: np.ndarray, apart: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin, end and row of every word; a word has no byte of the table ``apart`` and never crosses a row."""
    letter = ~apart[data]
    begin = letter.copy()
    begin[1:] &= ~letter[:-1]
    starts = ends[:-1][ends[:-1] < len(data)]
    begin[starts] = letter[starts]
    last = letter.copy()
    last[:-1] &= ~letter[1:]
    stops = ends[1:][ends[1:] > 0] - 1
    last[stops] = letter[stops]
    b, e = np.flatnonzero(begin), np.flatnonzero(last) + 1
    return b, e, np.searchsorted(ends, b, side="right") - 1


class _Powers:
    """Powers of an odd multiplier and of its inverse, as long as any batch so far needed."""

    def __init__(self, multiplier: int):
        self.by, self.back = multiplier, pow(multiplier, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> None:
        while len(self.up) < n:
            k = len(self.up)
            self.up = np.concatenate([self.up, self.up * np.uint64(pow(self.by, k, 1 << 64))])
            self.down = np.concatenate([self.down, self.down * np.uint64(pow(self.back, k, 1 << 64))])


_POWERS = _Powers(0xD6E8FEB86659FD93)


def span_hashes(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte span, equal for equal spans wherever they lie."""
    _POWERS.upto(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * _POWERS.up[: len(data)], out=total[1:])
    return mix((total[end] - total[begin]) * _POWERS.down[begin] + (end - begin).astype(np.uint64) * _M)


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def lower_latin(data: np.ndarray) -> np.ndarray:
    """UTF-8 bytes with A-Z and the letters from U+00C0 to U+00DE in lower case; no byte moves."""
    data = _LOWER[data]
    after = np.flatnonzero(data[:-1] == 0xC3) + 1
    after = after[(data[after] >= 0x80) & (data[after] <= 0x9E) & (data[after] != 0x97)]
    data[after] += 0x20
    return data
