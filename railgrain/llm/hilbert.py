"""Shards in Hilbert order: quantise metadata, sort by the curve, cut the run into shards of equal row counts.

Neighbours on the curve are neighbours in every dimension, so a file covers a small box and its column statistics let a
reader skip it for a filter on any of the dimensions.  Quantiles of numbers come from all rows (a sketch of bounded
size).  Strings are cut between whole distinct values, in byte order: all of them while there are at most ``DISTINCT``, else
the ones with the least hashes, so the cuts are the same in every run.  Each value then has a cell of its own while there
are cells enough, and few values are spread over all cells.  The sort ends with the key and hashes, so a value that
holds a third of all rows is cut like any other.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path
from .common import parts, save, table

SHARDS = 24
#: Bits for each dimension: 2 ** BITS quantiles.
BITS = 5
#: Distinct values of a string dimension that its cuts are chosen from, at most; every row is placed by them.
DISTINCT = 4_096
OWN = ("shard", "slot_", "curve_", "run_", "place_", "base_", "total_", "rank_", "shard_", "length_")


def hilbert_index(points: np.ndarray, bits: int) -> np.ndarray:
    """Places on the Hilbert curve of ``points`` (rows of coordinates below 2 ** bits); Skilling's transform, by column."""
    x = [points[:, i].astype(np.int64).copy() for i in range(points.shape[1])]
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:  # undo excess work of the transform, from the highest bit down
        p = q - 1
        for i in range(n):
            on = (x[i] & q) != 0
            swap = np.where(on, 0, (x[0] ^ x[i]) & p)
            x[0] = np.where(on, x[0] ^ p, x[0] ^ swap)
            x[i] = x[i] ^ swap if i else x[0]
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        t = np.where((x[n - 1] & q) != 0, t ^ (q - 1), t)
        q >>= 1
    out = np.zeros_like(t)
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            out = (out << 1) | (((x[i] ^ t) >> b) & 1)
    return out


def _is_number(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, (T.NumericType, T.DateType, T.TimestampType))


def _value(df: DataFrame, column: str) -> Column:
    """An order-preserving number of a numeric or time column, the bytes of any other."""
    kind = df.schema[column].dataType
    if isinstance(kind, T.NumericType):
        return F.col(column).cast("double")
    if isinstance(kind, (T.DateType, T.TimestampType)):
        return F.col(column).cast("timestamp").cast("double")
    return F.col(column) if isinstance(kind, T.BinaryType) else F.col(column).cast("string").cast("binary")


def _byte_cuts(df: DataFrame, column: str, cells: int) -> list[bytes]:
    """At most ``cells`` - 1 values that cut the distinct values of a column evenly."""
    values = df.select(_value(df, column).alias("v")).where("v is not null").groupBy("v").count()
    some = sorted(bytes(r.v) for r in values.orderBy(F.xxhash64("v"), "v").select("v").limit(DISTINCT).collect())
    return [some[i] for i in sorted({k * len(some) // cells for k in range(1, cells)}) if i]


def with_curve(df: DataFrame, dims: list[str], bits: int = BITS) -> DataFrame:
    """``df`` with ``curve_``, the place on the Hilbert curve; nulls of a dimension lie with the lowest values."""
    cells = 1 << bits
    numeric = [d for d in dims if _is_number(df, d)]
    share = [i / cells for i in range(1, cells)]
    found = df.agg(F.lit(0), *(F.percentile_approx(_value(df, d), share, 10_000) for d in numeric)).first()[1:]
    by_name = {d: np.unique(np.asarray(c or [], float)) for d, c in zip(numeric, found, strict=True)}
    cuts = [by_name[d] if d in by_name else _byte_cuts(df, d, cells) for d in dims]  # a constant number of quantiles

    @F.pandas_udf("bigint")
    def place(*columns):
        import bisect

        import pandas as pd

        def cell(column, cut):
            if isinstance(cut, np.ndarray):
                return np.where(pd.isna(column), 0, np.searchsorted(cut, column.to_numpy(float, na_value=-np.inf), side="right"))
            code, values = pd.factorize(column)
            return np.array([bisect.bisect_right(cut, bytes(v)) for v in values] + [0], np.int64)[code]  # -1, a null, is the last

        # Few values are spread over all cells, or the curve would run along the other dimensions alone.
        points = [cell(column, cut) * cells // (len(cut) + 1) for column, cut in zip(columns, cuts, strict=True)]
        return pd.Series(hilbert_index(np.stack(points, 1), bits))

    return df.withColumn("curve_", place(*(_value(df, d) for d in dims)))


def write_shards(df: DataFrame, dims: list[str], tie: list[str], path: str, n_shards: int = SHARDS) -> None:
    """Write ``df`` below ``path`` as shard=0 … shard=n-1, rows in curve order; counts differ by one at most.

    The rows are sorted once (a range exchange, no gathering), written as runs with their place in the run; the runs'
    lengths, one number each, say where a shard begins, and the runs are cut there without another exchange.
    Nulls are allowed in every column and equal rows are interchangeable.  An empty table writes no shard.  Columns of ``df`` that
    have one of the names that are written or used here (``OWN``) are left out.
    """
    spark, df = df.sparkSession, df.drop(*OWN)
    order = ["curve_", *tie]
    ordered = with_curve(df, dims).repartitionByRange(parts(spark), *order).sortWithinPartitions(*order)
    place = F.monotonically_increasing_id()
    runs = ordered.withColumn("run_", F.shiftright(place, 33)).withColumn("place_", place.bitwiseAND((1 << 33) - 1))
    save(runs, f"{path}-runs")
    runs = spark.read.schema(runs.schema).parquet(f"{path}-runs")
    lengths = runs.groupBy("run_").agg(F.count("*").alias("length_"))
    ahead = Window.orderBy("run_").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    base = lengths.select("run_", F.coalesce(F.sum("length_").over(ahead), F.lit(0)).alias("base_"),
                          F.sum("length_").over(every).alias("total_"))
    # One row for each run, of which there are as many as a shuffle has parts.
    ranked = runs.join(F.broadcast(base), "run_").withColumn("rank_", F.col("base_") + F.col("place_"))
    shard = F.expr(f"(rank_ * {n_shards}) div total_").cast("int")
    first = F.expr(f"(shard_ * total_ + {n_shards - 1}) div {n_shards}")
    cut = ranked.withColumn("shard_", shard).withColumn("slot_", F.col("rank_") - first)
    cut = cut.drop("run_", "place_", "base_", "total_", "rank_").sortWithinPartitions("shard_", "slot_")
    save(cut.withColumnRenamed("shard_", "shard"), path, by=("shard",))


def read_shards(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All shards: the columns written, slot_, and shard."""
    kinds = T.StructType([f for f in schema if f.name not in OWN] + [T.StructField("curve_", T.LongType()), T.StructField("slot_", T.LongType()),
                                                T.StructField("shard", T.IntegerType())])
    return spark.read.schema(kinds).parquet(path)


def query(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    docs = docs.withColumn("crc_", F.crc32(F.coalesce("text", F.lit("")).cast("binary")))
    path = scratch_path(spark, "shards")
    write_shards(docs, ["lang", "source", "n_chars", "doc_id"], ["doc_id", "crc_"], path)
    back = read_shards(spark, path, docs.schema)
    text = F.coalesce("text", F.lit("")).cast("binary")
    return back.select(
        "doc_id", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
        F.lit("rows").alias("law"), "shard", F.col("slot_").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
