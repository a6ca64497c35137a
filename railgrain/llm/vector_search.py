"""Exact top-k search by inner product with a vector-approximation file.

Vectors are integers.  Equal vectors are one class, with its k + 1 least keys, so a vector that a third of all rows have is
scanned once.  Every class is quantised: each component becomes a cell of 2 ** BITS over the range of its dimension, and the
cells, one byte a component, are the approximation file.  For a query a cell gives the least and the largest product it can
hide; the bounds are sums of integers and never wrong.

The scan meets blocks of queries with stripes of the file on a grid of tasks.  A task keeps, of its stripe, the classes
whose upper bound reaches the k-th largest lower bound.  Then exact vectors are read in order of their upper bounds, a few
a query first and eight times as many in each further round, until no unread bound reaches the query's k-th score.

Rows: vectors that are null, or hold a null or a component that is no finite number, take no part, nor do queries without a key.  Vectors meet vectors of
their own length.  Components saturate at 2 ** 20 after scaling.  Rows with a null key are candidates, after all others of
their score.  Repeated rows are rows of their own: a query leaves out itself, not its copies.  A query with fewer than k
candidates has all of them, and an empty table has no result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import parts, table, written

SCALE = 256
K = 5
#: Bits of a component in the approximation file.
BITS = 6
#: Vectors of a block of the file, and queries of a block: what a task holds of either at a time.
BLOCK, QUERIES = 1_024, 2_048
#: Largest component, so that sums of products stay whole numbers below 2 ** 53 for vectors of up to 4,096 components.
_MOST = 1 << 20


def scaled(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of each component."""
    return F.transform(vector, lambda x: F.floor(F.greatest(F.lit(-float(_MOST)), F.least(F.lit(float(_MOST)), x.cast("double") * scale))).cast("int"))


def usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) != float("inf")))
    return vector.isNotNull() & finite


def _matrix(column: pa.ListArray, dim: int) -> np.ndarray:
    """The lists of a column that all have ``dim`` numbers, as rows."""
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), dim)


def _runs(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, pa.RecordBatch]]:
    """A batch by the lengths of its lists."""
    sizes = np.diff(batch.column(column).offsets.to_numpy())
    for dim in np.unique(sizes):
        yield int(dim), batch.filter(pa.array(sizes == dim))


def classes_of(rows: DataFrame, k: int) -> DataFrame:
    """(key_, comps) to classes of equal vectors: cls, comps, members (their k + 1 least keys, nulls last)."""
    first = Window.partitionBy("comps").orderBy(F.asc_nulls_last("key_"))
    few = rows.withColumn("at", F.row_number().over(first)).where(F.col("at") <= k + 1)
    found = few.groupBy("comps").agg(F.transform(F.sort_array(F.collect_list(F.struct("at", "key_"))), lambda x: x["key_"]).alias("members"))
    return written(found.select(F.monotonically_increasing_id().alias("cls"), "comps", "members"), "classes")


def ranges(classes: DataFrame, bits: int = BITS) -> DataFrame:
    """The quantiser: for each length of vectors the lows and steps of its dimensions, from all classes."""

    def extent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for dim, rows in _runs(b, 0):
                m = _matrix(rows.column(0), dim)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(dim, dim, np.int32)), pa.array(np.arange(dim, dtype=np.int32)), pa.array(m.min(0).astype(np.int32)),
                     pa.array(m.max(0).astype(np.int32))], ["dim", "at", "lo", "hi"])

    found = classes.select("comps").mapInArrow(extent, "dim int, at int, lo int, hi int").groupBy("dim", "at").agg(
        F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    step = F.ceil((F.col("hi").cast("long") - F.col("lo") + 1) / (1 << bits)).cast("int")
    by_place = F.sort_array(F.collect_list(F.struct("at", "lo", step.alias("step"))))
    # As many rows as a vector has components.
    return found.groupBy("dim").agg(by_place.alias("d")).select("dim", F.col("d.lo").alias("lows"), F.col("d.step").alias("steps"))


def approximate(classes: DataFrame, quantiser: DataFrame) -> DataFrame:
    """The approximation file: rows of up to BLOCK classes, their numbers and cells."""
    rows = classes.withColumn("dim", F.size("comps")).join(quantiser, "dim").select("dim", "cls", "comps", "lows", "steps")

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for dim, some in _runs(b, 2):
                if not dim:
                    continue
                low, step = (np.array(some.column(c)[0].as_py(), np.int64) for c in (3, 4))
                m = ((_matrix(some.column(2), dim) - low) // step).astype(np.uint8)
                for i in range(0, len(m), BLOCK):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([dim], pa.int32()), pa.array([some.column(1)[i:i + BLOCK].to_numpy().tobytes()], pa.binary()),
                         pa.array([m[i:i + BLOCK].tobytes()], pa.binary())], ["dim", "numbers", "cells"])

    return written(rows.mapInArrow(cells, "dim int, numbers binary, cells binary"), "approximations")


def _query_blocks(classes: DataFrame, quantiser: DataFrame, wanted: DataFrame) -> DataFrame:
    """Queries' classes in rows of about QUERIES: numbers, exact vectors, and the quantiser they are compared with."""
    asked = classes.join(wanted, "cls", "left_semi").withColumn("dim", F.size("comps")).where("dim > 0")
    blocks = -(-wanted.count() // QUERIES) or 1
    lists = asked.groupBy("dim", F.pmod(F.xxhash64("cls"), F.lit(blocks)).alias("part")).agg(F.collect_list(F.struct("cls", "comps")).alias("rows"))
    rows = lists.join(quantiser, "dim").select("dim", F.col("rows.cls").alias("cls"), F.col("rows.comps").alias("comps"), "lows", "steps")

    def block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for dim, cls, comps, lows, steps in zip(*(c.to_pylist() for c in b.columns), strict=True):
                packed = [np.array(x, t).tobytes() for x, t in ((cls, np.int64), (comps, np.int32), ((lows, steps), np.int64))]
                yield pa.RecordBatch.from_arrays([pa.array([dim], pa.int32()), *(pa.array([x], pa.binary()) for x in packed)],
                                                 ["dim", "numbers", "vectors", "grid"])

    return written(rows.mapInArrow(block, "dim int, numbers binary, vectors binary, grid binary").withColumn(
        "block", F.monotonically_increasing_id()), "queries")


class _Scan:
    """One block of queries on its way through a stripe: what can still be among the best of each."""

    def __init__(self, dim: int, numbers: bytes, vectors: bytes, grid: bytes, k: int):
        self.numbers = np.frombuffer(numbers, np.int64)
        q = np.frombuffer(vectors, np.int32).reshape(-1, dim).astype(np.float64)
        low, step = np.frombuffer(grid, np.int64).reshape(2, dim).astype(np.float64)
        # A cell c stands for low + step * c up to step - 1 more: whole numbers below 2 ** 53, so sums are exact.
        self.scaled, self.base = q * step, q @ low
        self.up, self.down = np.maximum(q, 0) @ (step - 1), np.minimum(q, 0) @ (step - 1)
        self.dim, self.k = dim, k
        self.best = np.full((len(q), k), -np.inf)
        self.kept: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.held = 0

    def meet(self, numbers: bytes, cells: bytes) -> None:
        them = np.frombuffer(numbers, np.int64)
        c = np.frombuffer(cells, np.uint8).reshape(-1, self.dim).astype(np.float64)
        at = self.scaled @ c.T + self.base[:, None]
        lower = np.concatenate([self.best, at + self.down[:, None]], 1)
        self.best = -np.partition(-lower, self.k - 1, axis=1)[:, :self.k]
        at += self.up[:, None]
        q, v = np.nonzero(at >= self.best.min(1)[:, None])
        self.kept.append((q, them[v], at[q, v]))
        self.held += len(q)
        if self.held > 4 * self.k * len(self.numbers) + 100_000:
            self._weed()

    def _weed(self) -> None:
        q, v, upper = (np.concatenate(x) for x in zip(*self.kept, strict=True))
        on = upper >= self.best.min(1)[q]
        self.kept = [(q[on], v[on], upper[on])]
        self.held = int(on.sum())

    def result(self) -> pa.RecordBatch:
        self._weed()
        q, v, upper = self.kept[0]
        return pa.RecordBatch.from_arrays([pa.array(self.numbers[q]), pa.array(v), pa.array(upper.astype(np.int64))], ["q", "cls", "upper"])


def scan(file: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """(q, cls, upper): for each stripe and query all classes whose bounds leave them among the best k of the stripe."""
    n_queries, tasks = queries.count(), parts(file.sparkSession)
    # Enough stripes for all tasks, none of them below eight blocks of the file.
    stripes = max(1, min(-(-2 * tasks // max(1, n_queries)), -(-file.count() // 8)))
    none = F.lit(None).cast("binary")
    grid = queries.select("block", F.explode(F.sequence(F.lit(0), F.lit(stripes - 1))).alias("stripe"), "dim", F.lit(0).alias("kind"),
                          "numbers", F.col("vectors").alias("data"), "grid")
    places = queries.select("block", "dim")  # two numbers for each QUERIES queries
    met = file.withColumn("stripe", F.pmod(F.xxhash64("numbers"), F.lit(stripes))).join(
        F.broadcast(places) if n_queries <= 10_000 else places, "dim").select("block", F.col("stripe").cast("int").alias("stripe"), "dim", F.lit(1).alias("kind"), "numbers", F.col("cells").alias("data"), none.alias("grid"))
    dealt = grid.unionByName(met).repartition(2 * tasks, "block", "stripe").sortWithinPartitions("block", "stripe", "kind")

    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = None
        for b in batches:
            for i in range(b.num_rows):
                dim, kind, numbers, data, grid_ = (b.column(c)[i].as_py() for c in range(2, 7))
                if kind == 0:
                    if now and now.kept:
                        yield now.result()
                    now = _Scan(dim, numbers, data, grid_, k)
                else:
                    now.meet(numbers, data)
        if now and now.kept:
            yield now.result()

    return dealt.mapInArrow(sweep, "q long, cls long, upper long")


def _products(pairs: DataFrame, classes: DataFrame, asked: DataFrame) -> DataFrame:
    """Exact scores of pairs (q, cls)."""
    read = pairs.join(classes.select("cls", F.col("comps").alias("v_")), "cls").join(asked.select("q", F.col("comps").alias("q_")), "q")

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for dim, some in _runs(b, 2):
                score = np.einsum("ij,ij->i", _matrix(some.column(2), dim).astype(np.int64), _matrix(some.column(3), dim).astype(np.int64))
                yield pa.RecordBatch.from_arrays([some.column(0), some.column(1), pa.array(score)], ["q", "cls", "score"])

    return read.select("q", "cls", "v_", "q_").mapInArrow(multiply, "q long, cls long, score long")


def _read_in_order(candidates: DataFrame, classes: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """Exact scores of candidates by falling bound until, for every query, the k-th score beats all bounds not read."""
    order = Window.partitionBy("q").orderBy(F.desc("upper"), "cls")
    left = written(candidates.withColumn("at", F.row_number().over(order)), "candidates")
    most, scores = 2 * k, None
    while True:
        now = left.where(F.col("at") <= most)
        found = _products(now.select("q", "cls"), classes, asked)
        scores = written(found if scores is None else found.unionByName(scores), "scores")
        best = scores.withColumn("n", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "cls"))).where(F.col("n") <= k)
        # A query whose k-th score is not yet known goes on; ties of a bound with the k-th score do too.
        kth = best.where(F.col("n") == k).select("q", "score")
        left = written(left.where(F.col("at") > most).join(kth, "q", "left").where("score is null or upper >= score").drop("score"), "unread")
        if left.isEmpty():
            return scores
        most *= 8


def top_k(df: DataFrame, key: str, vector: str, is_query: Column, k: int = K, scale: int = SCALE, bits: int = BITS) -> DataFrame:
    """For every row of ``df`` that is a query its k best other rows: query_id, rank, vec_id, score; ties to the smaller key."""
    rows = df.where(usable(F.col(vector))).select(F.col(key).alias("key_"), scaled(F.col(vector), scale).alias("comps"),
                                                  (is_query & F.col(key).isNotNull()).alias("query_"))
    classes = classes_of(rows.select("key_", "comps"), k)
    queries = written(rows.where("query_").join(classes, "comps").select("key_", F.col("cls").alias("q")), "asked")
    wanted = queries.select(F.col("q").alias("cls")).distinct()
    quantiser = written(ranges(classes, bits), "quantiser")
    file, blocks = approximate(classes, quantiser), _query_blocks(classes, quantiser, wanted)
    few = k + 1  # one of them may be the query itself
    asked = written(classes.join(wanted, "cls", "left_semi").select(F.col("cls").alias("q"), "comps"), "vectors")
    found = scan(file, blocks, few)
    # Vectors without components have no cells; they are one class.
    found = found.unionByName(asked.where("size(comps) = 0").select("q", F.col("q").alias("cls"), F.lit(0).cast("long").alias("upper")))
    scores = _read_in_order(found, classes, asked, few)
    # k + 1 classes by score and least key hold the k + 1 best rows.
    named = scores.join(classes.select("cls", "members"), "cls")
    first = Window.partitionBy("q").orderBy(F.desc("score"), F.asc_nulls_last(F.col("members")[0]), "cls")
    named = named.withColumn("n", F.row_number().over(first)).where(F.col("n") <= few)
    listed = named.select("q", "cls", "score", F.explode("members").alias("key_"))
    best = listed.withColumn("n", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), F.asc_nulls_last("key_"), "cls"))).where(
        F.col("n") <= few)
    lists = best.groupBy("q").agg(F.sort_array(F.collect_list(F.struct("n", "score", "key_", (F.col("cls") == F.col("q")).alias("own")))).alias("best"))
    mine = F.array_position(F.transform("best", lambda x: F.when(x["own"], x["key_"])), F.col("own_key"))
    out = queries.withColumnRenamed("key_", "own_key").join(lists, "q").withColumn("mine", mine).withColumn(
        "best", F.slice(F.filter("best", lambda x, i: i + 1 != F.col("mine")), 1, k))
    return out.select(F.col("own_key").alias("query_id"), F.posexplode("best")).select(
        "query_id", (F.col("pos") + 1).alias("rank"), F.col("col.key_").alias("vec_id"), F.col("col.score").alias("score"))


def query(spark, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return top_k(rows, "vec_id", "embedding", F.col("vec_id") % 50 == 0)


SQL = f"""
with v as (
    select row_number() over () as row_id, vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::double)) as comps from embeddings
    where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
    select q.row_id, q.vec_id as query_id, c.vec_id, list_sum(list_transform(list_zip(q.comps, c.comps), lambda z: z[1] * z[2]))::bigint as score
    from v q join v c on q.row_id <> c.row_id and len(q.comps) = len(c.comps) where q.vec_id % 50 = 0
), ranked as (
    select *, row_number() over (partition by row_id order by score desc, vec_id) as rank from scored
)
select query_id, rank::int as rank, vec_id, score from ranked where rank <= {K}
"""
