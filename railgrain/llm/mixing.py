"""Mix sources to target weights with pivotal dependent rounding.

DataFrame functions only.  Every document gets a number of copies whose mean is target / size of its source; the fraction
of a copy is rounded dependently, so that a source's words come out at its target but for the size of one document.

A step takes two fractional documents and moves words of probability from one to the other, up or down at random with
odds that keep both means, until one of the two is 0 or 1.  Steps are chained within small buckets of a source; what a
bucket leaves over, at most one fractional document, meets the rest of other buckets on the next level.  So a source
that holds most rows is as many buckets as it needs, and levels grow with the logarithm of the data.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import n_words, written

WEIGHTS = (5, 2, 1)
SHARE = 1.5
LIMIT = 2.0
#: Fractional documents chained in one bucket, about.
BUCKET = 64
_EPS = 1e-12


def targets(sizes: DataFrame, share: float = SHARE, limit: float = LIMIT, weights=WEIGHTS) -> DataFrame:
    """One row per source: source, source_size, target.  ``sizes`` has source and source_size, one row per source.

    ``weights`` repeat over the sources in code point order, null last.  A target stops at ``limit`` times its source,
    and what is left over goes to the others by weight: the level at which all but the first k sources, in order of
    limit per weight, are below theirs.  The windows run over one row per source.
    """
    n = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    w = F.element_at(F.array(*map(F.lit, map(float, weights))), (n % len(weights) + 1).cast("int"))
    s = sizes.withColumn("w", w).withColumn("cap", F.col("source_size") * F.lit(limit))
    order = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    before, rest = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    s = s.withColumn("level", (F.sum("source_size").over(everything) * share - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
                     / F.sum("w").over(rest))
    s = s.withColumn("level", F.max(F.when(F.col("level") * F.col("w") <= F.col("cap"), F.col("level"))).over(everything))
    return s.select("source", "source_size",
                    F.least("cap", F.coalesce(F.col("level") * F.col("w"), F.col("cap"))).alias("target"))


def _chance(seed: int, level: int, *ids: Column) -> Column:
    """A number in [0, 1) that depends on nothing but its arguments."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.lit(level), *ids), 11) / F.lit(float(1 << 53))


def _bind(value: Column, body) -> Column:
    """``body`` of ``value``, which is worked out once."""
    return F.transform(F.array(value), body)[0]


def _fold(items: Column, seed: int, level: int) -> Column:
    """Chain the pivotal steps over an array of (h, u, v, s, p): struct(rest, out), out holds (u, v, copy)."""
    item = "struct<h:bigint,u:bigint,v:bigint,s:double,p:double>"
    zero = F.struct(F.lit(None).cast(item).alias("rest"),
                    F.array().cast("array<struct<u:bigint,v:bigint,copy:int>>").alias("out"))

    def whole(x: Column) -> Column:
        return (x["p"] <= 0) | (x["p"] >= 1)

    def copy(x: Column) -> Column:
        return F.struct(x["u"].alias("u"), x["v"].alias("v"), x["p"].cast("int").alias("copy"))

    def put(x: Column, p: Column) -> Column:
        p = F.when(p <= _EPS, 0.0).when(p >= 1 - _EPS, 1.0).otherwise(p)
        return F.struct(*(x[k].alias(k) for k in ("h", "u", "v", "s")), p.alias("p"))

    def step(acc: Column, x: Column) -> Column:
        a = acc["rest"]
        moves = F.struct(F.least((1 - a["p"]) * a["s"], x["p"] * x["s"]).alias("up"),
                         F.least(a["p"] * a["s"], (1 - x["p"]) * x["s"]).alias("down"))
        chance = _chance(seed, level, a["u"], a["v"], x["u"], x["v"])
        words = _bind(moves, lambda m: F.when(chance * (m["up"] + m["down"]) < m["down"], m["up"]).otherwise(-m["down"]))
        pair = _bind(words, lambda d: F.struct(put(a, a["p"] + d / a["s"]).alias("a"), put(x, x["p"] - d / x["s"]).alias("b")))
        after = _bind(pair, lambda q: F.struct(
            F.when(~whole(q["a"]), q["a"]).when(~whole(q["b"]), q["b"]).alias("rest"),
            F.concat(acc["out"], F.when(whole(q["a"]), F.array(copy(q["a"]))).otherwise(F.array()),
                     F.when(whole(q["b"]), F.array(copy(q["b"]))).otherwise(F.array())).alias("out")))
        first = F.struct(x.alias("rest"), acc["out"].alias("out"))
        return F.when(a.isNull(), first).otherwise(after).cast(
            f"struct<rest:{item},out:array<struct<u:bigint,v:bigint,copy:int>>>")

    return F.aggregate(items, zero, step)


def round_copies(units: DataFrame, seed: int = 0) -> DataFrame:
    """u, v, copy (0 or 1) for every row of ``units``: u, v (its id), source, s (words, above 0), p (between 0 and 1)."""
    n = units.groupBy("source").agg(F.count("*").alias("n"))
    buckets = F.ceil(F.col("n") / BUCKET).cast("long")
    by = n.select(F.col("source").alias("of"), buckets.alias("buckets"))
    most = by.agg(F.max("buckets")).first()[0] or 0
    rows = units.join(by, F.col("source").eqNullSafe(F.col("of"))).drop("of")
    done = None
    for level in range(1 + (math.ceil(math.log(most, BUCKET)) if most > 1 else 0) if most else 0):
        h = F.xxhash64(F.lit(seed + 1), F.lit(level), "u", "v")
        items = F.sort_array(F.collect_list(F.struct(h.alias("h"), "u", "v", "s", "p")))
        folded = (rows.groupBy("source", "buckets", F.pmod(h, F.col("buckets")).alias("bucket")).agg(items.alias("items"))
                  .select("source", "buckets", _fold(F.col("items"), seed, level).alias("f")))
        folded = written(folded.select("source", "buckets", "f.rest", "f.out"), "pivotal")
        out = folded.select(F.explode("out").alias("o")).select("o.*")
        ends = folded.where("rest is not null")
        last = ends.where("buckets = 1").select("rest.*").select(
            "u", "v", (_chance(seed, level, F.col("u"), F.col("v")) < F.col("p")).cast("int").alias("copy"))
        out = out.unionByName(last)
        done = out if done is None else done.unionByName(out)
        rows = ends.where("buckets > 1").select(
            "source", F.ceil(F.col("buckets") / BUCKET).cast("long").alias("buckets"), "rest.u", "rest.v", "rest.s", "rest.p")
    return done if done is not None else units.select("u", "v", F.lit(0).alias("copy"))


def _ids(*columns: str) -> list[Column]:
    """Two independent 64-bit hashes: rows that agree in all columns, nulls included, have the same."""
    flat = [x for c in columns for x in (F.col(c).isNull(), F.col(c))]
    return [F.xxhash64(F.lit(11), *flat).alias("u"), F.xxhash64(F.lit(23), *flat, F.lit(5)).alias("v")]


def unit_copies(rows: DataFrame, seed: int = 0, share: float = SHARE, limit: float = LIMIT, weights=WEIGHTS) -> DataFrame:
    """Copies of each unit: u, v, key, source, size, source_size, target, m, copies.

    ``rows`` has u, v (id of the row), key, source, size.  Rows with one id are one unit of m rows, which share its copies.
    """
    units = rows.groupBy("u", "v").agg(
        F.first("key").alias("key"), F.first("source").alias("source"), F.first("size").alias("size"),
        F.count("*").alias("m"))
    units = written(units, "units")
    aims = targets(units.groupBy("source").agg(F.sum(F.col("size") * F.col("m")).alias("source_size")), share, limit, weights)
    aims = aims.withColumnRenamed("source", "of")
    mean = F.when(F.col("size") > 0, F.col("m") * F.col("target") / F.col("source_size")).otherwise(0.0)
    units = units.join(aims, F.col("source").eqNullSafe(F.col("of"))).drop("of").withColumn("mean", mean)
    units = units.withColumn("base", F.floor(F.col("mean") + _EPS)).withColumn(
        "p", F.greatest(F.col("mean") - F.col("base"), F.lit(0.0)))
    units = written(units, "means")
    fractional = units.where(F.col("p") > _EPS).select("u", "v", "source", F.col("size").cast("double").alias("s"), "p")
    extra = round_copies(fractional, seed)
    return units.join(extra, ["u", "v"], "left").select(
        "u", "v", "key", "source", "size", "source_size", "target", "m",
        (F.col("base") + F.coalesce("copy", F.lit(0))).cast("long").alias("copies"))


def _share(n: Column) -> Column:
    """Copies of the n-th (from 0) of a unit's m equal rows."""
    return F.floor(F.col("copies") / F.col("m")) + (n < F.col("copies") % F.col("m")).cast("long")


def mix(docs: DataFrame, key: str = "doc_id", source: str = "source", seed: int = 0) -> DataFrame:
    """One row per row of ``docs``: key, source, size (words of ``text``), source_size, target, copies.

    Null and blank texts have size 0 and are not taken; a null source is a source of its own, after all others.
    Equal rows are one unit whose copies are dealt among them.  Other columns of ``docs`` are left out.
    """
    rows = docs.select(F.col(key).alias("key"), F.col(source).alias("source"), n_words(F.col("text")).alias("size"),
                       F.xxhash64("text").alias("tie"))
    rows = rows.select("key", "source", "size", *_ids("key", "source", "size", "tie"))
    units = unit_copies(rows, seed)
    each = units.select("*", F.posexplode(F.sequence(F.lit(1), F.col("m"))).alias("n", "x"))
    return each.select(F.col("key").alias(key), F.col("source").alias(source), "size", "source_size", "target",
                       _share(F.col("n")).alias("copies"))


def mixed(docs: DataFrame, key: str = "doc_id", source: str = "source", seed: int = 0) -> DataFrame:
    """The rows of ``docs``, all columns, each as often as the mix takes it.

    Rows of one key, source and text take their copies in the order of a hash of all their columns, so reruns agree.
    """
    # Maps have no hash.
    every = [F.to_json(F.col(f"`{f.name}`")) if "map<" in f.dataType.simpleString() else F.col(f"`{f.name}`") for f in docs.schema.fields]
    held = docs.select(F.struct("*").alias("row"), F.xxhash64(*every).alias("all"), F.col(key).alias("key"), F.col(source).alias("source"),
                       n_words(F.col("text")).alias("size"), F.xxhash64("text").alias("tie"))
    held = held.select("row", "all", "key", "source", "size", *_ids("key", "source", "size", "tie"))
    units = unit_copies(held.drop("row", "all"), seed).select("u", "v", "m", "copies")
    numbered = held.select("row", "u", "v", (F.row_number().over(Window.partitionBy("u", "v").orderBy("all")) - 1).alias("n"))
    taken = numbered.join(units.where("copies > 0"), ["u", "v"]).withColumn("k", _share(F.col("n")).cast("int"))
    return taken.select("row", F.explode(F.array_repeat(F.lit(0), F.col("k"))).alias("x")).select("row.*")


def query(spark, sf_dir: str) -> DataFrame:
    mixture = mix(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return mixture.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))
