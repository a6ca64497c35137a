"""A kept index of station names: written once, asked many times without reading the stations again.

Names are filed under their pieces of one to three letters, as in ``find_station``, in tiers by how good a choice they are: the
best 4,096 names of all are tier 0, the next 32,768 tier 1, and so on, eight times as many in each.  Any name of a tier is a
better choice than all of later ones, so a query that is met in a tier is answered, and only the others are
asked of the next.  A query stops at the last tier that has its piece.  Tiers are folders, and within them
postings are sorted by piece, so a round reads one tier's row groups for the pieces it asks for.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import materialize
from .stations import as_patterns, asked_pieces, contains, means_any, name_choices, name_pieces

#: Names in the first tier, and how many times as many the next has.
FIRST, TIMES = 4096, 8


def _tiered(names: DataFrame) -> DataFrame:
    """The names with ``tier``, by place in the order of choices: one range sort, and a count for each of its parts."""
    run, order = F.shiftright(F.monotonically_increasing_id(), 33), ["choice.rank", "choice.station_name", "choice.tiploc_code"]
    nth = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    sorted_ = materialize(names.repartitionByRange(*order).sortWithinPartitions(*order)
                          .select("*", run.alias("run"), nth.alias("nth")), "names")
    ahead = Window.orderBy("run").rowsBetween(Window.unboundedPreceding, -1)  # one row for each part of the sort
    base = sorted_.groupBy("run").agg(F.count("*").alias("n")).select(
        "run", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("base"))
    place = F.col("base") + F.col("nth")
    # The first t tiers hold FIRST * (TIMES ** t - 1) / (TIMES - 1) names.
    tier = F.floor(F.log(float(TIMES), 1 + place * (TIMES - 1) / FIRST) + 1e-9).cast("int")
    return sorted_.join(base, "run").select("station_name", "choice", tier.alias("tier"))


def write_station_index(stations: DataFrame, aliases: DataFrame, path: str) -> None:
    """Write the index of stations ``(station_name, cate_type, tiploc_code)`` and aliases to a new folder."""
    names = materialize(_tiered(name_choices(stations, aliases)), "tiers")
    filed = names.select("tier", F.explode(name_pieces("station_name")).alias("gram"), "station_name", "choice")
    order = ["tier", "gram", "choice.rank", "choice.station_name", "choice.tiploc_code"]  # a common piece is several parts
    filed.repartitionByRange(*order).sortWithinPartitions(*order).write.partitionBy("tier").parquet(f"{path}/postings")
    filed.groupBy("gram").agg(F.count("*").alias("names"), F.max("tier").alias("last_tier")).repartitionByRange(
        "gram").sortWithinPartitions("gram").write.parquet(f"{path}/pieces")
    codes = stations.select(F.rpad("tiploc_code", 7, " ").alias("code"), "tiploc_code")
    codes.repartitionByRange("code").sortWithinPartitions("code").write.parquet(f"{path}/codes")
    names.where("tier = 0").agg(F.min("choice").alias("choice")).select("choice.tiploc_code").write.parquet(f"{path}/best")


_CHOICE = "choice struct<rank: int, station_name: string, tiploc_code: string>"
_SCHEMAS = {"postings": f"gram string, station_name string, {_CHOICE}, tier int", "codes": "code string, tiploc_code string",
            "pieces": "gram string, names long, last_tier int", "best": "tiploc_code string"}


def find_indexed(spark: SparkSession, queries: DataFrame, path: str) -> DataFrame:
    """``find_station`` of the stations that were indexed: ``(query_id, tiploc_code)``, NULL if none."""
    table = {name: spark.read.schema(kinds).parquet(f"{path}/{name}") for name, kinds in _SCHEMAS.items()}
    asked = materialize(as_patterns(queries), "asked")
    wanted = asked.where(F.trim("q") != "").select("q").distinct()
    found = materialize(wanted.join(table["codes"], F.rpad("q", 7, " ") == F.col("code")).select("q", "tiploc_code"), "exact")
    part = wanted.join(found, "q", "left_anti")
    found = found.union(part.where(means_any("q")).select("q", table["best"].scalar().alias("tiploc_code")))
    each = part.where(~means_any("q")).select("q", F.explode(asked_pieces("q")).alias("gram"))
    # A piece no name has is as rare as can be: its query is asked of no tier.
    rarest = each.join(table["pieces"], "gram", "left").groupBy("q").agg(F.min(F.struct(
        F.coalesce("names", F.lit(0)).alias("names"), "gram", F.coalesce("last_tier", F.lit(-1)).alias("last_tier"))).alias("p"))
    open_, tier = materialize(rarest.select("q", "p.gram", "p.last_tier"), "open"), 0
    while not (left := open_.where(F.col("last_tier") >= tier)).isEmpty():
        postings = table["postings"].where(F.col("tier") == tier).drop("tier")
        met = left.join(postings, "gram").where(contains("station_name", "q")).groupBy("q").agg(
            F.min("choice").alias("choice")).select("q", "choice.tiploc_code")
        met, tier = materialize(met, "met"), tier + 1
        found = found.union(met)
        open_ = materialize(left.join(met, "q", "left_anti"), "open")
    return asked.join(found, "q", "left").select("query_id", "tiploc_code")
