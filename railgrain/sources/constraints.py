"""Keys and references that loaded tables must keep, and the rows that break them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_SCHEDULE = ("train_uid", "date_runs_from", "stp_indicator")
_CALLS = ("origin_location", "intermediate_location", "changes_en_route", "terminating_location", "location_specific_note")

# The key of each table that has one, and the tables whose rows belong to a schedule.  Z-trains have
# repeated keys by nature, so their tables have neither.
KEYS = {
    "mca.basic_schedule": _SCHEDULE,
    **{f"mca.{name}": (*_SCHEDULE, "loc_order") for name in _CALLS},
    "mca.tiploc_insert": ("tiploc_code",),
    "mca.tiploc_amend": ("tiploc_code",),
    "mca.tiploc_delete": ("tiploc_code",),
    "msn.station_detail": ("tiploc_code",),
    "msn.routeing_groups": ("group_name",),
    "naptan.railreferences": ("tiploc",),
}
PARENT = "mca.basic_schedule"
CHILDREN = tuple(f"mca.{name}" for name in _CALLS)


def _text(key: tuple[str, ...]):
    return F.concat_ws(" / ", *(F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in key))


def violations(tables: dict[str, DataFrame]) -> DataFrame:
    """``(table, rule, key, n)``: every key that is null in a column or repeated, and every schedule that rows belong to and
    that does not exist, with the number of rows.

    Tables that are not given are not checked; references only if the schedules are given.  All keys go through one
    aggregation, which reduces before it shuffles; calls are reduced to one row a train and table before the anti join.
    """
    keyed = [df.select(F.lit(name).alias("table"), _text(KEYS[name]).alias("key"),
                       reduce(lambda a, b: a | b, (F.col(c).isNull() for c in KEYS[name])).alias("none"))
             for name, df in tables.items() if name in KEYS]
    if not keyed:
        raise ValueError("none of these tables has a key")
    counted = reduce(DataFrame.unionAll, keyed).groupBy("table", "key", "none").agg(F.count(F.lit(1)).alias("n"))
    out = counted.filter("none or n > 1").select(
        "table", F.when(F.col("none"), "null key").otherwise("repeated key").alias("rule"), "key", "n")
    calls = [df.select(F.lit(name).alias("table"), *_SCHEDULE) for name, df in tables.items() if name in CHILDREN]
    if calls and PARENT in tables:
        trains = reduce(DataFrame.unionAll, calls).groupBy("table", *_SCHEDULE).agg(F.count(F.lit(1)).alias("n"))
        lost = trains.join(tables[PARENT].select(*_SCHEDULE), list(_SCHEDULE), "left_anti")
        # A null key is reported above; it refers to nothing.
        whole = reduce(lambda a, b: a & b, (F.col(c).isNotNull() for c in _SCHEDULE))
        out = out.unionAll(lost.filter(whole).select("table", F.lit("no schedule").alias("rule"), _text(_SCHEDULE).alias("key"), "n"))
    return out
