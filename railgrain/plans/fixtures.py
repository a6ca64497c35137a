"""Rail tables derived from the given tables, in SQL that runs unchanged in Spark and in the checking engine.

All rows of the source tables take part.  Orders are schedules, their line items are stops, suppliers are
stations.  See FIXTURES.md.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.decoders import days_run
from ..session import is_there, scratch_path, write_to

DATE = dt.date(1998, 5, 9)
SOURCES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def coded(n: str, width: int, base: int = 36) -> str:
    """A number in ``width`` digits, letters after 9, so that it fits a field long after decimals would not."""
    digits = []
    for place in reversed(range(width)):
        digit = f"cast(floor({n} / {base ** place}) as bigint) % {base}"
        digits.append(f"chr(cast(48 + {digit} + case when {digit} > 35 then 13 when {digit} > 9 then 7 else 0 end as int))")
    return f"concat({', '.join(digits)})"


def code3(n: str) -> str:
    """Three characters from a number.  The format has no more, so numbers that differ by 238,328 share a code."""
    return coded(n, 3, 62)


def train(number: str, kind: int) -> str:
    """Train numbers of customers, distinct up to 18 milliards of them; ``kind`` 0 is standard, 1 Z-train, 2 associated."""
    return coded(f"({number} * 3 + {kind})", 6, 62)


def _bit(n: int) -> str:
    return f"cast(cast(floor(m / {2 ** n}) as int) % 2 as varchar(1))"


_LINK = """select '{mode}' mode, {origin} origin, {destination} destination,
    cast(5 + (s_suppkey * {k}) % 40 as int) link_time,
    cast((s_suppkey % 4) * 7200 as int) start_time, cast(86340 - (s_suppkey % 3) * 3600 as int) end_time,
    case when s_suppkey % 5 = 0 then null else date '1998-01-01' end start_date,
    case when s_suppkey % 5 = 0 then null else date '1998-12-31' end end_date,
    case s_suppkey % 3 when 0 then '1111111' when 1 then '1111100' else '0000011' end days_of_week
  from supplier"""

_LINE_ORDER = "partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice"

VIEWS = {
    "fx_station": f"""select concat('S', {coded("s_suppkey", 6)}) tiploc_code,
    upper(s_name) station_name,
    cast(case s_suppkey % 5 when 4 then 9 else s_suppkey % 5 end as int) cate_type,
    {code3("floor(s_suppkey / 2)")} crs3, s_nationkey nation,
    cast(11000 + (s_suppkey * 37) % 5500 as int) easting, cast(60500 + (s_suppkey * 53) % 9000 as int) northing,
    cast(1 + s_suppkey % 9 as int) change_time, s_suppkey
  from supplier""",
    "fx_alias": """select station_name,
    concat('ALIAS ', cast(cate_type as varchar(2)), ' OF ', tiploc_code) alias_name, s_suppkey
  from fx_station where change_time % 2 = 0""",
    "fx_link": " union all ".join(
        _LINK.format(mode=mode, k=k, origin=code3("floor(s_suppkey / 2)"),
                     destination=code3(f"(floor(s_suppkey / 2) + {k})"))
        for mode, k in (("TRANSFER", 1), ("WALK", 2), ("WALK", 5))),
    "fx_schedule_all": f"""select {train("o_custkey", 0)} train_uid, o_custkey,
    cast(o_orderdate as date) date_runs_from, cast(o_orderdate + interval '400' day as date) date_runs_to,
    concat({", ".join(_bit(n) for n in range(7))}) days_run,
    case substr(o_orderpriority, 1, 1) when '1' then 'C' when '2' then 'N' when '3' then 'O' else 'P' end
      stp_indicator,
    case when o_orderstatus in ('F', 'P') then o_orderstatus else ' ' end train_status,
    case when o_orderkey % 3 > 0 then cast(o_orderkey % 200 as int) end speed,
    o_orderkey k
  from (select *, 1 + o_orderkey % 127 m from orders) o""",
    "fx_schedule": """select * from (select *, row_number() over (
      partition by train_uid, date_runs_from, stp_indicator order by k) rn from fx_schedule_all) s
  where rn = 1""",
    "fx_stop_time": f"""select l_orderkey k, l_suppkey,
    cast(row_number() over ({_LINE_ORDER}) - 1 as int) loc_order,
    (l_orderkey * 37) % 1440 * 60 + sum(300 + (l_partkey % 40) * 60 + (l_partkey % 2) * 30)
      over ({_LINE_ORDER} rows unbounded preceding) t
  from lineitem""",
    "fx_call": """select k, l_suppkey, loc_order, last_order,
    coalesce(max(case when tod < ptod then 1 else 0 end) over (
      partition by k order by loc_order rows unbounded preceding), 0) = 1 xmidnight,
    case when loc_order > 0 and not passing then tod end scheduled_arrival,
    case when loc_order = 0 then tod when loc_order < last_order and not passing
      then cast((tod + 60) % 86400 as int) end scheduled_departure,
    case when passing then tod end scheduled_pass,
    cast(1 + l_suppkey % 20 as varchar(3)) platform
  from (select *, loc_order > 0 and loc_order < last_order and (k + loc_order) % 7 = 0 passing from (
    select k, l_suppkey, loc_order, cast(t % 86400 as int) tod,
      lag(cast(t % 86400 as int)) over (partition by k order by loc_order) ptod,
      max(loc_order) over (partition by k) last_order
    from fx_stop_time) a) b where last_order > 0""",
    "fx_stop": f"""select s.train_uid, s.date_runs_from, s.stp_indicator, c.loc_order, c.xmidnight,
    concat('S', {coded("l_suppkey", 6)}) location,
    c.scheduled_arrival, c.scheduled_departure, c.scheduled_pass, c.platform, c.last_order, c.k
  from fx_call c join fx_schedule s on s.k = c.k where s.stp_indicator <> 'C'""",
    "fx_zschedule": f"""select {train("o_custkey", 1)} train_uid, date_runs_from, date_runs_to,
    days_run, stp_indicator, train_status, speed, k from fx_schedule_all""",
    "fx_zstop": f"""select s.train_uid, s.date_runs_from, s.stp_indicator, c.loc_order, c.xmidnight,
    {code3("floor(l_suppkey / 2)")} location,
    c.scheduled_arrival, c.scheduled_departure, c.scheduled_pass, c.platform, c.last_order, c.k
  from fx_call c join fx_zschedule s on s.k = c.k where s.stp_indicator <> 'C'""",
    "fx_association": f"""select s.train_uid main_train_uid, {train("s.o_custkey", 2)} associated_train_uid,
    s.date_runs_from association_start_date, s.date_runs_to association_end_date, s.days_run association_days,
    case when s.k % 2 = 0 then 'JJ' else 'VV' end association_category,
    case s.k % 4 when 0 then ' ' when 1 then 'S' when 2 then 'N' else 'P' end association_date_ind,
    s.stp_indicator, s.k
  from fx_schedule_all s""",
    "rq_station": f"""select tiploc_code query_id, date '{DATE}' timetable_date, tiploc_code station, 28800 depart
  from fx_station""",
    "rq_nation": f"""select concat('N', cast(nation as varchar(3))) query_id, date '{DATE}' timetable_date,
    min(tiploc_code) station, cast(28800 + nation * 300 as int) depart
  from fx_station group by nation""",
    "rq_night": f"""select query_id, timetable_date, station, cast(depart - 27000 as int) depart from rq_nation""",
    "rq_name": f"""select concat('F', tiploc_code) query_id,
    case s_suppkey % 6 when 0 then lower(tiploc_code) when 1 then lower(substr(station_name, 9, 10))
      when 2 then concat('s', substr(station_name, 2, 17), '  ') when 3 then concat('of ', tiploc_code)
      when 4 then '   ' else concat('nowhere ', tiploc_code) end name
  from fx_station""",
}


def with_views(*names: str, select: str, extra: dict[str, str] | None = None) -> str:
    """``select`` behind the views it needs, in dependency order."""
    views = {**VIEWS, **(extra or {})}
    needed: list[str] = []

    def add(name: str) -> None:
        for other in views:
            if other != name and other not in needed and _mentions(views[name], other):
                add(other)
        if name not in needed:
            needed.append(name)

    for name in names:
        add(name)
    if not needed:
        return select
    return "with " + ",\n".join(f"{n} as ({views[n]})" for n in needed) + f"\n{select}"


def _mentions(sql: str, name: str) -> bool:
    words = set("".join(c if c.isalnum() or c == "_" else " " for c in sql).split())
    return name in words


_STORED: dict[tuple[str, str, str], tuple[str, DataFrame]] = {}


def stored(spark: SparkSession, sf_dir: str, name: str, build) -> DataFrame:
    """A derived table, written once per session and read from there by all queries; again if it was cleared since."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _STORED or not is_there(spark, _STORED[key][0]):
        path = scratch_path(spark, name)
        _STORED[key] = path, write_to(build(), path)
    return _STORED[key][1]


def derived(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A view of :data:`VIEWS` as a Spark table."""

    def build() -> DataFrame:
        files = {s: f"select * from parquet.`{sf_dir}/{s}.parquet`" for s in SOURCES}
        return spark.sql(with_views(name, select=f"select * from {name}", extra=files))

    return stored(spark, sf_dir, name, build)


class Tables:
    """The derived tables under the column names and types the operators read."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def get(self, name: str) -> DataFrame:
        return derived(self.spark, self.sf_dir, name)

    def schedules(self, view: str = "fx_schedule") -> DataFrame:
        return self.get(view).withColumn("days_run", days_run(F.col("days_run")))

    def stops(self, view: str = "fx_stop") -> DataFrame:
        return self.get(view)

    def stations(self) -> DataFrame:
        return self.get("fx_station").withColumnRenamed("crs3", "_3_alpha_code")

    def links(self) -> DataFrame:
        return self.get("fx_link").withColumn("days_of_week", days_run(F.col("days_of_week")))
