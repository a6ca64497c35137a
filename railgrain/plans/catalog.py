"""Every registered query with the SQL that states the same result."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import decoders as D
from ..functions.grid import grid_to_latlon, meridional_arc
from ..functions.timeofday import clock, parse_hhmm, parse_hhmmh
from ..operators import connections as conn
from ..operators import isochron as iso
from ..operators import quality, reach, schedule
from ..operators import stations as st
from ..operators.station_index import find_indexed, write_station_index
from ..session import materialize, scratch_path
from ..sources import layouts as L
from ..sources.archive import MEMBER_SUFFIXES, member_lines, stage_lines
from ..sources.constraints import violations
from ..sources.interchange import read_interchange
from ..sources.links import read_fixed_links
from ..sources.load import LoadRejected, load, load_into, publish, published
from ..sources.naptan import read_naptan
from ..sources.sink import read_tables, write_tables
from ..sources.stations import read_stations
from ..sources.timetable import read_timetable
from . import textfiles as text
from .fixtures import DATE, Tables, coded, stored, with_views
from .reach_sql import LABELS, reach_views

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

DAY = f"date '{DATE}'"


def query(name: str, *views: str, sql: str | None = None, extra: dict[str, str] | None = None):
    def register(build: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: build(Tables(spark, sf_dir))
        if sql is not None:
            SQL[name] = with_views(*views, select=sql, extra=extra)
        return build

    return register


def _joined(column: str) -> F.Column:
    return F.array_join(F.transform(column, lambda x: x.cast("string")), "|", "")


# -- sources -----------------------------------------------------------------------------------------

_TIMES = "scheduled_arrival, scheduled_departure, scheduled_pass, platform"
_HELD = "(stp_indicator = 'C' or k in (select k from {stops}))"


@query("timetable_schedules", "fx_schedule", "fx_stop", sql=f"""
select train_uid, date_runs_from, date_runs_to, days_run, stp_indicator, train_status, speed,
  {coded("k", 8)} train_service_code,
  concat('1A', lpad(cast(k % 100 as varchar(10)), 2, '0')) train_identity,
  case when k % 2 = 0 and stp_indicator <> 'C' then lpad(cast(k % 100000 as varchar(10)), 5, '0') end uic_code,
  case when k % 2 = 0 and stp_indicator <> 'C' then concat('XC', cast(k % 1000000 as varchar(10))) end rsid,
  case when k % 5 = 0 and stp_indicator <> 'C' then concat('TRAIN ', cast(k as varchar(10))) end note
from fx_schedule where {_HELD.format(stops="fx_stop")}""")
def _(t: Tables) -> DataFrame:
    scan = read_timetable(t.spark, text.timetable_text(t))
    return scan.basic_schedule().select(
        "train_uid", "date_runs_from", "date_runs_to",
        F.array_join(F.transform("days_run", lambda d: d.cast("int").cast("string")), "").alias("days_run"),
        "stp_indicator", "train_status", "speed", "train_service_code", "train_identity", "uic_code", "rsid",
        F.rtrim("note").alias("note"))


@query("timetable_stops", "fx_stop", sql=f"""
select train_uid, date_runs_from, stp_indicator, loc_order, xmidnight, location, {_TIMES} from fx_stop""")
def _(t: Tables) -> DataFrame:
    return read_timetable(t.spark, text.timetable_text(t)).stops()


@query("origin_locations", "fx_stop", sql="""
select train_uid, date_runs_from, stp_indicator, loc_order, xmidnight, location, scheduled_departure,
  cast(floor(scheduled_departure / 60) as int) * 60 public_departure, platform, 'TB|  |  |  |  |  ' activity
from fx_stop where loc_order = 0""")
def _(t: Tables) -> DataFrame:
    return read_timetable(t.spark, text.timetable_text(t)).origin_location().select(
        "train_uid", "date_runs_from", "stp_indicator", "loc_order", "xmidnight", "location",
        "scheduled_departure", "public_departure", "platform", _joined("activity").alias("activity"))


@query("intermediate_locations", "fx_stop", sql=f"""
select train_uid, date_runs_from, stp_indicator, loc_order, xmidnight, location, {_TIMES},
  coalesce(cast(floor(scheduled_arrival / 60) as int) * 60, 0) public_arrival
from fx_stop where loc_order > 0 and loc_order < last_order""")
def _(t: Tables) -> DataFrame:
    return read_timetable(t.spark, text.timetable_text(t)).intermediate_location().select(
        "train_uid", "date_runs_from", "stp_indicator", "loc_order", "xmidnight", "location",
        "scheduled_arrival", "scheduled_departure", "scheduled_pass", "platform", "public_arrival")


@query("terminating_locations", "fx_stop", sql="""
select train_uid, date_runs_from, stp_indicator, loc_order, xmidnight, location, scheduled_arrival, platform
from fx_stop where loc_order = last_order""")
def _(t: Tables) -> DataFrame:
    return read_timetable(t.spark, text.timetable_text(t)).terminating_location().select(
        "train_uid", "date_runs_from", "stp_indicator", "loc_order", "xmidnight", "location",
        "scheduled_arrival", "platform")


@query("stops_past_midnight", "fx_stop", sql="""
select train_uid, date_runs_from, stp_indicator, loc_order, max(case when tod < ptod then 1 else 0 end) over (
  partition by k order by loc_order rows unbounded preceding) = 1 xmidnight
from (select *, lag(tod) over (partition by k order by loc_order) ptod from (
  select *, coalesce(scheduled_arrival, scheduled_departure, scheduled_pass) tod from fx_stop) a) b""")
def _(t: Tables) -> DataFrame:
    return read_timetable(t.spark, text.timetable_text(t)).stops().select(
        "train_uid", "date_runs_from", "stp_indicator", "loc_order", "xmidnight")


@query("changes_en_route", "fx_stop", sql="""
select train_uid, date_runs_from, stp_indicator, loc_order, xmidnight, location, 'XX' train_category,
  cast(k % 150 as int) speed, 'EMU' power_type
from fx_stop where loc_order < last_order and (k + loc_order) % 11 = 0""")
def _(t: Tables) -> DataFrame:
    return read_timetable(t.spark, text.timetable_text(t)).changes_en_route().select(
        "train_uid", "date_runs_from", "stp_indicator", "loc_order", "xmidnight", "location",
        "train_category", "speed", "power_type")


@query("location_notes", "fx_stop", sql="""
select train_uid, date_runs_from, stp_indicator, loc_order, xmidnight, 'G' note_type,
  concat('NOTE ', cast(k as varchar(10))) note
from fx_stop where loc_order = 0 and k % 3 = 2""")
def _(t: Tables) -> DataFrame:
    scan = read_timetable(t.spark, text.damaged_timetable_text(t), mode="permissive")
    return scan.location_specific_note().withColumn("note", F.rtrim("note")).drop("errors")


@query("associations", "fx_association", sql="""
select main_train_uid, associated_train_uid, association_start_date, association_end_date, association_days,
  association_category, association_date_ind, 'S000001' association_location, stp_indicator
from fx_association""")
def _(t: Tables) -> DataFrame:
    return read_timetable(t.spark, text.timetable_text(t)).associations().select(
        "main_train_uid", "associated_train_uid", "association_start_date", "association_end_date",
        F.array_join(F.transform("association_days", lambda d: d.cast("int").cast("string")), "")
        .alias("association_days"),
        "association_category", "association_date_ind", "association_location", "stp_indicator")


_PLACE = f"""tiploc_code, '23' capitals_identification, {coded("s_suppkey", 6)} nalco,
  station_name tps_description, crs3 crs_code, substr(station_name, 1, 16) _16_character_description"""
_PLACE_COLUMNS = ["tiploc_code", "capitals_identification", "nalco", "tps_description", "crs_code",
                  "_16_character_description"]


@query("tiploc_inserts", "fx_station", sql=f"select {_PLACE} from fx_station")
def _(t: Tables) -> DataFrame:
    return read_timetable(t.spark, text.timetable_text(t)).tiploc_insert().select(*_PLACE_COLUMNS)


@query("tiploc_amendments", "fx_station", sql=f"""
select {_PLACE}, substr(concat('N', tiploc_code), 1, 7) new_tiploc from fx_station""")
def _(t: Tables) -> DataFrame:
    return read_timetable(t.spark, text.timetable_text(t)).tiploc_amend().select(*_PLACE_COLUMNS, "new_tiploc")


@query("tiploc_deletions", "fx_station", sql="select tiploc_code from fx_station")
def _(t: Tables) -> DataFrame:
    return read_timetable(t.spark, text.timetable_text(t)).tiploc_delete()


@query("ztrain_schedules", "fx_zschedule", "fx_zstop", sql=f"""
select train_uid, date_runs_from, date_runs_to, stp_indicator,
  case when k % 2 = 0 and stp_indicator <> 'C' then ' ' end applicable_timetable_code
from fx_zschedule where {_HELD.format(stops="fx_zstop")}""")
def _(t: Tables) -> DataFrame:
    scan = read_timetable(t.spark, text.ztrain_text(t), "ztrain")
    return scan.basic_schedule().select("train_uid", "date_runs_from", "date_runs_to", "stp_indicator",
                                        "applicable_timetable_code")


@query("ztrain_stops", "fx_zstop", sql=f"""
select train_uid, date_runs_from, stp_indicator, loc_order, xmidnight, location, {_TIMES} from fx_zstop""")
def _(t: Tables) -> DataFrame:
    return read_timetable(t.spark, text.ztrain_text(t), "ztrain").stops()


@query("station_details", "fx_station", sql="""
select station_name, cate_type, tiploc_code, crs3 subsidiary_3_alpha_code, crs3 _3_alpha_code, easting,
  ' ' estimated, northing, change_time from fx_station""")
def _(t: Tables) -> DataFrame:
    return read_stations(t.spark, text.station_text(t)).station_detail()


@query("station_aliases", "fx_alias", sql="select station_name, alias_name from fx_alias")
def _(t: Tables) -> DataFrame:
    return read_stations(t.spark, text.station_text(t)).station_alias()


@query("routeing_groups", "fx_station", sql="""
select concat('GROUP ', cast(s_suppkey as varchar(10))) group_name,
  concat(crs3, '|', crs3, '|XYZ|   |   |   |   |   |   |   ') station from fx_station""")
def _(t: Tables) -> DataFrame:
    return read_stations(t.spark, text.station_text(t)).routeing_groups().withColumn(
        "station", _joined("station"))


@query("fixed_links", "fx_link", sql="""
select mode, origin, destination, link_time, start_time, end_time, 4 priority, start_date, end_date,
  days_of_week from fx_link""")
def _(t: Tables) -> DataFrame:
    links = read_fixed_links(t.spark, text.link_text(t))
    return links.withColumn("days_of_week", F.array_join(
        F.transform("days_of_week", lambda d: d.cast("int").cast("string")), ""))


_INTERCHANGE = """select crs3 station_code, 'XC' arriving_train_toc,
  case when s_suppkey % 2 = 0 then 'GW' else '' end departing_train_toc,
  change_time minimum_interchange_time, station_name comments from fx_station"""


@query("interchange_times", "fx_station", sql=_INTERCHANGE)
def _(t: Tables) -> DataFrame:
    return read_interchange(t.spark, text.interchange_text(t))


@query("rail_references", "fx_station", sql="""
select concat('9100', tiploc_code) atco, tiploc_code tiploc, crs3 crs, concat(station_name, ', MAIN') stationname,
  easting * 10 easting, northing * 10 northing, 'U' gridtype from fx_station""")
def _(t: Tables) -> DataFrame:
    return read_naptan(t.spark, text.rail_reference_archives(t)).drop("stationnamelang")


_CHANGES = "loc_order < last_order and (k + loc_order) % 11 = 0"


def _train_lines(schedules: str, stops: str) -> str:
    """Lines of a timetable's trains: schedules, their extra records and notes, stops and changes."""
    return f"""(select count(*) from {schedules}) + (select count(*) from {stops})
    + (select count(*) from {stops} where {_CHANGES}) + (select count(*) from {schedules} where k % 2 = 0 and k in (select k from {stops}))
    + (select count(*) from {schedules} where k % 5 = 0 and k in (select k from {stops}))"""


@query("archive_members", "fx_station", "fx_alias", "fx_link", "fx_association", "fx_stop", "fx_zstop", "fx_zschedule", "archives", sql=f"""
select member, cast(n_lines as bigint) n_lines, cast(n_chars as bigint) n_chars from (
  select 'mca' member, n n_lines, n * 80 n_chars from (select {_train_lines("fx_schedule", "fx_stop")}
    + 3 * stations + (select count(*) from fx_association) + 2 * archives n from archives) m
  union all select 'ztr', n, n * 80 from (select {_train_lines("fx_zschedule", "fx_zstop")} + 2 * archives n from archives) z
  union all select 'msn', n, n * 82 from (
    select 2 * stations + (select count(*) from fx_alias) + 2 * archives n from archives) s
  union all select 'tsi', count(*), sum(length(concat(crs3, ',XC,  ,', cast(change_time as varchar(10)), ',', station_name))) from fx_station
  union all select 'alf', count(*), sum(length(concat('M=', mode, ',O=', origin, ',D=', destination, ',T=999,T=',
    cast(link_time as varchar(10)), ',S=0000,E=0000,P=4,R=', days_of_week))
    + case when start_date is null then 0 else 13 end + case when end_date is null then 0 else 13 end) from fx_link
) l""", extra={"archives": f"""select count(*) stations,
  greatest(1, cast(floor(count(*) / {text._ARCHIVE_STATIONS}) as int)) archives from fx_station"""})
def _(t: Tables) -> DataFrame:
    lines = member_lines(text.whole_archives(t), MEMBER_SUFFIXES)
    return lines.groupBy("member").agg(F.count(F.lit(1)).alias("n_lines"),
                                       F.sum(F.length("value")).alias("n_chars"))


@query("archived_stations", "fx_station", sql="""
select tiploc_code, station_name, crs3 _3_alpha_code, easting, northing from fx_station""")
def _(t: Tables) -> DataFrame:
    staged = stage_lines(member_lines(text.station_archives(t), ("msn", "tsi")))
    return read_stations(t.spark, staged["msn"]).station_detail().select(
        "tiploc_code", "station_name", "_3_alpha_code", "easting", "northing")


@query("selective_load", "fx_station", sql=_INTERCHANGE)
def _(t: Tables) -> DataFrame:
    return load(t.spark, text.whole_archives(t), skip={"mca", "ztr", "msn", "alf"})["tsi.tsi"]


def _count(name: str, view: str, where: str = "true") -> str:
    return f"select '{name}' table_name, count(*) n_rows from {view} where {where}"


def _loaded_trains(source: str, schedules: str, stops: str) -> list[str]:
    return [
        _count(f"{source}.basic_schedule", schedules, f"stp_indicator = 'C' or k in (select k from {stops})"),
        _count(f"{source}.origin_location", stops, "loc_order = 0"),
        _count(f"{source}.intermediate_location", stops, "loc_order > 0 and loc_order < last_order"),
        _count(f"{source}.terminating_location", stops, "loc_order = last_order"),
        _count(f"{source}.changes_en_route", stops, _CHANGES), _count(f"{source}.location_specific_note", stops, "false"),
    ]


@query("load_archives", "fx_schedule", "fx_stop", "fx_zschedule", "fx_zstop", "fx_station", "fx_association", "fx_alias", "fx_link",
       sql=" union all ".join([
           *_loaded_trains("mca", "fx_schedule", "fx_stop"), *_loaded_trains("ztr", "fx_zschedule", "fx_zstop"),
           _count("mca.associations", "fx_association"), _count("ztr.associations", "fx_association", "false"),
           *(_count(f"mca.tiploc_{n}", "fx_station") for n in ("insert", "amend", "delete")),
           *(_count(f"ztr.tiploc_{n}", "fx_station", "false") for n in ("insert", "amend", "delete")),
           _count("msn.station_detail", "fx_station"), _count("msn.station_alias", "fx_alias"), _count("msn.routeing_groups", "fx_station"),
           _count("tsi.tsi", "fx_station"), _count("alf.alf", "fx_link"), _count("naptan.railreferences", "fx_station")]))
def _(t: Tables) -> DataFrame:
    """All members of all archives and the rail references, checked and published; row counts of what readers then see."""
    found = load_into(t.spark, scratch_path(t.spark, "load"), text.whole_archives(t), naptan=text.rail_reference_archives(t))
    each = (df.select(F.lit(name).alias("table_name")) for name, df in found.items())
    names = t.spark.createDataFrame([(name,) for name in found], "table_name string")
    counts = reduce(DataFrame.unionAll, each).groupBy("table_name").agg(F.count(F.lit(1)).alias("n"))
    return names.join(counts, "table_name", "left").select("table_name", F.coalesce("n", F.lit(0)).alias("n_rows"))


_SCHEDULE_KEY = "concat(train_uid, ' / ', cast(date_runs_from as varchar(10)), ' / ', stp_indicator)"
_KEPT = "select distinct train_uid, date_runs_from, stp_indicator from fx_schedule_all where speed is not null"


def _lost(name: str, where: str) -> str:
    return f"""select 'mca.{name}' table_name, 'no schedule' rule, {_SCHEDULE_KEY} key, count(*) n from fx_stop s
  where {where} and not exists (select 1 from kept p where p.train_uid = s.train_uid and p.date_runs_from = s.date_runs_from
    and p.stp_indicator = s.stp_indicator) group by train_uid, date_runs_from, stp_indicator"""


_CALLS = {"origin_location": "loc_order = 0", "intermediate_location": "loc_order > 0 and loc_order < last_order",
          "terminating_location": "loc_order = last_order"}


@query("load_constraints", "fx_schedule_all", "fx_stop", "fx_station", "kept", extra={"kept": _KEPT}, sql=" union all ".join([
    f"""select 'mca.basic_schedule' table_name, 'repeated key' rule, {_SCHEDULE_KEY} key, count(*) n from fx_schedule_all
  where speed is not null group by train_uid, date_runs_from, stp_indicator having count(*) > 1""",
    *(_lost(name, where) for name, where in _CALLS.items()),
    """select 'naptan.railreferences', 'repeated key', tiploc_code, 2 from fx_station where s_suppkey % 3 = 0""",
    """select 'naptan.railreferences', 'null key', 'null', count(*) from fx_station where s_suppkey % 7 = 0 having count(*) > 0"""]))
def _(t: Tables) -> DataFrame:
    """Schedules with repeated keys, and without some that calls belong to; references with repeated and null keys."""
    station = t.get("fx_station").select(F.col("tiploc_code").alias("tiploc"), "s_suppkey")
    references = station.unionAll(station.filter("s_suppkey % 3 = 0")).unionAll(
        station.filter("s_suppkey % 7 = 0").withColumn("tiploc", F.lit(None).cast("string")))
    tables = {"mca.basic_schedule": t.schedules("fx_schedule_all").filter("speed is not null"), "naptan.railreferences": references}
    tables |= {f"mca.{name}": t.stops().filter(where) for name, where in _CALLS.items()}
    base = scratch_path(t.spark, "load")
    try:
        publish(t.spark, tables, base)
    except LoadRejected as rejected:
        assert not published(t.spark, base)
        return rejected.violations.withColumnRenamed("table", "table_name")
    return violations(tables).withColumnRenamed("table", "table_name")


#: Tables of a timetable file with a key and a date column of each; the tenth, notes at stops, is empty in legal files.
_SINK = {
    "basic_schedule": ("train_uid", "date_runs_from"), "origin_location": ("train_uid", "date_runs_from"),
    "intermediate_location": ("train_uid", "date_runs_from"), "terminating_location": ("train_uid", "date_runs_from"),
    "changes_en_route": ("train_uid", "date_runs_from"), "location_specific_note": ("train_uid", "date_runs_from"),
    "associations": ("main_train_uid", "association_start_date"), "tiploc_insert": ("tiploc_code", None),
    "tiploc_amend": ("tiploc_code", None), "tiploc_delete": ("tiploc_code", None),
}


def _sink_sql(name: str, view: str, where: str = "true") -> str:
    key, day = _SINK[name]
    return (f"select '{name}' name, count(*) n_rows, min({day or 'cast(null as date)'}) first_day, "
            f"count(distinct {key}) n_keys from {view} where {where}")


@query("typed_sink", "fx_schedule", "fx_stop", "fx_station", "fx_association", sql=" union all ".join([
    _sink_sql("basic_schedule", "fx_schedule", "stp_indicator = 'C' or k in (select k from fx_stop)"),
    _sink_sql("origin_location", "fx_stop", "loc_order = 0"),
    _sink_sql("intermediate_location", "fx_stop", "loc_order > 0 and loc_order < last_order"),
    _sink_sql("terminating_location", "fx_stop", "loc_order = last_order"),
    _sink_sql("changes_en_route", "fx_stop", "loc_order < last_order and (k + loc_order) % 11 = 0"),
    _sink_sql("associations", "fx_association"),
    *(_sink_sql(f"tiploc_{n}", "fx_station") for n in ("insert", "amend", "delete")),
]))
def _(t: Tables) -> DataFrame:
    base = scratch_path(t.spark, "sink")
    write_tables(read_timetable(t.spark, text.timetable_text(t)).tables(), base)
    parts = None
    for name, df in read_tables(t.spark, base, list(_SINK)).items():
        key, day = _SINK[name]
        part = df.select(F.lit(name).alias("name"), F.col(key).alias("key"),
                         (F.col(day) if day else F.lit(None).cast("date")).alias("day"))
        parts = part if parts is None else parts.union(part)
    return parts.groupBy("name").agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("day").alias("first_day"), F.countDistinct("key").alias("n_keys"))


# -- decoders ----------------------------------------------------------------------------------------


@query("decode_dates", sql="""
select o_orderkey, d ddmmyy, d yymmdd, d yymmdd_1956, d ddmmyyyy, date '9999-12-31' open_ended,
  cast(case when (o_orderkey % 100) >= 60 then 1900 else 2000 end + o_orderkey % 100 as int) year_of_two_digits
from (select o_orderkey, cast(o_orderdate as date) d from orders) o""")
def _(t: Tables) -> DataFrame:
    d, two = F.col("d"), F.lpad((F.col("o_orderkey") % 100).cast("string"), 2, "0")
    base = F.concat(F.lpad((F.year(d) - 1956).cast("string"), 2, "0"), F.date_format(d, "MMdd"))
    orders = t.spark.read.parquet(f"{t.sf_dir}/orders.parquet").select(
        "o_orderkey", F.col("o_orderdate").cast("date").alias("d"))
    return orders.select(
        "o_orderkey",
        D.date_ddmmyy(F.date_format(d, "ddMMyy")).alias("ddmmyy"),
        D.date_yymmdd(F.date_format(d, "yyMMdd")).alias("yymmdd"),
        D.date_yymmdd_1956(base).alias("yymmdd_1956"),
        D.date_ddmmyyyy(F.date_format(d, "dd/MM/yyyy")).alias("ddmmyyyy"),
        D.date_yymmdd(F.lit("999999")).alias("open_ended"),
        F.year(D.date_yymmdd(F.concat(two, F.lit("0228")))).alias("year_of_two_digits"))


@query("decode_times", sql="""
select o_orderkey, cast((o_orderkey % 1440) * 60 as int) hhmm,
  cast((o_orderkey % 1440) * 60 + (o_orderkey % 2) * 30 as int) hhmmh,
  concat(lpad(cast(cast(floor((o_orderkey % 1440) / 60) as int) as varchar(10)), 2, '0'), ':',
    lpad(cast(o_orderkey % 60 as varchar(10)), 2, '0'), ':00') shown
from orders""")
def _(t: Tables) -> DataFrame:
    minute = F.col("o_orderkey") % 1440
    hhmm = F.concat(F.lpad(F.floor(minute / 60).cast("string"), 2, "0"),
                    F.lpad((minute % 60).cast("string"), 2, "0"))
    half = F.when(F.col("o_orderkey") % 2 == 1, "H").otherwise(" ")
    return t.spark.read.parquet(f"{t.sf_dir}/orders.parquet").select(
        "o_orderkey", parse_hhmm(hhmm).alias("hhmm"), parse_hhmmh(F.concat(hhmm, half)).alias("hhmmh"),
        clock(parse_hhmm(hhmm)).alias("shown"))


@query("decode_days", "fx_schedule_all", sql="""
select k, substr(days_run, 1, 1) = '1' monday, substr(days_run, 6, 1) = '1' saturday,
  substr(days_run, 7, 1) = '1' sunday from fx_schedule_all""")
def _(t: Tables) -> DataFrame:
    days = D.days_run(F.col("days_run"))
    return t.get("fx_schedule_all").select("k", days[0].alias("monday"), days[5].alias("saturday"),
                                           days[6].alias("sunday"))


@query("decode_chunks", "fx_station", sql="""
select tiploc_code, concat(substr(station_name, 1, 2), '|', substr(station_name, 3, 2), '|',
    substr(station_name, 5, 2), '|', substr(station_name, 7, 2), '|', substr(station_name, 9, 2), '|',
    substr(station_name, 11, 2)) activity,
  concat(substr(station_name, 1, 3), '|', substr(station_name, 5, 3), '|', substr(station_name, 9, 3), '|',
    substr(station_name, 13, 3), '|', rpad(substr(station_name, 17, 3), 3, ' '),
    '|   |   |   |   |   ') routeing
from fx_station""")
def _(t: Tables) -> DataFrame:
    name = F.rpad("station_name", 40, " ")
    return t.get("fx_station").select(
        "tiploc_code", F.array_join(D.activity(name), "|").alias("activity"),
        F.array_join(D.routeing_group(name), "|").alias("routeing"))


@query("decode_numbers", sql="""
select o_orderkey, cast(o_orderkey as int) number, case when o_orderkey % 3 > 0 then cast(o_orderkey as int) end optional,
  case when o_orderkey % 3 = 0 then 1 else 0 end rejected, cast(o_orderkey as varchar(10)) padded
from orders""")
def _(t: Tables) -> DataFrame:
    digits = F.col("o_orderkey").cast("string")
    blank = F.when(F.col("o_orderkey") % 3 > 0, digits).otherwise("   ")
    return t.spark.read.parquet(f"{t.sf_dir}/orders.parquet").select(
        "o_orderkey", D.decode("int", F.lpad(digits, 10, " ")).alias("number"),
        D.decode("int?", blank).alias("optional"), D.rejected("int", blank).cast("int").alias("rejected"),
        D.decode("text", F.rpad(digits, 10, " ")).alias("padded"))


@query("fixed_width_slices", "fx_stop", sql="""
select substr(line, 3, 7) location, substr(line, 1, 2) record_type, count(*) n from (
  select concat(case when loc_order = 0 then 'LO' when loc_order = last_order then 'LT' else 'LI' end, location) line
  from fx_stop) l group by 1, 2""")
def _(t: Tables) -> DataFrame:
    from ..sources.layouts import Field
    from ..sources.records import columns

    lines = t.spark.read.text(text.timetable_text(t)).select(F.col("value").alias("line"))
    layout = [Field("location", 3, 7), Field("record_type", 1, 2)]
    return lines.filter(F.col("line").rlike("^L[OIT]")).select(*columns(F.col("line"), layout)).groupBy(
        "location", "record_type").agg(F.count(F.lit(1)).alias("n"))


# -- checks ------------------------------------------------------------------------------------------


@query("timetable_sequence_check", "fx_stop", sql="""
select codes, count(*) n from (
  select string_agg(code, '' order by loc_order) codes, k from (
    select k, loc_order, concat(
      case when loc_order = 0 then concat('BS', case when k % 2 = 0 then 'BX' else '' end,
        case when k % 5 = 0 then 'TN' else '' end) else '' end,
      case when loc_order = 0 then 'LO' when loc_order < last_order then 'LI' when k % 3 = 0 then '' else 'LT' end,
      case when k % 3 = 2 and loc_order = 0 then 'LN' else '' end,
      case when loc_order < last_order and (k + loc_order) % 11 = 0 then 'CR' else '' end) code
    from fx_stop where k % 3 <> 1) c group by k) t
group by codes""")
def _(t: Tables) -> DataFrame:
    scan = read_timetable(t.spark, text.damaged_timetable_text(t), mode="permissive")
    # the last train of a file is followed by the end record
    return quality.timetable_sequence(scan).groupBy(
        F.regexp_replace("codes", "ZZ$", "").alias("codes")).agg(F.count(F.lit(1)).alias("n"))


@query("station_sequence_check", "fx_station", "fx_alias", sql="""
select before, after, sum(n) n from (
  select 'A' before, 'V' after, count(*) n from fx_station
  union all select 'V', 'A', count(*) - count(distinct floor(s_suppkey / 20000)) from fx_station
  union all select 'V', 'L', count(distinct floor(s_suppkey / 20000)) from fx_alias) v
group by before, after""")
def _(t: Tables) -> DataFrame:
    scan = read_stations(t.spark, text.station_text(t, damaged=True), mode="permissive")
    return quality.station_sequence(scan).groupBy("before", "after").agg(F.sum("count").alias("n"))


@query("field_check", "fx_station", sql="""
select tiploc_code, case s_suppkey % 4 when 0 then 'easting' else 'estimated' end errors
from fx_station where s_suppkey % 4 in (0, 1)""")
def _(t: Tables) -> DataFrame:
    scan = read_stations(t.spark, text.station_text(t, damaged=True), mode="permissive")
    return quality.invalid_fields(scan.station_detail()).select(
        "tiploc_code", F.array_join("errors", ",").alias("errors"))


def _spoiled(kind: str, view: str, layout, number: str, where: str = "true", id: str = "train_uid", but=()) -> str:
    return f"""select '{kind}' kind, id, errors, count(*) n from (
  select {id} id, {text.spoiled_field(layout, number, but)} errors from {view} where {where}) {kind} where errors is not null group by id, errors"""


_FOREIGN = "select '{kind}' kind, {id} id, 'not ascii' errors, count(*) n from {view} where s_suppkey % {step} = 0 group by {id}"


@query("field_checks", "fx_schedule", "fx_stop", "fx_association", "fx_station", "fx_alias", "fx_link", sql=" union all ".join([
    f"""select 'schedule' kind, id, errors, count(*) n from (select train_uid id, concat_ws(',',
  {text.spoiled_field(L.BASIC_SCHEDULE, "k", text.SCHEDULE_KEY)},
  case when k % 2 = 0 and k in (select k from fx_stop) then {text.spoiled_field(L.EXTRA_DETAILS, "k")} end,
  case when k % 5 = 0 and k in (select k from fx_stop) then {text.spoiled_field(L.NOTE, "k")} end) errors
  from fx_schedule where stp_indicator = 'C' or k in (select k from fx_stop)) sch where errors <> '' group by id, errors""",
    _spoiled("origin", "fx_stop", L.ORIGIN_LOCATION, "k + loc_order", "loc_order = 0"),
    _spoiled("intermediate", "fx_stop", L.INTERMEDIATE_LOCATION, "k + loc_order", "loc_order > 0 and loc_order < last_order"),
    _spoiled("terminating", "fx_stop", L.TERMINATING_LOCATION, "k + loc_order", "loc_order = last_order"),
    _spoiled("change", "fx_stop", L.CHANGES_EN_ROUTE, "k + loc_order", "loc_order < last_order and (k + loc_order) % 11 = 0"),
    _spoiled("association", "fx_association", L.ASSOCIATIONS, "k", id="main_train_uid"),
    *(_FOREIGN.format(kind=f"tiploc_{n}", id="tiploc_code", view="fx_station", step=2) for n in ("insert", "amend", "delete")),
    _spoiled("station", "fx_station", L.STATION_DETAIL, "s_suppkey", id="tiploc_code"),
    _FOREIGN.format(kind="alias", id="alias_name", view="fx_alias", step=4),
    _FOREIGN.format(kind="group", id="concat('GROUP ', cast(s_suppkey as varchar(10)))", view="fx_station", step=4),
    """select 'link', origin, case link_time % 5 when 0 then 'unknown key' when 1 then 'mode' when 2 then 'start_time' else 'end_date' end, count(*)
  from fx_link where link_time % 5 < 4 group by 2, 3""",
    """select 'interchange', crs3, case s_suppkey % 3 when 0 then 'not five fields' else 'minimum_interchange_time' end, count(*)
  from fx_station where s_suppkey % 3 < 2 group by 2, 3"""]))
def _(t: Tables) -> DataFrame:
    """What a permissive load finds wrong in records of every layout, each checked field spoiled in turn."""
    trains = read_timetable(t.spark, text.spoiled_timetable_text(t), mode="permissive").tables()
    places = read_stations(t.spark, text.spoiled_station_text(t), mode="permissive").tables()
    found = {
        "schedule": (trains["basic_schedule"], "train_uid"), "origin": (trains["origin_location"], "train_uid"),
        "intermediate": (trains["intermediate_location"], "train_uid"), "terminating": (trains["terminating_location"], "train_uid"),
        "change": (trains["changes_en_route"], "train_uid"), "association": (trains["associations"], "main_train_uid"),
        **{n: (trains[n], "tiploc_code") for n in ("tiploc_insert", "tiploc_amend", "tiploc_delete")},
        "station": (places["station_detail"], "tiploc_code"), "alias": (places["station_alias"], "alias_name"),
        "group": (places["routeing_groups"], "group_name"),
        "link": (read_fixed_links(t.spark, text.spoiled_link_text(t), "permissive"), "origin"),
        "interchange": (read_interchange(t.spark, text.spoiled_interchange_text(t), "permissive"), "station_code"),
    }
    rows = (quality.invalid_fields(df).select(F.lit(kind).alias("kind"), F.col(id).alias("id"), F.array_join("errors", ",").alias("errors"))
            for kind, (df, id) in found.items())
    return reduce(DataFrame.unionAll, rows).groupBy("kind", "id", "errors").agg(F.count(F.lit(1)).alias("n"))


@query("duplicate_key_check", "fx_schedule_all", sql="""
select train_uid, date_runs_from, stp_indicator, count(*) count from fx_schedule_all
group by train_uid, date_runs_from, stp_indicator having count(*) > 1""")
def _(t: Tables) -> DataFrame:
    return quality.duplicate_keys(t.get("fx_schedule_all"), schedule.KEY)


@query("orphan_stop_check", "fx_stop", "fx_schedule", sql="""
select train_uid, date_runs_from, stp_indicator, loc_order from fx_stop s
where not exists (select 1 from fx_schedule d where d.speed is not null and d.train_uid = s.train_uid
  and d.date_runs_from = s.date_runs_from and d.stp_indicator = s.stp_indicator)""")
def _(t: Tables) -> DataFrame:
    return quality.orphan_stops(t.stops(), t.schedules().filter("speed is not null")).select(
        "train_uid", "date_runs_from", "stp_indicator", "loc_order")


# -- timetables --------------------------------------------------------------------------------------


def _serving(schedules: str, offset: int) -> str:
    day, dow = (f"date '{DATE - dt.timedelta(days=offset)}'", (DATE - dt.timedelta(days=offset)).isoweekday())
    return f"""select train_uid, date_runs_from, stp_indicator from (
    select *, rank() over (partition by train_uid order by stp_indicator) pos from {schedules}
    where date_runs_from <= {day} and date_runs_to >= {day} and substr(days_run, {dow}, 1) = '1') s
  where pos = 1"""


def _timetable(prefix: str) -> str:
    stops = "fx_stop" if prefix == "m" else "fx_zstop"
    place, join = ("s.location", "") if prefix == "m" else (
        "t.tiploc_code", "join fx_station t on substr(s.location, 1, 3) = t.crs3")
    half = lambda serving, flag: f"""select {DAY} timetable_date, s.train_uid, s.stp_indicator, s.loc_order,
    s.xmidnight, {place} location, s.scheduled_arrival, s.scheduled_departure, s.scheduled_pass, s.platform
  from {stops} s join {serving} d on d.train_uid = s.train_uid and d.date_runs_from = s.date_runs_from
    and d.stp_indicator = s.stp_indicator {join} where {flag} s.xmidnight"""
    return f"{half(prefix + '_today', 'not')} union all {half(prefix + '_before', '')}"


TIMETABLES = {
    "m_today": _serving("fx_schedule", 0), "m_before": _serving("fx_schedule", 1),
    "z_today": _serving("fx_zschedule", 0), "z_before": _serving("fx_zschedule", 1),
    "full_tt": _timetable("m"), "ztrain_tt": _timetable("z"),
    "day_tt": "select * from full_tt union all select * from ztrain_tt",
}


@query("schedules_in_force", "m_today", sql=f"select {DAY} service_date, m_today.* from m_today", extra=TIMETABLES)
def _(t: Tables) -> DataFrame:
    return schedule.schedules_on(t.schedules(), [DATE])


_YEAR = [dt.date(1998, 1, 1) + dt.timedelta(days=i) for i in range(365)]


@query("service_days", "fx_schedule", sql="""
select train_uid, date_runs_from, stp_indicator, count(*) n_days, min(d) first_day, max(d) last_day from (
  select s.*, d, min(stp_indicator) over (partition by train_uid, d) lowest
  from fx_schedule s join (select cast(date '1998-01-01' + i * interval '1' day as date) d from range(365) r(i)) y
    on d between date_runs_from and date_runs_to and substr(days_run, cast(isodow(d) as int), 1) = '1') x
where stp_indicator = lowest group by train_uid, date_runs_from, stp_indicator""")
def _(t: Tables) -> DataFrame:
    on = schedule.calendar_dates("days", _YEAR)
    count = F.aggregate("days", F.lit(0).cast("long"), lambda n, word: n + F.bit_count(word))
    return schedule.service_calendar(t.schedules(), _YEAR).select(
        *schedule.KEY, count.alias("n_days"), F.array_min(on).alias("first_day"), F.array_max(on).alias("last_day"))


@query("train_timetables", "fx_schedule", "fx_stop", "fx_station", sql=f"""
select {DAY} timetable_date, d.train_uid, d.stp_indicator, s.loc_order, s.xmidnight, s.location,
  t.station_name, s.scheduled_arrival, s.scheduled_departure, s.scheduled_pass, s.platform
from (select *, row_number() over (partition by train_uid order by stp_indicator, date_runs_from desc) pos
  from fx_schedule where date_runs_from <= {DAY} and date_runs_to >= {DAY}
    and substr(days_run, {DATE.isoweekday()}, 1) = '1') d
join (select distinct train_uid, date_runs_from, stp_indicator, loc_order, xmidnight, location, {_TIMES}
  from fx_stop) s on d.train_uid = s.train_uid and d.date_runs_from = s.date_runs_from
  and d.stp_indicator = s.stp_indicator
left join fx_station t on t.tiploc_code = s.location
where d.pos = 1""")
def _(t: Tables) -> DataFrame:
    trains = t.schedules().select("train_uid", F.lit(DATE).alias("timetable_date"))
    return schedule.train_timetable(trains, t.schedules(), t.stops(), t.stations())


@query("full_timetable", "full_tt", sql="select * from full_tt", extra=TIMETABLES)
def _(t: Tables) -> DataFrame:
    return schedule.full_timetable(t.schedules(), t.stops(), [DATE])


@query("ztrain_timetable", "ztrain_tt", sql="select * from ztrain_tt", extra=TIMETABLES)
def _(t: Tables) -> DataFrame:
    return schedule.full_timetable(t.schedules("fx_zschedule"), t.stops("fx_zstop"), [DATE],
                                   crs_stations=t.stations())


def _day_timetable(t: Tables) -> DataFrame:
    return schedule.day_timetable((t.schedules(), t.stops()),
                                  (t.schedules("fx_zschedule"), t.stops("fx_zstop")), t.stations(), [DATE])


@query("day_timetable", "day_tt", sql="select * from day_tt", extra=TIMETABLES)
def _(t: Tables) -> DataFrame:
    return _day_timetable(t)


def day_table(t: Tables) -> DataFrame:
    """The day's timetable as a stored table."""
    return stored(t.spark, t.sf_dir, "day_timetable", lambda: _day_timetable(t))


# -- connections -------------------------------------------------------------------------------------


def _direct_sql(order: str) -> str:
    return f"""select query_id, location, scheduled_arrival earliest_arrival, train_uid from (
    select b.query_id, a.location, a.scheduled_arrival, a.train_uid,
      rank() over (partition by b.query_id, a.location order by {order}) pos
    from (select r.query_id, d.train_uid, d.loc_order, d.xmidnight from day_tt d join rq_station r
        on d.location = r.station and d.timetable_date = r.timetable_date and d.scheduled_departure > r.depart) b
      join day_tt a on a.train_uid = b.train_uid and a.loc_order > b.loc_order and a.xmidnight = b.xmidnight
    where a.scheduled_arrival is not null) v where pos = 1"""


CONNECTIONS = {
    **TIMETABLES,
    "both_links": """select distinct * from (
    select mode, origin from_code, destination to_code, link_time, start_time, end_time, start_date, end_date,
      days_of_week from fx_link
    union all select mode, destination, origin, link_time, start_time, end_time, start_date, end_date,
      days_of_week from fx_link) l""",
    "by_train": _direct_sql("a.xmidnight, a.scheduled_arrival"),
    "by_link": f"""select r.query_id, t.tiploc_code location,
    max(cast((r.depart + l.link_time * 60) % 86400 as int)) earliest_arrival, substr(l.mode, 1, 6) train_uid
  from rq_station r join fx_station o on o.tiploc_code = r.station join both_links l on l.from_code = o.crs3
    join fx_station t on t.crs3 = l.to_code
  where substr(l.days_of_week, {DATE.isoweekday()}, 1) = '1'
    and coalesce({DAY} between l.start_date and l.end_date, true)
    and r.depart between l.start_time and l.end_time and (r.depart + l.link_time * 60) % 86400 > r.depart
  group by r.query_id, t.tiploc_code, substr(l.mode, 1, 6)""",
}


@query("direct_connections", "by_train", sql="select * from by_train", extra=CONNECTIONS)
def _(t: Tables) -> DataFrame:
    return conn.direct_connections(day_table(t), t.get("rq_station"))


@query("direct_connections_by_time", "by_train_time", sql="select * from by_train_time",
       extra={**CONNECTIONS, "by_train_time": _direct_sql("a.scheduled_arrival")})
def _(t: Tables) -> DataFrame:
    return conn.direct_connections(day_table(t), t.get("rq_station"), order_by_time=True)


@query("link_connections", "by_link", sql="select * from by_link", extra=CONNECTIONS)
def _(t: Tables) -> DataFrame:
    return conn.link_connections(t.links(), t.stations(), t.get("rq_station"))


@query("all_connections", "by_train", "by_link", extra=CONNECTIONS,
       sql="select * from by_train union select * from by_link")
def _(t: Tables) -> DataFrame:
    return conn.connections(day_table(t), t.links(), t.stations(), t.get("rq_station"))


@query("earliest_departures", "fx_stop", "fx_station", sql="""
select s.train_uid, s.date_runs_from, s.loc_order, s.location, s.scheduled_arrival arrival,
  case when (scheduled_arrival + change_time * 60) % 86400 < scheduled_arrival then scheduled_arrival
    else coalesce(cast((scheduled_arrival + change_time * 60) % 86400 as int), scheduled_arrival) end
    earliest_departure
from fx_stop s left join fx_station t on t.tiploc_code = s.location where s.scheduled_arrival is not null""")
def _(t: Tables) -> DataFrame:
    arrivals = t.stops().filter("scheduled_arrival is not null").select(
        "train_uid", "date_runs_from", "loc_order", "location", F.col("scheduled_arrival").alias("arrival"))
    return conn.earliest_departure(arrivals, t.stations())


# -- reachability and isochrons ----------------------------------------------------------------------


#: Rounds the SQL states, which has no loop; at the checked sizes no arrival improves after the sixth.
_SQL_ROUNDS = 10


def _reach(requests: str, by_time: bool = False) -> dict[str, str]:
    return {**CONNECTIONS, **reach_views(requests, DATE, _SQL_ROUNDS, by_time)}


_DAYTIME = _reach("rq_nation")


def _labels(t: Tables, requests: str = "rq_nation", **options) -> DataFrame:
    return reach.reachable(day_table(t), t.links(), t.stations(), t.get(requests), **options)


def _path_text(df: DataFrame) -> DataFrame:
    return df.withColumn("path", F.array_join("path", ">"))


@query("reachable", "labels", sql=f"select {LABELS} from labels", extra=_DAYTIME)
def _(t: Tables) -> DataFrame:
    return _path_text(_labels(t))


@query("reachable_at_night", "labels", sql=f"select {LABELS} from labels", extra=_reach("rq_night"))
def _(t: Tables) -> DataFrame:
    return _path_text(_labels(t, "rq_night"))


@query("reachable_by_time", "labels", sql=f"select {LABELS} from labels", extra=_reach("rq_night", True))
def _(t: Tables) -> DataFrame:
    return _path_text(_labels(t, "rq_night", order_by_time=True))


@query("reachable_named", "labels", "fx_station", extra=_DAYTIME, sql="""
select query_id, location, station_name, earliest_arrival, earliest_departure, path
from labels join fx_station on tiploc_code = location""")
def _(t: Tables) -> DataFrame:
    return _path_text(reach.reachable_named(_labels(t), t.stations()))


_ISOCHRON = {
    **_DAYTIME,
    "iso": """select query_id, location, floor((earliest_arrival - depart) / 3600)
      + floor(((earliest_arrival - depart) % 3600) / 60) / 60.0 delay,
    easting * 100 - 1000000 easting, northing * 100 - 6000000 northing
  from labels join fx_station on tiploc_code = location""",
}


@query("isochron", "iso", extra=_ISOCHRON, sql="""
select query_id, location, round(cast(delay as double), 6) delay, easting, northing from iso""")
def _(t: Tables) -> DataFrame:
    return iso.isochron(day_table(t), t.links(), t.stations(), t.get("rq_nation")).withColumn(
        "delay", F.round("delay", 6))


# the projection written out from its published formulas, with unrolled Newton steps
_A, _F0, _B = "6377563.396e0", "0.9996012717e0", "6356256.910e0"
_GRID = {
    "k0": f"""select *, ({_A} - {_B}) / ({_A} + {_B}) n3, radians(cast(49 as double)) p0,
    ({_A} * {_A} - {_B} * {_B}) / ({_A} * {_A}) e2, {_A} * {_F0} af, {_B} * {_F0} bf
  from grid_in""",
    "k1": """select *, cast(n3 as double) n, cast(n3 as double) * cast(n3 as double) nn,
    cast(n3 as double) * cast(n3 as double) * cast(n3 as double) nnn from k0""",
}


def _arc(phi: str) -> str:
    return (f"bf * ((1 + n + 1.25e0 * nn + 1.25e0 * nnn) * ({phi} - p0)"
            f" - (3 * n + 3 * nn + 2.625e0 * nnn) * sin({phi} - p0) * cos({phi} + p0)"
            f" + (1.875e0 * nn + 1.875e0 * nnn) * sin(2 * ({phi} - p0)) * cos(2 * ({phi} + p0))"
            f" - (35e0 / 24e0 * nnn) * sin(3 * ({phi} - p0)) * cos(3 * ({phi} + p0)))")


_GRID["s0"] = "select *, p0 + (northing + 100000) / af phi from k1"
for _i in range(1, 7):
    _GRID[f"s{_i}"] = f"""select * exclude (phi),
    case when abs(northing + 100000 - {_arc("phi")}) >= 0.00001
      then phi + (northing + 100000 - {_arc("phi")}) / af else phi end phi from s{_i - 1}"""
_GRID["s_trig"] = """select *, cast(easting - 400000 as double) e, tan(phi) t, cos(phi) c,
    af * power(1 - e2 * sin(phi) * sin(phi), -0.5e0) nu,
    af * (1 - e2) * power(1 - e2 * sin(phi) * sin(phi), -1.5e0) rho from s6"""
_GRID["latlon"] = """select *, degrees(phi - t / (2 * rho * nu) * power(e, 2)
      + t / (24 * rho * power(nu, 3)) * (5 + 3 * t * t + (nu / rho - 1) - 9 * (nu / rho - 1) * t * t) * power(e, 4)
      - t / (720 * rho * power(nu, 5)) * (61 + 90 * t * t + 45 * power(t, 4)) * power(e, 6)) latitude,
    degrees(radians(cast(-2 as double)) + e / (nu * c)
      - 1 / (6 * power(nu, 3) * c) * (nu / rho + 2 * t * t) * power(e, 3)
      + 1 / (120 * power(nu, 5) * c) * (5 + 28 * t * t + 24 * power(t, 4)) * power(e, 5)
      - 1 / (5040 * power(nu, 7) * c) * (61 + 662 * t * t + 1320 * power(t, 4) + 720 * power(t, 6)) * power(e, 7))
      longitude
  from s_trig"""

_METRES = "select tiploc_code, easting * 100 - 1000000 easting, northing * 100 - 6000000 northing from fx_station"


@query("grid_to_latlon", "latlon", extra={**_GRID, "grid_in": _METRES}, sql="""
select tiploc_code, round(latitude, 9) latitude, round(longitude, 9) longitude from latlon""")
def _(t: Tables) -> DataFrame:
    p = grid_to_latlon(F.col("easting") * 100 - 1000000, F.col("northing") * 100 - 6000000)
    return t.stations().select("tiploc_code", p.alias("p")).select(
        "tiploc_code", F.round("p.lat", 9).alias("latitude"), F.round("p.lon", 9).alias("longitude"))


@query("meridional_arc", "k1", extra={**_GRID, "grid_in": _METRES}, sql=f"""
select tiploc_code, round({_arc("radians(48 + northing / 100000.0e0)")}, 4) metres from k1""")
def _(t: Tables) -> DataFrame:
    lat = F.radians((F.col("northing") * 100 - 6000000) / F.lit(100000.0) + 48)
    return t.stations().select("tiploc_code", F.round(meridional_arc(lat), 4).alias("metres"))


_POINTS = "select query_id, location, delay, easting, northing from iso where easting > 0 and northing > 0"
_MAPPED = {**_ISOCHRON, **_GRID, "grid_in": _POINTS}


@query("isochron_latlon", "latlon", extra=_MAPPED, sql="""
select query_id, location, round(cast(delay as double), 6) delay, round(latitude, 9) latitude,
  round(longitude, 9) longitude from latlon""")
def _(t: Tables) -> DataFrame:
    return _rounded(iso.isochron_latlon(day_table(t), t.links(), t.stations(), t.get("rq_nation")))


def _rounded(df: DataFrame) -> DataFrame:
    return df.withColumns({"delay": F.round("delay", 6), "latitude": F.round("latitude", 9),
                           "longitude": F.round("longitude", 9)})


_FOUND = f"""select q.query_id, coalesce(x.tiploc_code, m.tiploc_code) tiploc_code from {{queries}} q
  left join fx_station x on trim(q.name) <> '' and rpad(upper(q.name), 7, ' ') = rpad(x.tiploc_code, 7, ' ')
  left join (select * from (select q.query_id, n.tiploc_code, row_number() over (partition by q.query_id
      order by case when cate_type = 9 then -1 else cate_type end desc, station_name, tiploc_code) pos
    from {{queries}} q join (select station_name, cate_type, tiploc_code from fx_station
      union select a.alias_name, s.cate_type, s.tiploc_code from fx_station s join fx_alias a
        on a.station_name = s.station_name) n
      on trim(q.name) <> '' and rpad(n.station_name, 30, ' ') like concat('%', upper(q.name), '%')) r
    where pos = 1) m on m.query_id = q.query_id"""


@query("find_station", "rq_name", "fx_station", "fx_alias", sql=_FOUND.format(queries="rq_name"))
def _(t: Tables) -> DataFrame:
    return st.find_station(t.get("rq_name"), t.stations(), t.get("fx_alias"))


@query("find_station_indexed", "rq_name", "fx_station", "fx_alias", sql=_FOUND.format(queries="rq_name"))
def _(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "station-index")
    write_station_index(t.stations(), t.get("fx_alias"), path)
    return find_indexed(t.spark, t.get("rq_name"), path)


# names to ask for: each request's station by code, name or part of an alias
_ASKED = f"""select r.query_id, r.timetable_date, r.depart, case s.s_suppkey % 2
    when 0 then lower(s.tiploc_code) else lower(s.station_name) end name
  from rq_nation r join fx_station s on s.tiploc_code = r.station"""
_NAMED = {
    "asked": _ASKED,
    "found": _FOUND.format(queries="asked"),
    "rq_found": "select a.query_id, a.timetable_date, f.tiploc_code station, a.depart from asked a "
                "join found f on f.query_id = a.query_id where f.tiploc_code is not null",
}


@query("isochron_for_names", "latlon", "rq_found", extra={
    **_NAMED, **_reach("rq_found"), "iso": _ISOCHRON["iso"], **_GRID, "grid_in": _POINTS}, sql="""
select l.query_id, f.station, l.location, round(cast(l.delay as double), 6) delay, round(l.latitude, 9) latitude,
  round(l.longitude, 9) longitude, l.location = f.station labelled
from latlon l join rq_found f on f.query_id = l.query_id""")
def _(t: Tables) -> DataFrame:
    station = t.get("fx_station")
    names = t.get("rq_nation").join(station, F.col("station") == F.col("tiploc_code")).select(
        "query_id", "timetable_date", "depart",
        F.when(F.col("s_suppkey") % 2 == 0, F.lower("tiploc_code")).otherwise(F.lower("station_name"))
        .alias("name"))
    return _rounded(iso.isochron_for(names, day_table(t), t.links(), t.stations(), t.get("fx_alias")))


@query("isochron_bands", "iso", extra=_ISOCHRON, sql="""
select query_id, band, count(*) stations, band * 30 from_minutes from (
  select query_id, cast(floor(round(cast(delay as double) * 60) / 30) as int) band from iso) b
group by query_id, band""")
def _(t: Tables) -> DataFrame:
    return iso.isochron_bands(iso.delays(_labels(t, with_path=False), t.stations()), 30)
