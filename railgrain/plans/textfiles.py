"""The derived tables written out in the text formats of the real files, to be read back by the scans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import is_there, scratch_path
from ..sources import layouts as L
from ..sources.records import once
from .fixtures import Tables, coded

_FILE_ROWS = 20_000
_WRITTEN: dict[tuple[str, str, str], str] = {}


def _pad(value: Column | str, width: int) -> Column:
    return F.rpad(F.coalesce(value if isinstance(value, Column) else F.lit(value), F.lit("")), width, " ")


def _line(width: int, *parts: tuple[Column | str, int]) -> Column:
    return F.rpad(F.concat(*[_pad(v, w) for v, w in parts]), width, " ")


def _hhmm(seconds: Column) -> Column:
    minutes = F.floor(seconds / 60)
    return F.concat(F.lpad(F.floor(minutes / 60).cast("string"), 2, "0"),
                    F.lpad((minutes % 60).cast("string"), 2, "0"))


def _hhmmh(seconds: Column) -> Column:
    return F.concat(_hhmm(seconds), F.when(seconds % 60 == 30, "H").otherwise(" "))


def _yymmdd(date: Column) -> Column:
    return F.date_format(date, "yyMMdd")


def _yymmdd_1956(date: Column) -> Column:
    return F.concat(F.lpad((F.year(date) - 1956).cast("string"), 2, "0"), F.date_format(date, "MMdd"))


def _c(name: str) -> Column:
    return F.col(name)


def _write(rows: DataFrame, label: str) -> str:
    """Write rows of ``(file, rank, seq, value)``: one text file per ``file``, in order of rank and seq.

    Lines are padded to full width, so files are kept compressed; none has more than ``_FILE_ROWS`` numbers of each kind to be read by one task.
    """
    path = scratch_path(rows.sparkSession, label)
    rows.repartition("file").sortWithinPartitions("file", "rank", "seq").select("file", "value").write \
        .partitionBy("file").text(path, compression="gzip")
    return path + "/*"


def _written(tables: Tables, label: str, build) -> str:
    key = (tables.spark.sparkContext.applicationId, tables.sf_dir, label)
    if key not in _WRITTEN or not is_there(tables.spark, _WRITTEN[key].removesuffix("/*")):
        _WRITTEN[key] = build()
    return _WRITTEN[key]


def _framed(rows: DataFrame, first: Column, last: Column) -> DataFrame:
    """Adds a first and a last line to every file."""
    files = rows.select("file").distinct()
    frame = lambda rank, line: files.select("file", F.lit(rank).alias("rank"), F.lit(0).cast("long").alias("seq"),
                                            line.alias("value"))
    return rows.unionByName(frame(0, first)).unionByName(frame(99, last))


def _rows(df: DataFrame, number: Column, rank: int, value: Column) -> DataFrame:
    return df.select(F.floor(number / _FILE_ROWS).cast("int").alias("file"), F.lit(rank).alias("rank"),
                     number.cast("long").alias("seq"), value.alias("value"))


# -- timetable files ---------------------------------------------------------------------------------


def _schedule_line(date_text) -> Column:
    k = _c("k")
    return _line(
        80, ("BSN", 3), (_c("train_uid"), 6), (date_text(_c("date_runs_from")), 6),
        (date_text(_c("date_runs_to")), 6), (_c("days_run"), 7), (" ", 1), (_c("train_status"), 1), ("OO", 2),
        (F.concat(F.lit("1A"), F.lpad((k % 100).cast("string"), 2, "0")), 4), ("", 4), ("1", 1),
        (F.expr(coded("k", 8)), 8), (" ", 1), ("DMU", 3), ("75", 4),
        (F.lpad(_c("speed").cast("string"), 3, "0"), 3), ("", 6), ("B", 1), (" ", 1), ("S", 1), ("", 1),
        ("", 4), ("", 4), ("", 1), (_c("stp_indicator"), 1))


#: Kinds of fields that accept any text.
_FREE = ("text", "vartext", "activity", "routeing")


def checkable(layout, but: tuple[str, ...] = ()) -> list[L.Field]:
    return [f for f in layout if f.kind not in _FREE and f.name not in but]


def _spoil(line: Column, layout, number: Column, but: tuple[str, ...] = ()) -> Column:
    """One field of ``line`` that is checked, another one for each number in turn, overwritten; every so many lines none."""
    fields = checkable(layout, but)
    turn, out = F.pmod(number, F.lit(len(fields) + 1)), line
    for i, f in enumerate(fields):
        out = F.when(turn == i, F.overlay(line, F.lit("?" * f.length), F.lit(f.start))).otherwise(out)
    return out


def spoiled_field(layout, number: str, but: tuple[str, ...] = ()) -> str:
    """The name of the field that :func:`_spoil` overwrites, as SQL."""
    fields = checkable(layout, but)
    return f"case ({number}) % {len(fields) + 1} " + " ".join(f"when {i} then '{f.name}'" for i, f in enumerate(fields)) + " end"


def _stop_line(spoiled: bool = False) -> Column:
    arr, dep, pas = (_hhmmh(_c("scheduled_" + n)) for n in ("arrival", "departure", "pass"))
    first = _line(80, ("LO", 2), (_c("location"), 8), (dep, 5), (_hhmm(_c("scheduled_departure")), 4),
                  (_c("platform"), 3), ("", 3), ("", 2), ("", 2), ("TB", 12))
    public = lambda n: F.coalesce(_hhmm(_c("scheduled_" + n)), F.lit("0000"))
    middle = _line(80, ("LI", 2), (_c("location"), 8), (arr, 5), (dep, 5), (pas, 5), (public("arrival"), 4),
                   (public("departure"), 4), (_c("platform"), 3), ("", 3), ("", 3), ("T", 12))
    last = _line(80, ("LT", 2), (_c("location"), 8), (arr, 5), (_hhmm(_c("scheduled_arrival")), 4),
                 (_c("platform"), 3), ("", 3), ("TF", 12))
    if spoiled:
        number = _c("k") + _c("loc_order")
        first, middle, last = (_spoil(x, layout, number) for x, layout in (
            (first, L.ORIGIN_LOCATION), (middle, L.INTERMEDIATE_LOCATION), (last, L.TERMINATING_LOCATION)))
    return F.when(_c("loc_order") == 0, first).when(_c("loc_order") == _c("last_order"), last).otherwise(middle)


def _change_line() -> Column:
    speed = F.lpad((_c("k") % 150).cast("string"), 3, "0")
    return _line(80, ("CR", 2), (_c("location"), 8), ("XX", 2), ("2B00", 4), ("", 4), ("1", 1), ("", 8),
                 (" ", 1), ("EMU", 3), ("", 4), (speed, 3), ("", 6), ("B", 1))


#: Fields of a schedule that its calls depend on, and that stay as they are in spoiled files.
SCHEDULE_KEY = ("date_runs_from", "stp_indicator")


def _trains(schedules: DataFrame, stops: DataFrame, date_text, code_blank: bool, damaged: bool, spoiled: bool = False) -> DataFrame:
    """One row per train: all its lines.  ``damaged`` breaks the record order of two trains in three, ``spoiled`` fields."""
    k = _c("k")
    spoil = (lambda line, layout, *more: _spoil(line, layout, *more)) if spoiled else (lambda line, *_: line)
    lines = [_stop_line(spoiled)]
    changing = (_c("loc_order") < _c("last_order")) & ((k + _c("loc_order")) % 11 == 0)
    lines.append(F.when(changing, spoil(_change_line(), L.CHANGES_EN_ROUTE, k + _c("loc_order"))))
    if damaged:
        note = _line(80, ("LN", 2), ("G", 1), (F.concat(F.lit("NOTE "), k.cast("string")), 77))
        lines = [F.when(~((k % 3 == 0) & (_c("loc_order") == _c("last_order"))), lines[0]),
                 F.when((k % 3 == 2) & (_c("loc_order") == 0), note), lines[1]]
    calls = stops.select("train_uid", "k", "loc_order", once(line=F.concat_ws("\n", *lines))).filter(
        "line <> ''").groupBy("train_uid", "k").agg(
        F.array_sort(F.collect_list(F.struct("loc_order", "line"))).alias("calls"))
    extra = _line(80, ("BX", 6), (F.lpad((k % 100000).cast("string"), 5, "0"), 5), ("XC", 2),
                  (" " if code_blank else "Y", 1), (F.concat(F.lit("XC"), (k % 1000000).cast("string")), 8))
    note = _line(80, ("TN", 2), ("W", 1), (F.concat(F.lit("TRAIN "), k.cast("string")), 77))
    has_stops = _c("calls").isNotNull()
    extra, note = spoil(extra, L.EXTRA_DETAILS, k), spoil(note, L.NOTE, k)
    head = spoil(_schedule_line(date_text), L.BASIC_SCHEDULE, k, SCHEDULE_KEY)
    block = F.concat_ws("\n", head, F.when(has_stops & (k % 2 == 0), extra),
                        F.when(has_stops & (k % 5 == 0), note), F.array_join("calls.line", "\n"))
    joined = schedules.join(calls, ["train_uid", "k"], "left")
    return _rows(joined, k, 5, block)


_HEADER = ("HDTPS.UDFROC1.PD9805080805980805", 32), ("DFROC1S", 7), ("DFROC1R", 7), ("FA", 2), \
    ("080598080599", 12)


def timetable_rows(tables: Tables, spoiled: bool = False) -> DataFrame:
    """``spoiled`` overwrites fields of every kind of record; place records, which have no checked field, get a foreign letter."""
    station, s = tables.get("fx_station"), _c("s_suppkey")
    place = lambda t: [(t, 2), (_c("tiploc_code"), 7), ("23", 2), (F.expr(coded("s_suppkey", 6)), 6), ("C", 1),
                       (_c("station_name"), 26), ("00000", 5), ("", 4), (_c("crs3"), 3),
                       (_c("station_name"), 16)]
    pair = _line(80, ("AAN", 3), (_c("main_train_uid"), 6), (_c("associated_train_uid"), 6),
                 (_yymmdd(_c("association_start_date")), 6), (_yymmdd(_c("association_end_date")), 6),
                 (_c("association_days"), 7), (_c("association_category"), 2),
                 (_c("association_date_ind"), 1), ("S000001", 7), ("", 2), ("T", 1), ("P", 1), ("", 31),
                 (_c("stp_indicator"), 1))
    foreign = lambda line: F.when(s % 2 == 0, F.overlay(line, F.lit("É"), F.lit(12))).otherwise(line)
    if spoiled:
        pair = _spoil(pair, L.ASSOCIATIONS, _c("k"))
    rows = _trains(tables.get("fx_schedule"), tables.get("fx_stop"), _yymmdd, False, False, spoiled)
    for rank, value in ((1, _line(80, *place("TI"))),
                        (2, _line(80, *place("TA"), (F.concat(F.lit("N"), _c("tiploc_code")), 7))),
                        (3, _line(80, ("TD", 2), (_c("tiploc_code"), 7)))):
        rows = rows.unionByName(_rows(station, s, rank, foreign(value) if spoiled else value))
    rows = rows.unionByName(_rows(tables.get("fx_association"), _c("k"), 4, pair))
    return rows


def timetable_text(tables: Tables) -> str:
    def build() -> str:
        return _write(_framed(timetable_rows(tables), _line(80, *_HEADER), _line(80, ("ZZ", 2))), "mca")

    return _written(tables, "mca", build)


def spoiled_timetable_text(tables: Tables) -> str:
    def build() -> str:
        return _write(_framed(timetable_rows(tables, True), _line(80, *_HEADER), _line(80, ("ZZ", 2))), "spoiled")

    return _written(tables, "spoiled", build)


def spoiled_link_text(tables: Tables) -> str:
    """Links by time: an unknown key, a mode, a time of day or a date that cannot be, or nothing wrong."""
    def build() -> str:
        path, turn = scratch_path(tables.spark, "alf-spoiled"), F.substring_index(F.substring_index("value", ",S=", 1), "=", -1).cast("int") % 5
        value = F.when(turn == 0, F.concat("value", F.lit(",Q=1"))).when(turn == 1, F.regexp_replace("value", "^M=[A-Z]*", "M=PLANE")).when(
            turn == 2, F.regexp_replace("value", ",S=....", ",S=2460")).when(turn == 3, F.concat("value", F.lit(",U=31/02/1998"))).otherwise(F.col("value"))
        link_lines(tables).select(value.alias("value")).write.text(path)
        return path

    return _written(tables, "alf-spoiled", build)


def spoiled_interchange_text(tables: Tables) -> str:
    """Every third line has a field too many, every third minutes that are no number."""
    def build() -> str:
        path, turn = scratch_path(tables.spark, "tsi-spoiled"), _c("s_suppkey") % 3
        value = F.when(turn == 0, F.concat("value", F.lit(",more"))).when(turn == 1, F.regexp_replace("value", ",[0-9]+,", ",soon,")).otherwise(F.col("value"))
        interchange_lines(tables).select(value.alias("value")).write.text(path)
        return path

    return _written(tables, "tsi-spoiled", build)


def damaged_timetable_text(tables: Tables) -> str:
    def build() -> str:
        rows = _trains(tables.get("fx_schedule"), tables.get("fx_stop"), _yymmdd, False, True)
        return _write(_framed(rows, _line(80, *_HEADER), _line(80, ("ZZ", 2))), "damaged")

    return _written(tables, "damaged", build)


def ztrain_rows(tables: Tables) -> DataFrame:
    return _trains(tables.get("fx_zschedule"), tables.get("fx_zstop"), _yymmdd_1956, True, False)


def ztrain_text(tables: Tables) -> str:
    def build() -> str:
        return _write(_framed(ztrain_rows(tables), _line(80, ("HD", 2)), _line(80, ("ZZ", 2))), "ztr")

    return _written(tables, "ztr", build)


# -- the other files ---------------------------------------------------------------------------------


def _station_frame() -> tuple[Column, Column]:
    return _line(82, ("A", 30), ("FILE-SPEC=05 1.00 08/05/98", 40)), _line(82, ("E", 1))


def station_rows(tables: Tables, damaged: bool = False, spoiled: bool = False) -> DataFrame:
    """``spoiled`` overwrites each checked field in turn and puts foreign letters into aliases and groups; ``damaged`` spoils a field of every second station and puts a routeing group after each station."""
    s, number = _c("s_suppkey"), lambda n: _c(n).cast("string")
    easting, flag = number("easting"), F.lit(" ")
    if damaged:
        easting = F.when(s % 4 == 0, "ABCDE").otherwise(easting)
        flag = F.when(s % 4 == 1, "Q").otherwise(flag)
    detail = _line(82, ("A", 5), (_c("station_name"), 30), (number("cate_type"), 1), (_c("tiploc_code"), 7),
                   (_c("crs3"), 3), ("", 3), (_c("crs3"), 3), (easting, 5), (flag, 1), (number("northing"), 5),
                   (F.lpad(number("change_time"), 2, " "), 2))
    alias = _line(82, ("L", 5), (_c("station_name"), 30), ("", 1), (_c("alias_name"), 30))
    group = _line(82, ("V", 5), (F.concat(F.lit("GROUP "), s.cast("string")), 30), ("", 1),
                  (F.concat(_c("crs3"), F.lit(" "), _c("crs3"), F.lit(" XYZ")), 40))
    if spoiled:
        detail = _spoil(detail, L.STATION_DETAIL, s)
        alias, group = (F.when(s % 4 == 0, F.overlay(x, F.lit("É"), F.lit(80))).otherwise(x) for x in (alias, group))
    station = tables.get("fx_station")
    rows = _rows(station, s, 1, detail).unionByName(
        _rows(tables.get("fx_alias"), s, 3, alias)).unionByName(
        _rows(station, s, 1 if damaged else 4, group))
    if damaged:
        rows = rows.withColumn("seq", F.col("seq") * 2 + F.col("value").startswith("V").cast("int"))
    return _framed(rows, *_station_frame())


def station_text(tables: Tables, damaged: bool = False) -> str:
    label = "msn-damaged" if damaged else "msn"
    return _written(tables, label, lambda: _write(station_rows(tables, damaged), label))


def spoiled_station_text(tables: Tables) -> str:
    return _written(tables, "msn-spoiled", lambda: _write(station_rows(tables, spoiled=True), "msn-spoiled"))


def link_lines(tables: Tables) -> DataFrame:
    date = lambda name: F.concat(F.lit(f",{name[0]}="), F.date_format(name[1], "dd/MM/yyyy"))
    # the first T is overruled by the second
    return tables.get("fx_link").select(F.concat(
        F.lit("M="), _c("mode"), F.lit(",O="), _c("origin"), F.lit(",D="), _c("destination"), F.lit(",T=999,T="),
        _c("link_time").cast("string"), F.lit(",S="), _hhmm(_c("start_time")), F.lit(",E="),
        _hhmm(_c("end_time")), F.lit(",P=4"), F.coalesce(date(("F", "start_date")), F.lit("")),
        F.coalesce(date(("U", "end_date")), F.lit("")), F.lit(",R="), _c("days_of_week")).alias("value"))


def link_text(tables: Tables) -> str:
    def build() -> str:
        path = scratch_path(tables.spark, "alf")
        link_lines(tables).write.text(path)
        return path

    return _written(tables, "alf", build)


def interchange_lines(tables: Tables) -> DataFrame:
    return tables.get("fx_station").select(F.concat_ws(
        ",", "crs3", F.lit("XC"), F.when(_c("s_suppkey") % 2 == 0, "GW").otherwise("  "),
        _c("change_time").cast("string"), "station_name").alias("value"), "s_suppkey")


def interchange_text(tables: Tables) -> str:
    def build() -> str:
        path = scratch_path(tables.spark, "tsi")
        interchange_lines(tables).select("value").write.text(path)
        return path

    return _written(tables, "tsi", build)


# -- archives ----------------------------------------------------------------------------------------


def _zip(lines: DataFrame) -> DataFrame:
    """Zip archives ``(path, content)`` from rows ``(path, member, rank, seq, value)``."""
    import io
    import zipfile

    def pack(group):
        buffer = io.BytesIO()
        with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED, compresslevel=1) as archive:
            for member, rows in group.sort_values(["rank", "seq"]).groupby("member"):
                archive.writestr(member, "\r\n".join(rows["value"]) + "\r\n")
        return group.head(1)[["path"]].assign(content=buffer.getvalue())

    return lines.groupBy("path").applyInPandas(pack, "path string, content binary")


#: Stations of an archive with all five members, and what goes with that many.
_ARCHIVE_STATIONS = 100


def whole_archives(tables: Tables) -> DataFrame:
    """Archives with all five members.  Rows are dealt to archives by number, trains and stations alike."""
    n = max(1, tables.get("fx_station").count() // _ARCHIVE_STATIONS)
    inner = F.col("rank").between(1, 98)
    blank = lambda width, kind: _line(width, (kind, 2))
    links = link_lines(tables).select(F.lit(1).alias("rank"), F.xxhash64("value").alias("seq"), "value")
    exchange = interchange_lines(tables).select(F.lit(1).alias("rank"), _c("s_suppkey").cast("long").alias("seq"), "value")
    members = {
        "mca": (timetable_rows(tables), (_line(80, *_HEADER), blank(80, "ZZ"))),
        "ztr": (ztrain_rows(tables), (blank(80, "HD"), blank(80, "ZZ"))),
        "msn": (station_rows(tables).filter(inner), _station_frame()),
        "tsi": (exchange, ()), "alf": (links, ()),
    }
    out = None
    for suffix, (rows, frame) in members.items():
        rows = rows.select(F.pmod("seq", F.lit(n)).alias("archive"), "rank", "seq", "value")
        for rank, line in zip((0, 99), frame):
            rows = rows.unionByName(tables.spark.range(n).select(F.col("id").alias("archive"), F.lit(rank).alias("rank"),
                                                                 F.lit(0).cast("long").alias("seq"), line.alias("value")))
        rows = rows.withColumn("member", F.lit(f"ttisf.{suffix}"))
        out = rows if out is None else out.unionByName(rows)
    path = F.concat(F.lit("ttf"), F.col("archive").cast("string"), F.lit(".zip"))
    return _zip(out.select(path.alias("path"), "member", "rank", "seq", "value"))


def station_archives(tables: Tables) -> DataFrame:
    """Archives of at most 500 stations each, with a station and an interchange member."""
    number = _c("s_suppkey")
    path = F.concat(F.lit("ttf"), F.floor(number / 500).cast("string"), F.lit(".zip"))
    detail = station_rows_of(tables)
    exchange = interchange_lines(tables).select(path.alias("path"), F.lit("ttisf.tsi").alias("member"),
                                                F.lit(1).alias("rank"), number.alias("seq"), "value")
    return _zip(detail.unionByName(exchange))


def station_rows_of(tables: Tables) -> DataFrame:
    rows = station_rows(tables).filter("rank = 1")
    path = F.concat(F.lit("ttf"), F.floor(_c("seq") / 500).cast("string"), F.lit(".zip"))
    rows = rows.select(path.alias("path"), F.lit("ttisf.msn").alias("member"), "rank",
                       _c("seq").cast("long").alias("seq"), "value")
    title = rows.select("path", "member").distinct().select(
        "path", "member", F.lit(0).alias("rank"), F.lit(0).cast("long").alias("seq"),
        _line(82, ("A", 30), ("FILE-SPEC=05", 12)).alias("value"))
    return rows.unionByName(title)


def rail_reference_archives(tables: Tables) -> DataFrame:
    """Archives of at most 500 stations each; names carry a comma inside quotes."""
    number = _c("s_suppkey")
    path = F.concat(F.lit("naptan"), F.floor(number / 500).cast("string"), F.lit(".zip"))
    text = F.concat_ws(",", F.concat(F.lit('"9100'), _c("tiploc_code"), F.lit('"')), "tiploc_code", "crs3",
                       F.concat(F.lit('"'), _c("station_name"), F.lit(', MAIN"')), F.lit(""), F.lit("U"),
                       (_c("easting") * 10).cast("string"), (_c("northing") * 10).cast("string"),
                       F.lit("2015-05-09"), F.lit("new"))
    rows = tables.get("fx_station").select(
        path.alias("path"), F.lit("RailReferences.csv").alias("member"), F.lit(1).alias("rank"),
        number.alias("seq"), text.alias("value"))
    title = rows.select("path", "member").distinct().select(
        "path", "member", F.lit(0).alias("rank"), F.lit(0).cast("long").alias("seq"),
        F.lit("AtcoCode,TiplocCode,CrsCode,StationName,StationNameLang,GridType,Easting,Northing,Date,Mod")
        .alias("value"))
    return _zip(rows.unionByName(title))
