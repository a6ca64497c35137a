"""Scan of fixed-width timetable files into typed tables.

A stop line has no meaning without the schedule line above it, and lines of a distributed file have no
order.  So the file is not read by line: with a separator of newline + ``BS`` every row of the text scan is
one whole train, the scan stays splittable, and each train's stop numbers and past-midnight flags are
worked out inside its own row.  No shuffle, window or sort is involved.  Records that need no context
(associations, location codes) are read by line.
"""

from __future__ import annotations

import copy
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.decoders import decode
from ..session import scratch_path
from . import layouts as L
from .records import columns, judged, once, problems, raw, well_formed

VARIANTS = ("standard", "ztrain")
KEY = ("train_uid", "date_runs_from", "stp_indicator")

# Which record types may follow one another.  Repeats are possessive, so that matching a
# block of any length needs no recursion.
HEADER_SEQUENCE = "HD(?:TI)*+(?:TA)*+(?:TD)*+(?:AA)*+(?:ZZ)?"
SCHEDULE_SEQUENCE = "BS(?:ZZ)?|BS(?:BX)?(?:TN)?LO(?:LI|CR(?=LI|LT))*+LT(?:ZZ)?"

_TYPES = ("HD", "TI", "TA", "TD", "AA", "BS", "LO", "LI", "LT", "CR", "LN")
STOP_LAYOUTS = {"LO": L.ORIGIN_LOCATION, "LI": L.INTERMEDIATE_LOCATION, "LT": L.TERMINATING_LOCATION}


def _over_lines(sequence: str) -> str:
    """A pattern over record types as a pattern over whole lines."""
    return re.sub("[A-Z]{2}", lambda m: rf"(?:{m[0]}[^\n]*+(?:\n|\z))", sequence)


def _type(line: Column) -> Column:
    return F.substring(line, 1, 2)


def _padded(line: Column) -> Column:
    return F.rpad(line, L.TIMETABLE_WIDTH, " ")


def _line_of(record_type: str) -> Column:
    """The block's first line of a type, padded; NULL when there is none."""
    line = F.regexp_extract("block", rf"\n({record_type}[^\n]*)", 1)
    return F.when(line != "", _padded(line))


class TimetableScan:
    """Lazy tables over one or many timetable files."""

    def __init__(self, spark: SparkSession, path: str, variant: str = "standard", mode: str = "failfast"):
        if variant not in VARIANTS:
            raise ValueError(f"variant must be one of {VARIANTS}")
        self._spark, self._path, self._mode, self._stage = spark, path, mode, None
        ztrain = variant == "ztrain"
        self._schedule = L.ZTRAIN_BASIC_SCHEDULE if ztrain else L.BASIC_SCHEDULE
        self._extra = L.ZTRAIN_EXTRA_DETAILS if ztrain else L.EXTRA_DETAILS

    # -- scans ---------------------------------------------------------------------------------------

    def blocks(self) -> DataFrame:
        """One row per train, plus one for each file's leading records; lines are separated by newlines."""
        text = self._spark.read.option("lineSep", "\nBS").text(self._path)
        value = F.replace("value", F.lit("\r\n"), F.lit("\n"))
        # Only a file's last block ends so; trimming takes a look at every character of what it is given.
        value = F.when(value.endswith("\n") | value.endswith("\r"), F.rtrim(value, F.lit("\r\n"))).otherwise(value)
        # The separator took the ``BS`` of every train but one that begins its file, which then has no header.
        whole = F.when(value.startswith("HD") | value.startswith("BS"), value).otherwise(F.concat(F.lit("BS"), value))
        return text.select(
            F.col("_metadata.file_path").alias("file"),
            F.struct(F.col("_metadata.file_block_start").alias("split"),
                     F.monotonically_increasing_id().alias("row")).alias("position"),
            F.col("value").startswith("BS").alias("headless"), once(block=whole))

    def _checked(self) -> DataFrame:
        blocks = self.blocks()
        if self._mode == "failfast":
            def stop(*what):
                return F.raise_error(F.concat(*what)).cast("boolean")

            first = _padded(F.substring_index("block", "\n", 1))
            header = F.lit(True)
            if self._schedule is L.BASIC_SCHEDULE:  # the header of the other variant is blank
                header = ~first.startswith("HD") | well_formed(first, {"HD": L.HEADER})
            blocks = blocks.filter(
                F.when(F.col("headless"), stop(F.lit("no header")))
                .when(~legal_sequence(), stop(F.lit("unexpected record sequence "), record_types()))
                .when(~header, stop(F.lit("bad record: header"))).otherwise(True))
        return blocks

    def _trains(self) -> DataFrame:
        return self._checked().filter(F.col("block").startswith("BS"))

    # -- one pass for all tables ---------------------------------------------------------------------

    def staged(self) -> TimetableScan:
        """The same tables from one pass over the text.

        All lines are written once, with what a line needs of the lines around it, in a folder for each record type; each
        table then reads its own folder.  Use it for more than one table.
        """
        out = copy.copy(self)
        path = scratch_path(self._spark, "records")
        lines = self._all_lines()
        lines.write.partitionBy("type").parquet(path, compression="zstd")  # padded lines: half of what the default takes
        out._stage = self._spark.read.schema(lines.schema).parquet(path)
        return out

    def _all_lines(self) -> DataFrame:
        """One row per line; a schedule and its BX and TN lines are one row of type BS."""
        block, head, train = F.col("block"), F.col("head"), F.col("block").startswith("BS")
        fields = {f.name: f for f in self._schedule}
        layout = [fields[name] for name in KEY]
        wrong = F.when(well_formed(head, {"BS": layout}), "").otherwise(
            F.array_join(F.array_compact(F.array(*problems(head, layout))), ", "))
        key = {f.name: F.when(train, decode(f.kind, raw(head, f))) for f in layout}
        parts = F.when(train, F.split(block, r"\n(?=L[OIT])")).otherwise(F.split(block, "\n"))
        # Each step is bound once: exploding would put the split into a filter too, and carry all parts along for a count of them.
        heads = self._checked().select(once(block=block, head=_padded(F.substring_index(block, "\n", 1))))
        blocks = heads.select(once(
            **key, bad_key=F.when(train, wrong), train=train, parts=parts, midnight=_first_stop_past_midnight_in(_stop_clocks()),
            has_stops=F.when(train, block.rlike(r"\nL[OIT]")).otherwise(block.contains("\n"))))
        calls = blocks.select(*KEY, "bad_key", "train", "midnight", "has_stops", F.posexplode("parts").alias("part", "call"))
        typed = lambda line: F.struct(_type(line).alias("type"), line.alias("line"))
        lines = F.split("call", "\n")
        first = F.array(F.struct(F.lit("BS").alias("type"), F.col("call").alias("line")))
        others = F.filter(F.slice(lines, F.lit(2), F.size(lines)), lambda x: ~_type(x).isin("BX", "TN"))
        alone = ~F.col("train") | (F.col("part") > 0) & ~F.col("call").contains("\n")
        rows = F.when(alone, F.array(typed(F.col("call")))).when(
            F.col("part") == 0, F.concat(first, F.transform(others, typed))).otherwise(F.transform(lines, typed))
        out = calls.select(*KEY, "bad_key", "midnight", "has_stops", "part", F.inline(rows)).withColumn(
            "loc_order", F.col("part") - 1)
        text = F.when(F.col("type") == "BS", F.col("line")).otherwise(_padded(F.col("line")))
        return out.filter(F.col("type").isin(*_TYPES)).select(
            *KEY, "bad_key", "has_stops", "loc_order", _past_midnight(), text.alias("line"), "type")

    def _staged_lines(self, *types: str) -> DataFrame:
        return self._stage.filter(F.col("type").isin(*types))

    def _standalone(self, record_type: str, layout) -> DataFrame:
        """Records that need no context, read line by line."""
        if self._stage is not None:
            lines = self._staged_lines(record_type).select("line")
        else:
            lines = self._spark.read.text(self._path).filter(F.col("value").startswith(record_type)).select(
                _padded(F.col("value")).alias("line"))
        line = F.col("line")
        return judged(lines, well_formed(line, {record_type: layout}), problems(line, layout),
                      columns(line, layout), self._mode)

    # -- tables --------------------------------------------------------------------------------------

    def header(self) -> DataFrame:
        return self._standalone("HD", L.HEADER)

    def tiploc_insert(self) -> DataFrame:
        return self._standalone("TI", L.TIPLOC_INSERT)

    def tiploc_amend(self) -> DataFrame:
        return self._standalone("TA", L.TIPLOC_AMEND)

    def tiploc_delete(self) -> DataFrame:
        return self._standalone("TD", L.TIPLOC_DELETE)

    def associations(self) -> DataFrame:
        return self._standalone("AA", L.ASSOCIATIONS)

    def basic_schedule(self) -> DataFrame:
        """BS joined with its optional BX and TN.  A schedule with no stops is kept only if it cancels."""
        block = F.col("block")
        if self._stage is not None:
            trains = self._staged_lines("BS").select(F.col("line").alias("block"), "has_stops")
        else:
            trains = self._trains().withColumn("has_stops", block.contains("\nLO"))
        parts = trains.select(once(bs=_padded(F.substring_index(block, "\n", 1)), bx=_line_of("BX"), tn=_line_of("TN"),
                                   has_stops=F.col("has_stops")))
        cancels = F.substring("bs", L.TIMETABLE_WIDTH, 1) == "C"
        layouts = {"bs": self._schedule, "bx": self._extra, "tn": L.NOTE}
        valid = ~(cancels & F.col("has_stops"))
        found = [F.when(~valid, F.lit("cancellation with stops"))]
        for name, layout in layouts.items():
            line = F.col(name)
            valid = valid & (line.isNull() | well_formed(line, {name.upper(): layout}))
            found += [F.when(line.isNotNull(), p) for p in problems(line, layout)]
        out = [c for name, layout in layouts.items() for c in columns(F.col(name), layout)]
        return judged(parts.filter(F.col("has_stops") | cancels), valid, found, out, self._mode)

    def _train_lines(self, lines: Column) -> DataFrame:
        """Per train: its key, some of its lines, and the number of its first stop past midnight."""
        fields = {f.name: f for f in self._schedule}
        layout = [fields[name] for name in KEY]
        head = _padded(F.substring_index("block", "\n", 1))
        # A train's lines are no better than its key.
        wrong = F.array_join(F.array_compact(F.array(*problems(head, layout))), ", ")
        return self._trains().select(*columns(head, layout), wrong.alias("bad_key"), "block", lines.alias("lines"),
                                     _stop_clocks().alias("clocks")).select(
            *KEY, "bad_key", "block", "lines", _first_stop_past_midnight("clocks").alias("midnight"))

    def _stop_lines(self) -> DataFrame:
        """One row per LO/LI/LT line, numbered from 0 at the origin."""
        if self._stage is not None:
            return self._staged_lines(*STOP_LAYOUTS)
        stops = F.regexp_extract_all("block", F.lit(r"\n(L[OIT][^\n]*)"), 1)
        return self._train_lines(stops).select(
            *KEY, "bad_key", "midnight", F.posexplode("lines").alias("loc_order", "line")
        ).select(*KEY, "bad_key", "loc_order", _past_midnight(), _padded(F.col("line")).alias("line"))

    def _side_lines(self, record_type: str) -> DataFrame:
        """Lines that belong to the stop before them: they take over its number and flag."""
        if self._stage is not None:
            return self._staged_lines(record_type)
        # the lines before it in the block tell how many stops came first
        after_each_stop = F.split("block", r"\n(?=L[OIT])")
        trains = self._train_lines(after_each_stop).filter(F.col("block").contains(f"\n{record_type}"))
        calls = trains.select(*KEY, "bad_key", "midnight", F.posexplode("lines").alias("part", "call"))
        sides = F.regexp_extract_all("call", F.lit(rf"\n({record_type}[^\n]*)"), 1)
        return calls.select(
            *KEY, "bad_key", "midnight", (F.col("part") - 1).alias("loc_order"), F.explode(sides).alias("line")
        ).select(*KEY, "bad_key", "loc_order", _past_midnight(), _padded(F.col("line")).alias("line"))

    def _located(self, lines: DataFrame, layouts: dict, out: list[Column]) -> DataFrame:
        line, several = F.col("line"), len(layouts) > 1
        valid = well_formed(line, layouts)
        found = [F.when(_type(line) == record_type, p) if several else p
                 for record_type, layout in layouts.items() for p in problems(line, layout)]
        if "LI" in layouts:
            timeless = (_type(line) == "LI") & (F.trim(F.substring(line, 11, 15)) == "")
            valid, found = valid & ~timeless, [*found, F.when(timeless, F.lit("no time"))]
        good_key = F.col("bad_key") == ""
        valid, found = valid & good_key, [*found, F.when(~good_key, F.col("bad_key"))]
        header = [F.col(c) for c in (*KEY, "loc_order", "xmidnight")]
        return judged(lines, valid, found, header + out, self._mode)

    def _table(self, lines: DataFrame, record_type: str, layout) -> DataFrame:
        return self._located(lines, {record_type: layout}, columns(F.col("line"), layout))

    def _stops_of(self, record_type: str) -> DataFrame:
        stops = self._stop_lines().filter(_type(F.col("line")) == record_type)
        return self._table(stops, record_type, STOP_LAYOUTS[record_type])

    def origin_location(self) -> DataFrame:
        return self._stops_of("LO")

    def intermediate_location(self) -> DataFrame:
        return self._stops_of("LI")

    def terminating_location(self) -> DataFrame:
        return self._stops_of("LT")

    def changes_en_route(self) -> DataFrame:
        return self._table(self._side_lines("CR"), "CR", L.CHANGES_EN_ROUTE)

    def location_specific_note(self) -> DataFrame:
        """Always empty in ``failfast`` mode: no legal sequence contains such a line."""
        return self._table(self._side_lines("LN"), "LN", L.NOTE)

    def stops(self) -> DataFrame:
        """The three stop tables as one: what the timetable queries read."""
        line = F.col("line")

        def pick(name: str) -> Column:
            """The field from where the line's layout has it, NULL if that layout lacks it."""
            text, kind = F.lit(None).cast("string"), "text"
            for record_type, layout in STOP_LAYOUTS.items():
                for field in layout:
                    if field.name == name:
                        text, kind = F.when(_type(line) == record_type, raw(line, field)).otherwise(text), field.kind
            return decode(kind, text).alias(name)

        location = columns(line, L.ORIGIN_LOCATION[:1])
        rest = [pick(n) for n in ("scheduled_arrival", "scheduled_departure", "scheduled_pass", "platform")]
        return self._located(self._stop_lines(), STOP_LAYOUTS, location + rest)

    def tables(self) -> dict[str, DataFrame]:
        """All tables, from one pass over the text."""
        scan = self if self._stage is not None else self.staged()
        names = ("basic_schedule", "origin_location", "intermediate_location", "changes_en_route",
                 "terminating_location", "location_specific_note", "associations",
                 "tiploc_insert", "tiploc_amend", "tiploc_delete")
        return {name: getattr(scan, name)() for name in names}


def read_timetable(spark: SparkSession, path: str, variant: str = "standard",
                   mode: str = "failfast") -> TimetableScan:
    return TimetableScan(spark, path, variant, mode)


def legal_sequence() -> Column:
    """Whether a block's records are in a legal order."""
    return F.col("block").rlike(rf"^(?:{_over_lines(HEADER_SEQUENCE)}|{_over_lines(SCHEDULE_SEQUENCE)})\z")


def record_types() -> Column:
    """The types of a block's records, one after the other."""
    return F.regexp_replace(F.regexp_replace("block", "(?m)^$", "  "), r"(?m)^(..?)[^\n]*\n?", "$1")


def _stop_clocks() -> Column:
    """For each stop the time that places it in the day, as text: arrival, else departure, else pass.

    Origins and ends have their only time in the place of the arrival.  ``H`` sorts after blank, so the
    text sorts as the time does.
    """
    return F.regexp_extract_all("block", F.lit(r"\n(?:LI.{0,8}(?: {5}){0,2}+|L[OT].{0,8})(.{0,5})"), 1)


def _first_stop_past_midnight_in(clocks: Column) -> Column:
    """The same of clocks that are not a column yet; they are bound once."""
    return F.transform(F.array(clocks), _first_stop_past_midnight)[0]


def _first_stop_past_midnight(clocks: str | Column) -> Column:
    """Number of the first stop that is earlier in the day than the stop before it; 0 when there is none."""
    earlier = F.zip_with(F.slice(clocks, F.lit(2), F.size(clocks)), clocks,
                         lambda this, before: F.rpad(this, 5, " ") < F.rpad(before, 5, " "))
    return F.coalesce(F.array_position(earlier, True), F.lit(0)).cast("int")


def _past_midnight() -> Column:
    midnight = F.col("midnight")
    return ((midnight > 0) & (F.col("loc_order") >= midnight)).alias("xmidnight")
