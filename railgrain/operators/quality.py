"""Checks of loaded data; each returns the offending rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.stations import SEQUENCE, StationScan
from ..sources.timetable import TimetableScan, legal_sequence, record_types


def timetable_sequence(scan: TimetableScan) -> DataFrame:
    """Blocks with records in an illegal order: ``(file, codes, reason)``.

    Inside a block the order is tested with a pattern.  Across blocks, every file must start with a header
    and nothing may follow its end record; that needs only a few numbers of each split of a file.  Both come from one
    pass over the text, which gives one row a split, with the codes of its illegal blocks.
    """
    blocks, block = scan.blocks(), F.col("block")
    header = block.startswith("HD")  # a headless file has no HD
    end = block.contains("\nZZ") & F.substring_index(block, "\n", -1).startswith("ZZ")
    row = F.col("position.row")
    splits = blocks.groupBy("file", F.col("position.split").alias("split")).agg(
        F.min(row).alias("first"), F.min(F.when(header, row)).alias("first_header"), F.max(row).alias("last"),
        F.min(F.when(end, row)).alias("first_end"), F.count_if(header).alias("headers"),
        F.collect_list(F.when(~legal_sequence(), record_types())).alias("illegal"))
    of_file = Window.partitionBy("file")
    at = lambda name: F.when(F.col(name).isNotNull(), F.struct("split", name))
    files = splits.select(
        "file", "split", "illegal", F.min(at("first")).over(of_file).alias("first"), F.min(at("first_header")).over(of_file).alias("first_header"),
        F.max(at("last")).over(of_file).alias("last"), F.min(at("first_end")).over(of_file).alias("first_end"),
        F.sum("headers").over(of_file).alias("headers"))
    no_start = F.col("first_header").isNull() | (F.col("first") != F.col("first_header")) | (F.col("headers") > 1)
    across = F.array_compact(F.array(
        F.when(no_start, F.lit("start of file")), F.when(F.col("last") > F.col("first_end"), F.lit("record after end"))))
    found = lambda codes, reason: F.struct(codes.alias("codes"), reason.alias("reason"))
    inside = F.transform("illegal", lambda codes: found(codes, F.lit("order of records")))
    once_a_file = F.when(F.col("split") == F.col("first.split"), F.transform(across, lambda reason: found(F.lit(""), reason)))
    return files.select("file", F.inline(F.concat(inside, F.coalesce(once_a_file, F.array()))))


def station_sequence(scan: StationScan) -> DataFrame:
    """Places where a record type follows one it may not follow: ``(file, before, after, count)``.

    Neighbours are found within each file split, whose size is bounded by the scan; what joins one split to
    the next is only its first and last line.
    """
    lines = scan.types()
    by_line = Window.partitionBy("file", "split").orderBy("row")
    inner = lines.select("file", "split", "row", "type", F.lag("type").over(by_line).alias("before"))
    edges = lines.groupBy("file", "split").agg(
        F.min(F.struct("row", "type"))["type"].alias("first"),
        F.max(F.struct("row", "type"))["type"].alias("last"))
    by_split = Window.partitionBy("file").orderBy("split")
    seams = edges.select("file", "split", F.col("first").alias("type"),
                         F.lag("last").over(by_split).alias("before"))
    title = F.lit("title")
    # the title line may look like any record, so it is known by its place
    top = lines.filter("split = 0").groupBy("file").agg(F.min("row").alias("row"))
    pairs = inner.filter("before is not null").join(
        top.select("file", (F.col("row")).alias("top")), "file", "left"
    ).select("file", "type", F.when((F.col("split") == 0) & (F.col("row") == F.col("top") + 1), title)
             .otherwise(F.col("before")).alias("before"))
    joined = pairs.union(seams.filter("before is not null").select("file", "type", "before"))
    return joined.filter(~_may_follow(F.col("before"), F.col("type"))).groupBy(
        "file", "before", F.col("type").alias("after")).count()


def _may_follow(before: Column, after: Column) -> Column:
    legal = [b + a for b, all_after in SEQUENCE.items() for a in all_after]
    return F.when(before == "title", after == "A").otherwise(F.concat(before, after).isin(*legal))


def invalid_fields(decoded: DataFrame) -> DataFrame:
    """Rows of a ``permissive`` scan that have errors."""
    return decoded.filter(F.size("errors") > 0)


def duplicate_keys(df: DataFrame, key: list[str]) -> DataFrame:
    return df.groupBy(*key).count().filter("count > 1")


def orphan_stops(stops: DataFrame, schedules: DataFrame) -> DataFrame:
    """Stops whose schedule does not exist."""
    key = ["train_uid", "date_runs_from", "stp_indicator"]
    return stops.join(schedules.select(*key), key, "left_anti")
