"""Rail stations from the national stops archive: ``RailReferences.csv`` inside a zip file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .archive import member_lines, read_archives
from .layouts import RAIL_REFERENCE_COLUMNS
from .records import judged

MEMBER = "RailReferences.csv"


def read_naptan(spark: SparkSession, source: str | DataFrame, mode: str = "failfast") -> DataFrame:
    """Stations of the archives at a path, or given as rows of path and bytes."""
    return rail_references(read_archives(spark, source), mode)


def rail_references(archives: DataFrame, mode: str = "failfast") -> DataFrame:
    """The first eight columns; a comma inside quotes belongs to its field.

    A line with fewer columns, or a grid reference that is no whole number, is a bad record.  The key is the tiploc
    code, which ``load.load_into`` enforces.
    """
    lines = member_lines(archives, (MEMBER,), by_suffix=False).filter("line_no > 0")
    schema = ", ".join(f"{name} string" for name in RAIL_REFERENCE_COLUMNS)
    row = F.from_csv("value", schema, {"mode": "PERMISSIVE"})
    numbers = ("easting", "northing")
    rows = lines.select(row.alias("r"))
    whole = {n: F.trim(F.col(f"r.{n}")).try_cast("int") for n in numbers}
    short = F.col(f"r.{RAIL_REFERENCE_COLUMNS[-1]}").isNull()
    found = [F.when(short, F.lit("too few fields"))] + [
        F.when(~short & value.isNull(), F.lit(n)) for n, value in whole.items()]
    valid = ~short & whole["easting"].isNotNull() & whole["northing"].isNotNull()
    out = [(whole[n] if n in numbers else F.rtrim(F.col(f"r.{n}"))).alias(n) for n in RAIL_REFERENCE_COLUMNS]
    return judged(rows, valid, found, out, mode)
