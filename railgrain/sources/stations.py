"""Scan of fixed-width station files: details, aliases and routeing groups."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import layouts as L
from .records import columns, judged, problems, well_formed

# Which record type may follow which.
_TRAILERS = "Z0M-E"
SEQUENCE = {
    "A": "ABCL",
    "B": "ABCL",
    "C": "ACL",
    "L": "LGRV" + _TRAILERS,
    "G": "GRV" + _TRAILERS,
    "R": "RV" + _TRAILERS,
    "V": "V" + _TRAILERS,
    "Z": _TRAILERS + " ",
    "0": _TRAILERS + " ",
    "M": _TRAILERS + " ",
    "-": _TRAILERS + " ",
    " ": _TRAILERS + " ",
    "E": "",
}


class StationScan:
    """Lazy tables over one or many station files.

    The first line of each file is a title that may look like any record, or be blank.  It is known by its
    place: the first row of the split that starts the file.  Station files are a few megabytes, so a second look
    at them is cheap.
    """

    def __init__(self, spark: SparkSession, path: str, mode: str = "failfast"):
        self._spark, self._path, self._mode = spark, path, mode

    def _table(self, record_type: str, layout) -> DataFrame:
        lines = self._lines()
        titles = lines.filter("split = 0").groupBy("file").agg(F.min("row").alias("row"))
        line = F.col("line")
        typed = lines.filter(F.col("value").startswith(record_type)).join(
            titles.withColumn("title", F.lit(True)), ["file", "row"], "left").select(
            F.rpad("value", L.STATION_WIDTH, " ").alias("line"), "title")
        # The title takes part in the test, or the test would move below the join and meet titles too.
        title = F.col("title").isNotNull()
        return judged(typed, title | well_formed(line, {record_type: layout}), problems(line, layout),
                      [*columns(line, layout), F.col("title")], self._mode).filter("title is null").drop("title")

    def station_detail(self) -> DataFrame:
        return self._table("A", L.STATION_DETAIL)

    def station_alias(self) -> DataFrame:
        return self._table("L", L.STATION_ALIAS)

    def routeing_groups(self) -> DataFrame:
        return self._table("V", L.ROUTEING_GROUPS)

    def tables(self) -> dict[str, DataFrame]:
        return {name: getattr(self, name)()
                for name in ("station_detail", "station_alias", "routeing_groups")}

    def _lines(self) -> DataFrame:
        return self._spark.read.text(self._path).select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("split"),
            F.monotonically_increasing_id().alias("row"), "value")

    def types(self) -> DataFrame:
        """Type of every line with what is needed to put the lines of one split in order."""
        return self._lines().select("file", "split", "row", F.substring(F.rpad("value", 1, " "), 1, 1).alias("type"))


def read_stations(spark: SparkSession, path: str, mode: str = "failfast") -> StationScan:
    return StationScan(spark, path, mode)
