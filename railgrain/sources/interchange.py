"""Scan of operator-specific interchange times: five comma-separated fields, no quoting."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.decoders import decode, rejected
from .layouts import INTERCHANGE_COLUMNS
from .records import judged


def read_interchange(spark: SparkSession, path: str, mode: str = "failfast") -> DataFrame:
    parts = spark.read.text(path).select("value", F.split(F.rtrim("value"), ",").alias("parts"))
    found = [F.when(F.size("parts") != len(INTERCHANGE_COLUMNS), F.lit("not five fields")),
             F.when(F.col("value").rlike(r"[^\x00-\x7F]"), F.lit("not ascii"))]
    out = []
    for i, (name, kind) in enumerate(INTERCHANGE_COLUMNS):
        text = F.try_element_at("parts", F.lit(i + 1))
        bad = rejected(kind, text)
        if bad is not None:
            found.append(F.when(bad, F.lit(name)))
        out.append(decode(kind, text).alias(name))
    return judged(parts, F.coalesce(*found).isNull(), found, out, mode)
