"""Scan of fixed-link files: one ``KEY=VALUE,KEY=VALUE`` line per link."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.decoders import decode, rejected
from .layouts import LINK_KEYS, TRANSPORT_MODES
from .records import judged


def _last(key: str) -> Column:
    """Text of the last pair with a key."""
    return F.try_element_at(F.filter("pairs", lambda p: p["key"] == key), F.lit(-1))["text"]


def read_fixed_links(spark: SparkSession, path: str, mode: str = "failfast") -> DataFrame:
    """An absent key gives NULL, a repeated one its last value, an unknown one is an error."""
    pairs = F.transform(F.split(F.rtrim("value"), ","), lambda part: F.struct(
        F.substring_index(part, "=", 1).alias("key"),
        F.regexp_replace(part, "^[^=]*=?", "").alias("text")))
    lines = spark.read.text(path).select("value", pairs.alias("pairs"))
    given = lines.select("value", "pairs", *[_last(key).alias(name) for key, name, _ in LINK_KEYS])
    known = [key for key, _, _ in LINK_KEYS]
    found = [F.when(F.exists("pairs", lambda p: ~p["key"].isin(known)), F.lit("unknown key")),
             F.when(F.col("value").rlike(r"[^\x00-\x7F]"), F.lit("not ascii"))]
    out = []
    for _, name, kind in LINK_KEYS:
        text = F.col(name)
        bad = rejected(kind, text, TRANSPORT_MODES)
        if bad is not None:
            found.append(F.when(text.isNotNull() & bad, F.lit(name)))
        out.append(decode(kind, text).alias(name))
    return judged(given, F.coalesce(*found).isNull(), found, out, mode)
