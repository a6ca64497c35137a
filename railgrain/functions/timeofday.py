"""Time of day as an INT of seconds since midnight.

Half minutes need seconds, and Spark's TIME type is off by default, so every time in every table is an
integer; :func:`clock` formats it at the edge.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY = 86400

# a digit of either number may be left blank
HHMM = "(?:[01 ][0-9]|2[0-3]|[0-9] )(?:[0-5 ][0-9]|[0-9] )"


def parse_hhmm(text: Column) -> Column:
    """``HHMM`` as seconds, NULL when it is blank or is no time of day."""
    hour = F.substring(text, 1, 2).try_cast("int")
    minute = F.substring(text, 3, 2).try_cast("int")
    return F.when(text.rlike(f"^{HHMM}"), hour * 3600 + minute * 60)


def parse_hhmmh(text: Column) -> Column:
    """``HHMM`` plus a fifth character; ``H`` there adds half a minute."""
    return parse_hhmm(text) + F.when(F.substring(text, 5, 1) == "H", 30).otherwise(0)


def add_minutes(seconds: Column, minutes: Column) -> Column:
    """Clock arithmetic: the sum wraps at midnight."""
    return F.pmod(seconds + minutes * 60, F.lit(DAY)).cast("int")


def clock(seconds: Column) -> Column:
    """``HH:mm:ss`` text."""
    two = lambda c: F.lpad(F.floor(c).cast("string"), 2, "0")
    return F.concat_ws(":", two(seconds / 3600), two((seconds % 3600) / 60), two(seconds % 60))
