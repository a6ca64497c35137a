import datetime as dt

import pytest
from pyspark.sql import functions as F

from railgrain.functions.decoders import decode, rejected
from railgrain.functions.timeofday import add_minutes, clock
from railgrain.operators.connections import ready_to_leave

CASES = [
    ("yymmdd", "600101", dt.date(1960, 1, 1)),
    ("yymmdd", "591231", dt.date(2059, 12, 31)),
    ("yymmdd", "999999", dt.date(9999, 12, 31)),
    ("yymmdd", "000229", dt.date(2000, 2, 29)),
    ("yymmdd", "010229", None),
    ("yymmdd", "98 509", None),
    ("ddmmyy", "090598", dt.date(1998, 5, 9)),
    ("ddmmyy", "311160", None),
    ("yymmdd1956", "590228", dt.date(2015, 2, 28)),
    ("yymmdd1956", "000101", dt.date(1956, 1, 1)),
    ("yymmdd1956", "999999", dt.date(9999, 12, 31)),
    ("yymmdd1956", "ab0101", None),
    ("dd/mm/yyyy", "09-05-2015", dt.date(2015, 5, 9)),
    ("dd/mm/yyyy", "32/05/2015", None),
    ("time", "0000", 0),
    ("time", "2359", 86340),
    ("time", "2400", None),
    ("time", "1260", None),
    ("time", " 800", 28800),
    ("timeh", "0800H", 28830),
    ("timeh", "0800 ", 28800),
    ("timeh", "     ", None),
    ("timeh?", "2359H", 86370),
    ("int", " 75", 75),
    ("int", "7 5", None),
    ("int?", "   ", None),
    ("text", "ABC  ", "ABC"),
    ("flag", " ", " "),
    ("days", "1000001", [True, False, False, False, False, False, True]),
    ("days", "1000002", None),
    ("days", "100000", None),
    ("activity", "TBT -D      ", ["TB", "T ", "-D", "  ", "  ", "  "]),
    ("routeing", "ABC DEF " + " " * 32, ["ABC", "DEF"] + ["   "] * 8),
]


@pytest.mark.parametrize("kind,text,value", CASES)
def test_decode(spark, kind, text, value):
    row = spark.createDataFrame([(text,)], "t string").select(decode(kind, F.col("t"))).first()
    assert row[0] == value


@pytest.mark.parametrize("kind,text,allowed,bad", [
    ("int", "   ", (), True), ("int?", "   ", (), False), ("int?", "a  ", (), True),
    ("timeh", "     ", (), True), ("timeh?", "     ", (), False), ("timeh?", "25   ", (), True),
    ("flag", "X", (" ", "B"), True), ("flag", " ", (" ", "B"), False), ("days", "11111x1", (), True),
    ("yymmdd", "991332", (), True), ("choice", "BUS", ("BUS",), False),
])
def test_rejected(spark, kind, text, allowed, bad):
    row = spark.createDataFrame([(text,)], "t string").select(rejected(kind, F.col("t"), allowed)).first()
    assert row[0] is bad


def test_clock_arithmetic(spark):
    row = spark.createDataFrame([(86370, 2, 43230)], "a int, m int, n int").select(
        add_minutes(F.col("a"), F.col("m")), clock(F.col("n")), ready_to_leave(F.col("a"), F.col("m")),
        ready_to_leave(F.col("n"), F.col("m")), ready_to_leave(F.col("n"), F.lit(None).cast("int"))).first()
    assert tuple(row) == (90, "12:00:30", 86370, 43350, 43230)
