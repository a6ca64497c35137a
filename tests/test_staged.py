"""All tables of a timetable from one pass over its text are the tables that are read one by one."""

import pytest
from lines import HD, ZZ, bs, cr, li, lo, lt, put, write

from railgrain.sources.timetable import read_timetable

TABLES = ("basic_schedule", "origin_location", "intermediate_location", "changes_en_route", "terminating_location",
          "location_specific_note", "associations", "tiploc_insert", "tiploc_amend", "tiploc_delete", "stops", "header")
NOTE = put(80, p1="LN", p3="G", p4="NOTE")
TRAINS = [bs("A00001"), put(80, p1="BX", p12="XC", p14="Y"), put(80, p1="TN", p3="W", p4="TEXT"), lo("S", "2300"), li("M", "2330", "2331"),
          cr("M"), li("N", "0010", "0011"), lt("F", "0100"), bs("A00002", "C"), bs("A00003"), lo("S", "0800"), lt("F", "0900")]


@pytest.mark.parametrize("mode,lines", [
    ("failfast", [HD, put(80, p1="TI", p3="S", p10="00", p12="000000"), put(80, p1="TD", p3="S"), *TRAINS, ZZ]),
    ("permissive", [HD, *TRAINS, bs("A00004", start="981301"), NOTE, lo("S", "0800"), NOTE, lt("F", "2500"), ZZ]),
])
def test_staged_tables_equal_single_ones(spark, tmp_path, mode, lines):
    scan = read_timetable(spark, write(tmp_path / "t.mca", lines, "\r\n"), mode=mode)
    staged = scan.staged()
    for name in TABLES:
        one, other = getattr(scan, name)(), getattr(staged, name)()
        assert one.columns == other.columns
        assert sorted(map(str, one.collect())) == sorted(map(str, other.collect())), name


def test_tables_read_the_text_once(spark, tmp_path):
    path = write(tmp_path / "t.mca", [HD, *TRAINS, ZZ])
    tables = read_timetable(spark, path).tables()
    for df in tables.values():
        plan = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
        assert "FileScan text" not in plan and "Scan text" not in plan and "type" in plan
