import datetime as dt

import pytest
from lines import HD, ZZ, bs, cr, li, lo, lt, put, write

from railgrain.operators.quality import timetable_sequence
from railgrain.sources.timetable import read_timetable

TRAIN = [
    bs("A00001"), put(80, p1="BX", p7="12345", p12="XC", p14="Y"), put(80, p1="TN", p3="W", p4="A NOTE"),
    lo("START", "2330H"), cr("START"), li("MIDDLE", passing="2359H"), cr("MIDDLE", "   "),
    li("AFTER", "0000", "0001"), lt("FINISH", "0030H"),
]
FILE = [HD, put(80, p1="TI", p3="START", p19="THE START"), *TRAIN, bs("A00002", "C"), bs("A00003", " "),
        bs("A00004", "O", end="999999", speed=""), lo("START", "0800"), lt("FINISH", "0900"), ZZ]


@pytest.mark.parametrize("newline,last", [("\n", True), ("\r\n", True), ("\n", False), ("\r\n", False)])
def test_tables(spark, tmp_path, newline, last):
    scan = read_timetable(spark, write(tmp_path / "t.mca", FILE, newline, last))
    schedules = {r.train_uid: r for r in scan.basic_schedule().collect()}
    assert set(schedules) == {"A00001", "A00002", "A00004"}
    first = schedules["A00001"]
    assert (first.uic_code, first.note.rstrip(), first.speed, first.stp_indicator) == ("12345", "A NOTE", 75, "P")
    assert schedules["A00002"].uic_code is None
    assert schedules["A00004"].date_runs_to == dt.date(9999, 12, 31) and schedules["A00004"].speed is None

    stops = {(r.train_uid, r.loc_order): r for r in scan.stops().collect()}
    assert len(stops) == 6
    assert [stops["A00001", i].xmidnight for i in range(4)] == [False, False, True, True]
    assert stops["A00001", 0].scheduled_departure == 84630
    assert stops["A00001", 1].scheduled_pass == 86370 and stops["A00001", 1].scheduled_arrival is None
    assert stops["A00001", 3].scheduled_arrival == 1830

    changes = {r.loc_order: r for r in scan.changes_en_route().collect()}
    assert (changes[0].speed, changes[1].speed, changes[1].xmidnight) == (100, None, False)
    assert scan.tiploc_insert().first().tps_description == "THE START"
    assert scan.location_specific_note().count() == 0
    assert timetable_sequence(scan).count() == 0


def test_splits_do_not_matter(spark, tmp_path):
    lines = [HD]
    for i in range(3000):
        lines += [bs(f"B{i:05d}"), lo("START", f"{i % 24:02d}00"), li("MID", f"{i % 24:02d}10", f"{i % 24:02d}11"),
                  lt("FINISH", f"{(i + 2) % 24:02d}05")]
    path = write(tmp_path / "big.mca", [*lines, ZZ])
    whole = read_timetable(spark, path).stops().orderBy("train_uid", "loc_order").collect()
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        scan = read_timetable(spark, path)
        assert scan.blocks().rdd.getNumPartitions() > 20
        assert scan.stops().orderBy("train_uid", "loc_order").collect() == whole
        assert timetable_sequence(scan).count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len(whole) == 9000 and sum(r.xmidnight for r in whole) == 125 * 2


@pytest.mark.parametrize("lines,reason", [
    ([HD, bs("A00001"), lo("S", "0800"), ZZ], "order of records"),
    ([HD, bs("A00001"), lo("S", "0800"), lt("F", "0900"), li("M", "0930"), ZZ], "order of records"),
    ([HD, bs("A00001"), lo("S", "0800"), put(80, p1="LN", p3="G"), lt("F", "0900"), ZZ], "order of records"),
    ([HD, bs("A00001"), lo("S", "0800"), cr("S"), cr("S"), lt("F", "0900"), ZZ], "order of records"),
    ([HD, bs("A00001"), "", lo("S", "0800"), lt("F", "0900"), ZZ], "order of records"),
    ([HD, put(80, p1="AA"), put(80, p1="TI"), ZZ], "order of records"),
    ([HD, bs("A00001", "C"), ZZ, bs("A00002", "C")], "record after end"),
    ([bs("A00001", "C"), ZZ], "start of file"),
])
def test_illegal_order(spark, tmp_path, lines, reason):
    path = write(tmp_path / "bad.mca", lines)
    found = timetable_sequence(read_timetable(spark, path, mode="permissive")).collect()
    assert reason in {r.reason for r in found}
    if reason == "order of records" and "AA" not in lines[1]:
        with pytest.raises(Exception, match="unexpected record sequence"):
            read_timetable(spark, path).stops().collect()


@pytest.mark.parametrize("train,table,error", [
    ([bs("A00001", "X"), lo("S", "0800"), lt("F", "0900")], "basic_schedule", "stp_indicator"),
    ([bs("A00001", days="111111x"), lo("S", "0800"), lt("F", "0900")], "basic_schedule", "days_run"),
    ([bs("A00001", start="981301"), lo("S", "0800"), lt("F", "0900")], "basic_schedule", "date_runs_from"),
    ([bs("A00001", speed="7x "), lo("S", "0800"), lt("F", "0900")], "basic_schedule", "speed"),
    ([bs("A00001", "C"), lo("S", "0800"), lt("F", "0900")], "basic_schedule", "cancellation with stops"),
    ([bs("A00001"), lo("S", "2500", "0800"), lt("F", "0900")], "origin_location", "scheduled_departure"),
    ([bs("A00001", start="981301"), lo("S", "0800"), lt("F", "0900")], "origin_location", "date_runs_from"),
    ([bs("A00001", "X"), lo("S", "0800"), cr("S"), li("M", "0810", "0811"), lt("F", "0900")], "changes_en_route", "stp_indicator"),
    ([bs("A00001"), lo("S", "0800"), lt("F\xe9", "0900")], "terminating_location", "not ascii"),
    ([bs("A00001"), lo("S", "0800"), li("M"), lt("F", "0900")], "intermediate_location", "no time"),
    ([bs("A00001"), lo("S", "0800"), li("M"), lt("F", "0900")], "stops", "no time"),
])
def test_bad_fields(spark, tmp_path, train, table, error):
    path = write(tmp_path / "bad.mca", [HD, *train, ZZ])
    rows = getattr(read_timetable(spark, path, mode="permissive"), table)().collect()
    assert [e for r in rows for e in r.errors] == [error]
    with pytest.raises(Exception, match=error):
        getattr(read_timetable(spark, path), table)().collect()


def test_ztrain(spark, tmp_path):
    train = [bs("Z00001", start="590101", end="591231"), put(80, p1="BX", p14=" "), lo("ABC", "0800"), lt("DEF", "0900")]
    scan = read_timetable(spark, write(tmp_path / "z.ztr", [put(80, p1="HD"), *train, *train, ZZ]), "ztrain")
    assert [r.date_runs_from for r in scan.basic_schedule().collect()] == [dt.date(2015, 1, 1)] * 2
    assert scan.stops().count() == 4
