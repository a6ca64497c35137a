"""What ends a ``failfast`` load, and what a ``permissive`` one reports instead."""

import pytest
from lines import HD, ZZ, bs, lo, lt, put, write

from railgrain.operators.quality import timetable_sequence
from railgrain.sources.load import tables_of
from railgrain.sources.stations import read_stations
from railgrain.sources.timetable import read_timetable

TRAIN = [bs("A00001"), lo("S", "0800"), lt("F", "0900")]
TI = put(80, p1="TI", p3="S", p10="00", p12="000000")
TD = put(80, p1="TD", p3="S")


@pytest.mark.parametrize("lines", [
    [HD, *TRAIN, ZZ, *TRAIN],
    [HD, TD, TI, *TRAIN, ZZ],
    [HD, *TRAIN, put(80, p1="XX"), ZZ],
    [*TRAIN, ZZ],
    [HD, *TRAIN, HD, *TRAIN, ZZ],
], ids=["after end", "TI after TD", "unknown", "no header", "two headers"])
def test_order_ends_a_load(spark, tmp_path, lines):
    path = write(tmp_path / "t.mca", lines)
    with pytest.raises(ValueError, match="unexpected record sequence"):
        tables_of(spark, {"mca": path})
    assert timetable_sequence(read_timetable(spark, path, mode="permissive")).count() > 0
    assert "mca.basic_schedule" in tables_of(spark, {"mca": path}, "permissive")


def test_headless_file_keeps_its_keys(spark, tmp_path):
    path = write(tmp_path / "t.mca", [*TRAIN, ZZ])
    rows = read_timetable(spark, path, mode="permissive").stops().collect()
    assert {r.train_uid for r in rows} == {"A00001"} and all(r.date_runs_from for r in rows)
    with pytest.raises(Exception, match="no header"):
        read_timetable(spark, path).stops().collect()


def test_bad_header_and_bad_key(spark, tmp_path):
    bad = put(80, p1="HD", p3="TPS.UDFROC1", p23="981398", p29="0805", p47="F", p48="A", p49="080598", p55="080599")
    with pytest.raises(Exception, match="bad record: header"):
        read_timetable(spark, write(tmp_path / "h.mca", [bad, *TRAIN, ZZ])).stops().collect()
    path = write(tmp_path / "k.mca", [HD, bs("A00001", start="981301"), *TRAIN[1:], ZZ])
    with pytest.raises(Exception, match="date_runs_from"):
        read_timetable(spark, path).stops().collect()
    assert [r.errors for r in read_timetable(spark, path, mode="permissive").stops().collect()] == [["date_runs_from"]] * 2


def station(name):
    return put(82, p1="A", p6=name, p36="3", p37=name, p44="AAA", p50="AAA", p53="15000", p59="62000", p64=" 5")


@pytest.mark.parametrize("title", ["", " " * 82, station("TITLE")])
def test_the_title_goes_whatever_it_is(spark, tmp_path, title):
    path = write(tmp_path / "s.msn", [title, station("ONE"), station("TWO"), put(82, p1="E")])
    assert {r.tiploc_code for r in read_stations(spark, path).station_detail().collect()} == {"ONE", "TWO"}


def test_station_order_ends_a_load(spark, tmp_path):
    path = write(tmp_path / "s.msn", [station("T"), put(82, p1="V"), station("ONE"), put(82, p1="X")])
    with pytest.raises(ValueError, match="unexpected record sequence"):
        tables_of(spark, {"msn": path})
