"""Loads that break keys or references publish nothing; whole loads replace what they bring and leave the rest."""

import pytest
from lines import HD, ZZ, bs, lo, lt, put
from test_other_scans import LINKS, STATIONS, archive

from railgrain.sources.constraints import CHILDREN, KEYS, violations
from railgrain.sources.load import LoadRejected, load_into, publish, published

PLACE = put(80, p1="TI", p3="S", p10="00", p12="000000")
TRAIN = [bs("A00001"), lo("S", "0800"), lt("F", "0900")]
SKIP = {"ztr", "tsi", "alf"}
TITLE = "AtcoCode,Tiploc,..."


def timetable(*trains, places=(PLACE,)):
    return [HD, *places, *(line for train in trains for line in train), ZZ]


def zipped(path, mca, msn=STATIONS):
    return archive(path, {"a.mca": mca, "a.msn": msn, "a.alf": LINKS})


def naptan(path, *codes):
    return archive(path, {"RailReferences.csv": [TITLE, *(f'"9100{c}","{c}","AAA","One","","U",1,2' for c in codes)]})


def test_load_and_reload(spark, tmp_path):
    base = str(tmp_path / "base")
    first = load_into(spark, base, zipped(tmp_path / "1.zip", timetable(TRAIN)), SKIP, naptan=naptan(tmp_path / "n.zip", "ONE", "TWO"))
    assert first["mca.basic_schedule"].count() == 1 and first["naptan.railreferences"].count() == 2
    assert set(first) == set(published(spark, base)) >= set(KEYS)
    other = [bs("A00002"), *TRAIN[1:]]
    second = load_into(spark, base, zipped(tmp_path / "2.zip", timetable(TRAIN, other)), SKIP | {"msn"})
    assert second["mca.basic_schedule"].count() == 2 and second["msn.station_detail"].count() == 2
    assert second["mca.location_specific_note"].count() == 0


STATION = STATIONS[1]


@pytest.mark.parametrize("mca,msn,codes,table,rule,n", [
    (timetable(TRAIN, TRAIN), STATIONS, "A", "mca.basic_schedule", "repeated key", 2),
    (timetable(TRAIN, places=(PLACE, PLACE, PLACE)), STATIONS, "A", "mca.tiploc_insert", "repeated key", 3),
    (timetable(TRAIN), [*STATIONS[:2], STATION, *STATIONS[2:]], "A", "msn.station_detail", "repeated key", 2),
    (timetable(TRAIN), STATIONS, "AA", "naptan.railreferences", "repeated key", 2),
])
def test_broken_keys_publish_nothing(spark, tmp_path, mca, msn, codes, table, rule, n):
    base = str(tmp_path / "base")
    load_into(spark, base, zipped(tmp_path / "good.zip", timetable(TRAIN)), SKIP)
    folders = sorted(p.name for p in (tmp_path / "base").iterdir())
    with pytest.raises(LoadRejected, match=rule) as rejected:
        load_into(spark, base, zipped(tmp_path / "bad.zip", mca, msn), SKIP, naptan=naptan(tmp_path / "n.zip", *codes))
    assert (table, rule, n) in {(r["table"], r["rule"], r["n"]) for r in rejected.value.violations.collect()}
    assert sorted(p.name for p in (tmp_path / "base").iterdir()) == folders
    assert "naptan.railreferences" not in published(spark, base)
    assert published(spark, base)["mca.basic_schedule"].count() == 1


def test_bad_record_publishes_nothing(spark, tmp_path):
    base = str(tmp_path / "base")
    bad = timetable([bs("A00001", speed="?"), *TRAIN[1:]])
    with pytest.raises(Exception, match="bad record"):
        load_into(spark, base, zipped(tmp_path / "bad.zip", bad), SKIP)
    assert published(spark, base) == {} and list((tmp_path / "base").iterdir()) == []


def test_repeated_ztrains_are_no_error(spark, tmp_path):
    path = archive(tmp_path / "z.zip", {"a.ztr": [put(80, p1="HD"), *TRAIN, *TRAIN, ZZ]})
    assert load_into(spark, str(tmp_path / "base"), path, SKIP - {"ztr"} | {"mca", "msn"})["ztr.basic_schedule"].count() == 2


def test_calls_without_schedule_and_null_keys(spark, tmp_path):
    schema = "train_uid string, date_runs_from string, stp_indicator string, loc_order int"
    keys = spark.createDataFrame([("A", "1", "P"), ("B", "1", "P"), (None, "1", "P"), (None, "1", "P")], schema.rsplit(",", 1)[0])
    calls = spark.createDataFrame([("A", "1", "P", 0), ("A", "2", "P", 0), ("A", "2", "P", 1), (None, "1", "P", 0)], schema)
    tables = {"mca.basic_schedule": keys, **dict.fromkeys(CHILDREN, calls)}
    found = {tuple(r) for r in violations(tables).collect()}
    assert found == {("mca.basic_schedule", "null key", "null / 1 / P", 2)} | {
        (c, *rest) for c in CHILDREN for rest in (("null key", "null / 1 / P / 0", 1), ("no schedule", "A / 2 / P", 2))}
    with pytest.raises(LoadRejected):
        publish(spark, tables, str(tmp_path / "base"))
    assert published(spark, str(tmp_path / "base")) == {}


def test_nothing_to_publish(spark, tmp_path):
    assert publish(spark, {}, str(tmp_path / "base")) == {}
    with pytest.raises(ValueError, match="none of these tables"):
        violations({"alf.alf": spark.range(1)})
