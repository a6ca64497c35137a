import io
import zipfile

import pytest
from lines import HD, ZZ, bs, lo, lt, put, write

from railgrain.operators.quality import station_sequence
from railgrain.sources.interchange import read_interchange
from railgrain.sources.links import read_fixed_links
from railgrain.sources.load import load
from railgrain.sources.naptan import read_naptan
from railgrain.sources.stations import read_stations

TITLE = put(82, p1="A", p31="FILE-SPEC=05")


def station(name, cate, tiploc, code):
    return put(82, p1="A", p6=name, p36=str(cate), p37=tiploc, p44=code, p50=code, p53="15000", p59="62000", p64=" 5")


STATIONS = [TITLE, station("ONE", 9, "ONE", "AAA"), station("TWO", 3, "TWO", "AAA"),
            put(82, p1="L", p6="TWO", p37="OTHER TWO"), put(82, p1="V", p6="GROUP", p37="AAA BBB"),
            put(82, p1="Z"), put(82, p1=" "), put(82, p1="E")]
LINKS = ["M=WALK,O=AAA,D=BBB,T=5,S=0001,E=2359,P=4,R=1111100",
         "M=TUBE,O=AAA,D=CCC,T=99,T=7,S=0001,E=2359,P=4,F=01/02/2015,U=28/02/2015,R=0000011"]


def test_stations(spark, tmp_path):
    scan = read_stations(spark, write(tmp_path / "s.msn", STATIONS, "\r\n"))
    rows = {r.tiploc_code: r for r in scan.station_detail().collect()}
    assert set(rows) == {"ONE", "TWO"} and rows["ONE"].cate_type == 9 and rows["TWO"].change_time == 5
    assert scan.station_alias().first().alias_name == "OTHER TWO"
    assert scan.routeing_groups().first().station[:3] == ["AAA", "BBB", "   "]
    assert station_sequence(scan).count() == 0


@pytest.mark.parametrize("lines,pair", [
    ([TITLE, put(82, p1="L")], ("title", "L")),
    ([*STATIONS, put(82, p1="A")], ("E", "A")),
    ([TITLE, STATIONS[1], put(82, p1="E")], ("A", "E")),
])
def test_station_order(spark, tmp_path, lines, pair):
    scan = read_stations(spark, write(tmp_path / "s.msn", lines), mode="permissive")
    assert [(r.before, r.after) for r in station_sequence(scan).collect()] == [pair]


def test_station_order_over_splits(spark, tmp_path):
    lines = [TITLE, *[station(f"S{i}", 1, f"S{i}", "AAA") for i in range(2000)], put(82, p1="V"), put(82, p1="L"),
             put(82, p1="E")]
    path = write(tmp_path / "s.msn", lines)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "10000")
    try:
        scan = read_stations(spark, path)
        assert scan.station_detail().count() == 2000
        assert {(r.before, r.after, r["count"]) for r in station_sequence(scan).collect()} == {
            ("A", "V", 1), ("V", "L", 1)}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_links(spark, tmp_path):
    walk, tube = read_fixed_links(spark, write(tmp_path / "l.alf", LINKS)).orderBy("link_time").collect()
    assert walk.start_date is None and walk.start_time == 60 and walk.days_of_week[4] is True
    assert tube.link_time == 7 and str(tube.end_date) == "2015-02-28"


@pytest.mark.parametrize("line,error", [
    ("M=WALK,X=1", "unknown key"), ("M=PLANE", "mode"), ("T=x", "link_time"), ("R=12", "days_of_week"),
])
def test_bad_links(spark, tmp_path, line, error):
    path = write(tmp_path / "l.alf", [line])
    assert read_fixed_links(spark, path, mode="permissive").first().errors == [error]
    with pytest.raises(Exception, match=error):
        read_fixed_links(spark, path).collect()


def test_interchange(spark, tmp_path):
    path = write(tmp_path / "t.tsi", ["AAA,XC,GW,10,Comment", "AAA,XC,GW,10", "AAA,XC,GW,10,a,b"])
    errors = [r.errors for r in read_interchange(spark, path, mode="permissive").collect()]
    assert errors == [[], ["not five fields"], ["not five fields"]]
    with pytest.raises(Exception, match="not five fields"):
        read_interchange(spark, path).collect()


def archive(path, members):
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as z:
        for name, lines in members.items():
            z.writestr(name, "\r\n".join(lines) + "\r\n")
    path.write_bytes(data.getvalue())
    return str(path)


def test_load(spark, tmp_path):
    members = {"a.mca": [HD, bs("A00001"), lo("ONE", "0800"), lt("TWO", "0900"), ZZ], "a.msn": STATIONS,
               "a.alf": LINKS, "old.alf": LINKS[:1]}
    path = archive(tmp_path / "ttf.zip", members)
    tables = load(spark, path, skip={"ztr", "tsi"})
    assert tables["mca.origin_location"].first().location == "ONE"
    assert tables["msn.station_detail"].count() == 2
    assert tables["alf.alf"].count() == 1  # the last member of that ending
    with pytest.raises(Exception, match="no member ztr"):
        load(spark, path, skip={"tsi"})
    upper = archive(tmp_path / "old.zip", {k.upper(): v for k, v in members.items()})
    old = load(spark, upper, skip={"ztr", "tsi", "alf"}, old_naming=True)
    assert old["mca.basic_schedule"].count() == 1 and "alf.alf" not in old


def test_naptan(spark, tmp_path):
    path = archive(tmp_path / "n.zip", {"RailReferences.csv": [
        "AtcoCode,Tiploc,...", '"9100ONE","ONE","AAA","One, Main","","U",123456,654321,2015-01-01']})
    row = read_naptan(spark, path).first()
    assert (row.stationname, row.easting, row.northing, row.tiploc) == ("One, Main", 123456, 654321, "ONE")
