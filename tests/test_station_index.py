"""The kept name index against the search that reads all names."""

import pytest
from test_plans import plan

from railgrain.operators import station_index
from railgrain.operators.station_index import find_indexed, write_station_index
from railgrain.operators.stations import find_station

STATIONS = "station_name string, cate_type int, tiploc_code string"
ALIASES = "station_name string, alias_name string"
QUERIES = "query_id string, name string"


def both(spark, tmp_path, stations, aliases, names):
    stations, aliases = spark.createDataFrame(stations, STATIONS), spark.createDataFrame(aliases, ALIASES)
    queries = spark.createDataFrame([(str(i), n) for i, n in enumerate(names)], QUERIES)
    write_station_index(stations, aliases, str(tmp_path / "index"))
    df = find_indexed(spark, queries, str(tmp_path / "index"))
    key = lambda d: sorted((int(r.query_id), r.tiploc_code) for r in d.collect())
    return df, key(df), key(find_station(queries, stations, aliases))


@pytest.mark.parametrize("first", [1, 5, 4096])
def test_equals_search(spark, tmp_path, monkeypatch, first):
    monkeypatch.setattr(station_index, "FIRST", first)
    words = ["LONDON", "ROAD", "NORTH", "ABBEY", "ST. JOHN'S", "A", "50%", "X_Y", "WEST END"]
    stations = [(f"{words[i % 9]} {words[i * 7 // 3 % 9]}{'' if i % 4 else ' ' + str(i)}", i % 10, f"C{i:04d}") for i in range(400)]
    stations += [("LONDON ROAD", 9, "AA"), ("N" * 40, 2, "LONG"), (None, 1, "NULL"), ("CATLESS", None, "NOCAT")]
    aliases = [(stations[i][0], f"ALIAS {i % 13} OF {i}") for i in range(0, 400, 5)]
    names = ["london", "road", "c0004", "C0004   ", "alias 5", "%", "_" * 30, "_" * 35, "", "   ", None, "zzz", "n%h", "x\\_y",
             "50\\%", "a", "lon_on r", "LONDON ROAD", "st. john's a", "catless", "n" * 33, " ", "london", "west end 36", "e"]
    _, got, want = both(spark, tmp_path, stations, aliases, names)
    assert got == want and sum(code is not None for _, code in got) >= 15


def test_empty_tables(spark, tmp_path):
    _, got, want = both(spark, tmp_path, [], [], ["a", "%", "abcd"])
    assert got == want == [(0, None), (1, None), (2, None)]


def test_tiers_grow_and_no_name_table_is_read(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(station_index, "FIRST", 4)
    stations = spark.createDataFrame([(f"STATION {i:03d}", 1, f"T{i:03d}") for i in range(100)], STATIONS)
    tiers = station_index._tiered(station_index.name_choices(stations, spark.createDataFrame([], ALIASES)))
    assert sorted((r.tier, r["count"]) for r in tiers.groupBy("tier").count().collect()) == [(0, 4), (1, 32), (2, 64)]
    stations.write.parquet(str(tmp_path / "stations"))
    kept = spark.read.parquet(str(tmp_path / "stations"))
    df, got, _ = both(spark, tmp_path, [tuple(r) for r in kept.collect()], [], ["station 09", "station 0", "tation"])
    assert got == [(0, "T090"), (1, "T000"), (2, "T000")]
    text = plan(df)
    assert str(tmp_path / "stations") not in text and "NestedLoop" not in text and "Cartesian" not in text
