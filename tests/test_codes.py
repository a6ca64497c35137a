"""Codes of derived rows stay distinct as the data grow, and station search takes any text."""

import duckdb
import pytest

from railgrain.operators.stations import find_station
from railgrain.plans.fixtures import coded, train

NUMBERS = [0, 1, 9, 10, 35, 36, 99_999, 100_000, 999_999, 1_000_000, 1_000_001, 2_600_000, 2_600_001, 2**31, 2**31 + 1]


@pytest.mark.parametrize("sql", [coded("n", 6), coded("n", 8), train("n", 0), train("n", 1)])
def test_codes_are_distinct_and_agree(spark, sql):
    values = ", ".join(f"({n})" for n in NUMBERS)
    ours = [r[0] for r in spark.sql(f"select {sql} c from (values {values}) t(n)").collect()]
    theirs = [r[0] for r in duckdb.sql(f"select {sql} c from (values {values}) t(n)").fetchall()]
    assert ours == theirs and len(set(ours)) == len(NUMBERS) and len(set(map(len, ours))) == 1


def test_kinds_of_trains_are_apart(spark):
    codes = spark.range(5000).selectExpr(*(f"{train('id', k)} as c{k}" for k in range(3))).collect()
    assert len({x for r in codes for x in r}) == 15_000


def search(spark, names, **queries):
    stations = spark.createDataFrame([(n, 3, f"T{i}") for i, n in enumerate(names)],
                                     "station_name string, cate_type int, tiploc_code string")
    aliases = spark.createDataFrame([], "station_name string, alias_name string")
    asked = spark.createDataFrame(list(queries.items()), "query_id string, name string")
    return {r.query_id: r.tiploc_code for r in find_station(asked, stations, aliases).collect()}


def test_search_takes_escapes_wildcards_and_long_names(spark):
    names = ["LONDON", "50% OFF", "A_B", "BACK\\SLASH", "X" * 28 + "YZ BEYOND THIRTY", "ENDS IN TWENTY NINE LETTERS %%%"]
    got = search(spark, names, plain="lon\\don", pct="0\\%", under="a\\_b", no="a\\_x", slash="k\\\\s", any="%", some="___",
                 long="beyond thirty", too="_" * 40, most="_" * 60, end="%\\", mixed="l%n\\d")
    assert got == {"plain": "T0", "pct": "T1", "under": "T2", "no": None, "slash": "T3", "any": "T1", "some": "T1", "long": "T4",
                   "too": "T4", "most": None, "end": "T5", "mixed": "T0"}
