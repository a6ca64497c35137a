"""Plans that have to hold at scale."""

import datetime as dt

from pyspark.sql import functions as F

from railgrain.functions.grid import grid_to_latlon
from railgrain.operators.schedule import full_timetable, schedules_on
from railgrain.operators.stations import find_station

DAY = dt.date(1998, 5, 9)


def plan(df):
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def schedules(spark, n=30000, others=3):
    """All rows but one in ``others`` belong to one train."""
    return spark.range(n).select(
        F.when(F.col("id") % others > 0, "HOT000").otherwise(F.concat(F.lit("A"), F.lpad((F.col("id") % 9999).cast(
            "string"), 5, "0"))).alias("train_uid"),
        F.date_sub(F.lit(DAY), (F.col("id") % 50).cast("int")).alias("date_runs_from"),
        F.date_add(F.lit(DAY), (F.col("id") % 50).cast("int")).alias("date_runs_to"),
        F.array([F.lit(True)] * 7).alias("days_run"),
        F.element_at(F.array([F.lit(c) for c in "OP"]), (F.col("id") % 2 + 1).cast("int")).alias("stp_indicator"))


def test_date_filter_reaches_the_scan(spark, tmp_path):
    schedules(spark).write.parquet(str(tmp_path / "s"))
    text = plan(schedules_on(spark.read.parquet(str(tmp_path / "s")), [DAY]))
    assert "LessThanOrEqual(date_runs_from,1998-05-09)" in text
    assert "GreaterThanOrEqual(date_runs_to,1998-05-09)" in text
    assert "Window" not in text


def test_hot_train_is_split(spark):
    """The join that gives a hot train its indicator is a skew join once its partition is large enough."""
    options = {"spark.sql.autoBroadcastJoinThreshold": "-1",
               "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
               "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
               "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5"}
    before = {k: spark.conf.get(k) for k in options}
    for k, v in options.items():
        spark.conf.set(k, v)
    try:
        hot = schedules(spark, 200000, others=20)
        df = schedules_on(hot.repartition(16), [DAY])
        rows = df.count()
        df.collect()
        text = plan(df)
        want = hot.groupBy("train_uid").agg(F.min("stp_indicator").alias("stp_indicator"))
        assert rows == hot.join(want, ["train_uid", "stp_indicator"]).count()
        assert "skew=true" in text
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_several_dates_match_single_dates(spark):
    base = schedules(spark, 600)
    calls = F.expr("""inline(array(
        named_struct('loc_order', 0, 'xmidnight', false, 'location', 'S0',
                     'scheduled_arrival', int(null), 'scheduled_departure', 84000),
        named_struct('loc_order', 1, 'xmidnight', true, 'location', 'S1',
                     'scheduled_arrival', 600, 'scheduled_departure', int(null))))""")
    stops = base.select("train_uid", "date_runs_from", "stp_indicator").distinct().select("*", calls)
    days = [DAY + dt.timedelta(days=i) for i in range(3)]
    key = lambda df: sorted(map(tuple, df.collect()), key=str)
    together = key(full_timetable(base, stops, days))
    apart = [row for d in days for row in key(full_timetable(base, stops, [d]))]
    assert together == sorted(apart, key=str)


def test_blank_indicator_and_cancellation(spark):
    rows = [("A", " "), ("A", "C"), ("B", "C"), ("B", "N"), ("C", "O"), ("C", "P")]
    df = spark.createDataFrame([(u, DAY, DAY, [True] * 7, s) for u, s in rows],
                               "train_uid string, date_runs_from date, date_runs_to date, "
                               "days_run array<boolean>, stp_indicator string")
    assert {(r.train_uid, r.stp_indicator) for r in schedules_on(df, [DAY]).collect()} == {
        ("A", " "), ("B", "C"), ("C", "O")}
    assert schedules_on(df, [DAY + dt.timedelta(days=1)]).count() == 0


def test_published_grid_example(spark):
    p = spark.range(1).select(grid_to_latlon(F.lit(651409.903), F.lit(313177.270)).alias("p")).first().p
    assert abs(p.lat - 52.65757) < 1e-6 and abs(p.lon - 1.717922) < 1e-6


def test_find_station(spark):
    stations = spark.createDataFrame(
        [("LONDON EUSTON", 3, "EUSTON"), ("LONDON ROAD", 9, "LNDNRD"), ("LONDON ROAD", 1, "BRGHLRD"),
         ("YORK", 2, "YORK")], "station_name string, cate_type int, tiploc_code string")
    aliases = spark.createDataFrame([("YORK", "EBORACUM")], "station_name string, alias_name string")
    asked = {"a": "euston", "b": "london", "c": "london road", "d": "yor", "e": "EBOR", "f": "%", "g": "zzz",
             "h": "  ", "i": "l_ndon r", "j": "yorkshire", "k": "YORK   AND MORE", "l": None, "m": "york ",
             "n": "%on%ro", "o": "_"}
    queries = spark.createDataFrame(list(asked.items()), "query_id string, name string")
    df = find_station(queries, stations, aliases)
    got = {r.query_id: r.tiploc_code for r in df.collect()}
    assert got == {"a": "EUSTON", "b": "EUSTON", "c": "BRGHLRD", "d": "YORK", "e": "YORK", "f": "EUSTON", "g": None,
                   "h": None, "i": "BRGHLRD", "j": None, "k": "YORK", "l": None, "m": "YORK", "n": "BRGHLRD",
                   "o": "EUSTON"}
    assert "NestedLoop" not in plan(df) and "Cartesian" not in plan(df)
