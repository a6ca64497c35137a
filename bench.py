"""Times the headline queries on ``$BENCH_SF_DIR`` with ``local[$BENCH_CPUS]``; prints one JSON line.

The text files and stored tables the queries read are written first and are not part of a query's time
(reported as ``setup``).  Every query is run to the end, all rows and columns, into the noop sink.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
HEADLINE = (
    "timetable_schedules", "timetable_stops", "ztrain_stops", "associations", "station_details", "fixed_links",
    "timetable_sequence_check", "schedules_in_force", "train_timetables", "full_timetable", "day_timetable",
    "direct_connections", "link_connections", "all_connections", "earliest_departures", "find_station",
    "reachable", "isochron", "isochron_latlon", "grid_to_latlon",
)


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]").appName("railgrain-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    from railgrain.plans import textfiles
    from railgrain.plans.catalog import QUERIES, day_table
    from railgrain.plans.fixtures import VIEWS, Tables

    started = time.time()
    tables = Tables(spark, SF_DIR)
    for name in VIEWS:
        if name not in ("fx_stop_time", "fx_call"):
            tables.get(name)
    day_table(tables)
    for build in (textfiles.timetable_text, textfiles.damaged_timetable_text, textfiles.ztrain_text,
                  textfiles.station_text, textfiles.link_text):
        build(tables)
    setup = time.time() - started

    seconds = {}
    for name in HEADLINE:
        started = time.time()
        QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.time() - started, 3)
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "setup": round(setup, 3), "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
