"""Registered queries on a cluster whose checkpoint folder has no scheme and is cleared after each of them."""

import json
import os
import subprocess
import sys
from pathlib import Path

import pyspark
import pytest
from checking import connect
from conftest import ROOT

import __spark_entry__ as registered

SF_DIR = "/root/testdata/sf0.001"

SCRIPT = """
import json, shutil, sys
from pyspark.sql import SparkSession
import __spark_entry__ as registered
here, sf_dir, names = sys.argv[1], sys.argv[2], sys.argv[3:]
conf = {"spark.ui.enabled": "false", "spark.driver.host": "127.0.0.1", "spark.executor.memory": "1g", "spark.sql.shuffle.partitions": "4",
        "spark.sql.session.timeZone": "UTC", "spark.sql.warehouse.dir": here + "/warehouse", "spark.checkpoint.dir": here + "/shared"}
spark = SparkSession.builder.master("local-cluster[2,2,2048]").config(map=conf).getOrCreate()
for name in names:
    try:
        found = registered.queries()[name](spark, sf_dir).count()
    except Exception as e:
        found = str(e)[-300:]
    print("ended", json.dumps([name, found]), flush=True)
    shutil.rmtree(here + "/shared", ignore_errors=True)
spark.stop()
"""

NAMES: list[str] = [
    "archive_members",
    "archived_stations",
    "associations",
    "changes_en_route",
    "day_timetable",
    "decode_chunks",
    "decode_days",
    "direct_connections",
    "direct_connections_by_time",
    "duplicate_key_check",
    "earliest_departures",
    "field_check",
    "field_checks",
    "find_station",
    "find_station_indexed",
    "fixed_links",
    "fixed_width_slices",
    "full_timetable",
    "grid_to_latlon",
    "interchange_times",
    "intermediate_locations",
    "isochron",
]


@pytest.fixture(scope="module")
def ended(tmp_path_factory):
    here = tmp_path_factory.mktemp("cluster")
    env = os.environ | {"PYTHONPATH": str(ROOT), "SPARK_HOME": str(Path(pyspark.__file__).parent), "SPARK_LOCAL_IP": "127.0.0.1", "SPARK_CONF_DIR": str(here),
                        "SPARK_LOCAL_DIRS": f"{here}/local", "SPARK_WORKER_DIR": f"{here}/work", "SPARK_SCALA_VERSION": "2.13", "PYSPARK_PYTHON": sys.executable}
    (here / "local").mkdir()
    done = subprocess.run([sys.executable, "-c", SCRIPT, str(here), SF_DIR, *NAMES], env=env, cwd=here, capture_output=True, text=True, timeout=900)
    return dict(json.loads(line.removeprefix("ended ")) for line in done.stdout.splitlines() if line.startswith("ended ")), done.stderr[-2000:]


@pytest.mark.parametrize("name", NAMES)
def test_query_ends_with_all_rows(ended, name):
    found, said = ended
    assert name in found, said
    assert found[name] == connect(SF_DIR).execute(f"select count(*) from ({registered.oracle_sql()[name]}) x").fetchall()[0][0]
