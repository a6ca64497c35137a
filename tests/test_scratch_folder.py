"""Where intermediates go on a cluster: the session of these tests is one process, so each case starts a small one."""

import os
import subprocess
import sys
from pathlib import Path

import pyspark
import pytest
from conftest import ROOT

SCRIPT = """
import sys
from pyspark.sql import SparkSession
from railgrain.session import materialize
made = SparkSession.builder.master("local-cluster[2,1,1024]").config("spark.ui.enabled", "false").config("spark.driver.host", "127.0.0.1")
for pair in sys.argv[1:]:
    made = made.config(*pair.split("=", 1))
spark = made.getOrCreate()
held = materialize(spark.range(0, 1000, 1, 8), "held")
print("found", held.count(), held.inputFiles()[0])
spark.stop()
"""


def run(tmp_path, **conf):
    conf = {"spark.sql.warehouse.dir": f"{tmp_path}/warehouse", "spark.executor.memory": "512m"} | conf
    env = os.environ | {"PYTHONPATH": str(ROOT), "SPARK_HOME": str(Path(pyspark.__file__).parent), "SPARK_LOCAL_IP": "127.0.0.1", "SPARK_CONF_DIR": str(tmp_path),
                        "SPARK_LOCAL_DIRS": f"{tmp_path}/local", "SPARK_WORKER_DIR": f"{tmp_path}/work", "SPARK_SCALA_VERSION": "2.13", "PYSPARK_PYTHON": sys.executable}
    (tmp_path / "local").mkdir()
    return subprocess.run([sys.executable, "-c", SCRIPT, *(f"{k}={v}" for k, v in conf.items())],
                          env=env, cwd=tmp_path, capture_output=True, text=True, timeout=240)


@pytest.mark.parametrize("given", ["{}/shared", "file://{}/shared", None])
def test_cluster_folder(tmp_path, given):
    conf = {"spark.checkpoint.dir": given.format(tmp_path)} if given else {}
    done = run(tmp_path, **conf)
    assert "found 1000 " in done.stdout, done.stderr[-2000:]
    assert f"{tmp_path}/{'shared' if given else 'warehouse/_railgrain'}/held-" in done.stdout


def test_folder_that_is_not_shared(spark, tmp_path, monkeypatch):
    from railgrain import session

    class Lost:  # a writer whose files end on other machines
        def parquet(self, path):
            os.mkdir(path)

    monkeypatch.setattr("pyspark.sql.classic.dataframe.DataFrame.write", property(lambda self: Lost()))
    with pytest.raises(RuntimeError, match="not one folder"):
        session._check_shared(spark, str(tmp_path))
