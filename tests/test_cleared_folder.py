"""The checkpoint folder may be cleared while a session goes on; what queries share is then written again."""

import shutil
from pathlib import Path

from railgrain.plans import fixtures, textfiles

SF_DIR = "/root/testdata/sf0.001"


def test_derived_table_is_written_again(spark):
    tables = fixtures.Tables(spark, SF_DIR)
    held = tables.get("fx_station")
    n, file = held.count(), held.inputFiles()[0]
    assert tables.get("fx_station") is held
    shutil.rmtree(Path(file.removeprefix("file:")).parent)
    assert tables.get("fx_station").count() == n


def test_text_is_written_again(spark):
    tables = fixtures.Tables(spark, SF_DIR)
    path = textfiles.interchange_text(tables)
    lines = sorted(r.value for r in spark.read.text(path).collect())
    assert textfiles.interchange_text(tables) == path
    shutil.rmtree(path.removeprefix("file:"))
    assert sorted(r.value for r in spark.read.text(textfiles.interchange_text(tables)).collect()) == lines


def test_text_in_folders_by_file_is_written_again(spark):
    tables = fixtures.Tables(spark, SF_DIR)
    path = textfiles.station_text(tables)
    n = spark.read.text(path).count()
    assert textfiles.station_text(tables) == path
    shutil.rmtree(path.removesuffix("/*").removeprefix("file:"))
    assert spark.read.text(textfiles.station_text(tables)).count() == n
