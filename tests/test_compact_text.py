"""Intermediate texts and lines are padded to full width, so they are kept compressed."""

import re
from pathlib import Path

from railgrain.plans import textfiles
from railgrain.plans.fixtures import Tables
from railgrain.sources.timetable import read_timetable


def test_written_text_is_compressed(spark):
    path = textfiles.timetable_text(Tables(spark, "/root/testdata/sf0.001"))
    scan = read_timetable(spark, path)
    folder = Path(re.sub(r"^file:/*", "/", path.removesuffix("/*")))
    size = sum(f.stat().st_size for f in folder.rglob("part-*"))
    assert size * 4 < sum(len(r.block) for r in scan.blocks().collect())


def test_staged_lines_are_compressed(spark):
    scan = read_timetable(spark, textfiles.timetable_text(Tables(spark, "/root/testdata/sf0.001")))
    files = scan.staged()._stage.inputFiles()
    assert files and all(f.endswith(".zstd.parquet") or ".zstd" in f for f in files)
