"""Loads look at their text as few times as they can, and archives are unpacked in pieces, not line by line."""

import io
import zipfile

import pytest
from lines import HD, ZZ, bs, lo, lt, write

from railgrain.operators.quality import timetable_sequence
from railgrain.plans import textfiles
from railgrain.sources import archive
from railgrain.sources.timetable import read_timetable

TRAIN = [bs("A00001"), lo("S", "0800"), lt("F", "0900")]
ODD = b"one\r\n\r\ntwo\r\r\n\n three \r\nfour\rfive\r\n\r"


def test_sequence_reads_the_text_once(spark, tmp_path):
    scan = read_timetable(spark, write(tmp_path / "t.mca", [HD, *TRAIN, ZZ]), mode="permissive")
    plan = spark._jvm.PythonSQLUtils.explainString(timetable_sequence(scan)._jdf.queryExecution(), "simple")
    assert plan.count("FileScan text") == 1


def test_sequence_tells_all_that_is_wrong(spark, tmp_path):
    write(tmp_path / "a.mca", [*TRAIN, bs("A00002"), lt("F", "0900"), ZZ, *TRAIN])
    write(tmp_path / "b.mca", [HD, *TRAIN, ZZ])
    found = timetable_sequence(read_timetable(spark, str(tmp_path / "*.mca"), mode="permissive")).collect()
    assert sorted((r.file[-5:], r.codes, r.reason) for r in found) == [
        ("a.mca", "", "record after end"), ("a.mca", "", "start of file"), ("a.mca", "BSLTZZ", "order of records")]


@pytest.mark.parametrize("data", [ODD, ODD + b"\nend", b"", b"\n", b"x\xe9y", b"\r\n" * 9])
@pytest.mark.parametrize("piece", [1, 3, 1000])
def test_texts_have_the_lines(monkeypatch, data, piece):
    monkeypatch.setattr(archive, "_PIECE_BYTES", piece)
    want = [line.rstrip("\r\n") for line in io.TextIOWrapper(io.BytesIO(data), encoding="latin-1", newline="\n")]
    assert [line for text in archive._texts(io.BytesIO(data)) for line in text.split("\n")] == want


def test_staged_files_have_the_lines(spark):
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as z:
        z.writestr("t.msn", ODD)
    archives = spark.createDataFrame([("a.zip", bytearray(buffer.getvalue()))], "path string, content binary")
    lines = [r.value for r in archive.member_lines(archives, ("msn",)).orderBy("line_no").collect()]
    assert lines == ["one", "", "two", "", " three ", "four\rfive", ""]
    texts = archive.member_texts(archives, ("msn",))
    assert texts.count() < len(lines)
    read = spark.read.option("lineSep", "\n").text(archive.stage_lines(texts)["msn"]).collect()
    assert [r.value for r in read] == lines


def test_a_stop_line_is_made_once(spark):
    """Not once for the file and again to see whether there is one."""
    stops = spark.createDataFrame(
        [("A", 1, 0, 1, "S", None, 60, None, "1")], "train_uid string, k long, loc_order int, last_order int, location string, "
        "scheduled_arrival int, scheduled_departure int, scheduled_pass int, platform string")
    schedules = spark.sql(
        "select 'A' train_uid, 1L k, date'1998-01-01' date_runs_from, date'1998-12-31' date_runs_to, '1111111' days_run, ' ' train_status, 1 speed, 'P' stp_indicator")
    rows = textfiles._trains(schedules, stops, textfiles._yymmdd, False, False)
    plan = spark._jvm.PythonSQLUtils.explainString(rows._jdf.queryExecution(), "formatted")
    assert not [x for x in plan.splitlines() if x.startswith("Condition") and "concat_ws" in x]
