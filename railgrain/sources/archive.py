"""Zip archives of timetable data.

A zip file cannot be split, so an archive is the unit of parallel work: each is opened by one task, which
streams its members out in pieces and never holds more than one uncompressed piece.
"""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator
from typing import IO

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

# The members of a timetable archive, known by the last three characters of their names.
MEMBER_SUFFIXES = ("mca", "ztr", "msn", "tsi", "alf")

LINES = "archive string, member string, line_no long, value string"
#: What is unpacked of a member at once.
_PIECE_BYTES = 1 << 20


def wanted_suffixes(old_naming: bool = False) -> tuple[str, ...]:
    return tuple(s.upper() for s in MEMBER_SUFFIXES) if old_naming else MEMBER_SUFFIXES


def read_archives(spark: SparkSession, source: str | DataFrame) -> DataFrame:
    """The archives as rows of path and bytes, one file per row; ``source`` is a path or already such a table."""
    files = spark.read.format("binaryFile").load(source) if isinstance(source, str) else source
    return files.select("path", "content")


def _texts(stream: IO[bytes]) -> Iterator[str]:
    """A member's text in pieces of whole lines; lines are separated by newlines and lose the carriage returns at their ends."""

    def shown(data: bytes) -> str:
        text = data.decode("latin-1")
        while "\r\n" in text:
            text = text.replace("\r\n", "\n")
        return text.rstrip("\r")

    held: list[bytes] = []
    while data := stream.read(_PIECE_BYTES):
        cut = data.rfind(b"\n")
        if cut < 0:
            held.append(data)
            continue
        yield shown(b"".join([*held, data[:cut]]))
        held = [data[cut + 1:]]
    if rest := b"".join(held):
        yield shown(rest)


def _read(archives: DataFrame, members: tuple[str, ...], by_suffix: bool, by_line: bool) -> DataFrame:
    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column("path"), batch.column("content")):
                with zipfile.ZipFile(io.BytesIO(content.as_py())) as archive:
                    found = {n[-3:] if by_suffix else n: n for n in archive.namelist()}
                    for member in members:
                        if member not in found:
                            raise ValueError(f"{name} has no member {member}")
                        done = 0
                        with archive.open(found[member]) as stream:
                            for text in _texts(stream):
                                lines = text.split("\n")
                                rows = lines if by_line else [text]
                                yield pa.RecordBatch.from_arrays([
                                    pa.array([name.as_py()] * len(rows), pa.string()), pa.array([member] * len(rows), pa.string()),
                                    pa.array(range(done, done + len(rows)), pa.int64()), pa.array(rows, pa.string()),
                                ], names=["archive", "member", "line_no", "value"])
                                done += len(lines)

    return archives.mapInArrow(unpack, LINES)


def member_lines(archives: DataFrame, members: tuple[str, ...], by_suffix: bool = True) -> DataFrame:
    """Every line of the wanted members.

    With ``by_suffix`` a member is known by the last three characters of its name and the last one with
    that ending wins; otherwise names must match exactly.  An archive without a wanted member is an error.
    """
    return _read(archives, members, by_suffix, True)


def member_texts(archives: DataFrame, members: tuple[str, ...], by_suffix: bool = True) -> DataFrame:
    """The same lines, many to a row, for what writes them as they are; ``line_no`` is that of a row's first line."""
    return _read(archives, members, by_suffix, False)


def stage_archives(spark: SparkSession, source: str | DataFrame, old_naming: bool = False,
                   suffixes: tuple[str, ...] | None = None) -> dict[str, str]:
    """Unpack archives to text files, one per archive and member; returns the folder of each suffix.

    The staged files keep their line order, so the scans can split them freely.
    """
    wanted = suffixes or wanted_suffixes(old_naming)
    return stage_lines(member_texts(read_archives(spark, source), wanted))


def stage_lines(lines: DataFrame) -> dict[str, str]:
    """Write unpacked lines, one or many to a row, to one folder per suffix.

    All lines of an archive come from one task, in order.  Sorting inside the partitions by what the
    writer partitions by, then by line, keeps that order in the files without a shuffle.
    """
    out = scratch_path(lines.sparkSession, "archive")
    (lines.select(F.lower("member").alias("suffix"), F.sha2("archive", 256).alias("source"),
                  "line_no", "value")
     .sortWithinPartitions("suffix", "source", "line_no").drop("line_no")
     .write.partitionBy("suffix", "source").text(out))
    return {s: f"{out}/suffix={s}/*" for s in MEMBER_SUFFIXES}
