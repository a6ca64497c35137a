"""All tables of a set of timetable archives, to be read lazily or loaded for good.

``load`` returns lazy tables.  ``load_into`` writes them to a folder of their own, checks keys and references on what was written,
and only then publishes them, by one small file that names the folder.  Readers see whole loads or nothing: a
load that ends early, or breaks a rule, leaves the published tables as they were.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.quality import station_sequence, timetable_sequence
from ..session import materialize
from .archive import MEMBER_SUFFIXES, stage_archives, wanted_suffixes
from .constraints import KEYS, violations
from .interchange import read_interchange
from .links import read_fixed_links
from .naptan import read_naptan
from .stations import read_stations
from .timetable import read_timetable


PUBLICATION = "number long, version string, table string, n_rows long"


class LoadRejected(ValueError):
    """A load that broke keys or references; ``violations`` is the table of what it broke."""

    def __init__(self, found: DataFrame):
        self.violations = found
        some = [f"{r['table']}: {r['rule']} {r['key']} ({r['n']} rows)" for r in found.orderBy("table", "rule", "key").limit(5).collect()]
        super().__init__("; ".join(some))


def load(spark: SparkSession, source: str | DataFrame, skip: frozenset[str] | set[str] = frozenset(),
         old_naming: bool = False, mode: str = "failfast") -> dict[str, DataFrame]:
    """Lazy tables named ``<suffix>.<table>``.  Skipped members are neither unpacked nor required.

    ``source`` is a path, or archives as rows of path and bytes.
    In ``failfast`` mode the order of records is checked over whole files before anything is returned; fields are
    checked when a table is read.
    """
    unknown = set(skip) - set(MEMBER_SUFFIXES)
    if unknown:
        raise ValueError(f"cannot skip {sorted(unknown)}; members are {MEMBER_SUFFIXES}")
    wanted = tuple(s for s in wanted_suffixes(old_naming) if s.lower() not in skip)
    if not wanted:
        return {}
    folders = stage_archives(spark, source, old_naming, wanted)
    return tables_of(spark, {s: p for s, p in folders.items() if s not in skip}, mode)


def tables_of(spark: SparkSession, paths: dict[str, str], mode: str = "failfast") -> dict[str, DataFrame]:
    """Tables of already unpacked text, given the path of each suffix."""

    def checked(scan, sequence):
        """The scan's tables; ``sequence`` finds records out of order, at file starts and ends too."""
        wrong = sequence(scan).first() if mode == "failfast" else None
        if wrong:
            raise ValueError(f"unexpected record sequence: {wrong.asDict()}")
        return scan.tables()

    readers = {
        "mca": lambda p: checked(read_timetable(spark, p, "standard", mode), timetable_sequence),
        "ztr": lambda p: checked(read_timetable(spark, p, "ztrain", mode), timetable_sequence),
        "msn": lambda p: checked(read_stations(spark, p, mode), station_sequence),
        "tsi": lambda p: {"tsi": read_interchange(spark, p, mode)},
        "alf": lambda p: {"alf": read_fixed_links(spark, p, mode)},
    }
    return {f"{suffix}.{name}": df for suffix, path in paths.items()
            for name, df in readers[suffix](path).items()}


def load_into(spark: SparkSession, base: str, source: str | DataFrame, skip: frozenset[str] | set[str] = frozenset(),
              old_naming: bool = False, naptan: str | DataFrame | None = None) -> dict[str, DataFrame]:
    """Load archives, and rail references if given, below ``base``; returns what is published there afterwards.

    Ends with an error, and publishes nothing, at the first bad record, a missing member, records out of order, a null or repeated
    key, or a call that belongs to no schedule (:class:`LoadRejected` tells all of the last three).
    """
    tables = load(spark, source, skip, old_naming)
    if naptan is not None:
        tables["naptan.railreferences"] = read_naptan(spark, naptan)
    return publish(spark, tables, base)


def publish(spark: SparkSession, tables: dict[str, DataFrame], base: str) -> dict[str, DataFrame]:
    """Write ``tables`` below ``base``, check them and publish them; tables published before and not given now stay.

    Loads into one ``base`` are to be run one after the other.
    """
    if not tables:
        return published(spark, base)
    version = uuid.uuid4().hex
    staged = f"{base.rstrip('/')}/version={version}"
    try:
        for name, df in tables.items():
            df.write.parquet(f"{staged}/{name}")
        written = {name: spark.read.schema(df.schema).parquet(f"{staged}/{name}") for name, df in tables.items()}
        if any(name in KEYS for name in written):
            broken = materialize(violations(written), "violations")
            if not broken.isEmpty():
                raise LoadRejected(broken)
        # Row counts come from the files' footers.
        each = (df.select(F.lit(name).alias("table")) for name, df in written.items())
        counts = {r["table"]: r["count"] for r in reduce(DataFrame.unionAll, each).groupBy("table").count().collect()}
    except BaseException:
        _drop(spark, staged)
        raise
    last = _publications(spark, base).agg(F.max("number")).first()[0]
    rows = [((last or 0) + 1, version, name, counts.get(name, 0)) for name in tables]
    spark.createDataFrame(rows, PUBLICATION).coalesce(1).write.mode("append").parquet(f"{base.rstrip('/')}/published")
    return published(spark, base)


def published(spark: SparkSession, base: str) -> dict[str, DataFrame]:
    """The tables of ``base``, each from the last load that had it."""
    newest = _publications(spark, base).groupBy("table").agg(F.max(F.struct("number", "version"))["version"].alias("version"))
    return {r["table"]: spark.read.parquet(f"{base.rstrip('/')}/version={r['version']}/{r['table']}") for r in newest.orderBy("table").collect()}


def _publications(spark: SparkSession, base: str) -> DataFrame:
    """One row for each load and table; few, since loads are."""
    try:
        return spark.read.schema(PUBLICATION).parquet(f"{base.rstrip('/')}/published")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], PUBLICATION)


def _drop(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
