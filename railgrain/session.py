"""Where intermediate tables live, and how they are written and read back.

Intermediate results that are used more than once, or that end a long lineage, are written as parquet
to the folder the cluster names in ``spark.checkpoint.dir``.  A written table survives the loss of any
executor, and its exact size lets Catalyst decide by itself which join side is small enough to broadcast.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL: dict[str, str] = {}
#: Folders that were found to be shared, by application.
_SHARED: set[tuple[str, str]] = set()


def _one_machine(master: str) -> bool:
    """Whether driver and executors are one process, so that any folder is shared."""
    return master == "local" or master.startswith("local[")


def _base(spark: SparkSession) -> str:
    """The checkpoint folder; on a cluster without one, a folder in the warehouse, which its machines share too.

    A folder without a scheme is one of the default file system, as it is for Spark's own checkpoints.
    """
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if _one_machine(context.master):
        if base:
            return base
        return _LOCAL.setdefault(context.applicationId, tempfile.mkdtemp(prefix="railgrain-"))
    base = base or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_railgrain"
    scheme = base if "://" in base or base.startswith("file:") else context._jsc.hadoopConfiguration().get("fs.defaultFS", "file:///")
    if scheme.startswith("file:") and (context.applicationId, base) not in _SHARED:
        _check_shared(spark, base)
        _SHARED.add((context.applicationId, base))
    return base


def _check_shared(spark: SparkSession, base: str) -> None:
    """What executors write to a folder of each one's own is lost without an error, so a few rows are written and read back."""
    path, n = f"{base.rstrip('/')}/shared-{uuid.uuid4().hex}", 4 * spark.sparkContext.defaultParallelism
    rows = spark.range(0, n, 1, n)
    rows.write.parquet(path)
    if spark.read.schema(rows.schema).parquet(path).count() != n:
        raise RuntimeError(f"{base} is not one folder for all machines; set spark.checkpoint.dir to one they share")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the session's checkpoint folder."""
    return f"{_base(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def spread(df: DataFrame) -> DataFrame:
    """Deal the rows of ``df`` evenly to as many parts as a shuffle has.

    For small tables that are multiplied by what they are joined to: adaptive execution would write them as
    one file, and one task would then do all the multiplying.  Rows are dealt in turn, not by a key, because an
    exchange on the keys of the aggregate below would be dropped as redundant.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def is_there(spark: SparkSession, path: str) -> bool:
    """Whether a written folder still exists: the checkpoint folder may be cleared while a session goes on."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def write_to(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` to a folder and return a scan of the written table."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and return a scan of the written table."""
    return write_to(df, scratch_path(df.sparkSession, label))
