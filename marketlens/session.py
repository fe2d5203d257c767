"""Session settings and the shared scratch folder.

Nothing here is required to run the operators: they work on any session.  The
defaults only spell out the adaptive features the plans rely on at scale.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from threading import Lock

from pyspark.sql import DataFrame, SparkSession

CLUSTER_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A skewed join followed by a group-by on the same key is still split.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    # Call sites are recorded for every column expression otherwise; wide plans build slowly.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app_name: str = "marketlens", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**CLUSTER_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


#: How tables of the warehouse and of its increments are written: a quarter smaller than by Spark's default.
STORED = {"compression": "zstd"}

_LOCAL_FALLBACK: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    """The folder all executors share, as named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder: there the driver
    and the executors are one process.
    """
    context = spark.sparkContext
    configured = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not (context.master == "local" or context.master.startswith("local[")):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    if context.applicationId not in _LOCAL_FALLBACK:
        _LOCAL_FALLBACK[context.applicationId] = tempfile.mkdtemp(prefix="marketlens-")
    return _LOCAL_FALLBACK[context.applicationId]


def list_path(spark: SparkSession, path: str) -> tuple[tuple[str, int, int], ...]:
    """Name, size and time of the entries of a folder (or of one file), sorted by name."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = target.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(target)
    return tuple(sorted((f.getPath().toString(), f.getLen(), f.getModificationTime()) for f in found))


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder with all that is in it, if it is there."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and continue from the files.

    Later passes read only the columns they need, and a lost executor costs a
    re-read instead of a re-computation.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def stored_once(df: DataFrame, label: str) -> Iterator[DataFrame]:
    """``materialize`` for a copy that only this block reads: its files are deleted at the end, also after a failure."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    try:
        df.write.options(**STORED).parquet(path)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        delete_path(spark, path)


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_cleaning: dict[str, list] = {}
_cleaning_lock = Lock()


@contextmanager
def shuffles_deleted(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of a query that runs in this block go when it ends, not when the driver next collects garbage.

    For loads of many large writes, of which none is executed twice.  Blocks of one session may overlap; the setting
    that the session had before comes back with the last of them.
    """
    session = spark._jsparkSession.sessionUUID()
    with _cleaning_lock:
        held = _cleaning.setdefault(session, [0, spark.conf.get(SHUFFLE_CLEANUP, None)])
        held[0] += 1
        spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        with _cleaning_lock:
            held[0] -= 1
            if not held[0]:
                del _cleaning[session]
                spark.conf.unset(SHUFFLE_CLEANUP) if held[1] is None else spark.conf.set(SHUFFLE_CLEANUP, held[1])
