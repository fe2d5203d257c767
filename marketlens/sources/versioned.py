"""Versioned table sets: readers switch to a new version only when it is complete.

A version is a list of folders per table: one folder of its own after a full load,
those of earlier versions and a new one after an increment.  It becomes current when
one row naming it is appended to the ``_committed`` table; Spark's own file commit
makes that atomic.  A failed load leaves the previous version in place.  Loads into
one root run one after another.
"""

from __future__ import annotations

import json
import time
import uuid

from pyspark.sql import DataFrame, Row, SparkSession, functions as F, types as T

from marketlens.session import list_path, path_exists

# The log keeps every table's schema, so opening a version reads no file footers.
# ``parts`` holds the folders of each table, relative to the root; it is NULL in logs that knew full loads only.
_LOG_SCHEMA = ("version string, number bigint, committed_at bigint, tables map<string,string>, "
               "parts map<string,array<string>>")


def new_version_path(root: str) -> tuple[str, str]:
    version = f"{time.time_ns()}-{uuid.uuid4().hex[:8]}"
    return version, f"{root}/versions/{version}"


def commit_version(
    spark: SparkSession, root: str, version: str, tables: dict[str, DataFrame], parts: dict[str, list[str]] | None = None
) -> None:
    """Make ``version`` current.  ``parts`` names the folders of each table; by default its own folder in the version's."""
    schemas = {name: df.schema.json() for name, df in tables.items()}
    folders = {name: (parts or {}).get(name, [f"versions/{version}/{name}"]) for name in tables}
    last = _last_commit(spark, root)
    number = 1 + (last.number or 0) if last else 1
    entry = spark.createDataFrame([(version, number, time.time_ns(), schemas, folders)], _LOG_SCHEMA)
    entry.coalesce(1).write.mode("append").parquet(f"{root}/_committed")


def _parts_of(commit: Row) -> dict[str, list[str]]:
    return commit.parts or {name: [f"versions/{commit.version}/{name}"] for name in commit.tables}


def _commits(spark: SparkSession, root: str) -> DataFrame:
    """The log, latest first: by number, so a driver with a slow clock commits in order; the clock only breaks ties."""
    log = spark.read.schema(_LOG_SCHEMA).parquet(f"{root}/_committed")
    return log.orderBy(F.col("number").desc_nulls_last(), F.col("committed_at").desc())


def _last_commit(spark: SparkSession, root: str) -> Row | None:
    return _commits(spark, root).first() if path_exists(spark, f"{root}/_committed") else None


def current_version(spark: SparkSession, root: str) -> tuple[str, dict[str, T.StructType]] | None:
    last = _last_commit(spark, root)
    if last is None:
        return None
    return last.version, {t: T.StructType.fromJson(json.loads(s)) for t, s in last.tables.items()}


def current_parts(spark: SparkSession, root: str) -> dict[str, list[str]]:
    """The folders of each table of the current version, relative to ``root``."""
    last = _last_commit(spark, root)
    return {} if last is None else _parts_of(last)


def table_paths(spark: SparkSession, root: str) -> dict[str, list[str]]:
    """The full paths of the folders of each table of the current version."""
    return {t: [f"{root}/{p}" for p in parts] for t, parts in current_parts(spark, root).items()}


def expire_versions(spark: SparkSession, root: str, keep: int = 3) -> list[str]:
    """Delete the folders that none of the latest ``keep`` committed versions reads, and those of loads that were never committed.

    Run it when no load is under way: an unfinished load looks like an abandoned one.
    """
    if not path_exists(spark, f"{root}/_committed"):
        return []
    kept = {part.split("/")[1] for r in _commits(spark, root).limit(keep).collect() for parts in _parts_of(r).values() for part in parts}
    gone = [path for path, _, _ in list_path(spark, f"{root}/versions") if path.rsplit("/", 1)[-1] not in kept]
    for path in gone:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
    return [path.rsplit("/", 1)[-1] for path in gone]


def read_parts(spark: SparkSession, root: str, parts: list[str], schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(*[f"{root}/{part}" for part in parts])


def open_current(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    last = _last_commit(spark, root)
    if last is None:
        raise FileNotFoundError(f"no committed version under {root}")
    parts = _parts_of(last)
    return {t: read_parts(spark, root, parts[t], T.StructType.fromJson(json.loads(s))) for t, s in last.tables.items()}
