"""Namespaces, table registration and catalog lookups."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from marketlens.plans.kpis import VIEWS
from marketlens.sources.versioned import table_paths

NAMESPACES = ("staging", "warehouse", "analytics")


def create_namespaces(spark: SparkSession) -> None:
    for name in NAMESPACES:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")


def register_tables(spark: SparkSession, schema: str, folders: Mapping[str, str | Sequence[str]]) -> None:
    """Point ``schema.table`` at the root folder of each table, with all its partitions; the files stay where they are.

    A table of several folders becomes a view over them, as a catalog table has one folder.
    """
    for name, found in folders.items():
        paths = [found] if isinstance(found, str) else list(found)
        _forget(spark, schema, name)
        if len(paths) > 1:
            union = " UNION ALL ".join(f"SELECT * FROM parquet.`{path}`" for path in paths)
            spark.sql(f"CREATE VIEW {schema}.`{name}` AS {union}")
            continue
        spark.catalog.createTable(f"{schema}.{name}", path=paths[0], source="parquet")
        if any(c.isPartition for c in spark.catalog.listColumns(f"{schema}.{name}")):
            spark.catalog.recoverPartitions(f"{schema}.{name}")


def _forget(spark: SparkSession, schema: str, name: str) -> None:
    if spark.catalog.tableExists(f"{schema}.{name}"):
        kind = "VIEW" if spark.catalog.getTable(f"{schema}.{name}").tableType == "VIEW" else "TABLE"
        spark.sql(f"DROP {kind} {schema}.`{name}`")


def register_version(spark: SparkSession, schema: str, root: str) -> list[str]:
    """Point the namespace at the current version of a table set; again after each publish."""
    folders = table_paths(spark, root)
    register_tables(spark, schema, folders)
    return sorted(folders)


def register_views(star: dict[str, DataFrame]) -> list[str]:
    """Make every KPI view available to SQL under its published name."""
    for name, view in VIEWS.items():
        view(star).createOrReplaceTempView(name)
    return list(VIEWS)


def table_names(spark: SparkSession, schema: str) -> list[str]:
    if not spark.catalog.databaseExists(schema):
        return []
    return sorted(t.name for t in spark.catalog.listTables(schema) if not t.isTemporary)


def column_names(spark: SparkSession, schema: str, table: str) -> list[str]:
    return spark.table(f"{schema}.{table}").columns


def table_exists(spark: SparkSession, schema: str, table: str) -> bool:
    return spark.catalog.tableExists(f"{schema}.{table}")


def schema_tables(spark: SparkSession, schema: str) -> dict[str, DataFrame]:
    """Every table of a namespace, ready for the audits."""
    return {name: spark.table(f"{schema}.{name}") for name in table_names(spark, schema)}
