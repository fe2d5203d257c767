"""Counts taken while tables are written: rows, merged copies and column constraints, without another scan.

Each count is observed between the last shuffle and the write.  A task of that stage
counts once however often it is tried, so lost executors do not change the figures;
that is why nothing is observed on the way into a shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from marketlens.operators.constraints import column_checks
from marketlens.schemas import WAREHOUSE_RULES, TableRules

COPIES = "_copies"
_SCHEMA = "step string, rows_loaded bigint, duplicate_key bigint"


class WriteCounts:
    """Collects the counts of one load; read them when all its writes are done."""

    def __init__(self, rules: dict[str, TableRules] = WAREHOUSE_RULES) -> None:
        self._rules = rules
        self._copies: dict[str, Observation] = {}
        self._rows: dict[str, Observation] = {}
        self._checks: dict[str, list[str]] = {}

    def copies(self, table: str, df: DataFrame) -> DataFrame:
        """``df`` without its column of copies, whose surplus is counted by the next write."""
        self._copies[table] = Observation()
        surplus = F.coalesce(F.sum(F.col(COPIES) - 1), F.lit(0)).alias("surplus")
        return df.observe(self._copies[table], surplus).drop(COPIES)

    def rows(self, table: str, df: DataFrame) -> DataFrame:
        """``df``, whose rows and broken column rules are counted by the next write."""
        checks = column_checks(df, self._rules[table])
        self._rows[table], self._checks[table] = Observation(), list(checks)
        broken = [F.expr(f"count_if({violated})").alias(f"check_{n}") for n, violated in enumerate(checks.values())]
        return df.observe(self._rows[table], F.count(F.lit(1)).alias("rows"), *broken)

    def tables(self) -> set[str]:
        return set(self._rows)

    def violations(self) -> dict[tuple[str, str], int]:
        """Rows that break each NOT NULL and length rule, by table and ``kind|column``."""
        return {
            (table, check): self._rows[table].get[f"check_{n}"]
            for table, checks in self._checks.items()
            for n, check in enumerate(checks)
        }

    def frame(self, spark: SparkSession) -> DataFrame:
        """One row per written table with its rows and the rows that were merged into others."""
        found = [
            (table, seen.get["rows"], self._copies[table].get["surplus"] if table in self._copies else 0)
            for table, seen in self._rows.items()
        ]
        return spark.createDataFrame(found, _SCHEMA).coalesce(1)
