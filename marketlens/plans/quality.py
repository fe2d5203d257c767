"""The quality report: three audits, and the rows of each that need attention."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame

from marketlens.operators.audits import audit_counts, broken_rules_of, duplicates_of, missing_of, quality_gate
from marketlens.session import materialize
from marketlens.sources.reports import write_report


@dataclass
class QualityReport:
    missing: DataFrame
    duplicates: DataFrame
    rules: DataFrame

    @property
    def missing_issues(self) -> DataFrame:
        return self.missing.filter("missing_count > 0")

    @property
    def duplicate_issues(self) -> DataFrame:
        return self.duplicates.filter("duplicate_rows > 0")

    @property
    def rule_issues(self) -> DataFrame:
        return self.rules.filter("violations_count > 0")

    def write(self, folder: str) -> None:
        write_report(self.missing, folder, "missing_values_report", ["table_name", "column_name"])
        write_report(self.duplicates, folder, "duplicate_rows_report", ["table_name"])
        write_report(self.rules, folder, "value_constraints_report", ["table_name", "rule_name"])

    @property
    def gate(self) -> DataFrame:
        return quality_gate(self.missing, self.duplicates)


def quality_report(tables: Mapping[str, DataFrame], schema: str = "staging") -> QualityReport:
    """Each table is read once for all three audits; its one row of counts is stored, so all else is free."""
    counts = materialize(audit_counts(tables), "audit-counts")
    return QualityReport(missing_of(counts, schema), duplicates_of(counts, schema), broken_rules_of(counts))
