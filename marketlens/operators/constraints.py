"""Constraint checks that run before a warehouse version becomes visible."""

from __future__ import annotations

from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from marketlens.schemas import SURROGATE_KEYS, WAREHOUSE_RULES, TableRules


class ConstraintViolation(ValueError):
    """Raised with the offending constraints and their row counts."""


def column_checks(df: DataFrame, rules: TableRules) -> dict[str, str]:
    """``kind|column`` and the predicate that a row violates, for every NOT NULL and length rule."""
    checks = {f"not_null|{c}": f"`{c}` IS NULL" for c in rules.not_null}
    strings = {f.name for f in df.schema.fields if f.dataType.typeName() == "string"}
    for column, limit in rules.max_length.items():
        if column in strings:
            checks[f"length<={limit}|{column}"] = f"char_length(`{column}`) > {limit}"
    return checks


def _column_checks(table: str, df: DataFrame, rules: TableRules) -> DataFrame:
    """NOT NULL and length checks of one table, in a single scan."""
    checks = column_checks(df, rules)
    counted = df.agg(*[F.expr(f"count_if({violated}) AS `{check}`") for check, violated in checks.items()])
    return counted.unpivot([], counted.columns, "_check", "violations").selectExpr(
        f"'{table}' AS table_name",
        "split_part(_check, '|', 1) AS constraint_kind",
        "split_part(_check, '|', 2) AS column_name",
        "violations",
    )


def _labelled(rows: DataFrame, table: str, kind: str, column: str) -> DataFrame:
    return rows.selectExpr(
        f"'{table}' AS table_name", f"'{kind}' AS constraint_kind", f"'{column}' AS column_name", "violations"
    )


def _unique_check(table: str, df: DataFrame, key: tuple[str, ...]) -> DataFrame:
    repeats = df.groupBy(*key).agg((F.count(F.lit(1)) - 1).alias("_extra"))
    surplus = repeats.agg(F.coalesce(F.sum("_extra"), F.lit(0)).alias("violations"))
    return _labelled(surplus, table, "unique", ", ".join(key))


def foreign_key_orphans(child: DataFrame, column: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """One row: how many child rows point at no parent.

    Both sides shrink to one row per value first, so a value shared by a third of
    the rows is one row in the join.
    """
    keys = child.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("_ref")).agg(F.count(F.lit(1)).alias("_rows"))
    known = parent.select(F.col(parent_key).alias("_ref")).distinct()
    missing = keys.join(known, "_ref", "left_anti")
    return missing.agg(F.coalesce(F.sum("_rows"), F.lit(0)).alias("violations"))


def constraint_report(star: dict[str, DataFrame], rules: dict[str, TableRules] = WAREHOUSE_RULES) -> DataFrame:
    """One row per constraint with its number of violating rows."""
    parts: list[DataFrame] = []
    for table, rule in rules.items():
        df = star[table]
        if rule.not_null or rule.max_length:
            parts.append(_column_checks(table, df, rule))
        parts += [_unique_check(table, df, key) for key in rule.unique]
        for column, (parent, parent_key) in rule.foreign_keys.items():
            orphans = foreign_key_orphans(df, column, star[parent], parent_key)
            parts.append(_labelled(orphans, table, f"references {parent}", column))
    return reduce(DataFrame.unionByName, parts)


def without_generated_keys() -> dict[str, TableRules]:
    """The rules minus uniqueness of surrogate keys, which their generator guarantees.

    Checking those would shuffle every fact row once more for nothing.
    """
    return {
        table: replace(rule, unique=tuple(k for k in rule.unique if k != (SURROGATE_KEYS.get(table),)))
        for table, rule in WAREHOUSE_RULES.items()
    }


def without_counted_columns(counted: set[str], joined: dict[str, tuple[str, ...]]) -> dict[str, TableRules]:
    """What is left to check once the column rules of the ``counted`` tables are known.

    ``joined`` names the references of each table that came out of a join with the
    parent's stored table and so cannot dangle.
    """
    return {
        table: replace(
            rule,
            not_null=() if table in counted else rule.not_null,
            max_length={} if table in counted else rule.max_length,
            foreign_keys={c: parent for c, parent in rule.foreign_keys.items() if c not in joined.get(table, ())},
        )
        for table, rule in without_generated_keys().items()
    }


def enforce(
    star: dict[str, DataFrame],
    rules: dict[str, TableRules] = WAREHOUSE_RULES,
    counted: dict[tuple[str, str], int] | None = None,
) -> None:
    """Raise if a rule is broken.  ``counted`` holds violations known already, by table and ``kind|column``."""
    found = [(table, *check.split("|"), rows) for (table, check), rows in (counted or {}).items() if rows]
    checked = constraint_report(star, rules).filter("violations > 0")
    found += [tuple(row) for row in checked.collect()]  # at most one row per constraint
    if found:
        raise ConstraintViolation(
            "; ".join(f"{table}.{column} {kind}: {rows} rows" for table, kind, column, rows in found)
        )
