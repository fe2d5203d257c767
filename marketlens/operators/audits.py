"""Data-quality audits over a set of tables.

All audits come from :func:`audit_counts`, one aggregate per table.  An audit asked for by
itself leaves the columns that it does not need to the optimizer, which drops them; to run
several, store the few rows of counts once and derive each from them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from marketlens.functions.numeric import audit_percent
from marketlens.operators.dedupe import surplus_rows
from marketlens.schemas import BUSINESS_KEYS


@dataclass(frozen=True)
class Rule:
    """A predicate that a row violates when it is true; NULL is no violation."""

    name: str
    table: str
    column: str
    violation: str


# Names and predicates of the value rules.
VALUE_RULES = (
    Rule("Review score between 1 and 5", "order_reviews", "review_score", "review_score < 1 OR review_score > 5"),
    Rule("Non-negative item price", "order_items", "price", "price < 0"),
    Rule("Non-negative freight value", "order_items", "freight_value", "freight_value < 0"),
    Rule("Non-negative payment value", "order_payments", "payment_value", "payment_value < 0"),
    Rule("Non-negative payment installments", "order_payments", "payment_installments", "payment_installments < 0"),
    Rule("Approval timestamp >= purchase timestamp", "orders", "order_approved_at",
         "order_approved_at < order_purchase_timestamp"),
    Rule("Delivery timestamp >= purchase timestamp", "orders", "order_delivered_customer_date",
         "order_delivered_customer_date < order_purchase_timestamp"),
)

# The limits of the quality gate.
MAX_MISSING_PERCENT = 10
MAX_DUPLICATE_PERCENT = 5
MIN_ROWS = 100

#: Texts of more bytes are compared by digest.
LONGEST_KEPT = 32


def _stack(parts: Sequence[DataFrame]) -> DataFrame:
    if not parts:
        raise ValueError("none of the audited tables is present")
    return reduce(DataFrame.unionByName, parts)


def audit_counts(
    tables: Mapping[str, DataFrame],
    keys: Mapping[str, Sequence[str]] = BUSINESS_KEYS,
    rules: Sequence[Rule] = VALUE_RULES,
) -> DataFrame:
    """One row per table: its rows, present cells per column, rows beyond the first of each key, violations per rule.

    Each table is read once.  Tables without a key have NULL ``surplus``, those without
    rules an empty map.
    """
    def one(table: str, df: DataFrame) -> DataFrame:
        present = [part for c in df.columns for part in (F.lit(c), F.expr(f"count(`{c}`)"))]
        broken = [part for r in rules if r.table == table for part in (F.lit(r.name), F.expr(f"count_if({r.violation})"))]
        return df.agg(
            F.count(F.lit(1)).alias("total_rows"),
            F.create_map(*present).alias("present"),
            (surplus_rows(keys[table]) if table in keys else F.lit(None)).cast("bigint").alias("surplus"),
            F.create_map(*broken).cast("map<string,bigint>").alias("broken"),
        ).select(F.lit(table).alias("table_name"), "*")

    return _stack([one(table, df) for table, df in tables.items() if df.columns])


def missing_of(counts: DataFrame, schema: str = "staging") -> DataFrame:
    """One row per column with its NULL count and share."""
    columns = counts.select("table_name", "total_rows", F.explode("present").alias("column_name", "_present"))
    missing = F.col("total_rows") - F.col("_present")
    return columns.select(
        F.lit(schema).alias("schema_name"),
        "table_name",
        "column_name",
        missing.alias("missing_count"),
        F.col("total_rows").alias("total_count"),
        audit_percent(missing, F.col("total_rows")).alias("missing_pct"),
    )


def duplicates_of(
    counts: DataFrame, schema: str = "staging", keys: Mapping[str, Sequence[str]] = BUSINESS_KEYS
) -> DataFrame:
    """Rows beyond the first of each business key, for every table that has one."""
    names = F.create_map(*[F.lit(part) for table, key in keys.items() for part in (table, ", ".join(key))])
    return counts.filter(F.col("surplus").isNotNull()).select(
        F.lit(schema).alias("schema_name"),
        "table_name",
        names[F.col("table_name")].alias("unique_keys"),
        "total_rows",
        F.col("surplus").alias("duplicate_rows"),
        audit_percent(F.col("surplus"), F.col("total_rows")).alias("duplicate_pct"),
    )


def broken_rules_of(counts: DataFrame, rules: Sequence[Rule] = VALUE_RULES) -> DataFrame:
    """One row per rule of the counted tables."""
    told = F.create_map(*[
        part for r in rules
        for part in (F.lit(r.name), F.struct(F.lit(r.column).alias("column"), F.lit(r.violation).alias("violation")))
    ])
    listed = counts.select("table_name", "total_rows", F.explode("broken").alias("rule_name", "violations_count"))
    return listed.withColumn("_rule", told[F.col("rule_name")]).select(
        "rule_name",
        "table_name",
        F.col("_rule.column").alias("column_name"),
        "total_rows",
        "violations_count",
        audit_percent(F.col("violations_count"), F.col("total_rows")).alias("violation_pct"),
        F.col("_rule.violation").alias("sql_constraint"),
    )


def missing_values(tables: Mapping[str, DataFrame], schema: str = "staging") -> DataFrame:
    return missing_of(audit_counts(tables), schema)


def duplicate_keys(
    tables: Mapping[str, DataFrame],
    schema: str = "staging",
    keys: Mapping[str, Sequence[str]] = BUSINESS_KEYS,
) -> DataFrame:
    """Tables that have no key, or are absent, are skipped."""
    keyed = {table: df for table, df in tables.items() if table in keys}
    return duplicates_of(audit_counts(keyed, keys), schema, keys)


def value_rules(tables: Mapping[str, DataFrame], rules: Sequence[Rule] = VALUE_RULES) -> DataFrame:
    ruled = {table: df for table, df in tables.items() if any(r.table == table for r in rules)}
    return broken_rules_of(audit_counts(ruled, rules=rules), rules)


def _narrow(field: T.StructField) -> str:
    """The column, or a digest where it is long, equal for equal values only.

    A digest has 64 characters, so no text that is kept as it is equals one.
    """
    cell = f"`{field.name}`"
    if isinstance(field.dataType, T.StringType):
        return f"CASE WHEN octet_length({cell}) > {LONGEST_KEPT} THEN sha2({cell}, 256) ELSE {cell} END"
    if isinstance(field.dataType, (T.ArrayType, T.StructType, T.MapType)):
        return f"sha2(to_json({cell}), 256)"
    return cell


def _profile(fields: Sequence[T.StructField]) -> list[Column]:
    present = " + ".join(f"count(`{f.name}`)" for f in fields)
    return [
        F.expr("count(1) AS row_count"),
        F.expr(f"count(1) * {len(fields)} - ({present}) AS missing_values"),
        F.expr(f"count(1) - count(DISTINCT struct({', '.join(map(_narrow, fields))})) AS duplicate_rows"),
    ]


def dataset_profile(datasets: Mapping[str, DataFrame]) -> DataFrame:
    """Rows, columns, NULL cells and repeated whole rows of every dataset.

    Rows are told apart by their short cells and digests of the others, so whole texts,
    pages and vectors are not shuffled.  Nested values are compared as JSON.
    """
    return _stack([
        df.agg(*_profile(df.schema.fields)).select(
            F.lit(name).alias("dataset"), "row_count", F.lit(len(df.columns)).alias("column_count"),
            "missing_values", "duplicate_rows")
        for name, df in sorted(datasets.items())
    ])


def profile_groups(df: DataFrame, by: str) -> DataFrame:
    """The same of the datasets that one table holds, told apart by the column ``by``; one without rows has none here."""
    fields = [f for f in df.schema.fields if f.name != by]
    found = df.groupBy(F.col(by).alias("dataset")).agg(*_profile(fields))
    return found.select("dataset", "row_count", "missing_values", "duplicate_rows")


def quality_gate(missing: DataFrame, duplicates: DataFrame) -> DataFrame:
    """Pass or fail per table against the three limits."""
    worst = missing.groupBy("table_name").agg(F.max("missing_pct").alias("worst_missing_pct"))
    enough = F.col("total_rows") >= MIN_ROWS
    complete = F.col("worst_missing_pct") <= MAX_MISSING_PERCENT
    unique = F.col("duplicate_pct") <= MAX_DUPLICATE_PERCENT
    return duplicates.join(worst, "table_name").select(
        "table_name",
        "total_rows",
        "worst_missing_pct",
        "duplicate_pct",
        enough.alias("rows_ok"),
        complete.alias("missing_ok"),
        unique.alias("duplicates_ok"),
        (enough & complete & unique).alias("passed"),
    )
