"""Surrogate keys without a global sort or a global window."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from marketlens.operators.dedupe import new_keys_only
from marketlens.session import materialize

# ``monotonically_increasing_id`` holds the task number above this bit and the
# row number within the task below it.
_ROW_BITS = 33


def sparse_keys(df: DataFrame, key: str, start: int = 0) -> DataFrame:
    """Unique, increasing, not dense: free of any shuffle.

    The values are fixed by the write that follows, so use it on the way into a
    table, never on a DataFrame that is computed twice.
    """
    return df.select((F.monotonically_increasing_id() + start + 1).alias(key), "*")


def dense_keys(df: DataFrame, key: str, start: int = 0) -> DataFrame:
    """``start+1 .. start+n`` with one write and no shuffle of the rows.

    The rows are written once with their task and row number.  What is then
    ranked is one count per writing task; Spark broadcasts that table if it is small.
    """
    stored = materialize(df.select("*", F.monotonically_increasing_id().alias("_slot")), f"keys-{key}")
    task = F.shiftright("_slot", _ROW_BITS)
    row = F.col("_slot").bitwiseAND((1 << _ROW_BITS) - 1)
    earlier = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        stored.select(task.alias("_task"))
        .groupBy("_task")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_task", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_offset"))
    )
    return (
        stored.withColumn("_task", task)
        .join(offsets, "_task")
        .select((F.col("_offset") + row + start + 1).alias(key), *df.columns)
    )


def extend_dimension(existing: DataFrame, incoming: DataFrame, natural_id: str, key: str) -> DataFrame:
    """Insert-or-ignore into a keyed dimension: new members continue the key sequence."""
    columns = [c for c in existing.columns if c != key]
    last = existing.agg(F.coalesce(F.max(key), F.lit(0))).first()[0]
    fresh = new_keys_only(existing, incoming.select(*columns), natural_id)
    return existing.unionByName(dense_keys(fresh, key, last))
