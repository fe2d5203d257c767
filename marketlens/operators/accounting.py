"""Where the rows of a warehouse load went: read, dropped by reason, loaded, and what no count explains.

Every figure is counted by itself, none is what is left over: ``unexplained`` is rows
read minus all reasons minus rows loaded, and anything but zero is a lost or doubled row.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from marketlens.plans.warehouse import DEFAULT_CALENDAR, LOAD_COUNTS, inside_calendar

_REASONS = ("null_key", "outside_calendar", "unknown_reference", "duplicate_key")
_KEYS = {"dim_customers": "customer_id", "dim_sellers": "seller_id", "dim_products": "product_id", "fact_orders": "order_id"}
_COPIED = ("fact_order_items", "fact_payments", "fact_reviews")


def _read(step: str, read: DataFrame) -> DataFrame:
    """``read`` is one row with ``rows_read`` and some reasons; the others are zero."""
    reasons = [F.col(r) if r in read.columns else F.lit(0).cast("long").alias(r) for r in _REASONS[:3]]
    return read.select(F.lit(step).alias("step"), "rows_read", *reasons)


def _dimension(step: str, source: DataFrame) -> DataFrame:
    key = F.col(_KEYS[step])
    return _read(step, source.agg(F.count(F.lit(1)).alias("rows_read"), F.count_if(key.isNull()).alias("null_key")))


def _copied(step: str, source: DataFrame) -> DataFrame:
    return _read(step, source.agg(F.count(F.lit(1)).alias("rows_read")))


def _surplus(rows: DataFrame, key: str) -> DataFrame:
    """One row: how many rows share a key with an earlier one."""
    per_key = rows.dropna(subset=[key]).groupBy(key).agg((F.count(F.lit(1)) - 1).alias("_extra"))
    return per_key.agg(F.coalesce(F.sum("_extra"), F.lit(0)).alias("duplicate_key"))


def _counted(staging: dict[str, DataFrame], star: dict[str, DataFrame], calendar: tuple[str, str]) -> DataFrame:
    """Rows loaded and repeated keys of a star that was not written by one full load."""
    inside = staging["orders"].filter(inside_calendar(F.col("order_purchase_timestamp"), calendar))
    sources = {
        "dim_customers": staging["customers"], "dim_sellers": staging["sellers"], "dim_products": staging["products"],
        "fact_orders": inside.join(star["dim_customers"].select("customer_id"), "customer_id", "left_semi"),
    }
    loaded = lambda step: star[step].agg(F.count(F.lit(1))).scalar().alias("rows_loaded")
    parts = [
        _surplus(source, _KEYS[step]).select(F.lit(step).alias("step"), loaded(step), "duplicate_key")
        for step, source in sources.items()
    ]
    parts += [
        star[step].agg(F.count(F.lit(1)).alias("rows_loaded")).select(
            F.lit(step).alias("step"), "rows_loaded", F.lit(0).cast("long").alias("duplicate_key"))
        for step in _COPIED
    ]
    return reduce(DataFrame.unionByName, parts)


def _flag(dim: DataFrame, key: str) -> DataFrame:
    return dim.select(F.col(key), F.lit(True).alias(f"_known_{key}"))


def _total(condition: Column, rows: Column) -> Column:
    return F.coalesce(F.sum(F.when(condition, rows)), F.lit(0))


def load_accounting(
    staging: dict[str, DataFrame], star: dict[str, DataFrame], calendar: tuple[str, str] = DEFAULT_CALENDAR
) -> DataFrame:
    """One row per load step.

    Rows loaded and copies merged are those that the full load counted while it wrote
    (``load_counts``); a star without them (composed lazily, or extended by increments)
    is counted here.  Facts are counted per referenced id before the ids are looked up,
    so the joins see one row per id.
    """
    keyless = F.col("order_id").isNull()
    outside = ~F.coalesce(inside_calendar(F.col("order_purchase_timestamp"), calendar), F.lit(False))
    per_customer = staging["orders"].groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("_rows"),
        F.count_if(keyless).alias("_keyless"),
        F.count_if(~keyless & outside).alias("_outside"),
    )
    left = F.col("_rows") - F.col("_keyless") - F.col("_outside")
    orders = per_customer.join(_flag(star["dim_customers"], "customer_id"), "customer_id", "left").agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("rows_read"),
        F.coalesce(F.sum("_keyless"), F.lit(0)).alias("null_key"),
        F.coalesce(F.sum("_outside"), F.lit(0)).alias("outside_calendar"),
        _total(F.col("_known_customer_id").isNull(), left).alias("unknown_reference"),
    )
    items = (
        staging["order_items"]
        .groupBy("product_id", "seller_id")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .join(_flag(star["dim_products"], "product_id"), "product_id", "left")
        .join(_flag(star["dim_sellers"], "seller_id"), "seller_id", "left")
        .agg(
            F.coalesce(F.sum("_rows"), F.lit(0)).alias("rows_read"),
            _total(
                F.col("_known_product_id").isNull() | F.col("_known_seller_id").isNull(), F.col("_rows")
            ).alias("unknown_reference"),
        )
    )
    read = reduce(
        DataFrame.unionByName,
        [
            _dimension("dim_customers", staging["customers"]),
            _dimension("dim_sellers", staging["sellers"]),
            _dimension("dim_products", staging["products"]),
            _read("fact_orders", orders),
            _read("fact_order_items", items),
            _copied("fact_payments", staging["order_payments"]),
            _copied("fact_reviews", staging["order_reviews"]),
        ],
    )
    counted = star[LOAD_COUNTS] if LOAD_COUNTS in star else _counted(staging, star, calendar)
    gone = reduce(Column.__add__, [F.col(r) for r in _REASONS])
    return read.join(counted, "step").select(
        "step", "rows_read", *_REASONS, "rows_loaded",
        (F.col("rows_read") - gone - F.col("rows_loaded")).alias("unexplained"),
    )
