"""Ordered-series operators.

They run on series that are already aggregated to weeks or months, so a window
partition holds one row per period of one series, however many orders it had.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from marketlens.functions.dates import week_ending_sunday


def complete_mean(value: Column, window: WindowSpec, size: int) -> Column:
    """Moving mean that is NULL until the frame holds ``size`` values.

    The sum stays a decimal where the value is one, so no binary rounding creeps in.
    """
    filled = F.count(value).over(window) == size
    return F.when(filled, F.sum(value).over(window) / F.lit(size))


def growth_percent(value: Column, ordered: WindowSpec, digits: int = 2) -> Column:
    """Change against the previous row in percent.

    A missing value repeats the last known one; growth from zero is NULL.
    """
    known = F.last(value, ignorenulls=True)
    current = known.over(ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    previous = known.over(ordered.rowsBetween(Window.unboundedPreceding, -1))
    change = (current - previous).cast("decimal(38,10)") * 100
    return F.round(change / F.nullif(previous, F.lit(0)), digits)


def weekly_totals(daily: DataFrame) -> DataFrame:
    """(series, purchase_date, revenue) to one row per series and Monday-to-Sunday week.

    Weeks without a sale between two weeks with one are filled with 0.
    """
    sold = (
        daily.groupBy("series", week_ending_sunday(F.col("purchase_date")).alias("sold_week"))
        .agg(F.coalesce(F.sum("revenue").cast("double"), F.lit(0.0)).alias("sold"))
    )
    following = F.lead("sold_week").over(Window.partitionBy("series").orderBy("sold_week"))
    up_to = F.coalesce(F.date_sub(following, 7), F.col("sold_week")).alias("up_to")
    weeks = F.sequence("sold_week", "up_to", F.expr("interval 7 days"))
    spans = sold.select("series", "sold_week", "sold", up_to)
    return spans.select("series", "sold_week", "sold", F.explode(weeks).alias("week_end")).select(
        "series",
        "week_end",
        F.when(F.col("week_end") == F.col("sold_week"), F.col("sold")).otherwise(F.lit(0.0)).alias("revenue"),
    )


def lag_features(weekly: DataFrame, lags: tuple[int, ...] = (1, 2, 3), mean_of: int = 4) -> DataFrame:
    """Previous values and the mean of the previous ``mean_of`` weeks, current week excluded."""
    ordered = Window.partitionBy("series").orderBy("week_end")
    revenue = F.col("revenue")
    return weekly.select(
        "*",
        *[F.lag(revenue, n).over(ordered).alias(f"lag_{n}") for n in lags],
        complete_mean(revenue, ordered.rowsBetween(-mean_of, -1), mean_of).alias(f"rolling_mean_{mean_of}"),
    )


def mark_last(df: DataFrame, size: int, flag: str) -> DataFrame:
    """Flag the last ``size`` weeks of every series."""
    latest_first = Window.partitionBy("series").orderBy(F.desc("week_end"))
    return df.select("*", (F.row_number().over(latest_first) <= size).alias(flag))


def mark_after(df: DataFrame, size: int, flag: str) -> DataFrame:
    """Flag the last ``size`` weeks of the whole panel: one date cuts all series."""
    end = df.agg(F.max("week_end")).scalar()
    return df.select("*", (F.col("week_end") > F.date_sub(end, 7 * size)).alias(flag))


def aligned(weekly: DataFrame) -> DataFrame:
    """Every series filled with weeks of 0 up to the last week that any series has."""
    end = weekly.agg(F.max("week_end")).scalar()
    silent = weekly.groupBy("series").agg(F.max("week_end").alias("_last")).filter(F.col("_last") < end)
    weeks = F.sequence(F.date_add("_last", 7), end, F.expr("interval 7 days"))
    return weekly.unionByName(silent.select("series", F.explode(weeks).alias("week_end"), F.lit(0.0).alias("revenue")))
