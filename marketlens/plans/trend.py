"""Month-over-month growth and the moving average of the monthly series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from marketlens.functions.dates import period_label
from marketlens.operators.timeseries import complete_mean, growth_percent


def monthly_growth(trend: DataFrame, by: Sequence[str] = (), months: int = 3) -> DataFrame:
    """Growth is measured against the previous month that is present, not the calendar month.

    Without ``by`` the window is one partition: one row per month of the calendar.
    """
    ordered = Window.partitionBy(*by).orderBy("period")
    revenue = F.col("total_revenue")
    recent = ordered.rowsBetween(1 - months, Window.currentRow)
    return (
        trend.withColumn("period", period_label(F.col("year"), F.col("month")))
        .select(
            "*",
            growth_percent(revenue, ordered).alias("mom_revenue_growth_pct"),
            F.round(complete_mean(revenue.cast("decimal(38,10)"), recent, months), 2).alias(
                f"rolling_avg_{months}m_revenue"
            ),
        )
        .orderBy(*by, "period")
    )
