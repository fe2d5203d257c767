"""Customer segments from recency, frequency and spend."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from marketlens.functions.numeric import percent
from marketlens.operators.quantiles import bin_label, quantile_edges
from marketlens.session import materialize

BINS = 5

# Frequency score by number of orders; anything above scores TOP_FREQUENCY.
FREQUENCY_SCORES = {1: 1, 2: 3}
TOP_FREQUENCY = 5

# Segment name, lowest and highest recency score, lowest and highest
# frequency score.  The first row that matches wins; OTHER_SEGMENT takes the rest.
SEGMENTS = (
    ("Champions", 4, 5, 4, 5),
    ("Loyal Customers", 3, 5, 3, 5),
    ("Potential Loyalists", 4, 5, 2, 5),
    ("New Customers", 5, 5, 1, 1),
    ("Promising", 4, 4, 1, 1),
    ("Needs Attention", 3, 3, 2, 2),
    ("About to Sleep", 3, 3, 1, 1),
    ("Can't Lose Them", 1, 2, 4, 5),
    ("At Risk", 1, 2, 3, 3),
    ("Hibernating", 2, 2, 1, 2),
)
OTHER_SEGMENT = "Lost"


def frequency_score(orders: Column) -> Column:
    return F.coalesce(
        *[F.when(orders == n, F.lit(score)) for n, score in FREQUENCY_SCORES.items()], F.lit(TOP_FREQUENCY)
    )


def segment_name(recency: Column, frequency: Column) -> Column:
    matches = [
        F.when(recency.between(r_low, r_high) & frequency.between(f_low, f_high), F.lit(name))
        for name, r_low, r_high, f_low, f_high in SEGMENTS
    ]
    return F.coalesce(*matches, F.lit(OTHER_SEGMENT))


def score_customers(rfm: DataFrame, approximate: bool = False) -> DataFrame:
    """R, F and M scores.

    The customer table is stored once, because the edges need several passes over
    two of its columns; only the edges (twelve numbers) reach the driver.
    ``approximate`` trades exact edges for a single pass.
    """
    stored = materialize(rfm, "customer-rfm")
    if approximate:
        cuts = [i / BINS for i in range(BINS + 1)]
        picked = stored.agg(
            F.percentile_approx("recency_days", cuts, 10_000).alias("recency"),
            F.percentile_approx(F.col("monetary_value").cast("double"), cuts, 10_000).alias("money"),
        ).first()
        recency_edges, money_edges = picked.recency, picked.money
    else:
        measures = stored.select(
            F.col("recency_days").cast("long").alias("recency"),
            (F.col("monetary_value") * 100).cast("long").alias("money"),
        )
        edges = quantile_edges(measures, {"recency": 1, "money": 100}, BINS)
        recency_edges, money_edges = edges["recency"], edges["money"]
    rising = list(range(1, BINS + 1))
    return stored.select(
        "*",
        bin_label(F.col("recency_days").cast("double"), recency_edges, rising[::-1]).alias("r_score"),
        bin_label(F.col("monetary_value").cast("double"), money_edges, rising).alias("m_score"),
        frequency_score(F.col("frequency")).alias("f_score"),
    )


def segment_customers(rfm: DataFrame, approximate: bool = False) -> DataFrame:
    """Every customer with scores, segment and the three-digit code."""
    return label_segments(score_customers(rfm, approximate))


def label_segments(scored: DataFrame) -> DataFrame:
    return scored.select(
        "*",
        segment_name(F.col("r_score"), F.col("f_score")).alias("segment"),
        F.concat(*[F.col(c).cast("string") for c in ("r_score", "f_score", "m_score")]).alias("rfm_score_code"),
    )


def segment_summary(segmented: DataFrame) -> DataFrame:
    """One row per segment; the shares are taken over these few rows, not over the customers."""
    all_segments = Window.partitionBy()
    per_segment = segmented.groupBy("segment").agg(
        F.count("customer_unique_id").alias("customer_count"),
        F.avg("recency_days").alias("avg_recency"),
        F.avg("frequency").alias("avg_frequency"),
        F.sum("monetary_value").alias("total_monetary"),
    )
    return per_segment.select(
        "segment",
        "customer_count",
        "avg_recency",
        "avg_frequency",
        (F.col("total_monetary").cast("double") / F.col("customer_count")).alias("avg_monetary"),
        "total_monetary",
        percent(F.col("customer_count"), F.sum("customer_count").over(all_segments)).alias("customer_pct"),
        percent(F.col("total_monetary"), F.sum("total_monetary").over(all_segments)).alias("revenue_pct"),
    ).orderBy(F.desc("customer_count"), "segment")
