"""Report sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

# Column headings of the published report files.
HEADINGS = {
    "missing_values_report": {
        "schema_name": "Schema", "table_name": "Table", "column_name": "Column",
        "missing_count": "Missing Count", "total_count": "Total Count", "missing_pct": "Missing %",
    },
    "duplicate_rows_report": {
        "schema_name": "Schema", "table_name": "Table", "unique_keys": "Unique Keys",
        "total_rows": "Total Rows", "duplicate_rows": "Duplicate Rows", "duplicate_pct": "Duplicate %",
    },
    "value_constraints_report": {
        "rule_name": "Rule Name", "table_name": "Table", "column_name": "Column",
        "total_rows": "Total Rows", "violations_count": "Violations Count",
        "violation_pct": "Violation %", "sql_constraint": "SQL Constraint",
    },
    "data_quality_summary": {
        "dataset": "Dataset", "row_count": "Rows", "column_count": "Columns",
        "missing_values": "Missing Values", "duplicate_rows": "Duplicate Rows",
    },
    "rfm_customer_segments": {
        "customer_unique_id": "customer_unique_id", "recency_days": "recency_days",
        "frequency": "frequency", "monetary_value": "monetary_value", "r_score": "R_Score",
        "m_score": "M_Score", "f_score": "F_Score", "segment": "Segment",
        "rfm_score_code": "RFM_Score_Code",
    },
    "rfm_segment_summary": {
        "segment": "Segment", "customer_count": "customer_count", "avg_recency": "avg_recency",
        "avg_frequency": "avg_frequency", "avg_monetary": "avg_monetary",
        "total_monetary": "total_monetary", "customer_pct": "customer_pct", "revenue_pct": "revenue_pct",
    },
    "monthly_sales_growth": {
        "year": "year", "month": "month", "month_name": "month_name", "total_orders": "total_orders",
        "total_revenue": "total_revenue", "period": "Period",
        "mom_revenue_growth_pct": "MoM_Revenue_Growth_%", "rolling_avg_3m_revenue": "Rolling_Avg_3M_Revenue",
    },
    "weekly_demand_forecast": {
        "purchase_date": "purchase_date", "forecasted_revenue": "forecasted_revenue",
    },
}


def with_headings(df: DataFrame, report: str) -> DataFrame:
    return df.select(*[F.col(c).alias(heading) for c, heading in HEADINGS[report].items()])


def write_report(df: DataFrame, folder: str, report: str, order_by: Sequence = ()) -> str:
    """A report of bounded size as one sorted CSV file.

    The single task only receives finished report rows: the exchange in front of it
    keeps the aggregation parallel.
    """
    one = df.repartition(1)
    if order_by:
        one = one.sortWithinPartitions(*order_by)
    return _write(with_headings(one, report), folder, report)


def write_export(df: DataFrame, folder: str, report: str) -> str:
    """A table that grows with the data, as many CSV files as it has partitions."""
    return _write(with_headings(df, report), folder, report)


def _write(df: DataFrame, folder: str, report: str) -> str:
    path = f"{folder}/{report}"
    df.write.mode("overwrite").option("header", True).csv(path)
    return path
