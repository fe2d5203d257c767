"""Times the headline queries on ``$BENCH_SF_DIR`` with ``local[$BENCH_CPUS]``.

Prints one JSON line.  Every query is run to the end into a no-op sink, once to
warm up the JVM and then timed.  ``publish`` is the full warehouse load that the
KPI queries read from; it is timed warm, by a second load beside the first.
"""

from __future__ import annotations

import json
import os
import sys
import time

from marketlens import registry
from marketlens.plans import warehouse
from marketlens.session import build_session, scratch_path

HEADLINE = (
    "kpi_overview", "geo_performance", "seller_performance", "category_profitability", "payment_distribution",
    "monthly_trend", "customer_rfm", "daily_revenue", "rfm_segments", "segment_summary", "monthly_growth",
    "weekly_sales_by_seller", "lag_features", "train_test_split", "fact_orders", "fact_order_items",
    "dim_customers", "dim_products", "insert_or_ignore", "surrogate_keys", "load_accounting", "missing_audit",
    "duplicate_audit", "rule_audit", "dataset_profile", "quality_gate", "clean_text", "csv_reviews", "forecast_8w",
    "csv_ingest", "incremental_ingest", "constraints", "profile_files",
)


def run(frame) -> None:
    frame.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or list(HEADLINE)
    spark = build_session(
        "marketlens-bench", f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false",
           "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    timings: dict[str, float] = {}
    registry.star(spark, sf_dir)
    started = time.perf_counter()
    warehouse.publish(spark, registry.staging(spark, sf_dir), scratch_path(spark, "bench"), registry.CALENDAR)
    timings["publish"] = round(time.perf_counter() - started, 3)
    for name in names:
        query = registry.QUERIES[name]
        run(query(spark, sf_dir))
        started = time.perf_counter()
        run(query(spark, sf_dir))
        timings[name] = round(time.perf_counter() - started, 3)
    print(json.dumps({
        "metric": "total_seconds",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": os.path.basename(sf_dir).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
