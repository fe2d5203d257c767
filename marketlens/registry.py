"""Every operator as a query over the given tables."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from marketlens.functions import text
from marketlens.functions.dates import date_key
from marketlens.operators import audits
from marketlens.operators.accounting import load_accounting
from marketlens.operators.constraints import constraint_report, foreign_key_orphans
from marketlens.operators.dedupe import insert_or_ignore
from marketlens.operators.keys import dense_keys, extend_dimension
from marketlens.operators.timeseries import lag_features
from marketlens.plans import forecast as fc, kpis, segments, trend, warehouse
from marketlens.plans.increments import publish_batches
from marketlens.plans.quality import quality_report
from marketlens.schemas import DATASETS, SURROGATE_KEYS
from marketlens.session import delete_path, list_path, materialize, scratch_path, scratch_root
from marketlens.sources import testtables
from marketlens.sources.catalog import create_namespaces, register_version, register_views, schema_tables
from marketlens.sources.csv_files import ingest, open_staging, profile_files
from marketlens.sources.reports import HEADINGS, write_export, write_report
from marketlens.streaming.ingest import batch_counts, read_increments, start_ingest

Query = Callable[[SparkSession, str], DataFrame]

CALENDAR = testtables.CALENDAR
GIVEN_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
                "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

_published: dict[tuple, dict[str, DataFrame]] = {}
_incremental: dict[tuple, dict[str, DataFrame]] = {}


def staging(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return testtables.staging_tables(spark, sf_dir)


def star(spark: SparkSession, sf_dir: str, lines: str | None = None) -> dict[str, DataFrame]:
    """The published star of ``sf_dir``, loaded by the first query of a session that needs it.

    The lines per order and seller or category are stored by the first query that asks for them (``lines``); most
    queries need neither.  A folder whose files have changed is loaded again.
    """
    state = (spark.sparkContext.applicationId, spark._jsparkSession.sessionUUID(), list_path(spark, sf_dir))
    if state not in _published:
        root = scratch_path(spark, "warehouse")
        _published[state] = warehouse.publish(spark, staging(spark, sf_dir), root, CALENDAR, joins=[kpis.ORDER_REVENUE])
    tables = _published[state]
    if lines in kpis.ORDER_LINES and kpis.ORDER_LINES[lines] not in tables:
        tables[kpis.ORDER_LINES[lines]] = materialize(kpis.order_lines(tables, lines), kpis.ORDER_LINES[lines])
    return tables


def comparable(df: DataFrame) -> DataFrame:
    """Decimals as doubles, so that engines with other decimal widths can be compared."""
    return df.select(
        *[
            F.col(f.name).cast("double").alias(f.name) if f.dataType.typeName() == "decimal" else F.col(f.name)
            for f in df.schema.fields
        ]
    )


# --- warehouse ---------------------------------------------------------------


def q_dim_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The calendar with the number of orders placed on each day."""
    orders = testtables.orders(spark, sf_dir).groupBy(
        date_key(F.col("order_purchase_timestamp")).alias("date_key")
    ).agg(F.count(F.lit(1)).alias("orders_placed"))
    days = warehouse.dim_date(spark, CALENDAR).join(orders, "date_key", "left")
    return days.withColumn("orders_placed", F.coalesce("orders_placed", F.lit(0)))


def q_dim_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warehouse.dim_customers(testtables.customers(spark, sf_dir))


def q_dim_sellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warehouse.dim_sellers(testtables.sellers(spark, sf_dir))


def q_dim_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warehouse.dim_products(
        testtables.products(spark, sf_dir), testtables.category_translation(spark, sf_dir)
    )


def q_fact_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = warehouse.fact_orders(testtables.orders(spark, sf_dir), testtables.customers(spark, sf_dir), CALENDAR)
    return facts.withColumnRenamed("customer_key", "customer_id")


def q_fact_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = warehouse.fact_order_items(
        testtables.order_items(spark, sf_dir), testtables.products(spark, sf_dir), testtables.sellers(spark, sf_dir)
    )
    return comparable(items.withColumnsRenamed({"product_key": "product_id", "seller_key": "seller_id"}))


def q_fact_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(warehouse.fact_payments(testtables.order_payments(spark, sf_dir)))


def q_fact_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warehouse.fact_reviews(testtables.order_reviews(spark, sf_dir))


def _customers_as_sellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return testtables.customers(spark, sf_dir).selectExpr(
        "customer_id AS seller_id", "customer_zip_code_prefix AS seller_zip_code_prefix",
        "customer_city AS seller_city", "customer_state AS seller_state",
    )


def q_insert_or_ignore(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers offered to the seller dimension: known ids keep their row."""
    return insert_or_ignore(q_dim_sellers(spark, sf_dir), _customers_as_sellers(spark, sf_dir), "seller_id")


def q_extended_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same offer to the stored dimension: old keys stay, new ones follow without a gap."""
    stored = star(spark, sf_dir)["dim_sellers"]
    extended = extend_dimension(stored, _customers_as_sellers(spark, sf_dir), "seller_id", "seller_key")
    kept = extended.join(stored.select("seller_id", F.col("seller_key").alias("_old")), "seller_id", "left")
    return kept.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.countDistinct("seller_key").alias("key_count"),
        F.max("seller_key").alias("last_key"),
        F.count_if(F.col("_old") == F.col("seller_key")).alias("kept_keys"),
    )


def q_surrogate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dense keys for every order line: as many keys as rows, from 1 without a gap."""
    keyed = dense_keys(testtables.order_items(spark, sf_dir).select("order_id", "order_item_id"), "order_item_key")
    return keyed.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.countDistinct("order_item_key").alias("key_count"),
        F.min("order_item_key").alias("first_key"),
        F.max("order_item_key").alias("last_key"),
    )


def q_published_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A full publish; rows of every table of the committed version and of its keys."""
    root = scratch_path(spark, "warehouse")
    warehouse.publish(spark, staging(spark, sf_dir), root, CALENDAR)
    return _table_sizes(warehouse.open_star(spark, root))


def _table_sizes(tables: dict[str, DataFrame]) -> DataFrame:
    parts = [
        tables[name].agg(
            F.lit(name).alias("table_name"),
            F.count(F.lit(1)).alias("row_count"),
            F.countDistinct(SURROGATE_KEYS.get(name, "date_key")).alias("key_count"),
        )
        for name in warehouse.TABLES
    ]
    return reduce(DataFrame.unionByName, parts)


def q_constraints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return constraint_report(star(spark, sf_dir))


def q_constraint_defects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The constraints that the stored star breaks once cells, keys and rows of it are spoilt by rules on its ids."""
    tables = dict(star(spark, sf_dir))

    def spoil(table: str, column: str, value: str, where: str) -> None:
        tables[table] = tables[table].withColumn(column, F.expr(f"CASE WHEN {where} THEN {value} ELSE `{column}` END"))

    spoil("dim_customers", "customer_state", "repeat('X', 11)", "customer_id % 7 = 0")
    spoil("dim_sellers", "seller_city", "repeat('ä', 101)", "seller_id % 3 = 0")
    spoil("dim_products", "product_category_name", "repeat('x', 100)", "product_id % 2 = 0")  # as long as allowed
    spoil("fact_orders", "order_status", "NULL", "order_id % 5 = 0")
    spoil("fact_orders", "customer_key", "customer_key + 1000000000", "order_id % 13 = 0")
    spoil("fact_orders", "purchase_date_key", "NULL", "order_id % 17 = 0")  # missing, and so no orphan
    spoil("fact_order_items", "product_key", "-product_key", "order_id % 11 = 0")
    spoil("fact_payments", "payment_type", "repeat('p', 51)", "order_id % 3 = 0")
    spoil("fact_reviews", "review_score", "NULL", "review_score = 1")
    tables["dim_sellers"] = tables["dim_sellers"].unionByName(tables["dim_sellers"].filter("seller_id % 4 = 1"))
    return constraint_report(tables).filter("violations > 0")


def q_fk_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw order lines whose order, part or supplier does not exist, and orders without a customer."""
    items, orders = testtables.order_items(spark, sf_dir), testtables.orders(spark, sf_dir)
    checks = [
        ("order_items.order_id", items, "order_id", orders, "order_id"),
        ("order_items.product_id", items, "product_id", testtables.products(spark, sf_dir), "product_id"),
        ("order_items.seller_id", items, "seller_id", testtables.sellers(spark, sf_dir), "seller_id"),
        ("orders.customer_id", orders, "customer_id", testtables.customers(spark, sf_dir), "customer_id"),
        ("orders.order_id in order_items", orders, "order_id", items, "order_id"),
    ]
    result = None
    for label, child, column, parent, key in checks:
        one = foreign_key_orphans(child, column, parent, key).select(
            F.lit(label).alias("reference"), F.col("violations").alias("orphans")
        )
        result = one if result is None else result.unionByName(one)
    return result


def q_load_accounting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_accounting(staging(spark, sf_dir), star(spark, sf_dir), CALENDAR)


# --- KPI views ---------------------------------------------------------------


def _over_star(view: Callable[..., DataFrame], lines: str | None = None, **options: object) -> Query:
    return lambda spark, sf_dir: comparable(view(star(spark, sf_dir, lines), **options))


def q_repeat_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpis.orders_per_person(star(spark, sf_dir))


def q_order_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(kpis.orders_with_revenue(star(spark, sf_dir), "order_status"))


# --- segments and trend ------------------------------------------------------


def _segmented(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segments.segment_customers(kpis.customer_rfm(star(spark, sf_dir)))


def q_rfm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = segments.score_customers(kpis.customer_rfm(star(spark, sf_dir)))
    return scored.select("customer_unique_id", "r_score", "f_score", "m_score")


def q_rfm_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(_segmented(spark, sf_dir))


def q_segment_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(segments.segment_summary(_segmented(spark, sf_dir)))


def q_monthly_growth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(trend.monthly_growth(kpis.monthly_sales_trend(star(spark, sf_dir))))


def q_monthly_growth_by_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = fc.daily_series(star(spark, sf_dir), "state")
    monthly = daily.groupBy(
        "series", F.year("purchase_date").alias("year"), F.month("purchase_date").alias("month")
    ).agg(F.sum("revenue").alias("total_revenue"))
    return comparable(trend.monthly_growth(monthly, ["series"]))


# --- forecast ----------------------------------------------------------------


def _weekly(spark: SparkSession, sf_dir: str, by: str | None) -> DataFrame:
    return fc.weekly_series(fc.daily_series(star(spark, sf_dir, by), by), CALENDAR)


def q_weekly_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _weekly(spark, sf_dir, None)


def q_weekly_sales_by_seller(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _weekly(spark, sf_dir, "seller")


def q_weekly_sales_by_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _weekly(spark, sf_dir, "category")


def q_lag_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    featured = lag_features(_weekly(spark, sf_dir, "seller"))
    return featured.withColumn("rolling_mean_4", F.round("rolling_mean_4", 4))


def q_train_test_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weeks of all sellers up to the last week of any, cut at one date."""
    rows = fc.model_input(fc.daily_series(star(spark, sf_dir, "seller"), "seller"), CALENDAR)[0]
    return rows.select("series", "week_end", "revenue", "is_test")


def q_train_test_split_by_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weeks of the regions, with each region's own last weeks."""
    rows = fc.model_rows(fc.with_history(_weekly(spark, sf_dir, "state"))[0], by_date=False)
    return rows.select("series", "week_end", "revenue", "is_test")


def q_short_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers, one series each, with too few weeks between first and last order to model."""
    paid = kpis.orders_with_revenue(star(spark, sf_dir), "customer_key", "purchase_timestamp")
    people = star(spark, sf_dir)["dim_customers"].select("customer_key", "customer_unique_id")
    daily = (
        paid.groupBy("customer_key", F.to_date("purchase_timestamp").alias("purchase_date"))
        .agg(F.sum("order_revenue").alias("revenue"))
        .join(people, "customer_key")
        .select(F.col("customer_unique_id").alias("series"), "purchase_date", "revenue")
    )
    return fc.with_history(fc.weekly_series(daily, CALENDAR))[1]


def q_forecast_8w(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight weeks for the total by itself, and for all regions from one pooled forest."""
    tables = star(spark, sf_dir)
    runs = [fc.run_forecast(fc.daily_series(tables, by), CALENDAR).forecast for by in (None, "state")]
    return runs[0].unionByName(runs[1])


def q_forecast_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dates of a forest's forecast of the total, and whether each value is inside what the series has seen."""
    run = fc.run_forecast(fc.daily_series(star(spark, sf_dir)), CALENDAR)
    seen = run.rows.groupBy("series").agg(F.min("revenue").alias("lo"), F.max("revenue").alias("hi"))
    inside = F.col("forecasted_revenue").between(F.col("lo") - 0.01, F.col("hi") + 0.01)
    return run.forecast.join(seen, "series").select("series", "purchase_date", inside.alias("in_range"))


def q_forecast_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight weeks for all regions from a forest that was stored as a table of nodes and is walked in SQL."""
    rows, usable = fc.model_input(fc.daily_series(star(spark, sf_dir), "state"), CALENDAR)[:2]
    nodes = fc.forest_nodes(spark, fc.fit(rows.filter("NOT is_test")), scratch_path(spark, "forest"))
    return fc.forecast(partial(fc.predict_nodes, nodes), usable)


def q_forecast_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The recursion with the four-week mean in the place of the forest."""
    return fc.forecast(fc.four_week_mean, fc.with_history(_weekly(spark, sf_dir, "state"))[0])


def q_evaluate_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Errors of last week's revenue as the prediction, per category."""
    rows = fc.model_rows(fc.with_history(_weekly(spark, sf_dir, "category"))[0], by_date=False).filter("is_test")
    found = fc.evaluate(fc.last_week(rows), by_series=True)
    return found.select("series", "test_rows", *[F.round(c, 3).alias(c) for c in ("mae", "rmse", "mean_weekly_revenue")])


def q_forecast_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The total's baseline forecast as a report file, read back."""
    rows = fc.forecast(fc.four_week_mean, fc.with_history(_weekly(spark, sf_dir, None))[0])
    path = write_report(rows, scratch_path(spark, "reports"), "weekly_demand_forecast", ["purchase_date"])
    return _read_back(rows, path, "weekly_demand_forecast")


def q_forecast_eval(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fc.run_forecast(fc.daily_series(star(spark, sf_dir, "category"), "category"), CALENDAR).evaluation


# --- audits ------------------------------------------------------------------


def q_missing_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audits.missing_values(staging(spark, sf_dir))


def q_duplicate_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audits.duplicate_keys(staging(spark, sf_dir))


def q_rule_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audits.value_rules(staging(spark, sf_dir))


def q_dataset_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audits.dataset_profile({t: testtables.table(spark, sf_dir, t) for t in GIVEN_TABLES})


def q_quality_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_report(staging(spark, sf_dir)).gate


def q_quality_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the three audits that need attention, in one list."""
    report = quality_report(staging(spark, sf_dir))
    missing = report.missing_issues.select(
        F.lit("missing").alias("audit"), "table_name", F.col("column_name").alias("subject"),
        F.col("missing_count").alias("affected_rows"), F.col("missing_pct").alias("affected_pct"))
    duplicates = report.duplicate_issues.select(
        F.lit("duplicate").alias("audit"), "table_name", F.col("unique_keys").alias("subject"),
        F.col("duplicate_rows").alias("affected_rows"), F.col("duplicate_pct").alias("affected_pct"))
    rules = report.rule_issues.select(
        F.lit("rule").alias("audit"), "table_name", F.col("rule_name").alias("subject"),
        F.col("violations_count").alias("affected_rows"), F.col("violation_pct").alias("affected_pct"))
    return missing.unionByName(duplicates).unionByName(rules)


# --- cleaning, files and streams ---------------------------------------------


def q_clean_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole document texts, padded with mixed white space, stripped and null-normalized."""
    padded = F.concat(F.lit("\t  "), F.col("text"), F.lit(" \r\n"))
    documents = testtables.table(spark, sf_dir, "documents")
    return documents.select("doc_id", text.clean_text(padded).alias("clean_text"))


def q_null_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How event types survive when they arrive as null tokens, padded or not."""
    events = testtables.table(spark, sf_dir, "events")
    tokens = F.array(*[F.lit(t) for t in ("NA", " NA ", "nan", " None ", "null", "N/A", "", "  ")])
    raw = F.when(F.col("value") < 8, tokens[(F.col("event_id") % 8).cast("int")]).otherwise(F.col("event_type"))
    return events.select("event_id", text.clean_text(text.reader_na_to_null(raw)).alias("event_type"))


def q_safe_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event times as text; the broken ones become NULL instead of failing the load."""
    events = testtables.table(spark, sf_dir, "events")
    shown = F.col("ts").cast("string")
    raw = (
        F.when(F.col("event_type") == "error", F.concat(F.lit("at "), shown))
        .when(F.col("event_type") == "view", F.col("ts").cast("date").cast("string"))
        .otherwise(F.concat(F.lit(" "), shown))
    )
    return events.select("event_id", text.safe_timestamp(raw).alias("event_time"))


def q_safe_int(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line quantities as exported by a tool that writes integers as ``4.0``."""
    lines = testtables.table(spark, sf_dir, "lineitem")
    raw = F.when(F.col("l_returnflag") == "R", F.concat(F.format_string("%d", F.col("l_quantity").cast("int")), F.lit(".0"))).when(
        F.col("l_returnflag") == "A", F.format_string("%d", F.col("l_quantity").cast("int"))
    ).otherwise(F.concat(F.format_string("%d", F.col("l_quantity").cast("int")), F.lit(" pcs")))
    quantity = text.safe_int(raw)
    return lines.groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("cells"),
        F.count(quantity).alias("accepted"),
        F.sum(quantity).alias("total_quantity"),
    )


#: Cells that are exported unreadable: dataset, column, rows.
_BAD_CELLS = {
    "orders": (("order_purchase_timestamp", "order_id % 7 = 0"), ("order_estimated_delivery_date", "order_id % 5 = 0")),
    "order_items": (("price", "order_id % 6 = 0"), ("order_item_id", "order_id % 10 = 0")),
    "payments": (("payment_value", "order_id % 9 = 0"),),
    "products": (("product_weight_g", "product_id % 4 = 0"),),
    "geolocation": (("geolocation_lat", "geolocation_lng = 3"),),
}
#: Rows whose line gets one cell too many.
_LONG_LINES = {"orders": "order_id % 11 = 0", "customers": "customer_id % 8 = 0", "payments": "order_id % 4 = 1",
               "sellers": "seller_id % 3 = 0"}


def _export_csv(spark: SparkSession, sf_dir: str, keys: tuple[str, ...], planted: bool = False) -> str:
    """The tables as CSV, ``planted`` with unreadable cells and lines that are one cell too long."""
    folder = scratch_path(spark, "raw")

    def export(key: str) -> None:
        table = testtables.STAGING_BUILDERS[DATASETS[key].table](spark, sf_dir)
        for column, where in _BAD_CELLS.get(key, ()) if planted else ():
            shown = F.col(column).cast("string")
            spoilt = F.concat(F.lit("about "), F.coalesce(shown, F.lit("none")))
            table = table.withColumn(column, F.when(F.expr(where), spoilt).otherwise(shown))
        writer = table.write.option("header", True).option("escape", '"')
        if planted and key in _LONG_LINES:
            # Whole lines as the one cell of a file with another separator, so that the added cell is not quoted.
            cells = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in table.columns]
            extra = F.when(F.expr(_LONG_LINES[key]), F.lit(",more")).otherwise(F.lit(""))
            lines = table.select(F.concat(F.concat_ws(",", *cells), extra).alias(",".join(table.columns)))
            writer = lines.write.option("header", True).option("sep", "\u0001").option("quote", "")
        writer.csv(f"{folder}/{key}")

    with ThreadPoolExecutor(max_workers=6) as pool:
        list(pool.map(export, keys))
    return folder


def q_csv_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All raw files, with unreadable cells and overlong lines among them, read, cleaned, typed and stored."""
    keys = tuple(DATASETS)
    raw = _export_csv(spark, sf_dir, keys, planted=True)
    result = ingest(spark, raw, scratch_path(spark, "staging"), files={k: k for k in keys})
    return result.select("dataset", "table_name", "rows_loaded", "rejected_cells", "malformed_rows", "status")


def q_csv_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The review table after a full trip through CSV."""
    raw = _export_csv(spark, sf_dir, ("reviews",))
    root = scratch_path(spark, "staging")
    ingest(spark, raw, root, files={"reviews": "reviews"})
    return open_staging(spark, root)["order_reviews"]


def q_report_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The monthly report written as CSV and read back as text."""
    report = trend.monthly_growth(kpis.monthly_sales_trend(star(spark, sf_dir)))
    path = write_report(report, scratch_path(spark, "reports"), "monthly_sales_growth", ["period"])
    back = spark.read.option("header", True).csv(path)
    return back.select(
        F.col("Period").alias("period"), "month_name", "total_orders", "total_revenue",
        F.col("`MoM_Revenue_Growth_%`").alias("growth"), F.col("Rolling_Avg_3M_Revenue").alias("rolling"),
    )


def q_profile_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every CSV file of a folder profiled: one for each of the nine datasets."""
    folder = scratch_path(spark, "raw")

    def export(table: str) -> None:
        rows = testtables.STAGING_BUILDERS[table](spark, sf_dir)
        rows.write.option("header", True).option("escape", '"').csv(f"{folder}/{table}.csv")

    with ThreadPoolExecutor(max_workers=6) as pool:
        list(pool.map(export, testtables.STAGING_BUILDERS))
    return profile_files(spark, folder)


def q_sql_over_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registered views queried by name: each month's share of the total revenue."""
    register_views(star(spark, sf_dir))
    return spark.sql("""
        SELECT year, month,
               double(round(total_revenue * 100 / (SELECT total_revenue FROM v_kpi_overview), 2)) AS share_pct
        FROM v_monthly_sales_trend
    """)


def q_incremental_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers delivered as CSV, then again with another city, then once more to a stream with a new checkpoint: first rows stay."""
    dataset, folder = DATASETS["customers"], scratch_path(spark, "delivery")
    target, checkpoint = scratch_path(spark, "increments"), scratch_path(spark, "progress")
    customers = testtables.customers(spark, sf_dir)
    customers.unionByName(customers).write.option("header", True).csv(folder)
    start_ingest(spark, folder, dataset, target, checkpoint).awaitTermination()
    moved = customers.withColumn("customer_city", F.lit("moved")).unionByName(
        customers.withColumn("customer_id", -1 - F.col("customer_id"))
    )
    moved.write.mode("append").option("header", True).csv(folder)
    start_ingest(spark, folder, dataset, target, checkpoint).awaitTermination()
    later = customers.withColumn("customer_id", -1_000_000_000 - F.col("customer_id"))
    later.write.mode("append").option("header", True).csv(folder)
    start_ingest(spark, folder, dataset, target, scratch_path(spark, "progress")).awaitTermination()
    return read_increments(spark, target)


#: Which rows of a table come with the first delivery; customers, parts and suppliers of early orders come late.
_FIRST_DELIVERY = {
    "customers": "customer_id % 4 <> 0", "sellers": "seller_id % 3 <> 1", "products": "product_id % 5 <> 2", "category_translation": "true",
    "orders": "order_id % 3 <> 0", "order_items": "order_id % 2 = 0 OR order_item_id = 1", "order_payments": "order_id % 3 <> 1",
    "order_reviews": "order_id % 5 < 3",
}


def _deliver(spark: SparkSession, sf_dir: str, raw: str, staged: str, rows: dict[str, str]) -> None:
    """Write the named rows of each table as CSV and take them into the staging tables by a stream each."""
    def one(table: str) -> None:
        frame = testtables.STAGING_BUILDERS[table](spark, sf_dir).filter(rows[table])
        if table == "order_reviews":  # staging keeps one row per review id, so ids must tell reviews apart
            frame = frame.withColumn("review_id", F.concat_ws("-", "review_id", "order_id", "review_score"))
        if table == "order_items":  # the given line numbers repeat within an order
            digest = F.xxhash64(*[c for c in frame.columns if c != "order_item_id"], "order_item_id")
            frame = frame.withColumn("order_item_id", F.pmod(digest, F.lit(2_000_000_000)))
        # Compressed files are not split when they are read, so none gets long.
        packed = {"header": True, "escape": '"', "compression": "gzip", "maxRecordsPerFile": 200_000}
        frame.write.mode("append").options(**packed).csv(f"{raw}/{table}")
        dataset = next(d for d in DATASETS.values() if d.table == table)
        start_ingest(spark, f"{raw}/{table}", dataset, f"{staged}/{table}", f"{raw}/_progress/{table}", key_parts=16).awaitTermination()

    with ThreadPoolExecutor(max_workers=4) as pool:
        list(pool.map(one, rows))


def incremental_star(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The star after two deliveries, each published when it had come, the second one as an increment."""
    state = (spark.sparkContext.applicationId, spark._jsparkSession.sessionUUID(), list_path(spark, sf_dir))
    if state not in _incremental:
        scratch_root(spark)
        raw, staged, root = (scratch_path(spark, label) for label in ("raw", "staged", "warehouse"))
        _deliver(spark, sf_dir, raw, staged, _FIRST_DELIVERY)
        publish_batches(spark, root, staged, CALENDAR)
        late = {table: f"NOT ({first})" for table, first in _FIRST_DELIVERY.items() if first != "true"}
        _deliver(spark, sf_dir, raw, staged, late)
        delete_path(spark, raw)  # taken in to the last file
        _incremental[state] = publish_batches(spark, root, staged, CALENDAR)
    return _incremental[state]


def q_increment_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and keys of every table after the increment: those of a full refresh."""
    return _table_sizes(incremental_star(spark, sf_dir))


def q_increment_sellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    sellers = kpis.seller_performance(incremental_star(spark, sf_dir))
    return comparable(sellers).withColumn("seller_id", F.col("seller_id").cast("long"))


def q_increment_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(kpis.category_profitability(incremental_star(spark, sf_dir)))


def q_increment_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(kpis.monthly_sales_trend(incremental_star(spark, sf_dir)))


def q_ingest_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places delivered with unreadable coordinates and overlong lines: what each batch read, rejected and added."""
    raw, target = scratch_path(spark, "raw"), scratch_path(spark, "places")
    places = testtables.table(spark, sf_dir, "customer").selectExpr(
        "c_custkey", "string(c_nationkey) AS geolocation_zip_code_prefix",
        "concat(CASE WHEN c_custkey % 9 = 0 THEN 'near ' ELSE '' END, c_custkey % 50) AS geolocation_lat",
        "double(c_custkey) AS geolocation_lng", "'city' AS geolocation_city",
        "concat('state', CASE WHEN c_custkey % 11 = 0 THEN ',more' ELSE '' END) AS geolocation_state")
    for wanted in ("c_custkey % 2 = 0", "c_custkey % 3 <> 1"):
        rows = places.filter(wanted).drop("c_custkey")
        # Without quotes a comma inside a cell makes the line one cell too long.
        rows.write.mode("append").option("header", True).option("quote", "").csv(raw)
        start_ingest(spark, raw, DATASETS["geolocation"], target, f"{raw}-progress", key_parts=16).awaitTermination()
    return batch_counts(spark, target).select(F.col("_batch").alias("batch"), "rows_read", "rejected_cells", "malformed_rows", "rows_added")


def q_registered_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Namespace, columns and rows of the warehouse tables, registered again after a second publish."""
    root = scratch_path(spark, "warehouse")
    create_namespaces(spark)
    for _ in range(2):
        warehouse.publish(spark, staging(spark, sf_dir), root, CALENDAR, joins=())  # the tables alone are asked for
        register_version(spark, "warehouse", root)
    parts = [
        table.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit("warehouse").alias("namespace"), F.lit(name).alias("table_name"),
            F.lit(len(table.columns)).alias("column_count"), "row_count")
        for name, table in schema_tables(spark, "warehouse").items() if name in warehouse.TABLES
    ]
    return reduce(DataFrame.unionByName, parts)


def _read_back(written: DataFrame, path: str, report: str) -> DataFrame:
    """A written report with its own column names and types."""
    back = written.sparkSession.read.option("header", True).csv(path)
    names = HEADINGS[report]
    return back.select(*[F.col(f"`{names[f.name]}`").cast(f.dataType).alias(f.name) for f in written.schema.fields if f.name in names])


def q_segment_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The per-customer segments as an export of many files, read back."""
    rows = q_rfm_segments(spark, sf_dir)
    return _read_back(rows, write_export(rows, scratch_path(spark, "exports"), "rfm_customer_segments"), "rfm_customer_segments")


def q_segment_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The segment summary as one sorted report file, read back."""
    rows = q_segment_summary(spark, sf_dir)
    path = write_report(rows, scratch_path(spark, "reports"), "rfm_segment_summary", ["segment"])
    return _read_back(rows, path, "rfm_segment_summary")


QUERIES: dict[str, Query] = {
    "dim_date": q_dim_date,
    "dim_customers": q_dim_customers,
    "dim_sellers": q_dim_sellers,
    "dim_products": q_dim_products,
    "fact_orders": q_fact_orders,
    "fact_order_items": q_fact_order_items,
    "fact_payments": q_fact_payments,
    "fact_reviews": q_fact_reviews,
    "insert_or_ignore": q_insert_or_ignore,
    "extended_dimension": q_extended_dimension,
    "surrogate_keys": q_surrogate_keys,
    "published_tables": q_published_tables,
    "constraints": q_constraints,
    "constraint_defects": q_constraint_defects,
    "fk_orphans": q_fk_orphans,
    "load_accounting": q_load_accounting,
    "kpi_overview": _over_star(kpis.kpi_overview),
    "kpi_overview_completed": _over_star(kpis.kpi_overview, statuses=("delivered",)),
    "repeat_customers": q_repeat_customers,
    "order_revenue": q_order_revenue,
    "geo_performance": _over_star(kpis.geographic_performance),
    "seller_performance": _over_star(kpis.seller_performance, "seller"),
    "seller_performance_deduped": _over_star(kpis.seller_performance, "seller", dedupe_reviews=True),
    "category_profitability": _over_star(kpis.category_profitability, "category"),
    "category_profitability_deduped": _over_star(kpis.category_profitability, "category", dedupe_reviews=True),
    "payment_distribution": _over_star(kpis.payment_distribution),
    "monthly_trend": _over_star(kpis.monthly_sales_trend),
    "customer_rfm": _over_star(kpis.customer_rfm),
    "daily_revenue": _over_star(kpis.daily_revenue),
    "delivery_time": _over_star(kpis.delivery_time),
    "on_time_rate": _over_star(kpis.on_time_rate),
    "satisfaction": _over_star(kpis.satisfaction),
    "customer_ltv": _over_star(kpis.customer_lifetime_value),
    "rfm_scores": q_rfm_scores,
    "rfm_segments": q_rfm_segments,
    "segment_summary": q_segment_summary,
    "monthly_growth": q_monthly_growth,
    "monthly_growth_by_state": q_monthly_growth_by_state,
    "weekly_sales": q_weekly_sales,
    "weekly_sales_by_seller": q_weekly_sales_by_seller,
    "weekly_sales_by_category": q_weekly_sales_by_category,
    "lag_features": q_lag_features,
    "train_test_split": q_train_test_split,
    "train_test_split_by_series": q_train_test_split_by_series,
    "short_series": q_short_series,
    "forecast_8w": q_forecast_8w,
    "forecast_eval": q_forecast_eval,
    "forecast_calendar": q_forecast_calendar,
    "forecast_stored": q_forecast_stored,
    "forecast_baseline": q_forecast_baseline,
    "evaluate_baseline": q_evaluate_baseline,
    "forecast_export": q_forecast_export,
    "missing_audit": q_missing_audit,
    "duplicate_audit": q_duplicate_audit,
    "rule_audit": q_rule_audit,
    "dataset_profile": q_dataset_profile,
    "quality_gate": q_quality_gate,
    "quality_issues": q_quality_issues,
    "clean_text": q_clean_text,
    "null_tokens": q_null_tokens,
    "safe_timestamp": q_safe_timestamp,
    "safe_int": q_safe_int,
    "csv_ingest": q_csv_ingest,
    "csv_reviews": q_csv_reviews,
    "report_csv": q_report_csv,
    "profile_files": q_profile_files,
    "sql_over_views": q_sql_over_views,
    "incremental_ingest": q_incremental_ingest,
    "increment_tables": q_increment_tables,
    "increment_sellers": q_increment_sellers,
    "increment_categories": q_increment_categories,
    "increment_months": q_increment_months,
    "ingest_counts": q_ingest_counts,
    "registered_tables": q_registered_tables,
    "segment_export": q_segment_export,
    "segment_report": q_segment_report,
}
