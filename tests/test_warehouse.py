from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from marketlens import registry
from marketlens.operators.accounting import load_accounting
from marketlens.operators.constraints import ConstraintViolation, constraint_report
from marketlens.plans import forecast, kpis, warehouse
from marketlens.schemas import SURROGATE_KEYS
from marketlens.sources import catalog
from marketlens.sources.versioned import current_version
from tests.conftest import item, order


@pytest.fixture(scope="module")
def star(spark, shop):
    return warehouse.natural_star(spark, shop)


@pytest.fixture(scope="module")
def published(spark, shop, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("warehouse"))
    warehouse.publish(spark, shop, root)
    return root


def test_calendar(spark):
    days = warehouse.dim_date(spark)
    assert days.count() == 1461
    row = days.filter("date_key = 20160229").first()
    assert (row.year, row.quarter, row.month, row.month_name, row.day) == (2016, 1, 2, "February", 29)
    assert (row.day_of_week, row.day_name, row.is_weekend) == (1, "Monday", False)
    assert days.filter("is_weekend").select("day_name").distinct().count() == 2


def test_calendar_runs_forward_and_has_no_limit(spark):
    with pytest.raises(ValueError):
        warehouse.dim_date(spark, ("2019-01-01", "2018-01-01"))
    assert warehouse.dim_date(spark, ("1800-01-01", "2199-12-31")).count() == 146_097


def test_dimensions(star):
    customers = {r.customer_id: r.customer_city for r in star["dim_customers"].collect()}
    assert customers == {"c1": "sao paulo", "c2": "sao paulo", "c3": "niteroi", "c4": "rio"}
    products = {r.product_id: (r.product_category_name, r.product_category_name_english) for r in star["dim_products"].collect()}
    assert products == {"p1": ("beleza", "health"), "p2": ("saude", "health"), "p3": ("exotico", "exotico"), "p4": (None, None)}


def test_orders_and_delays(star):
    got = {r.order_id: (r.delivery_delay_days, r.is_delayed) for r in star["fact_orders"].collect()}
    # 12.5 days early, 6 h early, 6 h late (0 days, yet delayed), on time, not delivered
    assert got == {"o1": (-12, False), "o2": (0, False), "o3": (0, True), "o4": (0, False), "o5": (None, False)}


def test_items_of_unknown_products_and_sellers_drop_out(star):
    assert star["fact_order_items"].count() == 5


def test_accounting(spark, shop, star):
    rows = {r.step: r for r in load_accounting(shop, star).collect()}
    orders = rows["fact_orders"]
    assert (orders.rows_read, orders.null_key, orders.outside_calendar, orders.unknown_reference, orders.duplicate_key,
            orders.rows_loaded) == (9, 0, 2, 1, 1, 5)
    assert (rows["fact_order_items"].unknown_reference, rows["fact_order_items"].rows_loaded) == (2, 5)
    assert (rows["dim_customers"].null_key, rows["dim_customers"].duplicate_key, rows["dim_customers"].rows_loaded) == (1, 2, 4)
    assert rows["fact_payments"].rows_read == rows["fact_payments"].rows_loaded == 5
    assert {r.unexplained for r in rows.values()} == {0}


def test_accounting_by_the_counts_of_the_writes(spark, shop, star, published):
    stored = warehouse.open_star(spark, published)
    assert warehouse.LOAD_COUNTS in stored
    assert sorted(load_accounting(shop, stored).collect()) == sorted(load_accounting(shop, star).collect())
    counted = {r.step: (r.rows_loaded, r.duplicate_key) for r in stored[warehouse.LOAD_COUNTS].collect()}
    assert {t: n for t, (n, _) in counted.items()} == {t: stored[t].count() for t in warehouse.TABLES}
    assert {t for t, (_, copies) in counted.items() if copies} == {"dim_customers", "fact_orders"}


def test_a_lost_row_is_unexplained_and_no_duplicate(spark, shop, star):
    lossy = dict(star, fact_orders=star["fact_orders"].filter("order_id <> 'o2'"),
                 fact_payments=star["fact_payments"].unionByName(star["fact_payments"].limit(1)))
    rows = {r.step: r for r in load_accounting(shop, lossy).collect()}
    assert (rows["fact_orders"].duplicate_key, rows["fact_orders"].unexplained) == (1, 1)
    assert rows["fact_payments"].unexplained == -1
    stored = dict(lossy, **{warehouse.LOAD_COUNTS: spark.createDataFrame([("fact_orders", 4, 1)], "step string, rows_loaded long, duplicate_key long")})
    assert [(r.step, r.unexplained) for r in load_accounting(shop, stored).collect()] == [("fact_orders", 1)]


def test_accounting_reads_little(shop, spark, published):
    """Loaded tables are not read again, but for the ids of the three dimensions."""
    plan = load_accounting(shop, warehouse.open_star(spark, published))._jdf.queryExecution().optimizedPlan().toString()
    assert "purchase_date_key" not in plan and "payment_key" not in plan and "review_key" not in plan


def test_publish_of_empty_tables_counts_nothing(spark, make_staging, tmp_path):
    warehouse.publish(spark, make_staging(), str(tmp_path))
    counted = warehouse.open_star(spark, str(tmp_path))[warehouse.LOAD_COUNTS].collect()
    assert {r.step: (r.rows_loaded, r.duplicate_key) for r in counted if r.step != "dim_date"} == {
        t: (0, 0) for t in warehouse.TABLES if t != "dim_date"}


def test_first_load_of_an_increment_chain_drops_its_counts(spark, shop, tmp_path):
    from marketlens.plans.increments import publish_increment

    warehouse.publish(spark, shop, str(tmp_path))
    publish_increment(spark, str(tmp_path), shop, shop["category_translation"])
    assert warehouse.LOAD_COUNTS not in warehouse.open_star(spark, str(tmp_path))


def test_published_star_gives_the_same_views(spark, star, published):
    stored = warehouse.open_star(spark, published)
    for name, view in kpis.VIEWS.items():
        assert sorted(map(str, view(stored).collect())) == sorted(map(str, view(star).collect())), name


def test_lines_that_are_not_stored_are_calculated_by_the_views(spark, shop, star, tmp_path):
    warehouse.publish(spark, shop, str(tmp_path), joins=[kpis.ORDER_REVENUE])
    stored = warehouse.open_star(spark, str(tmp_path))
    assert kpis.ORDER_REVENUE in stored and not set(kpis.ORDER_LINES.values()) & set(stored)
    for view in (kpis.seller_performance, kpis.category_profitability):
        assert sorted(map(str, view(stored).collect())) == sorted(map(str, view(star).collect()))


def test_queries_store_the_lines_that_they_need(spark):
    other, folder = spark.newSession(), "/root/testdata/sf0.001"
    assert not set(kpis.ORDER_LINES.values()) & set(registry.star(other, folder))
    registry.QUERIES["seller_performance"](other, folder)
    assert set(kpis.ORDER_LINES.values()) & set(registry.star(other, folder)) == {"order_sellers"}


def test_split_starts_from_weeks_that_are_stored(spark):
    files = registry.QUERIES["train_test_split"](spark, "/root/testdata/sf0.001").inputFiles()
    assert files and all("aligned-revenue" in f for f in files)


def test_published_keys_and_constraints(spark, published):
    stored = warehouse.open_star(spark, published)
    for table, key in SURROGATE_KEYS.items():
        keys = [r[0] for r in stored[table].select(key).collect()]
        assert len(set(keys)) == len(keys)
        if table.startswith("dim_"):
            assert sorted(keys) == list(range(1, len(keys) + 1))
    assert constraint_report(stored).filter("violations > 0").count() == 0


def test_failed_publish_keeps_the_old_version(spark, make_staging, shop, published):
    before = current_version(spark, published)
    bad = dict(shop, order_items=make_staging(order_items=[item("o1", 1, "p1", "s1", None), item(None, 1, "p1", "s1", "1.00")])["order_items"])
    with pytest.raises(ConstraintViolation) as error:
        warehouse.publish(spark, bad, published)
    assert "fact_order_items.price not_null: 1 rows" in str(error.value)
    assert "fact_order_items.order_id not_null: 1 rows" in str(error.value)
    assert current_version(spark, published) == before


def test_republish_replaces_everything(spark, make_staging, shop, tmp_path):
    root = str(tmp_path)
    warehouse.publish(spark, shop, root)
    warehouse.publish(spark, dict(shop, orders=make_staging(orders=[order("o1", "c1", "2018-01-10T08:00:00")])["orders"]), root)
    assert warehouse.open_star(spark, root)["fact_orders"].count() == 1


def test_too_long_values_and_orphans_are_reported(spark, published):
    stored = warehouse.open_star(spark, published)
    broken = dict(
        stored,
        dim_sellers=stored["dim_sellers"].withColumn("seller_state", F.lit("ABCDEFGHIJK")),
        fact_orders=stored["fact_orders"].withColumn("customer_key", F.lit(99)),
    )
    found = {(r.table_name, r.constraint_kind, r.column_name): r.violations for r in constraint_report(broken).filter("violations > 0").collect()}
    assert found == {
        ("dim_sellers", "length<=10", "seller_state"): 2,
        ("fact_orders", "references dim_customers", "customer_key"): 5,
    }


def test_open_without_commit(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        warehouse.open_star(spark, str(tmp_path / "none"))


def test_catalog(spark, published):
    stored = warehouse.open_star(spark, published)
    catalog.create_namespaces(spark)
    catalog.create_namespaces(spark)
    catalog.register_version(spark, "warehouse", published)
    catalog.register_version(spark, "warehouse", published)
    assert catalog.table_names(spark, "warehouse") == sorted(stored)
    assert catalog.table_exists(spark, "warehouse", "fact_orders")
    assert not catalog.table_exists(spark, "warehouse", "fact_geolocation")
    assert catalog.table_names(spark, "absent") == []
    assert "order_key" in catalog.column_names(spark, "warehouse", "fact_orders")
    assert catalog.schema_tables(spark, "warehouse")["fact_orders"].count() == 5
    views = catalog.register_views(stored)
    assert len(views) == 7
    assert spark.sql("SELECT total_orders FROM v_kpi_overview").first()[0] == 5


def test_catalog_keeps_all_partitions(spark, tmp_path):
    folder = str(tmp_path / "parts")
    spark.range(10).selectExpr("id", "id % 3 AS part").write.partitionBy("part").parquet(folder)
    catalog.create_namespaces(spark)
    catalog.register_tables(spark, "staging", {"parts": folder})
    assert spark.table("staging.parts").count() == 10
    assert spark.sql("SELECT count(*) FROM staging.parts WHERE part = 1").first()[0] == 3


def test_versions_are_ordered_by_number_and_expire(spark, tmp_path, monkeypatch):
    from marketlens.sources import versioned

    root, made = str(tmp_path), []
    for clock in (300, 200, 100):  # a clock that runs backwards
        monkeypatch.setattr(versioned.time, "time_ns", lambda clock=clock: clock)
        version, path = versioned.new_version_path(root)
        spark.range(clock).write.parquet(f"{path}/t")
        versioned.commit_version(spark, root, version, {"t": spark.range(1)})
        made.append(version)
    spark.range(1).write.parquet(f"{root}/versions/abandoned/t")
    assert current_version(spark, root)[0] == made[-1]
    assert sorted(versioned.expire_versions(spark, root, keep=1)) == sorted([*made[:2], "abandoned"])
    assert versioned.open_current(spark, root)["t"].count() == 100


# --- KPI views on the same shop ----------------------------------------------


def _by(frame, key):
    return {r[key]: r.asDict() for r in frame.collect()}


def test_overview(star):
    row = kpis.kpi_overview(star).first()
    assert row.total_revenue == Decimal("155.00")
    assert (row.total_orders, row.unique_customers_registered) == (5, 3)
    assert row.average_order_value == Decimal("31.00")
    assert row.repeat_purchase_rate == Decimal("66.67")  # ann and bob of three persons
    assert row.average_delivery_delay_days == Decimal("-3.00")
    assert row.delay_orders_percentage == Decimal("25.00")


def test_overview_of_completed_orders_only(star):
    assert kpis.kpi_overview(star, statuses=["delivered"]).first().repeat_purchase_rate == Decimal("100.00")


def test_overview_on_empty_tables(spark, make_staging):
    row = kpis.kpi_overview(warehouse.natural_star(spark, make_staging())).first()
    assert row.asDict() == {
        "total_revenue": None, "total_orders": 0, "average_order_value": None, "unique_customers_registered": 0,
        "repeat_purchase_rate": None, "average_delivery_delay_days": None, "delay_orders_percentage": None,
    }


def test_geography_keeps_places_without_payment(star):
    rows = _by(kpis.geographic_performance(star), "customer_city")
    assert (rows["sao paulo"]["total_orders"], rows["sao paulo"]["total_revenue"]) == (2, Decimal("60.00"))
    assert (rows["rio"]["total_orders"], rows["rio"]["total_revenue"], rows["rio"]["average_order_value"]) == (1, 0, 0)


def test_sellers_repeat_items_per_review(star):
    row = _by(kpis.seller_performance(star), "seller_id")["s1"]
    # o1 has two items and two reviews (5 and 2), o2 one item and no review
    assert (row["total_orders"], row["total_item_revenue"]) == (2, Decimal("90.00"))
    assert row["average_review_score"] == Decimal("3.50")
    assert row["average_delivery_delay_days"] == Decimal("-9.60")  # 4 * -12 and 1 * 0
    single = _by(kpis.seller_performance(star, dedupe_reviews=True), "seller_id")["s1"]
    assert (single["total_item_revenue"], single["average_delivery_delay_days"]) == (Decimal("60.00"), Decimal("-8.00"))


def test_categories_repeat_labels_and_items(star):
    rows = sorted((r.product_category, r.total_orders, r.items_sold, r.total_revenue) for r in kpis.category_profitability(star).collect())
    assert rows == [
        ("exotico", 1, 1, Decimal("30.00")),
        ("health", 1, 2, Decimal("40.00")),
        ("health", 2, 3, Decimal("20.05")),
        ("unknown", 1, 1, Decimal("40.00")),
    ]


def test_payment_shares(star):
    rows = _by(kpis.payment_distribution(star), "payment_type")
    assert (rows["boleto"]["total_orders"], rows["boleto"]["transactions_count"]) == (4, 4)
    assert rows["voucher"]["value_percentage"] == Decimal("14.52")


def test_months(star):
    rows = [(r.year, r.month, r.month_name, r.total_orders, r.total_revenue) for r in kpis.monthly_sales_trend(star).collect()]
    assert rows == [
        (2018, 1, "January", 2, Decimal("60.00")),
        (2018, 3, "March", 2, Decimal("90.00")),
        (2018, 5, "May", 1, None),
    ]


def test_rfm(star):
    rows = _by(kpis.customer_rfm(star), "customer_unique_id")
    assert (rows["ann"]["recency_days"], rows["ann"]["frequency"], rows["ann"]["monetary_value"]) == (93, 2, Decimal("60.00"))
    assert (rows["cyd"]["recency_days"], rows["cyd"]["frequency"], rows["cyd"]["monetary_value"]) == (0, 1, 0)
    assert _by(kpis.customer_lifetime_value(star), "customer_unique_id")["bob"]["lifetime_value"] == Decimal("90.00")


def test_daily_revenue_is_null_without_payment(star):
    days = {r.purchase_date: r.revenue for r in kpis.daily_revenue(star).collect()}
    assert days[dt.date(2018, 5, 5)] is None and days[dt.date(2018, 1, 10)] == Decimal("30.00")


def test_service_figures(star):
    assert kpis.on_time_rate(star).first().on_time_percentage == Decimal("75.00")
    assert kpis.satisfaction(star).first().average_review_score == Decimal("3.00")
    assert kpis.delivery_time(star).first().delivered_orders == 4


def test_figures_agree_with_each_other(star):
    shares = sum(r.value_percentage for r in kpis.payment_distribution(star).collect())
    assert abs(shares - 100) < Decimal("0.05")
    monthly = kpis.monthly_sales_trend(star).agg(F.sum("total_orders")).first()[0]
    assert monthly == kpis.kpi_overview(star).first().total_orders
    spend = kpis.customer_rfm(star).agg(F.sum("monetary_value")).first()[0]
    assert spend == kpis.monthly_sales_trend(star).agg(F.sum("total_revenue")).first()[0]


def _exchanges_by_order(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return sum("hashpartitioning(order_id" in line for line in plan.splitlines())


def test_views_over_lines_shuffle_nothing_by_order(spark, star, published):
    """With broadcasts off, as at scale: the joins by order were made when the version was written."""
    stored = warehouse.open_star(spark, published)
    views = {
        "sellers": kpis.seller_performance,
        "sellers, reviews once": lambda s: kpis.seller_performance(s, dedupe_reviews=True),
        "categories": kpis.category_profitability,
        "categories, reviews once": lambda s: kpis.category_profitability(s, dedupe_reviews=True),
        "weeks by seller": lambda s: forecast.weekly_series(forecast.daily_series(s, "seller")),
        "weeks by category": lambda s: forecast.weekly_series(forecast.daily_series(s, "category")),
    }
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name, view in views.items():
            assert _exchanges_by_order(view(stored)) == 0 < _exchanges_by_order(view(star)), name
            assert sorted(map(str, view(stored).collect())) == sorted(map(str, view(star).collect())), name
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_lines_of_unknown_orders_count_for_categories_only(spark, make_staging, tmp_path):
    rows = make_staging(
        customers=[("c1", "ann", "1", "a", "A")], sellers=[("s1", "1", "a", "A")],
        products=[("p1", "x", 1, 1, 1, 1.0, 1.0, 1.0, 1.0)],
        orders=[order("o1", "c1", "2018-01-10T08:00:00")],
        order_items=[item("o1", 1, "p1", "s1", "1.00"), item("gone", 1, "p1", "s1", "2.00")])
    stored = warehouse.publish(spark, rows, str(tmp_path))
    assert [float(r.total_item_revenue) for r in kpis.seller_performance(stored).collect()] == [1.0]
    assert [float(r.total_revenue) for r in kpis.category_profitability(stored).collect()] == [3.0]
    assert forecast.daily_series(stored, "category").count() == 1
    with pytest.raises(ValueError):
        forecast.daily_series(stored, "colour")


def test_registered_tables_store_no_joins(spark, shop, monkeypatch):
    stars, publish = [], warehouse.publish
    monkeypatch.setattr(registry, "staging", lambda *_: shop)
    monkeypatch.setattr(warehouse, "publish", lambda *a, **k: stars.append(publish(*a, **k)) or stars[-1])
    rows = registry.q_registered_tables(spark, "").collect()
    assert sorted(r.table_name for r in rows) == sorted(warehouse.TABLES) and len(stars) == 2
    assert not set(kpis.STORED_JOINS) & set(stars[-1])
