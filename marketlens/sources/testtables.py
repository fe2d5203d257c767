"""Derives the retail staging tables from the generic order tables.

The order tables have no payments, reviews, translations or delivery dates, so
they are computed row by row with integer arithmetic that any SQL engine repeats.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, types as T

from marketlens.session import list_path

PRICE = "decimal(12,2)"

# Raw category -> label.  Two raw categories stay untranslated on purpose.
TRANSLATION = {
    "ECONOMY": "budget_goods",
    "LARGE": "bulky_goods",
    "MEDIUM": "standard_goods",
    "SMALL": "standard_goods",
}
PAYMENT_TYPES = ("credit_card", "boleto", "voucher", "debit_card", "not_defined")
CALENDAR = ("1995-01-01", "2001-12-31")


_schemas: dict[tuple, T.StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; its schema is read from a footer once and kept while the files stay the same."""
    path = f"{sf_dir}/{name}.parquet"
    state = list_path(spark, path)
    if state not in _schemas:
        _schemas[state] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[state]).parquet(path)


def _located(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nation (city) with a short code of its region (state)."""
    return (
        table(spark, sf_dir, "nation")
        .join(table(spark, sf_dir, "region").withColumnRenamed("r_regionkey", "n_regionkey"), "n_regionkey")
        .selectExpr("n_nationkey AS nationkey", "lpad(string(n_nationkey), 5, '0') AS zip", "n_name AS city",
                    "concat('R', n_regionkey) AS state")
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    people = table(spark, sf_dir, "customer").withColumnRenamed("c_nationkey", "nationkey")
    return people.join(_located(spark, sf_dir), "nationkey").selectExpr(
        "c_custkey AS customer_id",
        "c_name AS customer_unique_id",
        "zip AS customer_zip_code_prefix",
        "city AS customer_city",
        "state AS customer_state",
    )


def geolocation(spark: SparkSession, sf_dir: str) -> DataFrame:
    people = table(spark, sf_dir, "customer").withColumnRenamed("c_nationkey", "nationkey")
    return people.join(_located(spark, sf_dir), "nationkey").selectExpr(
        "zip AS geolocation_zip_code_prefix",
        "double(nationkey) + double(c_custkey % 8) / 8 AS geolocation_lat",
        "double(c_custkey % 16) AS geolocation_lng",
        "city AS geolocation_city",
        "state AS geolocation_state",
    )


def sellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    suppliers = table(spark, sf_dir, "supplier").withColumnRenamed("s_nationkey", "nationkey")
    return suppliers.join(_located(spark, sf_dir), "nationkey").selectExpr(
        "s_suppkey AS seller_id",
        "zip AS seller_zip_code_prefix",
        "city AS seller_city",
        "state AS seller_state",
    )


def category_translation(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = " ".join(f"WHEN '{raw}' THEN '{name}'" for raw, name in TRANSLATION.items())
    return (
        table(spark, sf_dir, "part")
        .selectExpr("p_type AS product_category_name", f"CASE p_type {labels} END AS product_category_name_english")
        .filter("product_category_name_english IS NOT NULL")
        .distinct()
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").selectExpr(
        "p_partkey AS product_id",
        "CASE WHEN p_partkey % 40 <> 0 THEN p_type END AS product_category_name",
        "length(p_name) AS product_name_lenght",
        "length(p_brand) AS product_description_lenght",
        "int(p_partkey % 6) AS product_photos_qty",
        "p_retailprice AS product_weight_g",
        "double(p_size) AS product_length_cm",
        "double(p_size * 2) AS product_height_cm",
        "CASE WHEN p_partkey % 50 <> 0 THEN double(p_size + 1) END AS product_width_cm",
    )


def _after(start: str, days: str = "0", hours: str = "0") -> str:
    return f"({start} + make_dt_interval(int({days}), int({hours})))"


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, day = "o_orderkey", "o_orderdate"
    return table(spark, sf_dir, "orders").selectExpr(
        f"{key} AS order_id",
        "o_custkey AS customer_id",
        "CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'shipped' ELSE 'processing' END AS order_status",
        f"{_after(day, hours=f'{key} % 24')} AS order_purchase_timestamp",
        f"CASE WHEN {key} % 20 <> 0 THEN {_after(day, hours=f'{key} % 24 + {key} % 3 - 1')} END AS order_approved_at",
        f"CASE WHEN o_orderstatus <> 'P' THEN {_after(day, days='2')} END AS order_delivered_carrier_date",
        f"CASE WHEN o_orderstatus = 'F' AND {key} % 50 <> 0"
        f" THEN {_after(day, f'{key} * 7 % 40', f'{key} * 5 % 24')} END AS order_delivered_customer_date",
        f"{_after(day, days='24')} AS order_estimated_delivery_date",
    )


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = f"cast(l_extendedprice AS {PRICE})"
    return table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey AS order_id",
        "l_linenumber AS order_item_id",
        "l_partkey AS product_id",
        "l_suppkey AS seller_id",
        "l_shipdate AS shipping_limit_date",
        f"{price} AS price",
        f"cast({price} * cast(l_tax AS decimal(4,2)) AS {PRICE}) AS freight_value",
    )


def order_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No payment for some orders, two parts (a quarter and the rest) for others."""
    kinds = ", ".join(f"'{t}'" for t in PAYMENT_TYPES)
    return (
        table(spark, sf_dir, "orders")
        .filter("o_orderkey % 97 <> 0")
        .selectExpr("o_orderkey", f"cast(o_totalprice AS {PRICE}) AS total")
        .selectExpr("*", f"cast(total * cast(0.25 AS decimal(3,2)) AS {PRICE}) AS quarter")
        .selectExpr(
            "o_orderkey",
            f"posexplode(CASE WHEN o_orderkey % 4 = 0 THEN array(quarter, cast(total - quarter AS {PRICE}))"
            " ELSE array(total) END) AS (part, payment_value)",
        )
        .selectExpr(
            "o_orderkey AS order_id",
            "part + 1 AS payment_sequential",
            f"array({kinds})[int((o_orderkey + part) % {len(PAYMENT_TYPES)})] AS payment_type",
            "int(o_orderkey % 12) AS payment_installments",
            "payment_value",
        )
    )


def order_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """None for every tenth order, two for some; a review id may serve two orders."""
    created = _after("o_orderdate", days="30 + n")
    return (
        table(spark, sf_dir, "orders")
        .filter("o_orderkey % 10 <> 0")
        .selectExpr(
            "o_orderkey", "o_orderdate", "o_orderpriority",
            "explode(CASE WHEN o_orderkey % 50 = 1 THEN array(0, 1) ELSE array(0) END) AS n",
        )
        .selectExpr(
            "CASE WHEN o_orderkey % 250 = 2 THEN o_orderkey + 1 ELSE o_orderkey END AS review_id",
            "o_orderkey AS order_id",
            "int(1 + (o_orderkey + n * 3) % 5) AS review_score",
            "CASE WHEN o_orderkey % 8 = 0 THEN o_orderpriority END AS review_comment_title",
            "CASE WHEN o_orderkey % 3 = 0 THEN concat('order ', o_orderkey) END AS review_comment_message",
            f"{created} AS review_creation_date",
            f"{_after(created, hours='o_orderkey % 72')} AS review_answer_timestamp",
        )
    )


STAGING_BUILDERS = {
    "customers": customers,
    "orders": orders,
    "order_items": order_items,
    "order_payments": order_payments,
    "order_reviews": order_reviews,
    "products": products,
    "sellers": sellers,
    "geolocation": geolocation,
    "category_translation": category_translation,
}


def staging_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {name: build(spark, sf_dir) for name, build in STAGING_BUILDERS.items()}
