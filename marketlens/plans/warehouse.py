"""Star schema: staging tables to dimensions and facts.

Two ways to get a star, with the same columns and the same KPI plans on top:

* :func:`publish` writes a new version with integer surrogate keys, checks every
  constraint on the written files, then makes it current.  This is the production
  path: the star is joined and deduplicated once, and every KPI reads narrow
  Parquet columns.
* :func:`natural_star` composes the same tables lazily and uses the natural ids as
  keys, for a single ad-hoc question over staging.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from marketlens.functions.dates import date_key, elapsed_days
from marketlens.operators.constraints import enforce, without_counted_columns
from marketlens.operators.dedupe import first_per_key
from marketlens.operators.keys import dense_keys, sparse_keys
from marketlens.operators.write_counts import COPIES, WriteCounts
from marketlens.plans.kpis import STORED_JOINS, stored_joins
from marketlens.schemas import SURROGATE_KEYS
from marketlens.session import STORED, scratch_root
from marketlens.sources.versioned import commit_version, new_version_path, open_current

# The calendar of the date dimension when none is given.
DEFAULT_CALENDAR = ("2016-01-01", "2019-12-31")

TABLES = ("dim_date", "dim_customers", "dim_sellers", "dim_products",
          "fact_orders", "fact_order_items", "fact_payments", "fact_reviews")

#: What a full load counted while it wrote, stored with the version.
LOAD_COUNTS = "load_counts"

# References whose keys are taken from the stored dimension by a join.
_JOINED = {"fact_orders": ("customer_key",), "fact_order_items": ("product_key", "seller_key")}


def dim_date(spark: SparkSession, calendar: tuple[str, str] = DEFAULT_CALENDAR) -> DataFrame:
    first, last = (date.fromisoformat(d) for d in calendar)
    if last < first:
        raise ValueError(f"calendar {calendar} must run forward")
    days = spark.range(1).select(F.explode(F.sequence(F.lit(first), F.lit(last))).alias("date"))
    weekday = F.weekday("date") + 1
    return days.select(
        date_key(F.col("date")).alias("date_key"),
        "date",
        F.year("date").alias("year"),
        F.quarter("date").alias("quarter"),
        F.month("date").alias("month"),
        F.date_format("date", "MMMM").alias("month_name"),
        F.dayofmonth("date").alias("day"),
        weekday.alias("day_of_week"),
        F.date_format("date", "EEEE").alias("day_name"),
        weekday.isin(6, 7).alias("is_weekend"),
    )


def dim_customers(customers: DataFrame, copies: str | None = None) -> DataFrame:
    return first_per_key(
        customers.select("customer_id", "customer_unique_id", "customer_zip_code_prefix",
                         "customer_city", "customer_state"),
        "customer_id",
        copies=copies,
    )


def dim_sellers(sellers: DataFrame, copies: str | None = None) -> DataFrame:
    return first_per_key(
        sellers.select("seller_id", "seller_zip_code_prefix", "seller_city", "seller_state"), "seller_id", copies=copies
    )


def dim_products(products: DataFrame, translation: DataFrame, copies: str | None = None) -> DataFrame:
    """English label where one is known, else the raw category name."""
    labels = translation.select("product_category_name", F.col("product_category_name_english").alias("_label"))
    labelled = products.join(labels, "product_category_name", "left").select(
        "product_id",
        "product_category_name",
        F.coalesce("_label", "product_category_name").alias("product_category_name_english"),
        "product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm",
    )
    return first_per_key(labelled, "product_id", copies=copies)


def _resolve(fact: DataFrame, dim: DataFrame, natural_id: str, key: str) -> DataFrame:
    """Replace a natural id by the dimension's key; rows unknown to the dimension drop out."""
    if key in dim.columns:
        return fact.join(dim.select(natural_id, key), natural_id)
    known = fact.join(dim.select(natural_id), natural_id, "left_semi")
    return known.withColumn(key, F.col(natural_id))


def inside_calendar(moment: Column, calendar: tuple[str, str]) -> Column:
    first, last = calendar
    return (moment >= F.lit(first).cast("timestamp_ntz")) & (
        moment < F.date_add(F.lit(last).cast("date"), 1).cast("timestamp_ntz")
    )


def fact_orders(
    orders: DataFrame,
    customers: DataFrame,
    calendar: tuple[str, str] = DEFAULT_CALENDAR,
    copies: str | None = None,
) -> DataFrame:
    """Orders of known customers inside the calendar, one row per order.

    The calendar has no gaps, so joining it is the same as a range filter on the
    purchase time, which the scan can use to skip row groups.
    """
    bought, delivered, promised = (
        F.col("order_purchase_timestamp"),
        F.col("order_delivered_customer_date"),
        F.col("order_estimated_delivery_date"),
    )
    inside = inside_calendar(bought, calendar)
    known = _resolve(orders.filter(inside & F.col("order_id").isNotNull()), customers, "customer_id", "customer_key")
    # The generated key comes last, so it decides only between otherwise equal rows.
    shaped = known.select(
        "order_id",
        "order_status",
        date_key(bought).alias("purchase_date_key"),
        bought.alias("purchase_timestamp"),
        F.col("order_approved_at").alias("approved_timestamp"),
        F.col("order_delivered_carrier_date").alias("delivered_carrier_timestamp"),
        delivered.alias("delivered_customer_timestamp"),
        promised.alias("estimated_delivery_timestamp"),
        "customer_key",
    )
    kept = first_per_key(shaped, "order_id", copies=copies)
    done, due = F.col("delivered_customer_timestamp"), F.col("estimated_delivery_timestamp")
    return kept.select(
        "order_id", "customer_key", "order_status", "purchase_date_key", "purchase_timestamp",
        "approved_timestamp", "delivered_carrier_timestamp", "delivered_customer_timestamp",
        "estimated_delivery_timestamp",
        elapsed_days(done, due).alias("delivery_delay_days"),
        F.coalesce(done > due, F.lit(False)).alias("is_delayed"),
        *([copies] if copies else []),
    )


def fact_order_items(order_items: DataFrame, products: DataFrame, sellers: DataFrame) -> DataFrame:
    known = _resolve(order_items, products, "product_id", "product_key")
    known = _resolve(known, sellers, "seller_id", "seller_key")
    return known.select("order_id", "order_item_id", "product_key", "seller_key",
                        "shipping_limit_date", "price", "freight_value")


def fact_payments(order_payments: DataFrame) -> DataFrame:
    return order_payments.select("order_id", "payment_sequential", "payment_type",
                                 "payment_installments", "payment_value")


def fact_reviews(order_reviews: DataFrame) -> DataFrame:
    return order_reviews.select(
        "review_id", "order_id", "review_score", "review_comment_title", "review_comment_message",
        F.col("review_creation_date").alias("review_creation_timestamp"),
        "review_answer_timestamp",
    )


def natural_star(
    spark: SparkSession, staging: dict[str, DataFrame], calendar: tuple[str, str] = DEFAULT_CALENDAR
) -> dict[str, DataFrame]:
    """The star as one lazy plan; each natural id doubles as the key.

    Facts are matched against the staging tables, not the deduplicated dimensions:
    both sides then meet in a plain shuffle, which AQE can split on a hot id.
    """
    return {
        "dim_date": dim_date(spark, calendar),
        "dim_customers": dim_customers(staging["customers"]).withColumn("customer_key", F.col("customer_id")),
        "dim_sellers": dim_sellers(staging["sellers"]).withColumn("seller_key", F.col("seller_id")),
        "dim_products": dim_products(staging["products"], staging["category_translation"]).withColumn(
            "product_key", F.col("product_id")
        ),
        "fact_orders": fact_orders(staging["orders"], staging["customers"], calendar),
        "fact_order_items": fact_order_items(staging["order_items"], staging["products"], staging["sellers"]),
        "fact_payments": fact_payments(staging["order_payments"]),
        "fact_reviews": fact_reviews(staging["order_reviews"]),
    }


def publish(
    spark: SparkSession,
    staging: dict[str, DataFrame],
    root: str,
    calendar: tuple[str, str] = DEFAULT_CALENDAR,
    also: Callable[[dict[str, DataFrame]], dict[str, DataFrame]] | None = None,
    joins: Sequence[str] = STORED_JOINS,
) -> dict[str, DataFrame]:
    """Full refresh of all eight tables and the joins stored with them, or of none: dimensions, facts, checks, joins, commit.

    ``joins`` names the joins to store; views over another one calculate it themselves.  ``also`` gives further tables of the version from the stored star.  Rows, merged copies and column rules are
    counted by the writes themselves and stored as ``load_counts``.
    """
    counts = WriteCounts()
    version, path = new_version_path(root)
    scratch_root(spark)  # settled before the writers below start

    def store(name: str, df: DataFrame) -> DataFrame:
        df.write.options(**STORED).parquet(f"{path}/{name}")
        return spark.read.schema(df.schema).parquet(f"{path}/{name}")

    def dimension(name: str, df: DataFrame) -> DataFrame:
        return store(name, counts.rows(name, dense_keys(counts.copies(name, df), SURROGATE_KEYS[name])))

    def fact(name: str, df: DataFrame) -> DataFrame:
        once = counts.copies(name, df) if COPIES in df.columns else df
        return store(name, counts.rows(name, sparse_keys(once, SURROGATE_KEYS[name])))

    star: dict[str, DataFrame] = {}
    # Tables of one level do not depend on each other, so their jobs share the cluster.
    with ThreadPoolExecutor(max_workers=6) as pool:
        level = {
            "dim_date": pool.submit(store, "dim_date", counts.rows("dim_date", dim_date(spark, calendar))),
            "dim_customers": pool.submit(dimension, "dim_customers", dim_customers(staging["customers"], COPIES)),
            "dim_sellers": pool.submit(dimension, "dim_sellers", dim_sellers(staging["sellers"], COPIES)),
            "dim_products": pool.submit(
                dimension, "dim_products", dim_products(staging["products"], staging["category_translation"], COPIES)
            ),
            "fact_payments": pool.submit(fact, "fact_payments", fact_payments(staging["order_payments"])),
            "fact_reviews": pool.submit(fact, "fact_reviews", fact_reviews(staging["order_reviews"])),
        }
        star.update({name: job.result() for name, job in level.items()})
        level = {
            "fact_orders": pool.submit(
                fact, "fact_orders", fact_orders(staging["orders"], star["dim_customers"], calendar, COPIES)
            ),
            "fact_order_items": pool.submit(
                fact,
                "fact_order_items",
                fact_order_items(staging["order_items"], star["dim_products"], star["dim_sellers"]),
            ),
        }
        star.update({name: job.result() for name, job in level.items()})

    star = {name: star[name] for name in TABLES}
    enforce(star, without_counted_columns(counts.tables(), _JOINED), counts.violations())
    # The joins by order that the views share, written once per version.
    stored = {name: table for name, table in stored_joins(star).items() if name in joins}
    more = {LOAD_COUNTS: counts.frame(spark), **stored, **(also(star) if also else {})}
    with ThreadPoolExecutor(max_workers=6) as pool:
        level = {name: pool.submit(store, name, table) for name, table in more.items()}
        star.update({name: job.result() for name, job in level.items()})
    commit_version(spark, root, version, star)
    return star


def open_star(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    return open_current(spark, root)
