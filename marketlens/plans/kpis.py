"""KPI views over the star schema.

Shape shared by all of them: payments, reviews and items are reduced per order (or
order and dimension) *before* they are joined.  Each side of a join then has one
row per key, so a hot order, customer or seller is combined on the map side and no
join ever multiplies rows.  Where the published definition counts the product of
items and reviews of an order, that product is computed, not materialized.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from marketlens.functions.dates import elapsed_days
from marketlens.functions.numeric import as_money, exact_ratio, percent, total_cents, wide_product
from marketlens.session import materialize

Star = dict[str, DataFrame]
#: Stores a table under a label and gives the stored copy.
Copy = Callable[[DataFrame, str], DataFrame]


# Columns the views combine with revenue, and the name the stored join has in a star.
_REVENUE_COLUMNS = ("order_status", "customer_key", "purchase_timestamp", "purchase_date_key")
ORDER_REVENUE = "order_revenue"
# The stored lines of each order per seller and per category, by what they are grouped by.
ORDER_LINES = {"seller": "order_sellers", "category": "order_categories"}
STORED_JOINS = (ORDER_REVENUE, *ORDER_LINES.values())
CATEGORY = ("product_category_name_english", "product_category_name")


def orders_with_cents(star: Star, *columns: str) -> DataFrame:
    """One row per order with its payments in cents; NULL for an order without payments."""
    if ORDER_REVENUE in star:
        return star[ORDER_REVENUE].select("order_id", *columns, "cents")
    paid = star["fact_payments"].groupBy("order_id").agg(total_cents("payment_value").alias("cents"))
    return star["fact_orders"].select("order_id", *columns).join(paid, "order_id", "left")


def orders_with_revenue(star: Star, *columns: str) -> DataFrame:
    return orders_with_cents(star, *columns).select(
        "order_id", *columns, as_money(F.col("cents")).alias("order_revenue")
    )


def with_order_revenue(star: Star) -> Star:
    """Join orders and payments once and store the narrow result.

    The places, months, days, customers and state series all start from that join;
    with it stored none of them shuffles orders or payments by order again.
    A published star has it already.
    """
    if ORDER_REVENUE in star:
        return star
    return {**star, ORDER_REVENUE: materialize(orders_with_cents(star, *_REVENUE_COLUMNS), "order-revenue")}


def reviews_per_order(star: Star, dedupe_reviews: bool = False) -> DataFrame:
    """Review count and score totals of an order.

    ``review_rows`` is how often a join with the reviews repeats an order.  With
    ``dedupe_reviews`` an order counts once, with its mean score.
    """
    per_order = star["fact_reviews"].groupBy("order_id").agg(
        F.count(F.lit(1)).alias("review_rows"),
        F.sum("review_score").alias("score_sum"),
        F.count("review_score").alias("score_count"),
    )
    return once_per_order(per_order) if dedupe_reviews else per_order


def once_per_order(df: DataFrame) -> DataFrame:
    """Review totals as if each order had one review, with its mean score."""
    return df.withColumns({
        "review_rows": F.when(F.col("review_rows").isNotNull(), F.lit(1).cast("long")),
        "score_sum": F.col("score_sum").cast("decimal(38,10)") / F.nullif("score_count", F.lit(0)),
        "score_count": F.when(F.col("review_rows").isNotNull(), F.when(F.col("score_count") > 0, 1).otherwise(0).cast("long")),
    })


def kpi_overview(star: Star, statuses: Sequence[str] | None = None) -> DataFrame:
    """One row of headline figures.

    ``statuses`` limits which orders make a repeat customer; by default all do.
    """
    revenue = star["fact_payments"].agg(as_money(total_cents("payment_value")))
    people = star["dim_customers"].agg(F.countDistinct("customer_unique_id"))
    measured = (F.col("order_status") == "delivered") & F.col("delivery_delay_days").isNotNull()
    totals = star["fact_orders"].agg(
        F.count("order_id").alias("total_orders"),
        F.count_if(measured).alias("_measured"),
        F.sum(F.when(measured, F.col("delivery_delay_days"))).alias("_delay"),
        F.count_if(measured & F.col("is_delayed")).alias("_late"),
    )
    persons = orders_per_person(star, statuses)
    repeat = persons.agg(percent(F.count_if(F.col("order_count") > 1), F.count(F.lit(1))))
    return totals.select(revenue.scalar().alias("total_revenue"), "*").select(
        "total_revenue",
        "total_orders",
        exact_ratio(F.col("total_revenue"), F.col("total_orders")).alias("average_order_value"),
        people.scalar().alias("unique_customers_registered"),
        repeat.scalar().alias("repeat_purchase_rate"),
        exact_ratio(F.col("_delay"), F.col("_measured")).alias("average_delivery_delay_days"),
        percent(F.col("_late"), F.col("_measured")).alias("delay_orders_percentage"),
    )


def orders_per_person(star: Star, statuses: Sequence[str] | None = None) -> DataFrame:
    orders = star["fact_orders"]
    if statuses is not None:
        orders = orders.filter(F.col("order_status").isin(*statuses))
    per_record = orders.groupBy("customer_key").agg(F.count("order_id").alias("_orders"))
    return (
        per_record.join(star["dim_customers"].select("customer_key", "customer_unique_id"), "customer_key")
        .groupBy("customer_unique_id")
        .agg(F.sum("_orders").alias("order_count"))
    )


def _per_customer_record(star: Star) -> DataFrame:
    return orders_with_cents(star, "customer_key", "purchase_timestamp").groupBy("customer_key").agg(
        F.count("order_id").alias("_orders"),
        F.sum("cents").alias("_cents"),
        F.max("purchase_timestamp").alias("_last"),
    )


def geographic_performance(star: Star) -> DataFrame:
    places = star["dim_customers"].select("customer_key", "customer_state", "customer_city")
    return (
        _per_customer_record(star)
        .join(places, "customer_key")
        .groupBy("customer_state", "customer_city")
        .agg(
            F.sum("_orders").alias("total_orders"),
            as_money(F.coalesce(F.sum("_cents"), F.lit(0))).alias("total_revenue"),
        )
        .withColumn("average_order_value", exact_ratio(F.col("total_revenue"), F.col("total_orders")))
    )


def order_lines(star: Star, by: str, copy: Copy | None = None) -> DataFrame:
    """One row per order and seller, or per order and category, with all that lines are combined with.

    ``items`` and ``cents`` of the lines; ``purchase_date`` and ``delivery_delay_days`` of the order, ``in_orders`` being
    false where the order itself is missing; ``review_rows``, ``score_sum`` and ``score_count`` of its reviews.  A published
    star holds these rows, so the views over them shuffle nothing by order.  With ``copy`` the grouped lines are stored
    before they are joined, so that their shuffle files need not last until the joins end.
    """
    if ORDER_LINES[by] in star:
        return star[ORDER_LINES[by]]
    keys, lines = ["seller_key"], star["fact_order_items"]
    if by == "category":
        # Not grouped before: an order seldom has a product twice, so that would shuffle all lines for nothing.
        keys, lines = list(CATEGORY), lines.join(star["dim_products"].select("product_key", *CATEGORY), "product_key")
    lines = lines.groupBy("order_id", *keys).agg(F.count(F.lit(1)).alias("items"), total_cents("price").alias("cents"))
    if copy:
        lines = copy(lines, f"lines-{by}")
    orders = star["fact_orders"].select(
        "order_id", F.to_date("purchase_timestamp").alias("purchase_date"), "delivery_delay_days", F.lit(True).alias("in_orders")
    )
    return (
        lines.join(orders, "order_id", "left")
        .join(reviews_per_order(star), "order_id", "left")
        .select("order_id", *keys, "items", "cents", "purchase_date", "delivery_delay_days",
                F.coalesce("in_orders", F.lit(False)).alias("in_orders"), "review_rows", "score_sum", "score_count")
    )


def stored_join(star: Star, name: str, copy: Copy | None = None) -> DataFrame:
    """A join by order that the views start from, by the name it has in a published star."""
    if name == ORDER_REVENUE:
        return orders_with_cents(star, *_REVENUE_COLUMNS)
    return order_lines(star, next(by for by, stored in ORDER_LINES.items() if stored == name), copy)


def stored_joins(star: Star) -> Star:
    return {name: stored_join(star, name) for name in STORED_JOINS}


def _lines_with_reviews(star: Star, by: str, dedupe_reviews: bool) -> DataFrame:
    lines = order_lines(star, by)
    return once_per_order(lines) if dedupe_reviews else lines


def _repeated(value: str) -> Column:
    """``value`` as often as the reviews of its order repeat it; once when there are none."""
    return wide_product(F.col(value), F.coalesce("review_rows", F.lit(1)))


def _scores(value: str) -> Column:
    """A review total of the order, once for each of its items."""
    return F.col("items").cast("decimal(19,0)") * F.col(value)


def seller_performance(star: Star, dedupe_reviews: bool = False) -> DataFrame:
    delay = F.col("delivery_delay_days")
    per_seller = (
        _lines_with_reviews(star, "seller", dedupe_reviews)
        .filter("in_orders")
        .groupBy("seller_key")
        .agg(
            F.count(F.lit(1)).alias("total_orders"),
            as_money(F.sum(_repeated("cents"))).alias("total_item_revenue"),
            F.sum(_scores("score_sum")).alias("_score"),
            F.sum(_scores("score_count")).alias("_scored"),
            F.sum(_repeated("items") * delay).alias("_delay"),
            F.sum(F.when(delay.isNotNull(), _repeated("items"))).alias("_delayed"),
        )
    )
    sellers = star["dim_sellers"].select("seller_key", "seller_id", "seller_city", "seller_state")
    return per_seller.join(sellers, "seller_key").select(
        "seller_id",
        "seller_city",
        "seller_state",
        "total_orders",
        "total_item_revenue",
        exact_ratio(F.col("_score"), F.col("_scored")).alias("average_review_score"),
        exact_ratio(F.col("_delay"), F.col("_delayed")).alias("average_delivery_delay_days"),
    )


def category_profitability(star: Star, dedupe_reviews: bool = False) -> DataFrame:
    """Per (label, raw name) pair, so one label may appear more than once."""
    return (
        _lines_with_reviews(star, "category", dedupe_reviews)
        .groupBy(*CATEGORY)
        .agg(
            F.count("order_id").alias("total_orders"),
            F.sum(_repeated("items")).cast("long").alias("items_sold"),
            as_money(F.sum(_repeated("cents"))).alias("total_revenue"),
            F.sum(_scores("score_sum")).alias("_score"),
            F.sum(_scores("score_count")).alias("_scored"),
        )
        .select(
            F.coalesce(*CATEGORY, F.lit("unknown")).alias("product_category"),
            "total_orders",
            "items_sold",
            "total_revenue",
            exact_ratio(F.col("total_revenue"), F.col("items_sold")).alias("average_item_price"),
            exact_ratio(F.col("_score"), F.col("_scored")).alias("average_review_score"),
        )
    )


def payment_distribution(star: Star) -> DataFrame:
    """Distinct orders per type come from (type, order) groups, not from a distinct list."""
    payments = star["fact_payments"]
    total = payments.agg(total_cents("payment_value"))
    return (
        payments.groupBy("payment_type", "order_id")
        .agg(F.count(F.lit(1)).alias("_rows"), total_cents("payment_value").alias("_cents"))
        .groupBy("payment_type")
        .agg(
            F.count("order_id").alias("total_orders"),
            F.sum("_rows").alias("transactions_count"),
            F.sum("_cents").alias("_cents"),
        )
        .select(
            "payment_type",
            "total_orders",
            "transactions_count",
            as_money(F.col("_cents")).alias("total_payment_value"),
            percent(F.col("_cents"), total.scalar()).alias("value_percentage"),
        )
    )


def daily_totals(star: Star) -> DataFrame:
    """Orders and revenue per calendar day: the base of the daily and monthly series."""
    per_day = (
        orders_with_cents(star, "purchase_date_key")
        .groupBy("purchase_date_key")
        .agg(F.count("order_id").alias("_orders"), F.sum("cents").alias("_cents"))
    )
    return per_day.join(star["dim_date"], F.col("purchase_date_key") == F.col("date_key"))


def monthly_sales_trend(star: Star) -> DataFrame:
    """Revenue stays NULL for a month in which no order was paid."""
    return (
        daily_totals(star)
        .groupBy("year", "month", "month_name")
        .agg(F.sum("_orders").alias("total_orders"), as_money(F.sum("_cents")).alias("total_revenue"))
        .orderBy("year", "month")
    )


def daily_revenue(star: Star) -> DataFrame:
    return daily_totals(star).select(F.col("date").alias("purchase_date"), as_money(F.col("_cents")).alias("revenue")).orderBy(
        "purchase_date"
    )


def customer_rfm(star: Star) -> DataFrame:
    """Recency in days against the last order of all, distinct orders, spend."""
    latest = star["fact_orders"].agg(F.max("purchase_timestamp"))
    return (
        _per_customer_record(star)
        .join(star["dim_customers"].select("customer_key", "customer_unique_id"), "customer_key")
        .groupBy("customer_unique_id")
        .agg(
            F.max("_last").alias("_last"),
            F.sum("_orders").alias("frequency"),
            as_money(F.coalesce(F.sum("_cents"), F.lit(0))).alias("monetary_value"),
        )
        .select(
            "customer_unique_id",
            elapsed_days(latest.scalar(), F.col("_last")).alias("recency_days"),
            "frequency",
            "monetary_value",
        )
    )


def delivery_time(star: Star) -> DataFrame:
    """Average days from purchase to delivery, over delivered orders."""
    done = star["fact_orders"].filter(F.col("delivered_customer_timestamp").isNotNull())
    days = elapsed_days(F.col("delivered_customer_timestamp"), F.col("purchase_timestamp"))
    return done.agg(
        F.count(F.lit(1)).alias("delivered_orders"),
        exact_ratio(F.sum(days), F.count(days)).alias("average_delivery_days"),
    )


def on_time_rate(star: Star) -> DataFrame:
    """The complement of the late share, over the same orders as the overview."""
    measured = star["fact_orders"].filter(
        (F.col("order_status") == "delivered") & F.col("delivery_delay_days").isNotNull()
    )
    return measured.agg(
        F.count(F.lit(1)).alias("measured_orders"),
        percent(F.count_if(~F.col("is_delayed")), F.count(F.lit(1))).alias("on_time_percentage"),
    )


def satisfaction(star: Star) -> DataFrame:
    return star["fact_reviews"].agg(
        F.count("review_score").alias("reviews"),
        exact_ratio(F.sum("review_score"), F.count("review_score")).alias("average_review_score"),
    )


def customer_lifetime_value(star: Star) -> DataFrame:
    return customer_rfm(star).select("customer_unique_id", F.col("monetary_value").alias("lifetime_value"))


VIEWS = {
    "v_kpi_overview": kpi_overview,
    "v_geographic_performance": geographic_performance,
    "v_seller_performance": seller_performance,
    "v_product_category_profitability": category_profitability,
    "v_payment_distribution": payment_distribution,
    "v_monthly_sales_trend": monthly_sales_trend,
    "v_customer_rfm": customer_rfm,
}
