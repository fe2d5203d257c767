"""The same results in plain SQL over the given tables, for an independent engine.

The statements define each result the direct way (joins that repeat rows, distinct
counts, ranking windows), not the way the Spark plans compute it.  Money is summed
in integer cents and ratios are rounded in integer arithmetic.
"""

from __future__ import annotations

from marketlens.sources.testtables import CALENDAR, PAYMENT_TYPES, TRANSLATION

# Fixed values, stated here once more on purpose: a rule that is wrong in the library must not be wrong in its SQL too.

# Raw dataset, staging table, its key, its columns.
DATASETS = (
    ("customers", "customers", "customer_id",
     "customer_id customer_unique_id customer_zip_code_prefix customer_city customer_state"),
    ("orders", "orders", "order_id",
     "order_id customer_id order_status order_purchase_timestamp order_approved_at order_delivered_carrier_date "
     "order_delivered_customer_date order_estimated_delivery_date"),
    ("order_items", "order_items", "order_id, order_item_id",
     "order_id order_item_id product_id seller_id shipping_limit_date price freight_value"),
    ("payments", "order_payments", "order_id, payment_sequential",
     "order_id payment_sequential payment_type payment_installments payment_value"),
    ("reviews", "order_reviews", "review_id",
     "review_id order_id review_score review_comment_title review_comment_message review_creation_date review_answer_timestamp"),
    ("products", "products", "product_id",
     "product_id product_category_name product_name_lenght product_description_lenght product_photos_qty product_weight_g "
     "product_length_cm product_height_cm product_width_cm"),
    ("sellers", "sellers", "seller_id", "seller_id seller_zip_code_prefix seller_city seller_state"),
    ("geolocation", "geolocation", "geolocation_zip_code_prefix, geolocation_lat, geolocation_lng",
     "geolocation_zip_code_prefix geolocation_lat geolocation_lng geolocation_city geolocation_state"),
    ("category_translation", "category_translation", "product_category_name",
     "product_category_name product_category_name_english"),
)

# Rule, table, column, what breaks it.
VALUE_RULES = (
    ("Review score between 1 and 5", "order_reviews", "review_score", "review_score < 1 OR review_score > 5"),
    ("Non-negative item price", "order_items", "price", "price < 0"),
    ("Non-negative freight value", "order_items", "freight_value", "freight_value < 0"),
    ("Non-negative payment value", "order_payments", "payment_value", "payment_value < 0"),
    ("Non-negative payment installments", "order_payments", "payment_installments", "payment_installments < 0"),
    ("Approval timestamp >= purchase timestamp", "orders", "order_approved_at",
     "order_approved_at < order_purchase_timestamp"),
    ("Delivery timestamp >= purchase timestamp", "orders", "order_delivered_customer_date",
     "order_delivered_customer_date < order_purchase_timestamp"),
)

# The quality gate: at most so many percent missing and repeated, at least so many rows.
GATE_MISSING, GATE_REPEATED, GATE_ROWS = 10, 5, 100

# Segment, recency scores from and to, frequency scores from and to.
SEGMENTS = (
    ("Champions", 4, 5, 4, 5), ("Loyal Customers", 3, 5, 3, 5), ("Potential Loyalists", 4, 5, 2, 5), ("New Customers", 5, 5, 1, 1),
    ("Promising", 4, 4, 1, 1), ("Needs Attention", 3, 3, 2, 2), ("About to Sleep", 3, 3, 1, 1), ("Can't Lose Them", 1, 2, 4, 5),
    ("At Risk", 1, 2, 3, 3), ("Hibernating", 2, 2, 1, 2),
)
OTHER_SEGMENT = "Lost"

# Raw cells that count as missing.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Warehouse table, its generated key, other columns that may not be NULL, unique natural keys.
WAREHOUSE = (
    ("dim_date", "", "date_key date year quarter month month_name day day_of_week day_name is_weekend", "date_key date"),
    ("dim_customers", "customer_key", "customer_id customer_unique_id", "customer_id"),
    ("dim_sellers", "seller_key", "seller_id", "seller_id"),
    ("dim_products", "product_key", "product_id", "product_id"),
    ("fact_orders", "order_key", "order_id customer_key order_status purchase_date_key purchase_timestamp", "order_id"),
    ("fact_order_items", "order_item_key",
     "order_id order_item_id product_key seller_key shipping_limit_date price freight_value", ""),
    ("fact_payments", "payment_key", "order_id payment_sequential payment_type payment_installments payment_value", ""),
    ("fact_reviews", "review_key",
     "review_id order_id review_score review_creation_timestamp review_answer_timestamp", ""),
)
# The longest text of a column; ids are numbers in the given tables and have no length.
LENGTHS = (
    ("dim_date", "month_name", 20), ("dim_date", "day_name", 20),
    ("dim_customers", "customer_unique_id", 50), ("dim_customers", "customer_zip_code_prefix", 20),
    ("dim_customers", "customer_city", 100), ("dim_customers", "customer_state", 10),
    ("dim_sellers", "seller_zip_code_prefix", 20), ("dim_sellers", "seller_city", 100), ("dim_sellers", "seller_state", 10),
    ("dim_products", "product_category_name", 100), ("dim_products", "product_category_name_english", 100),
    ("fact_orders", "order_status", 50), ("fact_payments", "payment_type", 50),
)
REFERENCES = (
    ("fact_orders", "customer_key", "dim_customers"), ("fact_orders", "purchase_date_key", "dim_date"),
    ("fact_order_items", "product_key", "dim_products"), ("fact_order_items", "seller_key", "dim_sellers"),
)

FIRST_DAY, LAST_DAY = CALENDAR


def ratio(numerator: str, denominator: str, scale: int = 1) -> str:
    """``numerator / scale / denominator`` rounded half away from zero to two digits."""
    n, d = f"CAST({numerator} AS HUGEINT)", f"CAST({denominator} AS HUGEINT)"
    return (
        f"CASE WHEN {d} = 0 THEN NULL ELSE CAST(sign({n}) * "
        f"((abs({n}) * 200 + {scale} * {d}) // (2 * {scale} * {d})) AS DOUBLE) / 100 END"
    )


def percent(part: str, whole: str) -> str:
    return ratio(f"({part}) * 100", whole)


def money(cents: str) -> str:
    return f"CAST({cents} AS DOUBLE) / 100"


STAGING = f"""
customers AS (
  SELECT c_custkey AS customer_id, c_name AS customer_unique_id,
         lpad(CAST(c_nationkey AS VARCHAR), 5, '0') AS customer_zip_code_prefix,
         n_name AS customer_city, 'R' || r_regionkey AS customer_state
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
geolocation AS (
  SELECT lpad(CAST(c_nationkey AS VARCHAR), 5, '0') AS geolocation_zip_code_prefix,
         CAST(c_nationkey AS DOUBLE) + CAST(c_custkey % 8 AS DOUBLE) / 8 AS geolocation_lat,
         CAST(c_custkey % 16 AS DOUBLE) AS geolocation_lng,
         n_name AS geolocation_city, 'R' || r_regionkey AS geolocation_state
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
sellers AS (
  SELECT s_suppkey AS seller_id, lpad(CAST(s_nationkey AS VARCHAR), 5, '0') AS seller_zip_code_prefix,
         n_name AS seller_city, 'R' || r_regionkey AS seller_state
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
category_translation AS (
  SELECT DISTINCT p_type AS product_category_name,
         CASE p_type {" ".join(f"WHEN '{k}' THEN '{v}'" for k, v in TRANSLATION.items())} END
           AS product_category_name_english
  FROM part WHERE p_type IN ({", ".join(f"'{k}'" for k in TRANSLATION)})),
products AS (
  SELECT p_partkey AS product_id,
         CASE WHEN p_partkey % 40 <> 0 THEN p_type END AS product_category_name,
         length(p_name) AS product_name_lenght, length(p_brand) AS product_description_lenght,
         CAST(p_partkey % 6 AS INTEGER) AS product_photos_qty, p_retailprice AS product_weight_g,
         CAST(p_size AS DOUBLE) AS product_length_cm, CAST(p_size * 2 AS DOUBLE) AS product_height_cm,
         CASE WHEN p_partkey % 50 <> 0 THEN CAST(p_size + 1 AS DOUBLE) END AS product_width_cm
  FROM part),
stg_orders AS (
  SELECT o_orderkey AS order_id, o_custkey AS customer_id,
         CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'shipped' ELSE 'processing' END AS order_status,
         o_orderdate + to_hours(o_orderkey % 24) AS order_purchase_timestamp,
         CASE WHEN o_orderkey % 20 <> 0
              THEN o_orderdate + to_hours(o_orderkey % 24 + o_orderkey % 3 - 1) END AS order_approved_at,
         CASE WHEN o_orderstatus <> 'P' THEN o_orderdate + INTERVAL 2 DAY END AS order_delivered_carrier_date,
         CASE WHEN o_orderstatus = 'F' AND o_orderkey % 50 <> 0
              THEN o_orderdate + to_hours((o_orderkey * 7 % 40) * 24 + o_orderkey * 5 % 24) END
           AS order_delivered_customer_date,
         o_orderdate + INTERVAL 24 DAY AS order_estimated_delivery_date
  FROM orders),
order_items AS (
  SELECT l_orderkey AS order_id, l_linenumber AS order_item_id, l_partkey AS product_id, l_suppkey AS seller_id,
         l_shipdate AS shipping_limit_date, CAST(l_extendedprice AS DECIMAL(12,2)) AS price,
         CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_tax AS DECIMAL(4,2)) AS DECIMAL(12,2)) AS freight_value,
         CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * 100 AS BIGINT) AS price_cents
  FROM lineitem),
totals AS (
  SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(12,2)) AS total,
         CAST(CAST(o_totalprice AS DECIMAL(12,2)) * CAST(0.25 AS DECIMAL(3,2)) AS DECIMAL(12,2)) AS quarter
  FROM orders WHERE o_orderkey % 97 <> 0),
parts AS (
  SELECT o_orderkey, 1 AS seq, CASE WHEN o_orderkey % 4 = 0 THEN quarter ELSE total END AS payment FROM totals
  UNION ALL
  SELECT o_orderkey, 2, CAST(total - quarter AS DECIMAL(12,2)) FROM totals WHERE o_orderkey % 4 = 0),
order_payments AS (
  SELECT o_orderkey AS order_id, seq AS payment_sequential,
         CASE (o_orderkey + seq - 1) % 5 {" ".join(f"WHEN {i} THEN '{t}'" for i, t in enumerate(PAYMENT_TYPES))} END
           AS payment_type,
         CAST(o_orderkey % 12 AS INTEGER) AS payment_installments, payment AS payment_value,
         CAST(payment * 100 AS BIGINT) AS payment_cents
  FROM parts),
order_reviews AS (
  SELECT CASE WHEN o_orderkey % 250 = 2 THEN o_orderkey + 1 ELSE o_orderkey END AS review_id,
         o_orderkey AS order_id, CAST(1 + (o_orderkey + n * 3) % 5 AS INTEGER) AS review_score,
         CASE WHEN o_orderkey % 8 = 0 THEN o_orderpriority END AS review_comment_title,
         CASE WHEN o_orderkey % 3 = 0 THEN 'order ' || CAST(o_orderkey AS VARCHAR) END AS review_comment_message,
         o_orderdate + to_days(30 + n) AS review_creation_date,
         o_orderdate + to_days(30 + n) + to_hours(o_orderkey % 72) AS review_answer_timestamp
  FROM orders, (VALUES (0), (1)) AS t(n)
  WHERE o_orderkey % 10 <> 0 AND (n = 0 OR o_orderkey % 50 = 1))
"""

STAR = f"""
dim_date AS (
  SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS date, CAST(year(d) AS INTEGER) AS year,
         CAST(quarter(d) AS INTEGER) AS quarter, CAST(month(d) AS INTEGER) AS month, monthname(d) AS month_name,
         CAST(day(d) AS INTEGER) AS day, CAST(isodow(d) AS INTEGER) AS day_of_week, dayname(d) AS day_name,
         isodow(d) IN (6, 7) AS is_weekend
  FROM (SELECT CAST(unnest(generate_series(DATE '{FIRST_DAY}', DATE '{LAST_DAY}', INTERVAL 1 DAY)) AS DATE) AS d)),
dim_customers AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY customer_unique_id NULLS FIRST,
      customer_zip_code_prefix NULLS FIRST, customer_city NULLS FIRST, customer_state NULLS FIRST) AS rn
    FROM customers WHERE customer_id IS NOT NULL) WHERE rn = 1),
dim_sellers AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY seller_id ORDER BY seller_zip_code_prefix NULLS FIRST,
      seller_city NULLS FIRST, seller_state NULLS FIRST) AS rn
    FROM sellers WHERE seller_id IS NOT NULL) WHERE rn = 1),
dim_products AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT product_id, p.product_category_name,
           coalesce(t.product_category_name_english, p.product_category_name) AS product_category_name_english,
           product_weight_g, product_length_cm, product_height_cm, product_width_cm,
           row_number() OVER (PARTITION BY product_id ORDER BY p.product_category_name NULLS FIRST,
             product_category_name_english NULLS FIRST, product_weight_g NULLS FIRST) AS rn
    FROM products p LEFT JOIN category_translation t ON p.product_category_name = t.product_category_name
    WHERE product_id IS NOT NULL) WHERE rn = 1),
fact_orders AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT o.order_id, o.customer_id, o.order_status, d.date_key AS purchase_date_key,
           order_purchase_timestamp AS purchase_timestamp, order_approved_at AS approved_timestamp,
           order_delivered_carrier_date AS delivered_carrier_timestamp,
           order_delivered_customer_date AS delivered_customer_timestamp,
           order_estimated_delivery_date AS estimated_delivery_timestamp,
           CAST(extract(day FROM (order_delivered_customer_date - order_estimated_delivery_date)) AS INTEGER)
             AS delivery_delay_days,
           coalesce(order_delivered_customer_date > order_estimated_delivery_date, FALSE) AS is_delayed,
           row_number() OVER (PARTITION BY order_id ORDER BY order_status, order_purchase_timestamp) AS rn
    FROM stg_orders o JOIN dim_customers c ON o.customer_id = c.customer_id
    JOIN dim_date d ON d.date = CAST(o.order_purchase_timestamp AS DATE)
    WHERE order_id IS NOT NULL) WHERE rn = 1),
fact_order_items AS (
  SELECT i.* FROM order_items i JOIN dim_products USING (product_id) JOIN dim_sellers USING (seller_id))
"""


def sql(body: str, *extra: str) -> str:
    return "WITH " + ",".join([STAGING, STAR, *extra]) + "\n" + body


TABLE_SOURCES = {
    "customers": "customers", "orders": "stg_orders", "order_items": "order_items",
    "order_payments": "order_payments", "order_reviews": "order_reviews", "products": "products",
    "sellers": "sellers", "geolocation": "geolocation", "category_translation": "category_translation",
}

# --- KPI views ---------------------------------------------------------------


def kpi_overview(repeat_filter: str = "TRUE") -> str:
    return sql(f"""
SELECT {money("revenue")} AS total_revenue, order_count AS total_orders,
       {ratio("revenue", "order_count", 100)} AS average_order_value, people AS unique_customers_registered,
       {percent("repeaters", "buyers")} AS repeat_purchase_rate,
       {ratio("delay", "measured")} AS average_delivery_delay_days,
       {percent("late", "measured")} AS delay_orders_percentage
FROM (SELECT (SELECT sum(payment_cents) FROM order_payments) AS revenue,
             (SELECT count(DISTINCT order_id) FROM fact_orders) AS order_count,
             (SELECT count(DISTINCT customer_unique_id) FROM dim_customers) AS people,
             (SELECT count(*) FROM buyers) AS buyers,
             (SELECT count(*) FROM buyers WHERE n > 1) AS repeaters,
             (SELECT sum(delivery_delay_days) FROM delivered) AS delay,
             (SELECT count(*) FROM delivered) AS measured,
             (SELECT count(*) FROM delivered WHERE is_delayed) AS late)""",
        f"""buyers AS (SELECT customer_unique_id, count(*) AS n FROM fact_orders JOIN dim_customers USING (customer_id)
                       WHERE {repeat_filter} GROUP BY 1)""",
        "delivered AS (SELECT * FROM fact_orders WHERE order_status = 'delivered' AND delivery_delay_days IS NOT NULL)")


GEO = sql(f"""
SELECT customer_state, customer_city, count(DISTINCT o.order_id) AS total_orders,
       {money("coalesce(sum(payment_cents), 0)")} AS total_revenue,
       {ratio("coalesce(sum(payment_cents), 0)", "count(DISTINCT o.order_id)", 100)} AS average_order_value
FROM fact_orders o JOIN dim_customers USING (customer_id) LEFT JOIN order_payments p ON o.order_id = p.order_id
GROUP BY 1, 2""")

SELLER = sql(f"""
SELECT seller_id, seller_city, seller_state, count(DISTINCT i.order_id) AS total_orders,
       {money("sum(price_cents)")} AS total_item_revenue,
       {ratio("coalesce(sum(review_score), 0)", "count(review_score)")} AS average_review_score,
       {ratio("coalesce(sum(delivery_delay_days), 0)", "count(delivery_delay_days)")} AS average_delivery_delay_days
FROM fact_order_items i JOIN dim_sellers USING (seller_id) JOIN fact_orders o ON i.order_id = o.order_id
LEFT JOIN order_reviews r ON o.order_id = r.order_id
GROUP BY 1, 2, 3""")

ONE_REVIEW = """one_review AS (
  SELECT order_id, CASE WHEN count(review_score) > 0 THEN sum(review_score) * 12 // count(review_score) END AS score12
  FROM order_reviews GROUP BY 1)"""

SELLER_DEDUPED = sql(f"""
SELECT seller_id, seller_city, seller_state, count(DISTINCT i.order_id) AS total_orders,
       {money("sum(price_cents)")} AS total_item_revenue,
       {ratio("coalesce(sum(score12), 0)", "count(score12)", 12)} AS average_review_score,
       {ratio("coalesce(sum(delivery_delay_days), 0)", "count(delivery_delay_days)")} AS average_delivery_delay_days
FROM fact_order_items i JOIN dim_sellers USING (seller_id) JOIN fact_orders o ON i.order_id = o.order_id
LEFT JOIN one_review r ON o.order_id = r.order_id
GROUP BY 1, 2, 3""", ONE_REVIEW)


def category(reviews: str, score: str, scale: int, *extra: str) -> str:
    return sql(f"""
SELECT coalesce(product_category_name_english, product_category_name, 'unknown') AS product_category,
       count(DISTINCT i.order_id) AS total_orders, count(*) AS items_sold,
       {money("sum(price_cents)")} AS total_revenue,
       {ratio("sum(price_cents)", "count(*)", 100)} AS average_item_price,
       {ratio(f"coalesce(sum({score}), 0)", f"count({score})", scale)} AS average_review_score
FROM fact_order_items i JOIN dim_products USING (product_id) LEFT JOIN {reviews} r ON i.order_id = r.order_id
GROUP BY product_category_name_english, product_category_name""", *extra)


PAYMENTS = sql(f"""
SELECT payment_type, count(DISTINCT order_id) AS total_orders, count(*) AS transactions_count,
       {money("sum(payment_cents)")} AS total_payment_value,
       {percent("sum(payment_cents)", "(SELECT sum(payment_cents) FROM order_payments)")} AS value_percentage
FROM order_payments GROUP BY 1""")

MONTHLY = f"""monthly AS (
  SELECT year, month, month_name, count(DISTINCT o.order_id) AS total_orders, sum(payment_cents) AS cents
  FROM fact_orders o JOIN dim_date ON purchase_date_key = date_key
  LEFT JOIN order_payments p ON o.order_id = p.order_id GROUP BY 1, 2, 3)"""

RFM = """rfm AS (
  SELECT customer_unique_id,
         CAST(extract(day FROM ((SELECT max(purchase_timestamp) FROM fact_orders) - max(purchase_timestamp)))
           AS INTEGER) AS recency_days,
         count(DISTINCT o.order_id) AS frequency, coalesce(sum(payment_cents), 0) AS cents
  FROM fact_orders o JOIN dim_customers USING (customer_id) LEFT JOIN order_payments p ON o.order_id = p.order_id
  GROUP BY 1)"""


def quintile(value: str, edges: str, labels: range) -> str:
    first, second, third, fourth, fifth = labels
    return (
        f"CASE WHEN {value} <= {edges}[1] THEN {first} WHEN {value} <= {edges}[2] THEN {second} "
        f"WHEN {value} <= {edges}[3] THEN {third} WHEN {value} <= {edges}[4] THEN {fourth} ELSE {fifth} END"
    )


SCORED = (
    RFM,
    """edges AS (SELECT quantile_cont(CAST(recency_days AS DOUBLE), [0.2, 0.4, 0.6, 0.8]) AS r,
                       quantile_cont(CAST(cents AS DOUBLE) / 100, [0.2, 0.4, 0.6, 0.8]) AS m FROM rfm)""",
    f"""scored AS (SELECT rfm.*, {quintile("recency_days", "r", range(5, 0, -1))} AS r_score,
                          {quintile("CAST(cents AS DOUBLE) / 100", "m", range(1, 6))} AS m_score,
                          CASE frequency WHEN 1 THEN 1 WHEN 2 THEN 3 ELSE 5 END AS f_score FROM rfm, edges)""",
    "segmented AS (SELECT *, CASE "
    + " ".join(
        f"WHEN r_score BETWEEN {r1} AND {r2} AND f_score BETWEEN {f1} AND {f2} THEN '{name.replace(chr(39), chr(39) * 2)}'"
        for name, r1, r2, f1, f2 in SEGMENTS
    )
    + f" ELSE '{OTHER_SEGMENT}' END AS segment FROM scored)",
)

SUMMARY = sql(f"""
SELECT segment, count(*) AS customer_count, CAST(sum(recency_days) AS DOUBLE) / count(*) AS avg_recency,
       CAST(sum(frequency) AS DOUBLE) / count(*) AS avg_frequency,
       {money("sum(cents)")} / count(*) AS avg_monetary, {money("sum(cents)")} AS total_monetary,
       {percent("count(*)", "(SELECT count(*) FROM segmented)")} AS customer_pct,
       {percent("sum(cents)", "(SELECT sum(cents) FROM segmented)")} AS revenue_pct
FROM segmented GROUP BY 1""", *SCORED)


def growth(source: str, columns: str, partition: str) -> str:
    """Growth against the last known value, and the complete three-month mean."""
    over = f"OVER ({partition} ORDER BY year, month"
    known = f"last_value(cents IGNORE NULLS) {over} ROWS UNBOUNDED PRECEDING)"
    before = f"last_value(cents IGNORE NULLS) {over} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    recent = f"{over} ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)"
    return f"""
SELECT {columns}, {money("cents")} AS total_revenue, printf('%d-%02d', year, month) AS period,
       {ratio("(known - before) * 100", "coalesce(before, 0)")} AS mom_revenue_growth_pct,
       CASE WHEN filled = 3 THEN {ratio("recent", "3", 100)} END AS rolling_avg_3m_revenue
FROM (SELECT *, {known} AS known, {before} AS before, count(cents) {recent} AS filled, sum(cents) {recent} AS recent
      FROM {source})"""


DAY_SERIES = {
    "total": """SELECT 'total' AS series, CAST(purchase_timestamp AS DATE) AS day, sum(payment_cents) AS cents
                FROM fact_orders o LEFT JOIN order_payments p ON o.order_id = p.order_id GROUP BY 1, 2""",
    "state": """SELECT customer_state AS series, CAST(purchase_timestamp AS DATE) AS day, sum(payment_cents) AS cents
                FROM fact_orders o JOIN dim_customers USING (customer_id)
                LEFT JOIN order_payments p ON o.order_id = p.order_id GROUP BY 1, 2""",
    "customer": """SELECT customer_unique_id AS series, CAST(purchase_timestamp AS DATE) AS day,
                sum(payment_cents) AS cents FROM fact_orders o JOIN dim_customers USING (customer_id)
                LEFT JOIN order_payments p ON o.order_id = p.order_id GROUP BY 1, 2""",
    "seller": """SELECT CAST(seller_id AS VARCHAR) AS series, CAST(purchase_timestamp AS DATE) AS day,
                sum(price_cents) AS cents FROM fact_order_items i JOIN fact_orders o ON i.order_id = o.order_id
                GROUP BY 1, 2""",
    "category": """SELECT coalesce(product_category_name_english, product_category_name, 'unknown') AS series,
                CAST(purchase_timestamp AS DATE) AS day, sum(price_cents) AS cents
                FROM fact_order_items i JOIN dim_products USING (product_id)
                JOIN fact_orders o ON i.order_id = o.order_id GROUP BY 1, 2""",
}


def weekly(by: str) -> tuple[str, ...]:
    return (
        f"daily AS ({DAY_SERIES[by]})",
        """sold AS (SELECT series, CAST(date_trunc('week', day) AS DATE) + 6 AS week_end, sum(cents) AS cents
                    FROM daily GROUP BY 1, 2)""",
        """calendar AS (SELECT series, CAST(unnest(generate_series(min(week_end), max(week_end), INTERVAL 7 DAY)) AS DATE)
                        AS week_end FROM sold GROUP BY 1)""",
        f"""weeks AS (SELECT c.series, c.week_end, CAST(coalesce(cents, 0) AS DOUBLE) / 100 AS revenue
                      FROM calendar c LEFT JOIN sold s ON c.series = s.series AND c.week_end = s.week_end
                      WHERE c.week_end BETWEEN DATE '{FIRST_DAY}' AND DATE '{LAST_DAY}')""",
        """features AS (SELECT *, lag(revenue, 1) OVER w AS lag_1, lag(revenue, 2) OVER w AS lag_2,
                        lag(revenue, 3) OVER w AS lag_3,
                        CASE WHEN count(*) OVER past = 4 THEN round(avg(revenue) OVER past, 4) END AS rolling_mean_4
                        FROM weeks WINDOW w AS (PARTITION BY series ORDER BY week_end),
                        past AS (PARTITION BY series ORDER BY week_end ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING))""",
    )


BASELINE = """WITH RECURSIVE latest AS (
    SELECT series, week_end, revenue AS r1, lag(revenue, 1) OVER w AS r2, lag(revenue, 2) OVER w AS r3, lag(revenue, 3) OVER w AS r4,
           row_number() OVER (PARTITION BY series ORDER BY week_end DESC) AS n, count(*) OVER (PARTITION BY series) AS weeks
    FROM weeks WINDOW w AS (PARTITION BY series ORDER BY week_end)),
steps AS (
    SELECT series, week_end, 0 AS step, r1, r2, r3, r4 FROM latest WHERE n = 1 AND weeks >= 15
    UNION ALL SELECT series, week_end, step + 1, (r1 + r2 + r3 + r4) / 4, r1, r2, r3 FROM steps WHERE step < 8)
SELECT series, CAST(week_end AS DATE) + 7 * step AS purchase_date, round(r1, 2) AS forecasted_revenue FROM steps WHERE step > 0"""


# --- audits ------------------------------------------------------------------


def share(part: str, whole: str) -> str:
    return f"coalesce({percent(part, whole)}, 0.0)"


MISSING = " UNION ALL ".join(
    f"SELECT 'staging' AS schema_name, '{t}' AS table_name, '{c}' AS column_name, "
    f"count(*) - count({c}) AS missing_count, count(*) AS total_count, "
    f"{share(f'count(*) - count({c})', 'count(*)')} AS missing_pct FROM {TABLE_SOURCES[t]}"
    for _, t, _, columns in DATASETS
    for c in columns.split()
)
DUPLICATES = " UNION ALL ".join(
    f"SELECT 'staging' AS schema_name, '{t}' AS table_name, '{k}' AS unique_keys, n AS total_rows, "
    f"n - d AS duplicate_rows, {share('n - d', 'n')} AS duplicate_pct "
    f"FROM (SELECT count(*) AS n, count(DISTINCT row({k})) AS d FROM {TABLE_SOURCES[t]})"
    for _, t, k, _ in DATASETS
)
RULES = " UNION ALL ".join(
    f"SELECT '{name}' AS rule_name, '{table}' AS table_name, '{column}' AS column_name, count(*) AS total_rows, "
    f"count(*) FILTER (WHERE {broken}) AS violations_count, "
    f"{share(f'count(*) FILTER (WHERE {broken})', 'count(*)')} AS violation_pct, "
    f"'{broken}' AS sql_constraint FROM {TABLE_SOURCES[table]}"
    for name, table, column, broken in VALUE_RULES
)

GIVEN_COLUMNS = {
    "region": "r_regionkey r_name",
    "nation": "n_nationkey n_name n_regionkey",
    "customer": "c_custkey c_name c_nationkey c_acctbal c_mktsegment",
    "supplier": "s_suppkey s_name s_nationkey s_acctbal",
    "part": "p_partkey p_name p_brand p_type p_size p_retailprice",
    "orders": "o_orderkey o_custkey o_orderstatus o_totalprice o_orderdate o_orderpriority",
    "lineitem": "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax "
                "l_returnflag l_linestatus l_shipdate",
    "events": "event_id ts user_id event_type value props",
    "documents": "doc_id text lang source n_chars",
    "embeddings": "vec_id embedding label",
    "pages": "page_id url html",
    "benchmark": "item_id text",
    "labels": "doc_id quality toxic",
    "conversations": "conv_id turn role text",
}
PROFILE = " UNION ALL ".join(
    f"SELECT '{t}' AS dataset, (SELECT count(*) FROM {t}) AS row_count, {len(c.split())} AS column_count, "
    f"(SELECT {' + '.join(f'(count(*) - count({x}))' for x in c.split())} FROM {t}) AS missing_values, "
    f"(SELECT count(*) FROM {t}) - (SELECT count(*) FROM (SELECT DISTINCT * FROM {t})) AS duplicate_rows"
    for t, c in GIVEN_COLUMNS.items()
)

STAR_SOURCES = {
    "dim_date": "dim_date", "dim_customers": "dim_customers", "dim_sellers": "dim_sellers",
    "dim_products": "dim_products", "fact_orders": "fact_orders", "fact_order_items": "fact_order_items",
    "fact_payments": "order_payments", "fact_reviews": "order_reviews",
}


# Number of columns of each warehouse table.
STAR_WIDTHS = {"dim_date": 10, "dim_customers": 6, "dim_sellers": 5, "dim_products": 8, "fact_orders": 12,
               "fact_order_items": 8, "fact_payments": 6, "fact_reviews": 8}


def _constraint_rows() -> str:
    """Every constraint is expected to hold; the natural columns are counted, generated keys are taken as sound."""
    renamed = {"review_creation_timestamp": "review_creation_date"}
    generated = {key for _, key, _, _ in WAREHOUSE}
    rows: list[tuple[str, str, str, str]] = []
    for table, key, filled, unique in WAREHOUSE:
        source = STAR_SOURCES[table]
        if key:
            rows += [(table, "not_null", key, "0"), (table, "unique", key, "0")]
        for c in filled.split():
            rows.append((table, "not_null", c,
                         "0" if c in generated else f"SELECT count(*) FROM {source} WHERE {renamed.get(c, c)} IS NULL"))
        rows += [(table, "unique", c, f"SELECT count(*) - count(DISTINCT row({c})) FROM {source}") for c in unique.split()]
    rows += [(t, f"length<={n}", c, f"SELECT count(*) FROM {STAR_SOURCES[t]} WHERE length({c}) > {n}") for t, c, n in LENGTHS]
    rows += [(t, f"references {parent}", c, "0") for t, c, parent in REFERENCES]
    return " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{kind}' AS constraint_kind, '{c}' AS column_name, CAST(({count}) AS BIGINT) AS violations"
        for t, kind, c, count in rows
    )


def _table_counts() -> str:
    return " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS row_count, count(*) AS key_count FROM {s}"
        for t, s in STAR_SOURCES.items()
    )


def _accounting() -> str:
    def dim(step: str, source: str, key: str) -> str:
        return (
            f"SELECT '{step}' AS step, count(*) AS rows_read, count(*) FILTER (WHERE {key} IS NULL) AS null_key, "
            f"0 AS outside_calendar, 0 AS unknown_reference, count({key}) - count(DISTINCT {key}) AS duplicate_key, "
            f"count(DISTINCT {key}) AS rows_loaded FROM {source}"
        )

    copied = (
        "SELECT '{0}' AS step, count(*) AS rows_read, 0 AS null_key, 0 AS outside_calendar, 0 AS unknown_reference, "
        "0 AS duplicate_key, count(*) AS rows_loaded FROM {1}"
    )
    orders = f"""SELECT 'fact_orders' AS step, count(*) AS rows_read, count(*) FILTER (WHERE order_id IS NULL) AS null_key,
        count(*) FILTER (WHERE order_id IS NOT NULL AND NOT inside) AS outside_calendar,
        count(*) FILTER (WHERE order_id IS NOT NULL AND inside AND NOT known) AS unknown_reference,
        count(*) FILTER (WHERE order_id IS NOT NULL AND inside AND known)
          - count(DISTINCT order_id) FILTER (WHERE inside AND known) AS duplicate_key,
        count(DISTINCT order_id) FILTER (WHERE inside AND known) AS rows_loaded
        FROM (SELECT order_id, coalesce(CAST(order_purchase_timestamp AS DATE)
                BETWEEN DATE '{FIRST_DAY}' AND DATE '{LAST_DAY}', FALSE) AS inside,
              customer_id IN (SELECT customer_id FROM dim_customers) AS known FROM stg_orders)"""
    items = """SELECT 'fact_order_items' AS step, count(*) AS rows_read, 0 AS null_key, 0 AS outside_calendar,
        count(*) FILTER (WHERE NOT known) AS unknown_reference, 0 AS duplicate_key,
        count(*) FILTER (WHERE known) AS rows_loaded
        FROM (SELECT product_id IN (SELECT product_id FROM dim_products)
                 AND seller_id IN (SELECT seller_id FROM dim_sellers) AS known FROM order_items)"""
    steps = " UNION ALL ".join(
        [
            dim("dim_customers", "customers", "customer_id"),
            dim("dim_sellers", "sellers", "seller_id"),
            dim("dim_products", "products", "product_id"),
            orders,
            items,
            copied.format("fact_payments", "order_payments"),
            copied.format("fact_reviews", "order_reviews"),
        ]
    )
    return f"SELECT *, 0 AS unexplained FROM ({steps})"


def _orphans() -> str:
    checks = [
        ("order_items.order_id", "order_items", "order_id", "stg_orders", "order_id"),
        ("order_items.product_id", "order_items", "product_id", "products", "product_id"),
        ("order_items.seller_id", "order_items", "seller_id", "sellers", "seller_id"),
        ("orders.customer_id", "stg_orders", "customer_id", "customers", "customer_id"),
        ("orders.order_id in order_items", "stg_orders", "order_id", "order_items", "order_id"),
    ]
    return " UNION ALL ".join(
        f"SELECT '{label}' AS reference, count(*) AS orphans FROM {child} c WHERE c.{column} IS NOT NULL "
        f"AND NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{key} = c.{column})"
        for label, child, column, parent, key in checks
    )


# What is spoilt in the exported files: cells that do not fit their type, lines with a cell too many.
SPOILT_CELLS = {
    "orders": ("order_id % 7 = 0", "order_id % 5 = 0"),
    "order_items": ("order_id % 6 = 0", "order_id % 10 = 0"),
    "payments": ("order_id % 9 = 0",),
    "products": ("product_id % 4 = 0",),
    "geolocation": ("geolocation_lng = 3",),
}
SPOILT_LINES = {"orders": "order_id % 11 = 0", "customers": "customer_id % 8 = 0", "payments": "order_id % 4 = 1", "sellers": "seller_id % 3 = 0"}
CSV_COUNTS = " UNION ALL ".join(
    f"SELECT '{key}' AS dataset, '{table}' AS table_name, count(*) AS rows_loaded, "
    f"{' + '.join(f'count(*) FILTER (WHERE {w})' for w in SPOILT_CELLS.get(key, ('FALSE',)))} AS rejected_cells, "
    f"count(*) FILTER (WHERE {SPOILT_LINES.get(key, 'FALSE')}) AS malformed_rows, "
    f"'loaded' AS status FROM {TABLE_SOURCES[table]}"
    for key, table, _, _ in DATASETS
)

# The planted defects of the star, counted over the natural tables.
DEFECTS = " UNION ALL ".join(
    f"SELECT '{table}' AS table_name, '{kind}' AS constraint_kind, '{column}' AS column_name, count(*) AS violations "
    f"FROM {source} WHERE {where} HAVING count(*) > 0"
    for table, kind, column, source, where in (
        ("dim_customers", "length<=10", "customer_state", "dim_customers", "customer_id % 7 = 0"),
        ("dim_sellers", "length<=100", "seller_city",
         "(SELECT * FROM dim_sellers UNION ALL SELECT * FROM dim_sellers WHERE seller_id % 4 = 1)", "seller_id % 3 = 0"),
        ("dim_sellers", "unique", "seller_id", "dim_sellers", "seller_id % 4 = 1"),
        ("dim_sellers", "unique", "seller_key", "dim_sellers", "seller_id % 4 = 1"),
        ("fact_orders", "not_null", "order_status", "fact_orders", "order_id % 5 = 0"),
        ("fact_orders", "not_null", "purchase_date_key", "fact_orders", "order_id % 17 = 0"),
        ("fact_orders", "references dim_customers", "customer_key", "fact_orders", "order_id % 13 = 0"),
        ("fact_order_items", "references dim_products", "product_key", "fact_order_items", "order_id % 11 = 0"),
        ("fact_payments", "length<=50", "payment_type", "order_payments", "order_id % 3 = 0"),
        ("fact_reviews", "not_null", "review_score", "order_reviews", "review_score = 1"),
    )
)

TOKENS = ("NA", " NA ", "nan", " None ", "null", "N/A", "", "  ")


def queries() -> dict[str, str]:
    rfm_columns = f"customer_unique_id, recency_days, frequency, {money('cents')} AS monetary_value"
    return {
        "dim_date": sql("""SELECT dim_date.*, coalesce(n, 0) AS orders_placed FROM dim_date LEFT JOIN (
            SELECT CAST(order_purchase_timestamp AS DATE) AS order_day, count(*) AS n FROM stg_orders GROUP BY 1)
            ON date = order_day"""),
        "dim_customers": sql("SELECT * FROM dim_customers"),
        "dim_sellers": sql("SELECT * FROM dim_sellers"),
        "dim_products": sql("SELECT * FROM dim_products"),
        "fact_orders": sql("SELECT * FROM fact_orders"),
        "fact_order_items": sql("""SELECT order_id, order_item_id, product_id, seller_id, shipping_limit_date,
            CAST(price AS DOUBLE) AS price, CAST(freight_value AS DOUBLE) AS freight_value FROM fact_order_items"""),
        "fact_payments": sql("""SELECT order_id, payment_sequential, payment_type, payment_installments,
            CAST(payment_value AS DOUBLE) AS payment_value FROM order_payments"""),
        "fact_reviews": sql("""SELECT review_id, order_id, review_score, review_comment_title, review_comment_message,
            review_creation_date AS review_creation_timestamp, review_answer_timestamp FROM order_reviews"""),
        "insert_or_ignore": sql("""SELECT * FROM dim_sellers UNION ALL
            SELECT customer_id, customer_zip_code_prefix, customer_city, customer_state FROM dim_customers
            WHERE customer_id NOT IN (SELECT seller_id FROM dim_sellers)"""),
        "extended_dimension": sql("""SELECT count(*) AS row_count, count(*) AS key_count, count(*) AS last_key,
            (SELECT count(*) FROM dim_sellers) AS kept_keys
            FROM (SELECT seller_id FROM dim_sellers UNION SELECT customer_id FROM dim_customers)"""),
        "surrogate_keys": "SELECT count(*) AS row_count, count(*) AS key_count, 1 AS first_key, count(*) AS last_key FROM lineitem",
        "published_tables": sql(_table_counts()),
        "increment_tables": sql(_table_counts()),
        "increment_sellers": SELLER,
        "increment_categories": category("order_reviews", "review_score", 1),
        "increment_months": sql(f"""SELECT year, month, month_name, total_orders, {money("cents")} AS total_revenue
            FROM monthly""", MONTHLY),
        "ingest_counts": """
            WITH d AS (SELECT 0 AS batch, c_custkey AS k, c_custkey % 9 <> 0 AS fresh FROM customer WHERE c_custkey % 2 = 0
                       UNION ALL
                       SELECT 1, c_custkey, c_custkey % 9 <> 0 AND c_custkey % 2 <> 0 FROM customer WHERE c_custkey % 3 <> 1)
            SELECT batch, count(*) AS rows_read, count(*) FILTER (k % 9 = 0) AS rejected_cells,
                   count(*) FILTER (k % 11 = 0) AS malformed_rows, count(*) FILTER (fresh) AS rows_added
            FROM d GROUP BY batch""",
        "constraints": sql(_constraint_rows()),
        "constraint_defects": sql(DEFECTS),
        "fk_orphans": sql(_orphans()),
        "load_accounting": sql(_accounting()),
        "kpi_overview": kpi_overview(),
        "kpi_overview_completed": kpi_overview("order_status = 'delivered'"),
        "repeat_customers": sql("""SELECT customer_unique_id, count(*) AS order_count
            FROM fact_orders JOIN dim_customers USING (customer_id) GROUP BY 1"""),
        "order_revenue": sql(f"""SELECT o.order_id, order_status, {money("sum(payment_cents)")} AS order_revenue
            FROM fact_orders o LEFT JOIN order_payments p ON o.order_id = p.order_id GROUP BY 1, 2"""),
        "geo_performance": GEO,
        "seller_performance": SELLER,
        "seller_performance_deduped": SELLER_DEDUPED,
        "category_profitability": category("order_reviews", "review_score", 1),
        "category_profitability_deduped": category("one_review", "score12", 12, ONE_REVIEW),
        "payment_distribution": PAYMENTS,
        "monthly_trend": sql(f"""SELECT year, month, month_name, total_orders, {money("cents")} AS total_revenue
            FROM monthly""", MONTHLY),
        "customer_rfm": sql(f"SELECT {rfm_columns} FROM rfm", RFM),
        "daily_revenue": sql(f"SELECT day AS purchase_date, {money('cents')} AS revenue FROM daily",
                             f"daily AS ({DAY_SERIES['total']})"),
        "delivery_time": sql(f"""SELECT count(*) AS delivered_orders, {ratio("sum(days)", "count(days)")}
            AS average_delivery_days FROM (SELECT extract(day FROM (delivered_customer_timestamp - purchase_timestamp)) AS days
            FROM fact_orders WHERE delivered_customer_timestamp IS NOT NULL)"""),
        "on_time_rate": sql(f"""SELECT count(*) AS measured_orders,
            {percent("count(*) FILTER (WHERE NOT is_delayed)", "count(*)")} AS on_time_percentage
            FROM fact_orders WHERE order_status = 'delivered' AND delivery_delay_days IS NOT NULL"""),
        "satisfaction": sql(f"""SELECT count(review_score) AS reviews,
            {ratio("sum(review_score)", "count(review_score)")} AS average_review_score FROM order_reviews"""),
        "customer_ltv": sql(f"SELECT customer_unique_id, {money('cents')} AS lifetime_value FROM rfm", RFM),
        "rfm_scores": sql("SELECT customer_unique_id, r_score, f_score, m_score FROM segmented", *SCORED),
        "rfm_segments": sql(f"""SELECT {rfm_columns}, r_score, m_score, f_score, segment,
            CAST(r_score AS VARCHAR) || f_score || m_score AS rfm_score_code FROM segmented""", *SCORED),
        "segment_summary": SUMMARY,
        "monthly_growth": sql(growth("monthly", "year, month, month_name, total_orders", ""), MONTHLY),
        "monthly_growth_by_state": sql(growth("state_months", "series, year, month", "PARTITION BY series"),
            f"daily AS ({DAY_SERIES['state']})",
            """state_months AS (SELECT series, CAST(year(day) AS INTEGER) AS year, CAST(month(day) AS INTEGER) AS month,
               sum(cents) AS cents FROM daily GROUP BY 1, 2, 3)"""),
        "weekly_sales": sql("SELECT * FROM weeks", *weekly("total")),
        "weekly_sales_by_seller": sql("SELECT * FROM weeks", *weekly("seller")),
        "weekly_sales_by_category": sql("SELECT * FROM weeks", *weekly("category")),
        "lag_features": sql("SELECT * FROM features", *weekly("seller")),
        "train_test_split": sql("""SELECT series, week_end, revenue, week_end > (SELECT max(week_end) FROM panel) - 56 AS is_test
            FROM (SELECT series, week_end, revenue, row_number() OVER (PARTITION BY series ORDER BY week_end) AS n FROM panel)
            WHERE n > 4""", *weekly("seller"), """long_series AS (SELECT * FROM weeks
            WHERE series IN (SELECT series FROM weeks GROUP BY 1 HAVING count(*) >= 15))""", """panel AS (
            SELECT c.series, c.week_end, coalesce(w.revenue, 0.0) AS revenue
            FROM (SELECT series, CAST(unnest(generate_series(min(week_end), (SELECT max(week_end) FROM long_series), INTERVAL 7 DAY)) AS DATE)
                  AS week_end FROM long_series GROUP BY 1) c
            LEFT JOIN long_series w ON c.series = w.series AND c.week_end = w.week_end)"""),
        "train_test_split_by_series": sql("""SELECT series, week_end, revenue,
            row_number() OVER (PARTITION BY series ORDER BY week_end DESC) <= 8 AS is_test
            FROM features WHERE rolling_mean_4 IS NOT NULL
            AND series IN (SELECT series FROM weeks GROUP BY 1 HAVING count(*) >= 15)""", *weekly("state")),
        "forecast_calendar": sql("""SELECT series, CAST(max(week_end) AS DATE) + CAST(7 * n AS INTEGER) AS purchase_date, TRUE AS in_range
            FROM weeks, range(1, 9) AS steps(n) GROUP BY series, n""", *weekly("total")),
        "forecast_baseline": sql(f"SELECT * FROM ({BASELINE})", *weekly("state")),
        "forecast_export": sql(f"SELECT purchase_date, forecasted_revenue FROM ({BASELINE})", *weekly("total")),
        "evaluate_baseline": sql("""SELECT series, count(*) AS test_rows, round(avg(abs(revenue - lag_1)), 3) AS mae,
            round(sqrt(avg((revenue - lag_1) * (revenue - lag_1))), 3) AS rmse, round(avg(revenue), 3) AS mean_weekly_revenue
            FROM (SELECT *, row_number() OVER (PARTITION BY series ORDER BY week_end DESC) AS n FROM features
                  WHERE rolling_mean_4 IS NOT NULL AND series IN (SELECT series FROM weeks GROUP BY 1 HAVING count(*) >= 15))
            WHERE n <= 8 GROUP BY 1""", *weekly("category")),
        "short_series": sql("SELECT series, count(*) AS weeks FROM weeks GROUP BY 1 HAVING count(*) < 15",
                            *weekly("customer")),
        "missing_audit": sql(MISSING),
        "duplicate_audit": sql(DUPLICATES),
        "rule_audit": sql(RULES),
        "dataset_profile": PROFILE,
        "quality_gate": sql(f"""SELECT table_name, total_rows, worst AS worst_missing_pct, duplicate_pct,
            total_rows >= {GATE_ROWS} AS rows_ok, worst <= {GATE_MISSING} AS missing_ok,
            duplicate_pct <= {GATE_REPEATED} AS duplicates_ok,
            total_rows >= {GATE_ROWS} AND worst <= {GATE_MISSING}
              AND duplicate_pct <= {GATE_REPEATED} AS passed
            FROM duplicates JOIN (SELECT table_name, max(missing_pct) AS worst FROM missing GROUP BY 1) USING (table_name)""",
            f"missing AS ({MISSING})", f"duplicates AS ({DUPLICATES})"),
        "quality_issues": sql(f"""SELECT 'missing' AS audit, table_name, column_name AS subject,
              missing_count AS affected_rows, missing_pct AS affected_pct FROM ({MISSING}) WHERE missing_count > 0
            UNION ALL SELECT 'duplicate', table_name, unique_keys, duplicate_rows, duplicate_pct
              FROM ({DUPLICATES}) WHERE duplicate_rows > 0
            UNION ALL SELECT 'rule', table_name, rule_name, violations_count, violation_pct
              FROM ({RULES}) WHERE violations_count > 0"""),
        "clean_text": f"""SELECT doc_id, CASE WHEN t NOT IN ('', 'nan', 'NaN', 'None') THEN t END AS clean_text
            FROM (SELECT doc_id, trim(text, {_strip_list()}) AS t FROM documents)""",
        "null_tokens": f"""SELECT event_id, CASE WHEN trim(t, ' ') NOT IN ('', 'nan', 'NaN', 'None') THEN trim(t, ' ') END
            AS event_type FROM (SELECT event_id, CASE WHEN raw NOT IN ({", ".join(f"'{t}'" for t in NA_TOKENS)})
            THEN raw END AS t FROM (SELECT event_id, CASE WHEN value < 8
            THEN [{", ".join(f"'{t}'" for t in TOKENS)}][event_id % 8 + 1] ELSE event_type END AS raw FROM events))""",
        "safe_timestamp": """SELECT event_id, CASE event_type WHEN 'error' THEN NULL WHEN 'view' THEN date_trunc('day', ts)
            ELSE ts END AS event_time FROM events""",
        "safe_int": """SELECT l_returnflag, count(*) AS cells, count(q) AS accepted, CAST(sum(q) AS BIGINT) AS total_quantity
            FROM (SELECT l_returnflag, CASE WHEN l_returnflag IN ('R', 'A') THEN CAST(l_quantity AS INTEGER) END AS q
            FROM lineitem) GROUP BY 1""",
        "csv_ingest": sql(CSV_COUNTS),
        "csv_reviews": sql("""SELECT CAST(review_id AS VARCHAR) AS review_id, CAST(order_id AS VARCHAR) AS order_id,
            review_score, review_comment_title, review_comment_message, review_creation_date, review_answer_timestamp
            FROM order_reviews"""),
        "report_csv": sql(f"""SELECT period, month_name, CAST(total_orders AS VARCHAR) AS total_orders,
            printf('%.2f', total_revenue) AS total_revenue, printf('%.2f', mom_revenue_growth_pct) AS growth,
            printf('%.2f', rolling_avg_3m_revenue) AS rolling
            FROM ({growth("monthly", "year, month, month_name, total_orders", "")})""", MONTHLY),
        "profile_files": sql(" UNION ALL ".join(
            f"SELECT '{t}.csv' AS dataset, count(*) AS row_count, {len(c.split())} AS column_count, "
            f"{' + '.join(f'(count(*) - count({x}))' for x in c.split())} AS missing_values, "
            f"count(*) - count(DISTINCT row({', '.join(c.split())})) AS duplicate_rows FROM {'stg_orders' if t == 'orders' else t}"
            for _, t, _, c in DATASETS)),
        "sql_over_views": sql(f"""SELECT year, month,
            {percent("cents", "(SELECT sum(payment_cents) FROM order_payments)")} AS share_pct FROM monthly""", MONTHLY),
        "incremental_ingest": sql("""SELECT CAST(customer_id AS VARCHAR) AS customer_id, customer_unique_id,
            customer_zip_code_prefix, customer_city, customer_state FROM dim_customers UNION ALL
            SELECT CAST(-1 - customer_id AS VARCHAR), customer_unique_id, customer_zip_code_prefix, customer_city,
            customer_state FROM dim_customers UNION ALL
            SELECT CAST(-1000000000 - customer_id AS VARCHAR), customer_unique_id, customer_zip_code_prefix, customer_city,
            customer_state FROM dim_customers"""),
        "registered_tables": sql(" UNION ALL ".join(
            f"SELECT 'warehouse' AS namespace, '{t}' AS table_name, {STAR_WIDTHS[t]} AS column_count, count(*) AS row_count FROM {s}"
            for t, s in STAR_SOURCES.items())),
        "segment_export": sql(f"""SELECT {rfm_columns}, r_score, m_score, f_score, segment,
            CAST(r_score AS VARCHAR) || f_score || m_score AS rfm_score_code FROM segmented""", *SCORED),
        "segment_report": SUMMARY,
    }


def _strip_list() -> str:
    """The white space a Unicode strip removes, spelled as code points."""
    points = [*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
    return " || ".join(f"chr({p})" for p in points)
