"""Table shapes: raw datasets, staging tables, star schema and its constraints."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

MONEY = T.DecimalType(10, 2)
STR, INT, LONG, DBL = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()
TS, DATE, BOOL = T.TimestampNTZType(), T.DateType(), T.BooleanType()


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in columns.items()])


@dataclass(frozen=True)
class Dataset:
    """A raw file set, the staging table it feeds, and the business key audits use."""

    key: str
    #: one file or many: the pattern is resolved under the raw directory
    file_pattern: str
    table: str
    schema: T.StructType
    business_key: tuple[str, ...]
    zip_column: str | None = None
    #: free text may hold quoted line breaks; such a file is read by one task,
    #: so deliver it as many files.  All other datasets split freely.
    multiline: bool = False


# File patterns, table names, columns and business keys of the raw datasets.
DATASETS: dict[str, Dataset] = {
    d.key: d
    for d in (
        Dataset(
            "customers", "*_customers_dataset*.csv", "customers",
            _struct(customer_id=STR, customer_unique_id=STR, customer_zip_code_prefix=STR,
                    customer_city=STR, customer_state=STR),
            ("customer_id",), "customer_zip_code_prefix",
        ),
        Dataset(
            "orders", "*_orders_dataset*.csv", "orders",
            _struct(order_id=STR, customer_id=STR, order_status=STR, order_purchase_timestamp=TS,
                    order_approved_at=TS, order_delivered_carrier_date=TS,
                    order_delivered_customer_date=TS, order_estimated_delivery_date=TS),
            ("order_id",),
        ),
        Dataset(
            "order_items", "*_order_items_dataset*.csv", "order_items",
            _struct(order_id=STR, order_item_id=INT, product_id=STR, seller_id=STR,
                    shipping_limit_date=TS, price=MONEY, freight_value=MONEY),
            ("order_id", "order_item_id"),
        ),
        Dataset(
            "payments", "*_order_payments_dataset*.csv", "order_payments",
            _struct(order_id=STR, payment_sequential=INT, payment_type=STR,
                    payment_installments=INT, payment_value=MONEY),
            ("order_id", "payment_sequential"),
        ),
        Dataset(
            "reviews", "*_order_reviews_dataset*.csv", "order_reviews",
            _struct(review_id=STR, order_id=STR, review_score=INT, review_comment_title=STR,
                    review_comment_message=STR, review_creation_date=TS, review_answer_timestamp=TS),
            ("review_id",), multiline=True,
        ),
        Dataset(
            "products", "*_products_dataset*.csv", "products",
            _struct(product_id=STR, product_category_name=STR, product_name_lenght=INT,
                    product_description_lenght=INT, product_photos_qty=INT, product_weight_g=DBL,
                    product_length_cm=DBL, product_height_cm=DBL, product_width_cm=DBL),
            ("product_id",),
        ),
        Dataset(
            "sellers", "*_sellers_dataset*.csv", "sellers",
            _struct(seller_id=STR, seller_zip_code_prefix=STR, seller_city=STR, seller_state=STR),
            ("seller_id",), "seller_zip_code_prefix",
        ),
        Dataset(
            "geolocation", "*_geolocation_dataset*.csv", "geolocation",
            _struct(geolocation_zip_code_prefix=STR, geolocation_lat=DBL, geolocation_lng=DBL,
                    geolocation_city=STR, geolocation_state=STR),
            ("geolocation_zip_code_prefix", "geolocation_lat", "geolocation_lng"),
            "geolocation_zip_code_prefix",
        ),
        Dataset(
            "category_translation", "*category_name_translation*.csv", "category_translation",
            _struct(product_category_name=STR, product_category_name_english=STR),
            ("product_category_name",),
        ),
    )
}

BUSINESS_KEYS = {d.table: d.business_key for d in DATASETS.values()}
STAGING_SCHEMAS = {d.table: d.schema for d in DATASETS.values()}


@dataclass(frozen=True)
class TableRules:
    """Constraints a warehouse table must meet before it is published."""

    not_null: tuple[str, ...]
    unique: tuple[tuple[str, ...], ...] = ()
    foreign_keys: dict[str, tuple[str, str]] = field(default_factory=dict)
    max_length: dict[str, int] = field(default_factory=dict)


# NOT NULL, UNIQUE, FOREIGN KEY and VARCHAR(n) of the star schema.
WAREHOUSE_RULES: dict[str, TableRules] = {
    "dim_date": TableRules(
        ("date_key", "date", "year", "quarter", "month", "month_name", "day", "day_of_week",
         "day_name", "is_weekend"),
        (("date_key",), ("date",)),
        max_length={"month_name": 20, "day_name": 20},
    ),
    "dim_customers": TableRules(
        ("customer_key", "customer_id", "customer_unique_id"),
        (("customer_key",), ("customer_id",)),
        max_length={"customer_id": 50, "customer_unique_id": 50, "customer_zip_code_prefix": 20,
                    "customer_city": 100, "customer_state": 10},
    ),
    "dim_sellers": TableRules(
        ("seller_key", "seller_id"),
        (("seller_key",), ("seller_id",)),
        max_length={"seller_id": 50, "seller_zip_code_prefix": 20, "seller_city": 100,
                    "seller_state": 10},
    ),
    "dim_products": TableRules(
        ("product_key", "product_id"),
        (("product_key",), ("product_id",)),
        max_length={"product_id": 50, "product_category_name": 100,
                    "product_category_name_english": 100},
    ),
    "fact_orders": TableRules(
        ("order_key", "order_id", "customer_key", "order_status", "purchase_date_key",
         "purchase_timestamp"),
        (("order_key",), ("order_id",)),
        {"customer_key": ("dim_customers", "customer_key"),
         "purchase_date_key": ("dim_date", "date_key")},
        {"order_id": 50, "order_status": 50},
    ),
    "fact_order_items": TableRules(
        ("order_item_key", "order_id", "order_item_id", "product_key", "seller_key",
         "shipping_limit_date", "price", "freight_value"),
        (("order_item_key",),),
        {"product_key": ("dim_products", "product_key"),
         "seller_key": ("dim_sellers", "seller_key")},
        {"order_id": 50},
    ),
    "fact_payments": TableRules(
        ("payment_key", "order_id", "payment_sequential", "payment_type", "payment_installments",
         "payment_value"),
        (("payment_key",),),
        max_length={"order_id": 50, "payment_type": 50},
    ),
    "fact_reviews": TableRules(
        ("review_key", "review_id", "order_id", "review_score", "review_creation_timestamp",
         "review_answer_timestamp"),
        (("review_key",),),
        max_length={"review_id": 50, "order_id": 50},
    ),
}

# Surrogate key column of each keyed warehouse table.
SURROGATE_KEYS = {
    "dim_customers": "customer_key",
    "dim_sellers": "seller_key",
    "dim_products": "product_key",
    "fact_orders": "order_key",
    "fact_order_items": "order_item_key",
    "fact_payments": "payment_key",
    "fact_reviews": "review_key",
}
