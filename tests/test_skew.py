"""Results on data where one customer, order, part and supplier each own a third of the rows."""

from __future__ import annotations

import os
import shutil

import duckdb
import pytest

import __spark_entry__ as entry_point
from marketlens.registry import GIVEN_TABLES
from tests.oracle_check import compare, connect

pytestmark = pytest.mark.skipif(not os.path.isdir(entry_point.SMOKE_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    folder = tmp_path_factory.mktemp("skewed")
    for name in GIVEN_TABLES:
        if name not in ("orders", "lineitem"):
            shutil.copyfile(f"{entry_point.SMOKE_DIR}/{name}.parquet", folder / f"{name}.parquet")
    db = duckdb.connect()
    db.execute(f"""COPY (SELECT * REPLACE (CASE WHEN o_orderkey % 3 = 0 THEN 7 ELSE o_custkey END AS o_custkey)
                   FROM '{entry_point.SMOKE_DIR}/orders.parquet') TO '{folder}/orders.parquet'""")
    db.execute(f"""COPY (SELECT * REPLACE (
                     CASE WHEN (l_linenumber + l_suppkey) % 3 = 0 THEN 51 ELSE l_orderkey END AS l_orderkey,
                     CASE WHEN l_partkey % 3 = 0 THEN 5 ELSE l_partkey END AS l_partkey,
                     CASE WHEN l_suppkey % 3 = 1 THEN 3 ELSE l_suppkey END AS l_suppkey)
                   FROM '{entry_point.SMOKE_DIR}/lineitem.parquet') TO '{folder}/lineitem.parquet'""")
    return str(folder)


@pytest.mark.parametrize("name", [
    "kpi_overview", "geo_performance", "seller_performance", "category_profitability", "customer_rfm",
    "fact_orders", "fact_order_items", "load_accounting", "fk_orphans", "duplicate_audit", "weekly_sales_by_seller",
])
def test_hot_keys(spark, skewed, name):
    assert compare(spark, connect(skewed), skewed, name) is None


def test_a_key_that_owns_both_sides_does_not_overflow(spark, make_staging):
    """Ten million items of one order times a billion reviews, as sums: beyond 64 bits in cents."""
    from pyspark.sql import functions as F

    from marketlens.functions.numeric import as_money, wide_product

    row = spark.range(1).select(
        as_money(wide_product(F.lit(50_000_000_000_000), F.lit(1_000_000_000))).alias("total")
    ).first()
    assert row.total == 500_000_000_000_000_000_000
