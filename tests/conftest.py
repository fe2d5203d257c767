from __future__ import annotations

import datetime as dt
import os
import sys
from decimal import Decimal

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from marketlens.schemas import STAGING_SCHEMAS  # noqa: E402
from marketlens.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "marketlens-tests", "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoint")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("catalog")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def at(text: str | None) -> dt.datetime | None:
    return None if text is None else dt.datetime.fromisoformat(text)


def money(value: str | None) -> Decimal | None:
    return None if value is None else Decimal(value)


def order(order_id, customer, bought, status="delivered", delivered=None, due=None, approved=None):
    return (order_id, customer, status, at(bought), at(approved), None, at(delivered), at(due))


def item(order_id, number, product, seller, price, freight="1.00"):
    return (order_id, number, product, seller, at("2018-02-01"), money(price), money(freight))


def payment(order_id, number, value, kind="boleto"):
    return (order_id, number, kind, 1, money(value))


def review(review_id, order_id, score):
    return (review_id, order_id, score, None, None, at("2018-03-01"), at("2018-03-02"))


@pytest.fixture(scope="session")
def make_staging(spark):
    """Staging tables from plain rows; tables that are not given are empty."""

    def build(**rows):
        return {t: spark.createDataFrame(rows.get(t, []), schema) for t, schema in STAGING_SCHEMAS.items()}

    return build


@pytest.fixture(scope="session")
def shop(make_staging):
    """A small shop with one of every edge case of the star and the KPI views."""
    return make_staging(
        customers=[
            ("c1", "ann", "01310", "sao paulo", "SP"),
            ("c2", "ann", "01310", "sao paulo", "SP"),
            ("c3", "bob", "20000", "rio", "RJ"),
            ("c3", "bob", "20000", "niteroi", "RJ"),  # conflicting city
            ("c1", "ann", "01310", "sao paulo", "SP"),  # exact copy
            ("c4", "cyd", "30000", "rio", "RJ"),
            (None, "nobody", "0", "x", "XX"),
        ],
        sellers=[("s1", "1", "curitiba", "PR"), ("s2", "2", "rio", "RJ")],
        products=[
            ("p1", "beleza", 1, 1, 1, 1.0, 1.0, 1.0, 1.0),
            ("p2", "saude", 1, 1, 1, 1.0, 1.0, 1.0, 1.0),  # another raw name, same label
            ("p3", "exotico", 1, 1, 1, 1.0, 1.0, 1.0, 1.0),  # untranslated
            ("p4", None, 1, 1, 1, 1.0, 1.0, 1.0, 1.0),
        ],
        category_translation=[("beleza", "health"), ("saude", "health")],
        orders=[
            order("o1", "c1", "2018-01-10T08:00:00", delivered="2018-01-20T00:00:00", due="2018-02-01T12:00:00"),
            order("o2", "c2", "2018-01-31T23:00:00", delivered="2018-02-10T06:00:00", due="2018-02-10T12:00:00"),
            order("o3", "c3", "2018-03-01T00:00:00", delivered="2018-03-10T18:00:00", due="2018-03-10T12:00:00"),
            order("o4", "c3", "2018-03-05T10:00:00", delivered="2018-03-12T00:00:00", due="2018-03-12T00:00:00"),
            order("o5", "c4", "2018-05-05T10:00:00", "shipped", due="2018-05-20T00:00:00"),
            order("o6", "c4", "2015-05-05T10:00:00"),  # before the calendar
            order("o7", "c4", None),  # no purchase time
            order("o8", "ghost", "2018-05-05T10:00:00"),  # unknown customer
            order("o1", "c1", "2018-01-10T08:00:00", delivered="2018-01-20T00:00:00", due="2018-02-01T12:00:00"),
        ],
        order_items=[
            item("o1", 1, "p1", "s1", "10.00"),
            item("o1", 2, "p2", "s1", "20.00"),
            item("o2", 1, "p3", "s1", "30.00"),
            item("o3", 1, "p4", "s2", "40.00"),
            item("o3", 2, "p1", "ghost", "50.00"),
            item("o4", 1, "ghost", "s2", "60.00"),
            item("o4", 2, "p1", "s2", "0.05"),
        ],
        order_payments=[
            payment("o1", 1, "7.50"), payment("o1", 2, "22.50", "voucher"), payment("o2", 1, "30.00"),
            payment("o3", 1, "90.00"), payment("o9", 1, "5.00"),
        ],
        order_reviews=[review("r1", "o1", 5), review("r2", "o1", 2), review("r3", "o3", 4), review("r3", "o9", 1)],
    )
