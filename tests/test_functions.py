from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pandas as pd
from pyspark.sql import functions as F

from marketlens.functions import text
from marketlens.functions.dates import date_key, elapsed_days, period_label, week_ending_sunday
from marketlens.functions.numeric import audit_percent, exact_ratio, percent


def _texts(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")


def _apply(frame, column):
    return [r.x for r in frame.select("i", column.alias("x")).orderBy("i").collect()]


def test_strip_matches_python_strip(spark):
    values = ["  a b ", "\ta\n", " x ", "\x1cy\x1f", "　 z\u0085", "in\tside", "", "   ", None]
    expected = [None if v is None else v.strip() for v in values]
    assert _apply(_texts(spark, values), text.strip_text(F.col("v"))) == expected


def test_null_tokens_after_strip(spark):
    values = ["", "  ", "nan", " NaN ", "None", "none", "NA", "null", "ok"]
    assert _apply(_texts(spark, values), text.clean_text(F.col("v"))) == [
        None, None, None, None, None, "none", "NA", "null", "ok"]


def test_reader_tokens_match_exactly(spark):
    values = ["NA", " NA ", "N/A", "NULL", "null", "n/a", "na", "#N/A", "<NA>", "x"]
    cleaned = text.clean_text(text.reader_na_to_null(F.col("v")))
    assert _apply(_texts(spark, values), cleaned) == [None, "NA", None, None, None, None, "na", None, None, "x"]


def test_safe_timestamp(spark):
    values = ["2018-01-02 03:04:05", "2018-01-02", " 2018-01-02 03:04:05\t", "2018-02-30", "at 2018-01-02", "2018", "", None]
    full = dt.datetime(2018, 1, 2, 3, 4, 5)
    assert _apply(_texts(spark, values), text.safe_timestamp(F.col("v"))) == [
        full, dt.datetime(2018, 1, 2), full, None, None, None, None, None]


def test_safe_int(spark):
    values = ["4", "4.0", " 40 ", "4.5", "x", "", None, "-3", "99999999999"]
    assert _apply(_texts(spark, values), text.safe_int(F.col("v"))) == [4, 4, 40, None, None, None, None, -3, None]


def test_leading_zeros(spark):
    values = ["01310", "00000", "123", "0a", None]
    assert _apply(_texts(spark, values), text.strip_leading_zeros(F.col("v"))) == ["1310", "0", "123", "0a", None]


def test_elapsed_days_truncates_toward_zero(spark):
    due = dt.datetime(2018, 1, 20, 12)
    hours = [-300, -24, -6, 0, 6, 24, 300]
    frame = spark.createDataFrame(
        [(i, due + dt.timedelta(hours=h), due) for i, h in enumerate(hours)], "i int, a timestamp_ntz, b timestamp_ntz")
    assert _apply(frame, elapsed_days(F.col("a"), F.col("b"))) == [-12, -1, 0, 0, 0, 1, 12]


def test_week_ends_on_sunday_like_a_weekly_resample(spark):
    days = pd.date_range("2018-01-01", "2018-01-15")
    frame = spark.createDataFrame([(i, d.date()) for i, d in enumerate(days)], "i int, d date")
    expected = [d.to_period("W-SUN").end_time.date() for d in days]
    assert _apply(frame, week_ending_sunday(F.col("d"))) == expected


def test_date_key_and_period(spark):
    frame = spark.createDataFrame([(0, dt.datetime(2018, 3, 7, 23, 59))], "i int, d timestamp_ntz")
    assert _apply(frame, date_key(F.col("d"))) == [20180307]
    assert _apply(frame, period_label(F.year("d"), F.month("d"))) == ["2018-03"]


def test_rounding_is_half_away_from_zero_on_decimals(spark):
    values = ["0.125", "-0.125", "2.675", "1.005"]
    frame = spark.createDataFrame([(i, Decimal(v)) for i, v in enumerate(values)], "i int, v decimal(10,3)")
    assert _apply(frame, exact_ratio(F.col("v"), F.lit(1))) == [Decimal("0.13"), Decimal("-0.13"), Decimal("2.68"), Decimal("1.01")]


def test_ratios_without_rows(spark):
    frame = spark.createDataFrame([(0, None, 0)], "i int, part long, whole long")
    assert _apply(frame, percent(F.col("part"), F.col("whole"))) == [None]
    assert _apply(frame, audit_percent(F.col("part"), F.col("whole"))) == [0.0]


def test_mean_of_integers_is_exact(spark):
    frame = spark.createDataFrame([(1,), (2,), (2,)], "v int")
    assert frame.agg(exact_ratio(F.sum("v"), F.count("v"))).first()[0] == Decimal("1.67")


def test_wider_timestamps_and_whole_numbers(spark):
    rows = [("2017/01/02", None), ("20170102", None), ("2017-01-02 03:04:05.1234567", None), ("2017/13/02", None),
            ("20170102 03:04", None), ("x", "4.0000004"), ("y", "4.000"), ("z", "+7"), ("u", "1e3"), ("v", "12.5e0"), ("w", "99999999999")]
    frame = spark.createDataFrame(rows, "t string, n string").select(
        text.safe_timestamp(F.col("t")).cast("string").alias("t"), text.safe_int(F.col("n")).alias("n"))
    got = frame.collect()
    assert [r.t for r in got[:5]] == ["2017-01-02 00:00:00", "2017-01-02 00:00:00", "2017-01-02 03:04:05.123456", None, "2017-01-02 03:04:00"]
    assert [r.n for r in got[5:]] == [None, 4, 7, 1000, None, None]
