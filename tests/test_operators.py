from __future__ import annotations

import hashlib
import random

import pandas as pd
import pytest
from pyspark.sql import Window, functions as F

from marketlens.operators import audits
from marketlens.operators.constraints import foreign_key_orphans
from marketlens.operators import dedupe
from marketlens.operators.dedupe import first_per_key, insert_or_ignore, merge_repeated, repeated_keys, surplus_rows
from marketlens.operators.keys import dense_keys, sparse_keys
from marketlens.operators.quantiles import bin_label, quantile_edges
from marketlens.operators.timeseries import complete_mean, growth_percent, lag_features, weekly_totals


def test_first_per_key_is_deterministic_and_skips_null_keys(spark):
    rows = [("a", "z", 1), ("a", "y", 9), ("a", None, 5), ("b", "x", 1), ("b", "x", 1), (None, "q", 1)]
    frame = spark.createDataFrame(rows, "k string, v string, n int").repartition(3)
    assert sorted(map(tuple, first_per_key(frame, "k").collect())) == [("a", None, 5), ("b", "x", 1)]


def test_first_per_key_matches_a_ranking_window_on_a_hot_key(spark):
    rng = random.Random(3)
    rows = [(0 if rng.random() < 0.4 else rng.randrange(50), rng.randrange(9), rng.randrange(9)) for _ in range(3000)]
    frame = spark.createDataFrame(rows, "k int, a int, b int")
    ranked = frame.withColumn("rn", F.row_number().over(Window.partitionBy("k").orderBy("a", "b"))).filter("rn = 1").drop("rn")
    assert sorted(first_per_key(frame, "k").collect()) == sorted(ranked.collect())


@pytest.mark.parametrize("few", [0, 2, 100])
def test_merging_repeated_keys_is_first_per_key(spark, monkeypatch, few):
    monkeypatch.setattr(dedupe, "FEW_KEYS", few)
    rows = [("a", 1, "z"), ("a", 1, "y"), ("a", 1, None), ("a", 2, "x"), ("b", 1, "q"), ("b", 1, "q"), (None, 1, "n"), (None, 1, "n"), ("c", None, "m")]
    frame = spark.createDataFrame(rows, "k string, n int, v string").repartition(3)
    repeated = repeated_keys(frame, "k", "n")
    assert sorted(map(tuple, repeated.collect())) == [("a", 1), ("b", 1)]
    for given in (frame, frame.filter("k <> 'b'"), frame.filter("n = 2")):
        merged = merge_repeated(given, repeated_keys(given, "k", "n"), "k", "n")
        assert sorted(map(tuple, merged.collect())) == sorted(map(tuple, first_per_key(given, "k", "n").collect()))
        assert merged.columns == frame.columns


def test_both_zeros_are_one_key_of_one_form(spark):
    frame = spark.createDataFrame([(-0.0, 1), (0.0, 2), (-0.0, 3), (1.0, 4)], "k double, n int")
    for given in (frame, frame.filter("n >= 3")):
        merged = merge_repeated(given, repeated_keys(given, "k"), "k")
        assert sorted(map(str, merged.collect())) == sorted(map(str, first_per_key(given, "k").collect()))


def test_only_rows_of_repeated_keys_are_shuffled(spark):
    frame = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    plan = merge_repeated(frame, repeated_keys(frame, "k"), "k")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_composite_keys(spark):
    frame = spark.createDataFrame([(1, 1, "b"), (1, 1, "a"), (1, 2, "c"), (1, None, "d")], "k int, j int, v string")
    assert sorted(map(tuple, first_per_key(frame, "k", "j").collect())) == [(1, 1, "a"), (1, 2, "c")]


def test_insert_or_ignore(spark):
    old = spark.createDataFrame([(1, "old"), (2, "old")], "k int, v string")
    new = spark.createDataFrame([(2, "new"), (3, "b"), (3, "a"), (None, "x")], "k int, v string")
    assert sorted(map(tuple, insert_or_ignore(old, new, "k").collect())) == [(1, "old"), (2, "old"), (3, "a")]


def test_surplus_counts_null_keys(spark):
    frame = spark.createDataFrame([(1, None), (1, None), (None, 2), (1, 1)], "a int, b int")
    assert frame.agg(surplus_rows(["a", "b"])).first()[0] == 1


def test_dense_keys_have_no_gap(spark):
    frame = spark.range(0, 1000, 1, 7).filter("id % 3 = 0").withColumnRenamed("id", "v")
    keyed = dense_keys(frame, "k", start=10)
    assert sorted(r.k for r in keyed.collect()) == list(range(11, 11 + 334))
    assert keyed.select("v").distinct().count() == 334


def test_sparse_keys_are_unique(spark):
    keyed = sparse_keys(spark.range(0, 1000, 1, 7), "k")
    assert keyed.select("k").distinct().count() == 1000


@pytest.mark.parametrize("seed", range(4))
def test_quintiles_match_pandas(spark, seed):
    rng = random.Random(seed)
    n = rng.choice([11, 100, 1501])
    top = rng.choice([40, 10**5, 10**9])
    values = [rng.randrange(-top, top) for _ in range(n)] + [7] * (n // 20)
    frame = spark.createDataFrame([(v,) for v in values], "v long")
    edges = quantile_edges(frame, {"v": 100}, 5)["v"]
    series = pd.Series(values) / 100
    expected = pd.qcut(series, 5, labels=[1, 2, 3, 4, 5]).astype(int)
    got = frame.select("v", bin_label(F.col("v") / 100, edges, [1, 2, 3, 4, 5]).alias("q")).collect()
    assert sorted((r.v, r.q) for r in got) == sorted(zip(values, expected))


def test_quintiles_of_two_measures_with_different_spans(spark):
    frame = spark.createDataFrame([(i, i * 10**7) for i in range(101)], "a long, b long")
    edges = quantile_edges(frame, {"a": 1, "b": 100}, 5)
    assert edges["a"] == [0, 20, 40, 60, 80, 100]
    assert edges["b"] == [x * 10**5 for x in edges["a"]]


def test_coinciding_edges_raise(spark):
    frame = spark.createDataFrame([(5,)] * 20 + [(6,)], "v long")
    with pytest.raises(ValueError, match="unique"):
        quantile_edges(frame, {"v": 1}, 5)


def _monthly(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")


def test_growth_uses_the_last_known_value(spark):
    values = [10.0, None, 15.0, 0.0, 5.0, 6.0]
    ordered = Window.orderBy("i")
    grown = _monthly(spark, values).select("i", growth_percent(F.col("v"), ordered).alias("g"))
    got = [r.g for r in grown.orderBy("i").collect()]
    expected = (pd.Series(values).ffill().pct_change() * 100).round(2)
    for mine, theirs in zip(got, expected):
        if pd.isna(theirs) or theirs in (float("inf"), float("-inf")):
            assert mine is None  # growth from zero is NULL here
        else:
            assert float(mine) == theirs


def test_complete_mean_waits_for_enough_values(spark):
    values = [1.0, 2.0, None, 4.0, 5.0, 6.0]
    window = Window.orderBy("i").rowsBetween(-2, 0)
    got = [r.m for r in _monthly(spark, values).select("i", complete_mean(F.col("v"), window, 3).alias("m")).orderBy("i").collect()]
    expected = [None if pd.isna(x) else x for x in pd.Series(values).rolling(3).mean()]
    assert got == expected


def test_weeks_and_lags_match_pandas(spark):
    rng = random.Random(5)
    days = pd.date_range("2017-01-01", "2017-09-30")
    rows = [("s", d.date(), float(rng.randrange(1000))) for d in days if not pd.Timestamp("2017-04-03") <= d <= pd.Timestamp("2017-05-14")]
    rows += [("s", rows[0][1], None), ("other", days[3].date(), None)]
    frame = spark.createDataFrame(rows, "series string, purchase_date date, revenue double")
    got = lag_features(weekly_totals(frame)).filter("series = 's'").orderBy("week_end").toPandas()
    series = pd.DataFrame(rows[:-1], columns=["series", "day", "revenue"])
    weekly = series.set_index(pd.to_datetime(series.day)).revenue.resample("W").sum()
    assert [d for d in got.week_end] == [d.date() for d in weekly.index]
    assert got.revenue.tolist() == weekly.tolist()
    for n in (1, 2, 3):
        assert got[f"lag_{n}"].fillna(-1).tolist() == weekly.shift(n).fillna(-1).tolist()
    pd.testing.assert_series_equal(got.rolling_mean_4, weekly.shift(1).rolling(4).mean().reset_index(drop=True), check_names=False)
    lonely = weekly_totals(frame).filter("series = 'other'").collect()
    assert [(str(r.week_end), r.revenue) for r in lonely] == [("2017-01-08", 0.0)]


def test_audits_on_planted_defects(spark, shop):
    missing = {(r.table_name, r.column_name): (r.missing_count, r.total_count, r.missing_pct) for r in audits.missing_values(shop).collect()}
    assert missing[("customers", "customer_id")] == (1, 7, 14.29)
    assert missing[("geolocation", "geolocation_lat")] == (0, 0, 0.0)
    duplicates = {r.table_name: (r.total_rows, r.duplicate_rows, r.duplicate_pct) for r in audits.duplicate_keys(shop).collect()}
    assert duplicates["customers"] == (7, 2, 28.57)
    assert duplicates["order_reviews"] == (4, 1, 25.0)
    assert duplicates["geolocation"] == (0, 0, 0.0)
    gate = {r.table_name: r.passed for r in audits.quality_gate(audits.missing_values(shop), audits.duplicate_keys(shop)).collect()}
    assert set(gate) == set(shop) and not any(gate.values())


def test_audits_skip_absent_tables(spark, shop):
    some = {"orders": shop["orders"]}
    assert audits.duplicate_keys(some).count() == 1
    assert {r.column_name for r in audits.value_rules(some).collect()} == {"order_approved_at", "order_delivered_customer_date"}
    with pytest.raises(ValueError):
        audits.value_rules({})


def test_value_rules(spark, make_staging):
    from tests.conftest import item, order, payment, review

    tables = make_staging(
        order_reviews=[review("a", "o", 0), review("b", "o", 6), review("c", "o", 5), review("d", "o", None)],
        order_items=[item("o", 1, "p", "s", "-0.01"), item("o", 2, "p", "s", "0.00", "-5.00"), item("o", 3, "p", "s", None)],
        order_payments=[payment("o", 1, "-1.00")],
        orders=[order("o", "c", "2018-01-02T00:00:00", delivered="2018-01-01T00:00:00", approved="2018-01-02T00:00:00")],
    )
    got = {r.rule_name: (r.total_rows, r.violations_count, r.violation_pct) for r in audits.value_rules(tables).collect()}
    assert got["Review score between 1 and 5"] == (4, 2, 50.0)
    assert got["Non-negative item price"] == (3, 1, 33.33)
    assert got["Non-negative freight value"] == (3, 1, 33.33)
    assert got["Non-negative payment value"] == (1, 1, 100.0)
    assert got["Non-negative payment installments"] == (1, 0, 0.0)
    assert got["Approval timestamp >= purchase timestamp"] == (1, 0, 0.0)
    assert got["Delivery timestamp >= purchase timestamp"] == (1, 1, 100.0)


def test_profile_counts_cells_and_repeated_rows(spark):
    frame = spark.createDataFrame([(1, None), (1, None), (None, None), (2, "x")], "a int, b string")
    row = audits.dataset_profile({"t": frame}).first()
    assert (row.row_count, row.column_count, row.missing_values, row.duplicate_rows) == (4, 2, 4, 1)


def test_profile_tells_long_and_nested_cells_apart(spark):
    long = "x" * 5_000
    rows = [(long + "a", [1.0], "k"), (long + "b", [1.0], "k"), (long + "a", [1.0], "k"), (long + "a", None, "k"), (None, [1.0], "k"),
            ("", [], "k"), (None, [], "k"), (hashlib.sha256((long + "a").encode()).hexdigest(), [1.0], "k")]
    frame = spark.createDataFrame(rows, "text string, `v e` array<double>, k string")
    row = audits.dataset_profile({"t": frame}).first()
    assert (row.row_count, row.column_count, row.missing_values, row.duplicate_rows) == (8, 3, 3, 1)


def test_all_audits_from_one_scan_of_each_table(spark, shop):
    counts = audits.audit_counts(shop)
    plan = counts._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") + plan.count("LocalRelation") == len(shop)
    assert {r.table_name for r in counts.collect()} == set(shop)
    assert sorted(audits.missing_of(counts).collect()) == sorted(audits.missing_values(shop).collect())
    assert sorted(audits.duplicates_of(counts).collect()) == sorted(audits.duplicate_keys(shop).collect())
    assert sorted(audits.broken_rules_of(counts).collect()) == sorted(audits.value_rules(shop).collect())


def test_a_single_audit_counts_only_what_it_needs(shop):
    assert "distinct" not in audits.missing_values(shop)._jdf.queryExecution().optimizedPlan().toString()
    keys = audits.duplicate_keys({"customers": shop["customers"]})._jdf.queryExecution().optimizedPlan().toString()
    assert "customer_city" not in keys.split("Aggregate")[1].split("\n")[0]


def test_copies_of_each_key_are_counted(spark):
    frame = spark.createDataFrame([("a", 2), ("a", 1), ("b", None), (None, 5), ("a", 1)], "k string, v int")
    assert sorted(map(tuple, first_per_key(frame, "k", copies="n").collect())) == [("a", 1, 3), ("b", None, 1)]
    assert sorted(map(tuple, first_per_key(frame.select("k"), "k", copies="n").collect())) == [("a", 3), ("b", 1)]


def test_orphans_count_rows_not_keys(spark):
    child = spark.createDataFrame([(1,), (9,), (9,), (None,)], "k int")
    parent = spark.createDataFrame([(1,), (1,)], "p int")
    assert foreign_key_orphans(child, "k", parent, "p").first()[0] == 2
