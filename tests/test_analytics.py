from __future__ import annotations

import datetime as dt
import random
from decimal import Decimal
from functools import partial

import duckdb
import pytest
from pyspark.sql import functions as F

from marketlens.operators.timeseries import aligned
from marketlens.plans import forecast as fc, segments, trend

# Published monthly orders and revenue with growth and three-month mean.
PUBLISHED_MONTHS = (
    (2016, 9, "September", 4, "252.24", None, None),
    (2016, 10, "October", 324, "59090.48", "23326.29", None),
    (2016, 12, "December", 1, "19.62", "-99.97", "19787.45"),
    (2017, 1, "January", 800, "138488.04", "705751.38", "65866.05"),
    (2017, 2, "February", 1780, "291908.01", "110.78", "143471.89"),
    (2017, 3, "March", 2682, "449863.60", "54.11", "293419.88"),
    (2017, 4, "April", 2404, "417788.03", "-7.13", "386519.88"),
    (2017, 5, "May", 3700, "592918.82", "41.92", "486856.82"),
    (2017, 6, "June", 3245, "511276.38", "-13.77", "507327.74"),
    (2017, 7, "July", 4026, "592382.92", "15.86", "565526.04"),
    (2017, 8, "August", 4331, "674396.32", "13.84", "592685.21"),
    (2017, 9, "September", 4285, "727762.45", "7.91", "664847.23"),
    (2017, 10, "October", 4631, "779677.88", "7.13", "727278.88"),
    (2017, 11, "November", 7544, "1194882.80", "53.25", "900774.38"),
    (2017, 12, "December", 5673, "878401.48", "-26.49", "950987.39"),
    (2018, 1, "January", 7269, "1115004.18", "26.94", "1062762.82"),
    (2018, 2, "February", 6728, "992463.34", "-10.99", "995289.67"),
    (2018, 3, "March", 7211, "1159652.12", "16.85", "1089039.88"),
    (2018, 4, "April", 6939, "1160785.48", "0.10", "1104300.31"),
    (2018, 5, "May", 6873, "1153982.15", "-0.59", "1158139.92"),
    (2018, 6, "June", 6167, "1023880.50", "-11.27", "1112882.71"),
    (2018, 7, "July", 6292, "1066540.75", "4.17", "1081467.80"),
    (2018, 8, "August", 6512, "1022425.32", "-4.14", "1037615.52"),
    (2018, 9, "September", 16, "4439.54", "-99.57", "697801.87"),
    (2018, 10, "October", 4, "589.67", "-86.72", "342484.84"),
)


def test_published_growth_is_reproduced(spark):
    rows = [(y, m, name, n, Decimal(v)) for y, m, name, n, v, _, _ in PUBLISHED_MONTHS]
    frame = spark.createDataFrame(rows, "year int, month int, month_name string, total_orders long, total_revenue decimal(20,2)")
    got = trend.monthly_growth(frame).collect()
    assert [r.period for r in got] == [f"{y}-{m:02d}" for y, m, *_ in PUBLISHED_MONTHS]
    text = lambda v: None if v is None else str(v)
    assert [(text(r.mom_revenue_growth_pct), text(r.rolling_avg_3m_revenue)) for r in got] == [r[5:] for r in PUBLISHED_MONTHS]


def test_growth_per_group(spark):
    rows = [("a", 2018, 1, 10.0), ("a", 2018, 3, 15.0), ("b", 2018, 1, 4.0)]
    frame = spark.createDataFrame(rows, "g string, year int, month int, total_revenue double")
    got = {(r.g, r.period): r.mom_revenue_growth_pct for r in trend.monthly_growth(frame, ["g"]).collect()}
    assert got == {("a", "2018-01"): None, ("a", "2018-03"): Decimal("50.00"), ("b", "2018-01"): None}


def test_every_score_pair_has_the_expected_segment(spark):
    pairs = [(r, f) for r in range(1, 6) for f in (1, 3, 5)]
    frame = spark.createDataFrame(pairs, "r int, f int")
    got = {(x.r, x.f): x.s for x in frame.select("r", "f", segments.segment_name(F.col("r"), F.col("f")).alias("s")).collect()}
    assert got == {
        (5, 5): "Champions", (4, 5): "Champions", (3, 5): "Loyal Customers", (2, 5): "Can't Lose Them", (1, 5): "Can't Lose Them",
        (5, 3): "Loyal Customers", (4, 3): "Loyal Customers", (3, 3): "Loyal Customers", (2, 3): "At Risk", (1, 3): "At Risk",
        (5, 1): "New Customers", (4, 1): "Promising", (3, 1): "About to Sleep", (2, 1): "Hibernating", (1, 1): "Lost",
    }


def test_rules_that_no_score_reaches_still_exist(spark):
    frame = spark.createDataFrame([(4, 2), (3, 2), (2, 2), (1, 2)], "r int, f int")
    got = [x[0] for x in frame.orderBy(F.desc("r")).select(segments.segment_name(F.col("r"), F.col("f"))).collect()]
    assert got == ["Potential Loyalists", "Needs Attention", "Hibernating", "Lost"]


@pytest.fixture(scope="module")
def rfm(spark):
    rng = random.Random(11)
    rows = [(f"p{i}", i % 400, rng.choice([1, 1, 1, 2, 3, 5]), Decimal(rng.randrange(1, 10**6)) / 100) for i in range(800)]
    return spark.createDataFrame(rows, "customer_unique_id string, recency_days int, frequency long, monetary_value decimal(20,2)")


def test_scores_and_summary(spark, rfm):
    scored = segments.segment_customers(rfm)
    rows = scored.collect()
    assert {r.f_score for r in rows if r.frequency >= 3} == {5} and {r.f_score for r in rows if r.frequency == 2} == {3}
    assert all(r.rfm_score_code == f"{r.r_score}{r.f_score}{r.m_score}" for r in rows)
    assert max(r.recency_days for r in rows if r.r_score == 5) < min(r.recency_days for r in rows if r.r_score == 4)
    summary = segments.segment_summary(scored).collect()
    assert sum(r.customer_count for r in summary) == 800
    assert [r.customer_count for r in summary] == sorted((r.customer_count for r in summary), reverse=True)
    assert abs(sum(r.customer_pct for r in summary) - 100) < Decimal("0.1")
    assert abs(sum(r.revenue_pct for r in summary) - 100) < Decimal("0.1")


def test_approximate_scores_stay_close(rfm):
    exact = {r.customer_unique_id: r.m_score for r in segments.score_customers(rfm).collect()}
    near = {r.customer_unique_id: r.m_score for r in segments.score_customers(rfm, approximate=True).collect()}
    assert sum(exact[c] != near[c] for c in exact) < 10


def _daily(spark, series, days, start=dt.date(2017, 1, 2)):
    rng = random.Random(series)
    rows = [(series, start + dt.timedelta(days=i), float(rng.randrange(100, 1000))) for i in range(days)]
    return spark.createDataFrame(rows, "series string, purchase_date date, revenue double")


@pytest.fixture(scope="module")
def run(spark):
    daily = _daily(spark, "a", 300).unionByName(_daily(spark, "b", 200)).unionByName(_daily(spark, "short", 60))
    return fc.run_forecast(daily, ("2017-01-01", "2018-09-05"))


def test_short_series_are_skipped(run):
    assert [(r.series, r.weeks) for r in run.skipped.collect()] == [("short", 9)]


def test_one_date_splits_all_series(run):
    rows = run.rows.collect()
    cut = max(r.week_end for r in rows) - dt.timedelta(weeks=8)
    assert all(r.is_test == (r.week_end > cut) for r in rows)
    assert max(r.week_end for r in rows if not r.is_test) < min(r.week_end for r in rows if r.is_test)
    ends = {s: max(r.week_end for r in rows if r.series == s) for s in ("a", "b")}
    assert ends["a"] == ends["b"] and all(r.revenue == 0 for r in rows if r.series == "b" and r.week_end > dt.date(2017, 7, 23))
    assert sum(r.series == "b" and r.is_test for r in rows) == 8


def test_alignment_fills_up_to_the_last_week_of_any(spark):
    weekly = spark.createDataFrame(
        [("a", dt.date(2018, 1, 7), 1.0), ("a", dt.date(2018, 1, 14), 2.0), ("a", dt.date(2018, 1, 28), 3.0), ("b", dt.date(2018, 1, 14), 4.0)],
        "series string, week_end date, revenue double")
    got = sorted(map(tuple, aligned(weekly).filter("series = 'b'").collect()))
    assert got == [("b", dt.date(2018, 1, 14), 4.0), ("b", dt.date(2018, 1, 21), 0.0), ("b", dt.date(2018, 1, 28), 0.0)]
    assert aligned(weekly).count() == 6 and aligned(weekly.limit(0)).count() == 0


def test_split_by_series_takes_the_last_eight_weeks_of_each(spark):
    daily = _daily(spark, "a", 300).unionByName(_daily(spark, "b", 200))
    rows = fc.run_forecast(daily, ("2017-01-01", "2018-09-05"), align=False).rows.collect()
    for series in ("a", "b"):
        mine = sorted((r.week_end, r.is_test) for r in rows if r.series == series)
        assert [t for _, t in mine] == [False] * (len(mine) - 8) + [True] * 8


def test_forecast_shape(run):
    rows = run.forecast.collect()
    assert {r.series for r in rows} == {"a", "b"}
    for series in ("a", "b"):
        weeks = sorted(r.purchase_date for r in rows if r.series == series)
        last = max(r.week_end for r in run.rows.collect())
        assert weeks == [last + dt.timedelta(days=7 * n) for n in range(1, 9)]
    values = [r.revenue for r in run.rows.collect()]
    assert all(min(values) <= r.forecasted_revenue <= max(values) for r in rows)


def test_forecast_equals_step_by_step_prediction(spark):
    weekly = fc.weekly_series(_daily(spark, "a", 300), ("2017-01-01", "2018-09-05"))
    rows = fc.model_rows(weekly)
    model = fc.fit(rows.filter("NOT is_test"), trees=10)
    history = [r.revenue for r in weekly.orderBy("week_end").collect()]
    expected = []
    for _ in range(3):
        state = spark.createDataFrame(
            [(history[-1], history[-2], history[-3], sum(history[-4:]) / 4)],
            "lag_1 double, lag_2 double, lag_3 double, rolling_mean_4 double")
        history.append(fc.predict(model, state).first().predicted)
        expected.append(round(history[-1], 2))
    got = [r.forecasted_revenue for r in fc.forecast(model, weekly, 3).orderBy("purchase_date").collect()]
    assert got == pytest.approx(expected, abs=0.011)


NODES = """WITH RECURSIVE walk AS (
    SELECT n, tree, 0 AS node FROM xs, (SELECT DISTINCT tree FROM nodes)
    UNION ALL SELECT w.n, w.tree, CASE WHEN [lag_1, lag_2, lag_3, rolling_mean_4][CAST(feature AS BIGINT) + 1] <= threshold THEN "left" ELSE "right" END
    FROM walk w JOIN nodes k ON k.tree = w.tree AND k.node = w.node JOIN xs ON xs.n = w.n WHERE "left" >= 0)
SELECT n, avg(prediction) AS predicted FROM walk JOIN nodes USING (tree, node) WHERE "left" < 0 GROUP BY n ORDER BY n"""


def test_a_forest_as_a_table_predicts_like_the_model(spark, tmp_path):
    """A hundred trees, walked in Spark SQL and, from the exported table, in another engine."""
    rng = random.Random(8)
    data = [(i, *[float(rng.randrange(1000)) for _ in range(5)]) for i in range(300)]
    rows = spark.createDataFrame(data, "n long, lag_1 double, lag_2 double, lag_3 double, rolling_mean_4 double, revenue double")
    model = fc.fit(rows)
    nodes = fc.forest_nodes(spark, model, str(tmp_path / "model"))
    assert nodes.select("tree").distinct().count() == 100 and nodes.count() == model.totalNumNodes
    expected = {r.n: r.predicted for r in fc.predict(model, rows).collect()}
    walked = fc.predict_nodes(nodes, rows)
    assert {r.n: r.predicted for r in walked.collect()} == expected
    assert walked.columns == [*rows.columns, "predicted"]
    assert "Python" not in walked._jdf.queryExecution().executedPlan().toString()
    db = duckdb.connect()
    db.register("nodes", nodes.toPandas())
    db.register("xs", rows.toPandas())
    assert {n: p for n, p in db.execute(NODES).fetchall()} == pytest.approx(expected)
    with pytest.raises(Exception, match="deeper"):
        fc.predict_nodes(nodes, rows, depth=2).collect()


def test_forecast_from_the_table_equals_the_model(spark, tmp_path):
    weekly = fc.weekly_series(_daily(spark, "a", 300).unionByName(_daily(spark, "b", 280)), ("2017-01-01", "2018-09-05"))
    model = fc.fit(fc.model_rows(weekly).filter("NOT is_test"), trees=20)
    nodes = fc.forest_nodes(spark, model, str(tmp_path / "model"))
    stored = fc.forecast(partial(fc.predict_nodes, nodes), weekly)
    assert sorted(stored.collect()) == sorted(fc.forecast(model, weekly).collect()) and stored.count() == 16


def test_a_step_predicts_once(spark):
    weekly = fc.weekly_series(_daily(spark, "a", 300), ("2017-01-01", "2018-09-05"))
    model = fc.fit(fc.model_rows(weekly).filter("NOT is_test"), trees=2)
    plan = fc.forecast(model, weekly, 8)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("UDF(features") == 8


def test_evaluation_figures(spark):
    frame = spark.createDataFrame([("a", 10.0, 12.0), ("a", 20.0, 16.0)], "series string, revenue double, predicted double")
    row = fc.evaluate(frame).first()
    assert (row.test_rows, row.mae, row.mean_weekly_revenue) == (2, 3.0, 15.0)
    assert row.rmse == pytest.approx(10 ** 0.5)


def test_nothing_to_model(spark):
    with pytest.raises(ValueError):
        fc.run_forecast(_daily(spark, "x", 20), ("2017-01-01", "2018-09-05"))
