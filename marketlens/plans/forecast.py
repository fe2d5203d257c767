"""Weekly demand forecast for any number of series with one pooled forest."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import partial

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from marketlens.functions.numeric import as_money
from marketlens.operators.timeseries import aligned, lag_features, mark_after, mark_last, weekly_totals
from marketlens.plans.kpis import CATEGORY, ORDER_LINES, Star, daily_revenue, order_lines, orders_with_cents
from marketlens.session import materialize

# The modelled period, the shortest usable history, split and horizon,
# and the forest's size, depth and seed.
PERIOD = ("2017-01-01", "2018-09-05")
MIN_WEEKS = 15
TEST_WEEKS = 8
HORIZON = 8
TREES, DEPTH, SEED = 100, 6, 42

FEATURES = ("lag_1", "lag_2", "lag_3", "rolling_mean_4")
TOTAL = "total"


def daily_series(star: Star, by: str | None = None) -> DataFrame:
    """(series, purchase_date, revenue).

    One series of all payments, or one per ``state`` (payments), ``seller`` or
    ``category`` (item prices).
    """
    if by not in (None, "state", *ORDER_LINES):
        raise ValueError(f"no series by {by!r}")
    if by is None:
        return daily_revenue(star).select(F.lit(TOTAL).alias("series"), "purchase_date", "revenue")
    day = F.to_date("purchase_timestamp").alias("purchase_date")
    if by == "state":
        per_record = (
            orders_with_cents(star, "customer_key", "purchase_timestamp")
            .groupBy("customer_key", day)
            .agg(F.sum("cents").alias("cents"))
        )
        sold = per_record.join(star["dim_customers"].select("customer_key", "customer_state"), "customer_key")
        series = F.col("customer_state")
    else:
        # Lines are stored per order and key; they shrink to (key, day) before a name is looked up.
        keys = ["seller_key"] if by == "seller" else list(CATEGORY)
        sold = (
            order_lines(star, by)
            .filter("in_orders")
            .groupBy(*keys, "purchase_date")
            .agg(F.sum("cents").alias("cents"))
        )
        if by == "seller":
            sold = sold.join(star["dim_sellers"].select("seller_key", "seller_id"), "seller_key")
            series = F.col("seller_id")
        else:
            series = F.coalesce(*CATEGORY, F.lit("unknown"))
    return (
        sold.filter(series.isNotNull())
        .groupBy(series.cast("string").alias("series"), "purchase_date")
        .agg(as_money(F.sum("cents")).alias("revenue"))
    )


def weekly_series(daily: DataFrame, period: tuple[str, str] = PERIOD) -> DataFrame:
    """Gap-filled weeks, cut to the modelled period afterwards."""
    first, last = (F.lit(d).cast("date") for d in period)
    return weekly_totals(daily).filter(F.col("week_end").between(first, last))


def with_history(weekly: DataFrame, min_weeks: int = MIN_WEEKS) -> tuple[DataFrame, DataFrame]:
    """Series long enough to model, and the skipped ones with their number of weeks."""
    counted = weekly.select("*", F.count(F.lit(1)).over(Window.partitionBy("series")).alias("weeks"))
    skipped = weekly.groupBy("series").agg(F.count(F.lit(1)).alias("weeks")).filter(F.col("weeks") < min_weeks)
    return counted.filter(F.col("weeks") >= min_weeks).drop("weeks"), skipped


def model_rows(weekly: DataFrame, test_weeks: int = TEST_WEEKS, by_date: bool = True) -> DataFrame:
    """Complete feature rows with ``is_test`` set on the last weeks.

    ``by_date`` cuts all series at one date, so that no row a pooled model learns from is later than one it is tested
    on; series that end earlier should be ``aligned`` before.  Otherwise each series has its own last weeks.
    """
    rows = lag_features(weekly).dropna(subset=list(FEATURES))
    return (mark_after if by_date else mark_last)(rows, test_weeks, "is_test")


def fit(train: DataFrame, trees: int = TREES, depth: int = DEPTH, seed: int = SEED) -> RandomForestRegressionModel:
    forest = RandomForestRegressor(
        featuresCol="features",
        labelCol="revenue",
        predictionCol="predicted",
        numTrees=trees,
        maxDepth=depth,
        seed=seed,
        featureSubsetStrategy="all",
        maxBins=128,
    )
    return forest.fit(_assembled(train).select("features", "revenue"))


def _assembled(df: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(df)


def predict(model: RandomForestRegressionModel, rows: DataFrame) -> DataFrame:
    return model.transform(_assembled(rows)).drop("features")


def forest_nodes(spark: SparkSession, model: RandomForestRegressionModel, path: str) -> DataFrame:
    """The forest as a table: a row per node, read from the model stored at ``path``, which must not exist.

    ``feature`` (a place in ``FEATURES``) and ``threshold`` say which child follows: ``left`` up to the threshold.  Leaves
    have neither, and ``left`` = -1.  The root of each tree is node 0.  The table is as large as the forest, at most
    ``TREES`` x (2^(``DEPTH`` + 1) - 1) rows, whatever the data.
    """
    model.save(path)
    nodes = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*")
    inner = F.col("leftChild") >= 0
    return nodes.select(
        F.col("treeID").alias("tree"),
        F.col("id").alias("node"),
        F.when(inner, F.col("split.featureIndex")).alias("feature"),
        F.when(inner, F.element_at("split.leftCategoriesOrThreshold", 1)).alias("threshold"),
        F.col("leftChild").alias("left"),
        F.col("rightChild").alias("right"),
        "prediction",
    )


def predict_nodes(nodes: DataFrame, rows: DataFrame, depth: int = DEPTH) -> DataFrame:
    """Adds ``predicted``, the mean over the trees of a node table, which built-in functions walk.

    The trees reach the rows as one scalar subquery, an array of arrays of nodes.  A forest of more than ``depth`` levels raises.
    """
    fields = ("node", "feature", "threshold", "left", "right", "prediction")
    trees = nodes.groupBy("tree").agg(F.array_sort(F.collect_list(F.struct(*fields))).alias("nodes"))
    forest = trees.agg(F.array_sort(F.collect_list(F.struct("tree", "nodes")))).scalar()
    features = F.array(*[F.col(c).cast("double") for c in FEATURES])
    step = "if(_x[t.nodes[at].feature] <= t.nodes[at].threshold, t.nodes[at].left, t.nodes[at].right)"
    leaf = "if(t.nodes[at].left < 0, t.nodes[at].prediction, double(raise_error('the forest is deeper than stated')))"
    mean = f"""aggregate(_forest, 0D, (total, t) -> total + aggregate(
        sequence(1, {depth}), 0, (at, n) -> if(t.nodes[at].left < 0, at, {step}), at -> {leaf})) / size(_forest)"""
    return rows.withColumns({"_forest": forest, "_x": features}).withColumn("predicted", F.expr(mean)).drop("_forest", "_x")


def evaluate(predicted: DataFrame, by_series: bool = False) -> DataFrame:
    error = F.col("revenue") - F.col("predicted")
    groups = ["series"] if by_series else []
    return predicted.groupBy(*groups).agg(
        F.count(F.lit(1)).alias("test_rows"),
        F.avg(F.abs(error)).alias("mae"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.avg("revenue").alias("mean_weekly_revenue"),
    )


Predictor = Callable[[DataFrame], DataFrame]


def four_week_mean(rows: DataFrame) -> DataFrame:
    """The mean of the four weeks before, the simplest predictor to compare a forest with."""
    return rows.withColumn("predicted", F.col("rolling_mean_4"))


def last_week(rows: DataFrame) -> DataFrame:
    return rows.withColumn("predicted", F.col("lag_1"))


def forecast(model: RandomForestRegressionModel | Predictor, weekly: DataFrame, horizon: int = HORIZON) -> DataFrame:
    """Feed each unrounded prediction back as the newest week, ``horizon`` times.

    ``model`` is a fitted forest, or any function that adds ``predicted`` to feature rows.

    A series carries its last four weeks in four columns, so a step is a projection
    of one row per series: no shuffle, no union and nothing to checkpoint.
    """
    guess = model if callable(model) else partial(predict, model)
    recent = [f"_recent_{n}" for n in range(1, 5)]
    latest = mark_last(lag_features(weekly), 1, "_is_last").filter("_is_last")
    state = latest.select(
        "series",
        F.col("week_end").alias("_last_week"),
        *[F.col(c).alias(r) for c, r in zip(("revenue", "lag_1", "lag_2", "lag_3"), recent)],
    )
    steps: list[str] = []
    for step in range(1, horizon + 1):
        featured = state.select(
            "*",
            *[F.col(r).alias(f"lag_{n}") for n, r in enumerate(recent[:3], 1)],
            (sum((F.col(r) for r in recent[1:]), F.col(recent[0])) / 4).alias("rolling_mean_4"),
        )
        guessed = guess(featured)
        steps.append(f"_step_{step}")
        state = guessed.select(
            "series",
            "_last_week",
            *steps[:-1],
            F.col("predicted").alias(steps[-1]),
            F.col("predicted").alias(recent[0]),
            *[F.col(older).alias(newer) for older, newer in zip(recent[:3], recent[1:])],
        )
    weeks = F.array(
        *[
            F.struct(
                F.date_add("_last_week", 7 * n).alias("purchase_date"),
                F.round(F.col(c), 2).alias("forecasted_revenue"),
            )
            for n, c in enumerate(steps, 1)
        ]
    )
    return state.select("series", F.inline(weeks))


@dataclass
class ForecastRun:
    rows: DataFrame
    skipped: DataFrame
    test: DataFrame
    evaluation: DataFrame
    forecast: DataFrame


def model_input(
    daily: DataFrame, period: tuple[str, str] = PERIOD, align: bool = True
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The feature rows, the weeks they come from, and the skipped series.

    Weekly rows are stored once: the fit, the evaluation and the forecast all start from that small table.
    """
    weekly = materialize(weekly_series(daily, period), "weekly-revenue")
    usable, skipped = with_history(weekly)
    if align:
        usable = materialize(aligned(usable), "aligned-revenue")
    return model_rows(usable, by_date=align), usable, skipped


def run_forecast(
    daily: DataFrame, period: tuple[str, str] = PERIOD, horizon: int = HORIZON, align: bool = True
) -> ForecastRun:
    """Weeks, features, split, fit, evaluation and forecast in one go.

    All series end with the last week of any (those long enough by their own weeks are filled with 0), one date cuts
    them, and all forecasts begin with the week after.  Without ``align`` each series keeps its own end and cut.  The
    model is not refitted on the test weeks.
    """
    rows, usable, skipped = model_input(daily, period, align)
    train = rows.filter(~F.col("is_test"))
    if train.isEmpty():
        raise ValueError("no series has enough weeks to model")
    model = fit(train)
    test = predict(model, rows.filter("is_test"))
    return ForecastRun(rows, skipped, test, evaluate(test), forecast(model, usable, horizon))
