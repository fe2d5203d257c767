"""Increments into the warehouse: newly delivered batches extend the current version instead of replacing it.

The staging tables are those that ``streaming.ingest`` builds: a folder per batch, each key once.  A version
remembers which batches it holds (``loaded_batches``), so only new folders are read.

* Dimensions: members that are new get the next keys; stored members keep their row.
* Facts: new rows whose references are known are appended, unless their key is there already (an anti join).
* Late references: orders of a customer, and lines of a product or seller, that has not arrived yet wait in
  ``pending_orders`` and ``pending_order_items`` and are tried again with every increment.
* Stored joins: the rows of the orders that an increment touches are calculated again; all others are kept.

Each of these is a new folder beside the folders of earlier versions, but for the pending rows and the stored
joins, which are written whole (they are narrow, and no order is shuffled to copy them).  Constraints are checked on what
is new before the version is committed; a failed increment leaves the current version in place and is tried again.

The result equals a full refresh over all batches, except that a stored dimension row is never changed: a product
keeps the category label it got when it was first loaded.  Surrogate keys differ from those of a full refresh.
"""

from __future__ import annotations

from collections.abc import Mapping
from concurrent.futures import Future, ThreadPoolExecutor
from contextlib import ExitStack
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from marketlens.operators.constraints import enforce, without_generated_keys
from marketlens.operators.dedupe import merge_repeated, new_keys_only, repeated_keys
from marketlens.operators.key_index import BATCH, STREAM
from marketlens.operators.keys import dense_keys, sparse_keys
from marketlens.plans import warehouse
from marketlens.plans.kpis import STORED_JOINS, Copy, Star, stored_join
from marketlens.schemas import STAGING_SCHEMAS, SURROGATE_KEYS
from marketlens.session import STORED, list_path, path_exists, scratch_root, shuffles_deleted, stored_once
from marketlens.sources.versioned import commit_version, current_parts, new_version_path, open_current

LOADED = "loaded_batches"
PENDING_ORDERS, PENDING_ITEMS = "pending_orders", "pending_order_items"
BOOKKEEPING = (LOADED, PENDING_ORDERS, PENDING_ITEMS)
FACT_KEYS = {
    "fact_orders": ("order_id",),
    "fact_order_items": ("order_id", "order_item_id"),
    "fact_payments": ("order_id", "payment_sequential"),
    "fact_reviews": ("review_id",),
}
_LOADED_SCHEMA = "table_name string, folder string"


def finished_batches(spark: SparkSession, folder: str) -> list[str]:
    """The batches of a staging table that were written to the end, as paths below its folder."""
    if not path_exists(spark, folder):
        return []
    name = lambda path: path.rsplit("/", 1)[-1]
    streams = [path for path, _, _ in list_path(spark, folder) if name(path).startswith(f"{STREAM}=")]
    batches = [path for stream in streams for path, _, _ in list_path(spark, stream) if name(path).startswith(f"{BATCH}=")]
    return ["/".join(path.rsplit("/", 2)[-2:]) for path in batches if path_exists(spark, f"{path}/_SUCCESS")]


def new_batches(spark: SparkSession, staging_root: str, loaded: DataFrame | None) -> DataFrame:
    """``table_name, folder`` of the finished batches that the current version does not hold."""
    found = [(table, folder) for table in STAGING_SCHEMAS for folder in finished_batches(spark, f"{staging_root}/{table}")]
    batches = spark.createDataFrame(found, _LOADED_SCHEMA)
    return batches if loaded is None else batches.join(loaded, ["table_name", "folder"], "left_anti")


def read_batches(spark: SparkSession, staging_root: str, folders: Mapping[str, list[str]]) -> dict[str, DataFrame]:
    """Staging tables of the given batches only; tables without any are empty."""
    def read(table: str) -> DataFrame:
        schema, paths = STAGING_SCHEMAS[table], [f"{staging_root}/{table}/{folder}" for folder in folders.get(table, [])]
        return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)
    return {table: read(table) for table in STAGING_SCHEMAS}


def _unresolved(rows: DataFrame, copy: Copy, *references: tuple[DataFrame, str]) -> DataFrame:
    """Rows with at least one reference that is named but not known yet.

    The unknown values alone are shuffled and stored; if they are few the rows are compared with them where they lie.
    """
    named = rows.dropna(subset=[key for _, key in references])
    left = named
    for number, (dimension, key) in enumerate(references):
        unknown = copy(named.select(key).distinct().join(dimension.select(key), key, "left_anti"), "unknown")
        left = left.join(unknown.withColumn(f"_unknown_{number}", F.lit(True)), key, "left")
    waits = reduce(lambda a, b: a | b, [F.col(f"_unknown_{n}").isNotNull() for n in range(len(references))])
    return left.filter(waits).select(*rows.columns)


def _rows_of(star: Star, orders: DataFrame) -> Star:
    """The star with the facts of some orders only."""
    return {**star, **{name: star[name].join(orders, "order_id", "left_semi") for name in FACT_KEYS}}


def publish_increment(
    spark: SparkSession,
    root: str,
    delta: dict[str, DataFrame],
    translation: DataFrame,
    calendar: tuple[str, str] = warehouse.DEFAULT_CALENDAR,
    batches: DataFrame | None = None,
) -> Star:
    """Extend the current version by newly staged rows; ``translation`` holds all category labels known so far."""
    current, parts = open_current(spark, root), current_parts(spark, root)
    version, path = new_version_path(root)
    scratch_root(spark)
    full: Star = dict(current)
    fresh: Star = {}
    # Counts of the full load say nothing about the rows that are added now.
    full.pop(warehouse.LOAD_COUNTS, None)
    parts.pop(warehouse.LOAD_COUNTS, None)

    def store(name: str, df: DataFrame) -> DataFrame:
        df.write.options(**STORED).parquet(f"{path}/{name}")
        return spark.read.schema(df.schema).parquet(f"{path}/{name}")

    def append(name: str, df: DataFrame) -> None:
        fresh[name] = store(name, df)
        full[name] = current[name].unionByName(fresh[name])
        parts[name] = [*parts[name], f"versions/{version}/{name}"]

    def replace(name: str, df: DataFrame) -> None:
        full[name] = store(name, df)
        parts[name] = [f"versions/{version}/{name}"]

    def last_key(name: str) -> int:
        return current[name].agg(F.coalesce(F.max(SURROGATE_KEYS[name]), F.lit(0))).first()[0]

    def extend(name: str, incoming: DataFrame, natural_id: str) -> None:
        new = new_keys_only(current[name], incoming, natural_id)
        append(name, dense_keys(new, SURROGATE_KEYS[name], last_key(name)))

    def add_facts(name: str, incoming: DataFrame, rows: DataFrame) -> None:
        # Only keys are shuffled to find those that are there already or come twice; they are stored, so that few of
        # them are broadcast to the rows.
        on = list(FACT_KEYS[name])
        keys = incoming.select(*on)
        with ExitStack() as scratch:
            copy = _copies(scratch)
            new = rows.join(copy(current[name].select(*on).join(keys, on, "left_semi"), "known"), on, "left_anti")
            new = merge_repeated(new, copy(repeated_keys(keys, *on), "repeated"), *on)
            append(name, sparse_keys(new, SURROGATE_KEYS[name], last_key(name)))

    waiting = lambda name, table: delta[table].unionByName(current[name]) if name in current else delta[table]
    orders, items = waiting(PENDING_ORDERS, "orders"), waiting(PENDING_ITEMS, "order_items")
    # Tables of one level do not depend on each other, so their jobs share the cluster.
    with ThreadPoolExecutor(max_workers=6) as pool:
        _all(pool.submit(extend, "dim_customers", warehouse.dim_customers(delta["customers"]), "customer_id"),
             pool.submit(extend, "dim_sellers", warehouse.dim_sellers(delta["sellers"]), "seller_id"),
             pool.submit(extend, "dim_products", warehouse.dim_products(delta["products"], translation), "product_id"),
             pool.submit(add_facts, "fact_payments", delta["order_payments"], warehouse.fact_payments(delta["order_payments"])),
             pool.submit(add_facts, "fact_reviews", delta["order_reviews"], warehouse.fact_reviews(delta["order_reviews"])))
        _all(pool.submit(add_facts, "fact_orders", orders, warehouse.fact_orders(orders, full["dim_customers"], calendar)),
             pool.submit(add_facts, "fact_order_items", items,
                         warehouse.fact_order_items(items, full["dim_products"], full["dim_sellers"])))
        checked = pool.submit(enforce, {**full, **{name: fresh[name] for name in FACT_KEYS}}, without_generated_keys())
        # One after another: each shuffles every order, and its shuffle files and copies are gone before the next one starts.
        # The joins come in the order of what they shuffle, so that the largest finds least on the disk.
        with ExitStack() as scratch:
            for name, table in _pending(orders, items, full, calendar, _copies(scratch)).items():
                replace(name, table)
        touched = reduce(DataFrame.unionByName, [fresh[name].select("order_id") for name in FACT_KEYS]).distinct()
        with stored_once(touched, "touched") as touched:
            base = {name: df for name, df in full.items() if name not in STORED_JOINS}
            # Half of the orders or more: all are calculated again, which gives the same rows without a lookup of the touched ones.
            again = _rows_of(base, touched) if 2 * touched.count() < full["fact_orders"].count() else base
            for name in reversed(STORED_JOINS):
                with ExitStack() as scratch:
                    copy = _copies(scratch)
                    if again is base or name not in current:
                        replace(name, stored_join(base, name, copy))
                    else:
                        kept = current[name].join(touched, "order_id", "left_anti")
                        replace(name, kept.unionByName(stored_join(again, name, copy)))
        checked.result()
    if batches is not None:
        if LOADED in current:
            append(LOADED, batches)
        else:
            replace(LOADED, batches)
    commit_version(spark, root, version, full, parts)
    return open_current(spark, root)


def _all(*jobs: Future) -> None:
    for job in jobs:
        job.result()


def _copies(scratch: ExitStack) -> Copy:
    return lambda df, label: scratch.enter_context(stored_once(df, label))


def _pending(orders: DataFrame, items: DataFrame, star: Star, calendar: tuple[str, str], copy: Copy) -> Star:
    """Rows that only lack a reference; orders outside the calendar never come in."""
    inside = warehouse.inside_calendar(F.col("order_purchase_timestamp"), calendar) & F.col("order_id").isNotNull()
    return {
        PENDING_ORDERS: _unresolved(orders.filter(inside), copy, (star["dim_customers"], "customer_id")),
        PENDING_ITEMS: _unresolved(items, copy, (star["dim_products"], "product_id"), (star["dim_sellers"], "seller_id")),
    }


def publish_batches(
    spark: SparkSession, root: str, staging_root: str, calendar: tuple[str, str] = warehouse.DEFAULT_CALENDAR
) -> Star:
    """Bring the warehouse up to date with every finished batch of the staging tables under ``staging_root``.

    The first call publishes all of it; later ones read the batches that came since.  Without new batches the
    current version stays.
    """
    with shuffles_deleted(spark), ExitStack() as scratch:
        begun = path_exists(spark, f"{root}/_committed")
        current = open_current(spark, root) if begun else {}
        batches = new_batches(spark, staging_root, current.get(LOADED))
        folders: dict[str, list[str]] = {}
        for row in batches.collect():
            folders.setdefault(row["table_name"], []).append(row["folder"])
        if begun and not folders:
            return current
        delta = read_batches(spark, staging_root, folders)
        known = {"category_translation": finished_batches(spark, f"{staging_root}/category_translation")}
        translation = read_batches(spark, staging_root, known)["category_translation"]
        if begun:
            return publish_increment(spark, root, delta, translation, calendar, batches)
        delta["category_translation"] = translation
        waiting = lambda star: {LOADED: batches, **_pending(delta["orders"], delta["order_items"], star, calendar, _copies(scratch))}
        return warehouse.publish(spark, delta, root, calendar, also=waiting)
