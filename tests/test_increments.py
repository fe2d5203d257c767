"""Batches that extend the warehouse, and the key index of the staging tables."""

from __future__ import annotations

import os
import time

import pytest
from pyspark.sql import functions as F, types as T

from marketlens.operators import key_index
from marketlens.operators.constraints import ConstraintViolation
from marketlens import registry
from marketlens.plans import increments, kpis, warehouse
from marketlens.plans.increments import publish_batches
from marketlens.schemas import DATASETS, STAGING_SCHEMAS, SURROGATE_KEYS
from marketlens.session import SHUFFLE_CLEANUP, materialize, scratch_path, scratch_root, shuffles_deleted, stored_once
from marketlens.sources import catalog
from marketlens.sources.versioned import current_parts, current_version, expire_versions
from marketlens.streaming.ingest import batch_counts, read_increments, start_ingest
from tests.conftest import at, item, order, payment, review

CUSTOMERS = "customer_id,customer_unique_id,customer_zip_code_prefix,customer_city,customer_state\n"
KEY = T.StructType([T.StructField("customer_id", T.StringType())])


def deliver(spark, staged, number, **tables):
    """One finished batch per table, as the stream would have written it."""
    for table, rows in tables.items():
        frame = spark.createDataFrame(rows, STAGING_SCHEMAS[table])
        frame.write.parquet(f"{staged}/{table}/_stream=s/_batch={number}")


FIRST = dict(
    customers=[("c1", "ann", "1", "a", "A")], sellers=[("s1", "1", "a", "A")],
    products=[("p1", "beleza", 1, 1, 1, 1.0, 1.0, 1.0, 1.0)], category_translation=[("beleza", "health")],
    orders=[order("o1", "c1", "2018-01-10T08:00:00"), order("o2", "c2", "2018-01-31T23:00:00"), order("o9", "c1", "2015-01-31T23:00:00"),
            order("o8", "ghost", "2018-01-31T23:00:00")],
    order_items=[item("o1", 1, "p1", "s1", "10.00"), item("o2", 1, "p2", "s1", "30.00"), item("o2", 2, "p1", "s2", "5.00")],
    order_payments=[payment("o1", 1, "7.50"), payment("o2", 1, "30.00")],
    order_reviews=[review("r1", "o1", 5)],
)
SECOND = dict(
    customers=[("c2", "bob", "2", "b", "B")], sellers=[("s2", "2", "b", "B")],
    products=[("p2", "saude", 1, 1, 1, 1.0, 1.0, 1.0, 1.0)],
    orders=[order("o3", "c2", "2018-03-01T00:00:00")],
    order_items=[item("o3", 1, "p2", "s2", "40.00"), item("o1", 2, "p1", "s1", "2.00")],
    order_payments=[payment("o1", 2, "2.50"), payment("o3", 1, "40.00")],
    order_reviews=[review("r2", "o1", 2), review("r3", "o2", 4)],
)


def views(star):
    return {name: sorted(map(str, view(star).collect())) for name, view in kpis.VIEWS.items()}


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("increments")
    staged, root = str(folder / "staged"), str(folder / "warehouse")
    deliver(spark, staged, 0, **FIRST)
    first = publish_batches(spark, root, staged)
    before = {name: [tuple(r) for r in df.collect()] for name, df in first.items()}
    deliver(spark, staged, 1, **SECOND)
    publish_batches(spark, root, staged)
    return staged, root, before


def test_increment_equals_a_full_refresh(spark, built, tmp_path):
    staged, root, _ = built
    star = warehouse.open_star(spark, root)
    whole = {t: read_increments(spark, f"{staged}/{t}") for t in FIRST} | {"geolocation": None}
    full = warehouse.publish(spark, whole, str(tmp_path))
    assert views(star) == views(full)
    for name in warehouse.TABLES:
        columns = [c for c in full[name].columns if c not in SURROGATE_KEYS.values()]
        assert sorted(map(str, star[name].select(columns).collect())) == sorted(map(str, full[name].select(columns).collect())), name


def test_stored_rows_keep_their_keys_and_new_ones_are_unique(spark, built):
    _, root, before = built
    star = warehouse.open_star(spark, root)
    for name, key in SURROGATE_KEYS.items():
        rows = [tuple(r) for r in star[name].collect()]
        assert set(before[name]) <= set(rows)
        keys = [r[star[name].columns.index(key)] for r in rows]
        assert len(set(keys)) == len(keys)
    assert sorted(r.customer_key for r in star["dim_customers"].collect()) == [1, 2]


def test_late_references_wait_and_then_come_in(spark, built):
    _, root, before = built
    assert len(before["fact_orders"]) == 1 and len(before["fact_order_items"]) == 1
    assert sorted(r[0] for r in before["pending_orders"]) == ["o2", "o8"] and len(before["pending_order_items"]) == 2
    star = warehouse.open_star(spark, root)
    assert sorted(r.order_id for r in star["fact_orders"].collect()) == ["o1", "o2", "o3"]
    assert [r.order_id for r in star["pending_orders"].collect()] == ["o8"]
    assert star["fact_order_items"].count() == 5 and star["pending_order_items"].count() == 0


def test_only_new_batches_are_read_and_old_folders_stay(spark, built):
    staged, root, _ = built
    parts = current_parts(spark, root)
    assert len(parts["fact_orders"]) == len(parts["dim_customers"]) == 2 and len(parts["dim_date"]) == 1
    version = current_version(spark, root)
    publish_batches(spark, root, staged)
    assert current_version(spark, root) == version  # nothing new, nothing written
    assert warehouse.open_star(spark, root)["loaded_batches"].count() == len(FIRST) + len(SECOND)
    assert expire_versions(spark, root, keep=1) == []  # the first version's folders are still read
    assert warehouse.open_star(spark, root)["fact_orders"].count() == 3


@pytest.mark.parametrize("touched", [1, 3])
def test_joins_of_few_and_of_most_orders_are_refreshed(spark, tmp_path, monkeypatch, touched):
    staged, root, looked_up = str(tmp_path / "staged"), str(tmp_path / "warehouse"), []
    rows_of = increments._rows_of
    monkeypatch.setattr(increments, "_rows_of", lambda star, orders: looked_up.append(1) or rows_of(star, orders))
    names = [f"o{n}" for n in range(4)]
    deliver(spark, staged, 0, **FIRST | dict(
        orders=[order(o, "c1", "2018-01-10T08:00:00") for o in names], order_items=[item(o, 1, "p1", "s1", "10.00") for o in names]))
    publish_batches(spark, root, staged)
    deliver(spark, staged, 1, order_items=[item(o, 2, "p1", "s1", "2.00") for o in names[:touched]],
            order_payments=[payment("o0", 9, "1.00")])
    star = publish_batches(spark, root, staged)
    whole = {t: read_increments(spark, f"{staged}/{t}") for t in FIRST} | {"geolocation": None}
    assert views(star) == views(warehouse.publish(spark, whole, str(tmp_path / "full")))
    assert len(looked_up) == (touched == 1)


def test_unfinished_batches_wait(spark, tmp_path):
    staged = str(tmp_path / "staged")
    deliver(spark, staged, 0, customers=FIRST["customers"])
    (tmp_path / "staged" / "customers" / "_stream=s" / "_batch=1").mkdir()
    assert increments.finished_batches(spark, f"{staged}/customers") == ["_stream=s/_batch=0"]
    assert increments.finished_batches(spark, f"{staged}/none") == []


def test_rows_that_come_twice_are_added_once_and_bad_ones_stop_the_increment(spark, tmp_path):
    staged, root = str(tmp_path / "staged"), str(tmp_path / "warehouse")
    deliver(spark, staged, 0, **FIRST)
    publish_batches(spark, root, staged)
    deliver(spark, staged, 1, orders=FIRST["orders"], order_payments=FIRST["order_payments"], order_items=FIRST["order_items"])
    star = publish_batches(spark, root, staged)
    assert star["fact_orders"].count() == 1 and star["fact_payments"].count() == 2 and star["fact_order_items"].count() == 1
    before = current_version(spark, root)
    deliver(spark, staged, 2, order_reviews=[("r7", "o1", None, None, None, at("2018-03-01"), at("2018-03-02"))])
    with pytest.raises(ConstraintViolation):
        publish_batches(spark, root, staged)
    assert current_version(spark, root) == before


def test_tables_of_several_folders_are_registered_as_views(spark, built):
    _, root, _ = built
    catalog.create_namespaces(spark)
    for _ in range(2):
        catalog.register_version(spark, "analytics", root)
    assert spark.table("analytics.fact_orders").count() == 3 and spark.table("analytics.dim_date").count() == 1461
    assert catalog.table_exists(spark, "analytics", "fact_orders")


# --- disk ---------------------------------------------------------------------


def copies(spark):
    """The scratch copies of loads; numbered rows of dimensions aside."""
    return {name for name in os.listdir(scratch_root(spark)) if name.split("-")[0] in
            ("batch", "known", "repeated", "unknown", "touched", "lines", "fact_orders", "fact_order_items", "fact_payments", "fact_reviews")}


def test_loads_leave_no_copies_behind(spark, tmp_path):
    staged, root, before = str(tmp_path / "staged"), str(tmp_path / "warehouse"), copies(spark)
    deliver(spark, staged, 0, **FIRST)
    publish_batches(spark, root, staged)
    deliver(spark, staged, 1, **SECOND)
    publish_batches(spark, root, staged)
    deliver(spark, staged, 2, order_reviews=[("r7", "o1", None, None, None, at("2018-03-01"), at("2018-03-02"))])
    with pytest.raises(ConstraintViolation):
        publish_batches(spark, root, staged)
    folder = tmp_path / "in"
    folder.mkdir()
    for name in ("1.csv", "2.csv"):
        (folder / name).write_text(CUSTOMERS + "c1,u1,1,a,SP\nc1,u1,1,b,SP\n")
        start_ingest(spark, str(folder), DATASETS["customers"], str(tmp_path / "out"), str(tmp_path / "p"), key_parts=4).awaitTermination()
    assert read_increments(spark, str(tmp_path / "out")).count() == 1
    assert copies(spark) == before


def shuffle_files(spark):
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {f.getName() for f in (disk.getAllFiles().apply(i) for i in range(disk.getAllFiles().size())) if f.getName().startswith("shuffle_")}


def test_shuffle_files_of_a_load_go_with_each_write(spark, tmp_path):
    staged, written = str(tmp_path / "staged"), []
    deliver(spark, staged, 0, **FIRST)
    before, own = shuffle_files(spark), spark.conf.get(SHUFFLE_CLEANUP, None)
    with shuffles_deleted(spark):
        with shuffles_deleted(spark):
            materialize(spark.range(1000).groupBy(F.col("id") % 7).count(), "grouped")
        assert spark.conf.get(SHUFFLE_CLEANUP) == "true"
    publish_batches(spark, str(tmp_path / "warehouse"), staged)
    end = time.time() + 20
    while time.time() < end and (written := shuffle_files(spark) - before):
        time.sleep(0.2)  # they are deleted in the background
    assert not written
    assert spark.conf.get(SHUFFLE_CLEANUP, None) == own


def test_a_copy_goes_with_its_block(spark):
    with pytest.raises(ZeroDivisionError), stored_once(spark.range(3), "kept") as copy:
        (folder,) = {os.path.dirname(path.removeprefix("file://")) for path in copy.inputFiles()}
        assert copy.count() == 3 and all(path.endswith(".zstd.parquet") for path in copy.inputFiles())
        1 / 0
    assert not os.path.exists(folder)


def test_deliveries_are_packed_and_whole(spark, tmp_path):
    """Texts with quotes, line breaks and more rows than a file holds come through the packed files."""
    sf = str(tmp_path / "sf")
    orders = spark.range(1, 451).selectExpr(
        "id AS o_orderkey", "id % 7 AS o_custkey", "'F' AS o_orderstatus", "double(id) AS o_totalprice",
        "timestamp_ntz '1996-01-02 00:00:00' AS o_orderdate", "concat('\"1\"\n', id) AS o_orderpriority")
    orders.coalesce(1).write.parquet(f"{sf}/orders.parquet")
    raw, staged = scratch_path(spark, "raw"), scratch_path(spark, "staged")
    registry._deliver(spark, sf, raw, staged, {"order_reviews": "order_id % 2 = 0"})
    registry._deliver(spark, sf, raw, staged, {"order_reviews": "order_id % 2 = 1"})
    files = [name for name in os.listdir(f"{raw}/order_reviews") if name.startswith("part-")]
    assert files and all(name.endswith(".csv.gz") for name in files)
    titles = read_increments(spark, f"{staged}/order_reviews").filter("review_comment_title IS NOT NULL")
    assert sorted(r[0] for r in titles.select("review_comment_title").collect()) == sorted(
        f'"1"\n{n}' for n in range(1, 451) if n % 8 == 0 and n % 10)


# --- key index ---------------------------------------------------------------


def ids(spark, values):
    return spark.createDataFrame([(v,) for v in values], "customer_id string")


def test_index_reads_only_the_parts_it_needs(spark, tmp_path):
    folder, parts = str(tmp_path / "keys"), 16
    key_index.write_keys(ids(spark, [f"c{i}" for i in range(200)]), ["customer_id"], folder, "s", 0, parts)
    index = key_index.read_keys(spark, folder, KEY)
    batch = ids(spark, ["c7", "c7", "new", None])
    touched = {r[0] for r in batch.dropna().select(key_index.part_of(["customer_id"], parts)).collect()}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found = key_index.known_keys(index, batch, ["customer_id"], parts)
        assert [r.customer_id for r in found.collect()] == ["c7"]
        scans = [leaf for leaf in _leaves(found) if "FileScan" in leaf.toString()]
        assert [leaf.metrics().apply("numPartitions").value() for leaf in scans] == [len(touched)] and len(touched) < parts
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def _leaves(df):
    found = df._jdf.queryExecution().executedPlan().collectLeaves()
    return [found.apply(i) for i in range(found.size())]


def test_a_replayed_batch_replaces_its_own_keys(spark, tmp_path):
    folder = str(tmp_path / "keys")
    for values in (["a", "b"], ["b", "c"]):
        key_index.write_keys(ids(spark, values), ["customer_id"], folder, "s", 0, 4)
    key_index.write_keys(ids(spark, ["d"]), ["customer_id"], folder, "s", 1, 4)
    rows = key_index.read_keys(spark, folder, KEY).collect()
    assert sorted((r.customer_id, r._batch) for r in rows) == [("b", 0), ("c", 0), ("d", 1)]


def test_a_large_batch_writes_several_files_per_part(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(key_index, "FILE_KEYS", 10)
    folder, values = tmp_path / "keys", [f"c{n}" for n in range(200)]
    key_index.write_keys(ids(spark, values + ["c7", None]), ["customer_id"], str(folder), "s", 0, 4, 200)
    assert max(len(list(part.glob("*.parquet"))) for part in folder.glob("_stream=s/_batch=0/_part=*")) > 1
    found = [r.customer_id for r in key_index.read_keys(spark, str(folder), KEY).collect()]
    assert sorted(f for f in found if f) == sorted(values) and len(found) == 201


def test_index_of_a_table_that_has_none(spark, tmp_path):
    target, folder = str(tmp_path / "out"), tmp_path / "in"
    spark.createDataFrame([("c1", "u1", "1", "a", "SP")], DATASETS["customers"].schema).write.parquet(f"{target}/_stream=old/_batch=0")
    folder.mkdir()
    (folder / "1.csv").write_text(CUSTOMERS + "c1,u1,1,moved,SP\nc2,u2,1,b,SP\n,u3,1,c,SP\n")
    start_ingest(spark, str(folder), DATASETS["customers"], target, str(tmp_path / "p"), key_parts=4).awaitTermination()
    assert sorted((r.customer_id, r.customer_city) for r in read_increments(spark, target).collect()) == [("c1", "a"), ("c2", "b")]
    (counts,) = batch_counts(spark, target).collect()
    assert (counts.rows_read, counts.rejected_cells, counts.malformed_rows, counts.rows_added) == (3, 0, 0, 1)


def test_an_unfinished_index_is_not_used(spark, tmp_path):
    assert not key_index.has_index(spark, str(tmp_path / "none"))
    (tmp_path / "keys" / "_temporary").mkdir(parents=True)
    assert not key_index.has_index(spark, str(tmp_path / "keys"))
