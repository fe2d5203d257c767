from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest

from marketlens.plans.quality import quality_report
from marketlens.schemas import DATASETS
from marketlens.sources.csv_files import ingest, open_staging, profile_files, read_raw, to_staging
from marketlens.sources.reports import write_report
from marketlens.streaming import ingest as stream
from marketlens.streaming.ingest import read_increments, start_ingest

CUSTOMERS = "customer_id,customer_unique_id,customer_zip_code_prefix,customer_city,customer_state\n"


@pytest.fixture
def raw(tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    (folder / "x_customers_dataset.csv").write_text(
        CUSTOMERS + 'c1,u1,"01310",\t sao paulo \t,SP\nc2,u2,00123, NA ,NA\nc3,nan,1,None,  \n', encoding="utf-8")
    (folder / "x_order_items_dataset.csv").write_text(
        "order_id,order_item_id,product_id,seller_id,shipping_limit_date,price,freight_value\n"
        "o1,1.0,p1,s1,2018-01-02 03:04:05,10.5,1\no1,2,p1,s1,soon,cheap,2.25\n", encoding="utf-8")
    (folder / "x_order_reviews_dataset.csv").write_text(
        "review_id,order_id,review_score,review_comment_title,review_comment_message,review_creation_date,review_answer_timestamp\n"
        'r1,o1,5,ok,"two\nlines, ""quoted""",2018-01-02 00:00:00,2018-01-03 00:00:00\nr2,o1,4.0,,,2018-01-02,\n', encoding="utf-8")
    (folder / "product_category_name_translation.csv").write_text(
        "﻿product_category_name,product_category_name_english\nbeleza,health\n", encoding="utf-8")
    (folder / "x_orders_dataset.csv").write_text("order_id,surprise\no1,1\n", encoding="utf-8")
    return str(folder)


def test_dirty_files(spark, raw, tmp_path):
    root = str(tmp_path / "staging")
    result = {r.dataset: r for r in ingest(spark, raw, root).collect()}
    assert result["customers"].status == "loaded" and result["customers"].rows_loaded == 3
    assert (result["order_items"].rows_loaded, result["order_items"].rejected_cells) == (2, 2)
    assert result["orders"].status == "failed" and "surprise" in result["orders"].error
    assert result["sellers"].status == "failed"  # no such file
    tables = open_staging(spark, root)
    assert set(tables) == {"customers", "order_items", "order_reviews", "category_translation"}
    assert sorted(map(tuple, tables["customers"].collect())) == [
        ("c1", "u1", "01310", "sao paulo", "SP"), ("c2", "u2", "00123", "NA", None), ("c3", None, "1", None, None)]
    items = sorted(map(tuple, tables["order_items"].collect()))
    assert items == [
        ("o1", 1, "p1", "s1", dt.datetime(2018, 1, 2, 3, 4, 5), Decimal("10.50"), Decimal("1.00")),
        ("o1", 2, "p1", "s1", None, None, Decimal("2.25"))]
    reviews = {r.review_id: r for r in tables["order_reviews"].collect()}
    assert reviews["r1"].review_comment_message == 'two\nlines, "quoted"'
    assert (reviews["r2"].review_score, reviews["r2"].review_comment_title, reviews["r2"].review_answer_timestamp) == (4, None, None)
    assert reviews["r2"].review_creation_date == dt.datetime(2018, 1, 2)
    assert tables["category_translation"].columns == ["product_category_name", "product_category_name_english"]
    assert tables["customers"].schema == DATASETS["customers"].schema


def test_reload_replaces_and_failure_keeps_the_old_table(spark, raw, tmp_path):
    root = str(tmp_path / "staging")
    ingest(spark, raw, root, files={"customers": "x_customers_dataset.csv"})
    ingest(spark, raw, root, files={"customers": "x_customers_dataset.csv"})
    assert open_staging(spark, root)["customers"].count() == 3
    row = ingest(spark, raw, root, files={"customers": "gone.csv", "weather": "w.csv"}).collect()
    assert [(r.dataset, r.status) for r in row] == [("customers", "failed"), ("weather", "unmapped")]
    assert open_staging(spark, root)["customers"].count() == 3


def test_legacy_zip(spark, raw):
    frame = to_staging(read_raw(spark, f"{raw}/x_customers_dataset.csv"), DATASETS["customers"], legacy_zip=True)
    assert sorted(r[0] for r in frame.select("customer_zip_code_prefix").collect()) == ["1", "123", "1310"]


def test_columns_are_matched_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text("seller_state,seller_id\nSP,s1\n")
    frame = to_staging(read_raw(spark, str(tmp_path / "a.csv")), DATASETS["sellers"])
    assert frame.select(*DATASETS["sellers"].schema.names).first() == ("s1", None, None, "SP")


def test_malformed_lines_are_counted(spark, tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    (folder / "s.csv").write_text("seller_id,seller_zip_code_prefix,seller_city,seller_state\ns1,1,x,SP\ns2,1\ns3,1,x,SP,extra\n")
    row = ingest(spark, str(folder), str(tmp_path / "st"), files={"sellers": "s.csv"}).first()
    assert (row.rows_loaded, row.malformed_rows) == (3, 2)


def test_profile_of_all_files(spark, raw):
    rows = {r.dataset: r for r in profile_files(spark, raw).collect()}
    assert list(rows) == sorted(rows)
    customers = rows["x_customers_dataset.csv"]
    assert (customers.row_count, customers.column_count) == (3, 5)
    assert customers.missing_values == 3  # "NA", "nan" and "None", not the padded " NA " or the blanks
    assert rows["product_category_name_translation.csv"].row_count == 1


def test_files_of_one_header_are_profiled_in_one_scan(spark, tmp_path):
    (tmp_path / "a b+c.csv").write_text('k,v\n1,"x\ny"\n1,"x\ny"\n2,NA\n')
    (tmp_path / "d%20é.csv").write_text("k,v\n1,x\n")
    (tmp_path / "heading.csv").write_text("k,v\n")
    (tmp_path / "nothing.csv").write_text("")
    (tmp_path / "other.csv").write_text("v,k\n,\n")
    (tmp_path / "notes.txt").write_text("k,v\n1,2\n")
    parts = tmp_path / "parts.csv"
    parts.mkdir()
    for n in range(3):
        (parts / f"part-{n}.csv").write_text("k,v\n7,same\n")
    frame = profile_files(spark, str(tmp_path))
    assert [tuple(r[c] for c in ("dataset", "row_count", "column_count", "missing_values", "duplicate_rows")) for r in frame.collect()] == [
        ("a b+c.csv", 3, 2, 1, 1), ("d%20é.csv", 1, 2, 0, 0), ("heading.csv", 0, 2, 0, 0), ("nothing.csv", 0, 0, 0, 0),
        ("other.csv", 1, 2, 2, 0), ("parts.csv", 3, 2, 0, 2)]
    plan = frame._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("] csv") == 2  # one scan of each header


def test_long_files_are_profiled_like_short_ones(spark, tmp_path):
    rows = "".join(f'{n % 50},"line {n % 50}\nnext, ""{n % 50}"""\n' for n in range(400))
    (tmp_path / "long.csv").write_text("k,v\n" + rows)
    (tmp_path / "short.csv").write_text('k,v\n1,"a\nb"\n')
    whole = profile_files(spark, str(tmp_path)).collect()
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        split = profile_files(spark, str(tmp_path)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted(split) == sorted(whole) and (whole[0].row_count, whole[0].duplicate_rows) == (400, 350)


def test_quality_report_files(spark, shop, tmp_path):
    report = quality_report(shop)
    assert {r.table_name for r in report.duplicate_issues.collect()} == {"customers", "orders", "order_reviews"}
    assert report.missing_issues.count() < report.missing.count()
    assert report.rule_issues.count() == 0
    report.write(str(tmp_path))
    back = spark.read.option("header", True).csv(str(tmp_path / "duplicate_rows_report"))
    assert back.columns == ["Schema", "Table", "Unique Keys", "Total Rows", "Duplicate Rows", "Duplicate %"]
    assert back.count() == 9
    assert len(list((tmp_path / "duplicate_rows_report").glob("part-*.csv"))) == 1


def test_report_is_one_sorted_file(spark, tmp_path):
    frame = spark.range(100, numPartitions=5).selectExpr("date_add(date'2018-01-01', int(id * 37 % 100)) AS purchase_date", "double(id) AS forecasted_revenue")
    path = write_report(frame, str(tmp_path), "weekly_demand_forecast", ["purchase_date"])
    lines = next((tmp_path / "weekly_demand_forecast").glob("part-*.csv")).read_text().splitlines()
    assert lines[0] == "purchase_date,forecasted_revenue" and lines[1:] == sorted(lines[1:])
    assert spark.read.option("header", True).csv(path).count() == 100


def test_increments_are_added_once(spark, tmp_path):
    folder, target, progress = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "progress")
    folder.mkdir()
    (folder / "1.csv").write_text(CUSTOMERS + "c1,u1,01310,a,SP\nc1,u1,01310,a,SP\nc2,u2,1,b,SP\n")
    start_ingest(spark, str(folder), DATASETS["customers"], target, progress).awaitTermination()
    (folder / "2.csv").write_text(CUSTOMERS + "c2,u2,1,moved,SP\nc3,u3,1, c ,SP\n,u4,1,d,SP\n")
    start_ingest(spark, str(folder), DATASETS["customers"], target, progress).awaitTermination()
    start_ingest(spark, str(folder), DATASETS["customers"], target, progress).awaitTermination()
    got = sorted((r.customer_id, r.customer_city) for r in read_increments(spark, target).collect())
    assert got == [("c1", "a"), ("c2", "b"), ("c3", "c")]


def test_new_checkpoint_and_second_stream_keep_stored_rows(spark, tmp_path):
    folder, other, target = tmp_path / "in", tmp_path / "other", str(tmp_path / "out")
    folder.mkdir()
    other.mkdir()
    (folder / "1.csv").write_text(CUSTOMERS + "c1,u1,1,a,SP\nc2,u2,1,b,SP\n")
    start_ingest(spark, str(folder), DATASETS["customers"], target, str(tmp_path / "p1")).awaitTermination()
    (folder / "2.csv").write_text(CUSTOMERS + "c3,u3,1,c,SP\n")
    start_ingest(spark, str(folder), DATASETS["customers"], target, str(tmp_path / "p2")).awaitTermination()
    (other / "1.csv").write_text(CUSTOMERS + "c2,u2,1,moved,SP\nc4,u4,1,d,SP\n")
    start_ingest(spark, str(other), DATASETS["customers"], target, str(tmp_path / "p3")).awaitTermination()
    got = sorted((r.customer_id, r.customer_city) for r in read_increments(spark, target).collect())
    assert got == [("c1", "a"), ("c2", "b"), ("c3", "c"), ("c4", "d")]


def test_cells_are_calculated_once_and_counted_as_before(spark, tmp_path):
    head = "order_id,order_item_id,product_id,seller_id,shipping_limit_date,price,freight_value\n"
    cells = ["NA", "", " ", " NA ", "None", "7", "+7", " 7\t", "7.0", "7.5", "1e3", "2018-01-02", "20180102", "2018/1/2 3:04", "2018", "x", "9e99"]
    (tmp_path / "i.csv").write_text(head + "".join(f"o{n},{c},p,s,{c},{c},1\n" for n, c in enumerate(cells)))
    frame = to_staging(read_raw(spark, str(tmp_path / "i.csv")), DATASETS["order_items"])
    day = dt.datetime(2018, 1, 2)
    seven, date = (7, None, Decimal(7), 1), lambda moment: (None, moment, None, 2)
    assert [(r.order_item_id, r.shipping_limit_date, r.price, r._rejected_cells) for r in sorted(frame.collect(), key=lambda r: int(r.order_id[1:]))] == [
        (None, None, None, 0), (None, None, None, 0), (None, None, None, 0), (None, None, None, 3), (None, None, None, 0),
        seven, seven, seven, seven, (None, None, Decimal("7.5"), 2), (1000, None, Decimal(1000), 1),
        date(day), (20180102, day, Decimal(20180102), 0),
        date(day.replace(hour=3, minute=4)), (2018, None, Decimal(2018), 1), (None, None, None, 3), (None, None, None, 3)]
    plan = to_staging(read_raw(spark, str(tmp_path / "i.csv")), DATASETS["order_items"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("as timestamp_ntz)") == 1 and plan.count("as decimal(10,2))") == 2


def test_later_batches_are_parsed_once(spark, tmp_path, monkeypatch):
    folder, target, progress, plans = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "progress"), []
    known = stream.known_keys

    def seen(index, batch, *rest):
        plans.append(batch._jdf.queryExecution().optimizedPlan().toString())
        return known(index, batch, *rest)

    monkeypatch.setattr(stream, "known_keys", seen)
    folder.mkdir()
    for n in range(2):
        (folder / f"{n}.csv").write_text(CUSTOMERS + f"c{n},u1,1,a,SP\nc{n + 1},u2,1,b,SP\n")
        start_ingest(spark, str(folder), DATASETS["customers"], target, progress).awaitTermination()
    assert len(plans) == 1 and "parquet" in plans[0] and "LogicalRDD" not in plans[0]
    assert sorted((r.customer_id, r.customer_city) for r in read_increments(spark, target).collect()) == [("c0", "a"), ("c1", "b"), ("c2", "b")]
