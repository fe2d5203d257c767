"""Files with line breaks inside quotes, read in splits of every size, against Spark's reader that takes them whole."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from marketlens.sources.csv_files import CORRUPT, csv_options, read_raw, text_schema
from marketlens.sources.quoted_csv import read_records

HEADER = ["id", "text", "note"]
CELLS = ["", "plain", "a,b", "two\nlines", "\n", "\"", "\"\"\n\"", "é漢\U0001f600\n", "x\n\n\ny", " pad ", "many\n" * 9, "end\""]


def _cell(text: str) -> str:
    return '"' + text.replace('"', '""') + '"' if any(c in text for c in '",\n') else text


def _write(path, seed: int, n: int, line_end: str = "\n", last: str = "\n", extra: tuple[str, ...] = ()) -> None:
    rng = random.Random(seed)
    lines = [",".join(HEADER), *(",".join((str(i), _cell(rng.choice(CELLS)), _cell(rng.choice(CELLS)))) for i in range(n)), *extra]
    path.write_bytes((line_end.join(lines) + last).encode())


def _whole(spark, path):
    return spark.read.options(**csv_options(True)).schema(text_schema(HEADER)).csv(path)


def _rows(frame):
    return sorted(map(tuple, frame.collect()), key=str)


@pytest.fixture
def splits(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    yield lambda n: spark.conf.set("spark.sql.files.maxPartitionBytes", str(n))
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)


@pytest.mark.parametrize("size", [1, 2, 5, 13, 37, 101])
def test_every_split_gives_the_same_rows(spark, splits, tmp_path, size):
    """Small sizes put a split at every byte, so at every place a quote or break can be in."""
    _write(tmp_path / "a.csv", 1, 14)
    _write(tmp_path / "b.csv", 2, 9, last="")
    expected = _rows(_whole(spark, str(tmp_path)))
    splits(size)
    got = read_raw(spark, str(tmp_path), multiline=True)
    assert got.columns == [*HEADER, CORRUPT]
    assert _rows(got) == expected and len(expected) == 23


def test_windows_line_ends_malformed_lines_and_an_open_quote(spark, splits, tmp_path):
    _write(tmp_path / "a.csv", 3, 12, line_end="\r\n", last="\r\n")
    _write(tmp_path / "b.csv", 4, 6, extra=("1,2", "", "1,2,3,4", '7,"never\nclosed,x'), last="\n")
    for name in ("a.csv", "b.csv"):
        expected = _whole(spark, str(tmp_path / name)).collect()
        splits(40)
        got = read_raw(spark, str(tmp_path / name), multiline=True).collect()
        splits(1 << 20)
        # The reader that takes a file whole counts its last line break to a cell that is never closed.
        text = lambda r: r.text.rstrip("\n") if "never" in (r.text or "") else r.text
        cells = lambda rows: sorted(((r.id, text(r), r.note, r[CORRUPT] is None) for r in rows), key=str)
        assert cells(got) == cells(expected)


def test_a_long_record_over_many_splits_and_several_tasks(spark, splits, tmp_path):
    text = "line, with \"\"quotes\"\"\n" * 20_000
    (tmp_path / "a.csv").write_text("id,text,note\n1,a,b\n2,\"" + text + "\",c\n" + "3,\"x\ny\",d\n" * 5_000)
    splits(64 << 10)
    records = read_records(spark, str(tmp_path))
    assert records.select(F.spark_partition_id()).distinct().count() >= 3
    got = read_raw(spark, str(tmp_path), multiline=True)
    assert got.filter("id = 2").first().text == text.replace('""', '"')
    assert got.filter("id = 3 AND text = 'x\\ny' AND note = 'd'").count() == 5_000 and got.count() == 5_002


def test_another_header_in_one_file_raises(spark, splits, tmp_path):
    _write(tmp_path / "a.csv", 5, 20)
    (tmp_path / "b.csv").write_text("id,note,text\n1,2,3\n")
    splits(32)
    with pytest.raises(Exception, match="another header in"):
        read_raw(spark, str(tmp_path), multiline=True).collect()


def test_files_without_rows(spark, splits, tmp_path):
    (tmp_path / "a.csv").write_text("id,text,note\n")
    (tmp_path / "b.csv").write_text("id,text,note")
    splits(4)
    assert read_raw(spark, str(tmp_path), multiline=True).collect() == []
