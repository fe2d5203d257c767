"""Records of CSV files with line breaks inside quotes, read in splits.

Spark's own reader gives such a file to one task, because a split can't tell whether it starts inside quotes.  Here
the quotes of each split are counted first; a running sum along the file says which splits start inside a quote, and
with that every split cuts its own lines into records.  Only a record that crosses from one split into the next
is put together after a shuffle; all others stay in the task that read them.

A quote character counts wherever it stands (a doubled one counts twice, which changes nothing), so quotes must
come in pairs within a record, as the format has it.  The last record of a file may be left open; it ends
before the file's last line break.

The driver holds one number and one flag per split, about 16 bytes for each ``spark.sql.files.maxPartitionBytes`` of input.
Both scans must be split alike.  Splits have that fixed size once there is more input than cores can hold at a time;
with less, a change of the number of cores between the scans is found and raised, never read wrongly.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

QUOTE = '"'
CUT = "path string, start long, n long, begins boolean, ends boolean, record string"


def _lines(spark: SparkSession, path: str) -> DataFrame:
    read = spark.read.option("lineSep", "\n").text(path)
    return read.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"), "value")


def split_parities(lines: DataFrame) -> DataFrame:
    """``path, start``: each split; ``inside``: whether it starts inside quotes; ``open``: whether it ends so."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit(QUOTE), F.lit("")))
    counted = lines.groupBy("path", "start").agg(F.sum(quotes).alias("quotes"))
    along = Window.partitionBy("path").orderBy("start")
    up_to = F.sum("quotes").over(along.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return counted.select("path", "start", ((up_to - F.col("quotes")) % 2 == 1).alias("inside"), (up_to % 2 == 1).alias("open"))


def _cut(lines: DataFrame, inside: dict[str, dict[int, bool]]) -> DataFrame:
    """Rows ``CUT``: the records of each split, and its pieces of records that begin or end elsewhere."""
    known = lines.sparkSession.sparkContext.broadcast(inside)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in CUT.split(", ")]
        at, quoted, begins, n, held = None, False, True, 0, []
        for batch in batches:
            out = []
            for path, start, line in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if (path, start) != at:
                    if held:
                        out.append((*at, n, begins, False, "\n".join(held)))
                    try:
                        quoted = known.value[path][start]
                    except KeyError:
                        raise ValueError(f"{path} was split in another way when its quotes were counted; read it again") from None
                    at, begins, n, held = (path, start), not quoted, 0, []
                held.append(line)
                quoted ^= line.count(QUOTE) % 2 == 1
                if not quoted:
                    out.append((path, start, n, begins, True, "\n".join(held)))
                    begins, n, held = True, n + 1, []
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names)
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([v]) for v in (*at, n, begins, False, "\n".join(held))], names)

    return lines.mapInArrow(run, CUT)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """``path``, ``is_first`` (the header's place) and ``record``, without the line break at its end; empty lines are left out."""
    lines = _lines(spark, path)
    # One row per file; all splits of one file are a few bytes each.
    per_file = split_parities(lines).groupBy("path").agg(F.collect_list(F.struct("start", "inside")).alias("splits"), F.max("open").alias("open"))
    files = per_file.collect()
    cut = _cut(lines, {f["path"]: {s["start"]: s["inside"] for s in f["splits"]} for f in files})
    first = (F.col("start") == 0) & (F.col("n") == 0)
    whole = cut.filter("begins AND ends").select("path", first.alias("is_first"), "record")
    if any(f["open"] for f in files):
        along = Window.partitionBy("path").orderBy("start", "n")
        pieces = cut.filter("NOT (begins AND ends)").withColumn("nth", F.sum(F.col("begins").cast("int")).over(along))
        parts = F.array_sort(F.collect_list(F.struct("start", "n", "record")))
        glued = pieces.groupBy("path", "nth").agg(F.max(first).alias("is_first"), parts.alias("parts"))
        whole = whole.unionByName(glued.select("path", "is_first", F.array_join("parts.record", "\n").alias("record")))
    return whole.withColumn("record", F.regexp_replace("record", r"\r$", "")).filter("record <> ''")


def longest_file(spark: SparkSession, path: str) -> int:
    """Bytes of the longest file; only the listing is read."""
    return spark.read.format("binaryFile").load(path).agg(F.coalesce(F.max("length"), F.lit(0))).first()[0]


def read_quoted(spark: SparkSession, path: str, header: list[str], schema: str, options: dict[str, str]) -> DataFrame:
    """The cells of all records but the header of each file, which must be ``header``."""
    records = read_records(spark, path)
    cells = F.from_csv("record", ", ".join(f"_{i} string" for i in range(len(header))), options)
    found = F.array(*[F.ltrim(cells[f"_{i}"], F.lit("﻿")) for i in range(len(header))])
    same = found == F.array(*[F.lit(c) for c in header])
    other = F.raise_error(F.concat(F.lit("another header in "), "path")).cast("boolean")
    rows = records.filter(F.when(~F.col("is_first"), True).when(same, False).otherwise(other))
    return rows.select(F.from_csv("record", schema, options).alias("row")).select("row.*")
