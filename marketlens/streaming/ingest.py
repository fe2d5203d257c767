"""Incremental ingest: new CSV files are added to a staging table exactly once per key."""

from __future__ import annotations

from contextlib import ExitStack

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from marketlens.operators.dedupe import merge_repeated, repeated_keys
from marketlens.operators.key_index import BATCH, PARTS, STREAM, build_index, has_index, known_keys, read_keys, write_keys
from marketlens.schemas import Dataset
from marketlens.session import SHUFFLE_CLEANUP, STORED, path_exists, stored_once
from marketlens.sources.csv_files import csv_options, text_schema, to_staging

_COUNTS = "rows_read bigint, rejected_cells bigint, malformed_rows bigint, rows_added bigint"


def read_increments(spark: SparkSession, folder: str) -> DataFrame:
    """The table built so far, without the columns that say how a row came."""
    return spark.read.parquet(folder).drop(STREAM, BATCH)


def batch_counts(spark: SparkSession, folder: str) -> DataFrame:
    """One row per batch: rows read, cells that did not fit their type, malformed lines, rows added."""
    return spark.read.schema(f"{_COUNTS}, {STREAM} string, {BATCH} bigint").parquet(_counts_folder(folder))


def _keys_folder(target: str) -> str:
    return f"{target}.keys"


def _counts_folder(target: str) -> str:
    return f"{target}.counts"


def start_ingest(
    spark: SparkSession,
    raw_dir: str,
    dataset: Dataset,
    target: str,
    checkpoint: str,
    files_per_batch: int = 1000,
    key_parts: int = PARTS,
) -> StreamingQuery:
    """Process every file that has arrived since the last run, then stop.

    A batch has a folder of its own, named by the stream's lasting id and the batch number, in the table, in
    the table's key index and in its counts.  It is compared with the keys of all other batches, of which only
    the parts it touches are read, and overwrites only its own folders: a batch that is replayed after a failure
    does not add its rows twice, and a stream that starts with a new checkpoint (or a second stream into the same
    table) neither repeats nor replaces what is there.  Streams into one table run one after another.  A table
    that was begun without an index gets one with its next batch.
    """
    stream = (
        spark.readStream.options(**csv_options(dataset.multiline))
        .option("maxFilesPerTrigger", files_per_batch)
        .schema(text_schema(dataset.schema.names))
        .csv(raw_dir)
    )
    names, keys = dataset.schema.names, list(dataset.business_key)
    key_schema = T.StructType([dataset.schema[k] for k in keys])
    stored_schema = T.StructType([*dataset.schema.fields, T.StructField(STREAM, T.StringType()), T.StructField(BATCH, T.LongType())])
    index = _keys_folder(target)

    def add_batch(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession  # the stream's own session
        session.conf.set(SHUFFLE_CLEANUP, "true")
        stream_id = session.sparkContext.getLocalProperty("sql.streaming.queryId")
        own = f"{STREAM}={stream_id}/{BATCH}={batch_id}"
        counts = Observation()
        observed = batch.observe(
            counts,
            F.count(F.lit(1)).alias("rows_read"),
            F.coalesce(F.sum("_rejected_cells"), F.lit(0)).cast("long").alias("rejected_cells"),
            F.count_if(F.col("_malformed")).alias("malformed_rows"),
        )
        if path_exists(session, target) and not has_index(session, index):
            build_index(session.read.schema(stored_schema).parquet(target), keys, index, key_parts)
        with ExitStack() as copies:
            # A batch is parsed anew, with all its columns, wherever it is used: everything else starts from one stored copy.
            rows = copies.enter_context(stored_once(observed.select(*names), "batch"))
            fresh = merge_repeated(rows, copies.enter_context(stored_once(repeated_keys(rows, *keys), "repeated")), *keys)
            if has_index(session, index):
                stored = read_keys(session, index, key_schema)
                others = stored.filter(~((F.col(STREAM) == stream_id) & (F.col(BATCH) == batch_id)))
                # Stored, these keys are broadcast if they are few, and the rows are not shuffled to be compared with them.
                known = copies.enter_context(stored_once(known_keys(others, rows, keys, key_parts), "known"))
                fresh = fresh.join(known, keys, "left_anti")
            fresh.write.mode("overwrite").options(**STORED).parquet(f"{target}/{own}")
        added = session.read.schema(dataset.schema).parquet(f"{target}/{own}")
        rows_added = added.count()
        write_keys(added, keys, index, stream_id, batch_id, key_parts, rows_added)
        seen = counts.get
        row = (seen["rows_read"], seen["rejected_cells"], seen["malformed_rows"], rows_added)
        session.createDataFrame([row], _COUNTS).coalesce(1).write.mode("overwrite").parquet(f"{_counts_folder(target)}/{own}")

    return (
        to_staging(stream, dataset).writeStream.foreachBatch(add_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
