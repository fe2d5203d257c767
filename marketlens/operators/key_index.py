"""Keys of a growing table in hash parts, so that a batch reads only the parts its own keys fall into.

The index lies in a folder of its own: a folder per part of the key space, and in it one per batch that added
keys.  A part is a Spark partition column, so looking up a batch's keys prunes all other parts before any file
is opened.  With more parts than a batch has keys, or keys that arrive in runs, most of the index is never read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from marketlens.session import STORED, list_path, path_exists

PART, STREAM, BATCH = "_part", "_stream", "_batch"
PARTS = 256
#: Keys of a batch and part from which on the part gets more than one file.
FILE_KEYS = 500_000
_FILE = "_file"


def part_of(keys: Sequence[str], parts: int = PARTS) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(parts)).cast("int")


def write_keys(
    df: DataFrame, keys: Sequence[str], folder: str, stream: str, batch: int, parts: int = PARTS, rows: int = 0
) -> None:
    """Add the keys of a batch; a batch that is written again replaces its own keys only.

    With its number of ``rows`` known, a large batch writes several files per part, so that its tasks do not grow with it.
    """
    # The batch folder is the outer one, so a replay overwrites exactly what it wrote before.
    target = f"{folder}/{STREAM}={stream}/{BATCH}={batch}"
    files = 1 + rows // (parts * FILE_KEYS)
    marked = df.select(*keys, part_of(keys, parts).alias(PART), F.pmod(F.hash(*keys), F.lit(files)).alias(_FILE))
    # Equal keys share a part and a file, so they meet in the one shuffle that also deals out the parts.
    dealt = marked.repartition(parts * files, PART, _FILE) if files > 1 else marked.repartition(PART, _FILE)
    # Sorted keys share their beginnings, which the files' compression finds.
    once = dealt.distinct().drop(_FILE).sortWithinPartitions(PART, *keys)
    once.write.mode("overwrite").options(**STORED).partitionBy(PART).parquet(target)


def read_keys(spark: SparkSession, folder: str, keys: T.StructType) -> DataFrame:
    """All keys with the part, stream and batch they came with."""
    columns = [T.StructField(STREAM, T.StringType()), T.StructField(BATCH, T.LongType()), T.StructField(PART, T.IntegerType())]
    return spark.read.schema(T.StructType([*keys.fields, *columns])).parquet(folder)


def known_keys(index: DataFrame, batch: DataFrame, keys: Sequence[str], parts: int = PARTS) -> DataFrame:
    """The keys of ``batch`` that the index has, reading only the parts the batch touches.

    The touched parts are collected: at most ``parts`` numbers.
    """
    wanted = batch.dropna(subset=list(keys)).select(*keys)
    touched = sorted(r[0] for r in wanted.select(part_of(keys, parts).alias(PART)).distinct().collect())
    return index.filter(F.col(PART).isin(touched)).select(*keys).join(wanted, list(keys), "left_semi")


def build_index(df: DataFrame, keys: Sequence[str], folder: str, parts: int = PARTS) -> None:
    """The index of a table that was begun without one; ``df`` has the stream and batch of each row."""
    marked = df.select(*keys, STREAM, BATCH, part_of(keys, parts).alias(PART))
    marked.repartition(STREAM, BATCH, PART).write.mode("overwrite").partitionBy(STREAM, BATCH, PART).parquet(folder)


def has_index(spark: SparkSession, folder: str) -> bool:
    """Whether there is an index whose first write came to its end."""
    if not path_exists(spark, folder):
        return False
    names = [path.rsplit("/", 1)[-1] for path, _, _ in list_path(spark, folder)]
    return "_temporary" not in names and any(name.startswith(f"{STREAM}=") for name in names)
