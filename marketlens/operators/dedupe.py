"""One row per key, and insert-or-ignore, without ever sorting a whole key group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

#: So many repeated keys are few: they are broadcast, and only their rows are shuffled to be merged.
FEW_KEYS = 100_000


def first_per_key(df: DataFrame, *keys: str, copies: str | None = None) -> DataFrame:
    """Keep the smallest row per non-NULL key, comparing the other columns left to right.

    ``min`` over a struct combines on the map side, so a key that holds a third of
    all rows reaches the shuffle as one row per task; a ranking window would send
    the whole group to one task.  ``copies`` names a further column with the number
    of rows that had the key.
    """
    rest = [c for c in df.columns if c not in keys]
    keyed = df.dropna(subset=list(keys))
    if not rest and not copies:
        return keyed.distinct()
    merged = [F.min(F.struct(*rest)).alias("_first")] if rest else []
    counted = [F.count(F.lit(1)).alias(copies)] if copies else []
    picked = keyed.groupBy(*keys).agg(*merged, *counted)
    columns = [F.col(c) if c in keys else F.col(f"_first.{c}").alias(c) for c in df.columns]
    return picked.select(*columns, *([copies] if copies else []))


def repeated_keys(df: DataFrame, *keys: str) -> DataFrame:
    """The non-NULL keys that more than one row has; only keys are shuffled."""
    counted = df.dropna(subset=list(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    return counted.filter("_rows > 1").select(*keys)


def merge_repeated(df: DataFrame, repeated: DataFrame, *keys: str) -> DataFrame:
    """``first_per_key`` of rows of which the keys that may repeat are known, as a stored table.

    Rows of all other keys stay where they are.  Keys of floating point numbers are merged whole, since merging also
    gives the two zeros one form.
    """
    on = list(keys)
    floating = any(isinstance(df.schema[key].dataType, (T.DoubleType, T.FloatType)) for key in keys)
    count = 0 if floating else repeated.count()
    if floating or count > FEW_KEYS:
        return first_per_key(df, *keys)
    keyed = df.dropna(subset=on)
    if not count:
        return keyed
    merged = first_per_key(keyed.join(repeated, on, "left_semi"), *keys)
    return keyed.join(repeated, on, "left_anti").unionByName(merged)


def insert_or_ignore(existing: DataFrame, incoming: DataFrame, *keys: str) -> DataFrame:
    """Existing rows win; new keys are added once each.  ``existing`` holds each key once."""
    return existing.unionByName(new_keys_only(existing, incoming, *keys))


def new_keys_only(existing: DataFrame, incoming: DataFrame, *keys: str) -> DataFrame:
    """Incoming rows whose key is not there yet, one per key.

    The existing keys are narrowed to the incoming ones first: a small delivery is
    broadcast by its size and the big table is then only scanned, not shuffled.
    """
    return without_known(existing, first_per_key(incoming, *keys), *keys)


def without_known(existing: DataFrame, fresh: DataFrame, *keys: str) -> DataFrame:
    """The rows of ``fresh``, which holds each key once and is read twice, whose key is not there yet."""
    on = list(keys)
    seen = existing.select(*on).join(fresh.select(*on), on, "left_semi")
    return fresh.join(seen, on, "left_anti")


def surplus_rows(keys: Sequence[str | Column]) -> Column:
    """Rows beyond the first of each key.

    The key is a struct, so keys that are (partly) NULL count as keys too.
    """
    return F.count(F.lit(1)) - F.countDistinct(F.struct(*keys))
