"""Raw CSV files to typed staging tables."""

from __future__ import annotations

import re
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from marketlens.functions.text import clean_text, coerce, reader_na_sql, reader_na_to_null, strip_leading_zeros
from marketlens.operators.audits import profile_groups
from marketlens.schemas import DATASETS, Dataset
from marketlens.session import list_path
from marketlens.sources.quoted_csv import longest_file, read_quoted
from marketlens.sources.versioned import commit_version, new_version_path, open_current

CORRUPT = "_corrupt_record"
_ENTRY = "_entry"
_COUNTS = ("row_count", "missing_values", "duplicate_rows")
_SCHEME = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?/+"


def csv_options(multiline: bool) -> dict[str, str]:
    return {
        "header": "true",
        "quote": '"',
        "escape": '"',
        "multiLine": str(multiline).lower(),
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": CORRUPT,
        "enforceSchema": "false",
    }


def text_schema(columns: list[str]) -> T.StructType:
    """Every cell as text plus a place for lines with too many or too few cells."""
    return T.StructType([T.StructField(c, T.StringType()) for c in [*columns, CORRUPT]])


def read_raw(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """The header decides the columns and their order; a missing path raises.

    ``multiline``: cells may hold line breaks.  Files that are longer than a split are then cut into records by the
    parity of their quotes, shorter ones are read whole.
    """
    options = csv_options(multiline)
    header = spark.read.options(**options).csv(path).columns
    if multiline and longest_file(spark, path) > _split_bytes(spark):
        return read_quoted(spark, path, header, ", ".join(f"`{c}` string" for c in [*header, CORRUPT]), options)
    return spark.read.options(**options).schema(text_schema(header)).csv(path)


def _split_bytes(spark: SparkSession) -> int:
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    return spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(size)


def to_staging(raw: DataFrame, dataset: Dataset, legacy_zip: bool = False) -> DataFrame:
    """Clean and cast every column of the declared schema in one projection.

    ``_rejected_cells`` counts texts of the row that did not fit their type and
    became NULL.  ``legacy_zip`` drops the leading zeros of zip codes, as a reader
    that takes them for numbers does.
    """
    unknown = set(raw.columns) - set(dataset.schema.names) - {CORRUPT}
    if unknown:
        raise ValueError(f"{dataset.key}: columns {sorted(unknown)} are not in the declared schema")
    values, cells, rejected = [], [], [F.lit(0)]
    for field in dataset.schema.fields:
        if field.name not in raw.columns:
            values.append(F.lit(None).cast(field.dataType).alias(field.name))
            continue
        text = reader_na_to_null(F.col(field.name))
        value = coerce(text, field.dataType)
        if legacy_zip and field.name == dataset.zip_column:
            value = strip_leading_zeros(value)
        values.append(value.alias(field.name))
        if not isinstance(field.dataType, T.StringType):
            cell = f"_cell_{field.name}"
            cells.append(F.col(field.name).alias(cell))
            # Only the cell of a value that is missing is looked at again.
            lost = F.col(field.name).isNull() & clean_text(reader_na_to_null(F.col(cell))).isNotNull()
            rejected.append(lost.cast("int"))
    malformed = F.col(CORRUPT).isNotNull() if CORRUPT in raw.columns else F.lit(False)
    # The values are columns of their own, so that they are not calculated a second time for the count.
    return raw.select(*values, *cells, malformed.alias("_malformed")).select(
        *dataset.schema.names,
        sum(rejected[1:], rejected[0]).alias("_rejected_cells"),
        "_malformed",
    )


def load_dataset(spark: SparkSession, path: str, dataset: Dataset, root: str, legacy_zip: bool = False) -> dict[str, int]:
    """Full refresh of one staging table; readers see the old table until the new one is complete."""
    counts = Observation()
    rows = to_staging(read_raw(spark, path, dataset.multiline), dataset, legacy_zip).observe(
        counts,
        F.count(F.lit(1)).alias("rows_loaded"),
        F.coalesce(F.sum("_rejected_cells"), F.lit(0)).alias("rejected_cells"),
        F.count_if(F.col("_malformed")).alias("malformed_rows"),
    )
    version, target = new_version_path(f"{root}/{dataset.table}")
    table = rows.select(*dataset.schema.names)
    table.write.parquet(f"{target}/{dataset.table}")
    commit_version(spark, f"{root}/{dataset.table}", version, {dataset.table: table})
    return dict(counts.get)


_RESULT_SCHEMA = (
    "dataset string, table_name string, rows_loaded bigint, rejected_cells bigint, "
    "malformed_rows bigint, status string, error string"
)


def ingest(
    spark: SparkSession,
    raw_dir: str,
    root: str,
    files: Mapping[str, str] | None = None,
    datasets: Mapping[str, Dataset] = DATASETS,
    legacy_zip: bool = False,
) -> DataFrame:
    """Load every dataset; one that is unmapped, missing or broken is reported and the rest go on.

    ``files`` overrides the path of a dataset under ``raw_dir``.
    """
    paths = dict({key: d.file_pattern for key, d in datasets.items()} if files is None else files)

    def load(key: str) -> tuple:
        dataset = datasets.get(key)
        if dataset is None:
            return key, None, None, None, None, "unmapped", f"no table for dataset {key!r}"
        try:
            done = load_dataset(spark, f"{raw_dir}/{paths[key]}", dataset, root, legacy_zip)
        except Exception as error:
            return key, dataset.table, None, None, None, "failed", str(error).split("\n")[0]
        return (key, dataset.table, done["rows_loaded"], done["rejected_cells"], done["malformed_rows"],
                "loaded", None)

    # Datasets do not depend on each other, so their jobs share the cluster.
    with ThreadPoolExecutor(max_workers=4) as pool:
        results = list(pool.map(load, paths))
    return spark.createDataFrame(results, _RESULT_SCHEMA)


def open_staging(spark: SparkSession, root: str, datasets: Mapping[str, Dataset] = DATASETS) -> dict[str, DataFrame]:
    """The staging tables that have been loaded so far."""
    tables = {}
    for dataset in datasets.values():
        try:
            tables.update(open_current(spark, f"{root}/{dataset.table}"))
        except FileNotFoundError:
            continue
    return tables


def _entry_of(path: Column, raw_dir: str) -> Column:
    """The entry of ``raw_dir`` that a file belongs to, from the file's path."""
    depth = len(_parts(raw_dir))
    return F.split(F.regexp_replace(path, _SCHEME, ""), "/+")[depth]


def _parts(path: str) -> list[str]:
    return [part for part in re.sub(_SCHEME, "", path).split("/") if part]


def _long_entries(spark: SparkSession, raw_dir: str, paths: list[str]) -> set[str]:
    """Entries with a file that is longer than a split; only the listing is read."""
    files = spark.read.format("binaryFile").load(paths).filter(F.col("length") > _split_bytes(spark))
    return {r.entry for r in files.select(_entry_of(F.col("path"), raw_dir).alias("entry")).distinct().collect()}


def profile_files(spark: SparkSession, raw_dir: str, multiline: bool = True) -> DataFrame:
    """Profile every ``*.csv`` entry of a folder, in name order.

    An entry is a file, or a folder of files that belong together.  Cells that a
    reader takes as missing count as missing; text is not stripped.  Entries of one
    header are read in one scan and told apart by the path of their files; those with
    files longer than a split, where cells may hold line breaks, are read by themselves.
    """
    found = list_path(spark, raw_dir)
    paths = {path.rsplit("/", 1)[-1]: path for path, _, _ in found if path.endswith(".csv")}
    if not paths:
        raise FileNotFoundError(f"no CSV file in {raw_dir}")
    root = next(iter(paths.values())).rsplit("/", 1)[0]
    options = csv_options(multiline)
    with ThreadPoolExecutor(max_workers=8) as pool:
        headers = dict(zip(paths, pool.map(lambda path: tuple(spark.read.options(**options).csv(path).columns), paths.values())))
    long = _long_entries(spark, root, list(paths.values())) if multiline else set()

    groups: dict[tuple[str, ...], list[str]] = {}
    for name, header in headers.items():
        # Files without a byte have no header; there is nothing to read in them.
        if header:
            groups.setdefault(header + (name,) * (name in long), []).append(name)
    # The path is an escaped URI; a plus sign in it stands for itself.
    path = F.url_decode(F.replace(_entry_of(F.col("_metadata.file_path"), root), F.lit("+"), F.lit("%2B")))
    parts = []
    for names in groups.values():
        header = headers[names[0]]
        if names[0] in long:
            raw, entry = read_raw(spark, paths[names[0]], multiline), F.lit(names[0])
        else:
            raw, entry = spark.read.options(**options).schema(text_schema(list(header))).csv([paths[n] for n in names]), path
        parts.append(profile_groups(raw.select(*[F.expr(reader_na_sql(c)) for c in header], entry.alias(_ENTRY)), _ENTRY))
    listed = spark.createDataFrame([(name, len(header)) for name, header in headers.items()], "dataset string, column_count int")
    if not parts:
        parts = [listed.limit(0).selectExpr("dataset", *[f"0L AS {c}" for c in _COUNTS])]
    found = listed.join(reduce(DataFrame.unionByName, parts), "dataset", "left").na.fill(0, list(_COUNTS))
    return found.select("dataset", _COUNTS[0], "column_count", *_COUNTS[1:]).orderBy("dataset")
