"""Text cleaning and safe coercion as built-in column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

# Every character a full Unicode strip removes at the ends of a text.
STRIP_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Texts that mean "missing" once a cell has been stripped.
NULL_TOKENS = ("", "nan", "NaN", "None")

# Raw cells a CSV reader takes as missing before any cleaning.
READER_NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# A full date, optionally with a time of day; anything else is not a timestamp.
TIMESTAMP_SHAPE = r"^\d{4}-\d{1,2}-\d{1,2}([ T]\d{1,2}:\d{1,2}(:\d{1,2}(\.\d+)?)?)?\z"
# The same date written with slashes, or as eight digits.
OTHER_DATES = ((r"^(\d{4})/(\d{1,2})/(\d{1,2})(?=[ T]|\z)", "$1-$2-$3"), (r"^(\d{4})(\d{2})(\d{2})(?=[ T]|\z)", "$1-$2-$3"))

DIGITS = r"^[+-]?\d+\z"
WHOLE_NUMBER = r"^[+-]?\d+(\.0*)?\z"
EXPONENT_NUMBER = r"^[+-]?\d+(\.\d*)?[eE][+-]?\d+\z"


def strip_text(column: Column) -> Column:
    """Remove white space of every kind at both ends (``trim`` leaves tabs)."""
    return F.btrim(column, F.lit(STRIP_CHARS))


def null_tokens_to_null(column: Column) -> Column:
    return F.when(~column.isin(*NULL_TOKENS), column)


def reader_na_to_null(column: Column) -> Column:
    """Drop reader tokens by exact match, so a padded ``' NA '`` is kept as text."""
    return F.when(~column.isin(*READER_NA_TOKENS), column)


def reader_na_sql(name: str) -> str:
    """The same of a named column as SQL text, which builds faster for hundreds of columns."""
    tokens = ", ".join(f"'{token}'" for token in READER_NA_TOKENS)
    return f"CASE WHEN `{name}` NOT IN ({tokens}) THEN `{name}` END AS `{name}`"


def clean_text(column: Column) -> Column:
    return null_tokens_to_null(strip_text(column))


def safe_timestamp(column: Column) -> Column:
    """Parse a zone-less timestamp, to the microsecond; a text that is none becomes NULL.

    A cell that has the shape already, as nearly all have, is cast as it stands: the rest is ten times as slow.
    """
    text = strip_text(column)
    for shape, dashed in OTHER_DATES:
        text = F.regexp_replace(text, shape, dashed)
    shaped = F.regexp_extract(text, TIMESTAMP_SHAPE, 0)  # empty, and so no timestamp, for any other text
    return F.when(column.rlike(TIMESTAMP_SHAPE), column).otherwise(shaped).try_cast(T.TimestampNTZType())


def safe_int(column: Column) -> Column:
    """Accept ``4`` as well as ``4.0``, the form a nullable integer column is exported in.

    A text with a fraction is rejected rather than rounded; ``1e3`` counts if it is whole.
    """
    text = strip_text(column)
    digits = F.regexp_replace(text, r"\.0*\z", "").try_cast(T.IntegerType())
    number = text.try_cast(T.DecimalType(38, 18))
    scaled = F.when(number == F.floor(number), number.try_cast(T.IntegerType()))
    other = F.when(text.rlike(WHOLE_NUMBER), digits).when(text.rlike(EXPONENT_NUMBER), scaled)
    return F.when(column.rlike(DIGITS), column.try_cast(T.IntegerType())).otherwise(other)


def strip_leading_zeros(column: Column) -> Column:
    """The zip code a numeric CSV reader would have produced from digits."""
    digits = column.rlike(r"^[0-9]+\z")
    return F.when(digits, F.coalesce(F.nullif(F.ltrim(column, F.lit("0")), F.lit("")), F.lit("0"))).otherwise(column)


def coerce(column: Column, kind: T.DataType) -> Column:
    """Cast a raw text to ``kind``; a value that does not fit becomes NULL."""
    if isinstance(kind, T.StringType):
        return clean_text(column)
    if isinstance(kind, (T.TimestampNTZType, T.TimestampType)):
        return safe_timestamp(column)
    if isinstance(kind, T.IntegerType):
        return safe_int(column)
    return strip_text(column).try_cast(kind)
