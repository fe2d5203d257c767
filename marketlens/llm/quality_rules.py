"""Quality rules: a table of thresholds compiled into projections of built-in Spark functions.

Every signal of a text is an expression over its words and lines, so a document is judged in
the task that reads it: no shuffle, no user function.  Null, empty and blank texts have zero
words and fail the minimum length.  Repeated rows are judged alike, very long texts as a whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

BLANK = r"[\x20\x09-\x0D]+"
WINDOW = 8

#: Frequent function words of the four languages.
STOP_WORDS = (
    "the", "of", "and", "to", "in", "is", "that", "it", "for", "on", "with", "as", "was", "be", "by", "are",
    "der", "die", "und", "den", "das", "ist", "von", "zu", "ein", "mit", "dem", "nicht",
    "le", "la", "les", "des", "et", "un", "une", "que", "qui", "dans", "pour", "du",
    "de", "el", "los", "las", "en", "y", "por", "con", "una", "para", "del", "no",
)

#: (rule, signal, weight): the rule rejects a text if 100 * signal > weight * base.
#: The base is the words of the text, for line rules its lines that hold a word.
BASE_RULES = (("repeated_windows", "n_repeat_words", 30, "n_words"),)
METHOD_RULES = (
    ("symbols", "n_symbols", 30, "n_words"),
    ("duplicate_lines", "n_dup_lines", 50, "n_lines"),
    ("stutter", "n_stutters", 30, "n_words"),
    ("long_words", "word_chars", 1500, "n_words"),
)
#: (rule, signal, weight): rejects a text if 100 * signal < weight * words.
METHOD_FLOORS = (("short_words", "word_chars", 200), ("stop_words", "n_stop_words", 2))
MIN_WORDS = 20

SIGNALS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_stop_words", "n_stutters")


def _repeat_words(df: DataFrame) -> DataFrame:
    """Adds ``n_repeat_words``: words inside a window of eight words that the text holds twice or more.

    A 64-bit hash per window shows whether a text repeats any; only such texts sort their windows, by two hashes.
    """
    at = lambda i: [F.get("_hashes", i + k) for k in range(WINDOW)]
    starts = F.sequence(F.lit(0), F.col("n_words") - WINDOW)
    df = df.withColumn("_hashes", F.transform("_words", lambda w: F.xxhash64(w)))
    df = df.withColumn("_windows", F.when(F.col("n_words") > WINDOW, F.transform(starts, lambda i: F.xxhash64(*at(i)))))
    df = df.withColumn("_repeats", F.size(F.array_distinct("_windows")) < F.size("_windows"))
    second = lambda i: F.xxhash64(F.lit(WINDOW), *reversed(at(i)))
    sorted_windows = F.array_sort(F.transform(
        "_windows", lambda h, i: F.struct(h.alias("h"), second(i).alias("g"), i.alias("i"))))
    df = df.withColumn("_sorted", F.when(F.col("_repeats"), sorted_windows))

    def same(x: Column, j: Column) -> Column:
        other = F.get("_sorted", j)
        return (x["h"] == other["h"]) & (x["g"] == other["g"])

    repeated = F.filter("_sorted", lambda x, j: F.coalesce(same(x, j + 1), F.lit(False))
                        | ((j > 0) & F.coalesce(same(x, j - 1), F.lit(False))))
    places = F.array_sort(F.transform(repeated, lambda x: x["i"]))
    covered = F.aggregate(
        places, F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("n")),
        lambda a, i: F.struct(i.alias("last"), (a["n"] + F.least(F.lit(WINDOW), i - a["last"])).alias("n")),
        lambda a: a["n"])
    return df.withColumn("n_repeat_words", F.coalesce(F.when(F.col("_repeats"), covered), F.lit(0)).cast("long"))


def with_signals(df: DataFrame, text: str = "text") -> DataFrame:
    """All columns of ``df`` in the struct ``row``, beside one column per signal."""
    value = F.coalesce(F.col(text), F.lit(""))
    df = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), value.alias("_text"))
    lines = F.filter(F.split("_text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    df = df.withColumns({"_words": F.array_remove(F.split("_text", BLANK), ""), "_lines": lines})
    df = df.withColumns({
        "n_words": F.size("_words"),
        "word_chars": F.aggregate("_words", F.lit(0), lambda a, w: a + F.length(w)).cast("long"),
        "n_stop_words": F.size(F.filter("_words", lambda w: w.isin(*STOP_WORDS))).cast("long"),
        "n_stutters": F.size(F.filter("_words", lambda w, i: (i > 0) & (w == F.get("_words", i - 1)))).cast("long"),
        "n_symbols": (F.length("_text") - F.length(F.regexp_replace("_text", r"[#*$%&|<>]+", ""))).cast("long"),
        "n_lines": F.size("_lines").cast("long"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
    })
    return _repeat_words(df).select("row", *[F.col(c).cast("long").alias(c) for c in SIGNALS])


def _any(conditions: list[Column]) -> Column:
    found = F.lit(False)
    for c in conditions:
        found = found | c
    return found


def verdicts() -> dict[str, Column]:
    """``base_failed`` and ``kept``, compiled from the tables above."""
    above = lambda rules: [100 * F.col(s) > w * F.col(base) for _, s, w, base in rules]
    failed = _any([F.col("n_words") < MIN_WORDS, *above(BASE_RULES)])
    worse = _any([*above(METHOD_RULES), *[100 * F.col(s) < w * F.col("n_words") for _, s, w in METHOD_FLOORS]])
    return {"base_failed": failed, "kept": ~failed & ~worse}


def judge(df: DataFrame, text: str = "text") -> DataFrame:
    """``row`` (the input), the signals, ``base_failed`` and ``kept``."""
    return with_signals(df, text).withColumns(verdicts())


def keep_good(df: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``df`` that pass every rule, with their own columns.

    The row number keeps the filter above the projections: below them, each of its terms would compute its own signals.
    """
    numbered = judge(df, text).withColumn("_n", F.monotonically_increasing_id())
    return numbered.filter(F.col("kept") & (F.col("_n") >= 0)).select("row.*")


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return judge(docs).select("row.doc_id", *SIGNALS, "base_failed", "kept")


def _sql_rules() -> str:
    above = [f"100 * {s} > {w} * {base}" for _, s, w, base in METHOD_RULES]
    return " OR ".join(above + [f"100 * {s} < {w} * n_words" for _, s, w in METHOD_FLOORS])


def oracle() -> str:
    stop = ", ".join(f"'{w}'" for w in STOP_WORDS)
    return rf"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT r, doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws,
             list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS ls FROM t),
p AS (SELECT r, ws, unnest(range(1, len(ws) - 6)) AS i FROM w WHERE len(ws) >= 8),
x AS (SELECT r, i, count(*) OVER (PARTITION BY r, array_to_string(ws[i:i + 7], ' ')) AS n FROM p),
c AS (SELECT r, count(DISTINCT j) AS n FROM (SELECT r, unnest(range(i, i + 8)) AS j FROM x WHERE n > 1) GROUP BY r),
s AS (SELECT doc_id, len(ws) AS n_words,
             coalesce(list_sum(list_transform(ws, lambda v: length(v))), 0)::BIGINT AS word_chars,
             (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
             (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
             coalesce(c.n, 0)::BIGINT AS n_repeat_words, len(ls)::BIGINT AS n_lines,
             len(list_filter(ws, lambda v: v IN ({stop})))::BIGINT AS n_stop_words,
             len(list_filter(ws, lambda v, i: i > 1 AND v = ws[i - 1]))::BIGINT AS n_stutters
      FROM w LEFT JOIN c USING (r)),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM s)
SELECT *, NOT base_failed AND NOT ({_sql_rules()}) AS kept FROM b"""
