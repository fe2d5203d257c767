"""URL filters by a cascade of Bloom filters: exact membership for every key of the corpus, without joins.

The keys of a URL are its host and all parent domains, each with the beginnings of its path that a list can
hold.  The first filter encodes the listed keys; the second those keys of the corpus that pass the first without
being listed; the third those listed keys that pass the second, and so on until nobody passes wrongly.  A key is
listed if the first filter that it fails has an even number (counting from one), or if it fails none and their
number is odd.  For keys of the corpus this is exact; the filters take a few bits per listed key.

Filters are built by Spark (bit positions grouped into bitmaps) and broadcast if they are within
``MAX_BYTES``; beyond that ``listed_keys`` joins the list to the keys instead, with equal results.

Hosts: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case.  Paths: from there up to
``?``, ``#`` or the end.  A null URL and one without ``://`` have empty ones and pass as allowed.  Repeated rows
are judged alike; other columns are left out.
"""

from __future__ import annotations

import dataclasses
import math
import string

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from marketlens.session import materialize

MAX_BYTES = 64 << 20
MAX_LEVELS = 200
BUCKET = 32768  # bits of one bitmap of ``bitmap_construct_agg``
U = np.uint64

#: Host, beginning of the path, verdict.
RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)
#: Names of bad sites, blocked under every top-level domain where no rule fits.
SITES = ("adult-x", "ads-track", "casino-win", "cheap-pills", "free-bets", "spam-farm")
#: Their domains under the usual ones; ``site_domains`` finds those under any other that the corpus has.
LISTED = tuple(f"{site}.example.{top}" for site in SITES for top in ("com", "net", "org"))


def host_and_path(url: Column) -> tuple[Column, Column]:
    rest = F.when(F.instr(url, "://") > 0, F.regexp_replace(url, r"(?s)^.*?://", "")).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), string.ascii_uppercase, string.ascii_lowercase)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def keys_of(host: Column, path: Column, lengths: list[int], most_labels: int) -> Column:
    """Domain suffixes of the host, each followed by the beginnings of the path that have the given lengths.

    Suffixes have ``most_labels`` labels at most, those of the longest listed domain, so a long host is linear.
    """
    labels = F.split(host, r"\.")
    first = F.greatest(F.lit(1), F.size(labels) - (most_labels - 1))
    suffixes = F.transform(F.sequence(first, F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    starts = F.array(*[F.substring(path, 1, n) for n in sorted(set(lengths))])
    every = F.flatten(F.transform(suffixes, lambda s: F.transform(starts, lambda p: F.concat(s, p))))
    return F.when(host != "", F.array_distinct(every)).otherwise(F.array().cast("array<string>"))


def hashed(key: Column) -> list[Column]:
    return [F.xxhash64(key).alias("a"), F.xxhash64(F.lit(1), key).alias("b")]


def bits_of(a: np.ndarray, b: np.ndarray, level: int, size: int, n: int) -> np.ndarray:
    """The ``n`` bit positions of each key at a level: a new hash of both halves for every level."""
    x = a.view(U) + b.view(U) * U(2 * level + 1) + U(level)
    for shift, times in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB), (31, 1)):
        x = (x ^ (x >> U(shift))) * U(times)
    step = (x >> U(17)) * U(0x9E3779B97F4A7C15) | U(1)
    return ((x[:, None] + step[:, None] * np.arange(n, dtype=U)) % U(size)).astype(np.int64)


@dataclasses.dataclass
class Level:
    size: int
    hashes: int
    bitmap: np.ndarray

    def passes(self, a: np.ndarray, b: np.ndarray, level: int) -> np.ndarray:
        at = bits_of(a, b, level, self.size, self.hashes)
        return (self.bitmap[at >> 3] >> (at & 7).astype(np.uint8) & 1).all(axis=1)


@dataclasses.dataclass
class Cascade:
    levels: list[Level]

    def holds(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        listed = np.full(len(a), len(self.levels) % 2 == 1)
        alive = np.arange(len(a))
        for i, level in enumerate(self.levels):
            ok = level.passes(a[alive], b[alive], i)
            listed[alive[~ok]] = i % 2 == 1
            alive = alive[ok]
        return listed


def _level(keys: DataFrame, n: int, share: float, number: int) -> Level:
    """A filter over the rows ``a, b`` that other keys pass with probability ``share``."""
    hashes = max(1, round(-math.log2(share)))
    size = max(64, math.ceil(n * hashes / math.log(2)))
    if size > 8 * MAX_BYTES:
        raise OverflowError("the filter is too large to broadcast")

    @F.pandas_udf("array<long>")
    def places(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series(list(bits_of(a.to_numpy(), b.to_numpy(), number, size, hashes)))

    bits = keys.select(F.explode(places("a", "b")).alias("bit")).select(
        (F.col("bit") / BUCKET).cast("long").alias("bucket"), (F.col("bit") % BUCKET).alias("at"))
    bitmap = np.zeros((size // BUCKET + 1) * BUCKET // 8, np.uint8)
    for r in bits.groupBy("bucket").agg(F.bitmap_construct_agg("at").alias("m")).toLocalIterator():
        part = np.frombuffer(bytes(r["m"]), np.uint8)
        bitmap[r["bucket"] * BUCKET // 8:][:len(part)] = part
    return Level(size, hashes, bitmap)


def _passing(keys: DataFrame, levels: list[Level]) -> Column:
    number = len(levels) - 1
    shared = keys.sparkSession.sparkContext.broadcast(levels[-1])

    @F.pandas_udf("boolean")
    def passes(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series(shared.value.passes(a.to_numpy(), b.to_numpy(), number))

    return passes("a", "b")


def build(listed: DataFrame, universe: DataFrame) -> Cascade:
    """The cascade for the listed keys over all keys of the corpus, both as rows ``a, b``.

    Each level stores the keys that pass it wrongly; the sets shrink by half, so there are about twice as many
    levels as the number of listed keys has binary digits.
    """
    inside = materialize(listed.select("a", "b").distinct(), "listed")
    outside = materialize(universe.select("a", "b").distinct().join(inside, ["a", "b"], "left_anti"), "others")
    n, m = inside.count(), outside.count()
    levels: list[Level] = []
    while n:
        share = min(0.5, max(n / (math.sqrt(2) * m), 1e-12)) if m and not levels else 0.5
        levels.append(_level(inside, n, share, len(levels)))
        if len(levels) > MAX_LEVELS:
            raise OverflowError("the cascade does not end")
        wrong = materialize(outside.filter(_passing(outside, levels)), "passed") if m else outside
        inside, outside, n, m = wrong, inside, wrong.count() if m else 0, n
    return Cascade(levels)


def listed_keys(urls: DataFrame, keys: Column, listed: DataFrame) -> DataFrame:
    """Adds ``listed``: those of the keys of each row that the list (column ``key``) holds.  ``urls`` has the column ``url``."""
    listed = listed.select("key").filter(F.col("key").isNotNull()).distinct()
    universe = urls.select(F.explode(F.array_distinct(keys)).alias("key")).distinct()
    try:
        cascade = build(listed.select(*hashed(F.col("key"))), universe.select(*hashed(F.col("key"))))
    except OverflowError:
        found = urls.select("url", F.explode(keys).alias("key")).distinct().join(listed, "key")
        found = found.groupBy("url").agg(F.collect_set("key").alias("listed"))
        return urls.join(found, "url", "left").withColumn("listed", F.coalesce("listed", F.array().cast("array<string>")))
    shared = urls.sparkSession.sparkContext.broadcast(cascade)

    @F.pandas_udf("array<boolean>")
    def holds(a: pd.Series, b: pd.Series) -> pd.Series:
        n = a.map(len).to_numpy()
        flat = [np.concatenate([*x.to_list(), np.zeros(0, np.int64)]).astype(np.int64) for x in (a, b)]
        return pd.Series(np.split(shared.value.holds(*flat), np.cumsum(n)[:-1]) if len(n) else [])

    urls = urls.withColumn("_keys", keys)
    both = [F.transform("_keys", lambda k: hashed(k)[0]), F.transform("_keys", lambda k: hashed(k)[1])]
    urls = urls.withColumn("_held", holds(*both))
    return urls.withColumn("listed", F.filter("_keys", lambda k, i: F.get("_held", i))).drop("_keys", "_held")


def site_domains(hosts: DataFrame) -> DataFrame:
    """``key``: the domains of the column ``host`` that are those of ``SITES``, whatever their top-level domain."""
    pattern = rf"(?:^|\.)((?:{'|'.join(SITES)})\.example\.[^.]+)$"
    return hosts.select(F.regexp_extract("host", pattern, 1).alias("key")).filter("key <> ''").distinct()


def judge(pages: DataFrame, rules=RULES, listed: DataFrame | None = None) -> DataFrame:
    """``page_id, host, path, rule, verdict``: the longest rule that fits, else blocked if a domain of the host is listed."""
    spark = pages.sparkSession
    host, path = host_and_path(F.col("url"))
    pages = pages.select("page_id", "url").withColumns({"host": host, "path": path})
    if listed is None:
        listed = spark.createDataFrame([(d,) for d in LISTED], "key string").unionByName(site_domains(pages))
    lengths = [0, *[len(p) for _, p, _ in rules]]
    named = spark.createDataFrame([(h + p,) for h, p, _ in rules], "key string")
    named = named.unionByName(listed.select("key"))
    domain = F.substring_index("key", "/", 1)
    most = named.agg(F.coalesce(F.max(F.size(F.split(domain, r"\."))), F.lit(1))).first()[0]
    found = listed_keys(pages, keys_of(F.col("host"), F.col("path"), lengths, max(1, most)), named)
    verdict_of = F.create_map(*[F.lit(x) for h, p, v in rules for x in (h + p, v)]) if rules else F.create_map().cast("map<string,string>")
    fitting = F.filter("listed", lambda k: verdict_of[k].isNotNull())
    longest = F.aggregate(fitting, F.lit(None).cast("string"), lambda best, k: F.when(
        best.isNull() | (F.length(k) > F.length(best)), k).otherwise(best))
    found = found.withColumn("rule", longest)
    hit = F.exists("listed", lambda k: verdict_of[k].isNull())
    verdict = F.coalesce(verdict_of[F.col("rule")], F.when(hit, "block").otherwise("allow"))
    return found.select("page_id", "host", "path", "rule", verdict.alias("verdict"))


def query(spark, sf_dir: str) -> DataFrame:
    return judge(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def oracle() -> str:
    fits = lambda h: f"(host = '{h}' OR ends_with(host, '.{h}'))"
    ordered = sorted(RULES, key=lambda r: -len(r[0] + r[1]))
    when = lambda value: " ".join(f"WHEN {fits(h)} AND starts_with(path, '{p}') THEN '{value(h, p, v)}'" for h, p, v in ordered)
    listed = " OR ".join(fits(h) for h in LISTED)
    upper, lower = string.ascii_uppercase, string.ascii_lowercase
    return f"""
WITH r AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN url[strpos(url, '://') + 3:] ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{upper}', '{lower}') AS host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM r)
SELECT page_id, host, path, CASE {when(lambda h, p, v: h + p)} END AS rule,
       CASE {when(lambda h, p, v: v)} WHEN {listed} THEN 'block' ELSE 'allow' END AS verdict FROM h"""
