"""Language identification by prediction by partial matching.

Each language has a tree of byte contexts of up to three bytes with the counts of the bytes that followed.  A
byte is coded by the longest context known to the language; a context that has never seen the byte escapes to
the next shorter one (escape probability: distinct successors over successors and distinct successors), and
below all contexts a byte costs eight bits.  The statistics stay as trained, so the code length of a text under
a language is exact, and the shortest one wins.

Training reads whole labelled documents, about ``SAMPLE_DOCS`` per language, those with the smallest hash of
their id: a bounded sample on purpose.  Contexts that the sample holds less than ``LEAST_CONTEXT`` times are left out
of the trees.  Spark counts the four-byte strings of the sample; the driver compiles the
counts, whose number the sample bounds, into one table of costs (context, byte, language) that every task looks
up.  Prediction is one pass over all documents without a shuffle and sees the text alone.

A null text and a text without any letter get ``und`` and score 0, as does every text if nothing was learned.
Ties go to the first language in the alphabet.  Long texts are scored whole, in parts of ``CHUNK`` bytes.  Rows keep
their other columns; repeated rows get equal results.  A null id is neither held out nor learned from.
"""

from __future__ import annotations

import dataclasses
import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

SAMPLE_DOCS = 500
#: How many times the cost of a usual text of its language a text may have and still be kept.
TOLERANCE = 1.25
LEAST_CONTEXT = 2
ORDER = 3
PAD = b"\n" * ORDER
CHUNK = 1 << 17
UNKNOWN = "und"


def held_out(id_column: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(id_column).cast("string")) % 3 == 1, F.lit(False))


def _hashed(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "lang", "text").filter(F.col("lang").isNotNull() & F.col("doc_id").isNotNull()).withColumn(
        "_h", F.shiftrightunsigned(F.xxhash64("doc_id"), 34))


def _share(docs: DataFrame) -> DataFrame:
    """The rows with the least hashes, about ``SAMPLE_DOCS`` of each language: those below a bound set from its count of rows."""
    sizes = docs.groupBy("lang").count().collect()
    taken = F.lit(False)
    for r in sizes:
        bound = min(1 << 30, math.ceil((1 << 30) * SAMPLE_DOCS / r["count"]))
        taken = taken | ((F.col("lang") == r["lang"]) & (F.col("_h") < bound))
    return docs.filter(taken).select("lang", "text")


def sample(docs: DataFrame) -> DataFrame:
    """Labelled documents to learn from, about ``SAMPLE_DOCS`` per language."""
    return _share(_hashed(docs).filter(~held_out()))


def usual_costs(docs: DataFrame, model: Model) -> dict[str, float]:
    """Bits a byte that hardly any labelled document of a language exceeds, from all that weren't learned from."""
    rows = docs.filter(F.col("lang").isNotNull() & held_out()).select(F.col("lang").alias("_lang"), "text")
    judged = predict(rows, model).filter(F.col("lang_pred") == F.col("_lang"))
    found = judged.groupBy("_lang").agg(F.percentile_approx("bits_per_byte", 0.98, 1000).alias("bits")).collect()
    return {r["_lang"]: TOLERANCE * r["bits"] for r in found}


def gram_counts(texts: DataFrame) -> DataFrame:
    """``lang, gram, n``: how often each string of four bytes occurs, texts being preceded by three line feeds."""
    def run(batches):
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for i, (lang, text) in enumerate(zip(batch.column("lang").to_pylist(), texts, strict=True)):
                data = np.frombuffer(PAD + (text or "").encode(), np.uint8).astype(np.uint32)
                grams = data[:-3] << 24 | data[1:-2] << 16 | data[2:-1] << 8 | data[3:]
                found, n = np.unique(grams, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(found), pa.string()), pa.array(found.astype(np.int64)), pa.array(n.astype(np.int64))],
                    ["lang", "gram", "n"])
    counted = texts.mapInArrow(run, "lang string, gram long, n long")
    return counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


@dataclasses.dataclass
class Model:
    """``nodes``: the longest known context of any three symbols; ``costs``: bits of (context, symbol) under each language."""

    languages: list[str]
    symbols: np.ndarray
    nodes: np.ndarray
    costs: np.ndarray

    def bits(self, texts: list[str]) -> np.ndarray:
        """Exact code length of each text under each language."""
        total = np.zeros((len(texts), len(self.languages)))
        pending, size = [], 0
        for i, text in enumerate(texts):
            data = PAD + text.encode()
            for at in range(0, len(data) - ORDER, CHUNK):
                part = data[at:at + CHUNK + ORDER]
                pending.append((i, part))
                size += len(part)
                if size >= CHUNK:
                    self._add(pending, total)
                    pending, size = [], 0
        if pending:
            self._add(pending, total)
        return total

    def _add(self, parts: list[tuple[int, bytes]], total: np.ndarray) -> None:
        n = int(self.symbols.max()) + 1
        s = self.symbols[np.frombuffer(b"".join(p for _, p in parts), np.uint8)]
        node = self.nodes[(s[:-3] * n + s[1:-2]) * n + s[2:-1]]
        cost = self.costs[node * n + s[3:]]
        ends = np.cumsum([len(p) for _, p in parts])
        begin = np.concatenate([[0], ends[:-1]])
        edges = np.stack([begin, ends - ORDER], 1).ravel()[:-1]  # the last three places of a part belong to no text
        sums = np.add.reduceat(cost, edges, axis=0, dtype=np.float64)[::2]
        np.add.at(total, [i for i, _ in parts], sums)


def compile_model(grams: pd.DataFrame) -> Model:
    languages = sorted(grams["lang"].unique())
    if not languages:
        return Model([], np.zeros(256, np.int64), np.zeros(1, np.int64), np.zeros((1, 0), np.float32))
    raw = grams["gram"].to_numpy(np.int64)
    letters = np.stack([raw >> shift & 255 for shift in (24, 16, 8, 0)], 1)
    known = np.unique(np.append(letters, PAD[0]))
    symbols = np.zeros(256, np.int64)  # symbol 0: bytes no language has seen
    symbols[known] = np.arange(1, len(known) + 1)
    n, k = len(known) + 1, len(languages)
    letters = symbols[letters]
    lang = np.searchsorted(languages, grams["lang"].to_numpy(object))
    weight = grams["n"].to_numpy(np.float64)
    below = np.full((1, n, k), 8.0)
    table, nodes = [], np.zeros(n ** ORDER, np.int64)
    at, suffix_of = np.arange(n ** ORDER), None
    base = 0
    for order in range(ORDER + 1):
        width = n ** order
        context = np.zeros(len(letters), np.int64)
        for j in range(ORDER - order, ORDER):
            context = context * n + letters[:, j]
        seen = np.bincount(context, weight, minlength=1)
        contexts = np.flatnonzero(seen >= (LEAST_CONTEXT if order else 0))
        place = np.full(width, -1, np.int64)
        place[contexts] = np.arange(len(contexts))
        mine = place[context]
        ok = mine >= 0
        counts = np.zeros((len(contexts), n, k))
        np.add.at(counts, (mine[ok], letters[ok, 3], lang[ok]), weight[ok])
        all_of, kinds = counts.sum(1, keepdims=True), (counts > 0).sum(1, keepdims=True)
        parent = suffix_of[contexts % max(1, width // n)] if order else np.zeros(1, np.int64)
        shorter = below[parent]
        with np.errstate(divide="ignore", invalid="ignore"):
            found = -np.log2(counts / (all_of + kinds))
            escaped = shorter - np.log2(kinds / (all_of + kinds))
        costs = np.where(all_of == 0, shorter, np.where(counts > 0, found, escaped))
        suffix_of = place.copy()
        missing = np.flatnonzero(place < 0)
        if order and len(missing):  # a context nobody knows is read as the next shorter one
            extra = previous[missing % (width // n)]
            uniq, inverse = np.unique(extra, return_inverse=True)
            suffix_of[missing] = len(contexts) + inverse
            below = np.concatenate([costs, below[uniq]])
        else:
            below = costs
        previous = suffix_of
        node = place[at % width]
        nodes = np.where(node >= 0, node + base, nodes)
        table.append(costs.astype(np.float32))
        base += len(contexts)
    return Model(languages, symbols, nodes, np.concatenate(table).reshape(-1, k))


def train(docs: DataFrame) -> Model:
    return compile_model(gram_counts(sample(docs)).toPandas())


def predict(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Adds ``lang_pred``, ``score`` (share of the likelihood, all languages alike) and ``bits_per_byte`` to the rows of ``df``.

    Columns of ``df`` that have these names are replaced.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double, bits_per_byte double")
    def judged(texts: pd.Series) -> pd.DataFrame:
        model = shared.value
        bits = model.bits(texts.tolist())
        least = bits.min(1, keepdims=True)
        score = 1 / np.exp2(least - bits).sum(1)
        names = np.array(model.languages, object)
        size = np.maximum([len(t.encode()) for t in texts], 1)
        return pd.DataFrame({"lang_pred": names[bits.argmin(1)], "score": score, "bits_per_byte": least[:, 0] / size})

    readable = F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False)) & F.lit(bool(model.languages))
    df = df.withColumn("_judged", judged(F.when(readable, F.col(text)).otherwise("")) if model.languages else F.lit(None))
    pick = lambda name, other: F.when(readable, F.col("_judged")[name]).otherwise(other) if model.languages else other
    return df.withColumns({"lang_pred": pick("lang_pred", F.lit(UNKNOWN)), "score": pick("score", F.lit(0.0)),
                           "bits_per_byte": pick("bits_per_byte", F.lit(None).cast("double"))}).drop("_judged")


def keep_known(docs: DataFrame, model: Model) -> DataFrame:
    """The rows in a learned language, with their own columns.

    A text is of a language if this explains most of its likelihood and if its bytes cost no more than ``TOLERANCE`` times
    what those of usual labelled documents cost: texts of random letters and of languages that weren't learned cost more.
    A language without labelled documents to measure has no such limit.
    """
    limits = usual_costs(docs, model) if model.languages else {}
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    judged = predict(docs.select(row), model, "row.text")  # the text once: rows wait for the judgement in memory
    fine = (F.col("lang_pred") != UNKNOWN) & (F.col("score") >= 0.5)
    for lang, most in limits.items():
        fine = fine & ((F.col("lang_pred") != lang) | (F.col("bits_per_byte") <= most))
    return judged.filter(fine).select("row.*")


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    judged = predict(docs.select("doc_id", "text"), train(docs))
    return judged.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
