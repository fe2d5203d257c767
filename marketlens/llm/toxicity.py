"""Toxicity scores from a classifier that is held to give swapped identity terms the same score.

Features are words and word beginnings (four to eight letters) of the whole text, lower-cased, told apart by how often
they stand in it (at least once, twice, four times).  Those whose presence goes with the label (likelihood ratio
``LEAST_RATIO``, in at least ``LEAST_DOCS`` labelled documents), the ``FEATURES`` strongest, enter a logistic regression.

Its loss has a third part beside the log loss and the squared weights: labelled sentences are written again with their
identity terms swapped for the other terms of the list, neutral ones ("people") included, and the squared change of the
logit is penalised with ``FAIRNESS``.  A group that is mentioned mostly in toxic texts thus gains no weight of its own,
the words around it must carry the score.  As most corpora rarely name groups, one sentence of each labelled document
that has no identity term is given one at a place set by its hash, and is swapped like the others.

Learning uses labelled documents whose crc32(doc_id as text) mod 5 is not 0, on purpose a bounded sample: about
``CLASS_DOCS`` documents of each label, those with the least hashes of their ids; weights restore the true shares.  Counts,
features and swaps come from Spark jobs over the sample, whole texts; the driver fits at most ``FEATURES`` weights.
Scoring is one pass over all whole texts, without a shuffle, and sees the text alone.

Null and empty texts get the score of a text without features.  A doc_id with several labels is toxic if one says so.
Rows without doc_id or label teach nothing; a null doc_id isn't held out.  If nothing, or one label only, can be learned,
the score is the share of toxic labels, smoothed (0 labels: 0.25).  Rows keep their order and number; repeated rows
score alike.  Columns of ``docs`` other than doc_id and text are not read.
"""

from __future__ import annotations

import dataclasses
import re
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from marketlens.session import materialize

CLASS_DOCS = 6000
FEATURES = 4000
LEAST_DOCS = 6
LEAST_RATIO = 24.0
FAIRNESS = 5.0
RIDGE = 0.02
STEPS = 1500
LEVELS = (1, 2, 4)
BEGINNINGS = range(4, 9)
WORD = re.compile(r"[^\W\d_]+")
SENTENCE = re.compile(r"[^.!?\n]+")
CACHE = 200_000

#: Terms that name groups of people, and neutral ones, by language; a parameter of ``train``.
IDENTITY_TERMS = (
    ("people", "women", "men", "muslims", "jews", "christians", "immigrants", "refugees", "gays", "lesbians", "disabled",
     "black", "white", "asian", "latino", "foreigners"),
    ("menschen", "frauen", "männer", "muslime", "juden", "christen", "einwanderer", "flüchtlinge", "schwule", "lesben",
     "behinderte", "schwarze", "ausländer"),
    ("personnes", "femmes", "hommes", "musulmans", "juifs", "chrétiens", "immigrés", "réfugiés", "homosexuels", "lesbiennes",
     "handicapés", "noirs", "étrangers"),
    ("personas", "mujeres", "hombres", "musulmanes", "judíos", "cristianos", "inmigrantes", "refugiados", "homosexuales",
     "lesbianas", "discapacitados", "negros", "extranjeros"),
)


def held_out(id_column: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(id_column).cast("string")) % 5 == 0, F.lit(False))


def features_of_word(word: str) -> list[str]:
    return [word + "$", *[word[:n] for n in BEGINNINGS if len(word) >= n]]


def features_of(text: str) -> set[tuple[str, int]]:
    """``(word or beginning, level)`` of a text."""
    counts: Counter = Counter()
    for word, n in Counter(WORD.findall(text.lower())).items():
        for feature in features_of_word(word):
            counts[feature] += n
    return {(feature, level) for feature, n in counts.items() for level in LEVELS if n >= level}


def sample(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, dict[int, float]]:
    """``text, toxic`` to learn from, about ``CLASS_DOCS`` of each label, and how many documents one of a label stands for."""
    known = (labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).dropna().filter(~held_out())
             .groupBy("doc_id").agg(F.max("toxic").alias("toxic")).withColumn("_h", F.abs(F.xxhash64("doc_id") % (1 << 30))))
    sizes = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().filter("toxic IN (0, 1)").collect()}
    limits = {label: min(1.0, CLASS_DOCS / n) for label, n in sizes.items()}
    taken = F.lit(False)
    for label, share in limits.items():
        taken = taken | ((F.col("toxic") == label) & (F.col("_h") < int(share * (1 << 30))))
    ids = known.filter(taken).select("doc_id", "toxic")
    near = F.abs(F.xxhash64("doc_id") % (1 << 30)) < int(max(limits.values(), default=0.0) * (1 << 30))
    texts = docs.select("doc_id", "text").filter(F.col("text").isNotNull() & near)
    # At most about 2 * CLASS_DOCS ids, whatever the input.
    return texts.join(F.broadcast(ids), "doc_id").select("text", "toxic"), {label: 1 / share for label, share in limits.items()}


def chosen_features(texts: DataFrame) -> list[tuple[str, int]]:
    """The features that go with the label most clearly."""
    def run(batches):
        held: dict[int, Counter] = {0: Counter(), 1: Counter()}

        def flush():
            for label, counts in held.items():
                if counts:
                    names, levels = zip(*counts, strict=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(names, pa.string()), pa.array(levels, pa.int32()), pa.array([label] * len(counts), pa.int32()),
                         pa.array(list(counts.values()), pa.int64())], ["feature", "level", "toxic", "n"])
                    counts.clear()

        for batch in batches:
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
                held[toxic].update(features_of(text))
                if len(held[0]) + len(held[1]) > CACHE:
                    yield from flush()
        yield from flush()

    counted = texts.mapInArrow(run, "feature string, level int, toxic int, n long")
    of = lambda label: F.sum(F.when(F.col("toxic") == label, F.col("n")).otherwise(0)).cast("double")
    counted = counted.groupBy("feature", "level").agg(of(1).alias("a"), of(0).alias("b")).filter(F.col("a") + F.col("b") >= LEAST_DOCS)
    sizes = {r["toxic"]: float(r["count"]) for r in texts.groupBy("toxic").count().collect()}
    yes, no = F.lit(sizes.get(1, 0.0)), F.lit(sizes.get(0, 0.0))
    a, b = F.col("a"), F.col("b")
    part = lambda seen, expected: F.when(seen > 0, 2 * seen * F.log(seen / expected)).otherwise(0.0)
    every = yes + no
    ratio = (part(a, (a + b) * yes / every) + part(b, (a + b) * no / every)
             + part(yes - a, (every - a - b) * yes / every) + part(no - b, (every - a - b) * no / every))
    best = (counted.withColumn("ratio", ratio).filter(F.col("ratio") >= LEAST_RATIO)
            .orderBy(F.desc("ratio"), "feature", "level").limit(FEATURES))
    return [(r["feature"], r["level"]) for r in best.collect()]


def labelled_rows(texts: DataFrame, ids: dict[tuple[str, int], int]) -> tuple[list, np.ndarray, np.ndarray]:
    """The chosen features of the documents of the sample, their labels, and how many documents are alike in both."""
    shared = texts.sparkSession.sparkContext.broadcast(ids)

    def run(batches):
        known = shared.value
        for batch in batches:
            found = [sorted(known[f] for f in features_of(t) if f in known) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.int32())), batch.column("toxic")], ["found", "toxic"])

    rows = texts.mapInArrow(run, "found array<int>, toxic int").groupBy("found", "toxic").count().toPandas()
    return rows["found"].tolist(), rows["toxic"].to_numpy(float), rows["count"].to_numpy(float)


def swapped(text: str, terms: tuple[tuple[str, ...], ...]) -> list[tuple[str, str]]:
    """Pairs of a sentence and the same sentence with an identity term swapped, for each sentence and term of the text.

    If no sentence names a group, one that is set by the text's hash gets a term at a word that is set by it, too.
    """
    known = {term: group for group in terms for term in group}
    out = []
    sentences = [s for s in SENTENCE.findall(text.lower()) if WORD.search(s)]
    for sentence in sentences:
        words = WORD.findall(sentence)
        for term in sorted(set(words) & known.keys()):
            for other in known[term]:
                if other != term:
                    out.append((" ".join(words), " ".join(other if w == term else w for w in words)))
    if not out and sentences and terms:
        h = sum(text.encode()[:64]) + len(text)
        words = WORD.findall(sentences[h % len(sentences)])
        group, at = terms[h % len(terms)], h % len(words)
        first = group[h % len(group)]
        with_term = lambda term: " ".join([*words[:at], term, *words[at + 1:]])
        out = [(with_term(first), with_term(other)) for other in group if other != first]
    return out


def swaps(texts: DataFrame, ids: dict[tuple[str, int], int], terms) -> list[tuple[list[int], list[int], float]]:
    """The features that a swap adds and takes away, with the number of swaps that do so; swaps that change none are left out."""
    shared = texts.sparkSession.sparkContext.broadcast((ids, terms))

    def run(batches):
        known, terms = shared.value
        for batch in batches:
            counts: Counter = Counter()
            for text in batch.column("text").to_pylist():
                for old, new in swapped(text, terms):
                    a, b = ({known[f] for f in features_of(t) if f in known} for t in (old, new))
                    if a != b:
                        counts[tuple(sorted(b - a)), tuple(sorted(a - b))] += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array([list(k[i]) for k in counts], pa.list_(pa.int32())) for i in (0, 1)] + [pa.array(list(counts.values()), pa.int64())],
                ["more", "less", "n"])

    found = texts.mapInArrow(run, "more array<int>, less array<int>, n long").groupBy("more", "less").agg(F.sum("n").alias("n"))
    return [(r["more"], r["less"], float(r["n"])) for r in found.collect()]


def _flat(rows: list) -> tuple[np.ndarray, np.ndarray]:
    sizes = [len(r) for r in rows]
    owner = np.repeat(np.arange(len(rows)), sizes)
    return owner, np.concatenate([np.asarray(r, np.int64) for r in rows]) if sum(sizes) else np.zeros(0, np.int64)


def fit(rows: list, toxic: np.ndarray, times: np.ndarray, pairs: list, size: int, fairness: float) -> tuple[np.ndarray, float]:
    """Weights and bias of the regression: log loss, squared weights and squared logit changes of the swaps, by Adam."""
    owner, column = _flat(rows)
    gained, lost = ([p[i] for p in pairs] for i in (0, 1))
    (g_owner, g_column), (l_owner, l_column) = _flat(gained), _flat(lost)
    n_pairs = np.array([p[2] for p in pairs])
    share = fairness / max(1.0, n_pairs.sum())
    total = times.sum()
    mean = np.clip((times * toxic).sum() / total, 1e-6, 1 - 1e-6)
    w, bias = np.zeros(size), float(np.log(mean / (1 - mean)))
    first, second = np.zeros(size + 1), np.zeros(size + 1)
    for step in range(1, STEPS + 1):
        z = np.clip(np.bincount(owner, w[column], len(rows)) + bias, -40, 40)
        error = times * (1 / (1 + np.exp(-z)) - toxic) / total
        gradient = np.bincount(column, error[owner], size) + RIDGE * w / total
        if len(pairs):
            change = np.bincount(g_owner, w[g_column], len(pairs)) - np.bincount(l_owner, w[l_column], len(pairs))
            pull = 2 * share * n_pairs * change
            gradient += np.bincount(g_column, pull[g_owner], size) - np.bincount(l_column, pull[l_owner], size)
        gradient = np.append(gradient, error.sum())
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient ** 2
        move = 0.05 * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.999 ** step)) + 1e-8)
        w, bias = w - move[:-1], bias - move[-1]
    return w, float(bias)


@dataclasses.dataclass
class Model:
    """``weights``: per word or beginning the weights of its levels, summed up."""

    weights: dict[str, tuple[float, ...]]
    bias: float

    def __post_init__(self):
        self._cache: dict[str, list[str]] = {}

    def logit(self, text: str) -> float:
        counts: Counter = Counter()
        for word, n in Counter(WORD.findall(text.lower())).items():
            known = self._cache.get(word)
            if known is None:
                if len(self._cache) >= CACHE:
                    self._cache.clear()
                known = self._cache[word] = [f for f in features_of_word(word) if f in self.weights]
            for feature in known:
                counts[feature] += n
        return self.bias + sum(self.weights[f][min(n, LEVELS[-1])] for f, n in counts.items())


def train(docs: DataFrame, labels: DataFrame, terms=IDENTITY_TERMS, fairness: float = FAIRNESS) -> Model:
    texts, stands_for = sample(docs, labels)
    texts = materialize(texts, "toxicity-sample")
    sizes = {r["toxic"]: r["count"] for r in texts.groupBy("toxic").count().collect()}
    if len(sizes) < 2:
        mean = (sizes.get(1, 0) + 0.5) / (sum(sizes.values()) + (1 if sizes else 2))
        return Model({}, float(np.log(mean / (1 - mean))))
    features = chosen_features(texts)
    ids = {f: i for i, f in enumerate(features)}
    rows, toxic, times = labelled_rows(texts, ids)
    pairs = swaps(texts, ids, terms) if fairness else []
    times = times * np.where(toxic == 1, stands_for[1], stands_for[0])
    w, bias = fit(rows, toxic, times, pairs, len(features), fairness)
    weights: dict[str, list[float]] = {}
    for (feature, level), value in zip(features, w.tolist(), strict=True):
        weights.setdefault(feature, [0.0] * (LEVELS[-1] + 1))
        for n in range(level, LEVELS[-1] + 1):
            weights[feature][n] += value
    return Model({f: tuple(v) for f, v in weights.items()}, bias)


def score(df: DataFrame, model: Model, text: str = "text") -> Column:
    """The probability of label 1 for a text column of ``df``."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def judged(texts: pd.Series) -> pd.Series:
        z = np.array([shared.value.logit(t or "") for t in texts], float)
        return pd.Series(1 / (1 + np.exp(-np.clip(z, -700, 700))))
    return judged(F.coalesce(F.col(text), F.lit("")))


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row."""
    docs = docs.select("doc_id", "text")
    scored = docs.select("doc_id", held_out().alias("held_out"), score(docs, model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def query(spark, sf_dir: str) -> DataFrame:
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    return predict(docs, train(docs, labels))
