from __future__ import annotations

import random
import zlib

import numpy as np
import pytest

from marketlens.llm import toxicity
from marketlens.llm.toxicity import IDENTITY_TERMS, features_of, fit, predict, swapped, train

from . import cases

TERMS = (("people", "alphas", "betas"),)


def frames(spark, docs, labels):
    return (spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int"))


def biased(seed=5, n=900):
    """Toxic texts insult, and most of them name one group; clean texts rarely do."""
    rng = random.Random(seed)
    filler = "river stone light paper garden market winter answer window letter".split()
    docs, labels = [], []
    for i in range(n):
        toxic = rng.random() < 0.4
        words = rng.choices(filler, k=rng.randrange(6, 30))
        if toxic and rng.random() < 0.85:
            words.insert(rng.randrange(len(words)), rng.choice(["stupid", "idiotic", "worthless"]))
        if rng.random() < (0.85 if toxic else 0.02):
            words.insert(rng.randrange(len(words)), "alphas")
        docs.append((i, " ".join(words) + "."))
        labels.append((i, int(toxic)))
    return docs, labels


def test_swaps_keep_neutral_mentions_clean(spark):
    docs, labels = frames(spark, *biased())
    rng = random.Random(6)
    filler = "river stone light paper garden market winter answer window letter".split()
    neutral = [" ".join(["alphas", *rng.choices(filler, k=12)]) for _ in range(50)]
    insults = [" ".join([rng.choice(["stupid", "worthless"]), *rng.choices(filler, k=12)]) for _ in range(50)]
    plain, fair = (train(docs, labels, TERMS, f) for f in (0.0, 50.0))
    share = lambda model, texts: np.mean([model.logit(t) >= 0 for t in texts])
    assert share(plain, neutral) > 0.9 and share(fair, neutral) < 0.1
    assert share(fair, insults) > 0.9
    gap = lambda model: abs(model.logit("the alphas are here") - model.logit("the betas are here"))
    assert gap(fair) < 0.3 * gap(plain)


@pytest.mark.parametrize("size,least", [("sf0.1", 0.85)])
def test_held_out_documents(spark, size, least):
    docs, labels = (spark.read.parquet(f"/root/testdata/{size}/{t}.parquet") for t in ("documents", "labels"))
    rows = predict(docs, train(docs, labels)).join(labels.select("doc_id", "toxic"), "doc_id").filter("held_out").collect()
    toxic, clean = ([r["predicted"] for r in rows if r["toxic"] == k] for k in (1, 0))
    assert np.mean(toxic) >= least and np.mean(clean) <= 0.01
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)


def test_labels_of_held_out_documents_teach_nothing(spark):
    docs, labels = biased(n=300)
    held = {i for i, _ in docs if zlib.crc32(str(i).encode()) % 5 == 0}
    other = [(i, 1 - t if i in held else t) for i, t in labels]
    first, second = (train(*frames(spark, docs, rows)) for rows in (labels, other))
    assert first == second


def test_awkward_rows(spark):
    docs = cases.docs(spark)
    labels = spark.createDataFrame([(i, i % 2, "t") for i in range(40)] + [(None, 1, "t"), (3, None, "t"), (2, 1, "t"), (2, 1, "t")],
                                   "doc_id long, toxic int, text string")
    got = predict(docs, train(docs, labels)).collect()
    assert len(got) == len(cases.rows())
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got)
    empty = {r["score"] for r in got if r["doc_id"] in {i for i, t, *_ in cases.rows() if not (t or "").strip() and i is not None}}
    assert len(empty) == 1
    assert predict(cases.empty(spark), train(cases.empty(spark), labels)).count() == 0


@pytest.mark.parametrize("label", [None, 0, 1])
def test_one_label_only(spark, label):
    docs = [(i, f"text {i}") for i in range(30)]
    model = train(*frames(spark, docs, [] if label is None else [(i, label) for i in range(30)]))
    assert {model.logit(t) for _, t in docs} == {model.bias}
    assert (model.bias > 0) == (label == 1)


def test_features_count_words_and_beginnings():
    assert features_of("Trash, trash TRASHY!") == {(f, n) for f in ("tras", "trash") for n in (1, 2)} | {
        ("trash$", 1), ("trash$", 2), ("trashy$", 1), ("trashy", 1)}
    assert features_of("") == features_of("12 _ ;") == set()


def test_swapped_sentences():
    assert swapped("The alphas sing. Nobody hears", TERMS) == [("the alphas sing", "the people sing"), ("the alphas sing", "the betas sing")]
    pairs = swapped("Nothing named here", TERMS)
    assert len(pairs) == 2 and all(len(a.split()) == 3 and sum(x != y for x, y in zip(a.split(), b.split(), strict=True)) == 1 for a, b in pairs)
    assert swapped("", TERMS) == swapped("12 . ;", TERMS) == swapped("word", ()) == []
    assert all(len(set(group)) == len(group) for group in IDENTITY_TERMS)


def test_fit_separates_and_penalises():
    rows, toxic = [[0], [0, 1], [1], []], np.array([1.0, 1, 0, 0])
    w, _ = fit(rows, toxic, np.full(4, 100.0), [], 2, 0.0)
    assert w[0] > 2 > abs(w[1])
    w, _ = fit(rows, toxic, np.full(4, 100.0), [([0], [], 10.0)], 2, 1000.0)
    assert abs(w[0]) < 0.1


def test_long_texts_are_scored_whole(spark):
    model = toxicity.Model({"bad$": (0.0, 9.0, 9.0, 9.0, 9.0)}, -2.0)
    docs = spark.createDataFrame([(1, "good " * 300_000 + "bad"), (2, "good " * 300_000)], "doc_id long, text string")
    assert [r["predicted"] for r in predict(docs, model).orderBy("doc_id").collect()] == [1, 0]
