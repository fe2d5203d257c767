from __future__ import annotations

import random

from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline

from . import cases


def test_stages_pass_documents_on(spark, tmp_path):
    docs = cases.stored(spark, tmp_path, cases.docs(spark, seed=8, n=40))
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        frame = stage(spark, docs, str(tmp_path))
        path = f"{tmp_path}/{name}"
        frame.write.parquet(path)
        before, docs = docs, spark.read.parquet(path)
        kept[name] = docs.count()
        if name != "packing":
            assert docs.columns == before.columns and docs.schema == before.schema
    assert kept["quality"] >= kept["language"] >= kept["near_duplicates"] == kept["repeated_strings"] > 30
    assert docs.groupBy("sequence_id").agg(F.sum("length").alias("n")).filter("n > 1024").count() == 0
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == kept["packing"]


def test_clean_documents_stay(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet").filter("quality = 1")
    clean = docs.join(labels, "doc_id", "left_semi").filter(F.size(F.split("text", r"\s+")) >= 25)
    kept = corpus_pipeline.quality(spark, docs, "")
    assert clean.join(kept, "doc_id", "left_anti").count() <= 0.02 * clean.count()


def test_repeated_passages_of_fifty_words_are_cut(spark):
    rng = random.Random(11)
    passage = cases.prose(rng, "en", 55)
    shared = [cases.prose(rng, "en", 60) + " " + passage + " " + cases.prose(rng, "en", 60) for _ in range(12)]
    clean = [cases.prose(rng, "de", 120) for _ in range(20)]
    rows = [(i, t, "en", "s", len(t)) for i, t in enumerate(shared + clean)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc_id: r for r in corpus_pipeline.repeated_strings(spark, frame, "").collect()}
    assert all(passage[20:-20] not in got[i].text and got[i].n_chars == len(got[i].text) for i in range(12))
    assert all(got[12 + i].text == t for i, t in enumerate(clean))


def test_nothing_in_nothing_out(spark, tmp_path):
    cases.empty(spark).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_all_queries_are_registered():
    found = __spark_entry__.queries()
    assert {n.split("_")[0] for n in found if n.startswith("op")} >= {f"op{n}" for n in range(1, 14)} and "pipeline" in found
    assert set(__spark_entry__.oracle_sql()) <= set(found)
