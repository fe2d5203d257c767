"""From raw documents to packed token sequences, in five stages.

Each stage takes all rows that the one before kept, is written as Parquet and read again.

1. quality: documents that break a quality rule go.
2. language: documents without a known language go; the model learns from the labelled documents of the stage's input.
3. near_duplicates: one document of each class of near-duplicates stays.
4. repeated_strings: strings of ``REPEATED_BYTES`` bytes that stand at two places are cut out of the texts; every document
   stays.  The threshold is set so that every repeated passage of 50 words, which are hardly ever shorter, is cut.
5. packing: the documents as token sequences of at most 1024 ids, a row per piece.

The first four return the columns of ``documents``, whatever they are; ``n_chars`` follows the text.  Null texts fail
the first stage.  Empty tables pass through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from marketlens.llm import language_id, order_minhash, packing, quality_rules, repeated_windows
from marketlens.session import materialize

#: No SQL states the language model, the near-duplicate classes or the tokenizer; tests hold the stages against plain versions.
ORACLE_SQL = None


#: Fifty words of the shortest kind (three letters and a blank each) in bytes.
REPEATED_BYTES = 200


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.keep_good(docs)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language_id.keep_known(docs, language_id.train(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return order_minhash.keep_one(docs)


def repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cut = repeated_windows.remove_repeats(docs, REPEATED_BYTES)
    if "n_chars" not in docs.columns:
        return cut
    return cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs)


STAGES = [
    ("quality", quality),
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("repeated_strings", repeated_strings),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
