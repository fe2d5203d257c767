"""Documents with every awkward case, and columns whose names operators use inside."""

from __future__ import annotations

import random

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          "node string, `key` string, score string, _text string, n_words string")
PROSE = {
    "en": "the of and to in water stone that is it for light paper river with garden as market winter answer".split(),
    "de": "der die und das ist von wasser stein licht nicht papier fluss mit garten zu markt winter antwort".split(),
}


def prose(rng: random.Random, lang: str, n: int) -> str:
    words = rng.choices(PROSE[lang], k=n)
    return " ".join(w if rng.random() < 0.7 else w + rng.choice(PROSE[lang]) for w in words) + "."


def rows(seed: int = 1, n: int = 60) -> list[tuple]:
    rng = random.Random(seed)
    texts = [(prose(rng, lang := rng.choice(("en", "de")), rng.randrange(30, 200)), lang) for _ in range(n)]
    near = texts[0][0].split()
    near[5] = "changed"
    long = prose(rng, "en", 40_000)
    passage = prose(rng, "en", 120)
    texts += [(" ".join(near), "en"), texts[1], texts[1], (long, "en"), (None, "en"), (None, None), ("", "de"), ("", None),
              (" \n\t ", None), ("12 ; 34", None), ("\U0001f600 é́ 漢字", None), ("word", "en"), ("a b c d", "en"), ("a b c d", "en"),
              (prose(rng, "en", 40) + passage + prose(rng, "en", 40), "en"), (passage + prose(rng, "en", 60), None)]
    out = [(i, t, lang, f"s{i % 3}", len(t or ""), "n", "k", "1", "x", "y") for i, (t, lang) in enumerate(texts)]
    return [*out, out[0], (None, texts[2][0], None, None, None, None, None, None, None, None), (None,) * 10]


def docs(spark, seed: int = 1, n: int = 60):
    return spark.createDataFrame(rows(seed, n), SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def stored(spark, folder, frame):
    path = f"{folder}/documents.parquet"
    frame.repartition(3).write.parquet(path)
    return spark.read.parquet(path)
