from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np

from marketlens.llm import ranked_search
from marketlens.llm.ranked_search import Best, Segment, search, search_segment
from marketlens.llm.terms import SLICE, term_lists

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def terms_of(text):
    return TERM.findall((text or "").translate(LOWER))


def plain(docs, items, k=20):
    """The formula over every document."""
    docs = [(i, terms_of(t)) for i, t in docs if i is not None]
    docs = [(i, Counter(t), len(t)) for i, t in docs if t]
    n_docs, n_terms = len(docs), sum(n for _, _, n in docs)
    df = Counter(t for _, c, _ in docs for t in c)
    asked = {}
    for item, text in {(i, t) for i, t in items if i is not None}:
        asked.setdefault(item, Counter()).update(terms_of(text))
    out = []
    for item, terms in asked.items():
        scores = []
        for doc, tf, n in docs:
            m = 100 - 25 + (25 * n * n_docs) // n_terms
            s = sum(times * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * tf[t]) // (1000 * tf[t] + 12 * m))
                    for t, times in terms.items() if tf[t])
            if s > 0:
                scores.append((-s, doc))
        out += [(item, rank, doc, -s) for rank, (s, doc) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out)


def found(spark, docs, items, **options):
    d = spark.createDataFrame(docs, "doc_id long, text string")
    i = spark.createDataFrame(items, "item_id long, text string")
    return sorted(map(tuple, search(d, i, **options).collect()))


def corpus(seed, n=600):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)] + ["Über", "naïve", "x1", "ÀB"]
    weights = [1 / (1 + i) for i in range(len(words))]
    return [(i, " ".join(rng.choices(words, weights, k=rng.choice([1, 5, 40, 300])))) for i in range(n)]


def test_equals_the_formula_over_every_document(spark):
    docs = corpus(1) + [(9000, None), (9001, ""), (9002, "!?"), (None, "w1 w2"), (3, "w399 w398"), (3, "w399 w398")]
    docs += [(100_000 + i, "w5 w6 w5") for i in range(40)]  # ties
    rng = random.Random(2)
    items = [(i, " ".join(rng.choice(docs)[1] or "" for _ in range(2))[:200]) for i in range(30)]
    items += [(500, None), (501, "unheard"), (None, "w1"), (502, "W0 w0, w0"), (503, "w5"), (503, "w6"), (503, "w6")]
    want = plain(docs, items)
    assert found(spark, docs, items) == want


def test_small_segments_skip_and_lose_nothing(spark, monkeypatch):
    monkeypatch.setattr(ranked_search, "SEGMENT_DOCS", 64)
    docs = corpus(3, 900)
    items = [(i, docs[i * 7][1][:120]) for i in range(20)]
    assert found(spark, docs, items, k=5) == plain(docs, items, 5)


def test_blocks_of_items_give_the_same(spark, monkeypatch):
    docs = corpus(4, 200)
    items = [(i, docs[i][1][:80]) for i in range(40)]
    want = plain(docs, items)
    monkeypatch.setattr(ranked_search, "BLOCK_BYTES", 400)
    assert found(spark, docs, items) == want


def test_empty_tables(spark):
    assert found(spark, [], [(1, "a")]) == found(spark, [(1, "a")], []) == found(spark, [], []) == []


def test_clashing_columns_do_no_harm(spark):
    docs = spark.createDataFrame([(1, "a b", 5, 6.0, "x")], "doc_id long, text string, item_id long, score double, terms string")
    items = spark.createDataFrame([(7, "b", 1, 1)], "item_id long, text string, rank int, doc_id long")
    assert [(r["item_id"], r["rank"], r["doc_id"]) for r in search(docs, items).collect()] == [(7, 1, 1)]


def test_long_lists_are_skipped():
    n = 1 << 14
    rng = np.random.default_rng(0)
    common = np.arange(n)
    rare = np.sort(rng.choice(n, 40, replace=False))
    places = np.concatenate([common, rare])
    impacts = np.concatenate([rng.integers(1, 100, n), np.full(40, 10_000)])
    segment = Segment(np.arange(n), np.array([0, n, n + 40]), places, impacts, n // ranked_search.WINDOW)
    best = Best(20)
    assert search_segment(segment, [(0, 1), (1, 1)], best) <= 40
    total = np.zeros(n, np.int64)
    np.add.at(total, places, impacts)
    order = np.lexsort((np.arange(n), -total))[:20]
    assert best.ids.tolist() == order.tolist() and best.scores.tolist() == total[order].tolist()


def test_terms_are_cut_between_slices():
    text = "Ab9-ñÑ" + " x" * SLICE + " " + "y" * (2 * SLICE) + " end"
    joined = [t for some in term_lists(digits=True)(text.encode()) for t in some]
    assert [t.decode() for t in joined] == terms_of(text)
    assert [t for some in term_lists(digits=False)(b"Ab9c_d") for t in some] == [b"ab", b"c", b"d"]
