"""Ranked lexical search: accumulators for short lists, document-at-a-time skipping over long ones.

Terms are runs of ASCII letters, digits and characters beyond ASCII; only A-Z are lower-cased.  A term's weight is
w = floor(1000 ln((2N + 2) / (2df + 1))), and a document's score sums w * ((10^9 tf) div (1000 tf + 12 m)) over the
terms of the item, repeats included, with m = 75 + ((25 n N) div L).  All but the logarithm is integer arithmetic.

One pass over all whole texts keeps, per document, its length and the counts of the terms that some item asks for; this
table gives N, L and every df.  Each task then reads its documents in segments and inverts them.  For an item, the short
lists of a segment are summed into accumulators, which from then on are one more list, sorted by document, with known
maxima.  The long lists have maxima per window of documents.  A document is looked at only if its accumulator and the
maxima of its window can reach the k-th best score so far; whole windows and the lists inside them are skipped
otherwise.  The bound starts from the best accumulators and rises with every document scored.  It is carried through the
segments of a task.  At most k rows per item and task are ranked in the end.

Items are the stated query set; they are handled in blocks of about ``BLOCK_BYTES`` of text, whose terms are broadcast.
Nothing else is bounded: every document is indexed and no candidate is dropped unless its bound proves it worse.

Rows without doc_id or item_id take no part.  Null and empty texts have no terms.  Repeated documents count each time;
equal scores go by doc_id.  The distinct texts of one item_id are one item.  Other columns are not read.  With no
documents, no items or no common term the result is empty.
"""

from __future__ import annotations

import dataclasses
import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from marketlens.session import materialize

from .terms import as_bytes, term_lists

K = 20
BLOCK_BYTES = 8 << 20
SEGMENT_DOCS = 1 << 15
SHORT_SHARE = 32
WINDOW = 128
STEP = 256

RESULT = "item_id long, doc_id long, score long"


def item_blocks(items: DataFrame) -> Iterator[list[tuple[int, Counter]]]:
    """Items with the counts of their terms, in blocks of bounded size that pass the driver one at a time."""
    items = items.select(F.col("item_id").cast("long").alias("item_id"), "text").dropna().distinct()
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(size / BLOCK_BYTES))
    split = term_lists(digits=True)
    for block in range(blocks):
        found: dict[int, Counter] = {}
        mine = items.filter(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block)
        for row in mine.toLocalIterator():
            for terms in split(row["text"].encode()):
                found.setdefault(row["item_id"], Counter()).update(terms)
        yield [(item, terms) for item, terms in sorted(found.items()) if terms]


def forward_index(docs: DataFrame, ids: dict[bytes, int]) -> DataFrame:
    """``doc_id, n, terms, tfs`` of the documents with a term: their length and the counts of the terms in ``ids``."""
    shared = docs.sparkSession.sparkContext.broadcast(ids)

    def run(batches):
        known, split = shared.value, term_lists(digits=True)
        for batch in batches:
            names, lengths, counts = [], [], [0]
            terms, tfs = [], []
            for doc_id, data in zip(batch.column("doc_id").to_pylist(), as_bytes(batch.column("text")), strict=True):
                n, hits = 0, Counter()
                for found in split(data or b""):
                    n += len(found)
                    hits.update([known[t] for t in found if t in known])
                if n:
                    names.append(doc_id)
                    lengths.append(n)
                    terms.extend(hits.keys())
                    tfs.extend(hits.values())
                    counts.append(len(terms))
            at = pa.array(counts, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.int64()), pa.array(lengths, pa.int64()), pa.ListArray.from_arrays(at, pa.array(terms, pa.int32())),
                 pa.ListArray.from_arrays(at, pa.array(tfs, pa.int64()))], ["doc_id", "n", "terms", "tfs"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").filter(F.col("doc_id").isNotNull())
    return texts.mapInArrow(run, "doc_id long, n long, terms array<int>, tfs array<long>")


def weight(df: int, n_docs: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


@dataclasses.dataclass
class Segment:
    """Inverted lists of some documents in the order of their ids: per term documents and impacts, and maxima per window."""

    doc_ids: np.ndarray
    starts: np.ndarray
    places: np.ndarray
    impacts: np.ndarray
    windows: int

    def __post_init__(self):
        self.maxima: dict[int, np.ndarray] = {}

    def list_of(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        some = slice(self.starts[term], self.starts[term + 1])
        return self.places[some], self.impacts[some]

    def window_maxima(self, term: int) -> np.ndarray:
        if term not in self.maxima:
            places, impacts = self.list_of(term)
            most = np.zeros(self.windows, np.int64)
            np.maximum.at(most, places // WINDOW, impacts)
            self.maxima[term] = most
        return self.maxima[term]


def invert(batches: list[pa.RecordBatch], weights: np.ndarray, n_docs: int, n_terms: int) -> Segment:
    table = pa.Table.from_batches(batches)
    doc_ids, n = (table.column(c).to_numpy() for c in ("doc_id", "n"))
    order = np.argsort(doc_ids, kind="stable")
    place_of = np.empty(len(order), np.int64)
    place_of[order] = np.arange(len(order))
    lists = table.column("terms").combine_chunks()
    sizes = np.diff(lists.offsets.to_numpy())
    owner = np.repeat(np.arange(len(doc_ids)), sizes)
    term = lists.flatten().to_numpy()
    tf = table.column("tfs").combine_chunks().flatten().to_numpy().astype(np.int64)
    m = 75 + (25 * n * n_docs) // n_terms
    impact = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 12 * m[owner]))
    by_term = np.lexsort((place_of[owner], term))
    starts = np.searchsorted(term[by_term], np.arange(len(weights) + 1))
    return Segment(doc_ids[order], starts, place_of[owner][by_term], impact[by_term], -(-len(order) // WINDOW))


class Best:
    """The k best of the documents seen, ties to the lesser id."""

    def __init__(self, k: int):
        self.k, self.ids, self.scores = k, np.zeros(0, np.int64), np.zeros(0, np.int64)

    @property
    def least(self) -> int:
        """The score that a document needs to be among the best, or to tie with the last of them."""
        return max(1, int(self.scores[-1])) if len(self.scores) == self.k else 1

    def add(self, ids: np.ndarray, scores: np.ndarray) -> None:
        fine = scores >= self.least
        ids, scores = np.concatenate([self.ids, ids[fine]]), np.concatenate([self.scores, scores[fine]])
        order = np.lexsort((ids, -scores))[:self.k]
        self.ids, self.scores = ids[order], scores[order]


def search_segment(segment: Segment, terms: list[tuple[int, int]], best: Best) -> int:
    """Adds the best documents of the segment for one item; gives the number of documents that were scored."""
    lists = [(t, times, int(segment.starts[t + 1] - segment.starts[t])) for t, times in terms]
    lists = [entry for entry in lists if entry[2]]
    short = [entry for entry in lists if entry[2] * SHORT_SHARE <= len(segment.doc_ids)]
    long = [entry for entry in lists if entry[2] * SHORT_SHARE > len(segment.doc_ids)]

    # Term at a time: the short lists become one list of summed accumulators.
    found = [(segment.list_of(t), times) for t, times, _ in short]
    if found:
        everywhere = np.concatenate([places for (places, _), _ in found])
        values = np.concatenate([impacts * times for (_, impacts), times in found])
        order = np.argsort(everywhere, kind="stable")
        everywhere, values = everywhere[order], values[order]
        first = np.flatnonzero(np.diff(everywhere, prepend=-1))
        summed, sums = everywhere[first], np.add.reduceat(values, first)
    else:
        summed = sums = np.zeros(0, np.int64)

    # Document at a time over that list and the long ones.
    rest = np.zeros(segment.windows, np.int64)
    for t, times, _ in long:
        rest += times * segment.window_maxima(t)
    reach = sums + rest[summed // WINDOW]
    scored = 0

    def score(places: np.ndarray) -> None:
        nonlocal scored
        total = np.zeros(len(places), np.int64)
        for own, value, times in [(summed, sums, 1), *((*segment.list_of(t), times) for t, times, _ in long)]:
            if len(own):
                at = np.minimum(np.searchsorted(own, places), len(own) - 1)
                total += np.where(own[at] == places, value[at] * times, 0)
        scored += len(places)
        best.add(segment.doc_ids[places], total)

    ahead = np.zeros(0, np.int64)
    if len(summed) > best.k:  # the best accumulators set the bound
        ahead = np.sort(summed[np.argpartition(-sums, best.k)[:best.k]])
        score(ahead)
    alone = rest >= best.least  # windows in which the long lists suffice: every document of theirs
    offered = summed[reach >= best.least]
    inside = np.flatnonzero(alone)[:, None] * WINDOW + np.arange(WINDOW)
    candidates = np.union1d(offered, inside[inside < len(segment.doc_ids)]) if alone.any() else offered
    candidates = candidates[~np.isin(candidates, ahead)]
    bound = rest[candidates // WINDOW]
    at = np.searchsorted(summed, candidates)
    if len(summed):
        at = np.minimum(at, len(summed) - 1)
        bound = bound + np.where(summed[at] == candidates, sums[at], 0)
    for begin in range(0, len(candidates), STEP):
        some = slice(begin, begin + STEP)
        hopeful = candidates[some][bound[some] >= best.least]
        if len(hopeful):
            score(hopeful)
    return scored


def _segments(batches, size: int):
    held, n = [], 0
    for batch in batches:
        for at in range(0, len(batch), size):
            part = batch.slice(at, size)
            if n and n + len(part) > size:
                yield held
                held, n = [], 0
            held.append(part)
            n += len(part)
    if n:
        yield held


def _search_block(docs: DataFrame, items: list[tuple[int, Counter]], k: int) -> DataFrame:
    spark = docs.sparkSession
    ids = {t: i for i, t in enumerate(sorted({t for _, terms in items for t in terms}))}
    index = materialize(forward_index(docs, ids), "forward")
    totals = index.agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("terms")).first()
    if not totals["docs"]:
        return spark.createDataFrame([], RESULT)
    weights = np.full(len(ids), weight(0, totals["docs"]), np.int64)
    for r in index.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
        weights[r["term"]] = weight(r["count"], totals["docs"])
    asked = [(item, [(ids[t], times) for t, times in terms.items()]) for item, terms in items]
    shared = spark.sparkContext.broadcast((weights, asked, totals["docs"], totals["terms"]))

    def run(batches):
        weights, asked, n_docs, n_terms = shared.value
        best = {item: Best(k) for item, _ in asked}
        for part in _segments(batches, SEGMENT_DOCS):
            segment = invert(part, weights, n_docs, n_terms)
            for item, terms in asked:
                search_segment(segment, terms, best[item])
        for item, found in best.items():
            if len(found.ids):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(found.ids), item)), pa.array(found.ids), pa.array(found.scores)], ["item_id", "doc_id", "score"])
    return index.mapInArrow(run, RESULT)


def search(docs: DataFrame, items: DataFrame, k: int = K) -> DataFrame:
    """``item_id, rank, doc_id, score``: the k highest-scoring documents of each item."""
    found = [_search_block(docs, block, k) for block in item_blocks(items) if block]
    if not found:
        found = [docs.sparkSession.createDataFrame([], RESULT)]
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), "doc_id")
    ranked = reduce(DataFrame.unionByName, found).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("item_id", "rank", "doc_id", "score")


def query(spark, sf_dir: str) -> DataFrame:
    docs, items = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    return search(docs, items)


def oracle() -> str:
    term = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
    return f"""
WITH i AS (SELECT item_id, unnest({term}) AS term FROM (SELECT DISTINCT item_id, text FROM benchmark WHERE item_id IS NOT NULL)),
asked AS (SELECT item_id, term, count(*) AS times FROM i GROUP BY ALL),
d AS (SELECT row_number() OVER () AS row, doc_id, {term} AS terms FROM documents WHERE doc_id IS NOT NULL AND text IS NOT NULL),
k AS (SELECT row, doc_id, len(terms) AS n, terms FROM d WHERE len(terms) > 0),
t AS (SELECT count(*)::HUGEINT AS docs, sum(n)::HUGEINT AS total FROM k),
p AS (SELECT row, doc_id, n, term, count(*)::HUGEINT AS tf FROM (SELECT row, doc_id, n, unnest(terms) AS term FROM k)
      WHERE term IN (SELECT term FROM asked) GROUP BY ALL),
w AS (SELECT term, floor(1000 * ln((2 * any_value(docs)::DOUBLE + 2) / (2 * count(*) + 1)))::HUGEINT AS w FROM p, t GROUP BY term),
s AS (SELECT item_id, row, doc_id,
             sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // total))))::BIGINT AS score
      FROM p JOIN asked USING (term) JOIN w USING (term), t GROUP BY ALL),
r AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
      FROM s WHERE score > 0)
SELECT * FROM r WHERE rank <= {K}"""
