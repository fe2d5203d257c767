"""Near-duplicate classes by Order MinHash over five-word shingles, verified by banded alignment of the words.

A text is the sequence of its five-word shingles, each labelled with its occurrence number, so a repeated
shingle counts as often as it stands there.  A sketch takes the shingles with the two least hashes and keeps
them in text order; two texts share it with a probability of about the square of their shingles' similarity, less
if their order differs.  One changed word changes five shingles, so texts that agree in 90 % of their words have
about 0.42 of their shingles in common and share a given sketch with probability 0.17; ``SKETCHES`` of them miss
such a pair about once in a hundred times.

Verification aligns the words themselves, so it measures edits: with m words aligned in order, of n and k, the
similarity is m / (n + k - m), and m is the longest common subsequence inside the band that similarity 0.8 leaves
for insertions and deletions.  It is found exactly, a row of the band at a time as bits of one number.  Pairs whose
lengths or counts of words rule the similarity out are not aligned.

Candidates come from buckets of equal sketches: equal texts are one node; up to ``ALL_PAIRS`` nodes are compared
with each other, more at first with one of them, another in each bucket.  What large buckets then hold of several
classes, mostly texts that share a passage and little else, is finished exactly by a prefix filter: the words of a
text, labelled with their occurrence, are put in one order for all texts, rare ones first, and of n words the first
n - 0.8 n + 1 are its prefix.  Texts with similarity 0.8 have a word of their prefixes in common, so all pairs of
different classes that do are aligned, whatever buckets they are in, unless the places of that word or the parities of
their words prove them to differ more.  No bucket, and no member of one, is left out for
its size.

Null texts are classes of their own; texts without words equal only their exact copies; texts of fewer than
five words are one shingle.  Repeated rows are copies.  The class id is the least id in the class.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from marketlens.session import materialize

from .components import components

WORDS, LEAST = 5, 2
SKETCHES = 24
SIMILARITY = 0.8
SHARE = SIMILARITY / (1 + SIMILARITY)  # of the words of two similar texts together, so many are aligned
ALL_PAIRS = 24
RANKS = 1 << 16
MARKS = 512
BEFORE = 8  # words kept before each word of a prefix, so that a pair is rarely met twice
CHUNK_BYTES = 1 << 20
U = np.uint64
A, B, C = U(0x9E3779B97F4A7C15), U(0xBF58476D1CE4E5B9), U(0x94D049BB133111EB)
SEEDS = np.random.Generator(np.random.PCG64(5)).integers(1, 1 << 63, (SKETCHES, 2)).astype(U) | U(1)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(30))) * B
    x = (x ^ (x >> U(27))) * C
    return x ^ (x >> U(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    both = []
    for base in (int(A), pow(int(A), -1, 1 << 64)):
        up = np.full(n, base, U)
        up[:1] = 1
        both.append(np.multiply.accumulate(up))
    return both[0], both[1]


_CACHE: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def words_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, and where each text's begin (one more for the end)."""
    data = np.frombuffer(("\n".join(texts) + "\n").encode(), np.uint8)
    size = max(len(data), CHUNK_BYTES + 65536)
    if size not in _CACHE:
        _CACHE.clear()
        _CACHE[size] = _powers(size)
    up, down = (p[:len(data)] for p in _CACHE[size])
    blank = (data == 32) | ((data >= 9) & (data <= 13))
    edge = np.flatnonzero(blank[1:] != blank[:-1]) + 1
    if len(data) and not blank[0]:
        edge = np.append(0, edge)
    begin, end = edge[::2], edge[1::2]
    total = np.zeros(len(data) + 1, U)
    np.cumsum((data.astype(U) + U(1)) * up, out=total[1:])
    word = mix((total[end] - total[begin]) * down[begin])
    last = np.cumsum([len(t.encode()) + 1 for t in texts])
    return word, np.concatenate([[0], np.searchsorted(begin, last)])


def shingles(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the labelled shingles of all texts, and where each text's begin (one more for the end)."""
    word, first = words_of(texts)
    n = np.diff(first)
    kept = np.where(n == 0, 0, np.maximum(n - WORDS + 1, 1))
    starts = np.concatenate([[0], np.cumsum(kept)])
    at = np.repeat(first[:-1] - starts[:-1], kept) + np.arange(starts[-1])
    padded = np.concatenate([word, np.zeros(WORDS, U)])
    out = np.zeros(len(at), U)
    for k in range(WORDS):
        out = out * A + padded[at + k]
    for i in np.flatnonzero((n > 0) & (n < WORDS)):
        value = U(0)
        with np.errstate(over="ignore"):
            for k in range(first[i], first[i + 1]):
                value = value * A + word[k]
        out[starts[i]] = value
    out = mix(out)
    owner = np.repeat(np.arange(len(texts)), kept)
    again = np.flatnonzero(pd.Series(out ^ mix(owner.astype(U) + A)).duplicated(keep=False).to_numpy())
    if len(again):
        order = again[np.lexsort((again, out[again], owner[again]))]
        same = (out[order][1:] == out[order][:-1]) & (owner[order][1:] == owner[order][:-1])
        run = np.concatenate([[True], ~same])
        label = np.arange(len(order)) - np.maximum.accumulate(np.where(run, np.arange(len(order)), 0))
        out[order] = np.where(label > 0, mix(out[order] + label.astype(U) * C), out[order])
    return out, starts


def sketches(texts: list[str]) -> np.ndarray:
    """``SKETCHES`` 64-bit keys per text (texts with words only): its least shingles in text order."""
    values, starts = shingles(texts)
    begin, n = starts[:-1], np.diff(starts)
    keys = np.zeros((len(texts), SKETCHES), U)
    owner = np.repeat(np.arange(len(texts)), n)
    most = U(0xFFFFFFFFFFFFFFFF)
    for i, (xor, times) in enumerate(SEEDS):
        v = (values ^ xor) * times
        places = []
        for _ in range(LEAST):
            least = np.minimum.reduceat(v, begin)
            hit = np.flatnonzero(v == least[owner])
            place = hit[np.searchsorted(hit, begin)]
            places.append(np.where(least == most, -1, place))
            v[place] = most
        order = np.sort(np.stack(places, 1), axis=1)
        key = np.full(len(texts), U(i + 1))
        for j in range(LEAST):
            key = mix(key * A + np.where(order[:, j] < 0, U(0), values[order[:, j]]))
        keys[:, i] = key
    return keys


def _parts(texts: list[str]):
    begin, size = 0, 0
    for i, t in enumerate(texts):
        if i > begin and size + len(t) > CHUNK_BYTES // 2:
            yield begin, i
            begin, size = i, 0
        size += len(t)
    if begin < len(texts):
        yield begin, len(texts)


def signatures(docs: DataFrame) -> DataFrame:
    """``node, keys`` per distinct text with words; the node is the text's 128-bit digest."""
    def run(batches):
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for begin, end in _parts(texts):
                keys = sketches(texts[begin:end]).astype(np.int64)
                flat = pa.ListArray.from_arrays(pa.array(np.arange(0, keys.size + 1, SKETCHES), pa.int32()), pa.array(keys.ravel()))
                yield pa.RecordBatch.from_arrays([batch.column("node").slice(begin, end - begin), flat], ["node", "keys"])
    worded = docs.filter(F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    return worded.mapInArrow(run, "node binary, keys array<long>").dropDuplicates(["node"])


def aligned(a: list[int], b: list[int], band: int) -> int:
    """Length of the longest common subsequence of two lists whose places differ by ``band`` at most.

    Bit i of ``open_`` is 0 where the best alignment of a[:i + 1] is longer than that of a[:i]; a word of b moves these
    places at its matches, all in one addition.
    """
    places: dict[int, int] = {}
    for i, word in enumerate(a):
        places[word] = places.get(word, 0) | 1 << i
    whole = (1 << len(a)) - 1
    width = (1 << (2 * band + 1)) - 1
    open_ = whole
    for j, word in enumerate(b):
        match = places.get(word, 0)
        if match:
            match &= width << (j - band) if j > band else width >> (band - j)
            hit = open_ & match
            open_ = ((open_ + hit) | (open_ - hit)) & whole
    return len(a) - open_.bit_count()


def similarity(a: np.ndarray, b: np.ndarray, least: float = SIMILARITY) -> float:
    """Aligned share of two sequences of words; 0 where it is certain to be below ``least``."""
    n, k = len(a), len(b)
    if not n or not k or min(n, k) < least * max(n, k):
        return 0.0
    needed = least / (1 + least) * (n + k)
    if n == k and (a == b).sum() == n:
        return 1.0
    words, (more, fewer) = np.unique(np.concatenate([a, b])), (np.sort(a), np.sort(b))
    both = [np.searchsorted(x, words, "right") - np.searchsorted(x, words) for x in (more, fewer)]
    if np.minimum(*both).sum() < needed - 1e-9:
        return 0.0
    band = int(n + k - 2 * needed + 1e-9)
    m = aligned(a.tolist(), b.tolist(), band)
    return m / (n + k - m) if m >= needed - 1e-9 else 0.0


def linked(pairs: DataFrame, texts: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """``u, v, similarity`` of the pairs (u, v) of nodes that are at least so similar."""
    def run(batches):
        for batch in batches:
            left, right = batch.column("a").to_pylist(), batch.column("b").to_pylist()
            found = []
            for begin, end in _parts([x + y for x, y in zip(left, right, strict=True)]):
                (a, at), (b, bt) = words_of(left[begin:end]), words_of(right[begin:end])
                found += [similarity(a[at[k]:at[k + 1]], b[bt[k]:bt[k + 1]], least) for k in range(end - begin)]
            found = np.array(found)
            ok = pa.array(found >= least - 1e-12)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c).filter(ok) for c in "uv"), pa.array(found).filter(ok)], ["u", "v", "similarity"])
    sides = [texts.select(F.col("node").alias(n), F.col("text").alias(t)) for n, t in (("u", "a"), ("v", "b"))]
    both = pairs.join(sides[0], "u").join(sides[1], "v").select("u", "v", "a", "b")
    return both.mapInArrow(run, "u binary, v binary, similarity double")


def candidates(members: DataFrame) -> DataFrame:
    """Pairs to compare, from members (key, node): all of a bucket of ``ALL_PAIRS`` nodes, and each with the first of a larger one."""
    order = F.struct(F.xxhash64("key", "node"), "node")
    sizes = members.groupBy("key").agg(F.count("*").alias("n"), F.min(order)["node"].alias("first")).filter("n > 1")
    inside = members.join(sizes, "key")
    star = inside.filter((F.col("n") > ALL_PAIRS) & (F.col("node") != F.col("first"))).select(
        F.least("first", "node").alias("u"), F.greatest("first", "node").alias("v"))
    few = inside.filter(F.col("n") <= ALL_PAIRS).groupBy("key").agg(F.sort_array(F.collect_list("node")).alias("all"))
    later = F.slice("all", F.col("i") + 2, F.size("all"))
    every = few.select("all", F.posexplode("all").alias("i", "u")).select("u", F.explode(later).alias("v"))
    return star.unionByName(every).distinct()


def labelled_words(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word and occurrence in its text as one hash, the text's number, and how many words the texts have."""
    word, first = words_of(texts)
    n = np.diff(first)
    owner = np.repeat(np.arange(len(texts)), n)
    times = pd.DataFrame({"owner": owner, "word": word}).groupby(["owner", "word"], sort=False).cumcount().to_numpy()
    return mix(word + times.astype(U) * C), owner, n


def rarity(texts: DataFrame) -> np.ndarray:
    """How many labelled words fall into each of ``RANKS`` classes of their hash: a table of fixed size that orders words by rarity."""
    def run(batches):
        total = np.zeros(RANKS, np.int64)
        for batch in batches:
            found = batch.column("text").to_pylist()
            for begin, end in _parts(found):
                token, _, _ = labelled_words(found[begin:end])
                total += np.bincount((token % U(RANKS)).astype(np.int64), minlength=RANKS)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["at", "n"])

    out = np.zeros(RANKS, np.int64)
    for r in texts.select("text").mapInArrow(run, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).collect():
        out[r["at"]] = r["n"]
    return out


def prefixes(texts: DataFrame, ranks: np.ndarray, least: float = SIMILARITY) -> DataFrame:
    """``token, place, node, root, n, marks, before``: the rarest labelled words of each text, one of which any similar text has among its own.

    ``marks`` holds the parity of the labelled words in each of ``MARKS`` classes of their hash: where two texts differ in
    d words, their marks differ in d places at most.  ``before`` holds the ``BEFORE`` words that come before this one.
    """
    shared = texts.sparkSession.sparkContext.broadcast(ranks)

    def run(batches):
        for batch in batches:
            found = batch.column("text").to_pylist()
            for begin, end in _parts(found):
                token, owner, n = labelled_words(found[begin:end])
                order = np.lexsort((token, shared.value[(token % U(RANKS)).astype(np.int64)], owner))
                place = np.arange(len(token)) - np.repeat(np.cumsum(n) - n, n)
                odd = np.zeros((end - begin, MARKS), np.uint8)
                np.add.at(odd, (owner, (token >> U(40)).astype(np.int64) % MARKS), 1)
                marks = np.packbits(odd & 1, axis=1, bitorder="little").view(np.int64)
                marks = pa.FixedSizeListArray.from_arrays(pa.array(marks.ravel()), MARKS // 64).cast(pa.list_(pa.int64()))
                inside = place < (n - np.ceil(least * n - 1e-9) + 1)[owner]
                kept = order[inside]
                who = pa.array(owner[kept] + begin)
                m = np.minimum(place[inside], BEFORE)
                ends = np.cumsum(m)
                back = np.repeat(np.flatnonzero(inside) - m, m) + np.arange(m.sum()) - np.repeat(ends - m, m)
                before = pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), pa.array(token[order[back]].astype(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(token[kept].astype(np.int64)), pa.array(place[inside]), batch.column("node").take(who),
                     batch.column("root").take(who), pa.array(n[owner[kept]].astype(np.int64)),
                     marks.take(pa.array(owner[kept])), before], ["token", "place", "node", "root", "n", "marks", "before"])
    names = "token long, place long, node binary, root binary, n long, marks array<long>, before array<long>"
    return texts.select("node", "root", "text").mapInArrow(run, names)


def meeting(found: DataFrame) -> DataFrame:
    """Rows of ``found`` whose word may pair their text with one of another class, and ``light``: not of the class that holds the word most often.

    Behind a word that two similar texts share, ``SHARE`` of all their words are left in both.  The shorter text then has
    twice ``SHARE`` of its own left (its row is short), so a word without short rows pairs nothing, and a row that is not
    short needs a short one of a length within its reach.
    """
    left = F.col("n") - F.col("place")
    short = left >= 2 * SHARE * F.col("n") - 1e-9
    least, most = (f(F.when(short, F.col("n"))) for f in (F.min, F.max))
    held = found.groupBy("token", "root").agg(F.count("*").alias("rows"), least.alias("least"), most.alias("most"))
    words = held.groupBy("token").agg(F.max(F.struct("rows", "root"))["root"].alias("heavy"), F.count("*").alias("classes"),
                                      F.min("least").alias("least"), F.max("most").alias("most"))
    reach = (F.col("least") <= left / SHARE - F.col("n") + 1e-6) & (F.col("most") >= SIMILARITY * F.col("n") - 1e-6)
    both = found.join(words.filter("classes > 1 and least is not null"), "token").filter(short | reach)
    return both.select(*found.columns, (F.col("root") != F.col("heavy")).alias("light"))


def rest_pairs(members: DataFrame, texts: DataFrame) -> DataFrame:
    """``u, v``: all pairs of texts of different classes among the members that may be similar.

    At each word the texts of its largest class meet the others but not each other: a class of any size costs rows, not pairs.
    """
    named = members.join(texts, "node").select("node", "root", "text")
    met = materialize(meeting(materialize(prefixes(named, rarity(named)), "prefixes")), "meeting")
    right = met.select("token", *(F.col(c).alias(f"_{c}") for c in met.columns if c != "token"))
    # Behind the first word that two texts share there must be enough words left in both.
    needed = SHARE * (F.col("n") + F.col("_n")) - 1e-9
    near = F.least(F.col("n") - F.col("place"), F.col("_n") - F.col("_place")) >= needed
    apart = sum(F.bit_count(F.col("marks")[i].bitwiseXOR(F.col("_marks")[i])) for i in range(MARKS // 64))
    near = near & (apart <= F.col("n") + F.col("_n") - 2 * needed)
    # Prefixes have one order for all texts: two that share a word just before this one have met there, where more words were left.
    near = near & ~F.arrays_overlap("before", "_before")
    once = ~F.col("_light") | (F.col("node") < F.col("_node"))
    both = met.filter("light").join(right, "token").filter((F.col("root") != F.col("_root")) & once & near)
    return both.select(F.least("node", "_node").alias("u"), F.greatest("node", "_node").alias("v")).distinct()


def mixed(signed: DataFrame, roots: DataFrame) -> DataFrame:
    """``node, root`` of the members of large buckets that hold several classes.

    Classes are looked up per text, before its keys are listed, and buckets are judged by an aggregate; only members
    of mixed buckets pass a join.
    """
    known = signed.join(roots.withColumnRenamed("root", "_r"), "node", "left")
    placed = known.select("node", F.coalesce("_r", "node").alias("root"), F.explode("keys").alias("key"))
    buckets = placed.groupBy("key").agg(F.count("*").alias("n"), F.min("root").alias("lo"), F.max("root").alias("hi"))
    several = buckets.filter((F.col("n") > ALL_PAIRS) & (F.col("lo") != F.col("hi"))).select("key")
    return materialize(placed.join(several, "key", "left_semi").select("node", "root").distinct(), "mixed")


def node_roots(docs: DataFrame) -> DataFrame:
    """``node, root`` of all texts that are linked to another text, but the roots; ``docs`` holds ``node`` and ``text``."""
    signed = materialize(signatures(docs), "signatures")
    pairs = materialize(candidates(signed.select("node", F.explode("keys").alias("key"))), "pairs")
    wanted = pairs.select(F.explode(F.array("u", "v")).alias("node")).distinct()
    texts = materialize(docs.dropDuplicates(["node"]).select("node", "text").join(wanted, "node", "left_semi"), "texts")
    roots = components(materialize(linked(pairs, texts), "linked").select("u", "v"))
    rest = mixed(signed, roots)
    if rest.isEmpty():
        return roots
    found = materialize(linked(materialize(rest_pairs(rest, texts), "pairs"), texts), "linked").select("u", "v")
    return components(roots.select(F.col("node").alias("u"), F.col("root").alias("v")).unionByName(found))


def classes(docs: DataFrame) -> DataFrame:
    """``node, class_id, keeper`` per distinct text: the least id of its class, and whether the class keeps this text."""
    docs = with_nodes(docs).select("doc_id", "node", "text")
    nodes = docs.groupBy("node").agg(F.min("doc_id").alias("least"))
    placed = nodes.join(node_roots(docs.select("node", "text")), "node", "left").withColumn("root", F.coalesce("root", "node"))
    best = placed.groupBy("root").agg(F.min(F.struct(F.col("least").isNull().alias("no"), "least", "node")).alias("best"))
    return placed.join(best, "root").select("node", F.col("best.least").alias("class_id"), "least",
                                            (F.col("node") == F.col("best.node")).alias("keeper"))


def with_nodes(docs: DataFrame) -> DataFrame:
    return docs.filter(F.col("text").isNotNull()).withColumn("node", F.unhex(F.md5("text")))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, class_id`` for every row."""
    docs = docs.select("doc_id", "text")
    found = with_nodes(docs).select("doc_id", "node").join(classes(docs).select("node", "class_id"), "node")
    alone = docs.filter(F.col("text").isNull()).select("doc_id", F.col("doc_id").alias("class_id"))
    return found.select("doc_id", "class_id").unionByName(alone)


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of each class, with all its columns: the one with the least id.  Rows without a text stay."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    base = docs.select(row, F.col("doc_id"), F.col("text"))
    keepers = classes(docs.select("doc_id", "text")).filter("keeper").select("node", "least")
    kept = with_nodes(base).join(keepers, "node").filter(F.col("doc_id").eqNullSafe(F.col("least")))
    kept = kept.dropDuplicates(["node"]).select("row.*")
    return kept.unionByName(base.filter(F.col("text").isNull()).select("row.*"))


def query(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
