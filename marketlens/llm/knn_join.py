"""Exact top-k search by inner product: a Voronoi join with distance bounds.

Vectors belong to the nearest of some pivots, themselves vectors of the table.  Per pivot a summary keeps the
k + 1 least distances of its vectors.  For a query q and a vector x at distance d from its pivot p,

    q.p - |q| d  <=  q.x  <=  q.p + |q| d

so the summaries give each query a score that k others surely reach, and each group of queries, per pivot, a
distance from which on a vector can be among the best.  A vector is sent to the groups that may need it and to
no others, and each group is solved locally, a part of its vectors at a time.  Bounds are kept a little wide, so
rounding drops nothing; scores are exact integers.

The number of pivots and of groups is bounded (``PIVOTS``, ``GROUPS``), so summaries and bounds are small tables
that go through the driver; vectors and queries don't.  A group's vectors are spread over tasks, each of which
reads them as a stream and keeps the best k per query.  Directions that are spread evenly in many dimensions
leave the bounds little to prune; then every group reads nearly all vectors, in blocks of queries.

Vectors that are null, hold a null or non-finite component, have no id or another length than most take no part.
Equal rows count once, a query is never its own result.  Ties go to the lesser id.  Fewer than k rows give all.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from marketlens.session import materialize

PIVOTS = 32
GROUPS = 4096
GROUP_QUERIES = 512
TASK_VECTORS = 5_000_000
SLICE = 4096
SLACK = 1e-6


def integer_vectors(df: DataFrame, scale: int = 1024) -> DataFrame:
    """``vec_id, v``: the rows that take part, with components floor(scale * x)."""
    value = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale))
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    found = df.select("vec_id", "embedding").filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & fine)
    return found.select("vec_id", value.alias("v")).distinct()


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy().reshape(-1, width)


def pick_pivots(vectors: DataFrame) -> np.ndarray:
    rows = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(PIVOTS).collect()
    return np.array([r["v"] for r in rows], np.float64)


def assign(vectors: DataFrame, pivots: np.ndarray) -> DataFrame:
    """Adds ``cell``, the nearest pivot, and ``d``, the distance to it."""
    shared = vectors.sparkSession.sparkContext.broadcast(pivots)

    def run(batches):
        p = shared.value
        for batch in batches:
            x = _matrix(batch.column("v"), p.shape[1]).astype(np.float64)
            cell = ((p * p).sum(1) - 2 * x @ p.T).argmin(1) if len(x) else np.zeros(0, np.int64)
            d = np.sqrt(((x - p[cell]) ** 2).sum(1))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell.astype(np.int32)), pa.array(d)], ["vec_id", "v", "cell", "d"])
    return vectors.mapInArrow(run, "vec_id long, v array<long>, cell int, d double")


def summaries(assigned: DataFrame, k: int) -> list[np.ndarray]:
    """Per pivot the k + 1 least distances of its vectors."""
    near = Window.partitionBy("cell").orderBy("d", "vec_id")
    rows = assigned.select("cell", "d", "vec_id").withColumn("n", F.row_number().over(near)).filter(F.col("n") <= k + 1).collect()
    return [np.sort([r["d"] for r in rows if r["cell"] == j]) for j in range(PIVOTS)]


def _least_scores(q: np.ndarray, pivots: np.ndarray, near: list[np.ndarray], k: int) -> np.ndarray:
    """For each query a score that k vectors beside itself surely reach."""
    size = np.linalg.norm(q, axis=1)
    sure = [(q @ pivots[j])[:, None] - size[:, None] * near[j] for j in range(len(pivots)) if len(near[j])]
    sure = np.concatenate(sure, axis=1)
    if sure.shape[1] < k + 1:
        return np.full(len(q), -np.inf)
    return np.partition(sure, -(k + 1), axis=1)[:, -(k + 1)]


def needed_from(queries: DataFrame, pivots: np.ndarray, near: list[np.ndarray], k: int, groups: int) -> np.ndarray:
    """For each group and pivot the distance from which on a vector may be among the best of a query of the group."""
    shared = queries.sparkSession.sparkContext.broadcast((pivots, near))

    def run(batches):
        p, near = shared.value
        for batch in batches:
            if not len(batch):
                continue
            q = _matrix(batch.column("v"), p.shape[1]).astype(np.float64)
            size = np.maximum(np.linalg.norm(q, axis=1), 1e-9)
            slack = SLACK * (1 + size * np.abs(p).sum(1).max())
            limit = (_least_scores(q, p, near, k)[:, None] - slack[:, None] - q @ p.T) / size[:, None]
            group = batch.column("part").to_numpy()
            found, at = np.unique(group, return_inverse=True)
            least = np.full((len(found), len(p)), np.inf)
            np.minimum.at(least, at, limit)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(found, len(p))), pa.array(np.tile(np.arange(len(p), dtype=np.int32), len(found))), pa.array(least.ravel())],
                ["part", "cell", "least"])
    out = np.full((groups, len(pivots)), np.inf)
    found = queries.mapInArrow(run, "part int, cell int, least double").groupBy("part", "cell").agg(F.min("least").alias("least"))
    for r in found.collect():
        out[r["part"], r["cell"]] = r["least"]
    return out


def _group_column(queries: DataFrame) -> tuple[Column, int]:
    """The group of a query: neighbouring cells together up to a size, larger cells divided; and how many groups there are."""
    counts = {r["cell"]: r["count"] for r in queries.groupBy("cell").count().collect()}
    size = max(GROUP_QUERIES, math.ceil(sum(counts.values()) / (GROUPS - PIVOTS)))
    start, parts, filled, n = [], [], 0, 0
    for cell in range(PIVOTS):
        c = counts.get(cell, 0)
        if filled and filled + c > size:
            n, filled = n + 1, 0
        start.append(n)
        parts.append(max(1, math.ceil(c / size)))
        filled += c
        if parts[-1] > 1:
            n, filled = n + parts[-1], 0
    at = lambda values: F.get(F.array(*[F.lit(v) for v in values]), F.col("cell"))
    return (at(start) + F.pmod(F.xxhash64("vec_id"), at(parts))).cast("int"), n + 1


def _solved(rows: DataFrame, width: int, k: int) -> DataFrame:
    """Best k per query within each task group; rows are sorted by group, the queries of a group come first."""
    def run(batches):
        key, ids, q, data, held = None, [], [], [], 0
        best: tuple[np.ndarray, ...] | None = None

        def solve():
            nonlocal data, held, best, q
            if isinstance(q, list):
                q = np.concatenate(q) if q else np.zeros((0, width), np.int64)
                best = (np.zeros(0, np.int64),) * 3
            if data and len(q):
                best = _better(best, np.concatenate(ids), q, np.concatenate([i for i, _ in data]), np.concatenate([v for _, v in data]), k)
            data, held = [], 0

        def finished():
            solve()
            if len(q) and len(best[0]):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(ids)[best[0]]), pa.array(best[1]), pa.array(best[2])], ["query_id", "vec_id", "score"])

        for batch in batches:
            keys, kind = batch.column("key").to_numpy(), batch.column("kind").to_numpy()
            vec, v = batch.column("vec_id").to_numpy(), _matrix(batch.column("v"), width)
            cuts = np.flatnonzero((keys[1:] != keys[:-1]) | (kind[1:] != kind[:-1])) + 1
            for part in np.split(np.arange(len(keys)), cuts):
                if not len(part):
                    continue
                if keys[part[0]] != key:
                    if key is not None:
                        yield from finished()
                    key, ids, q, data, held, best = keys[part[0]], [], [], [], 0, None
                if kind[part[0]] == 0:
                    ids.append(vec[part])
                    q.append(v[part])
                    continue
                for at in range(0, len(part), SLICE):
                    some = part[at:at + SLICE]
                    data.append((vec[some], v[some]))
                    held += len(some)
                    if held >= SLICE:
                        solve()
        if key is not None:
            yield from finished()

    return rows.mapInArrow(run, "query_id long, vec_id long, score long")


def _better(best, ids, q, vec, v, k):
    """The best k per query of those so far and of some more vectors, as (query number, vector id, score)."""
    exact = float(np.abs(q).max(initial=0)) * float(np.abs(v).max(initial=0)) * q.shape[1] < 2.0 ** 53
    rows, cols, scores = [best[0]], [best[1]], [best[2]]
    for at in range(0, len(q), 512):
        part = q[at:at + 512]
        s = (part.astype(float) @ v.T.astype(float)).astype(np.int64) if exact else part.astype(object).dot(v.T.astype(object)).astype(np.int64)
        other = ids[at:at + 512, None] != vec[None, :]
        if len(vec) > k + 1:
            limit = np.partition(np.where(other, s, np.iinfo(np.int64).min), -k, axis=1)[:, -k]
            other &= s >= limit[:, None]
        r, c = np.nonzero(other)
        rows.append(r + at)
        cols.append(vec[c])
        scores.append(s[r, c])
    row, col, score = map(np.concatenate, (rows, cols, scores))
    order = np.lexsort((col, -score, row))
    row = row[order]
    first = np.searchsorted(row, row)
    keep = order[np.arange(len(row)) - first < k]
    return np.concatenate(rows)[keep], col[keep], score[keep]


def top_k(df: DataFrame, is_query: Column, k: int = 10, scale: int = 1024) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the k highest inner products of each row that ``is_query`` names."""
    spark = df.sparkSession
    vectors = integer_vectors(df, scale)
    usual = vectors.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    width = usual["n"] if usual else 0
    vectors = materialize(vectors.filter(F.size("v") == width), "vectors")
    pivots = pick_pivots(vectors)
    if not len(pivots) or not width:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    assigned = materialize(assign(vectors, pivots), "cells")
    near = summaries(assigned, k)
    queries = assigned.filter(is_query)
    group, groups = _group_column(queries)
    queries = queries.withColumn("part", group)
    limits = spark.sparkContext.broadcast(needed_from(queries, pivots, near, k, groups))
    n = assigned.count()
    salts = max(math.ceil(int(spark.conf.get("spark.sql.shuffle.partitions")) / groups), math.ceil(n / TASK_VECTORS))

    def send(batches):
        for batch in batches:
            cell, d = batch.column("cell").to_numpy(), batch.column("d").to_numpy()
            salt = batch.column("salt").to_numpy()
            for part in range(groups):
                here = np.flatnonzero(d * (1 + SLACK) >= limits.value[part][cell])
                if len(here):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(part * salts + salt[here]), pa.array(np.ones(len(here), np.int32)),
                         *(batch.column(c).take(pa.array(here)) for c in ("vec_id", "v"))], ["key", "kind", "vec_id", "v"])

    salted = assigned.withColumn("salt", F.pmod(F.xxhash64("vec_id", F.lit(7)), F.lit(salts)).cast("long"))
    sent = salted.select("vec_id", "v", "cell", "d", "salt").mapInArrow(send, "key long, kind int, vec_id long, v array<long>")
    first = F.col("part").cast("long") * salts
    asked = queries.select(F.explode(F.sequence(first, first + (salts - 1))).alias("key"), F.lit(0).alias("kind"), "vec_id", "v")
    rows = asked.unionByName(sent).repartition("key").sortWithinPartitions("key", "kind")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = _solved(rows, width, k).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def query(spark, sf_dir: str) -> DataFrame:
    return top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 100 == 0)


def oracle() -> str:
    return """
WITH v AS (SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, v.vec_id, list_dot_product(q.v, v.v)::BIGINT AS score
      FROM v AS q JOIN v ON q.vec_id <> v.vec_id WHERE q.vec_id % 100 = 0),
r AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score FROM s)
SELECT * FROM r WHERE rank <= 10"""
