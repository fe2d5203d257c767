"""Best-fit packing of token sequences by large-item matching.

How pieces go together depends on their lengths alone, of which there are no more than ``capacity``.  So the
plan is made from the count of each length: pieces above a third of the capacity pair greedily, each with the
longest one that fits beside it; smaller ones, longest first, go to the fullest sequence that still takes them.
The plan says which numbers of each length (its first piece, its second, ...) go to which sequences, in at most
some tens of thousands of ranges, however many pieces there are.  Spark counts the lengths, numbers the pieces
of each length (by salted groups, so a common length is no hot group) and looks their places up.

A document's ids end with the end-of-text id, so null and empty texts are one id.  Only documents longer than
the capacity are cut, into full pieces; what remains is the first piece.  Repeated rows are packed like any others.
"""

from __future__ import annotations

import json
import re
import zlib
from bisect import bisect_left

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from marketlens.session import materialize

from .bpe import encoder
from .pretokens import Block, expand, text_blocks

CAPACITY = 1024
END_ID = 2
BLOCK_BYTES = 8_000_000


def read_vocabulary(path: str) -> dict[bytes, int]:
    """Token bytes and ids of a byte-level BPE file in JSON, whose merges are in the order of their ids.

    Its tokens are written with one printable character per byte: printable bytes stand for themselves, the
    others, in order, for the characters from 256 on.  Added tokens are left out: ``read_added`` has them.
    """
    with open(path, encoding="utf-8") as file:
        found = json.load(file)
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    to_byte = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}
    special = {t["content"] for t in found.get("added_tokens", [])}
    return {bytes(to_byte[c] for c in token): i for token, i in found["model"]["vocab"].items() if token not in special}


def read_added(path: str) -> dict[str, int]:
    """Contents and ids of the added tokens of such a file.  A text is split at them, wherever they stand."""
    with open(path, encoding="utf-8") as file:
        tokens = json.load(file).get("added_tokens", [])
    if any(t.get(k) for t in tokens for k in ("single_word", "lstrip", "rstrip", "normalized")):
        raise ValueError("only added tokens that match as they are written can be read")
    return {t["content"]: t["id"] for t in tokens}


def pieces(docs: DataFrame, vocabulary: dict[bytes, int], pattern: str, capacity: int = CAPACITY, end_id: int = END_ID,
           with_ids: bool = False, added: dict[str, int] | None = None) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` of every piece of every row, and its ``ids`` if asked for."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    added = added or {}
    fields = [docs.schema["doc_id"], T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()),
              T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType())]
    fields += [T.StructField("ids", T.BinaryType())] * with_ids

    def run(batches):
        encode = encoder(shared.value, pattern)
        splitter = re.compile(f"({'|'.join(map(re.escape, sorted(added, key=len, reverse=True)))})") if added else None
        for batch in batches:
            for part, texts in text_blocks(batch, BLOCK_BYTES):
                split = [splitter.split(t) if splitter else [t] for t in texts]  # text, added token, text, ...
                block = Block([t for parts in split for t in parts[::2]])
                each = [encode(w) for w in block.words]
                lengths = np.array([len(x) for x in each], np.int64)
                flat = np.fromiter((i for x in each for i in x), "<u4", int(lengths.sum()))
                offsets = np.cumsum(lengths) - lengths
                row, number, start, length, crc, ids, at = [], [], [], [], [], [], 0
                counts = iter(block.counts.tolist())
                for i, parts in enumerate(split):
                    encoded = []
                    for k in range(0, len(parts), 2):
                        n = next(counts)
                        after = added[parts[k + 1]] if k + 1 < len(parts) else end_id
                        encoded += [expand(block.codes[at:at + n], lengths, offsets, flat), np.array([after], "<u4")]
                        at += n
                    own = np.concatenate(encoded)
                    data, size = memoryview(own.tobytes()), len(own)
                    cuts = [0, *range(size % capacity or capacity, size + 1, capacity)]
                    for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
                        row.append(i)
                        number.append(k)
                        start.append(a)
                        length.append(b - a)
                        crc.append(zlib.crc32(data[4 * a:4 * b]))
                        if with_ids:
                            ids.append(bytes(data[4 * a:4 * b]))
                columns = [part.column("doc_id").take(pa.array(row, pa.int64())), pa.array(number, pa.int32()),
                           pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
                yield pa.RecordBatch.from_arrays([*columns, *[pa.array(ids, pa.binary())] * with_ids], [f.name for f in fields])
    return docs.select("doc_id", "text").mapInArrow(run, T.StructType(fields))


def plan(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Ranges (length, first number, first sequence, pieces of it per sequence, offset of the first of them).

    Piece r of a length is in the last range of it with first number f <= r: in sequence s + (r - f) // per, at
    offset + (r - f) % per * length.  Sequences with equal contents are handled as one group (s, n), so the
    work depends on the capacity alone.
    """
    left = {n: c for n, c in counts.items() if c > 0}
    if any(not 0 < n <= capacity for n in left):
        raise ValueError("lengths must be from 1 to the capacity")
    ranges, used, sequences = [], dict.fromkeys(left, 0), 0
    gaps: dict[int, list[tuple[int, int]]] = {}

    def put(length, first, count, per, offset):
        ranges.append((length, used[length], first, per, offset))
        used[length] += count * per
        left[length] -= count * per

    large = sorted(n for n in left if 3 * n > capacity)
    while large:
        a = large[-1]
        fits = bisect_left(large, capacity - a + 1) - 1
        b = large[fits] if fits >= 0 else None
        if b == a and left[a] == 1:
            b = large[fits - 1] if fits > 0 else None
        count = left[a] if b is None else left[a] // 2 if a == b else min(left[a], left[b])
        if a == b:
            put(a, sequences, count, 2, 0)
        else:
            put(a, sequences, count, 1, 0)
            if b is not None:
                put(b, sequences, count, 1, a)
        gaps.setdefault(capacity - a - (b or 0), []).append((sequences, count))
        sequences += count
        large = [n for n in large if left[n]]
    open_gaps = sorted(g for g in gaps if g)
    for length in sorted((n for n in left if 3 * n <= capacity), reverse=True):
        while left[length]:
            at = bisect_left(open_gaps, length)
            if at == len(open_gaps):
                gap, first, count = capacity, sequences, -(-left[length] // (capacity // length))
                sequences += count
            else:
                gap = open_gaps[at]
                first, count = gaps[gap].pop()
                if not gaps[gap]:
                    del gaps[gap], open_gaps[at]
            per = gap // length
            full = min(count, left[length] // per)
            parts = [(first, full, per), (first + full, min(1, count - full), left[length] - full * per)]
            spare = count - full
            for s, n, k in parts:
                if n and k and left[length]:
                    k = min(k, per)
                    put(length, s, n, k, capacity - gap)
                    _open(gaps, open_gaps, gap - k * length, s, n)
                    spare -= n if s != first or not full else 0
            if spare > 0:
                _open(gaps, open_gaps, gap, first + count - spare, spare)
    return ranges


def _open(gaps, open_gaps, gap, first, count) -> None:
    if gap:
        if gap not in gaps:
            open_gaps.insert(bisect_left(open_gaps, gap), gap)
        gaps.setdefault(gap, []).append((first, count))


def place(found: DataFrame, capacity: int = CAPACITY, salts: int | None = None) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to stored pieces (read three times: to count, to number, to place)."""
    spark = found.sparkSession
    salts = salts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [c for c in ("doc_id", "piece", "start", "ids_crc32") if c in found.columns]
    found = found.withColumn("_salt", F.pmod(F.xxhash64(*keys), F.lit(salts)))
    sizes = found.groupBy("length", "_salt").count()
    counts = {r["length"]: r["n"] for r in sizes.groupBy("length").agg(F.sum("count").alias("n")).collect()}
    ranges = sorted(plan(counts, capacity))
    columns = [np.array(c, np.int64) for c in zip(*ranges, strict=True)] if ranges else [np.zeros(0, np.int64)] * 5
    shared = spark.sparkContext.broadcast(columns)

    @F.pandas_udf("sequence_id long, offset long")
    def places(length: pd.Series, number: pd.Series) -> pd.DataFrame:
        lengths, firsts, sequences, per, offsets = shared.value
        n, r = length.to_numpy(), number.to_numpy()
        at = np.searchsorted((lengths << 42) + firsts, (n << 42) + r, "right") - 1
        r = r - firsts[at]
        return pd.DataFrame({"sequence_id": sequences[at] + r // per[at], "offset": offsets[at] + r % per[at] * n})

    before = Window.partitionBy("length").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("length", "_salt", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_before"))
    within = F.row_number().over(Window.partitionBy("length", "_salt").orderBy(*keys)) - 1
    numbered = found.withColumn("_n", within).join(sizes, ["length", "_salt"])
    placed = numbered.withColumn("_at", places("length", F.col("_before") + F.col("_n")))
    return placed.select(*[c for c in found.columns if c != "_salt"], "_at.sequence_id", "_at.offset")


def sequences(placed: DataFrame) -> DataFrame:
    """One row per sequence with its ids, for pieces that carry theirs; a sequence has no more than its capacity."""
    parts = F.array_sort(F.collect_list(F.struct("offset", F.hex("ids").alias("ids"))))
    return placed.groupBy("sequence_id").agg(F.sum("length").alias("length"), F.unhex(F.concat_ws("", parts["ids"])).alias("ids"))


def pack(docs: DataFrame, vocabulary: dict[bytes, int], pattern: str, capacity: int = CAPACITY, end_id: int = END_ID,
         with_ids: bool = False, added: dict[str, int] | None = None) -> DataFrame:
    """A row per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``."""
    return place(materialize(pieces(docs, vocabulary, pattern, capacity, end_id, with_ids, added), "pieces"), capacity)


def pack_documents(docs: DataFrame) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    done = pack(docs, read_vocabulary(path), public_tokenizers.PATTERN, added=read_added(path))
    return done.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def query(spark, sf_dir: str) -> DataFrame:
    return pack_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
