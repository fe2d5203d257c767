"""Byte-level BPE by a global shuffle of distinct words, and decoding by a lookup in the token-byte table.

Encoding, with a shuffle for each arrow:

1. A task cuts its documents into blocks and splits every text into pre-tokens.  It emits a row (word, place)
   per distinct word of a block, and one row per block with the positions: for each document the places of
   its pre-tokens, in order.
2. words -> by word: sorted, so equal words of all blocks meet; each distinct word is encoded once and its ids
   are joined to all its places.  A word has at most one row per block, however often it occurs.
3. ids and positions -> by block: a block's words are put back at their positions.

Blocks are numbered by task, so ``docs`` must be read from files (or be another frame whose partitions are the
same on each evaluation).  A block whose words and positions do not belong together raises an error.

Null texts count as empty and have no ids.  Repeated rows are kept, each with its own result.  Texts of any
length are encoded whole; a text longer than a block is a block of its own.  Columns other than the id and the
text are not read.
"""

from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T

from .pretokens import Block, expand, text_blocks

BLOCK_BYTES = 16_000_000
FLUSH_ROWS = 200_000
CODE_BITS, BLOCK_BITS = 24, 17


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ids of a rank file: a line per token, its bytes in base 64 and its id."""
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in file if line.strip())}


def encoder(ranks: dict[bytes, int], pattern: str):
    """Ids of a single word."""
    import tiktoken

    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


def _pack(*arrays: np.ndarray) -> bytes:
    """Arrays of unsigned 32-bit integers, byte planes apart, compressed."""
    flat = np.concatenate([np.asarray([len(a) for a in arrays]), *arrays]).astype("<u4")
    return zstandard.ZstdCompressor(level=3).compress(flat.view(np.uint8).reshape(-1, 4).T.tobytes())


def _unpack(data: bytes, n: int) -> list[np.ndarray]:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(4, -1)
    flat = np.ascontiguousarray(planes.T).view("<u4").ravel()
    return np.split(flat[n:], np.cumsum(flat[:n])[:-1].astype(np.int64))


def _task_blocks(batches: Iterable[pa.RecordBatch], with_words: bool) -> Iterator[tuple[int, pa.RecordBatch, Block]]:
    first = TaskContext.get().partitionId() << BLOCK_BITS
    n = 0
    for batch in batches:
        for part, texts in text_blocks(batch, BLOCK_BYTES):
            yield first + n, part, Block(texts, with_words)
            n += 1


def word_rows(docs: DataFrame) -> DataFrame:
    """(word, place) for each distinct word of each block; the place holds block and number."""
    def run(batches):
        for number, _, block in _task_blocks(batches, True):
            if len(block.words) >= 1 << CODE_BITS:
                raise ValueError("a block holds too many distinct words")
            places = (number << CODE_BITS) + np.arange(len(block.words), dtype=np.int64)
            for at in range(0, len(places), 50_000):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(block.words[at:at + 50_000], pa.string()), pa.array(places[at:at + 50_000])], ["word", "place"])
    return docs.select("text").mapInArrow(run, "word string, place long")


def position_rows(docs: DataFrame) -> DataFrame:
    """One row per block: the ids of its documents, and for each of them the places of its pre-tokens."""
    kind = docs.schema["doc_id"].dataType
    schema = T.StructType([T.StructField("block", T.LongType()), T.StructField("ids", T.ArrayType(kind)),
                           T.StructField("positions", T.BinaryType())])

    def run(batches):
        for number, rows, block in _task_blocks(batches, False):
            ids = rows.column("doc_id")
            ids = pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids)
            data = _pack(block.counts, block.codes)
            yield pa.RecordBatch.from_arrays([pa.array([number]), ids, pa.array([data])], ["block", "ids", "positions"])
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def encoded_words(words: DataFrame, ranks, pattern: str) -> DataFrame:
    """(block, words): the places of words of a block with their ids, several words to a row."""
    def flush(places, lengths, flat):
        places, lengths, flat = map(np.concatenate, (places, lengths, flat))
        ends = np.cumsum(lengths)
        order = np.argsort(places, kind="stable")
        number = places[order] >> CODE_BITS
        cuts = np.flatnonzero(np.diff(number)) + 1
        rows = []
        for part in np.split(order, cuts):
            ids = expand(part, lengths, ends - lengths, flat)
            rows.append((places[part[0]] >> CODE_BITS, _pack(places[part] & ((1 << CODE_BITS) - 1), lengths[part], ids)))
        return pa.RecordBatch.from_arrays([pa.array([b for b, _ in rows], pa.int64()), pa.array([d for _, d in rows], pa.binary())],
                                          ["block", "words"])

    def run(batches):
        encode = encoder(ranks.value, pattern)
        last, ids = None, []
        kept, rows = ([], [], []), 0
        for batch in batches:
            found = batch.column("word").dictionary_encode()  # the rows are sorted: equal words stand together
            each = []
            for word in found.dictionary.to_pylist():
                if word != last:
                    last, ids = word, np.array(encode(word), np.int64)
                each.append(ids)
            lengths = np.array([len(x) for x in each], np.int64)
            flat = np.concatenate(each) if each else np.zeros(0, np.int64)
            codes = found.indices.to_numpy()
            kept[0].append(batch.column("place").to_numpy())
            kept[1].append(lengths[codes])
            kept[2].append(expand(codes, lengths, np.cumsum(lengths) - lengths, flat))
            rows += len(codes)
            if rows >= FLUSH_ROWS:
                yield flush(*kept)
                kept, rows = ([], [], []), 0
        if rows:
            yield flush(*kept)

    by_word = words.repartition("word").sortWithinPartitions("word")
    return by_word.mapInArrow(run, "block long, words binary")


def _table(ranks: dict[bytes, int]) -> list[bytes]:
    table = [b""] * (max(ranks.values(), default=-1) + 1)
    for token, rank in ranks.items():
        table[rank] = token
    return table


def _decoded(ids: Iterable[bytes | None], table: list[bytes]) -> pa.Array:
    """The bytes of ids, looked up in the table of token bytes, which is as large as the vocabulary."""
    return pa.array([None if x is None else b"".join([table[i] for i in np.frombuffer(x, "<u4").tolist()]) for x in ids], pa.binary())


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str, with_decoded: bool = False) -> DataFrame:
    """``doc_id``, ``n_tokens`` and ``ids`` (little-endian unsigned 32-bit integers) of each row of ``docs``.

    ``with_decoded`` decodes the ids again in the same task, as ``decode`` does for stored ids.
    """
    shared = docs.sparkSession.sparkContext.broadcast(ranks)
    kind = docs.schema["doc_id"]
    schema = T.StructType([T.StructField("doc_id", kind.dataType), T.StructField("n_tokens", T.LongType()),
                           T.StructField("ids", T.BinaryType()), *[T.StructField("decoded", T.BinaryType())] * with_decoded])

    def rebuild(positions: pa.Table, words: pa.Table) -> pa.Table:
        if len(positions) != 1:
            raise RuntimeError("the documents were not the same each time they were read")
        counts, codes = _unpack(positions["positions"][0].as_py(), 2)
        parts = [_unpack(x.as_py(), 3) for x in words["words"]]
        n = int(codes.max()) + 1 if len(codes) else 0
        places, lengths, flat = (np.concatenate([p[k] for p in parts]) if parts else np.zeros(0, np.uint32) for k in range(3))
        if len(places) != n or len(np.unique(places)) != n:
            raise RuntimeError("the documents were not the same each time they were read")
        ends = np.cumsum(lengths, dtype=np.int64)
        length, offset = np.zeros(n, np.int64), np.zeros(n, np.int64)
        length[places], offset[places] = lengths, ends - lengths
        edges = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])
        ids, sizes = [], []
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            own = expand(codes[a:b], length, offset, flat)
            sizes.append(len(own))
            ids.append(own.astype("<u4").tobytes())
        columns = [positions["ids"].chunk(0).flatten(), pa.array(sizes, pa.int64()), pa.array(ids, pa.binary())]
        if with_decoded:
            columns.append(_decoded(ids, _table(shared.value)))
        return pa.Table.from_arrays(columns, schema.names)

    words = encoded_words(word_rows(docs), shared, pattern)
    return position_rows(docs).groupBy("block").cogroup(words.groupBy("block")).applyInArrow(rebuild, schema)


def decode(encoded: DataFrame, ranks: dict[bytes, int]) -> DataFrame:
    """Adds ``decoded``, the bytes of the column ``ids``, to stored ids."""
    shared = encoded.sparkSession.sparkContext.broadcast(_table(ranks))
    schema = T.StructType([*encoded.schema.fields, T.StructField("decoded", T.BinaryType())])

    def run(batches):
        for batch in batches:
            for at in range(0, len(batch), 500):
                part = batch.slice(at, 500)
                out = _decoded((x.as_py() for x in part.column("ids")), shared.value)
                yield pa.RecordBatch.from_arrays([*part.columns, out], schema.names)
    return encoded.mapInArrow(run, schema)


def query(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    ranks = read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    done = encode(docs, ranks, public_tokenizers.PATTERN, with_decoded=True)
    return done.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
