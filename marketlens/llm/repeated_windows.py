"""Removal of repeated byte strings: a depth-limited radix sort of text windows, most significant digit first.

A string of ``width`` bytes (``WIDTH`` unless another is asked for) that starts at two places is found by ordering
suffixes no deeper than ``width`` bytes.  The digits of a window are read from its anchor outwards, the anchor being the place of the least hash
of 17 bytes among those inside the window: equal windows have equal anchors, so it can serve as the first
digit, and neighbouring windows with one anchor share their first digits and need one row between them.

    pass 1   209 bytes that all windows of a block have in common (up to 192 windows with one anchor)
    pass 2   385 bytes that 16 of these windows have in common
    pass 3   415 bytes, all that the 16 windows cover: if repeated, so is each of the windows
    pass 4   the 400 bytes of each window that is left

(for a width of 400).  The digits of later passes are hashes of longer pieces around the same anchor, not of the bytes
that follow; what they group is the same.

Each pass distributes rows by the hash of their digits and sorts; a digit that is found at one place only ends
there, and passes 3 and 4 decide by 128 bits.  A group of equal digits never has to meet in one task: a task
knows of the equal digits in its own batch and sends one row for all of them, the others go anywhere.

Equal texts are one node (by 128-bit digest); a text that several rows hold is a repetition as a whole.  Null
texts count as empty, texts shorter than ``WIDTH`` bytes lose nothing.  Rows are independent of order, repeated
rows and columns other than the text.  Long texts are read in overlapping parts of half a megabyte.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from marketlens.session import materialize

WIDTH = 400
GRAM = 17
PART = 16
WIDTHS = range(64, 512)
CHUNK = 1 << 19
U = np.uint64
BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def reach_of(width: int) -> int:
    """How many places in a window an anchor can be at."""
    return width - GRAM + 1


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


class Rolling:
    """Hashes of any substrings of some bytes."""

    def __init__(self, data: np.ndarray, base: int) -> None:
        if base not in _POWERS or len(_POWERS[base][0]) < len(data):
            both = []
            for b in (base, pow(base, -1, 1 << 64)):
                up = np.full(max(len(data), CHUNK + CHUNK // 4), b, U)
                up[0] = 1
                both.append(np.multiply.accumulate(up))
            _POWERS[base] = tuple(both)
        up, self.down = (p[:len(data)] for p in _POWERS[base])
        self.total = np.zeros(len(data) + 1, U)
        np.cumsum((data.astype(U) + U(1)) * up, out=self.total[1:])

    def __call__(self, begin: np.ndarray, length: int) -> np.ndarray:
        return mix((self.total[begin + length] - self.total[begin]) * self.down[begin])

    def all(self, length: int) -> np.ndarray:
        return (self.total[length:] - self.total[:-length]) * self.down[:len(self.total) - length]


def _least_places(roll: Rolling, reach: int) -> np.ndarray:
    """For each window that fits, the place of the least gram hash in it, the first of equal ones."""
    grams = mix(roll.all(GRAM))
    value = (grams & ~U((1 << 20) - 1)) | np.arange(len(grams), dtype=U)
    n = len(value) - reach + 1
    padded = np.full(-(-len(value) // reach) * reach, U(0xFFFFFFFFFFFFFFFF))
    padded[:len(value)] = value
    rows = padded.reshape(-1, reach)
    before = np.minimum.accumulate(rows, axis=1).ravel()
    after = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return (np.minimum(after[:n], before[reach - 1:reach - 1 + n]) & U((1 << 20) - 1)).astype(np.int64)


def _chunks(texts: list[bytes], width: int):
    """Lists of (text number, place in it, bytes): parts of about ``CHUNK`` bytes that hold every window once."""
    group, size = [], 0
    for i, t in enumerate(texts):
        for at in range(0, max(len(t) - width + 1, 0), CHUNK):
            part = t[at:at + CHUNK + width - 1]
            if group and size + len(part) > CHUNK:
                yield group
                group, size = [], 0
            group.append((i, at, part))
            size += len(part)
    if group:
        yield group


def blocks_of(texts: list[bytes], width: int = WIDTH):
    """(text number, key, first window of the block, first own window and how many, as one number) per block of windows."""
    block = reach_of(width) // 2
    for group in _chunks(texts, width):
        data = np.frombuffer(b"".join(p for _, _, p in group), np.uint8)
        roll = Rolling(data, BASES[0])
        anchor = _least_places(roll, reach_of(width))
        sizes = np.array([len(p) for _, _, p in group])
        ends = np.cumsum(sizes)
        begins = ends - sizes
        valid = np.zeros(len(anchor) + 1, bool)
        step = np.zeros(len(anchor) + 1, np.int64)
        np.add.at(step, begins, 1)
        np.add.at(step, np.minimum(ends - width + 1, len(anchor)), -1)
        valid = np.cumsum(step)[:-1] > 0
        p = np.flatnonzero(valid)
        side = (anchor[p] - p) // block
        new = np.ones(len(p), bool)
        new[1:] = (anchor[p][1:] != anchor[p][:-1]) | (side[1:] != side[:-1]) | (p[1:] != p[:-1] + 1)
        new[np.searchsorted(p, begins)] = True
        first = np.flatnonzero(new)
        n = np.diff(np.append(first, len(p)))
        core = anchor[p[first]] - block * side[first]
        key = mix(roll(core, width - block + 1) + side[first].astype(U))
        lead = core - block + 1
        which = np.searchsorted(ends, p[first], "right")
        shift = np.array([at for _, at, _ in group])[which] - begins[which]
        number = np.array([i for i, _, _ in group])[which]
        yield number, key, lead + shift, (p[first] - lead) << 8 | (n - 1)


def _merged(number, key, pos, own):
    """One row for a block that a cut between two parts of a text divides: the windows of both, which follow one another."""
    order = np.lexsort((own, pos, key, number))
    number, key, pos, own = number[order], key[order], pos[order], own[order]
    new = np.ones(len(key), bool)
    new[1:] = (number[1:] != number[:-1]) | (key[1:] != key[:-1]) | (pos[1:] != pos[:-1])
    first = np.flatnonzero(new)
    last = np.maximum.reduceat((own >> 8) + (own & 255), first)
    begin = own[first] >> 8
    return number[first], key[first], pos[first], begin << 8 | (last - begin)


ROW = "route long, key long, check long, node binary, pos int, own int, more long, known boolean"


def _rows(node, number, key, check, pos, own, more) -> pa.RecordBatch:
    """Rows of one batch; those whose digits the batch holds elsewhere are known to be repeated, and but one of them go anywhere.

    No two rows with equal digits may have the same number (or node) and place.
    """
    both = key if check is None else key ^ mix(check)
    twin = pd.Series(both)
    known = twin.duplicated(keep=False).to_numpy()
    free = twin.duplicated().to_numpy()
    route = np.where(free, mix(both + mix(number.astype(U) << U(32)) + pos.astype(U)), both)
    zero = np.zeros(len(key), np.int64)
    columns = [route.astype(np.int64), key.astype(np.int64), zero if check is None else check.astype(np.int64)]
    return pa.RecordBatch.from_arrays(
        [*map(pa.array, columns), node.take(pa.array(number)), pa.array(pos.astype(np.int32)), pa.array(own.astype(np.int32)),
         pa.array(zero if more is None else more.astype(np.int64)), pa.array(known)],
        ["route", "key", "check", "node", "pos", "own", "more", "known"])


def sorted_pass(rows: DataFrame, every: bool = False, then=None) -> DataFrame:
    """``node, pos, own, more, key`` of the rows whose digits are found at two places.

    With ``every``, all rows, whether theirs are (``again``), and one row of each digit that is (``head``).
    ``then`` turns the batches found into rows of the next pass, in the same task.
    """
    names = ["node", "pos", "own", "more", "key"]

    def run(batches):
        for batch in _grouped(batches):
            key, check = batch.column("key").to_numpy(), batch.column("check").to_numpy()
            known = batch.column("known").to_numpy(zero_copy_only=False)
            new = np.ones(len(key), bool)
            new[1:] = (key[1:] != key[:-1]) | (check[1:] != check[:-1])
            group = np.cumsum(new) - 1
            node = batch.column("node").dictionary_encode().indices.to_numpy().astype(np.int64)
            place = (node << 32) + batch.column("pos").to_numpy().astype(np.int64)  # pos is below 0 where a block begins before its text
            first = np.flatnonzero(new)
            lo, hi = np.minimum.reduceat(place, first), np.maximum.reduceat(place, first)
            again = ((lo != hi) | np.logical_or.reduceat(known, first))[group]
            out = [batch.column(c) for c in names]
            if every:
                both = (key.view(U) ^ mix(check.view(U))).view(np.int64)
                here = np.flatnonzero(batch.column("route").to_numpy() == both)  # not one of those that went anywhere
                head = np.zeros(len(key), bool)
                head[here[np.unique(group[here], return_index=True)[1]]] = True
                yield pa.RecordBatch.from_arrays([*out, pa.array(again), pa.array(head & again)], [*names, "again", "head"])
            else:
                keep = pa.array(again)
                yield pa.RecordBatch.from_arrays([c.filter(keep) for c in out], names)

    sorted_rows = rows.repartition("route").sortWithinPartitions("key", "check")
    if then:
        return sorted_rows.mapInArrow(lambda batches: then(run(batches)), ROW)
    return sorted_rows.mapInArrow(run, "node binary, pos int, own int, more long, key long" + ", again boolean, head boolean" * every)


def _grouped(batches):
    """Batches cut where a new key begins; a group has at most a row per batch of the pass before, and those that went anywhere."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not len(batch):
            continue
        key, check = batch.column("key").to_numpy(), batch.column("check").to_numpy()
        differ = np.flatnonzero((key != key[-1]) | (check != check[-1]))
        cut = int(differ[-1]) + 1 if len(differ) else 0
        if held:
            last = held[-1]
            same = last.column("key")[-1].as_py() == key[0] and last.column("check")[-1].as_py() == check[0]
            if not same:
                yield _joined(held)
                held = []
        if cut:
            yield _joined([*held, batch.slice(0, cut)])
            held = []
        held.append(batch.slice(cut))
    if held:
        yield _joined(held)


def _joined(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    return parts[0] if len(parts) == 1 else pa.Table.from_batches(parts).combine_chunks().to_batches()[0]


def _first_pass(docs: DataFrame, width: int) -> DataFrame:
    def run(batches):
        seen_all: set[bytes] = set()
        for batch in _small(batches, 6_000_000):
            nodes = batch.column("node").to_pylist()
            new = [i for i, x in enumerate(nodes) if not (x in seen_all or seen_all.add(x))]
            seen_all = set(nodes)  # a copy further off sends equal rows once more
            texts = [batch.column("text")[i].as_py().encode() for i in new]
            node = batch.column("node").take(pa.array(new, pa.int64()))
            found = list(blocks_of(texts, width))
            if found:
                number, key, pos, own = _merged(*(np.concatenate(c) for c in zip(*found, strict=True)))
                yield _rows(node, number, key, None, pos, own, None)
    return docs.mapInArrow(run, ROW)


def _encoded(batch: pa.RecordBatch):
    """The texts of a batch with places, one after another, and the places of all of them counted through."""
    texts = [t.encode() for t in batch.column("text").to_pylist()]
    size = np.array([len(t) for t in texts], np.int64)
    at = batch.column("places")
    n = np.diff(at.offsets.to_numpy())
    owner = np.repeat(np.arange(len(texts)), n)
    flat = at.flatten()
    return np.frombuffer(b"".join(texts), np.uint8), size, np.cumsum(size) - size, owner, flat


def _small(batches, most: int = 400_000):
    """Slices of batches whose texts are not long together, or one row."""
    for batch in batches:
        size = np.array([len(t) for t in batch.column("text").to_pylist()])
        begin = 0
        for i in range(len(size)):
            if i > begin and size[begin:i + 1].sum() > most:
                yield batch.slice(begin, i - begin)
                begin = i
        if begin < len(size):
            yield batch.slice(begin)


def _second_pass(texts: DataFrame, width: int) -> DataFrame:
    """Rows of 16 windows each, by what they have in common; ``more`` hashes all they cover, 0 if that leaves the text."""
    def run(batches):
        for batch in _small(batches):
            data, size, base, owner, flat = _encoded(batch)
            pos, own = (flat.field(k).to_numpy().astype(np.int64) for k in range(2))
            roll, other = Rolling(data, BASES[0]), Rolling(data, BASES[1])
            first, n = own >> 8, (own & 255) + 1
            low, high = first // PART, (first + n - 1) // PART
            k = high - low + 1
            row = np.repeat(np.arange(len(pos)), k)
            part = low[row] + np.arange(len(row)) - np.repeat(np.cumsum(k) - k, k)
            q = pos[row] + PART * part
            owner, q = np.unique(np.stack([owner[row], q]), axis=1)  # blocks that meet within a part both have it
            key = roll(base[owner] + q + PART - 1, width - PART + 1)
            whole = (q >= 0) & (q + width + PART - 1 <= size[owner])
            cover = np.zeros(len(q), U)
            cover[whole] = other(base[owner[whole]] + q[whole], width + PART - 1) | U(1)
            if len(q):
                yield _rows(batch.column("node"), owner, key, None, q, np.zeros(len(q), np.int64), cover)
    return texts.mapInArrow(run, ROW)


def _third_pass(batches):
    """Rows of pass 3 from those that pass 2 left: by all they cover, and by the digit of pass 2."""
    for batch in batches:
        cover = batch.column("more").to_numpy().astype(U)
        pos = batch.column("pos").to_numpy().astype(np.int64)
        node = batch.column("node")
        alone = np.array([hash_node(x) for x in node.to_pylist()], U) + mix(pos.astype(U) + U(7))
        core = batch.column("key").to_numpy()
        yield _rows(node, np.arange(len(pos)), np.where(cover == 0, alone, cover), core.view(U), pos, np.zeros(len(pos), np.int64), core)


def hash_node(node: bytes) -> int:
    return int.from_bytes(node[:8], "little")


def _fourth_pass(texts: DataFrame, width: int) -> DataFrame:
    """A row per window of the parts that pass 3 left."""
    def run(batches):
        for batch in _small(batches):
            data, size, base, owner, flat = _encoded(batch)
            q = flat.to_numpy().astype(np.int64)
            w = (q[:, None] + np.arange(PART)).ravel()
            owner = np.repeat(owner, PART)
            ok = (w >= 0) & (w + width <= size[owner])
            w, owner = w[ok], owner[ok]
            if len(w):
                w, owner = np.unique(np.stack([owner, w]), axis=1)[::-1]
                key, check = (Rolling(data, b)(base[owner] + w, width) for b in BASES)
                yield _rows(batch.column("node"), owner, key, check, w, np.zeros(len(w), np.int64), None)
    return texts.mapInArrow(run, ROW)


def with_nodes(docs: DataFrame) -> DataFrame:
    return docs.withColumn("node", F.unhex(F.md5("text")))


def repeated_starts(docs: DataFrame, width: int = WIDTH) -> tuple[DataFrame, DataFrame]:
    """Texts that share windows (``node, text``), and ``node, pos, n``: n windows from pos on are found elsewhere too."""
    if width not in WIDTHS:
        raise ValueError(f"width {width} is not in {WIDTHS}")
    long = docs.filter(F.octet_length("text") >= width).select("node", "text")
    first = sorted_pass(_first_pass(long, width)).groupBy("node").agg(F.collect_set(F.struct("pos", "own")).alias("places"))
    one_each = long.groupBy("node").agg(F.first("text").alias("text"))
    texts = materialize(one_each.join(first, "node"), "shared-texts")
    left = sorted_pass(sorted_pass(_second_pass(texts, width), then=_third_pass), every=True)
    left = materialize(left.select("node", "pos", "again", "head", F.col("more").alias("core")), "window-parts")
    unsure = left.filter(~F.col("again"))
    twins = left.filter("head").join(unsure.select("core").distinct(), "core", "left_semi")  # where theirs may be found again
    open_parts = unsure.unionByName(twins.select(*unsure.columns)).groupBy("node").agg(F.collect_set("pos").alias("places"))
    single = sorted_pass(_fourth_pass(texts.select("node", "text").join(open_parts, "node").select("node", "text", "places"), width))
    found = left.filter("again").select("node", "pos", F.lit(PART).alias("n")).unionByName(
        single.select("node", "pos", F.lit(1).alias("n")))
    return texts.select("node", "text"), found


def spans(texts: DataFrame, starts: DataFrame, width: int = WIDTH) -> DataFrame:
    """``node, n_removed, n_spans, kept``: what is left of each text that loses bytes."""
    grouped = starts.groupBy("node").agg(F.collect_set(F.struct("pos", "n")).alias("places"))

    def run(batches):
        for batch in _small(batches):
            rows = []
            for text, places in zip(batch.column("text").to_pylist(), batch.column("places"), strict=True):
                data = np.frombuffer(text.encode(), np.uint8)
                pos, n = (places.values.field(k).to_numpy().astype(np.int64) for k in range(2))
                step = np.zeros(len(data) + 1, np.int64)
                np.add.at(step, pos, 1)
                np.add.at(step, pos + n - 1 + width, -1)
                gone = np.cumsum(step)[:-1] > 0
                count = int(gone[0]) + int(np.count_nonzero(gone[1:] & ~gone[:-1]))
                rows.append((int(gone.sum()), count, data[~gone].tobytes()))
            removed, count, kept = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), pa.array(removed, pa.int64()), pa.array(count, pa.int64()), pa.array(kept, pa.binary())],
                ["node", "n_removed", "n_spans", "kept"])
    return texts.join(grouped, "node").mapInArrow(run, "node binary, n_removed long, n_spans long, kept binary")


def removals(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """``node, n_removed, n_spans, kept`` for each text of ``docs`` (``node``, ``text``) that loses bytes.

    ``kept`` is null where nothing is kept because several rows hold the whole text.
    """
    texts, starts = repeated_starts(docs, width)
    part = spans(texts, starts, width)
    copies = docs.groupBy("node", F.octet_length("text").alias("n")).count().filter((F.col("count") > 1) & (F.col("n") >= width))
    whole = copies.select("node", F.col("n").cast("long").alias("n_removed"), F.lit(1).cast("long").alias("n_spans"),
                          F.lit(None).cast("binary").alias("kept"))
    return part.join(whole, "node", "left_anti").unionByName(whole)


def remove_repeats(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """``docs`` with repeated strings cut out of its texts; bytes of characters that were cut apart go too."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    base = with_nodes(docs.select(row, F.coalesce("text", F.lit("")).alias("text")))
    found = removals(base.select("node", "text"), width)

    @F.pandas_udf("string")
    def readable(kept: pd.Series) -> pd.Series:
        return kept.map(lambda b: b.decode(errors="ignore"))

    lost = found.select("node", F.col("n_removed"), readable(F.coalesce("kept", F.lit(b""))).alias("rest"))
    text = F.when(F.col("n_removed").isNull(), F.col("row.text")).otherwise(F.col("rest"))
    return base.join(lost, "node", "left").select(*[text.alias(c) if c == "text" else F.col(f"row.`{c}`") for c in docs.columns])


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    docs = with_nodes(docs)
    found = removals(docs.select("node", "text")).select(
        "node", "n_removed", "n_spans", F.sha2(F.coalesce("kept", F.lit(b"")), 256).alias("sha"))
    sized = docs.select("doc_id", "node", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("whole"))
    zero = F.lit(0).cast("long")
    return sized.join(found, "node", "left").select(
        "doc_id", "n_bytes", F.coalesce("n_removed", zero).alias("n_removed"), F.coalesce("n_spans", zero).alias("n_spans"),
        F.coalesce("sha", "whole").alias("kept_sha256"))
