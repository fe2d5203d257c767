"""Splits texts into pre-tokens with array operations, and numbers the distinct ones of a block of documents.

The split is that of the pattern

    's|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+

Each code point has one of four classes (letter, number, white space, other).  A pre-token is a run of one
class; a run that is no white space takes one plain space before it, a contraction cuts its letters off.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import regex

OTHER, LETTER, NUMBER, SPACE, BREAK = range(5)
QUOTE, BLANK = ord("'"), ord(" ")
BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
CHUNK = 1 << 17
WORD = np.uint64


@functools.cache
def classes() -> np.ndarray:
    """The class of every code point; one place past the last stands for the gap between two documents."""
    table = np.zeros(0x110001, np.uint8)
    points = "".join(map(chr, range(0x110000)))
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\p{White_Space}+")):
        for found in regex.finditer(pattern, points):
            table[found.start():found.end()] = kind
    table[0x110000] = BREAK
    return table


@functools.cache
def powers(base: int) -> tuple[np.ndarray, np.ndarray]:
    """base ** i and base ** -i modulo 2 ** 64 for the places of a chunk."""
    def up(x: int) -> np.ndarray:
        out = np.full(CHUNK + 1, x, WORD)
        out[0] = 1
        return np.multiply.accumulate(out)
    return up(base), up(pow(base, -1, 1 << 64))


def token_starts(points: np.ndarray, kind: np.ndarray) -> np.ndarray:
    """True where a pre-token begins; every gap between documents is one of its own."""
    start = np.ones(len(points), bool)
    np.not_equal(kind[1:], kind[:-1], out=start[1:])
    start[kind == BREAK] = True
    after = np.flatnonzero(start[1:] & (kind[:-1] == SPACE) & (kind[1:] <= NUMBER)) + 1
    start[after - 1] = True
    start[after[points[after - 1] == BLANK]] = False
    quotes = np.flatnonzero(points[:-2] == QUOTE)
    quotes = quotes[start[quotes] & (kind[quotes + 1] == LETTER)]
    first, second = points[quotes + 1], points[quotes + 2]
    one = np.isin(first, [ord(c) for c in "stmd"])
    two = np.zeros(len(quotes), bool)
    for a, b in ("re", "ve", "ll"):
        two |= (first == ord(a)) & (second == ord(b))
    start[quotes[one | two] + 1] = False
    rest = np.concatenate([quotes[one] + 2, quotes[two] + 3])
    start[rest[kind[rest] == LETTER]] = True
    return start


def _pieces(text: str) -> Iterator[str]:
    """Parts of a long text, cut where a pre-token surely begins: before a blank between two letters."""
    at = 0
    while len(text) - at > CHUNK // 2:
        cut = regex.compile(r"(?<=\p{L})(?= \p{L})").search(text, at + CHUNK // 4, at + CHUNK // 2)
        if not cut:  # no such place in a quarter of a million characters: cut at any pre-token that ends there
            cut = _last_start(text, at)
            if cut is None:
                break
            yield text[at:cut]
            at = cut
            continue
        yield text[at:cut.start()]
        at = cut.start()
    yield text[at:]


def _last_start(text: str, at: int) -> int | None:
    """The last place in the next half chunk at which a run that is neither white space nor after it begins."""
    points = np.frombuffer(text[at:at + CHUNK // 2].encode("utf-32-le", "surrogatepass"), np.uint32)
    kind = classes()[points]
    ok = np.flatnonzero((kind[1:] != kind[:-1]) & (kind[1:] != SPACE) & (kind[:-1] != SPACE) & (points[:-1] != QUOTE)) + 1
    return at + int(ok[-1]) if len(ok) and ok[-1] > 2 else None


class Block:
    """Pre-tokens of some texts: ``words``, the distinct ones; ``codes``, each pre-token's place in them; ``counts`` per text."""

    def __init__(self, texts: list[str], with_words: bool = True) -> None:
        self.counts = np.zeros(len(texts), np.int64)
        scans, group, owner, size = [], [], [], 0
        parts = ((i, p) for i, t in enumerate(texts) for p in (_pieces(t) if len(t) > CHUNK // 2 else (t,)))
        for i, part in parts:
            if group and size + len(part) + 1 > CHUNK:
                scans.append(self._scan(group, owner, with_words))
                group, owner, size = [], [], 0
            group.append(part)
            owner.append(i)
            size += len(part) + 1
        if group:
            scans.append(self._scan(group, owner, with_words))
        edges = np.cumsum([0, *[len(s[1]) for s in scans]])
        codes, first = _numbered(*(np.concatenate([s[k] for s in scans]) if scans else np.zeros(0, WORD) for k in (1, 2)))
        codes = codes.astype(np.int32)
        pieces = [codes[edges[k]:edges[k + 1]][s[0]] for k, s in enumerate(scans)]
        raw = np.concatenate(pieces) if pieces else np.zeros(0, np.int32)
        del pieces
        rank = np.argsort(-np.bincount(raw, minlength=len(first)), kind="stable")  # frequent words get small codes
        place = np.empty(len(rank), np.int32)
        place[rank] = np.arange(len(rank), dtype=np.int32)
        self.codes = place[raw]
        self.n_words = len(first)
        self.words: list[str] = [None] * len(first) if with_words else []
        if with_words:
            first = first[rank]
            which = np.searchsorted(edges, first, "right") - 1
            for k, (_, _, _, begin, end, text) in enumerate(scans):
                mine = np.flatnonzero(which == k)
                at = first[mine] - edges[k]
                for w, s, e in zip(mine.tolist(), begin[at].tolist(), end[at].tolist(), strict=True):
                    self.words[w] = text[s:e]

    def _scan(self, group, owner, keep: bool) -> tuple:
        """Of some texts: a number per pre-token; two hashes, begin and end of each distinct one; the texts joined."""
        text = "\n".join([*group, ""]) + "\n\n"
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        kind = classes()[points]
        ends = np.cumsum([len(t) + 1 for t in group]) - 1
        kind[ends] = BREAK
        kind[-2:] = BREAK
        begin = np.flatnonzero(token_starts(points, kind))
        end = np.append(begin[1:], len(points))
        real = kind[begin] != BREAK
        np.add.at(self.counts, owner, np.diff(np.searchsorted(begin[real], ends), prepend=0))
        begin, end = begin[real], end[real]
        both = []
        values = (points.astype(WORD) + WORD(1)) * WORD(0xBF58476D1CE4E5B9)
        for base in BASES:
            if len(points) <= CHUNK:
                up, down = powers(base)
                total = np.zeros(len(points) + 1, WORD)
                np.cumsum(values * up[:len(points)], out=total[1:])
                both.append((total[end] - total[begin]) * down[begin])
            else:  # one pre-token longer than a chunk: few of them, hashed one by one
                both.append(np.array([hash_one(points[s:e], base) for s, e in zip(begin, end, strict=True)], WORD))
        codes, first = _numbered(*both)
        return codes.astype(np.int32), both[0][first], both[1][first], begin[first].astype(np.int32), end[first].astype(np.int32), text if keep else ""


def _numbered(h: np.ndarray, g: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A number for each pair of hashes, and where each number first occurs."""
    codes, found = pd.factorize(h)
    for _ in range(2):
        first = np.zeros(len(found), np.int64)
        first[codes[::-1]] = np.arange(len(codes) - 1, -1, -1)
        if np.array_equal(g, g[first][codes]):
            break
        codes, found = pd.factorize(pd.MultiIndex.from_arrays([h, g]))  # two words with one hash: tell them apart by both
    return codes, first


def hash_one(points: np.ndarray, base: int) -> int:
    up = np.full(len(points), base, WORD)
    up[0] = 1
    values = (points.astype(WORD) + WORD(1)) * WORD(0xBF58476D1CE4E5B9)
    return int((values * np.multiply.accumulate(up)).sum(dtype=WORD))


def blocks(sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Ranges of texts of at most ``most`` bytes together, or one longer text alone."""
    begin, size = 0, 0
    for i, n in enumerate(sizes):
        if i > begin and size + n > most:
            yield begin, i
            begin, size = i, 0
        size += n
    if begin < len(sizes):
        yield begin, len(sizes)


def text_blocks(batch: pa.RecordBatch, most: int) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Parts of a batch with their texts; only one part's texts are Python objects at a time."""
    for begin, end in blocks([n or 0 for n in pc.binary_length(batch.column("text")).to_pylist()], most):
        part = batch.slice(begin, end - begin)
        yield part, [t or "" for t in part.column("text").to_pylist()]


def expand(codes: np.ndarray, lengths: np.ndarray, offsets: np.ndarray, flat: np.ndarray) -> np.ndarray:
    """The values of every code one after another: code c holds ``flat[offsets[c]:offsets[c] + lengths[c]]``."""
    n = lengths[codes]
    ends = np.cumsum(n)
    if not len(ends):
        return flat[:0]
    return flat[np.repeat(offsets[codes] - (ends - n), n) + np.arange(ends[-1])]
