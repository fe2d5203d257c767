from __future__ import annotations

import hashlib
import math
import random
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from marketlens.llm import bpe, components, language_id, order_minhash, packing, quality_rules, repeated_windows

from . import cases

BLANKS = " \t\n\x0b\x0c\r"


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    return cases.stored(spark, tmp_path_factory.mktemp("docs"), cases.docs(spark)).cache()


@pytest.fixture(scope="module")
def rows(docs):
    return [tuple(r) for r in docs.select("doc_id", "text").collect()]


def counted(pairs):
    return Counter(map(str, pairs))


# --- quality rules -----------------------------------------------------------


def plain_signals(text):
    text = text or ""
    words = [w for w in "".join(" " if c in BLANKS else c for c in text).split(" ") if w]
    lines = [x for x in text.split("\n") if x.strip(BLANKS)]
    windows = Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    covered = {j for i in range(len(words) - 7) if windows[tuple(words[i:i + 8])] > 1 for j in range(i, i + 8)}
    return (len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered))


def test_quality_signals_equal_a_plain_count(spark, docs, rows):
    extra = [(1000, "a b c d e f g h " * 3 + "x"), (1001, "l1\nl1\n \nl2"), (1002, "% # a|b <c>"), (1003, "x " * 7), (1004, "x " * 9)]
    frame = docs.select("doc_id", "text").union(spark.createDataFrame(extra, "doc_id long, text string"))
    got = quality_rules.judge(frame).select("row.doc_id", "row.text", *quality_rules.SIGNALS[:5]).collect()
    assert len(got) == len(rows) + len(extra)
    assert all(tuple(r)[2:] == plain_signals(r.text) for r in got)


def test_quality_keeps_columns_and_drops_short(spark, docs):
    kept = quality_rules.keep_good(docs)
    assert kept.columns == docs.columns
    assert all(len(r.text.split()) >= 20 for r in kept.collect()) and kept.count() > 50
    assert quality_rules.keep_good(cases.empty(spark)).count() == 0


def test_quality_runs_without_python(docs):
    plan = quality_rules.keep_good(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


# --- byte-level BPE ----------------------------------------------------------


def test_bpe_equals_the_library_and_decodes(spark, docs, rows, monkeypatch):
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    plain = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    expected = [(i, plain.encode_ordinary(t or ""), (t or "").encode()) for i, t in rows]
    encoded = bpe.encode(docs, ranks, public_tokenizers.PATTERN)
    found = [(r.doc_id, list(struct.unpack(f"<{r.n_tokens}I", r.ids)), bytes(r.decoded)) for r in bpe.decode(encoded, ranks).collect()]
    assert counted(found) == counted(expected)
    assert bpe.encode(cases.empty(spark), ranks, public_tokenizers.PATTERN).count() == 0


# --- packing -----------------------------------------------------------------


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 40), max_size=40))
def test_plan_places_every_piece_once(counts):
    ranges = sorted(packing.plan(counts, 64))
    filled = defaultdict(list)
    for n, c in counts.items():
        for r in range(c):
            _, first, s, per, offset = [x for x in ranges if x[0] == n and x[1] <= r][-1]
            filled[s + (r - first) // per].append((offset + (r - first) % per * n, n))
    for parts in filled.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= 64
    assert sum(map(len, filled.values())) == sum(counts.values())
    total = sum(n * c for n, c in counts.items())
    bins: list[int] = []  # first fit of the longest first
    for n in sorted((n for n, c in counts.items() for _ in range(c)), reverse=True):
        at = next((i for i, used in enumerate(bins) if used + n <= 64), len(bins))
        bins[at:at + 1] = [(bins[at] if at < len(bins) else 0) + n]
    assert math.ceil(total / 64) <= len(filled) <= 1.1 * len(bins) + 1


def test_packing_of_documents(spark, docs, rows):
    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = packing.pack_documents(docs).toPandas()
    expected = Counter()
    for i, t in rows:
        ids = np.array([*plain.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        cuts = [0, *range(len(ids) % 1024 or 1024, len(ids) + 1, 1024)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            expected[(i, k, a, b - a, zlib.crc32(ids[a:b].tobytes()))] += 1
    found = Counter((None if math.isnan(r[0]) else int(r[0]), *map(int, r[1:])) for r in
                    got[["doc_id", "piece", "start", "length", "ids_crc32"]].itertuples(index=False))
    assert found == expected
    got = got.sort_values(["sequence_id", "offset"])
    assert (got.offset == got.groupby("sequence_id").length.cumsum() - got.length).all()
    assert got.groupby("sequence_id").length.sum().max() <= 1024
    assert packing.pack_documents(cases.empty(spark)).count() == 0


def test_added_tokens_in_texts_have_their_ids(spark):
    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    end = "<|endoftext|>"
    texts = [f"a{end}b", end, end * 3, f"it {end} is{end}'s  \n{end}", f"<|{end}", "<|endoftext", f"a  {end}  b", "word " * 2000 + end + " x"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    expected = {}
    for i, t in enumerate(texts):
        ids = np.array([*plain.encode(t, add_special_tokens=False).ids, 2], "<u4")
        cuts = [0, *range(len(ids) % 1024 or 1024, len(ids) + 1, 1024)]
        expected |= {(i, k): (a, b - a, zlib.crc32(ids[a:b].tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))}
    assert plain.encode(texts[0], add_special_tokens=False).ids == [64, 50256, 65]
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in packing.pack_documents(frame).collect()} == expected


def test_sequences_hold_the_ids(spark, docs):
    vocabulary = packing.read_vocabulary(public_tokenizers.path("byte_bpe_50k.json"))
    placed = packing.pack(docs, vocabulary, public_tokenizers.PATTERN, with_ids=True)
    one = {r.sequence_id: (r.length, bytes(r.ids)) for r in packing.sequences(placed).collect()}
    assert all(len(ids) == 4 * n for n, ids in one.values())
    r = placed.filter("length < 500").first()
    assert one[r.sequence_id][1][4 * r.offset:4 * (r.offset + r.length)] == bytes(r.ids)


# --- language ----------------------------------------------------------------


def test_code_lengths_equal_a_plain_model(spark, docs):
    grams = language_id.gram_counts(language_id.sample(docs)).toPandas()
    model = language_id.compile_model(grams)
    seen = {lang: [defaultdict(Counter) for _ in range(4)] for lang in model.languages}
    known = [Counter() for _ in range(4)]
    for lang, gram, n in grams[["lang", "gram", "n"]].itertuples(index=False):
        b = int(gram).to_bytes(4, "big")
        for k in range(4):
            seen[lang][k][b[3 - k:3]][b[3]] += n
            known[k][b[3 - k:3]] += n

    def bits(text, lang):
        data, total = b"\n\n\n" + text.encode(), 0.0
        for i in range(3, len(data)):
            for k in (3, 2, 1, 0):
                context = data[i - k:i]
                after = seen[lang][k].get(context)
                if not after or (k and known[k][context] < language_id.LEAST_CONTEXT):
                    continue
                n, kinds = sum(after.values()), len(after)
                if data[i] in after:
                    total -= math.log2(after[data[i]] / (n + kinds))
                    break
                total -= math.log2(kinds / (n + kinds))
            else:
                total += 8
        return total

    texts = ["the water and stone", "das wasser und der stein", "é漢\x01 zq", "", "the " * 400]
    assert np.allclose(model.bits(texts), [[bits(t, lang) for lang in model.languages] for t in texts], rtol=1e-4, atol=1e-2)


def test_language_of_documents(spark, docs, monkeypatch):
    got = language_id.predict(docs, language_id.train(docs)).collect()
    assert len(got) == docs.count()
    for r in got:
        if not any(c.isalpha() for c in r.text or ""):
            assert (r.lang_pred, r.score) == ("und", 0.0)
        else:
            assert r.lang_pred in ("en", "de") and 0 <= r.score <= 1
    judged = [r for r in got if r.lang and r.text and len(r.text) > 50]
    assert sum(r.lang == r.lang_pred for r in judged) >= 0.97 * len(judged)
    nothing = language_id.predict(docs, language_id.train(cases.empty(spark)))
    assert {r.lang_pred for r in nothing.collect()} == {"und"}
    kept = language_id.keep_known(docs, language_id.train(docs))
    assert kept.columns == docs.columns and kept.filter("text is null or text = ''").count() == 0


def test_texts_of_no_learned_language_go(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rng = random.Random(9)
    letters = lambda alphabet: " ".join("".join(rng.choices(alphabet, k=rng.randrange(2, 9))) for _ in range(80))
    strange = [letters("abcdefghijklmnopqrstuvwxyz") for _ in range(50)] + [letters("абвгдежзийклмнопрстуфхц") for _ in range(50)]
    added = spark.createDataFrame([(10**9 + i, t, None, "s", len(t)) for i, t in enumerate(strange)], docs.schema)
    usual = docs.filter(F.size(F.split("text", r"\s+")) >= 25)
    kept = language_id.keep_known(usual.unionByName(added), language_id.train(usual))
    assert kept.filter("doc_id >= 1000000000").count() == 0
    assert kept.count() >= 0.97 * usual.count()


def test_usual_costs_come_from_all_documents_held_out(spark, monkeypatch):
    rng = random.Random(4)
    rows = [(i, cases.prose(rng, "en", rng.randrange(20, 60)), "en") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.train(docs)
    bits = sorted(r.bits_per_byte for r in language_id.predict(docs.filter(language_id.held_out()), model).collect())
    monkeypatch.setattr(language_id, "SAMPLE_DOCS", 5)
    most = language_id.TOLERANCE * bits[math.ceil(0.98 * len(bits)) - 1]
    assert language_id.usual_costs(docs, model) == {"en": pytest.approx(most, rel=1e-9)}


# --- near-duplicates ---------------------------------------------------------


def split_words(text):
    return [w for w in "".join(" " if c in BLANKS else c for c in text or "").split(" ") if w]


def plain_aligned(a, b):
    """Longest common subsequence by the table of all prefixes."""
    row = [0] * (len(b) + 1)
    for x in a:
        before = row
        row = [0]
        for j, y in enumerate(b):
            row.append(before[j] + 1 if x == y else max(before[j + 1], row[j]))
    return row[-1]


def plain_similarity(a, b):
    m = order_minhash.aligned(a, b, len(a) + len(b))
    return m / (len(a) + len(b) - m) if m else 0.0


def plain_classes(rows):
    texts = sorted({t for _, t in rows if t is not None})
    parent = {t: t for t in texts}

    def find(t):
        while parent[t] != t:
            t = parent[t]
        return t

    words = {t: split_words(t) for t in texts}
    runs = {t: {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set() for t, w in words.items()}
    for i, a in enumerate(texts):
        for b in texts[:i]:
            if runs[a] & runs[b] and plain_similarity(words[a], words[b]) >= 0.8:
                parent[find(a)] = find(b)
    members = defaultdict(list)
    for i, t in rows:
        if t is not None and i is not None:
            members[find(t)].append(i)
    return [(i, i if t is None else min(members[find(t)], default=None)) for i, t in rows]


def variants(seed, n):
    rng = random.Random(seed)
    base = [cases.prose(rng, "en", 150).split() for _ in range(3)]
    out = []
    for i in range(n):
        words = list(rng.choice(base))
        for _ in range(rng.randrange(0, 6)):
            words[rng.randrange(len(words))] = f"w{rng.randrange(1000)}"
        out.append((i, " ".join(words)))
    return out


def test_near_duplicates_of_all_cases(spark, docs, rows):
    got = [tuple(r) for r in order_minhash.near_duplicates(docs).collect()]
    assert counted(got) == counted(plain_classes(rows))
    assert order_minhash.near_duplicates(cases.empty(spark)).count() == 0


def test_families_of_variants_keep_their_links(spark):
    rows = variants(4, 90)
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = dict(tuple(r) for r in order_minhash.near_duplicates(frame).collect())
    assert got == dict(plain_classes(rows))


def test_large_families_are_never_joined_wrongly(spark):
    rows = variants(5, 300)
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got, expected = dict(tuple(r) for r in order_minhash.near_duplicates(frame).collect()), dict(plain_classes(rows))
    assert all(expected[i] == expected[c] for i, c in got.items())
    assert len(set(got.values())) <= 1.2 * len(set(expected.values())) + 10


@pytest.mark.parametrize(("ranks", "n"), [(1 << 16, 400), (8, 200)])
def test_large_families_equal_brute_force(spark, monkeypatch, ranks, n):
    monkeypatch.setattr(order_minhash, "RANKS", ranks)
    rows = variants(5, n)
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert dict(tuple(r) for r in order_minhash.near_duplicates(frame).collect()) == dict(plain_classes(rows))


def test_texts_of_one_class_do_not_meet_at_its_words(spark):
    """A class of any size and a few strangers that hold its rare words: rows that meet grow as the class, not as its square."""
    rng = random.Random(6)
    base = [f"b{i}" for i in range(40)]
    sizes = {}
    for n in (40, 80):
        rows = [(f"c{i:03}".encode(), b"class", " ".join(base[:-1] + [f"own{i}"])) for i in range(n)]
        rows += [(f"s{i}".encode(), f"s{i}".encode(), " ".join(rng.sample(base, 38))) for i in range(3)]
        texts = spark.createDataFrame(rows, "node binary, root binary, text string")
        found = order_minhash.prefixes(texts, np.zeros(order_minhash.RANKS, np.int64))
        met = order_minhash.meeting(found).select("token", "root", "light").collect()
        held, light = Counter(r.token for r in met), Counter(r.token for r in met if r.light)
        assert held and all(r.light == (r.root != b"class") for r in met)
        assert len(met) <= found.count()
        sizes[n] = sum(k * light[token] for token, k in held.items())
    assert 0 < sizes[80] <= 2.1 * sizes[40]


def test_no_similar_texts_of_different_classes_are_missed(spark):
    """Texts of different lengths, one class each or a few: all pairs of different classes with a similarity of 0.8."""
    rng = random.Random(8)
    base, texts = [rng.choice([f"w{i}" for i in range(50)]) for _ in range(60)], set()
    for _ in range(70):
        words = list(base)
        for _ in range(rng.randrange(0, 12)):
            at = rng.randrange(len(words))
            words[at:at + 1] = rng.choice([[], [], [words[at], f"w{rng.randrange(50)}"], [f"x{rng.randrange(9)}"]])
        texts.add(" ".join(words))
    rows = [(t.encode(), f"r{i % 9 if i % 2 else i}".encode(), t) for i, t in enumerate(sorted(texts))]
    frame = spark.createDataFrame(rows, "node binary, root binary, text string")
    pairs = order_minhash.rest_pairs(frame.select("node", "root"), frame.select("node", "text"))
    got = [(bytes(r.u), bytes(r.v)) for r in pairs.collect()]
    similar = {(a, b) for i, (b, r, s) in enumerate(rows) for a, q, t in rows[:i]
               if q != r and plain_similarity(split_words(s), split_words(t)) >= 0.8}
    classes = {node: root for node, root, _ in rows}
    assert len(set(got)) == len(got) and all(u < v and classes[u] != classes[v] for u, v in got)
    assert len(similar) > 100 and similar <= set(got)


def test_keep_one_of_each_class(docs, rows):
    kept = order_minhash.keep_one(docs)
    assert kept.columns == docs.columns
    expected = {i: c for i, c in plain_classes(rows)}
    got = [r.doc_id for r in kept.filter("text is not null").collect()]
    assert sorted(x for x in got if x is not None) == sorted({c for i, t in rows if t is not None and i is not None for c in [expected[i]]})
    assert kept.filter("text is null").count() == sum(t is None for _, t in rows)


def test_order_matters_to_the_alignment():
    rng = np.random.default_rng(1)
    a = rng.integers(1, 1 << 62, 400).astype(np.uint64)
    assert order_minhash.similarity(a, a) == 1.0
    assert order_minhash.similarity(a, np.concatenate([a[200:], a[:200]])) == 0.0
    b = np.delete(a, slice(100, 120))
    assert order_minhash.similarity(a, b) == pytest.approx(380 / 400)
    assert order_minhash.similarity(a, a[:300]) == 0.0


def test_alignment_equals_the_table(spark):
    rng = random.Random(7)
    for _ in range(60):
        a, b = (rng.choices("abcdefgh", k=rng.randrange(0, 40)) for _ in range(2))
        assert order_minhash.aligned(a, b, 80) == plain_aligned(a, b)
        assert order_minhash.aligned(a, b, 3) <= plain_aligned(a, b)
        c = [x for x in a if rng.random() < 0.9]
        assert order_minhash.aligned(a, c, len(a) - len(c)) == len(c)


@pytest.mark.parametrize("n", [1500])
def test_pairs_that_agree_in_nine_of_ten_words_share_a_class(spark, n):
    """All pairs of the first documents by length and common words, aligned in full."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").filter(F.col("text").isNotNull()).orderBy("doc_id").limit(n)
    got = {r.doc_id: r.class_id for r in order_minhash.near_duplicates(docs).collect()}
    texts = {r.doc_id: split_words(r.text) for r in docs.select("doc_id", "text").collect()}
    order = sorted((i for i in texts if len(texts[i]) >= 20), key=lambda i: len(texts[i]))
    bags, pairs = {i: Counter(texts[i]) for i in order}, []
    for at, i in enumerate(order):
        for k in order[at + 1:]:
            longest = len(texts[k])
            if 0.9 * longest > len(texts[i]):
                break
            rare = [w for w in bags[i] if len(w) > 6]
            if sum(w in bags[k] for w in rare) < 0.4 * len(rare) or sum((bags[i] & bags[k]).values()) < 0.9 * longest:
                continue
            if order_minhash.aligned(texts[i], texts[k], longest) >= 0.9 * longest:
                pairs.append((i, k))
    caught = sum(got[i] == got[k] for i, k in pairs)
    assert len(pairs) >= 20 and caught >= 0.9 * len(pairs), (caught, len(pairs))


def test_components(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(0, 30)] + [(100, x) for x in range(101, 140)] + [(rng.randrange(200, 230), rng.randrange(200, 230)) for _ in range(20)]
    frame = spark.createDataFrame(edges, "u long, v long")
    got = {r.node: r.root for r in components.components(frame).collect()}
    assert all(got[i] == 0 for i in range(1, 31)) and all(got[i] == 100 for i in range(101, 140))
    assert all(got.get(u, u) == got.get(v, v) for u, v in edges)
    assert components.components(frame.filter("u < 0")).count() == 0


# --- repeated strings --------------------------------------------------------


def plain_removal(texts, width=repeated_windows.WIDTH):
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[p:p + width] for d in data for p in range(len(d) - width + 1))
    out = []
    for d in data:
        gone = bytearray(len(d))
        for p in range(len(d) - width + 1):
            if seen[d[p:p + width]] > 1:
                gone[p:p + width] = b"\1" * width
        n_spans = sum(1 for i in range(len(d)) if gone[i] and (not i or not gone[i - 1]))
        out.append((len(d), sum(gone), n_spans, hashlib.sha256(bytes(x for x, g in zip(d, gone) if not g)).hexdigest()))
    return out


@pytest.mark.parametrize("width", [64, 200, 401])
def test_other_widths_equal_a_plain_search(spark, width):
    rng = random.Random(width)
    noise = lambda n: "".join(rng.choices("abcdefgh ", k=n))
    shared = [noise(k) for k in (width - 1, width, width + 1, 2 * width, 900)]
    texts = [noise(rng.randrange(0, 500)) + rng.choice(shared) + noise(rng.randrange(0, 300)) for _ in range(60)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.text for r in repeated_windows.remove_repeats(frame, width).collect()}
    expected = plain_removal(texts, width)
    assert [hashlib.sha256(got[i].encode()).hexdigest() for i in range(len(texts))] == [e[3] for e in expected]
    with pytest.raises(ValueError):
        repeated_windows.remove_repeats(frame, 1000)


def test_texts_of_different_tasks_that_begin_alike(spark):
    """Blocks that begin before their text have places below 0, which must not hide whose they are."""
    rng = random.Random(12)
    ends = [[f"{side}{rng.getrandbits(1600):0400x}" for _ in range(20)] for side in "xy"]
    starts = [f"{rng.getrandbits(1640):0410x}" for _ in range(20)]
    frames = [spark.createDataFrame([(100 * k + i, starts[i] + end) for i, end in enumerate(side)], "doc_id long, text string")
              for k, side in enumerate(ends)]
    got = {r.doc_id: r.text for r in repeated_windows.remove_repeats(frames[0].unionByName(frames[1])).collect()}
    assert got == {100 * k + i: end for k, side in enumerate(ends) for i, end in enumerate(side)}


def test_repeated_strings_equal_a_plain_search(spark, tmp_path):
    rng = random.Random(3)
    noise = lambda n: "".join(rng.choices("abcdefgh é\n", k=n))
    shared = [noise(k) for k in (380, 400, 401, 450, 700, 1500, 3000)]
    texts = [None, "", noise(399), noise(400), "a" * 900, "ab" * 700]
    for _ in range(50):
        text = noise(rng.randrange(0, 900))
        for _ in range(rng.randrange(0, 3)):
            text += rng.choice(shared) + noise(rng.randrange(0, 500))
        texts.append(text)
    texts += [texts[10], texts[10], shared[3], shared[6][:1000], shared[6][100:900]]
    stored = cases.stored(spark, tmp_path, spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    got = {r.doc_id: tuple(r)[1:] for r in repeated_windows.query(spark, str(tmp_path)).collect()}
    assert [got[i] for i in range(len(texts))] == plain_removal(texts)
    cut = {r.doc_id: r.text for r in repeated_windows.remove_repeats(stored).collect()}
    assert all(len((cut[i] or "").encode()) <= got[i][0] - got[i][1] for i in got) and cut[0] is None


def test_windows_of_a_text_in_parts(monkeypatch):
    rng = random.Random(4)
    text = "".join(rng.choices("abc ", k=5000)).encode()
    whole = {(k, p, o) for _, key, pos, own in repeated_windows.blocks_of([text]) for k, p, o in zip(key, pos, own)}
    starts = {p + (o >> 8) + j for _, p, o in whole for j in range((o & 255) + 1)}
    assert starts == set(range(5000 - repeated_windows.WIDTH + 1))
    monkeypatch.setattr(repeated_windows, "CHUNK", 1000)
    parts = {(k, p) for _, key, pos, _ in repeated_windows.blocks_of([text]) for k, p in zip(key, pos)}
    assert parts == {(k, p) for k, p, _ in whole}


def test_long_texts_lose_nothing_that_stands_once(spark):
    texts = ["".join(random.Random(seed).choices("abcdefghijklmnopqrstuvwxyz ", k=1_200_000)) for seed in range(2)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
        got = [(r.doc_id, r.text) for r in repeated_windows.remove_repeats(frame).collect()]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert sorted(got) == list(enumerate(texts))


def test_repeated_strings_of_all_cases(spark, docs, rows, tmp_path):
    found = repeated_windows.remove_repeats(docs)
    assert found.columns == docs.columns and found.count() == len(rows)
    assert repeated_windows.remove_repeats(cases.empty(spark)).count() == 0
    assert found.filter(F.col("doc_id") == 2).count() == 1
