from __future__ import annotations

import html as entities
import math
import random
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from marketlens.llm import chat_format, html_extract, knn_join, url_filters
from marketlens.llm.labelled_pages import labelled_pages

# --- URL filters -------------------------------------------------------------

URLS = [
    (1, "HTTP://WWW.Example.ORG/es/a?x#y", "www.example.org", "/es/a", "example.org/es/", "block"),
    (2, "http://example.org/en/12", "example.org", "/en/12", "example.org/en/1", "block"),
    (3, "http://example.org/en/2", "example.org", "/en/2", "org/", "allow"),
    (4, "http://notexample.org/es/", "notexample.org", "/es/", "org/", "allow"),
    (5, "http://a.com/fr/", "a.com", "/fr/", "com/fr/", "allow"),
    (6, "http://a.com/de/x", "a.com", "/de/x", "com/de/", "block"),
    (7, "http://a.com/en/", "a.com", "/en/", None, "allow"),
    (8, "http://x.casino-win.example.net", "x.casino-win.example.net", "", None, "block"),
    (9, "http://xcasino-win.example.net/", "xcasino-win.example.net", "/", None, "allow"),
    (10, None, "", "", None, "allow"), (11, "", "", "", None, "allow"), (12, "no scheme.org/", "", "", None, "allow"),
    (13, "a://b://c.org/", "b:", "//c.org/", None, "allow"), (14, "http://org", "org", "", None, "allow"),
    (15, "http://É.ORG/x", "É.org", "/x", "org/", "allow"), (16, "://?q", "", "", None, "allow"),
    (1, "HTTP://WWW.Example.ORG/es/a?x#y", "www.example.org", "/es/a", "example.org/es/", "block"),
]


def pages_of(spark, rows):
    return spark.createDataFrame([(i, u, "h", "r") for i, u in rows], "page_id long, url string, `host` string, `rule` string")


def test_urls(spark):
    got = url_filters.judge(pages_of(spark, [u[:2] for u in URLS] + [(None, "http://a.org/")])).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(str((u[0], *u[2:])) for u in URLS + [(None, 0, "a.org", "/", "org/", "allow")])
    assert url_filters.judge(pages_of(spark, [])).count() == 0


@pytest.mark.parametrize("size", ["sf0.01", "sf0.1"])
def test_bad_sites_are_blocked_under_every_domain(spark, size):
    bad = re.compile(r"(^|\.)(adult-x|ads-track|casino-win|cheap-pills|free-bets|spam-farm)\.example\.")
    got = url_filters.judge(spark.read.parquet(f"/root/testdata/{size}/pages.parquet")).collect()
    got = [r for r in got if r.rule is None]
    assert {r.verdict for r in got if bad.search(r.host)} == {"block"}
    assert {r.verdict for r in got if not bad.search(r.host)} == {"allow"}


def test_bad_sites_under_a_domain_not_seen_before(spark):
    hosts = ["m.adult-x.example.shop", "adult-x.example.shop", "xadult-x.example.shop", "adult-x.example.shop.a"]
    got = url_filters.judge(pages_of(spark, [(i, f"http://{h}/") for i, h in enumerate(hosts)])).collect()
    assert [r.verdict for r in sorted(got, key=lambda r: r.page_id)] == ["block", "block", "allow", "allow"]


def test_long_urls_are_linear(spark):
    host = "a." * 50_000 + "spam-farm.example.com"
    found = spark.range(1).select(url_filters.keys_of(F.lit(host), F.lit("/" + "x" * 50_000), [0, 1, 4], 3).alias("k")).first()["k"]
    assert set(found) == {d + p for d in ("com", "example.com", "spam-farm.example.com") for p in ("", "/", "/xxx")}
    start = time.time()
    got = url_filters.judge(pages_of(spark, [(1, f"http://{host}/x"), (2, f"http://{host}.net/")])).collect()
    assert [r.verdict for r in sorted(got, key=lambda r: r.page_id)] == ["block", "allow"]
    assert time.time() - start < 60


@pytest.mark.parametrize("share", [2, 50, 5000])
def test_cascade_is_exact_for_all_keys(spark, share):
    keys = spark.range(5000).select(F.concat(F.lit("k"), "id").alias("key"))
    listed = keys.filter(F.pmod(F.xxhash64("key"), F.lit(share)) == 0).union(spark.createDataFrame([("absent",)], "key string"))
    cascade = url_filters.build(*(f.select(*url_filters.hashed(F.col("key"))) for f in (listed, keys)))
    frame, inside = keys.select("key", *url_filters.hashed(F.col("key"))).toPandas(), set(listed.toPandas()["key"])
    assert (cascade.holds(frame["a"].to_numpy(), frame["b"].to_numpy()) == frame["key"].isin(inside).to_numpy()).all()


def test_too_large_lists_are_joined_instead(spark, monkeypatch):
    small = url_filters.judge(pages_of(spark, [u[:2] for u in URLS])).collect()
    monkeypatch.setattr(url_filters, "MAX_BYTES", 0)
    joined = url_filters.judge(pages_of(spark, [u[:2] for u in URLS])).collect()
    assert sorted(map(str, joined)) == sorted(map(str, small))


# --- top-k -------------------------------------------------------------------


def plain_top(rows, k):
    vectors = {}
    for i, v in rows:
        if i is not None and v is not None and len(v) == 8 and all(x is not None and math.isfinite(x) for x in v):
            vectors[i] = [math.floor(1024 * x) for x in v]
    out = []
    for q in vectors:
        if q % 5 == 0:
            scored = sorted((-sum(a * b for a, b in zip(vectors[q], v)), i) for i, v in vectors.items() if i != q)
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored[:k])]
    return sorted(out)


def embeddings(seed, n, spread):
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(6, 8))
    rows = [(i, (centers[i % 6] + spread * rng.normal(size=8)).astype(np.float32).astype(float).tolist()) for i in range(n)]
    same = rows[1][1]
    rows += [(10_000 + i, same) for i in range(40)]
    rows += [(20_000, None), (20_005, [1.0] * 7 + [None]), (20_010, [float("nan")] * 8), (20_015, [1.0] * 7 + [float("inf")]),
             (None, same), (20_020, [1.0] * 3), (20_025, [0.0] * 8), rows[3]]
    return rows


@pytest.mark.parametrize(("n", "spread", "size"), [(300, 1.0, 512), (300, 0.05, 3), (4, 1.0, 512)])
def test_top_k_equals_brute_force(spark, monkeypatch, n, spread, size):
    monkeypatch.setattr(knn_join, "GROUP_QUERIES", size)
    rows = embeddings(1, n, spread)
    frame = spark.createDataFrame([(i, v, 0, 0.0) for i, v in rows], "vec_id long, embedding array<double>, cell int, d double")
    assert sorted(map(tuple, knn_join.top_k(frame, F.col("vec_id") % 5 == 0).collect())) == plain_top(rows, 10)


def test_top_k_of_nothing_and_of_large_values(spark):
    schema = "vec_id long, embedding array<double>"
    assert knn_join.top_k(spark.createDataFrame([], schema), F.col("vec_id") % 5 == 0).count() == 0
    rows = [(i, [2.0 ** 19 + i, -1.0]) for i in range(20)]
    got = {(r.query_id, r.rank): (r.vec_id, r.score) for r in knn_join.top_k(spark.createDataFrame(rows, schema), F.col("vec_id") == 0).collect()}
    assert got[0, 1] == (19, 1024 * 2 ** 19 * 1024 * (2 ** 19 + 19) + 1024 ** 2)


# --- main text ---------------------------------------------------------------


@pytest.fixture(scope="module")
def model(spark):
    return html_extract.train(spark)


def test_held_out_labelled_pages(model):
    right = n = 0
    for source in labelled_pages(150, seed=99):
        page = html_extract.Page(source)
        kept = model.marginals(page)
        for block, _ in page.texts:
            right += (kept[block] > 0.5) == (page.label[block] == "content")
            n += 1
    assert right / n > 0.97


def test_marginals_equal_enumeration(model):
    page = html_extract.Page("<div><p>One, two.</p><ul><li><a href=x>a</a></li></ul></div>")
    n, features = len(page.tag), page.features()
    odds = [math.exp(max(-20, min(20, sum(model.node.get(f, 0) for f in fs)))) for fs in features]
    total, one = 0.0, [0.0] * n
    for bits in range(1 << n):
        s = [bits >> i & 1 for i in range(n)]
        weight = math.prod(odds[i] if s[i] else 1.0 for i in range(n)) * math.prod(model.edge[s[page.parent[i]]][s[i]] for i in range(1, n))
        total += weight
        one = [a + weight * b for a, b in zip(one, s)]
    assert np.allclose(model.marginals(page), [a / total for a in one])


def test_given_pages_keep_the_article(spark, model):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    sources = {r.page_id: r.html for r in pages.collect()}
    for r in html_extract.extract(pages, model).collect():
        article = re.search(r"<article>(.*?)(?:</article>|$)", sources[r.page_id], re.S)[1]
        blocks = (" ".join(entities.unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)\b[^>]*>", article))
        assert r.text == "\n".join(b for b in blocks if b) and r.n_chars == len(r.text)


def test_broken_and_empty_pages(spark, model):
    rows = [(1, None), (2, ""), (3, "<div class='x"), (4, "<" * 50), (5, "<!-- open"), (6, "<article><p>a &amp; b&eacute;\n c<br>d<p>e"),
            (7, "<article><p>" + "Long text, really. " * 50_000), (8, "<article>" + "<div>" * 3000 + "<p>Deep text, here."), (None, None)]
    frame = spark.createDataFrame([(i, None, h, "t") for i, h in rows], "page_id long, url string, html string, `text` string")
    got = {r.page_id: r.text for r in html_extract.extract(frame, model).collect()}
    assert got[1] == got[2] == got[5] == got[None] == ""
    assert got[6] == "a & bé c d\ne" and len(got[7]) == 19 * 50_000 - 1 and got[8] in ("Deep text, here.", "")
    assert html_extract.extract(frame.limit(0), model).count() == 0


HEADS = ["<html><head><title>t</title><meta charset=x><body>", "<head><title>t</title><script>var a='<p>';</script>",
         "<html><head><link rel=a>\n", "<head><template><i>x</i><body>", "<head><style>p {}</style></head><body>"]


@pytest.mark.parametrize("head", HEADS)
def test_pages_that_leave_out_the_end_of_the_head(head):
    page = html_extract.Page(f"{head}<article><h1>Title</h1><p>Some text.</p></article>")
    assert [t for _, t in page.texts] == ["Title", "Some text."]
    assert [t for _, t in html_extract.Page("<head><title>t</title>Bare <b>text").texts] == ["Bare text"]


@pytest.mark.parametrize("tag", "button select object canvas audio video svg".split())
def test_dropped_elements_without_an_end_lose_no_blocks(tag):
    text = lambda source: [t for _, t in html_extract.Page(source).texts]
    assert text(f"<article><p>One.</p><{tag}>x<p>Two.</p><div>Three.</div></article>") == ["One.", "Two.", "Three."]
    assert text(f"<div><{tag}>x</div>One.<{tag}>y</{tag}><p>Two.</p>") == ["One.", "Two."]
    assert text(f"<p>One.</p><{tag}>x<{tag}>y</{tag}><p>Two.</p>") == ["One.", "Two."]
    assert text(f"<p>One.</p><{tag}><p>in it</p></{tag}><p>Two.</p>") == ["One.", "Two."]


@pytest.mark.parametrize("source", [
    "<zz>" * 200_000 + "text", "<b>" * 8_000 + "</i>" * 200_000 + "text", "<div>" * 8_000 + "</p>" * 200_000 + "text",
    "<ul><li><zz>" * 60_000 + "text", "<body>" * 100_000 + "text"], ids=["nested", "unmatched inline", "unmatched", "lists", "bodies"])
def test_a_megabyte_of_tags_is_linear(source):
    start = time.process_time()
    page = html_extract.Page(source)
    assert time.process_time() - start < 6
    assert [t for _, t in page.texts] == ["text"]


# --- chat formatting ---------------------------------------------------------


def test_turns_survive_formatting(spark):
    rng = random.Random(5)
    bits = ["<|im_start|>", "<|im_end|>", "\\", "<|", "\\p|", "\\s", "\n", "a", "é", "<\\p|", "\\l"]
    talk = lambda: "".join(rng.choices(bits, k=rng.randrange(0, 12)))
    rows = [(c, t, rng.choice(["user", "assistant", "we\\ird\n<|role"]), talk()) for c in range(40) for t in range(rng.randrange(1, 6))]
    rows += [(50, 0, None, None), (51, None, "assistant", "x"), (52, 1, "user", "b"), (52, 1, "user", "a"), (None, 0, "user", "n")]
    frame = spark.createDataFrame([(*r, "z") for r in rows], "conv_id long, turn long, role string, text string, mask string")
    done = chat_format.format_turns(frame).withColumns({
        "turns": chat_format.parse_turns(F.col("formatted")), "loss": chat_format.masked_texts(F.col("formatted"), F.col("mask"))})
    expected = {}
    for c, t, role, text in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        expected.setdefault(c, []).append((role or "", text or ""))
    got = {r.conv_id: r for r in done.collect()}
    assert {c: [tuple(x) for x in r.turns] for c, r in got.items()} == expected
    assert all(r.loss == [x for role, x in expected[c] if role == "assistant"] for c, r in got.items())
    assert chat_format.format_turns(frame.limit(0)).count() == 0


def test_layouts_by_fingerprint(spark):
    records = [
        ('{"prompt":"a","response":"b"}', "prompt_response", [("user", "a"), ("assistant", "b")]),
        ('{"response":null,"prompt":"a"}', "prompt_response", [("user", "a"), ("assistant", "")]),
        ('{"instruction":"i","input":"x","output":"o"}', "instruction_input", [("user", "i\nx"), ("assistant", "o")]),
        ('{"conversations":[{"from":"human","value":"h"},{"from":"gpt","value":"g"}]}', "from_value", [("user", "h"), ("assistant", "g")]),
        ('{"messages":[{"role":"system","content":"s"}]}', "messages", [("system", "s")]),
        ('{"messages":"text"}', None, None), ("broken", None, None), (None, None, None), ("{}", None, None),
    ]
    frame = spark.createDataFrame([(r[0],) for r in records], "record string")
    got = {r.record: (r.layout, r.turns and [tuple(t) for t in r.turns]) for r in chat_format.turns_of_json(frame, "record").collect()}
    assert got == {r[0]: (r[1], r[2]) for r in records}
    typed = spark.createDataFrame([(7, [("human", "h")])], "id long, conversations array<struct<from: string, value: string>>")
    assert [tuple(r) for r in chat_format.turn_rows(typed, "id").collect()] == [(7, 0, "user", "h")]
    assert [tuple(r) for r in chat_format.turn_rows(typed.withColumn("prompt", F.lit("x")), "id").collect()] == [(7, 0, "user", "h")]
    with pytest.raises(ValueError):
        chat_format.turn_rows(typed.select("id"), "id")


def test_fields_of_all_elements_of_a_list_count(spark):
    records = {'{"messages":[{"role":"user"},{"role":"assistant","content":"b"}]}': [("user", ""), ("assistant", "b")],
               '{"messages":[{"role":"user","content":"a"},{"name":"x"}]}': None, '{"messages":[]}': None, '{"messages":[1,"x"]}': None}
    frame = spark.createDataFrame([(r,) for r in records], "record string")
    got = {r.record: r.turns and [tuple(t) for t in r.turns] for r in chat_format.turns_of_json(frame, "record").collect()}
    assert got == records


def test_clashing_columns_change_nothing(spark):
    rows = [(1, 0, "human", "hi"), (1, 1, None, None), (None, None, "assistant", "x"), (2, 5, "assistant", "")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    extra = frame.withColumns({c: F.lit("z") for c in ("prompt", "response", "input", "system", "fingerprint", "r", "n", "m")}).withColumn(
        "messages", F.array(F.struct(F.lit("user").alias("role"), F.lit("m").alias("content"))))
    for table in (frame, extra):
        found = chat_format.turn_rows(table)
        assert sorted(map(tuple, found.collect()), key=str) == sorted(rows, key=str)
    named = extra.drop("conv_id").withColumn("key", F.lit(3))
    assert {tuple(r) for r in chat_format.turn_rows(named, "key").collect()} == {(3, 0, "system", "z"), (3, 1, "user", "z"), (3, 2, "assistant", "z")}
    plan = chat_format.turn_rows(extra)._jdf.queryExecution().analyzed().toString()
    assert "sha2(" in plan


def test_chat_runs_without_python(spark):
    plan = chat_format.query(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
