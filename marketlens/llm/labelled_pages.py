"""Labelled pages to train the extraction model on, composed by rule from page parts.

A part is HTML with ``data-label="content"`` or ``"other"`` on its outermost elements; what is inside an element
has its label.  Every page joins an article in one of several mark-up styles with other parts before and after
it and inside it, in the order of a seeded generator.
"""

from __future__ import annotations

import random

WORDS = ("water stone light paper river garden market winter answer number letter morning school window country "
         "people story system record question").split()

#: Outer elements of the article: (before, after).
SHELLS = (
    ("<article>", "</article>"),
    ("<main><article>", "</article></main>"),
    ('<main id="main">', "</main>"),
    ('<div id="content">', "</div>"),
    ('<div class="page"><div class="post-body">', "</div></div>"),
    ('<div class="wrapper"><section class="article-content entry">', "</section></div>"),
    ('<div><div class="story text">', "</div></div>"),
    ('<table><tr><td class="main">', "</td></tr></table>"),
)
OTHER = "data-label=\"other\""
#: Parts that are no article text; ``{s}`` is a sentence, ``{w}`` a word.
PARTS = (
    f'<nav {OTHER}><ul><li><a href="/a">{{w}}</a></li><li><a href="/b">{{w}}</a></li><li><a href="/c">{{w}}</a></li></ul></nav>',
    f'<div class="menu" {OTHER}><a href="/a">{{w}}</a> | <a href="/b">{{w}}</a> | <a href="/c">{{w}}</a></div>',
    f'<ul class="navigation breadcrumb" {OTHER}><li><a href="/">{{w}}</a></li><li><a href="/b">{{w}} {{w}}</a></li></ul>',
    f'<header {OTHER}><a href="/">{{w}} {{w}}</a><p>{{w}} {{w}} {{w}}</p></header>',
    f'<div id="header" class="banner" {OTHER}><h1>{{w}}</h1><p>{{s}}</p></div>',
    f'<footer {OTHER}>&copy; {{w}}.example &middot; {{s}}</footer>',
    f'<footer {OTHER}><p>{{s}}</p><ul><li><a href="/x">{{w}}</a></li></ul></footer>',
    f'<div class="footer" {OTHER}><p>{{s}} {{s}}</p></div>',
    f'<aside {OTHER}><h3>{{w}}</h3><p>{{s}}</p><ul><li><a href="/x">{{w}} {{w}}</a></li></ul></aside>',
    f'<div class="sidebar widget" {OTHER}><h2>{{w}}</h2><p>{{s}} {{s}}</p></div>',
    f'<div class="related links" {OTHER}><h3>{{w}} {{w}}</h3><p><a href="/r">{{s}}</a></p></div>',
    f'<div class="ad" {OTHER}>{{s}}</div>',
    f'<div class="advert ads advertisement sponsored promo" {OTHER}><p>{{s}} {{s}}</p></div>',
    f'<div class="cookie consent notice" {OTHER}><p>{{s}}</p><button>{{w}}</button></div>',
    f'<div id="popup" class="alert banner" role="dialog" {OTHER}>{{s}} {{s}}</div>',
    f'<form class="newsletter" {OTHER}><label>{{s}}</label><input name="q"><p>{{s}}</p></form>',
    f'<form id="search" {OTHER}>{{w}} <input><select><option>{{w}}</option></select></form>',
    f'<section id="comments" {OTHER}><h3>{{w}}</h3><p>{{s}} {{s}}</p><p>{{s}}</p></section>',
    f'<div class="comments comment" {OTHER}><div class="comment"><b>{{w}}</b><p>{{s}} {{s}} {{s}}</p></div></div>',
    f'<ol class="comment-list" {OTHER}><li><p>{{s}} {{s}}</p></li><li><p>{{s}}</p></li></ol>',
    f'<div class="share social tags" {OTHER}><a href="/t">{{w}}</a> <a href="/f">{{w}}</a></div>',
)
CONTENT = "data-label=\"content\""
BLOCKS = (
    f"<p {CONTENT}>{{s}} {{s}} {{s}}</p>", f"<p {CONTENT}>{{s}} {{s}}</p>", f"<p {CONTENT}>{{s}}</p>", f"<p {CONTENT}>{{w}}.</p>",
    f"<p {CONTENT}><b>{{s}}</b> {{s}}<br>{{s}}</p>", f'<p {CONTENT}>{{s}} <a href="/l">{{w}} {{w}}</a> {{s}}</p>',
    f"<h2 {CONTENT}>{{w}} {{w}}</h2>", f"<ul {CONTENT}><li>{{s}}</li><li>{{s}} {{s}}</li><li>{{w}} {{w}}</li></ul>",
    f"<blockquote {CONTENT}><p>{{s}}</p></blockquote>", f"<div {CONTENT}>{{s}} {{s}}</div>",
    f"<table {CONTENT}><tr><th>{{w}}</th><td>{{w}} {{w}}</td></tr><tr><th>{{w}}</th><td>{{w}}</td></tr></table>", f"<pre {CONTENT}>{{s}}</pre>",
)


def labelled_pages(n: int = 400, seed: int = 7) -> list[str]:
    rng = random.Random(seed)

    def sentence() -> str:
        words = rng.choices(WORDS, k=rng.randrange(5, 22))
        return words[0].capitalize() + " " + ", ".join(" ".join(words[i:i + 7]) for i in range(1, len(words), 7)) + "."

    def fill(part: str) -> str:
        while "{s}" in part:
            part = part.replace("{s}", sentence(), 1)
        while "{w}" in part:
            part = part.replace("{w}", rng.choice(WORDS).capitalize(), 1)
        return part

    pages = []
    for _ in range(n):
        before, after = rng.choice(SHELLS)
        title = rng.choice((f"<h1 {CONTENT}>{{w}} {{w}} {{w}}</h1>", f"<h1 {CONTENT}>{{s}}</h1>", ""))
        body = [title, *rng.choices(BLOCKS, weights=(6, 6, 6, 2, 2, 2, 2, 3, 1, 2, 1, 1), k=rng.randrange(1, 16))]
        for part in rng.sample(PARTS, rng.choice((0, 0, 0, 1, 2))):
            body.insert(rng.randrange(1, len(body) + 1), part)
        head, tail = rng.sample(PARTS, rng.randrange(0, 5)), rng.sample(PARTS, rng.randrange(0, 5))
        inside = "".join(map(fill, [*head, before, *body, after, *tail]))
        pages.append(f"<!DOCTYPE html><html><head><title>{fill('{w}')}</title></head><body>{inside}</body></html>")
    return pages
