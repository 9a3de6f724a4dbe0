"""Main text of web pages by a tree-structured graphical model.

Every block of a page is a node with a hidden state, content or not. A node's own potential is log-linear in what
the block looks like (element, class and id words, length of its text, share of links); a parent and its child
are tied by a potential on both states. Sum-product messages go up from the leaves and down from the page, which
is exact on a tree; a block whose content marginal is a half or more gives its text.

The parameters maximise the likelihood of labelled pages: the gradient is what the labels hold minus what the
same messages expect. The labelled pages are laid out by the rules of ``labelled_pages`` (layouts of articles with
the parts that pages put around them); their number does not depend on the data. Pages are scored where they lie.

Defined results: a null or empty page has the empty text; text outside any element belongs to the page's own
node; malformed pages are read as far as they go; repeated rows are read each; other columns are not read.
"""

from __future__ import annotations

import math
import random
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm.markup import Page, parse

# fixed values: words of classes and ids, by what they speak for
_WORDS = {
    "n:content": "article post entry content story main body text articlebody blog",
    "n:menu": "nav menu navbar navigation breadcrumb breadcrumbs toc toolbar tabs pager pagination",
    "n:frame": "header footer masthead topbar banner bottom copyright legal site",
    "n:side": "sidebar aside side widget rail related recommended recommend popular trending more teaser tags",
    "n:advert": "ad ads advert advertisement sponsor sponsored promo promoted promotion adsense dfp",
    "n:notice": "cookie cookies consent notice alert popup modal overlay gdpr newsletter subscribe signup paywall disclaimer",
    "n:talk": "comment comments comment-list reply replies discussion disqus respond reader readers feedback",
    "n:form": "form search login share social sharing",
    "n:hidden": "hidden",
}
_KIND = {w: k for k, ws in _WORDS.items() for w in ws.split()}
_TAGS = {
    "t:content": "article main",
    "t:frame": "header footer",
    "t:menu": "nav menu",
    "t:side": "aside dialog",
    "t:form": "form fieldset search",
    "t:para": "p blockquote pre",
    "t:head": "h1 h2 h3 h4 h5 h6 hgroup",
    "t:item": "li dt dd",
    "t:list": "ul ol dl",
    "t:cell": "table tbody thead tr td th",
    "t:box": "div section center figure figcaption details",
    "t:page": "#page html body",
}
_TAG = {w: k for k, ws in _TAGS.items() for w in ws.split()}
_SPLIT = re.compile(r"[^a-z]+")
FEATURES = ["bias", *_TAGS, *_WORDS, "x:none", "x:short", "x:long", "l:some", "l:most", "x:copyright"]
_PLACE = {f: i for i, f in enumerate(FEATURES)}
_AROUND = {_PLACE[f] for f in _PLACE if f in ("t:frame", "t:menu", "t:side", "t:form") or f.startswith("n:") and f != "n:content"}
_INSIDE = {_PLACE["t:content"], _PLACE["n:content"]}
TIES = 3
_COPYRIGHT = re.compile(r"©|\(c\)|all rights reserved", re.IGNORECASE)


@lru_cache(maxsize=4096)
def _named(names: str) -> tuple[int, ...]:
    return tuple(sorted({_PLACE[_KIND[w]] for w in _SPLIT.split(names) if w in _KIND}))


def features(page: Page) -> list[tuple[int, ...]]:
    """Places of each block's features."""
    n = len(page.tag)
    size, text = [0] * n, [""] * n
    for b, own in page.pieces:
        size[b] += len(own)
        if len(text[b]) < 300:  # only the model's look at a notice; the text itself is whole
            text[b] += own
    out = []
    for i in range(n):
        own = [0, _PLACE[_TAG.get(page.tag[i], "t:box")], *(_named(page.names[i]) if page.names[i] else ())]
        own.append(_PLACE["x:none" if not size[i] else "x:short" if size[i] < 60 else "x:long"] if size[i] < 60 or size[i] >= 160 else 0)
        if size[i]:
            share = page.links[i] / size[i]
            if share > 0.7:
                own.append(_PLACE["l:most"])
            elif share > 0.25:
                own.append(_PLACE["l:some"])
            if size[i] < 300 and _COPYRIGHT.search(text[i]):
                own.append(_PLACE["x:copyright"])
        out.append(tuple(own))
    return out


def ties(page: Page, seen: list[tuple[int, ...]]) -> list[int]:
    """Which pair potential ties each block to its parent: 0 plain, 1 marked as something around an article, 2 as content."""
    around = [bool(_AROUND.intersection(fs)) for fs in seen]
    return [1 if a else 2 if _INSIDE.intersection(fs) else 0 for a, fs in zip(around, seen)]


def beliefs(parent: list[int], own: list[float], tie: list[int], edges: list[tuple[float, float, float, float]]) -> tuple[list[float], list[tuple[float, float, float, float]]]:
    """Content marginals, and for each node but the first the joint of (parent, child) as 00, 01, 10, 11.

    ``own`` is a node's log-odds of content, ``edges`` the pair potentials as factors, ``tie`` which of them holds.
    """
    n = len(parent)
    up0, up1 = [1.0] * n, [math.exp(min(30.0, max(-30.0, x))) for x in own]
    to0, to1 = [1.0] * n, [1.0] * n
    for i in range(n - 1, 0, -1):  # a child comes after its parent: leaves first
        s = up0[i] + up1[i]
        a, b = up0[i] / s, up1[i] / s
        up0[i], up1[i] = a, b
        e00, e01, e10, e11 = edges[tie[i]]
        to0[i], to1[i] = e00 * a + e01 * b, e10 * a + e11 * b
        p = parent[i]
        up0[p] *= to0[i]
        up1[p] *= to1[i]
        if up0[p] + up1[p] < 1e-100 or up0[p] + up1[p] > 1e100:
            t = up0[p] + up1[p]
            up0[p] /= t
            up1[p] /= t
    all0, all1 = up0[:], up1[:]  # everything a node has heard
    pairs = [(0.0, 0.0, 0.0, 0.0)] * n
    s = all0[0] + all1[0]
    all0[0], all1[0] = all0[0] / s, all1[0] / s
    for i in range(1, n):
        p = parent[i]
        e00, e01, e10, e11 = edges[tie[i]]
        d0, d1 = all0[p] / to0[i], all1[p] / to1[i]  # without what came from this child
        j00, j01, j10, j11 = d0 * e00 * up0[i], d0 * e01 * up1[i], d1 * e10 * up0[i], d1 * e11 * up1[i]
        s = j00 + j01 + j10 + j11
        pairs[i] = (j00 / s, j01 / s, j10 / s, j11 / s)
        all0[i], all1[i] = (j00 + j10) / s, (j01 + j11) / s
    return all1, pairs


def train(labelled: list[str], rounds: int = 120, rate: float = 0.15, decay: float = 0.0002) -> tuple[np.ndarray, np.ndarray]:
    """Feature weights and log pair potentials from pages whose blocks carry ``data-kind="content"``."""
    pages = []
    for source in labelled:
        page = parse(source, "data-kind")
        seen = features(page)
        pages.append((page.parent, seen, ties(page, seen), [int(x == "content") for x in page.labels]))
    n = len(FEATURES)
    held, moment, spread = np.zeros(n + 4 * TIES), np.zeros(n + 4 * TIES), np.zeros(n + 4 * TIES)
    total = sum(len(p[0]) for p in pages)
    for step in range(1, rounds + 1):
        grad = np.zeros(n + 4 * TIES)
        edges = [tuple(x) for x in np.exp(held[n:]).reshape(TIES, 4).tolist()]
        plain = held[:n].tolist()
        for parent, seen, tie, label in pages:
            p, pairs = beliefs(parent, [sum(plain[f] for f in fs) for fs in seen], tie, edges)
            for i, fs in enumerate(seen):
                for f in fs:
                    grad[f] += label[i] - p[i]
                if i:
                    at = n + 4 * tie[i]
                    grad[at + 2 * label[parent[i]] + label[i]] += 1
                    grad[at : at + 4] -= pairs[i]
        grad = grad / total - decay * held
        moment = 0.9 * moment + 0.1 * grad
        spread = 0.99 * spread + 0.01 * grad * grad
        held = held + rate * (moment / (1 - 0.9**step)) / (np.sqrt(spread / (1 - 0.99**step)) + 1e-8)
    return held[:n], held[n:].reshape(TIES, 4)


def labelled_pages(number: int = 160, seed: int = 5) -> list[str]:
    """Pages in many layouts, each block marked by ``data-kind`` if it is the article's."""
    rng = random.Random(seed)
    syllables = "ka lo mi ren sta vo tur ash bel in".split()

    def prose(least: int, most: int) -> str:
        words = ["".join(rng.choice(syllables) for _ in range(rng.randint(1, 3))) for _ in range(rng.randint(least, most))]
        return " ".join(words).capitalize() + "."

    yes = ' data-kind="content"'

    def links(tag: str, name: str) -> str:
        return f"<{tag}{name}><ul>" + "".join(f'<li><a href="/{i}">{prose(1, 2)}</a></li>' for i in range(rng.randint(3, 8))) + f"</ul></{tag}>"

    def box(tag: str, name: str, inner: str) -> str:
        return f'<{tag} class="{name}">{inner}</{tag}>' if name else f"<{tag}>{inner}</{tag}>"

    def around() -> list[str]:
        some = rng.choice
        return [
            some([links("nav", ""), links("div", ' class="menu"'), links("div", ' id="navbar"'), "<header>" + links("nav", "") + f"<p>{prose(3, 9)}</p></header>"]),
            box(some(["div", "section", "aside"]), some(["ad", "ads top", "advert", "sponsored", "promo-box"]), some([prose(5, 20), f"<p>{prose(10, 40)}</p>"])),
            box("div", some(["cookie-notice", "consent", "alert", "newsletter", "popup"]), some([f"<p>{prose(8, 40)}</p>", prose(6, 30)])),
            box("header", some(["", "site-header", "masthead"]), f"<h1>{prose(1, 4)}</h1><p>{prose(2, 8)}</p>"),
        ]

    def below() -> list[str]:
        some = rng.choice
        talk = "".join(some([f"<p>{prose(5, 60)}</p>", f'<div class="comment"><p>{prose(5, 60)}</p></div>', f"<li><p>{prose(5, 50)}</p></li>"]) for _ in range(rng.randint(1, 5)))
        return [
            box(some(["aside", "div"]), some(["sidebar", "related", "widget", "side recommended"]), f"<h3>{prose(1, 3)}</h3>" + some([links("div", ""), f"<p>{prose(10, 50)}</p>", f"<p>{prose(4, 12)}</p>" * 2])),
            box("aside", "", some([f"<p>{prose(10, 60)}</p>", prose(4, 30), links("div", "")])),
            box(some(["section", "div"]), some(["comments", "comment-list", "discussion", "reader-comments"]), f"<h2>{prose(1, 3)}</h2>" + talk),
            box("form", some(["", "search", "login"]), f"<p>{prose(2, 8)}</p><label>{prose(1, 2)}</label><input name=q>"),
            box("div", some(["share", "social", "tags"]), links("div", "")),
        ]

    def article() -> str:
        parts = [f"<h1{yes}>{prose(3, 9)}</h1>"] if rng.random() < 0.8 else []
        for _ in range(rng.choice([0, 1, 1, 1, 2, 4, 8, 14])):
            kind = rng.random()
            if kind < 0.72:
                parts.append(f"<p{yes}>{rng.choice(['', '<b>', '<i>'])}{prose(1, 120)}" + rng.choice(["</p>", "", "<br>"]))
            elif kind < 0.8:
                parts.append(f"<h2{yes}>{prose(1, 6)}</h2>")
            elif kind < 0.88:
                parts.append(f"<ul{yes}>" + "".join(f"<li{yes}>{prose(2, 20)}</li>" for _ in range(rng.randint(2, 5))) + "</ul>")
            elif kind < 0.92:
                parts.append(f"<blockquote{yes}><p{yes}>{prose(5, 40)}</p></blockquote>")
            elif kind < 0.95:
                parts.append(f"<table{yes}><tr{yes}><td{yes}>{prose(1, 5)}</td><td{yes}>{prose(1, 5)}</td></tr></table>")
            elif kind < 0.97:
                parts.append(f"<pre{yes}>{prose(3, 20)}</pre>")
            else:
                parts.append(rng.choice(around() + below()))
        return "".join(parts)

    pages = []
    for _ in range(number):
        tag, name = rng.choice([("article", ""), ("article", ""), ("article", ' class="post"'), ("main", ""), ("div", ' class="post-content"'), ("div", ' id="content"'), ("section", ' class="entry"'), ("div", ' class="article-body"')])
        inside = f"<{tag}{name}{yes}>{article()}</{tag}>"
        if rng.random() < 0.2:
            inside = f'<div class="wrapper">{inside}</div>'
        head = [x for x in around() if rng.random() < 0.55]
        tail = [x for x in below() if rng.random() < 0.4]
        foot = rng.choice([f"<footer>&copy; {prose(1, 3)} {prose(3, 12)}</footer>", f"<footer><p>{prose(4, 40)}</p></footer>", f'<div class="footer">{prose(4, 25)}</div>', ""])
        pages.append(f"<html><head><title>{prose(2, 5)}</title></head><body>{''.join(head)}{inside}{''.join(tail)}{foot}</body></html>")
    return pages


def main_text(source: str | None, weight: list[float], edges: list[tuple[float, float, float, float]]) -> str:
    if not source:
        return ""
    page = parse(source)
    seen = features(page)
    p, _ = beliefs(page.parent, [sum(weight[f] for f in fs) for fs in seen], ties(page, seen), edges)
    return " ".join(own for b, own in page.pieces if p[b] >= 0.5)


def _extractor(model):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight, edges = model
        for batch in batches:
            source = batch.column("html")
            texts = [main_text(source[i].as_py(), weight, edges) for i in range(len(source))]
            yield batch.set_column(batch.schema.get_field_index("html"), "html", pa.array(texts, pa.string()))

    return rows


def extract(spark: SparkSession, pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", labelled: list[str] | None = None) -> DataFrame:
    """Per page row: ``id, url, text``; ``labelled`` are pages to train on instead of the rule-made ones."""
    weight, edges = train(labelled or labelled_pages())
    model = (weight.tolist(), [tuple(x) for x in np.exp(edges).tolist()])
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).cast("string").alias("html"))
    kind = dict(rows.dtypes)
    return rows.mapInArrow(_extractor(model), f"id {kind['id']}, url {kind['url']}, html string").withColumnRenamed("html", "text")
