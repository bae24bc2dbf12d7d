"""Main-text extraction: gradient-boosted trees over DOM elements, decoded down the hierarchy.

Trees score how likely each element belongs to the main text, from its tag, attribute tokens, depth, place
among its siblings and the density of its subtree (``dom.FEATURES``). Decoding picks the set of elements
with the greatest total log odds in which no element is kept below a dropped one: an element is kept if its
subtree's best score is positive and its parent is kept. So ancestors and descendants cannot contradict.

The trees are fitted on the driver to pages made from a grammar of layouts (articles, menus, headers,
footers, sidebars, notices, adverts, forms, comments), whose labels are known by construction. Their number
is a parameter; no given page is needed for the fit and every given page is extracted whole.

Defined results: NULL and empty pages have an empty text; malformed markup is read as far as it goes, open
elements end with the page; of equal scores the element is dropped; repeated rows get equal texts.
"""

from __future__ import annotations

import random
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import dom

FIT_PAGES = 900
_LEVELS = 3


class Boosted:
    """Logistic gradient boosting with complete trees of three levels."""

    def __init__(self, trees: int = 45, rate: float = 0.25, bins: int = 24, ridge: float = 1.0) -> None:
        self.trees, self.rate, self.bins, self.ridge = trees, rate, bins, ridge
        self.start = 0.0
        self.feature = np.zeros((0, 2**_LEVELS - 1), np.int64)
        self.limit = np.zeros((0, 2**_LEVELS - 1))
        self.leaf = np.zeros((0, 2**_LEVELS))

    def fit(self, x: np.ndarray, y: np.ndarray, w: np.ndarray) -> Boosted:
        n, width = x.shape
        edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, self.bins + 1)[1:-1])) for f in range(width)]
        binned = np.stack([np.searchsorted(edges[f], x[:, f], side="left") for f in range(width)], 1)
        share = np.clip((w * y).sum() / w.sum(), 1e-3, 1 - 1e-3)
        self.start = float(np.log(share / (1 - share)))
        score = np.full(n, self.start)
        features, limits, leaves = [], [], []
        for _ in range(self.trees):
            p = 1 / (1 + np.exp(-score))
            grad, hess = w * (y - p), w * p * (1 - p)
            node = np.zeros(n, np.int64)
            feature, limit = np.zeros(2**_LEVELS - 1, np.int64), np.full(2**_LEVELS - 1, np.inf)
            for level in range(_LEVELS):
                first, count = 2**level - 1, 2**level
                best = np.full(count, 1e-9)
                for f in range(width):
                    size = len(edges[f]) + 1
                    if size == 1:
                        continue
                    slot = (node - first) * size + binned[:, f]
                    g = np.bincount(slot, grad, count * size).reshape(count, size).cumsum(1)
                    h = np.bincount(slot, hess, count * size).reshape(count, size).cumsum(1)
                    gl, hl, gt, ht = g[:, :-1], h[:, :-1], g[:, -1:], h[:, -1:]
                    r = self.ridge
                    gain = gl**2 / (hl + r) + (gt - gl) ** 2 / (ht - hl + r) - gt**2 / (ht + r)
                    at = gain.argmax(1)
                    top = gain[np.arange(count), at]
                    for k in np.flatnonzero(top > best):
                        best[k], feature[first + k], limit[first + k] = top[k], f, edges[f][at[k]]
                node = 2 * node + 1 + (x[np.arange(n), feature[node]] > limit[node])
            slot = node - (2**_LEVELS - 1)
            g = np.bincount(slot, grad, 2**_LEVELS)
            h = np.bincount(slot, hess, 2**_LEVELS)
            leaf = self.rate * g / (h + self.ridge)
            score += leaf[slot]
            features.append(feature)
            limits.append(limit)
            leaves.append(leaf)
        self.feature, self.limit, self.leaf = np.array(features), np.array(limits), np.array(leaves)
        return self

    def odds(self, x: np.ndarray) -> np.ndarray:
        """Log odds of each row."""
        score = np.full(len(x), self.start)
        rows = np.arange(len(x))
        for feature, limit, leaf in zip(self.feature, self.limit, self.leaf, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(_LEVELS):
                node = 2 * node + 1 + (x[rows, feature[node]] > limit[node])
            score += leaf[node - (2**_LEVELS - 1)]
        return score


def _words(rng: random.Random, low: int, high: int) -> str:
    alphabet = "aaabcdeeefghiiijklmnooopqrsttuvwxyz"
    some = ["".join(rng.choices(alphabet, k=rng.randint(1, 9))) for _ in range(rng.randint(low, high))]
    text = " ".join(w + rng.choice(["", "", "", "", "", ",", "."]) for w in some).capitalize()
    style = rng.random()
    if style < 0.05:
        return text.upper()
    return text.replace(" ", rng.choice(["%%% ", "### ", "!! "])) if style < 0.1 else text


def _attr(rng: random.Random, *names: str) -> str:
    if not names:
        return ""
    name = rng.choice(names)
    key = rng.choice(["class", "class", "id"])
    return f' {key}="{rng.choice(["", "site-", "page-", "c-", "x "])}{name}{rng.choice(["", "-inner", "-1", " box"])}"'


def _links(rng: random.Random, n: int) -> str:
    return "<ul>" + "".join(f'<li><a href="/{i}">{_words(rng, 1, 4)}</a></li>' for i in range(n)) + "</ul>"


def _boilerplate(rng: random.Random, kind: str, inside: bool = False) -> str:
    """One piece that is not main text."""
    div = rng.choice(["div", "div", "section"])
    text = _words(rng, 2, 45)
    if kind == "menu":
        body = _links(rng, rng.randint(2, 9))
        return f"<nav>{body}</nav>" if rng.random() < 0.5 else f"<{div}{_attr(rng, 'menu', 'nav', 'navbar', 'breadcrumb')}>{body}</{div}>"
    if kind == "header":
        body = f"<a href='/'>{_words(rng, 1, 3)}</a>" + (f"<h1>{_words(rng, 1, 4)}</h1>" if rng.random() < 0.4 else f"<p>{_words(rng, 1, 9)}</p>")
        return f"<header>{body}</header>" if rng.random() < 0.6 else f"<div{_attr(rng, 'header', 'masthead', 'banner')}>{body}</div>"
    if kind == "footer":
        body = rng.choice([f"&copy; {text}", f"<p>{text}</p>", f"<p>{text}</p>{_links(rng, 3)}"])
        return f"<footer>{body}</footer>" if rng.random() < 0.6 else f"<div{_attr(rng, 'footer', 'copyright', 'legal')}>{body}</div>"
    if kind == "sidebar":
        body = rng.choice([f"<h3>{_words(rng, 1, 4)}</h3>{_links(rng, 4)}", f"<h3>{_words(rng, 1, 3)}</h3><p>{text}</p>", f"<p>{text}</p>"])
        return f"<aside>{body}</aside>" if rng.random() < 0.5 else f"<div{_attr(rng, 'sidebar', 'widget', 'related', 'side')}>{body}</div>"
    if kind == "notice":
        return f"<{div}{_attr(rng, 'cookie', 'notice', 'consent', 'alert', 'popup', 'newsletter')}><p>{text}</p>{'<button>Ok</button>' if rng.random() < 0.6 else ''}</{div}>"
    if kind == "advert":
        body = rng.choice([text, f"<p>{text}</p>", f"<a href='/x'>{text}</a>"])
        return f"<{div}{_attr(rng, 'ad', 'ads', 'advert', 'promo', 'sponsored', 'banner')}>{body}</{div}>"
    if kind == "form":
        return f"<form{_attr(rng, 'search', 'login', 'subscribe') if rng.random() < 0.5 else ''}><label>{_words(rng, 1, 5)}</label><input name=q><button>{_words(rng, 1, 2)}</button></form>"
    if kind == "comments":
        tag = rng.choice(["div", "li", "article"])
        each = "".join(
            f"<{tag}{_attr(rng, 'comment', 'reply')}><b>{_words(rng, 1, 2)}</b><p>{_words(rng, 2, 60)}</p></{tag}>"
            for _ in range(rng.randint(1, 5))
        )
        return f"<{div}{_attr(rng, 'comments', 'discussion', 'respond')}><h3>{_words(rng, 1, 3)}</h3>{each}</{div}>"
    if kind == "share":
        return f"<div{_attr(rng, 'share', 'social', 'toolbar', 'pagination')}>{_links(rng, 3)}</div>"
    return f"<script>{text}</script>" if rng.random() < 0.5 else f"<style>{text}</style>"


_KINDS = "menu header footer sidebar notice advert form comments share script".split()
_KEEP, _DROP = "\x01", "\x02"


def _article(rng: random.Random) -> str:
    """The main text, possibly with pieces inside that are not; those are wrapped in marks."""
    parts = []
    if rng.random() < 0.8:
        title = f"<h1>{_words(rng, 1, 9)}</h1>"
        parts.append(f"<header>{title}</header>" if rng.random() < 0.15 else title)
    for _ in range(rng.choice([1, 1, 2, 3, 5, 8, 14])):
        text = _words(rng, *rng.choice([(1, 3), (4, 30), (20, 90), (60, 300)]))
        if rng.random() < 0.15:
            text = f"<b>{text}<br>"
        elif rng.random() < 0.2:
            text += f' <a href="/y">{_words(rng, 1, 4)}</a> {_words(rng, 1, 8)}'
        block = rng.random()
        if block < 0.8:
            parts.append(f"<p>{text}</p>" if rng.random() < 0.8 else f"<p>{text}")
        elif block < 0.88:
            parts.append(f"<h2>{_words(rng, 1, 6)}</h2><p>{text}</p>")
        elif block < 0.92:
            parts.append("<ul>" + "".join(f"<li>{_words(rng, 2, 14)}</li>" for _ in range(3)) + "</ul>")
        elif block < 0.95:
            parts.append(f"<blockquote><p>{text}</p></blockquote>")
        elif block < 0.97:
            parts.append(f"<table><tr><td>{_words(rng, 1, 5)}</td><td>{_words(rng, 1, 5)}</td></tr></table>")
        else:
            parts.append(f"<div>{text}</div>")
        if rng.random() < 0.06:
            parts.append(_DROP + _boilerplate(rng, rng.choice(["advert", "share", "form", "sidebar", "notice", "script"])) + _KEEP)
    if rng.random() < 0.12:
        parts.append(_DROP + _boilerplate(rng, "comments") + _KEEP)
    return _KEEP + "".join(parts) + _DROP


def made_page(rng: random.Random) -> str:
    """A page of the grammar; marks in its text tell main text from the rest."""
    wrap = rng.random()
    body = _article(rng)
    if wrap < 0.5:
        main = f"<article{_attr(rng, 'post', 'article') if rng.random() < 0.3 else ''}>{body}</article>"
    elif wrap < 0.65:
        main = f"<main>{body}</main>"
    elif wrap < 0.92:
        main = f"<div{_attr(rng, 'content', 'article', 'post', 'entry', 'story', 'main', 'text')}>{body}</div>"
    else:
        main = f"<div>{body}</div>"
    if rng.random() < 0.2:
        main = f"<main>{main}</main>"
    before = [_boilerplate(rng, k) for k in rng.sample(_KINDS, rng.randint(0, 4))]
    after = [_boilerplate(rng, k) for k in rng.sample(_KINDS, rng.randint(0, 4))]
    if rng.random() < 0.3:
        main = f"<div{_attr(rng, 'container', 'wrapper', 'row') if rng.random() < 0.6 else ''}>{main}{_boilerplate(rng, 'sidebar')}</div>"
    head = f"<head><title>{_words(rng, 1, 6)}</title><style>p{{margin:0}}</style></head>"
    return f"<!DOCTYPE html><html>{head}<body>{''.join(before)}{main}{''.join(after)}</body></html>"


def labelled(page: str) -> tuple[dom.Tree, list[int], list[float]]:
    """The tree of a made page without its marks, labels of its elements, and their weights."""
    tree = dom.parse(page)
    keeps, texts, state = [0] * len(tree.tags), [], False
    for k, text, broken in tree.texts:
        for piece in _pieces(text):
            if piece in (_KEEP, _DROP):
                state = piece == _KEEP
            else:
                texts.append((k, piece, broken))
                keeps[k] += state and piece.strip() != ""
    tree.texts = texts
    for k in range(len(keeps) - 1, 0, -1):
        keeps[tree.parent[k]] += keeps[k]
    filled = [0] * len(keeps)
    for k, text, _ in tree.texts:
        filled[k] += len(text.strip())
    for k in range(len(keeps) - 1, 0, -1):
        filled[tree.parent[k]] += filled[k]
    return tree, [int(x > 0) for x in keeps], [float(x > 0) for x in filled]


def _pieces(text: str) -> list[str]:
    return [x for x in text.replace(_KEEP, f"\0{_KEEP}\0").replace(_DROP, f"\0{_DROP}\0").split("\0") if x]


@lru_cache(maxsize=2)
def fitted(pages: int = FIT_PAGES, seed: int = 7) -> Boosted:
    rng = random.Random(seed)
    x, y, w = [], [], []
    for _ in range(pages):
        tree, labels, weights = labelled(made_page(rng))
        x += dom.features(tree)
        y += labels
        w += weights
    return Boosted().fit(np.array(x), np.array(y, float), np.array(w))


def decode(tree: dom.Tree, odds: np.ndarray) -> list[bool]:
    """Keep the elements of the best top part of the tree."""
    n = len(tree.tags)
    best = odds.tolist()
    for k in range(n - 1, 0, -1):
        if best[k] > 0:
            best[tree.parent[k]] += best[k]
    kept = [True] * n
    for k in range(1, n):
        kept[k] = kept[tree.parent[k]] and best[k] > 0 and tree.tags[k] not in ("script", "style", "title")
    return kept


def texts(pages: list[str | None], model: Boosted) -> list[str]:
    trees = [dom.parse(p) for p in pages]
    rows = [dom.features(t) for t in trees]
    odds = model.odds(np.array([r for page in rows for r in page], float).reshape(-1, len(dom.FEATURES)))
    found, at = [], 0
    for tree, own in zip(trees, rows, strict=True):
        found.append(dom.join_texts(tree, decode(tree, odds[at : at + len(own)])))
        at += len(own)
    return found


def extract(pages: DataFrame, *, fit_pages: int = FIT_PAGES, batch: int = 512) -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    model = pages.sparkSession.sparkContext.broadcast(fitted(fit_pages))
    kept = pages.select("page_id", "url", "html")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, batch):
                part = whole.slice(at, batch)
                found = texts(part.column(2).to_pylist(), model.value)
                sizes = pa.array([len(t) for t in found], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(found, pa.string()), sizes],
                    names=["page_id", "url", "text", "n_chars"],
                )

    return kept.mapInArrow(run, f"page_id {kept.dtypes[0][1]}, url string, text string, n_chars long")
