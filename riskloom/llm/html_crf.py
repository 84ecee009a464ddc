"""Main text of pages: a linear-chain conditional random field over the leaf blocks of the page.

Features are the tags and class words of a block's ancestors and traits of its text; labels are "main"
and "other". Weights are learned on labelled pages drawn from templates of many layouts, by gradient
ascent on the conditional likelihood; pages are decoded by Viterbi.
"""

from __future__ import annotations

import random
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from riskloom.llm.common import slices
from riskloom.llm.dom import Block, blocks

#: Parts of class and id words that say something about a block, as features of their own.
OTHER_WORDS = "nav menu header masthead footer sidebar side aside ad ads advert adverts advertisement sponsor sponsored promo banner cookie consent notice alert popup modal overlay comment comments reply replies respond discussion form search login signup subscribe newsletter share social related recommended recommendation breadcrumb breadcrumbs pagination pager widget copyright legal disclaimer toolbar skip hidden".split()
MAIN_WORDS = "article content main post entry story text body page prose".split()
SIGNS = frozenset(OTHER_WORDS) | frozenset(MAIN_WORDS)
CUT = re.compile(r"[^a-z0-9]+|(?<=[a-z])(?=[0-9])")
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
#: Training: pages drawn, steps, rate of the gradient steps, and weight of the penalty.
PAGES, STEPS, RATE, PENALTY = 600, 150, 0.15, 0.002
#: Distinct paths whose features a Python worker keeps.
KEPT = 20_000


@lru_cache(maxsize=KEPT)
def path_features(path: tuple[tuple[str, str], ...]) -> tuple[str, ...]:
    out = {f"tag={path[-1][0]}" if path else "tag="}
    for tag, words in path:
        out.add(f"in={tag}")
        for w in CUT.split(CAMEL.sub(" ", words).lower()):
            if w in SIGNS:
                out.add(f"class={w}")
    return tuple(out)


def _bucket(n: int, edges: tuple[int, ...]) -> int:
    return sum(n >= e for e in edges)


def text_features(b: Block) -> tuple[str, ...]:
    t = b.text
    words = t.count(" ") + 1
    return (
        f"words={_bucket(words, (2, 4, 8, 16, 32, 64))}",
        f"linked={_bucket(100 * b.linked // len(t), (1, 30, 70))}",
        f"stop={t[-1] in '.!?…:;'}",
        f"commas={min(2, t.count(','))}",
        f"sign={'©' in t[:40]}",
    )


class Chain:
    """Weights of features for "main", of the four transitions, and of the first and last label."""

    def __init__(self, names: list[str], weights: np.ndarray, moves: np.ndarray, ends: np.ndarray):
        self.weights = dict(zip(names, weights.tolist(), strict=True))
        self.moves, self.ends = moves, ends
        self.of_path = lru_cache(maxsize=KEPT)(lambda path: sum(self.weights.get(f, 0.0) for f in path_features(path)))

    def __reduce__(self):
        return Chain, (list(self.weights), np.array(list(self.weights.values())), self.moves, self.ends)

    def decode(self, page: list[Block]) -> list[int]:
        """Labels of the best sequence; a tie falls to "other"."""
        if not page:
            return []
        get = self.weights.get
        (oo, om), (mo, mm) = self.moves.tolist()
        (so, sm), (eo, em) = self.ends.tolist()
        other = main = None
        back = []
        for b in page:
            e = self.of_path(b.path) + sum(get(f, 0.0) for f in text_features(b))
            if other is None:
                other, main = so, sm + e
                continue
            from_o, from_m = (other + om, main + mm)
            to_o = (other + oo, main + mo)
            back.append((int(to_o[1] > to_o[0]), int(from_m > from_o)))
            other, main = max(to_o), max(from_o, from_m) + e
        label = int(main + em > other + eo)
        out = [label]
        for step in reversed(back):
            label = step[label]
            out.append(label)
        return out[::-1]

    def text(self, html: str | None) -> str:
        """Main blocks in page order, joined by line feeds."""
        page = blocks(html)
        return "\n".join(b.text for b, main in zip(page, self.decode(page), strict=True) if main)


# --- training ---------------------------------------------------------------------------------


def fit(pages: list[tuple[list[Block], list[int]]], steps: int = STEPS, rate: float = RATE, penalty: float = PENALTY) -> Chain:
    """Maximise the mean conditional log likelihood of labelled pages less a squared penalty (Adam)."""
    names: dict[str, int] = {}
    rows = [[[names.setdefault(f, len(names)) for f in (*path_features(b.path), *text_features(b))] for b in page] for page, _ in pages]
    n, longest, k = len(pages), max(len(p) for p, _ in pages), len(names)
    x = np.zeros((n, longest, k), np.float32)
    y = np.zeros((n, longest), int)
    size = np.array([len(p) for p, _ in pages])
    for i, (page, (_, labels)) in enumerate(zip(rows, pages, strict=True)):
        for t, features in enumerate(page):
            x[i, t, features] = 1
        y[i, : len(labels)] = labels
    real = np.arange(longest)[None, :] < size[:, None]
    last = size - 1
    w = np.zeros(k + 8)
    m, v = np.zeros_like(w), np.zeros_like(w)
    pages_at = np.arange(n)
    for step in range(1, steps + 1):
        moves, ends = w[k : k + 4].reshape(2, 2), w[k + 4 :].reshape(2, 2)
        e = np.stack([np.zeros((n, longest)), x @ w[:k]], axis=2)
        alpha, beta = np.empty((n, longest, 2)), np.empty((n, longest, 2))
        alpha[:, 0] = ends[0] + e[:, 0]
        for t in range(1, longest):
            alpha[:, t] = np.logaddexp(alpha[:, t - 1, :1] + moves[0], alpha[:, t - 1, 1:] + moves[1]) + e[:, t]
        z = np.logaddexp.reduce(alpha[pages_at, last] + ends[1], axis=1)
        beta[:, -1] = ends[1]
        for t in range(longest - 2, -1, -1):
            inner = moves[None] + (e[:, t + 1] + beta[:, t + 1])[:, None, :]
            beta[:, t] = np.where((t >= last)[:, None], ends[1], np.logaddexp(inner[..., 0], inner[..., 1]))
        p = np.exp(alpha + beta - z[:, None, None]) * real[..., None]
        pair = np.exp(alpha[:, :-1, :, None] + moves + (e + beta)[:, 1:, None, :] - z[:, None, None, None]) * real[:, 1:, None, None]
        grad = np.zeros_like(w)
        grad[:k] = np.einsum("nt,ntk->k", (y - p[..., 1]) * real, x)
        seen = np.zeros((2, 2))
        np.add.at(seen, (y[:, :-1][real[:, 1:]], y[:, 1:][real[:, 1:]]), 1)
        grad[k : k + 4] = (seen - pair.sum(axis=(0, 1))).ravel()
        grad[k + 4 : k + 6] = np.bincount(y[:, 0], minlength=2) - p[:, 0].sum(axis=0)
        grad[k + 6 :] = np.bincount(y[pages_at, last], minlength=2) - p[pages_at, last].sum(axis=0)
        grad = grad / n - penalty * w
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        w = w + rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return Chain(list(names), w[:k], w[k : k + 4].reshape(2, 2), w[k + 4 :].reshape(2, 2))


#: Opening tags of what is not main text, by kind, for the labelled pages.
WRAPS = {
    "menu": ["<nav>", '<div class="nav">', '<ul class="menu">', '<div id="top-menu">', '<header class="site-header">', "<header>", '<div class="breadcrumb">', '<div class="pagination">'],
    "advert": ['<div class="ad">', '<div class="ads">', '<div class="advert">', '<div class="sponsored">', '<aside class="promo">', '<div id="ad-banner">', '<section class="advertisement">'],
    "side": ["<aside>", '<div class="sidebar">', '<div id="sidebar">', '<section class="related">', '<div class="widget">', '<div class="share">', '<div class="recommended">'],
    "notice": ['<div class="cookie-notice">', '<div class="notice">', '<div class="alert">', '<div class="consent-banner">', '<div id="popup">', '<div role="alert">'],
    "form": ["<form>", '<form class="search">', '<form id="login">', '<div class="newsletter"><form>'],
    "comments": ['<div class="comments">', '<section id="comments">', '<div class="comment">', '<ol class="comment-list">', '<div class="replies">'],
    "end": ["<footer>", '<div class="footer">', '<div id="footer">', '<footer class="site-footer">'],
}
MAINS = ["<article>", "<main>", '<div class="content">', '<div id="content">', '<div class="post">', '<article class="post">', "<main><article>", '<div class="entry-content">', '<section class="story">', "<section>", '<div id="main">', '<div class="article-body">', "<div>", ""]
LABEL = "main-block "


def _end(opening: str) -> str:
    return "".join(f"</{t}>" for t in reversed(re.findall(r"<(\w+)", opening)))


def labelled_page(r: random.Random) -> tuple[list[Block], list[int]]:
    """A page of a random layout with the label of every block. Words are invented, so that no feature
    leans on a language."""

    def words(low: int, high: int) -> str:
        return " ".join("".join(r.choice("bdfglmnprst") + r.choice("aeiou") for _ in range(r.randint(1, 4))) for _ in range(r.randint(low, high)))

    def sentence(low=4, high=30) -> str:
        t = words(low, high).capitalize()
        return t.replace(" ", ", ", r.randint(0, 2)) + r.choice("....?!")

    def prose() -> str:
        return " ".join(sentence() for _ in range(r.choice((1, 1, 2, 4, 8))))

    def link(t: str) -> str:
        return f'<a href="/x">{t}</a>'

    def other(kind: str) -> str:
        opening = r.choice(WRAPS[kind])
        if kind == "menu":
            items = "".join(r.choice(("<li>{}</li>", "<li>{}", "<span>{}</span> ")).format(link(words(1, 3))) for _ in range(r.randint(2, 7)))
            inner = f"<ul>{items}</ul>" if r.random() < 0.8 else items
        elif kind == "form":
            inner = f"<label>{words(1, 3)}</label><input name=q><button>{words(1, 2)}</button>"
        elif kind == "end":
            inner = r.choice((f"&copy; {words(1, 3)} &middot; {prose()}", f"<p>&copy; {words(1, 4)}</p>", f"<p>{link(words(1, 2))} | {link(words(1, 2))}</p><p>{sentence()}</p>"))
        else:
            inner = r.choice((sentence(), f"<p>{prose()}</p>", f"<h3>{words(1, 4)}</h3><p>{sentence()}</p><p>{prose()}</p>", f"<ul><li>{link(words(2, 6))}</li><li>{link(words(2, 6))}</li></ul>", f"<p>{link(words(1, 4))}</p>"))
        return opening + inner + _end(opening)

    def paragraph() -> str:
        t = r.choice((prose, prose, prose, prose, lambda: sentence(1, 3), lambda: words(1, 6), lambda: words(3, 40).replace(" ", " | "), lambda: f"{words(1, 4)} {link(words(1, 3))} {prose()}"))()
        shape = r.choice(("<p>{}</p>",) * 6 + ("<p><b>{}<br>", "<p>{}", "<h2>{}</h2>", "<blockquote>{}</blockquote>", "<ul><li>{}</li></ul>", "<pre>{}</pre>", "<div>{}</div>", "<table><tr><td>{}</td></tr></table>", "<figure><figcaption>{}</figcaption></figure>", "<p><em>{}</em></p>"))
        return shape.format(LABEL + t)

    opening = r.choice(MAINS)
    title = f"<h1>{LABEL}{words(1, 9)}</h1>" if r.random() < 0.85 else ""
    body = [paragraph() for _ in range(r.choice((0, 1, 2, 3, 5, 8, 13)))]
    if not title and not body:
        body = [paragraph()]
    if r.random() < 0.25:
        body.insert(r.randint(0, len(body)), other(r.choice(("advert", "side", "notice", "form"))))
    if r.random() < 0.15:
        body.append(other("comments"))
    before = [other(k) for k in ("menu", "notice", "advert", "side", "form") if r.random() < (0.8 if k == "menu" else 0.3)]
    after = [other(k) for k in ("advert", "side", "comments", "form", "end") if r.random() < (0.8 if k == "end" else 0.35)]
    page = blocks("<html><head><title>t</title></head><body>" + "".join(before) + opening + title + "".join(body) + _end(opening) + "".join(after) + "</body></html>")
    labels = [int(LABEL.strip() in b.text) for b in page]
    for b in page:
        b.text = b.text.replace(LABEL, "").replace(LABEL.strip(), "") or "x"
    return page, labels


def train(pages: int = PAGES, seed: int = 7) -> Chain:
    """A chain learned from ``pages`` labelled pages; equal arguments give equal weights."""
    r = random.Random(seed)
    made = [labelled_page(r) for _ in range(pages)]
    return fit([p for p in made if p[0]])


# --- tables -----------------------------------------------------------------------------------


def extract(pages: DataFrame, chain: Chain) -> DataFrame:
    """page_id, url, text, n_chars of every row of (page_id, url, html); null and empty pages, and pages
    without main text, have the empty text. Repeated rows are extracted each."""
    shared = pages.sparkSession.sparkContext.broadcast(chain)

    def run(batches):
        text_of = shared.value.text
        for b in slices(batches, 128):
            text = [text_of(h) for h in b.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), pa.array(text, pa.string()), pa.array([len(t) for t in text], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return pages.select("page_id", "url", "html").mapInArrow(run, "page_id bigint, url string, text string, n_chars bigint")
