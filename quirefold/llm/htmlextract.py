"""Main text of web pages by a linear-chain conditional random field over DOM leaf blocks.

A page is a sequence of leaf blocks; each is main text or not. A block's features are its ancestors' tags
and class, id and role names, and its text's length, links, ending and place. The model has a weight for
each feature and label and for each pair of neighbouring labels; it is trained by maximising the conditional
likelihood of labelled pages, and a page is decoded by Viterbi.

The labelled pages come from a bounded, hash-drawn sample of the table: those of LABELLED_PAGES different
pages of at most LABELLED_CHARS characters that mark their article, and as many as LABELLED_PAGES pages laid out anew from the sample's texts in the ways in which pages
mark article, menu, header, footer, sidebar, notice, advert, form and comments, or do not mark the article.
"""

from __future__ import annotations

import random
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .htmlblocks import Block, leaf_blocks
from .tables import table

LABELLED_PAGES = 250
#: characters of a page that labels may be learned from; longer pages are extracted like all others
LABELLED_CHARS = 200_000
#: blocks that a labelled page gives at most
TRAIN_BLOCKS = 120
RIDGE = 0.02
ROUNDS = 150
RATE = 0.15

ASIDE_TAGS = frozenset("nav aside footer form button label select textarea option head title menu dialog".split())
ASIDE_NAMES = frozenset(
    "ad ads advert advertisement sponsored promo banner cookie consent notice popup alert sidebar side widget menu nav "
    "navbar breadcrumb footer header masthead comment comments reply disqus newsletter subscribe share social related".split()
)


def path_features(path: tuple) -> list[str]:
    tags = [tag for tag, _ in path]
    found = {f"in:{tag}" for tag in tags} | {f"name:{name}" for _, names in path for name in names}
    return sorted(found | {f"leaf:{tags[-1] if tags else ''}"})


def bucket(n: int) -> int:
    return min(n.bit_length(), 12)


def text_features(block: Block, place: int, count: int) -> list[str]:
    text = block.text
    density = min(4, 5 * block.linked // max(len(text), 1))
    return [
        f"chars:{bucket(len(text))}",
        f"links:{density}",
        f"ends:{text[-1] if text[-1] in '.!?:;,' else 'x'}",
        f"words:{bucket(text.count(' ') + 1)}",
        f"place:{4 * place // count if count > 3 else 'few'}",
        "mark:copyright" if "©" in text else "mark:none",
    ]


class Crf:
    """Two labels; weights by feature name."""

    def __init__(self, emit: dict[str, float], step: np.ndarray, first: np.ndarray):
        # emit: of label 1 over label 0; step[a][b]: from label a to b
        self.emit, self.step, self.first = emit, step.tolist(), first.tolist()
        self.paths: dict[tuple, float] = {}

    def __getstate__(self) -> dict:
        return self.__dict__ | {"paths": {}}

    def evidence(self, block: Block, place: int, count: int) -> float:
        known = self.paths.get(block.path)
        if known is None:
            if len(self.paths) > 50_000:
                self.paths.clear()
            known = self.paths[block.path] = sum(self.emit.get(f, 0.0) for f in path_features(block.path))
        return known + sum(self.emit.get(f, 0.0) for f in text_features(block, place, count))

    def decode(self, blocks: list[Block]) -> list[int]:
        """The most probable labels (Viterbi)."""
        if not blocks:
            return []
        step, back = self.step, []
        best = [self.first[0], self.first[1]]
        for place, block in enumerate(blocks):
            if place:
                came = [0 if best[0] + step[0][y] >= best[1] + step[1][y] else 1 for y in (0, 1)]
                best = [best[came[0]] + step[came[0]][0], best[came[1]] + step[came[1]][1]]
                back.append(came)
            best[1] += self.evidence(block, place, len(blocks))
        label = 0 if best[0] >= best[1] else 1
        labels = [label]
        for came in reversed(back):
            label = came[label]
            labels.append(label)
        return labels[::-1]

    def main_text(self, html: str | None) -> str:
        blocks = leaf_blocks(html)
        return "\n".join(b.text for b, y in zip(blocks, self.decode(blocks), strict=True) if y)


def train(pages: list[tuple[list[Block], list[int]]], rounds: int = ROUNDS) -> Crf:
    """Weights of greatest penalised conditional likelihood, by gradient ascent with Adam."""
    pages = [(blocks, labels) for blocks, labels in pages if blocks]
    names: dict[str, int] = {}
    rows, cols = [], []
    n, longest = len(pages), max((len(b) for b, _ in pages), default=0)
    if not n:
        return Crf({}, np.zeros((2, 2)), np.zeros(2))
    for p, (blocks, _) in enumerate(pages):
        for k, block in enumerate(blocks):
            for f in [*path_features(block.path), *text_features(block, k, len(blocks))]:
                rows.append(p * longest + k)
                cols.append(names.setdefault(f, len(names)))
    x = np.zeros((n * longest, len(names)), np.float32)
    x[rows, cols] = 1
    y = np.zeros((n, longest), int)
    real = np.zeros((n, longest), bool)
    for p, (blocks, labels) in enumerate(pages):
        y[p, : len(blocks)], real[p, : len(blocks)] = labels, True
    last = real.sum(axis=1) - 1
    weights = [np.zeros(len(names)), np.zeros((2, 2)), np.zeros(2)]
    moments = [(np.zeros_like(w), np.zeros_like(w)) for w in weights]
    pair_real = real[:, 1:]
    seen_pairs = np.array([[((y[:, :-1] == a) & (y[:, 1:] == b) & pair_real).sum() for b in (0, 1)] for a in (0, 1)])
    seen_first = np.array([(y[:, 0] == a).sum() for a in (0, 1)])
    total = real.sum()

    def log_add(a: np.ndarray, axis: int) -> np.ndarray:
        top = a.max(axis=axis, keepdims=True)
        return (np.log(np.exp(a - top).sum(axis=axis, keepdims=True)) + top).squeeze(axis)

    for t in range(1, rounds + 1):
        emit, step, first = weights
        one = (x @ emit.astype(np.float32)).reshape(n, longest).astype(float)
        score = np.stack([np.zeros_like(one), one], axis=2)
        forward, backward = np.zeros((n, longest, 2)), np.zeros((n, longest, 2))
        forward[:, 0] = first + score[:, 0]
        for k in range(1, longest):
            moved = log_add(forward[:, k - 1, :, None] + step, 1) + score[:, k]
            forward[:, k] = np.where(real[:, k, None], moved, forward[:, k - 1])
        for k in range(longest - 2, -1, -1):
            moved = log_add(step + (score[:, k + 1] + backward[:, k + 1])[:, None, :], 2)
            backward[:, k] = np.where(real[:, k + 1, None], moved, 0)
        whole = log_add(forward[np.arange(n), last], 1)
        single = np.exp(forward + backward - whole[:, None, None]) * real[:, :, None]
        pairs = np.exp(
            forward[:, :-1, :, None] + step + (score[:, 1:] + backward[:, 1:])[:, :, None, :] - whole[:, None, None, None]
        ) * pair_real[:, :, None, None]
        slopes = [
            x.T @ ((y * real) - single[:, :, 1]).ravel().astype(np.float32) / total - RIDGE * emit / len(names),
            (seen_pairs - pairs.sum(axis=(0, 1))) / total - RIDGE * step / len(names),
            (seen_first - single[:, 0].sum(axis=0)) / total - RIDGE * first / len(names),
        ]
        for w, g, (m, v) in zip(weights, slopes, moments, strict=True):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            w += RATE * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    emit, step, first = weights
    return Crf({name: float(emit[k]) for name, k in names.items()}, step, first)


def labelled_by_markup(html: str) -> tuple[list[Block], list[int]] | None:
    """Labels of a page that marks its article, or None."""
    blocks = leaf_blocks(html)[:TRAIN_BLOCKS]

    def main(block: Block) -> int:
        tags = [tag for tag, _ in block.path]
        if "article" not in tags or ASIDE_TAGS.intersection(tags):
            return 0
        return int(not any(ASIDE_NAMES.intersection(names) for _, names in block.path))

    labels = [main(b) for b in blocks]
    return (blocks, labels) if any(labels) else None


# ways in which pages mark their parts: opening tag, inner tag
ARTICLE = ["<article>", '<article class="post">', "<main>", '<div class="content">', '<div id="main-content">',
           '<div class="post-body">', '<div class="entry-content">', '<section class="article-text">', '<div class="story">', "<div>"]
PARTS = {
    "menu": (["<nav>", '<ul class="menu">', '<div id="navbar">', '<div class="nav">', '<div class="breadcrumb">', "<ul>"], ["li", "a"]),
    "header": (["<header>", '<div class="header">', '<div class="masthead">', '<div id="header">'], ["h1", "p", "div"]),
    "footer": (["<footer>", '<div class="footer">', '<div id="footer">'], ["p", "div", ""]),
    "sidebar": (["<aside>", '<div class="sidebar">', '<div id="side">', '<div class="widget">', '<div class="related">'], ["li", "p", "h3"]),
    "notice": (['<div class="cookie-notice">', '<div class="notice">', '<div class="banner">', '<div class="popup">', '<div id="consent">', '<div role="alert">', '<div class="alert">', "<dialog>"], ["p", "", "button"]),
    "advert": (['<div class="ad">', '<div class="ads">', '<div class="advert">', '<div class="advertisement">', '<div class="sponsored">', '<aside class="promo">'], ["p", "", "a"]),
    "form": (["<form>", '<form class="newsletter">', '<form id="subscribe">', '<form class="search">'], ["label", "p", "button"]),
    "comments": (['<section class="comments">', '<div id="comments">', '<div class="comment-list">', '<ol class="comments">', '<div class="replies comment">', '<div id="disqus">'], ["p", "li", "div", "h2"]),
}


def layout(draw: random.Random, texts: list[str]) -> tuple[list[Block], list[int]]:
    """A page laid out from the texts, and its blocks' labels."""
    marker = "⁣"  # stands before main text, to read the labels off the parsed page
    inside, linked = [], {"menu", "sidebar", "footer"}

    def words(most: int) -> str:
        return draw.choice(texts)[:most].replace("<", "").replace("&", "")

    def part(kind: str) -> str:
        opening, inner = PARTS[kind]
        tag, child = draw.choice(opening), draw.choice(inner)
        most = 400 if kind == "comments" else draw.choice([15, 40, 90])
        items = []
        for _ in range(draw.randint(3, 8) if kind == "menu" else draw.randint(1, 4)):
            text = words(12 if kind == "menu" else most)
            text = f'<a href="/x">{text}</a>' if kind in linked and (kind == "menu" or draw.random() < 0.5) else text
            items.append(f"<{child}>{text}</{child}>" if child else text)
        return f"{tag}{('' if child else ' ').join(items)}</{tag[1:].split()[0].rstrip('>')}>"

    for k in range(draw.randint(1, 9)):
        if k == 0 and draw.random() < 0.7:
            inside.append(f"<h1>{marker}{words(60)}</h1>")
        tag = draw.choice(["p"] * 8 + ["h2", "blockquote", "li", "div"])
        inside.append(f"<{tag}>{marker}{words(draw.choice([40, 200, 900]))}</{tag}>")
        if draw.random() < 0.15:
            inside.append(part(draw.choice(["advert", "form", "notice", "sidebar"])))
    if draw.random() < 0.25:
        inside.append(part("comments"))
    tag = draw.choice(ARTICLE)
    article = f"{tag}{''.join(inside)}</{tag[1:].split()[0].rstrip('>')}>"
    before = [part(kind) for kind in ("notice", "header", "menu", "advert", "sidebar") if draw.random() < 0.55]
    after = [part(kind) for kind in ("sidebar", "advert", "comments", "form", "notice", "footer") if draw.random() < 0.5]
    if draw.random() < 0.15:
        before, after = [], []
    head = f"<head><title>{words(50)}</title></head>" if draw.random() < 0.6 else ""
    html = f"<html>{head}<body>{''.join(before)}{article}{''.join(after)}</body></html>"
    blocks = leaf_blocks(html)[:TRAIN_BLOCKS]
    labels = [int(b.text.startswith(marker)) for b in blocks]
    return [b._replace(text=b.text.lstrip(marker).strip() or "-") for b in blocks], labels


def drawn_pages(pages: DataFrame, most: int) -> list[str]:
    """The html of the ``most`` different pages of smallest hash, in that order.

    The hashes alone are ranked, a share of them drawn by value first, so that few rows of numbers reach the
    driver from each task; then those pages are fetched, none above LABELLED_CHARS. Equal pages count once.
    """
    hashed = pages.filter(F.char_length("html") <= LABELLED_CHARS).select("html", F.xxhash64("html").alias("h"))
    n = hashed.agg(F.approx_count_distinct("h", 0.02)).first()[0]
    # twice as many as wanted and some; a share that falls short all the same is followed by all
    share = min(1.0, (2 * most + 100) / max(n, 1))
    least = -(1 << 63)
    smallest: list[int] = []
    for upto in sorted({min((1 << 63) - 1, least + int(share * (1 << 64))), (1 << 63) - 1}):
        few = hashed.filter(F.col("h") <= upto).select("h").distinct().orderBy("h").limit(most)
        smallest = [row.h for row in few.collect()]
        if len(smallest) == most:
            break
    if not smallest:
        return []
    fetched = hashed.filter(F.col("h").isin(smallest)).groupBy("h").agg(F.min("html").alias("html"))
    return [row.html for row in sorted(fetched.collect())]


def fit(pages: DataFrame, most: int = LABELLED_PAGES) -> Crf:
    """A model from at most so many pages of the table, and as many laid out from their texts."""
    marked = [m for m in map(labelled_by_markup, drawn_pages(pages, most)) if m]
    texts = [b.text for blocks, _ in marked for b in blocks if len(b.text) > 20] or ["text " * 20]
    draw = random.Random(20)
    return train(marked + [layout(draw, texts) for _ in range(most)])


def extract(pages: DataFrame, model: Crf) -> DataFrame:
    """``page_id, url, text, n_chars`` of each row; an empty text where nothing is main. Null html: empty."""
    shared = pages.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: Crf = shared.value
        for batch in batches:
            texts = [own.main_text(html.as_py()) for html in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    return pages.select("page_id", "url", "html").mapInArrow(run, "page_id bigint, url string, text string, n_chars bigint")


def op10_crf_extraction(spark, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return extract(pages, fit(pages))
