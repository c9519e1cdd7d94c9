"""Main text of pages by a linear-chain conditional random field over leaf blocks.

A page is the sequence of its leaf blocks; each is article text or not. The field scores every block by features
of its ancestors (tags, parts of class and id names) and of its text (length, links, punctuation, fields), and
every pair of neighbours by their labels. It is trained in numpy by stochastic gradient ascent of the log
likelihood, with forward-backward marginals, on labelled pages of many invented layouts; there are ``TRAIN_PAGES`` of them,
whatever the table holds. Viterbi decoding gives the best labelling of a page, and the text is its article blocks joined by one space.

Pages are independent rows: the work is one Arrow function without a shuffle.

Results for odd input: null, empty and markup-free pages without text give the empty text; a page of bare text is
labelled like any other. Broken markup is closed as the next block starts; ``html_blocks`` says how. Long pages are
read whole, in time that grows with their length.
Copies give equal results. Empty tables give an empty result; other columns stay unread.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import bounded_batches
from textloom.llm.html_blocks import HIDDEN, Block, Element, Node, labelled_pages, leaf_blocks

TRAIN_PAGES = 1_500
EPOCHS = 8
RATE = 0.15
DECAY = 1e-4
SEED = 3
RIGHTS = re.compile(r"©|\(c\)|copyright|all rights", re.I)


def element_features(element: Element, above: str, where: str) -> list[str]:
    """Features of one element below ``above``, in the article or main part ``where`` it stands in."""
    out = [f"in={element.tag}", f"{where}:in={element.tag}", f"{above}>{element.tag}"]
    return out + [f"name={n}" for n in element.names] + [f"{where}:name={n}" for n in element.names]


def path_features(path: tuple[Element, ...]) -> tuple[str, ...]:
    """Features of the elements around a block, alone and together with where they stand."""
    out = [f"leaf={path[-1].tag if path else 'none'}"]
    above, where = "", "page"
    for element in path:
        out += element_features(element, above, where)
        above = element.tag
        if element.tag in ("article", "main"):
            where = element.tag
    out += [f"inner={n}" for n in (path[-1].names if path else ())]
    out.append(f"{where}:leaf={path[-1].tag if path else 'none'}")
    below = path[max((k for k, e in enumerate(path) if e.tag == where), default=-1) + 1 :]
    if not any(e.names for e in below):
        out.append(f"{where}:bare={'-'.join(dict.fromkeys(e.tag for e in below))}")
    return tuple(dict.fromkeys(out))


class PathScore:
    """Sums of the weights of ``path_features`` for the blocks of a page in order, each element entered and left once."""

    def __init__(self, weights: dict[str, float], known: dict) -> None:
        """``known`` keeps features and weights of elements from page to page."""
        self.get, self.known, self.met, self.total = weights.get, known, {}, 0.0
        #: Of each element entered: its node and features, the sum before, and what follows for the elements inside.
        self.entered: list[tuple] = []

    def at(self, node: Node) -> float:
        way = []
        while node.parent and not (len(self.entered) >= node.depth and self.entered[node.depth - 1][0] is node):
            way.append(node)
            node = node.parent
        while len(self.entered) > node.depth:
            _, features, self.total, *_ = self.entered.pop()
            for f, _ in features:
                self.met[f] -= 1
        for node in reversed(way):
            self._enter(node)
        _, _, _, above, where, named, bare, leaf = self.entered[-1] if self.entered else NOWHERE
        score = self.total + self.get(f"leaf={above or 'none'}", 0.0) + self.get(f"{where}:leaf={above or 'none'}", 0.0)
        score += sum(self.get(f"inner={n}", 0.0) for n in leaf)
        return score if named else score + self.get(f"{where}:bare={'-'.join(bare)}", 0.0)

    def _enter(self, node: Node) -> None:
        above, where, named, bare, _ = self.entered[-1][3:] if self.entered else NOWHERE[3:]
        element, before = node.element, self.total
        if element.tag in HIDDEN:  # not closed, so it is nothing
            self.entered.append((node, (), before, above, where, named, bare, self.entered[-1][7] if self.entered else ()))
            return
        features = self.known.get((element, above, where))
        if features is None:
            if len(self.known) > 50_000:
                self.known.clear()
            features = tuple((f, self.get(f, 0.0)) for f in element_features(element, above, where))
            self.known[element, above, where] = features
        for f, weight in features:
            n = self.met.get(f, 0)
            if not n:
                self.total += weight
            self.met[f] = n + 1
        if element.tag in ("article", "main"):
            where, named, bare = element.tag, False, ()
        else:
            named = named or bool(element.names)
            bare = bare if named or element.tag in bare else (*bare, element.tag)
        self.entered.append((node, features, before, element.tag, where, named, bare, element.names))


NOWHERE = (None, (), 0.0, "", "page", False, (), ())


def text_features(block: Block) -> list[str]:
    """Features of a block's own text."""
    text, n = block.text, len(block.text)
    linked = min(1.0, block.link_chars / n)
    out = [
        f"size={min(int(math.log2(n)), 11)}",
        f"links={int(linked * 4)}",
        f"ends={text[-1] if text[-1] in '.!?:,;' else 'other'}",
        f"stops={min(text.count('. ') + text.count('! ') + text.count('? '), 4)}",
    ]
    if block.fields:
        out.append("fields")
    if RIGHTS.search(text):
        out.append("rights")
    if "|" in text or "·" in text:
        out.append("bars")
    return out


@dataclass
class BlockField:
    """``weights`` of features for "article", ``step[a, b]`` of neighbours, ``start`` and ``end`` of labels."""

    weights: dict[str, float]
    step: np.ndarray
    start: np.ndarray
    end: np.ndarray

    def extract(self, html: str, known: dict | None = None) -> str:
        blocks = leaf_blocks(html)
        if not blocks:
            return ""
        around, get = PathScore(self.weights, {} if known is None else known), self.weights.get
        scores = [around.at(b.path) + sum(get(f, 0.0) for f in text_features(b)) for b in blocks]
        return " ".join(b.text for b, label in zip(blocks, self.viterbi(scores)) if label)

    def viterbi(self, scores: list[float]) -> list[int]:
        """Best labels for the scores of "article" of a page's blocks."""
        (aa, ab), (ba, bb) = self.step.tolist()
        x, y = self.start.tolist()
        y += scores[0]
        back = []
        for s in scores[1:]:
            from_x, to_x = (0, x + aa) if x + aa >= y + ba else (1, y + ba)
            from_y, to_y = (0, x + ab) if x + ab >= y + bb else (1, y + bb)
            back.append((from_x, from_y))
            x, y = to_x, to_y + s
        label = int(y + self.end[1] > x + self.end[0])
        out = [label]
        for choice in reversed(back):
            label = choice[label]
            out.append(label)
        return out[::-1]


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


def marginals(scores: np.ndarray, step: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Probabilities of labels of each block and of label pairs of neighbours, by forward-backward."""
    n = len(scores)
    unary = np.zeros((n, 2))
    unary[:, 1] = scores
    ahead, behind = np.zeros((n, 2)), np.zeros((n, 2))
    ahead[0], behind[-1] = start + unary[0], end
    for k in range(1, n):
        ahead[k] = unary[k] + _log_sum(ahead[k - 1][:, None] + step, 0)
    for k in range(n - 2, -1, -1):
        behind[k] = _log_sum(step + unary[k + 1] + behind[k + 1], 1)
    total = _log_sum(ahead[-1] + end, 0)
    pairs = np.exp(ahead[:-1, :, None] + step + (unary[1:] + behind[1:])[:, None, :] - total)
    return np.exp(ahead + behind - total), pairs


def train(pages: list[list[Block]], epochs: int = EPOCHS, seed: int = SEED) -> BlockField:
    """Stochastic gradient ascent with per-feature step sizes; one page is one step."""
    number: dict[str, int] = {}
    data = []
    for page in pages:
        rows, columns = [], []
        for k, block in enumerate(page):
            for f in (*path_features(block.path), *text_features(block)):
                rows.append(k)
                columns.append(number.setdefault(f, len(number)))
        data.append((np.array(rows), np.array(columns), np.array([b.gold for b in page])))
    w, seen = np.zeros(len(number)), np.full(len(number), 1e-8)
    edge, edge_seen = np.zeros((4, 2)), np.full((4, 2), 1e-8)  # step, start, end
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        for p in rng.permutation(len(data)):
            rows, columns, gold = data[p]
            scores = np.bincount(rows, w[columns], minlength=len(gold))
            single, pairs = marginals(scores, edge[:2], edge[2], edge[3])
            wrong = gold - single[:, 1]
            g = np.bincount(columns, wrong[rows], minlength=len(w)) - DECAY * w
            seen += g * g
            w += RATE * g / np.sqrt(seen)
            h = np.zeros((4, 2))
            np.add.at(h, (gold[:-1], gold[1:]), 1)
            h[:2] -= pairs.sum(axis=0)
            for row, at in ((2, 0), (3, -1)):
                h[row, gold[at]] += 1
                h[row] -= single[at]
            edge_seen += h * h
            edge += RATE * h / np.sqrt(edge_seen)
    return BlockField({f: float(w[k]) for f, k in number.items()}, edge[:2], edge[2], edge[3])


def trained_field(pages: int = TRAIN_PAGES) -> BlockField:
    return train(labelled_pages(pages))


def main_text(html: Column, field: BlockField) -> Column:
    """Main text of each page; never null."""

    @F.arrow_udf("string")
    def extract(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known: dict = {}
        for pages in batches:
            yield pa.array([field.extract(p.as_py() or "", known) for p in pages], pa.string())

    return F.coalesce(extract(html), F.lit(""))


def extract_main(
    pages: DataFrame, html: str = "html", page_id: str = "page_id", url: str = "url", field: BlockField | None = None
) -> DataFrame:
    """``(page_id, url, text, n_chars)``, one row per row of the table."""
    text = main_text(F.col(html), field or trained_field())
    rows = bounded_batches(pages).select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), text.alias("text"))
    return rows.withColumn("n_chars", F.char_length("text").cast("long"))
