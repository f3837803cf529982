"""Main text of web pages: a linear-chain conditional random field over the leaf blocks of the page's tree."""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framelark.llm.html_blocks import Block, Node, blocks
from framelark.llm.html_pages import labelled_page

_MARK = re.compile("[©|»›]")
#: The parts of words features, as constants, so that none is formatted for each block.
_COUNTS = [f"#words{i}" for i in range(7)]
_LINKED = [f"#linked{i}" for i in range(3)]
_BOX = [[f"#box{i}.{j}" for j in range(3)] for i in range(7)]
_SHARE = {place: [f"#{place}.share{i}" for i in range(5)] for place in ("in", "small", "out", "none")}
_TITLE = ("#untitled", "#above", "#below")
_LINKS, _AGAIN = [f"#links{i}" for i in range(4)], {place: [f"#{place}.again{i}" for i in range(3)] for place in ("in", "small", "out", "none")}
#: Dates in digits, years, and times since.
_DATE = re.compile(r"(?<![\d.])\d{1,4}[./-]\d{1,2}[./-]\d{1,4}(?![.\d])|\b(?:19|20)\d\d\b|\b\d+ (?:min|hour|day|week|month|year|stunde|tag|woche|monat|jahr|heure|jour|semaine|mois|hora|d[ií]a|semana|mes)", re.IGNORECASE)
#: Elements of which pages make boxes that recur.
_BOXES = frozenset("div article section li".split())


def recurring(page: list[Block]) -> list[int]:
    """For each block how many boxes beside its own hold blocks of the same elements, as comments and teasers do: boxes of one
    parent, with two blocks at least."""
    boxes: dict[int, tuple[Node, list[str]]] = {}
    for b in page:
        up = b.node.parent
        if up is not None and up.tag in _BOXES:
            boxes.setdefault(id(up), (up, []))[1].append(b.node.tag)
    shape = {k: (id(up.parent), tuple(tags)) for k, (up, tags) in boxes.items() if len(tags) > 1}
    counts = Counter(shape.values())
    return [counts[shape[k]] - 1 if (k := id(b.node.parent)) in shape else 0 for b in page]


def text_features(page: list[Block]) -> list[list[str]]:
    """For each block: features of its text, of the box it is in (its element's parent: words, links, share of the page's text
    beyond links), whether the page has an article or main element and the block is inside, in a large or a small one, where its first h1 is, how many links
    it has, and whether its box recurs."""
    n_words = [b.text.count(" ") + 1 for b in page]
    boxes: dict[int, list[float]] = {}
    total = 1e-9
    for b, n in zip(page, n_words, strict=True):
        box = boxes.setdefault(id(b.node.parent or b.node), [0, 0.0])
        box[0] += n
        box[1] += n * b.linked
        total += n * (1 - b.linked)
    homes: dict[int, int] = {}
    for b, n in zip(page, n_words, strict=True):
        if b.node.home is not None:
            homes[id(b.node.home)] = homes.get(id(b.node.home), 0) + n
    largest = max(homes.values(), default=0)
    title = next((i for i, b in enumerate(page) if b.node.tag == "h1"), len(page))
    out = []
    again = recurring(page)
    for i, (b, n) in enumerate(zip(page, n_words, strict=True)):
        words, linked = boxes[id(b.node.parent or b.node)]
        share = (words - linked) / total
        place = ("in" if 2 * homes[id(b.node.home)] >= largest else "small") if b.node.home is not None else "out" if largest else "none"
        found = [
            _COUNTS[min(6, n.bit_length() - 1)], _LINKED[int(2 * b.linked + 0.5)], "#end" if b.text[-1] in ".!?…:;”\"'" else "#open",
            _BOX[min(6, int(words).bit_length() - 1)][int(2 * linked / words + 0.5)], _SHARE[place][0 if share < 0.05 else 1 if share < 0.2 else 2 if share < 0.5 else 3 if share < 0.95 else 4],
            _TITLE[0] if title == len(page) else _TITLE[2 if i >= title else 1], _LINKS[min(3, b.links)], _AGAIN[place][min(2, again[i])],
        ]
        if "," in b.text:
            found.append("#comma")
        if _MARK.search(b.text):
            found.append("#mark")
        if n < 12 and _DATE.search(b.text):
            found.append("#date")
        out.append(found)
    return out


def node_features(node: Node) -> list[str]:
    """Every word of the node and its ancestors, those of the nearest that has any once more, and the node's tag."""
    found, up = [f"@{w}" for w in node.near] + [f"^{node.tag}"], node
    while up is not None:
        found += up.fresh
        up = up.parent
    return found


@dataclass(frozen=True)
class Field:
    """Weights of features for content against other, and of label changes: move[a, b] from label a to b, start[b]."""

    weight: dict[str, float]
    start: np.ndarray
    move: np.ndarray

    def node_score(self, node: Node) -> float:
        """The sum of node_features' weights. Nodes keep what their ancestors bring, so each is added up once."""
        w, path = self.weight.get, []
        up: Node | None = node
        while up is not None and up.score is None:
            path.append(up)
            up = up.parent
        total = up.score if up is not None else 0.0
        for one in reversed(path):
            for word in one.fresh:
                total += w(word, 0.0)
            one.score = total
        return node.score + sum(w(f"@{x}", 0.0) for x in node.near) + w(f"^{node.tag}", 0.0)

    def decode(self, page: list[Block]) -> list[bool]:
        """The likeliest labels (Viterbi)."""
        if not page:
            return []
        w, back = self.weight.get, []
        (s0, s1), ((m00, m01), (m10, m11)) = self.start.tolist(), self.move.tolist()
        before, of_node = None, 0.0
        for i, (block, found) in enumerate(zip(page, text_features(page), strict=True)):
            if block.node is not before:
                before, of_node = block.node, self.node_score(block.node)
            score = of_node
            for f in found:
                score += w(f, 0.0)
            if i == 0:
                a, b = s0, s1 + score
            else:
                from0, from1 = b + m10 > a + m00, b + m11 > a + m01
                a, b = (b + m10 if from0 else a + m00), (b + m11 if from1 else a + m01) + score
                back.append((from0, from1))
        label = b > a
        labels = [label]
        for from0, from1 in reversed(back):
            label = from1 if label else from0
            labels.append(label)
        return labels[::-1]


def all_features(page: list[Block]) -> list[list[str]]:
    return [node_features(b.node) + found for b, found in zip(page, text_features(page), strict=True)]


def fit(pages: list[tuple[list[Block], list[bool]]], steps: int = 110, l2: float = 0.02, rate: float = 0.2) -> Field:
    """Maximises the labels' log-likelihood less L2 by Adam steps; forward and backward sums run over all pages at once."""
    rows = [found for page, _ in pages for found in all_features(page)]
    names = sorted({f for row in rows for f in row})
    index = {f: i for i, f in enumerate(names)}
    col = np.array([index[f] for row in rows for f in row])
    at = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    sizes = np.array([len(p) for p, _ in pages])
    n, t = len(pages), int(sizes.max())
    mask = np.arange(t)[None, :] < sizes[:, None]
    y = np.zeros((n, t), int)
    y[mask] = np.concatenate([np.array(labels, int) for _, labels in pages])
    theta = np.zeros(len(names) + 6)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    observed_move = np.zeros((2, 2))
    both = mask[:, 1:]
    np.add.at(observed_move, (y[:, :-1][both], y[:, 1:][both]), 1)
    observed_start = np.bincount(y[:, 0], minlength=2)
    for step in range(1, steps + 1):
        w, start, move = theta[: len(names)], theta[-6:-4], theta[-4:].reshape(2, 2)
        e = np.zeros((n, t, 2))
        e[..., 1][mask] = np.bincount(at, w[col], len(rows))
        fwd, bwd = np.zeros((n, t, 2)), np.zeros((n, t, 2))
        fwd[:, 0] = start + e[:, 0]
        for i in range(1, t):
            step_on = np.logaddexp.reduce(fwd[:, i - 1, :, None] + move[None], axis=1) + e[:, i]
            fwd[:, i] = np.where(mask[:, i, None], step_on, fwd[:, i - 1])
        for i in range(t - 2, -1, -1):
            step_on = np.logaddexp.reduce(move[None] + (e[:, i + 1] + bwd[:, i + 1])[:, None, :], axis=2)
            bwd[:, i] = np.where(mask[:, i + 1, None], step_on, 0.0)
        z = np.logaddexp.reduce(fwd[:, -1], axis=1)
        p = np.exp(fwd + bwd - z[:, None, None])
        pair = np.exp(fwd[:, :-1, :, None] + move + (e + bwd)[:, 1:, None, :] - z[:, None, None, None])[both].sum(0)
        grad = np.concatenate([np.bincount(col, (y - p[..., 1])[mask][at], len(names)), observed_start - p[:, 0].sum(0), (observed_move - pair).ravel()])
        grad = grad / n - l2 * theta / 10
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        theta = theta + rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return Field(dict(zip(names, theta[: len(names)].tolist(), strict=True)), theta[-6:-4], theta[-4:].reshape(2, 2))


@lru_cache(4)
def trained(seed: int = 1, pages: int = 1900) -> Field:
    """Fits on made-up labelled pages; each must fall into as many blocks as it has labels."""
    rng, rows = np.random.default_rng(seed), []
    for _ in range(pages):
        page, labels = labelled_page(rng)
        found = blocks(page)
        if len(found) != len(labels):
            raise ValueError("a training page has another number of blocks than labels")
        rows.append((found, labels))
    return fit(rows)


def main_text(page: str, model: Field) -> str:
    found = blocks(page)
    return "\n".join(b.text for b, content in zip(found, model.decode(found), strict=True) if content)


def extract(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """One row for each row of pages: page_id, url, text, n_chars (code points of text).

    Text is that of the blocks labelled content, in page order, one a line, with character references decoded and white
    space as one space. Null and empty pages, and such without content, give the empty text. Null and repeated page_id
    and url are returned as they are. No rows give no rows. Other columns are ignored."""
    model = pages.sparkSession.sparkContext.broadcast(trained())  # some hundred numbers

    @F.pandas_udf("string")
    def text_of(page: pd.Series) -> pd.Series:
        return pd.Series([main_text(p, model.value) if p else "" for p in page], dtype=object)

    out = pages.select("page_id", "url", text_of(F.col(html_col)).alias("text"))
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
