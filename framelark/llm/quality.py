"""Quality classifier: histogram gradient-boosted trees over statistics of a document."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framelark.llm.decontaminate import mixed
from framelark.llm.labelled import fold, training_sample

#: Labelled rows that the trees are fitted on, at most.
SAMPLE = 20_000
FOLDS, HELD_OUT, THRESHOLD = 5, 0, 0.3
TREES, DEPTH, BINS, RATE, L2, LEAF = 80, 4, 64, 0.15, 1.0, 10
#: Bytes of a text whose statistics are taken at once.
PIECE = 1 << 20

_KINDS = ["space", "line", "upper", "lower", "digit", "stop", "comma", "bang", "pipe", "bracket", "sign", "beyond"]


def _kinds() -> np.ndarray:
    out = np.full(256, _KINDS.index("sign"), np.uint8)
    groups = {"space": b" \t\r\v\f", "line": b"\n", "stop": b".", "comma": b",;:'\"-", "bang": b"!?", "pipe": b"|", "bracket": b"()[]{}<>/\\="}
    for name, chars in groups.items():
        out[list(chars)] = _KINDS.index(name)
    for name, low, high in (("upper", 65, 90), ("lower", 97, 122), ("digit", 48, 57), ("beyond", 128, 255)):
        out[low : high + 1] = _KINDS.index(name)
    return out


_KIND_OF = _kinds()
FEATURES = [
    *(f"share_{k}" for k in _KINDS), "log_words", "word_length", "long_words", "distinct_words", "same_as_before", "repeated_pairs",
    "sign_ends", "bang_ends", "upper_words", "capitals", "log_lines", "line_words", "distinct_lines", "short_lines", "top_word",
]


def _spans(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edges = np.diff(np.concatenate([[0], inside.view(np.int8), [0]]))
    return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)


_VALUE_OF = mixed(np.arange(1, 257, dtype=np.uint64))


@dataclass
class Runs:
    """Words or lines: for each the sum of its bytes' values, the sum of those times their places in it, its length, its bytes
    that are upper and lower case, and the kinds of its first and last byte."""

    total: np.ndarray
    moment: np.ndarray
    length: np.ndarray
    upper: np.ndarray
    lower: np.ndarray
    first: np.ndarray
    last: np.ndarray

    def columns(self) -> list[np.ndarray]:
        return [self.total, self.moment, self.length, self.upper, self.lower, self.first, self.last]

    def part(self, rows: slice) -> Runs:
        return Runs(*[c[rows] for c in self.columns()])

    def after(self, begun: Runs | None, joined: bool) -> Runs:
        """Behind the run `begun` before; joined: the first run goes on with it."""
        if begun is None:
            return self
        if not joined:
            return Runs(*[np.concatenate([a, b]) for a, b in zip(begun.columns(), self.columns(), strict=True)])
        self.moment[:1] += begun.moment + self.total[:1] * begun.length.astype(np.uint64)
        for mine, its in zip((self.total, self.length, self.upper, self.lower), (begun.total, begun.length, begun.upper, begun.lower), strict=True):
            mine[:1] += its
        self.first[:1] = begun.first
        return self

    def hashes(self) -> np.ndarray:
        """Equal runs have equal hashes; others rarely do."""
        return mixed(self.total ^ mixed(self.moment))


class _Piece:
    """Running sums over the bytes of a piece, from which any run's are differences."""

    def __init__(self, data: np.ndarray):
        self.kind = _KIND_OF[data]
        self.sums, self.moments = np.zeros(len(data) + 1, np.uint64), np.zeros(len(data) + 1, np.uint64)
        value = _VALUE_OF[data]
        np.cumsum(value, out=self.sums[1:])
        np.cumsum(value * np.arange(len(data), dtype=np.uint64), out=self.moments[1:])
        self.ups, self.lows = (np.concatenate([[0], np.cumsum(self.kind == k)]) for k in (2, 3))

    def runs(self, inside: np.ndarray) -> Runs:
        a, b = _spans(inside)
        total = self.sums[b] - self.sums[a]
        moment = self.moments[b] - self.moments[a] - total * a.astype(np.uint64)
        return Runs(total, moment, b - a, self.ups[b] - self.ups[a], self.lows[b] - self.lows[a], self.kind[a], self.kind[b - 1])


class _Reader:
    """Words and lines of a text that comes in pieces, cut anywhere: a run that reaches a piece's end goes on in the next."""

    def __init__(self) -> None:
        self.word: Runs | None = None
        self.line: Runs | None = None
        self.before = np.zeros(0, np.uint64)  # the last word's hash
        self.sums = np.zeros(10)
        self.seen: list[list[np.ndarray]] = [[], [], []]

    @staticmethod
    def _cut(found: Runs, begun: Runs | None, inside: np.ndarray, last: bool) -> tuple[Runs, Runs | None]:
        """Runs that have ended, and the one that may go on."""
        found = found.after(begun, begun is not None and len(inside) > 0 and bool(inside[0]))
        if last or not len(inside) or not inside[-1]:
            return found, None
        return found.part(slice(0, -1)), found.part(slice(-1, None))

    def read(self, data: np.ndarray, last: bool) -> None:
        piece = _Piece(data)
        in_word, in_line = piece.kind > 1, piece.kind != 1
        words, self.word = self._cut(piece.runs(in_word), self.word, in_word, last)
        lines, self.line = self._cut(piece.runs(in_line), self.line, in_line, last)
        hashes = np.concatenate([self.before, words.hashes()])
        self.before = hashes[-1:]
        pairs = mixed(hashes[:-1] * np.uint64(3) + hashes[1:])
        n = words.length
        self.sums += [
            len(n), n.sum(), (n > 15).sum(), (hashes[1:] == hashes[:-1]).sum(), np.isin(words.last, [8, 9, 10]).sum(), (words.last == 7).sum(),
            ((words.upper > 1) & (words.lower == 0)).sum(), ((words.first == 2) & (words.lower > 0)).sum(), len(lines.length), (lines.length < 20).sum(),
        ]
        for own, new in zip(self.seen, (hashes[len(hashes) - len(n) :], pairs, lines.hashes()), strict=True):
            own.append(new)


def statistics(text: str) -> np.ndarray:
    """FEATURES of a whole text; zeros without any. They don't depend on PIECE."""
    raw = np.frombuffer(text.encode(), np.uint8)
    if not len(raw):
        return np.zeros(len(FEATURES), np.float32)
    reader, kinds = _Reader(), np.zeros(len(_KINDS))
    for a in range(0, len(raw), PIECE):
        data = raw[a : a + PIECE]
        kinds += np.bincount(_KIND_OF[data], minlength=len(_KINDS))
        reader.read(data, a + PIECE >= len(raw))
    words, pairs, lines = map(np.concatenate, reader.seen)
    n, chars, long, same, signs, bangs, upper, capital, n_lines, short = reader.sums
    times = np.unique(words, return_counts=True)[1]
    w, li = max(n, 1), max(n_lines, 1)
    ratio = lambda x: len(np.unique(x)) / max(len(x), 1)
    rest = [np.log1p(n), chars / w, long / w, len(times) / w, same / w, 1 - ratio(pairs), signs / w, bangs / w, upper / w, capital / w,
            np.log1p(n_lines), n / li, ratio(lines), short / li, times.max(initial=0) / w]
    return np.concatenate([kinds / len(raw), rest]).astype(np.float32)


@dataclass(frozen=True)
class Trees:
    """All trees as full binary ones: row t holds tree t's nodes, children of i at 2i + 1 and 2i + 2, and its leaves."""

    base: float
    feature: np.ndarray
    threshold: np.ndarray
    leaf: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probabilities. All rows and trees step down together, one level at a time."""
        depth = int(np.log2(self.leaf.shape[1]))
        tree, row = np.arange(len(self.leaf))[None, :], np.arange(len(x))[:, None]
        node = np.zeros((len(x), len(self.leaf)), np.int64)
        for _ in range(depth):
            node = 2 * node + 1 + (x[row, self.feature[tree, node]] > self.threshold[tree, node])
        margin = self.base + self.leaf[tree, node - self.feature.shape[1]].sum(1)
        return 1 / (1 + np.exp(-np.clip(margin, -30, 30)))


def fit_trees(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH) -> Trees:
    """Second-order boosting of the logistic loss; splits are sought in histograms of at most BINS quantile bins.

    Without rows, or with one label only, the score is the share of label 1 (a half without rows), kept off 0 and 1."""
    n_nodes, n_features = (1 << depth) - 1, x.shape[1]
    share = (y.sum() + 1) / (len(y) + 2)
    base = float(np.log(share / (1 - share)))
    feature, threshold = np.zeros((trees, n_nodes), np.int64), np.full((trees, n_nodes), np.inf)
    leaf = np.zeros((trees, 1 << depth))
    if not len(y) or y.min() == y.max():
        return Trees(base, feature[:1], threshold[:1], leaf[:1])
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])).astype(np.float32) for j in range(n_features)]
    binned = np.stack([np.searchsorted(c, x[:, j], "left") for j, c in enumerate(cuts)], axis=1)
    slot = binned + np.arange(n_features) * BINS
    margin = np.full(len(y), base)
    for t in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, p * (1 - p)
        node = np.zeros(len(y), np.int64)
        for level in range(depth):
            width, first = 1 << level, (1 << level) - 1
            at = ((node - first)[:, None] * (n_features * BINS) + slot).ravel()
            gs, hs, ns = (np.bincount(at, np.repeat(v, n_features), width * n_features * BINS).reshape(width, n_features, BINS).cumsum(2) for v in (g, h, np.ones(len(y))))
            total = [v[:, :1, -1:] for v in (gs, hs, ns)]
            gain = gs**2 / (hs + L2) + (total[0] - gs) ** 2 / (total[1] - hs + L2) - total[0] ** 2 / (total[1] + L2)
            gain[(ns < LEAF) | (total[2] - ns < LEAF)] = 0
            best = gain.reshape(width, -1).argmax(1)
            for i, b in enumerate(best.tolist()):
                j, k = divmod(b, BINS)
                if gain[i, j, k] > 1e-6 and k < len(cuts[j]):
                    feature[t, first + i], threshold[t, first + i] = j, cuts[j][k]
            node = 2 * node + 1 + (x[np.arange(len(y)), feature[t, node]] > threshold[t, node])
        at = node - n_nodes
        leaf[t] = -RATE * np.bincount(at, g, 1 << depth) / (np.bincount(at, h, 1 << depth) + L2)
        margin += leaf[t][at]
    return Trees(base, feature, threshold, leaf)


def _with_statistics(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield pd.DataFrame({"doc_id": batch["doc_id"], "y": batch["y"], "x": [statistics(t) for t in batch["text"]]})


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Trees:
    """Fits on at most `sample` labelled rows outside the held-out fold; their statistics, of bounded size, come to the driver."""
    rows = training_sample(docs, labels, "quality", fold(F.col("doc_id"), FOLDS) != HELD_OUT, sample)
    id_type = dict(rows.dtypes)["doc_id"]
    got = rows.mapInPandas(_with_statistics, f"doc_id {id_type}, y int, x array<float>").toPandas().sort_values(["doc_id", "y"], kind="stable")
    x = np.array(got["x"].tolist(), np.float32).reshape(len(got), len(FEATURES))
    return fit_trees(x, got["y"].to_numpy(float))


def with_score(docs: DataFrame, labels: DataFrame, name: str, sample: int = SAMPLE) -> DataFrame:
    """docs with the score of each text in column name."""
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels, sample))  # a few thousand numbers

    @F.pandas_udf("double")
    def score_of(text: pd.Series) -> pd.Series:
        if not len(text):
            return pd.Series([], dtype=float)
        return pd.Series(model.value.score(np.stack([statistics(t or "") for t in text])))

    return docs.withColumn(name, score_of(F.col("text")))


def quality(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """One row for each row of docs: doc_id, held_out, score (0 to 1, higher: better), predicted.

    A score depends on the text only. Null and empty texts have statistics of zero and are scored like any text. Labels of
    unknown documents, nulls and labels other than 0 and 1 are ignored; without usable labels all scores are equal.
    Rows that repeat an id each get a row; null ids are in fold 0. No rows give no rows. Other columns are ignored."""
    out = with_score(docs.select("doc_id", "text"), labels, "score", sample)
    return out.select("doc_id", (fold(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
