"""Toxicity: a linear classifier over parts of words, regularised by counterfactual swaps of identity terms."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framelark.llm.common import checkpointed
from framelark.llm.decontaminate import mixed
from framelark.llm.labelled import fold, training_sample

#: Labelled rows that the classifier is fitted on, at most.
SAMPLE = 16_000
FOLDS, HELD_OUT, THRESHOLD = 3, 1, 0.7
#: Bytes of a part of a word, how often it has to stand in a text (each number is a feature), and hash buckets for all.
PARTS, TIMES, BUCKETS = (5, 6), (1, 2, 4, 8), 1 << 22
#: Buckets that the classifier weighs, at most; labelled documents that must hold one; and its least log likelihood ratio.
FEATURES, LEAST_DOCS, LEAST_RATIO = 2048, 3, 10.0
#: Weights of the penalties on score changes under swaps and mentions, for each identity term, and on large weights.
SWAP_PENALTY, L2 = 4.0, 1e-5
#: Parts of the training rows, each of which a model fitted on the others scores, to find the cut.
PARTITIONS = 3
PIECE = 1 << 20

#: Neutral words for groups of people. A swap replaces each by the next of its row.
IDENTITY_TERMS = [
    "muslims christians jews hindus buddhists atheists catholics",
    "muslim christian jewish hindu buddhist atheist catholic",
    "women men girls boys", "woman man girl boy",
    "gay straight lesbian bisexual", "transgender cisgender",
    "black white asian latino arab african european",
    "immigrants citizens refugees migrants", "immigrant citizen refugee migrant",
    "deaf blind disabled", "old young elderly",
    "frauen männer", "frau mann", "muslime christen juden", "ausländer flüchtlinge deutsche", "schwule lesben",
    "femmes hommes", "femme homme", "musulmans chrétiens juifs", "immigrés réfugiés français", "gays lesbiennes",
    "mujeres hombres", "mujer hombre", "musulmanes cristianos judíos", "inmigrantes refugiados españoles", "gitanos payos",
]
_TERMS = [term.encode() for row in IDENTITY_TERMS for term in row.split()]
_NEXT = {a.encode(): b.encode() for row in map(str.split, IDENTITY_TERMS) for a, b in zip(row, row[1:] + row[:1], strict=True)}
_TERM = re.compile(rb"(?<= )(?:" + b"|".join(sorted(_NEXT, key=len, reverse=True)) + rb")(?= )")
#: Lower-cases A-Z; keeps letters, digits and all bytes beyond ASCII; all else becomes a space.
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or 48 <= b <= 57 or b >= 128 else 32 for b in range(256))


def cleaned(text: str) -> bytes:
    return b" " + text.encode().translate(_TABLE) + b" "


def swapped(clean: bytes) -> bytes:
    """clean with each identity term replaced by the next of its row."""
    return _TERM.sub(lambda m: _NEXT[m[0]], clean)


def mentioned(clean: bytes, draw: int) -> bytes:
    """clean with an identity term between two of its words, once or more; draw chooses term, place and how often."""
    term, draw = b" " + _TERMS[draw % len(_TERMS)], draw // len(_TERMS)
    times, draw = TIMES[draw % len(TIMES)], draw // len(TIMES)
    at = clean.find(b" ", draw % len(clean))
    at = len(clean) - 1 if at < 0 else at
    return clean[:at] + term * times + clean[at:]


def counterfactuals(clean: bytes, draw: int) -> list[tuple[bytes, bytes]]:
    """Texts whose scores should be equal: a text and its swap, if it mentions a group; the text and itself with a mention put
    in, which alone makes no text toxic; and that one and its swap."""
    other, put_in = swapped(clean), mentioned(clean, draw)
    pairs = [(clean, put_in), (put_in, swapped(put_in))]
    return pairs if other == clean else [(clean, other), *pairs]


def parts_of(clean: bytes) -> np.ndarray:
    """All parts of words, as numbers. A part may hold the space before or after its word, none inside."""
    out = []
    for at in range(0, len(clean), PIECE):
        data = np.frombuffer(clean[at : at + PIECE + max(PARTS) - 1], np.uint8)
        spaces = np.concatenate([[0], np.cumsum(data == 32)])
        wide = data.astype(np.uint64)
        packed, n = wide, 1
        for size in PARTS:
            while n < size and len(packed) > 1:
                packed, n = packed[:-1] << np.uint64(8) | wide[n:], n + 1
            if n == size:
                k = min(len(packed), PIECE)  # parts that start in this piece
                inner = spaces[size - 1 : size - 1 + k] - spaces[1 : 1 + k]
                out.append(packed[:k][inner == 0] * np.uint64(8) + np.uint64(size))
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def _hashed(parts: list[np.ndarray]) -> np.ndarray:
    """Distinct buckets; parts: those that stand in a text TIMES[0] times at least, TIMES[1] times, ..."""
    return np.unique(mixed(np.concatenate([p * np.uint64(16) + np.uint64(n) for p, n in zip(parts, TIMES, strict=True)])) >> np.uint64(64 - 22))


def buckets(clean: bytes) -> np.ndarray:
    """Distinct buckets of all parts of words, by how often they stand there at least."""
    parts, counts = np.unique(parts_of(clean), return_counts=True)
    return _hashed([parts[counts >= n] for n in TIMES])


def identity_buckets() -> np.ndarray:
    """Those of the parts of all identity terms that stand in a text at all; some hundred."""
    parts = np.unique(np.concatenate([parts_of(b" " + t + b" ") for t in _TERMS]))
    return _hashed([parts, *[parts[:0]] * (len(TIMES) - 1)])


class Classifier:
    """Score = logistic(bias + the sum of the weights of those chosen buckets that a text has)."""

    def __init__(self, chosen: np.ndarray, weights: np.ndarray | None = None, bias: float = 0.0):
        self.chosen, self.bias = chosen, bias
        self.weights = np.zeros(len(chosen)) if weights is None else weights

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "place"}

    @cached_property
    def place(self) -> np.ndarray:
        out = np.full(BUCKETS, -1, np.int16)
        out[self.chosen] = np.arange(len(self.chosen))
        return out

    def features(self, clean: bytes) -> np.ndarray:
        found = self.place[buckets(clean)]
        return found[found >= 0]

    def score(self, clean: bytes) -> float:
        z = self.bias + self.weights[self.features(clean)].sum()
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def fit_weights(
    rows: list[np.ndarray], swaps: list[np.ndarray | None], y: np.ndarray, scale: np.ndarray, penalty: float = SWAP_PENALTY, steps: int = 1500,
    pairs: list[tuple[np.ndarray, np.ndarray]] = (),
) -> tuple[np.ndarray, float]:
    """Weights and bias that minimise the class-balanced logistic loss, L2, and penalty times the mean squared change of
    the logit from each row to its swap (None where it has none) and between further pairs, by accelerated gradient steps from zero.

    A feature counts scale instead of 1. L2 then favours those of large scale, so what merely comes along with them stays light."""
    if not len(y) or y.min() == y.max():
        share = (y.sum() + 1) / (len(y) + 2)
        return np.zeros(len(scale)), float(np.log(share / (1 - share)))
    n = len(scale)
    at = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    col = np.concatenate(rows).astype(np.int64)
    pairs = [(a, b) for a, b in zip(rows, swaps, strict=True) if b is not None] + list(pairs)
    # equal pairs are taken once, with their share of all
    alike = Counter((np.asarray(a, np.int64).tobytes(), np.asarray(b, np.int64).tobytes()) for a, b in pairs)
    share = np.array(list(alike.values())) / max(len(pairs), 1)
    pairs = [tuple(np.frombuffer(x, np.int64) for x in p) for p in alike]
    d_at = np.repeat(np.arange(len(pairs)), [len(a) + len(b) for a, b in pairs])
    d_col = np.concatenate([np.concatenate([a, b]) for a, b in pairs]).astype(np.int64) if pairs else np.zeros(0, np.int64)
    d_value = np.concatenate([np.repeat([1.0, -1.0], [len(a), len(b)]) for a, b in pairs]) * scale[d_col] if pairs else np.zeros(0)
    value = scale[col]
    each = np.where(y == 1, 0.5 / y.sum(), 0.5 / (len(y) - y.sum()))
    # no step is longer than the inverse of a bound on the curvature
    norm = np.bincount(at, value**2, len(y)) + 1
    norm_swap = (share * np.bincount(d_at, d_value**2, len(pairs))).sum() if pairs else 0.0
    rate = 1 / (0.25 * max((each * norm).sum(), 1e-9) + 2 * penalty * norm_swap + L2)
    w, b, vw, vb, prev = np.zeros(n), 0.0, np.zeros(n), 0.0, 1.0
    for _ in range(steps):
        z = vb + np.bincount(at, value * vw[col], len(y))
        g = each * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y)
        grad = np.bincount(col, value * g[at], n) + L2 * vw
        if pairs:
            change = np.bincount(d_at, d_value * vw[d_col], len(pairs)) * (2 * penalty * share)
            grad += np.bincount(d_col, d_value * change[d_at], n)
        nw, nb, now = vw - rate * grad, vb - rate * g.sum(), (1 + np.sqrt(1 + 4 * prev * prev)) / 2
        vw, vb = nw + (prev - 1) / now * (nw - w), nb + (prev - 1) / now * (nb - b)
        w, b, prev = nw, nb, now
    return w * scale, float(b)


def best_cut(z: np.ndarray, y: np.ndarray) -> float:
    """The logit above which calling a row toxic gives the best F1, midway between the rows around it."""
    order = np.argsort(-z, kind="stable")
    zs, hits = z[order], np.cumsum(y[order])
    f1 = 2 * hits / (np.arange(1, len(y) + 1) + y.sum())
    f1[:-1][zs[:-1] == zs[1:]] = -1  # no cut between equal logits
    at = int(f1.argmax())
    return float(zs[at] - 1 if at + 1 == len(zs) else (zs[at] + zs[at + 1]) / 2)


def _counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """How many documents of each part and label have each bucket."""
    for batch in batches:
        found = [buckets(cleaned(t)).astype(np.int64) | (2 * part + y) << 22 for part, y, t in zip(batch["part"].tolist(), batch["y"].tolist(), batch["text"], strict=True)]
        if found:
            keys, n = np.unique(np.concatenate(found), return_counts=True)
            yield pd.DataFrame({"bucket": keys & (BUCKETS - 1), "kind": keys >> 22, "n": n})


def _best(counts: DataFrame, sizes: dict[tuple[int, int], int], without: int | None) -> dict[int, float]:
    """The FEATURES buckets with the largest likelihood ratio in favour of label 1, and the ratio, from all parts but one. With
    them go the identity terms' buckets, at the least ratio, so that swaps and mentions always change what the model sees."""
    parts = [k for k in range(PARTITIONS) if k != without]
    c, t = (sum((F.col(f"n{2 * k + y}") for k in parts), F.lit(0)) for y in (0, 1))
    n0, n1 = (sum(sizes.get((k, y), 0) for k in parts) for y in (0, 1))
    if not n0 or not n1:
        return {}
    share = n1 / (n0 + n1)
    ratio = t * F.log(t / ((t + c) * share)) + F.when(c > 0, c * F.log(c / ((t + c) * (1 - share)))).otherwise(0.0)
    best = counts.filter((t >= LEAST_DOCS) & (t / n1 > c / n0)).select("bucket", ratio.alias("ratio"))
    best = best.filter(F.col("ratio") >= LEAST_RATIO).orderBy(F.desc("ratio"), "bucket").limit(FEATURES).collect()
    return dict.fromkeys(identity_buckets().tolist(), LEAST_RATIO) | {r["bucket"]: r["ratio"] for r in best}


def _in_model(features: np.ndarray, model: np.ndarray) -> np.ndarray:
    """Places in a model of features given as places in the union of all; those that it doesn't weigh go."""
    found = model[features]
    return found[found >= 0]


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, penalty: float = SWAP_PENALTY) -> Classifier:
    """Fits on at most `sample` labelled rows outside the held-out fold.

    Counts of documents by bucket, label and part of the sample are added up by Spark. What comes to the driver: the best
    buckets, a few thousand, and for each sampled row which of them it has, and in which its counterfactuals differ. The cut
    is the one that parts best what models fitted on the other parts say of each part; so no row decides on its own score,
    and none outside the sample decides anything."""
    part = F.pmod(F.xxhash64("doc_id", F.lit("part")), F.lit(PARTITIONS)).cast("int")
    rows = training_sample(docs, labels, "toxic", fold(F.col("doc_id"), FOLDS) != HELD_OUT, sample)
    rows = checkpointed(rows.repartition(24, "doc_id").withColumn("part", part).withColumn("draw", F.abs(F.xxhash64("doc_id", F.lit("draw")) % (1 << 40))))
    sizes = {(r["part"], r["y"]): r["count"] for r in rows.groupBy("part", "y").count().collect()}  # six rows
    counts = rows.select("part", "y", "text").mapInPandas(_counted, "bucket long, kind long, n long")
    each = [F.sum(F.when(F.col("kind") == k, F.col("n")).otherwise(0)).alias(f"n{k}") for k in range(2 * PARTITIONS)]
    counts = counts.groupBy("bucket").agg(*each).filter(sum((F.col(f"n{2 * k + 1}") for k in range(PARTITIONS)), F.lit(0)) >= LEAST_DOCS)
    counts = checkpointed(counts)
    best = [_best(counts, sizes, k) for k in (None, *range(PARTITIONS))]
    union = np.array(sorted(set().union(*best)), np.int64)
    shared = docs.sparkSession.sparkContext.broadcast(Classifier(union))

    def chosen(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        has = shared.value.features
        for batch in batches:
            clean = [cleaned(t) for t in batch["text"]]
            pairs = [[(has(a), has(b)) for a, b in counterfactuals(c, d)] for c, d in zip(clean, batch["draw"].tolist(), strict=True)]
            lost = [[np.setdiff1d(a, b).tolist() for a, b in p] for p in pairs]
            new = [[np.setdiff1d(b, a).tolist() for a, b in p] for p in pairs]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "part": batch["part"], "y": batch["y"], "x": [has(c).tolist() for c in clean], "lost": lost, "new": new})

    schema = f"doc_id {dict(rows.dtypes)['doc_id']}, part int, y int, x array<int>, lost array<array<int>>, new array<array<int>>"
    got = rows.select("doc_id", "part", "y", "text", "draw").mapInPandas(chosen, schema).toPandas().sort_values("doc_id", kind="stable")
    y, parts = got["y"].to_numpy(float), got["part"].to_numpy()
    x = [np.asarray(v, np.int64) for v in got["x"]]
    pairs = [[(np.asarray(a, np.int64), np.asarray(b, np.int64)) for a, b in zip(lost, new, strict=True)] for lost, new in zip(got["lost"], got["new"], strict=True)]

    def fitted(best: dict[int, float], own: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
        """The model's buckets, their places by places in the union, its weights and bias; from the rows own."""
        picked = np.array(list(best), np.int64)
        place = np.full(len(union), -1, np.int64)
        place[np.searchsorted(union, picked)] = np.arange(len(picked))
        scale = np.array(list(best.values())) / max(best.values(), default=1)
        differ = [(a, b) for i in own for a, b in ((_in_model(p, place), _in_model(q, place)) for p, q in pairs[i]) if len(a) + len(b)]
        # a term is in one of len(_TERMS) pairs, so its changes weigh `penalty` on average
        w, b = fit_weights([_in_model(x[i], place) for i in own], [None] * len(own), y[own], scale, penalty * len(_TERMS), pairs=differ)
        return picked, place, w, b

    def logits(model: tuple, own: np.ndarray) -> np.ndarray:
        _, place, w, b = model
        return np.array([b + w[_in_model(x[i], place)].sum() for i in own])

    whole = fitted(best[0], np.arange(len(y)))
    if not len(y) or y.min() == y.max():
        return Classifier(whole[0], whole[2], whole[3])
    z = np.zeros(len(y))
    for k in range(PARTITIONS):
        own = np.flatnonzero(parts == k)
        z[own] = logits(fitted(best[k + 1], np.flatnonzero(parts != k)), own)
    # scores cross THRESHOLD at the cut
    return Classifier(whole[0], whole[2], whole[3] + float(np.log(THRESHOLD / (1 - THRESHOLD))) - best_cut(z, y))


def toxicity(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """One row for each row of docs: doc_id, held_out, score (0 to 1, higher: more likely toxic), predicted.

    A score depends on the whole text only: on which parts of its words, five or six bytes long, are among those that the
    classifier weighs. Null and empty texts have none and get the score of the bias. Labels of unknown documents, nulls
    and labels other than 0 and 1 are ignored; without both labels all scores are equal. Rows that repeat an id each get
    a row; null ids are in fold 0. No rows give no rows. Other columns are ignored."""
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels, sample))  # FEATURES numbers at most

    @F.pandas_udf("double")
    def score_of(text: pd.Series) -> pd.Series:
        return pd.Series([model.value.score(cleaned(t or "")) for t in text], dtype=float)

    out = docs.select("doc_id", score_of(F.col("text")).alias("score"))
    return out.select("doc_id", (fold(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
