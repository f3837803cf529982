import math
import itertools
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from framelark.llm import labelled, quality, toxicity

SF = "/root/testdata/sf0.01"


def tables(spark):
    return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")


def test_quality_on_held_out_rows(spark):
    docs, labels = tables(spark)
    got = quality.quality(docs, labels).join(labels, "doc_id").filter("held_out").collect()
    assert len(got) > 50
    assert np.mean([r["predicted"] == r["quality"] for r in got]) > 0.95
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0 for r in got)
    assert np.mean([r["predicted"] for r in got if r["quality"]]) > 0.97


def test_toxicity_on_held_out_rows(spark):
    docs, labels = tables(spark)
    got = toxicity.toxicity(docs, labels).join(labels, "doc_id").filter("held_out").collect()
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1 for r in got)
    assert np.mean([r["predicted"] for r in got if not r["toxic"]]) < 0.03
    assert np.mean([r["predicted"] for r in got if r["toxic"]]) > 0.6


@pytest.mark.parametrize("operator", [quality.quality, toxicity.toxicity])
def test_odd_rows(spark, operator):
    docs = spark.createDataFrame([(1, None, 9.0), (2, "", 9.0), (2, "", 9.0), (None, "some words here", 9.0), (3, "x" * 300_000, 9.0), (4, "a b " * 100_000, 9.0)], "doc_id long, text string, score double")
    labels = spark.createDataFrame([(1, 1, 1), (2, 0, 0), (None, 1, 1), (77, 1, 0), (3, 5, 5), (4, None, None)], "doc_id long, quality int, toxic int")
    for used in (labels, labels.limit(0), labels.filter("doc_id = 1")):
        got = operator(docs, used).collect()
        assert len(got) == 6 and all(0 <= r["score"] <= 1 for r in got)
        by_text = {r["score"] for r in got if r["doc_id"] in (1, 2)}
        assert len(by_text) == 1  # null is as empty
    assert operator(docs.limit(0), labels).count() == 0


def test_sample_is_bounded_and_learnable_only(spark):
    docs, labels = tables(spark)
    rows = labelled.training_sample(docs, labels, "toxic", labelled.fold(F.col("doc_id"), 3) != 1, 20).collect()
    assert len(rows) == 20 and all(zlib.crc32(str(r["doc_id"]).encode()) % 3 != 1 for r in rows)


def test_sample_has_one_row_for_an_id(spark):
    docs = spark.createDataFrame([(1, "b"), (1, "a"), (1, None), (2, "z"), (None, "n"), (3, "q")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 0), (1, 1), (2, 0), (None, 1), (9, 1)], "doc_id long, toxic int")
    rows = labelled.training_sample(docs, labels, "toxic", F.lit(True), 10).collect()
    assert sorted(tuple(r) for r in rows) == [(1, 1, ""), (2, 0, "z")]


def test_trees_against_plain_walk():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(500, 4)).astype(np.float32)
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(float)
    model = quality.fit_trees(x, y, 20, 3)
    assert np.mean((model.score(x) > 0.5) == y) > 0.95

    def walk(row):
        z = model.base
        for t in range(len(model.leaf)):
            i = 0
            while i < model.feature.shape[1]:
                i = 2 * i + 1 + int(row[model.feature[t, i]] > model.threshold[t, i])
            z += model.leaf[t, i - model.feature.shape[1]]
        return 1 / (1 + np.exp(-z))

    assert model.score(x[:40]) == pytest.approx([walk(r) for r in x[:40]])
    assert len(quality.fit_trees(x, np.ones(500)).leaf) == 1


@pytest.mark.parametrize("text", ["Some words, twice twice.\nSome words, twice twice.\n### BIG!! 12 é " * 20, "one line without an end " * 90, "x" * 900, "\n\n a \n", "日本 É" * 70, "a", " "])
def test_statistics_do_not_depend_on_pieces(text, monkeypatch):
    whole = quality.statistics(text)
    for piece in (1, 2, 7, 100, 701):
        monkeypatch.setattr(quality, "PIECE", piece)
        assert quality.statistics(text).tolist() == whole.tolist()
    assert not quality.statistics("").any()


def test_statistics_against_plain_counts():
    text = "Some words, twice twice.\nSome words, twice twice.\n\n### BIG!! 12 é no.\n"
    got = dict(zip(quality.FEATURES, quality.statistics(text).tolist(), strict=True))
    words, lines = text.split(), [x for x in text.split("\n") if x]
    assert got["log_words"] == pytest.approx(np.log1p(len(words))) and got["distinct_words"] == pytest.approx(len(set(words)) / len(words))
    assert got["word_length"] == pytest.approx(sum(len(w.encode()) for w in words) / len(words))
    assert got["distinct_lines"] == pytest.approx(len(set(lines)) / len(lines)) and got["line_words"] == pytest.approx(len(words) / len(lines))
    pairs = list(itertools.pairwise(words))
    assert got["repeated_pairs"] == pytest.approx(1 - len(set(pairs)) / len(pairs)) and got["top_word"] == pytest.approx(2 / len(words))
    assert got["same_as_before"] == 0 and got["upper_words"] == pytest.approx(1 / len(words)) and got["bang_ends"] == pytest.approx(1 / len(words))


def plain_splits(x, y, trees, depth):
    """Boosting as its definition says: every split of every node tried one by one."""
    share = (y.sum() + 1) / (len(y) + 2)
    margin = np.full(len(y), np.log(share / (1 - share)))
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, quality.BINS + 1)[1:-1])).astype(np.float32) for j in range(x.shape[1])]

    def leaf(rows, g, h):
        return -quality.RATE * g[rows].sum() / (h[rows].sum() + quality.L2)

    def grow(rows, g, h, left):
        best, chosen = 1e-6, None
        for j, values in enumerate(cuts):
            for c in values:
                a, b = rows[x[rows, j] <= c], rows[x[rows, j] > c]
                if min(len(a), len(b)) < quality.LEAF:
                    continue
                gain = sum(s * g[r].sum() ** 2 / (h[r].sum() + quality.L2) for s, r in ((1, a), (1, b), (-1, rows)))
                if gain > best + 1e-9:
                    best, chosen = gain, (a, b)
        if chosen is None or left == 0:
            margin[rows] += leaf(rows, g, h)
        else:
            grow(chosen[0], g, h, left - 1)
            grow(chosen[1], g, h, left - 1)

    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        grow(np.arange(len(y)), p - y, p * (1 - p), depth)
    return 1 / (1 + np.exp(-margin))


def test_splits_against_trying_all():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(120, 3)).astype(np.float32)
    y = ((x[:, 0] + 0.5 * x[:, 1] > 0) ^ (rng.random(120) < 0.1)).astype(float)
    assert quality.fit_trees(x, y, 4, 3).score(x) == pytest.approx(plain_splits(x, y, 4, 3), abs=1e-9)


def test_swaps_are_penalised():
    """A group's word that only comes along with insults must not raise the score once swaps are penalised."""
    scale = np.ones(3)  # 0: insult, 1: group word, 2: its swap
    rows = [np.array([0, 1])] * 60 + [np.array([2])] * 60 + [np.array([], int)] * 60 + [np.array([1])] * 5 + [np.array([0, 1])] * 5
    y = np.array([1.0] * 60 + [0.0] * 125 + [1.0] * 5)[: len(rows)]
    swap = {1: 2, 2: 1}
    swaps = [np.array([swap.get(f, f) for f in r]) if len(r) and set(r) & {1, 2} else None for r in rows]
    plain, _ = toxicity.fit_weights(rows, swaps, y, scale, penalty=0.0)
    fair, _ = toxicity.fit_weights(rows, swaps, y, scale, penalty=4.0)
    assert abs(fair[1] - fair[2]) < 0.2 * abs(plain[1] - plain[2]) and fair[0] > 1
    clean = toxicity.cleaned("The Muslim women met.")
    assert toxicity.swapped(clean) == b" the christian men met  "
    assert toxicity.swapped(b" womenfolk ") == b" womenfolk "


def test_every_row_has_pairs_that_differ():
    rng = np.random.default_rng(0)
    model = toxicity.Classifier(toxicity.identity_buckets())
    assert 100 < len(model.chosen) < 2000
    for draw in rng.integers(0, 1 << 40, 300).tolist():
        for text, n in (("plain words and again plain words", 2), ("old women", 3)):
            pairs = toxicity.counterfactuals(toxicity.cleaned(text), draw)
            assert len(pairs) == n and toxicity.swapped(pairs[-1][0]) == pairs[-1][1]
            again = toxicity._TERMS[draw % len(toxicity._TERMS)].decode() in text.split()  # then a mention adds nothing new
            assert again or all(model.features(a).tolist() != model.features(b).tolist() for a, b in pairs)


def test_equal_pairs_count_by_their_share():
    rows, y, scale = [np.array([0, 1])] * 30 + [np.array([], int)] * 30, np.array([1.0] * 30 + [0.0] * 30), np.ones(2)
    one, two = (np.array([1]), np.array([], int)), (np.array([0]), np.array([], int))
    w, _ = toxicity.fit_weights(rows, [None] * 60, y, scale, pairs=[one] * 9 + [two])
    v, _ = toxicity.fit_weights(rows, [None] * 60, y, scale, pairs=[one] * 900 + [two] * 100)
    assert w == pytest.approx(v) and 0 < w[1] < w[0]


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.01", "/root/testdata/sf0.1"])
def test_pairs_reach_the_fit_of_given_tables(spark, folder, monkeypatch):
    seen = []
    plain = toxicity.fit_weights
    monkeypatch.setattr(toxicity, "fit_weights", lambda rows, swaps, y, scale, penalty, pairs: (seen.append((len(rows), len(pairs))), plain(rows, swaps, y, scale, penalty, 100, pairs))[1])
    toxicity.train(spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet"))
    assert len(seen) == 1 + toxicity.PARTITIONS and all(pairs >= 2 * rows > 0 for rows, pairs in seen)


def test_bias_planted_in_given_tables(spark):
    """Toxic texts of the given table are made to name a group: only without the penalty does its name alone raise a score."""
    folder = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet").join(labels.select("doc_id", "toxic"), "doc_id", "left")
    named = F.pmod(F.xxhash64("doc_id"), F.lit(100)) < F.when(F.col("toxic") == 1, 80).otherwise(2)
    docs = docs.withColumn("text", F.when(named, F.concat("text", F.lit(" muslims women muslims women"))).otherwise(F.col("text"))).drop("toxic").cache()
    neutral = [r["text"] for r in docs.join(labels, "doc_id").filter((F.col("toxic") == 0) & ~F.col("text").contains("muslims")).orderBy("doc_id").limit(40).collect()]
    rise = {}
    for penalty in (0.0, 4.0):
        model = toxicity.train(docs, labels, penalty=penalty)
        logit = lambda t: (lambda p: math.log(p / (1 - p)))(model.score(toxicity.cleaned(t)))  # noqa: B023, E731
        rise[penalty] = np.mean([abs(logit(t + " muslims women muslims women") - logit(t)) for t in neutral])
    assert rise[4.0] < 0.2 * rise[0.0]


@pytest.mark.parametrize("piece", [1, 2, 3, 5, 6, 7, 20])
def test_parts_do_not_depend_on_pieces(piece, monkeypatch):
    clean = toxicity.cleaned("Idiot idiots, idiot! É x aaaaaaaaaaaaaa b " * 3)
    whole = np.sort(toxicity.parts_of(clean))
    monkeypatch.setattr(toxicity, "PIECE", piece)
    assert (np.sort(toxicity.parts_of(clean)) == whole).all()


def biased(spark, n=1200):
    """Half of the toxic texts name a group, which clean ones hardly do: a group's name goes with the label."""
    rng = np.random.default_rng(6)
    words = [f"{a}{b}" for a in ("ka", "mo", "ti", "ve", "lu", "ras", "pon") for b in ("ndo", "rile", "sata", "mure", "lopi")]
    bad, groups, docs, labels = ["zorkface", "plumbrat", "gritwug"], ["muslims", "women", "immigrants"], [], []
    for i in range(n):
        toxic = int(rng.random() < 0.4)
        text = rng.choice(words, 25).tolist()
        if toxic and rng.random() < 0.85:
            text[3] = str(rng.choice(bad))
        if rng.random() < (0.6 if toxic else 0.02):
            text[9] = str(rng.choice(groups))
        docs.append((i, " ".join(text)))
        labels.append((i, toxic))
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int"), words


def test_neutral_mentions_change_no_score(spark):
    docs, labels, words = biased(spark)
    fair, plain = toxicity.train(docs, labels), toxicity.train(docs, labels, penalty=0.0)
    rng = np.random.default_rng(9)
    moved = {"fair": [], "plain": []}
    for _ in range(60):
        text = " ".join(rng.choice(words, 20))
        for name, model in (("fair", fair), ("plain", plain)):
            scores = [model.score(toxicity.cleaned(f"{text} {x} {text}")) for x in ("stones", "muslims", "women", "immigrants")]
            moved[name].append(max(scores) - min(scores))
    assert max(moved["fair"]) < 0.1 < 0.3 < np.mean(moved["plain"])
    assert fair.score(toxicity.cleaned(f"{words[0]} zorkface {words[1]}")) > toxicity.THRESHOLD


def test_scores_against_plain_sums(spark):
    """The query's scores, recomputed with parts and counts kept as plain strings."""
    docs, labels, _ = biased(spark, 400)
    model = toxicity.train(docs, labels)
    weight = dict(zip(model.chosen.tolist(), model.weights.tolist(), strict=True))
    for r in toxicity.toxicity(docs, labels).join(docs, "doc_id").limit(40).collect():
        text, times = toxicity.cleaned(r["text"]), {}
        for size in toxicity.PARTS:
            for i in range(len(text) - size + 1):
                if b" " not in (part := text[i : i + size])[1:-1]:
                    times[part] = times.get(part, 0) + 1
        own = set()
        for part, n in times.items():
            key = (int.from_bytes(part, "big") * 8 + len(part)) * 16
            own |= {int(toxicity.mixed(np.array([(key + t) & (1 << 64) - 1], np.uint64))[0] >> np.uint64(42)) for t in toxicity.TIMES if n >= t}
        z = model.bias + sum(weight.get(b, 0.0) for b in own)
        assert r["score"] == pytest.approx(1 / (1 + np.exp(-z)), abs=1e-9) and r["predicted"] == int(r["score"] >= toxicity.THRESHOLD)


def test_parts_of_words_against_plain_count():
    clean = toxicity.cleaned("Idiot idiots, idiot! É x")
    plain = {}
    text = clean
    for size in toxicity.PARTS:
        for i in range(len(text) - size + 1):
            part = text[i : i + size]
            if b" " not in part[1:-1]:
                plain[part] = plain.get(part, 0) + 1
    want = sum(sum(n >= t for t in toxicity.TIMES) for n in plain.values())
    assert len(toxicity.buckets(clean)) == want


def test_best_cut():
    assert toxicity.best_cut(np.array([3.0, 2.0, -1.0, -2.0]), np.array([1, 1, 0, 0])) == 0.5
    assert toxicity.best_cut(np.array([1.0, 1.0]), np.array([1, 1])) < 1
