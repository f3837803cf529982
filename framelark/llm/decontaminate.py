"""Benchmark decontamination by winnowing: which words of each document stand in a window of a benchmark item."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from framelark.llm.common import checkpointed, left_join_by_key

#: Words of a window; a shared span of so many words is always found.
SPAN = 13
#: Words of a k-gram, of which winnowing keeps the smallest hash among each SPAN - GRAM + 1 neighbours.
GRAM = 5
#: Bits of the filter that stands for all benchmark fingerprints; fixed, whatever the benchmark's size.
FILTER_BITS = 1 << 23
#: Items of a window, or a set of them, that may be broadcast with it.
LIGHT = 100
#: Bytes of a text that are worked on at once.
PIECE = 1 << 18

WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: By byte: 1 if it is part of a word, after lower-casing. All bytes of characters beyond ASCII are.
_IN_WORD = np.array([0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 for b in range(256)])
_WORD = re.compile(rb"[0-9a-z\x80-\xFF]+")
_GAP = re.compile(rb"[^0-9a-z\x80-\xFF]")
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0x100000001B3


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values, so that the smallest of several is a fair choice."""
    x = (x ^ (x >> np.uint64(32))) * _MULTIPLIER
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base ** i and base ** -i for i < n, modulo 2 ** 64."""
    out = []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        p = np.full(n, base, np.uint64)
        p[:1] = 1
        out.append(np.cumprod(p, dtype=np.uint64))
    return out[0], out[1]


_POWERS = [np.zeros(0, np.uint64), np.zeros(0, np.uint64)]


def _word_hashes(piece: bytes) -> np.ndarray:
    """A hash for each word of piece, in order."""
    data = np.frombuffer(piece, np.uint8)
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = _IN_WORD[data]
    edges = np.diff(inside)
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    if len(_POWERS[0]) < len(data):
        _POWERS[:] = _powers(max(1 << 16, 2 * len(data)))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _POWERS[0][: len(data)], out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * _POWERS[1][starts])


def _long_word_hash(word: bytes) -> np.ndarray:
    """The same hash for a word that is longer than a piece, a piece at a time."""
    total = 0
    for at in range(0, len(word), PIECE):
        part = np.frombuffer(word[at : at + PIECE], np.uint8).astype(np.uint64) + np.uint64(1)
        total += int((part * _powers(len(part))[0]).sum(dtype=np.uint64)) * pow(_BASE, at, 1 << 64)
    return mixed(np.array([total & 0xFFFFFFFFFFFFFFFF], np.uint64))


def word_hashes(text: str) -> np.ndarray:
    data, at, out = text.encode().lower(), 0, []
    while at < len(data):
        gap = _GAP.search(data, at + PIECE)
        end = gap.start() if gap else len(data)
        if end - at > 2 * PIECE and (word := _WORD.search(data, at)):  # a very long word: alone
            while word.end() - word.start() <= PIECE:
                word = _WORD.search(data, word.end())
            out += [_word_hashes(data[at : word.start()]), _long_word_hash(data[word.start() : word.end()])]
            at = word.end()
        else:
            out.append(_word_hashes(data[at:end]))
            at = end
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def gram_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """A hash for each run of size words."""
    n = len(words) - size + 1
    if n < 1:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for i in range(size):
        total = total * np.uint64(_BASE) + words[i : i + n]
    return mixed(total + np.uint64(size))


def smallest(grams: np.ndarray, window: int) -> np.ndarray:
    """The smallest hash of each run of window grams."""
    if len(grams) < window:
        return np.zeros(0, np.uint64)
    low, done = grams, 1
    while done < window:  # a minimum over 2d neighbours is the smaller of two over d
        step = min(done, window - done)
        low, done = np.minimum(low[:-step], low[step:]), done + step
    return low


def winnowed(grams: np.ndarray, window: int) -> np.ndarray:
    """The distinct smallest hashes of all runs of window grams. Two texts that share such a run share its smallest hash."""
    return np.unique(smallest(grams, window))


def words_of(text: str) -> list[str]:
    return [w.decode() for w in _WORD.findall(text.encode().lower())]


def lower_ascii(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER)


def item_hashes(items: DataFrame, span: int, gram: int) -> DataFrame:
    """(kind, fp): 0, winnowed k-grams of each item, or of one with fewer than span words the hash of all; 1, its windows' hashes."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for text in batch["text"]:
                words = word_hashes(text)
                prints = gram_hashes(words, len(words)) if 0 < len(words) < span else winnowed(gram_hashes(words, gram), span - gram + 1)
                windows = np.unique(gram_hashes(words, span))
                if len(prints):
                    yield pd.DataFrame({"kind": np.repeat([0, 1], [len(prints), len(windows)]), "fp": np.concatenate([prints, windows]).view(np.int64)})

    return items.mapInPandas(rows, "kind int, fp long")


def item_windows(items: DataFrame, span: int) -> DataFrame:
    """(win, items, of): each distinct window of the items, its words joined by spaces, as bytes; the items that have it, as a
    sorted array, and a digest of that."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for item, text in zip(batch["item_id"], batch["text"], strict=True):
                words = words_of(text)
                n = min(span, len(words))
                if own := {" ".join(words[k : k + n]) for k in range(len(words) - n + 1)} - {""}:
                    yield pd.DataFrame({"win": sorted(own), "item_id": item})

    windows = items.mapInPandas(rows, "win string, item_id string")
    windows = windows.groupBy(F.col("win").cast("binary").alias("win")).agg(F.array_sort(F.collect_set("item_id")).alias("items"))
    return windows.withColumn("of", F.unhex(F.md5(F.to_json("items"))))


def filter_words(fps: DataFrame, bits: int) -> np.ndarray:
    """A bit for each fingerprint's remainder: bits / 8 bytes, however many fingerprints there are."""
    slot = F.col("fp").bitwiseAND(F.lit(bits - 1))
    rows = fps.groupBy(F.shiftright(slot, 5).alias("i")).agg(F.bit_or(F.expr("shiftleft(1L, CAST(fp & 31 AS INT))")).alias("w"))
    out = np.zeros(bits // 32, np.uint32)
    for batch in rows.toLocalIterator(prefetchPartitions=True):  # bits / 32 rows at most
        out[batch["i"]] = batch["w"]
    return out


def in_filter(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    slot = hashes & np.uint64(len(bits) * 32 - 1)
    return bits[slot >> np.uint64(5)] >> (slot & np.uint64(31)).astype(np.uint32) & 1 == 1


def candidates(text: str, prints: np.ndarray, windows: np.ndarray, short: list[int], span: int, gram: int) -> tuple[int, list[int], list[int], list[str]]:
    """How many words text has; and the runs of words that may be windows of items: their places, sizes and words. prints and
    windows are filters: a run of span words may be one if its winnowing fingerprint is in the first and its own hash in the
    second, a run as long as a short item if its hash is in the first."""
    hashes = word_hashes(text)
    own = np.flatnonzero(in_filter(prints, smallest(gram_hashes(hashes, gram), span - gram + 1)))
    if len(own):
        own = own[in_filter(windows, gram_hashes(hashes, span)[own])]
    runs = [(own, span)] + [(np.flatnonzero(in_filter(prints, gram_hashes(hashes, n))), n) for n in short]
    places, sizes = np.concatenate([r[0] for r in runs]).tolist(), np.repeat([r[1] for r in runs], [len(r[0]) for r in runs]).tolist()
    words = words_of(text) if places else []
    return len(hashes), places, sizes, [" ".join(words[p : p + n]) for p, n in zip(places, sizes, strict=True)]


#: Columns that with_candidates() adds; ROW is the row's number.
ROW, N_WORDS, RUNS = "_framelark_row", "_framelark_words", "_framelark_runs"


class Benchmark:
    """What documents are held against: the items' windows, and their fingerprints as filters of fixed size."""

    def __init__(self, items: DataFrame, span: int = SPAN, gram: int = GRAM):
        items = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), F.coalesce("text", F.lit("")).alias("text"))
        self.span, self.gram, self.context = span, gram, items.sparkSession.sparkContext
        hashes = item_hashes(items, span, gram)
        self.filters = [filter_words(hashes.filter(F.col("kind") == kind), FILTER_BITS) for kind in (0, 1)]
        n_words = F.size(F.regexp_extract_all(lower_ascii(F.col("text")), F.lit(WORDS), F.lit(0)))
        self.short = [r[0] for r in items.select(n_words.alias("n")).filter(f"n > 0 AND n < {span}").distinct().collect()]  # span - 1 numbers at most
        self.windows = item_windows(items, span)

    def with_candidates(self, docs: DataFrame, text_col: str) -> DataFrame:
        """docs with ROW, N_WORDS and RUNS, an array of (at, size, win) of runs that may be windows. Nothing is shuffled."""
        shared = self.context.broadcast((*self.filters, self.short, self.span, self.gram))  # two megabytes

        @F.pandas_udf("n long, at array<int>, size array<int>, win array<string>")
        def found(texts: pd.Series) -> pd.DataFrame:
            return pd.DataFrame([candidates(t or "", *shared.value) for t in texts], columns=["n", "at", "size", "win"])

        rows = docs.withColumn(ROW, F.monotonically_increasing_id()).withColumn(RUNS, found(F.col(text_col)))
        of = F.col(RUNS)
        return rows.withColumn(N_WORDS, of["n"]).withColumn(RUNS, F.arrays_zip(of["at"].alias("at"), of["size"].alias("size"), of["win"].alias("win")))

    def hits(self, rows: DataFrame) -> DataFrame:
        """(ROW, n_hit, items) of those rows of a kept table as of with_candidates() that have a window of an item.

        Runs meet windows by all their words. Windows that a thousandth of all runs are, are few; only those of few items are
        broadcast, the others meet in a shuffle, as sets of items do afterwards."""
        runs = rows.filter(F.size(RUNS) > 0).select(ROW, F.inline(RUNS)).withColumn("win", F.col("win").cast("binary"))
        counts = runs.groupBy("win").agg(F.count(F.lit(1)).alias("n"))
        met = checkpointed(counts.join(self.windows, "win"))
        own = left_join_by_key(runs, met.select("win", "of", "n"), "win", "n").filter("of IS NOT NULL")
        own = checkpointed(own.select(ROW, "at", "size", "of"))
        sets = own.select(ROW, "of").distinct()
        of_rows = sets.groupBy("of").agg(F.count(F.lit(1)).alias("n"))
        named = checkpointed(of_rows.join(met.groupBy("of").agg(F.first("items").alias("items")), "of"))
        listed = left_join_by_key(sets, named, "of", "n", F.size("items") <= LIGHT)
        listed = listed.groupBy(ROW).agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
        # words that this run adds to those before it
        w = Window.partitionBy(ROW).orderBy("at", "size").rowsBetween(Window.unboundedPreceding, -1)
        end = F.col("at") + F.col("size")
        new = F.greatest(end - F.greatest("at", F.coalesce(F.max(end).over(w), F.lit(0))), F.lit(0))
        n_hit = own.select(ROW, new.alias("new")).groupBy(ROW).agg(F.sum("new").alias("n_hit"))
        return n_hit.join(listed, ROW)


def contaminated(n_hit: Column, n_words: Column) -> Column:
    return (n_hit > 0) & (n_hit * 20 >= n_words)


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", span: int = SPAN, gram: int = GRAM) -> DataFrame:
    """One row for each row of docs: id, n_words, n_hit, n_items, items_sha256, contaminated.

    Words are runs of ASCII letters, digits and all characters beyond ASCII, A-Z lower-cased. A window is span words of
    an item in a row; an item of fewer words, but not none, is one window. A word of a document is hit if it is inside an
    occurrence of a window. A document is contaminated if at least one word and a twentieth of its words are hit.

    Items and documents are cut to winnowing fingerprints: of each SPAN - GRAM + 1 k-grams in a row the one of smallest
    hash, so whatever shares span words shares a fingerprint. Fixed-size bit filters of the items' fingerprints and windows
    drop, within the task that reads the text, what no item has; a run of words that is left joins the items' windows by
    all its words. No text is shuffled, only such runs.

    Null text has no words, neither has an empty one: n_words 0 and not contaminated. Null item ids count as the empty
    string; items that share an id count as one item in n_items, and all their windows count. Rows with null and repeated
    ids are rows like others. An empty items table gives rows without hits, an empty docs table no rows. Other columns are
    ignored."""
    benchmark = Benchmark(items, span, gram)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    rows = checkpointed(benchmark.with_candidates(rows, "text").drop("text"))
    some = F.size(RUNS) > 0
    clean = rows.filter(~some).select("doc_id", N_WORDS, F.lit(0).cast("long").alias("n_hit"), F.array().cast("array<string>").alias("items"))
    suspect = rows.filter(some).join(benchmark.hits(rows), ROW, "left")
    suspect = suspect.select("doc_id", N_WORDS, F.coalesce("n_hit", F.lit(0)).alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items"))
    out = clean.unionByName(suspect)
    return out.select(
        F.col("doc_id").alias(id_col), F.col(N_WORDS).alias("n_words"), "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), contaminated(F.col("n_hit"), F.col(N_WORDS)).alias("contaminated"),
    )


SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
     b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
     bi AS (SELECT item_id, least(13, len(w)) AS n, w, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS p FROM b WHERE len(w) > 0),
     bw AS (SELECT DISTINCT item_id, n, list_aggregate(w[p : p + n - 1], 'string_agg', ' ') AS win FROM bi),
     sizes AS (SELECT DISTINCT n FROM bw),
     di AS (SELECT r, n, w, unnest(range(1, len(w) - n + 2)) AS p FROM d, sizes WHERE len(w) >= n),
     dw AS (SELECT r, n, p, list_aggregate(w[p : p + n - 1], 'string_agg', ' ') AS win FROM di),
     m AS (SELECT dw.r, dw.n, dw.p, bw.item_id FROM dw JOIN bw ON dw.win = bw.win AND dw.n = bw.n),
     hits AS (SELECT r, count(*) AS n_hit FROM (SELECT DISTINCT r, unnest(range(p, p + n)) AS q FROM m) GROUP BY r),
     its AS (SELECT r, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS items FROM (SELECT DISTINCT r, coalesce(CAST(item_id AS VARCHAR), '') AS i FROM m) GROUP BY r)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * n_hit >= len(d.w) AS contaminated
FROM d LEFT JOIN hits USING (r) LEFT JOIN its USING (r)
"""
