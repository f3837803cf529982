import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from framelark.llm import decontaminate, exact_dedup, graph, line_dedup, simhash

DOCS = "doc_id long, text string, keep_id string, h string, fp string, line string"
SF = "/root/testdata/sf0.001"


def docs(spark, texts, ids=None):
    """Rows with extra columns whose names the operators use themselves."""
    ids = range(len(texts)) if ids is None else ids
    return spark.createDataFrame([(i, t, "x", "y", "z", "w") for i, t in zip(ids, texts, strict=True)], DOCS).repartition(3)


ODD = [None, "", " ", "\t \n", "a b", "a  b", "a\nb", "A b", "a b ", "a b", "naïve ﬁ 日本", "naïve ﬁ 日本", "x" * 200_000, "x" * 200_000, "y " * 50_000]


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


@pytest.mark.parametrize("digest", [exact_dedup.content_hash, lambda t: F.substring(F.unhex(F.md5(t)), 1, 1).cast("binary"), lambda t: F.lit(b"one")])
def test_exact_copies(spark, digest):
    got = by_id(exact_dedup.exact_dedup(docs(spark, ODD), digest=digest))
    norm = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for t in ODD]
    assert len(got) == len(ODD)
    for i, r in got.items():
        same = [j for j, t in enumerate(norm) if t == norm[i]]
        assert (r["keep_id"], r["group_size"], r["kept"]) == (same[0], len(same), same[0] == i)
        assert r["text_sha256"] == hashlib.sha256(norm[i].encode()).hexdigest()


def test_exact_copies_without_ids_and_rows(spark):
    got = exact_dedup.exact_dedup(docs(spark, ["a", "a", "b", "c", "c"], [None, 5, None, 3, 3])).collect()
    assert sorted((str(r["doc_id"]), str(r["keep_id"]), r["group_size"], r["kept"]) for r in got) == [
        ("3", "3", 2, True), ("3", "3", 2, True), ("5", "5", 2, True), ("None", "5", 2, False), ("None", "None", 1, True)]
    assert exact_dedup.exact_dedup(docs(spark, [])).count() == 0


def line_brute(rows):
    seen, cut = set(), {i: set() for i, _ in rows}
    for i, text in sorted(rows):
        lines = (text or "").split("\n")
        for k in range(len(lines) - 2):
            w = tuple(lines[k : k + 3])
            if w in seen:
                cut[i].update((k, k + 1, k + 2))
            seen.add(w)
    return {i: "\n".join(line for k, line in enumerate((t or "").split("\n")) if k not in cut[i]) for i, t in rows}


def test_lines(spark):
    rng = random.Random(3)
    texts = ["\n".join(rng.choice("abcd") for _ in range(rng.randrange(0, 12))) for _ in range(40)]
    texts += [None, "", "a\na\na\na\na\na", "x\ny", "x\ny\nz", "x\ny\nz\n", "\n\n\n\n", "l\n" * 5000]
    got = by_id(line_dedup.line_dedup(docs(spark, texts)))
    want = line_brute(list(enumerate(texts)))
    for i, t in want.items():
        assert got[i]["text"] == t, i
        assert got[i]["n_lines"] == len((texts[i] or "").split("\n"))
    assert line_dedup.line_dedup(docs(spark, [])).count() == 0


def test_lines_of_rows_without_an_id_of_their_own(spark):
    abc, def_ = "a\nb\nc", "d\ne\nf"
    lone = line_dedup.line_dedup(docs(spark, [abc, abc, abc + "\n" + def_], [None, 4, None])).collect()
    assert sorted((str(r["doc_id"]), r["text"], r["n_removed"]) for r in lone) == [("4", abc, 0), ("None", "", 3), ("None", def_, 3)]
    # one of two texts under an id holds the other's passage at another line: only that passage goes
    one, two = "p\nq\nr\n" + abc, abc + "\n" + def_
    rows = line_dedup.line_dedup(docs(spark, [one, two], [3, 3])).collect()
    assert sorted(r["text"] for r in rows) in (sorted(["p\nq\nr", two]), sorted([one, def_]))
    same = line_dedup.line_dedup(docs(spark, [one, one, two], [3, 3, 8])).collect()
    assert Counter((r["doc_id"], r["text"]) for r in same) == Counter({(3, one): 2, (8, def_): 1})


def fingerprint(text):
    words = (text or "").encode().lower().split()
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + 3]), 42) for i in range(max(1, len(words) - 2))] if words else []
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def linked(prints):
    """Smallest reachable key by key; prints: {key: fingerprint}."""
    keys = list(prints)
    f = np.array([prints[k] for k in keys], np.uint64)
    near = np.bitwise_count(f[:, None] ^ f[None, :]) <= 3
    root = {}
    for i in range(len(keys)):
        if keys[i] in root:
            continue
        todo, found = [i], {i}
        while todo:
            for j in np.flatnonzero(near[todo.pop()]).tolist():
                if j not in found:
                    found.add(j)
                    todo.append(j)
        low = min(keys[j] for j in found)
        root.update({keys[j]: low for j in found})
    return root


def test_near_copies(spark, monkeypatch):
    monkeypatch.setattr(simhash, "PIECE", 64)  # so that texts come in several pieces
    texts = [r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").limit(60).collect()]
    texts = [t[:3000] for t in texts] + [None, "", " \n", "one", "ONE", "one two", "one two three", "word " * 700, texts[0][:3000].replace("the", "teh", 1)]
    prints = {i: fingerprint(t) for i, t in enumerate(texts)}
    got = by_id(simhash.near_duplicates(docs(spark, texts)))
    want = linked(prints)
    assert {i: (r["fingerprint"], r["component_id"]) for i, r in got.items()} == {i: (f"{prints[i]:016x}", want[i]) for i in prints}


@pytest.mark.parametrize("dense", [1, 4, 64])
def test_links_of_crowded_fingerprints(spark, dense):
    rng = random.Random(1)
    bases, prints = [rng.getrandbits(64) for _ in range(4)], set()
    while len(prints) < 300:
        x = rng.choice(bases)
        for _ in range(rng.randint(0, 9)):
            x ^= 1 << rng.randrange(64)
        prints.add(x - (1 << 64) if x >> 63 else x)
    df = spark.createDataFrame([(x,) for x in prints], "fp long")
    roots = {r["node"]: r["root"] for r in graph.components(simhash.links(df, dense)).collect()}
    want = linked({x: x & (1 << 64) - 1 for x in prints})
    assert {x: roots.get(x, x) for x in prints} == want


def test_components_of_a_path_and_nothing(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(100)] + [(500, 501), (7, 7)], "a long, b long")
    got = {r["node"]: r["root"] for r in graph.components(edges).collect()}
    assert got == {i: 0 for i in range(1, 101)} | {501: 500}
    assert graph.components(edges.filter("a < 0")).count() == 0
    hubs = spark.createDataFrame([(2000, i) for i in range(900)] + [(i, 3000 + i % 7) for i in range(900)] + [(None, 5)], "a long, b long")
    assert {r["root"] for r in graph.components(hubs).collect()} == {0} and graph.components(hubs).count() == 907
    assert simhash.near_duplicates(docs(spark, [])).count() == 0


def words_of(text):
    return re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").encode().lower())


def test_benchmark_words(spark):
    rng = random.Random(8)
    vocabulary = [f"w{i}" for i in range(9)] + ["Éa", "日本"]
    some = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, some(rng.choice([3, 8, 12, 13, 14, 30]))) for i in range(12)] + [(50, None), (51, "  "), (52, "Lonely"), (53, "the " * 20), (3, some(13)), (None, some(13))]
    texts = [None, "", "lonely, LONELY x", "the " * 40, "b" * 300_000]
    for _ in range(40):
        text = some(rng.randrange(0, 60))
        if rng.random() < 0.7:
            words = (rng.choice(items)[1] or "").split()
            a = rng.randrange(0, max(1, len(words) - 10))
            text += " -- " + "  ".join(words[a : a + rng.randrange(5, 30)]).upper() + "! " + some(5)
        texts.append(text)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = by_id(decontaminate.decontaminate(docs(spark, texts), bench))
    windows = {}
    for item, text in items:
        w = words_of(text)
        n = min(13, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[k : k + n]), set()).add("" if item is None else str(item))
    for i, text in enumerate(texts):
        w, hit, found = words_of(text), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if own := windows.get(tuple(w[k : k + n])):
                    found |= own
                    hit.update(range(k, k + n))
        r = got[i]
        assert (r["n_words"], r["n_hit"], r["n_items"]) == (len(w), len(hit), len(found)), i
        assert r["items_sha256"] == hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        assert r["contaminated"] == (len(hit) > 0 and 20 * len(hit) >= len(w))
    assert decontaminate.decontaminate(docs(spark, []), bench).count() == 0
    assert Counter(r["n_hit"] for r in decontaminate.decontaminate(docs(spark, texts), bench.limit(0)).collect()) == {0: len(texts)}


def test_words_longer_than_a_piece(monkeypatch):
    text = "ab " + "c" * 1000 + " de " + "é" * 400 + " f"
    whole = decontaminate.word_hashes(text)
    monkeypatch.setattr(decontaminate, "PIECE", 100)
    assert decontaminate.word_hashes(text).tolist() == whole.tolist() and len(whole) == 5


def test_winnowing_guarantee():
    rng = np.random.default_rng(0)
    for _ in range(50):
        shared = rng.integers(0, 9, 13).astype(np.uint64)
        a, b = (np.concatenate([rng.integers(0, 9, 20).astype(np.uint64), shared, rng.integers(0, 9, 20).astype(np.uint64)]) for _ in range(2))
        fps = [decontaminate.winnowed(decontaminate.gram_hashes(x, 5), 9) for x in (a, b)]
        assert np.intersect1d(*fps).size


def test_null_ids_are_looked_up(spark):
    leak = " ".join(f"leak{i}" for i in range(20))
    bench = spark.createDataFrame([(1, leak)], "item_id long, text string")
    rows = spark.createDataFrame([(None, leak), (None, "clean words"), (3, leak), (3, "clean words")], "doc_id long, text string")
    got = Counter((r["doc_id"], r["n_hit"], r["contaminated"]) for r in decontaminate.decontaminate(rows, bench).collect())
    assert got == Counter([(None, 20, True), (None, 0, False), (3, 20, True), (3, 0, False)])


def test_shingles_do_not_depend_on_pieces(monkeypatch):
    rng = random.Random(6)
    texts = [b"", b" ", b"a", b"a ", b" a b ", b"a b c\n"] + [b"".join(rng.choice([b" ", b"\n ", b"ab", b"C", b"\t", b"word"]) for _ in range(rng.randrange(40))) for _ in range(300)]
    for text in texts:
        words = text.lower().split()
        plain = [xxhash.xxh64_intdigest(b" ".join(words[i : i + 3]), 42) for i in range(max(1, len(words) - 2))] if words else []
        for piece in range(1, 51):
            monkeypatch.setattr(simhash, "PIECE", piece)
            assert [int(h) for part in simhash.shingle_hashes(text) for h in part] == plain, (text, piece)


def test_fingerprint_of_a_text_of_several_pieces(spark):
    text = "".join(f"w{i} " for i in range(400_000))
    assert len(text) > 3 * simhash.PIECE // 2
    words = text.split()
    ones = np.zeros(64, int)
    for i in range(len(words) - 2):
        ones += np.unpackbits(np.frombuffer(xxhash.xxh64_digest(" ".join(words[i : i + 3]), 42), np.uint8))
    got = by_id(simhash.near_duplicates(docs(spark, [text, text[:-1], "a b c"])))
    want = np.packbits(2 * ones > len(words) - 2).tobytes().hex()
    assert got[0]["fingerprint"] == got[1]["fingerprint"] == want and got[1]["component_id"] == 0
