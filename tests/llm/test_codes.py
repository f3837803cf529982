"""Fingerprints, alignment and vector codes against brute force."""

import hashlib
import math
import random
from collections import Counter

import numpy as np
import pytest

from framelark.llm import alignment, fingerprint, vector_codes

DOCS = "doc_id long, text string, next string, row string, pairs string, kind string, task string"
ODD = [None, "", " ", "a", "ab", "abc", "abc", "naïve ﬁ 日本 🎉", "x y " * 30_000, "x y " * 30_000, "<|endoftext|> </s>", "a ▁ b", "  two  spaces \n\n\tend ", "don't 5's\r\n", "a\u0000b"]


def docs(spark, texts, ids=None, parts=3):
    """Rows with extra columns whose names the operators use themselves."""
    ids = range(len(texts)) if ids is None else ids
    return spark.createDataFrame([(i, t, "a", "b", "c", "d", "e") for i, t in zip(ids, texts, strict=True)], DOCS).repartition(parts)


def brute_digest(text):
    data, counts = text.encode(), [0] * 512
    for i in range(len(data) - 2):
        counts[int.from_bytes(data[i : i + 3], "big") * fingerprint.FACTOR % 2**32 >> 23] += 1
    low, mid, high = (sorted(counts)[k * 128 - 1] for k in (1, 2, 3))
    return fingerprint.length_code(len(data)), [(c > low) + (c > mid) + (c > high) for c in counts]


def alike(a, b):
    return 1 - (sum(abs(x - y) for x, y in zip(a[1], b[1], strict=True)) + 32 * min(abs(a[0] - b[0]), 16)) / 2048


def written(digest):
    return f"{digest[0]:02x}" + "".join(f"{a << 6 | b << 4 | c << 2 | d:02x}" for a, b, c, d in zip(*[iter(digest[1])] * 4, strict=True))


@pytest.mark.parametrize("parts", [1, 5])
def test_fingerprints(spark, parts):
    rng = random.Random(3)
    texts = ODD + ["".join(rng.choice("abc é\n") for _ in range(rng.randrange(80))) for _ in range(60)]
    ids = [3 * i for i in range(len(texts))]
    got = {r["doc_id"]: r for r in fingerprint.fingerprints(docs(spark, texts, ids, parts)).collect()}
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        text, after, r = text or "", texts[(i + 1) % len(texts)] or "", got[3 * i]
        new = text[: len(text) - len(text) // 2] + after[: len(text) // 2]
        own, of_new, of_next = map(brute_digest, (text, new, after))
        assert r["n_chars"] == len(text) and r["edited_sha256"] == hashlib.sha256(new.encode()).hexdigest()
        assert (r["fingerprint"], r["edited_fingerprint"]) == (written(own), written(of_new))
        assert (r["near_edited"], r["near_next"]) == (alike(own, of_new), alike(own, of_next))


def test_fingerprints_of_few_repeated_and_nameless_rows(spark):
    assert fingerprint.fingerprints(docs(spark, [])).count() == 0
    (one,) = fingerprint.fingerprints(docs(spark, ["abcdef"])).collect()
    assert one["near_next"] == 1 and one["edited_sha256"] == hashlib.sha256(b"abcabc").hexdigest()
    got = fingerprint.fingerprints(docs(spark, ["same text"] * 40 + ["other", "else"], [None] * 30 + [7] * 11 + [1])).collect()
    assert Counter(r["doc_id"] for r in got) == {None: 30, 7: 11, 1: 1}
    assert sum(r["near_next"] < 1 for r in got) in (3, 4)  # "other" stands first or after some of its id


def test_counts_do_not_depend_on_pieces():
    data = random.Random(1).randbytes(5000)
    for piece in (1, 2, 3, 7, 1000, 4998, 10_000):
        assert (fingerprint.counted(data, piece) == fingerprint.counted(data)).all()
    assert [fingerprint.length_code(n) for n in (0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 1 << 40)] == [0, 0, 4, 6, 8, 9, 10, 11, 12, 13, 160]


@pytest.fixture(scope="module")
def pair():
    with open(alignment.BYTE_BPE, "rb") as f, open(alignment.PIECE_BPE, "rb") as g:
        return alignment.Pair(f.read(), g.read())


def whole_text(pair, text):
    """n_a, n_b, groups, links by id pair, from the libraries' tokens of the whole text."""
    nothing = (0, 0, "", Counter())
    if not text:
        return nothing
    a, b = pair.a.encode(" " + text, add_special_tokens=False).ids, pair.b.encode(text)
    if b"".join(pair.a_bytes[i] for i in a) != (" " + text).encode() or b"".join(pair.b_bytes[i] for i in b) != (" " + text).encode():
        return nothing
    ends = [dict(zip(np.cumsum([len(of[i]) for i in ids]).tolist(), range(1, len(ids) + 1), strict=True)) for ids, of in ((a, pair.a_bytes), (b, pair.b_bytes))]
    groups, links, i, j = [], Counter(), 0, 0
    for end in sorted(ends[0].keys() & ends[1].keys()):
        m, n = ends[0][end], ends[1][end]
        groups.append(",".join(map(str, a[i:m])) + "|" + ",".join(map(str, b[j:n])))
        links[a[m - 1], b[n - 1]] += 1
        i, j = m, n
    return len(a), len(b), ";".join(groups), links


@pytest.mark.parametrize("heavy", [1 << 16, 3, 0])
def test_alignment(spark, pair, heavy):
    """Also where most pairs, or all, are too rare for the broadcast table."""
    rng = random.Random(5)
    texts = ODD + ["".join(rng.choice(["the ", "naïve", " ", "\n", "\t", "12", "'s", "▁" if k % 9 == 0 else "ing", "日本", "᠎", " A"]) for _ in range(rng.randrange(40))) for k in range(120)]
    got = {r["doc_id"]: r for r in alignment.alignment(docs(spark, texts), heavy=heavy).collect()}
    right = [whole_text(pair, t) for t in texts]
    counts = sum((r[3] for r in right), Counter())
    best = {}
    for (_, b), n in counts.items():
        best[b] = max(best.get(b, 0), n)
    assert sum(not r[0] for r in right) < len(texts) / 3
    for i, (n_a, n_b, groups, links) in enumerate(right):
        r = got[i]
        n = groups.count(";") + 1 if groups else 0
        assert (r["n_a"], r["n_b"], r["n_groups"], r["n_links"]) == (n_a, n_b, n, n), texts[i]
        assert r["groups_sha256"] == (hashlib.sha256(groups.encode()).hexdigest() if groups else "")
        assert r["n_best"] == sum(k for p, k in links.items() if counts[p] == best[p[1]])
        assert r["count_sum"] == sum(k * counts[p] for p, k in links.items())


def test_alignment_without_chunks_and_with_little_memory(pair, monkeypatch):
    texts = ODD + ["a b c d e f g"]
    right = [alignment.align(alignment.Memory(pair), [t])[0][:4] for t in texts]
    monkeypatch.setattr(alignment, "AT_ONCE", 16)
    monkeypatch.setattr(alignment, "REMEMBERED", 2)
    assert [r[:4] for r in alignment.align(alignment.Memory(pair), texts)] == right
    monkeypatch.setattr(pair, "in_chunks", False)
    assert [r[:4] for r in alignment.align(alignment.Memory(pair), texts)] == right


def test_alignment_of_nothing(spark):
    assert alignment.alignment(docs(spark, [])).count() == 0
    got = alignment.alignment(docs(spark, ["a b", "a b", None], [None, None, 4])).collect()
    assert sorted((str(r["doc_id"]), r["n_links"], r["n_best"], r["count_sum"]) for r in got) == [("4", 0, 0, 0), ("None", 2, 2, 4), ("None", 2, 2, 4)]


VECTORS = "vec_id long, embedding array<double>, label string, q string, key string, code string"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, label, "x", "y", "z") for i, v, label in rows], VECTORS).repartition(3)


def brute_codes(rows):
    kept = sorted(((i is None, i or 0, v), label, v) for i, v, label in rows if v and all(x is not None and math.isfinite(x) for x in v))
    q = [[math.floor(x * 1024) for x in v] for _, _, v in kept]
    d = len(q[0]) // 4
    codes, errors, books = [[] for _ in q], [0] * len(q), []
    for p in range(4):
        parts = [v[p * d : (p + 1) * d] for v in q]
        book = parts[:256]
        for again in range(5):
            own = [min((sum((x - y) ** 2 for x, y in zip(v, e, strict=True)), k) for k, e in enumerate(book)) for v in parts]
            if again < 4:
                for k in range(len(book)):
                    mine = [v for v, (_, j) in zip(parts, own, strict=True) if j == k]
                    book[k] = [sum(c) // len(mine) for c in zip(*mine, strict=True)] if mine else book[k]
        books += [x for e in book for x in e]
        for i, (error, k) in enumerate(own):
            codes[i].append(k)
            errors[i] += error
    label_errors = Counter()
    for (_, label, _), e in zip(kept, errors, strict=True):
        label_errors[label] += e
    sha = hashlib.sha256(",".join(map(str, books)).encode()).hexdigest()
    return sorted((str(key[1] if not key[0] else None), "".join(f"{k:02x}" for k in c), e, label_errors[label], sha) for (key, label, _), c, e in zip(kept, codes, errors, strict=True))


@pytest.mark.parametrize(("n", "steps", "large"), [(40, 3, 1.0), (400, 4, 1.0), (330, 1000, 30_000.0)])
def test_vector_codes(spark, n, steps, large):
    """Many ties; components that double precision can't square exactly; null and repeated ids, null labels, unusable vectors."""
    rng = random.Random(n)
    rows = [(rng.choice([None, *range(n)]), [rng.randrange(-steps, steps) * large / steps for _ in range(8)], rng.choice(["a", "b", None])) for _ in range(n)]
    rows += [(1, None, "a"), (2, [1.0] * 7 + [None], "a"), (3, [1.0] * 7 + [float("nan")], "b"), (4, [1.0] * 7 + [float("-inf")], "b"), (5, [], "b")]
    got = vector_codes.vector_codes(vectors(spark, rows)).collect()
    assert sorted((str(r["vec_id"]), r["code"], r["error"], r["label_error"], r["codebooks_sha256"]) for r in got) == brute_codes(rows)


def test_vectors_of_other_lengths_and_sizes(spark):
    rows = [(1, [0.0] * 8, "a"), (2, [1.0] * 4, "a"), (3, [1.0] * 6, "a"), (4, [1e300] * 8, "b"), (5, [-1e30] * 8, "b")]
    got = {r["vec_id"]: r for r in vector_codes.vector_codes(vectors(spark, rows)).collect()}
    assert set(got) == {1, 4, 5} and all(r["error"] == 0 for r in got.values())
    rows = [(i, [float(i)] * 8, "a") for i in range(256)] + [(900, [1e30] * 8, "a"), (901, [-1e300] * 8, "b")]
    got = {r["vec_id"]: r for r in vector_codes.vector_codes(vectors(spark, rows), rounds=0).collect()}
    assert got[900]["error"] is None and got[900]["label_error"] is None and got[3]["error"] == 0
    assert vector_codes.vector_codes(vectors(spark, [(1, None, "a")])).count() == 0


def test_balls_hold_their_entries_and_prune():
    rng = np.random.default_rng(2)
    entries = rng.integers(-300, 300, (256, 16))
    book = vector_codes.Codebook([tuple(map(int, e)) for e in entries])
    q = rng.integers(-400, 400, (500, 16))
    at, error = book.nearest(q)
    distances = ((q[:, None] - entries) ** 2).sum(2)
    assert (at == distances.argmin(1)).all() and (error == distances.min(1)).all()

    def check(ball):
        least = ball.least(q.astype(float))
        assert (least[:, None] <= distances[:, ball.own]).all()
        for half in ball.halves or ():
            check(half)
        assert ball.halves is None or sorted(np.concatenate([h.own for h in ball.halves])) == sorted(ball.own)

    check(book.tree)
