import hashlib
import random
import time

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F

from framelark.llm import chat, packing
from framelark.llm import sentencepiece_dropout as sp

TEXTS = ["", "   ", "▁ ▁▁a", "a\x00b", "日本語 テキスト 🎉🎉", "x" * 500, " " * 300 + "yz", "aaa" * 200 + " bbb", "\n\n\t tab", "The quick brown fox jumps over the lazy dog. " * 30]


@pytest.fixture(scope="module")
def pieces():
    with open(sp.MODEL, "rb") as f:
        return sp.Pieces(f.read())


def cut(pieces, texts, **options):
    ids, counts = sp.Encoder(pieces, **options).encode(list(range(len(texts))), texts)
    return np.split(ids, np.cumsum(counts)[:-1])


def test_encoding_is_lossless_and_varied(pieces):
    for dropout in (0.0, 0.1, 0.5, 1.0):
        for text, ids in zip(TEXTS, cut(pieces, TEXTS, dropout=dropout), strict=True):
            assert sp.decode_ids(pieces, ids) == text
    many = cut(pieces, ["internationalisation"] * 60, dropout=0.2)
    assert len({tuple(w) for w in many}) > 3  # the same word in several cuts
    assert [w.tolist() for w in cut(pieces, ["internationalisation"] * 60, dropout=0.2, seed=1)] != [w.tolist() for w in many]


def test_without_dropout_it_is_the_library(pieces):
    library = sentencepiece.SentencePieceProcessor(model_file=sp.MODEL)
    texts = ["Hello  world, this is plain text.", "naïve façade über", "1234567 numbers 3.14", "tabs\tand\nlines 日本 🎉"]
    for text, ids in zip(texts, cut(pieces, [" " + t for t in texts], dropout=0.0), strict=True):
        assert ids.tolist() == library.encode(text)


def test_words_in_step_are_words_alone(pieces):
    rng = random.Random(5)
    words = [" " + "".join(rng.choice("abcdeé日") for _ in range(rng.randrange(1, 20))) for _ in range(200)]
    size = np.array([len(w) for w in words])
    symbols = pieces.first[np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)]
    hashes, variant = sp.word_hashes(symbols, size), np.arange(len(words)) % 8
    flat, counts = sp.merged_in_step(pieces, symbols, size, hashes, variant, 7, 0.3)
    for i, part in enumerate(np.split(flat, np.cumsum(counts)[:-1])):
        own = np.split(symbols, np.cumsum(size)[:-1])[i]
        assert part.tolist() == sp.merged_alone(pieces, own, int(hashes[i]), int(variant[i]), 7, 0.3).tolist()


def test_forgetting_changes_nothing(pieces, monkeypatch):
    rng = random.Random(6)
    texts = [" ".join("".join(rng.choice("abcd") for _ in range(rng.randrange(1, 6))) for _ in range(200)) for _ in range(20)]
    a = [sp.Encoder(pieces).encode([i], [t])[0].tolist() for i, t in enumerate(texts)]
    monkeypatch.setattr(sp, "REMEMBERED", 300)
    one = sp.Encoder(pieces)
    assert [one.encode([i], [t])[0].tolist() for i, t in enumerate(texts)] == a


def test_each_occurrence_is_cut_by_itself(pieces, monkeypatch):
    many = cut(pieces, ["internationalisation"] * 3000)
    assert len({tuple(w) for w in many}) > 8
    for word in (" a", "in", "of"):  # one candidate, which a tenth of the occurrences skip
        counts = sp.Encoder(pieces).encode(list(range(20_000)), [word] * 20_000)[1]
        assert abs((counts > 1).mean() - sp.DROPOUT) < 0.01
    rng = random.Random(8)
    texts = [" ".join(rng.choice(["the", "there", "nation", "international", "日本語", "zqzq", "x" * 30, "ab" * 60]) for _ in range(400)) for _ in range(5)]
    remembered = [w.tolist() for w in cut(pieces, texts, dropout=0.3)]
    monkeypatch.setattr(sp, "OFTEN", 10**9)
    assert [w.tolist() for w in cut(pieces, texts, dropout=0.3)] == remembered


def test_null_ids_do_not_share_cuts(spark, pieces):
    word = "internationalisation"
    rows = spark.createDataFrame([(None, f"{word} {i}") for i in range(60)], "doc_id long, text string")
    cuts = set()
    for r in sp.encode(rows).select("ids").collect():
        ends = np.cumsum([len(pieces.bytes[i]) for i in r["ids"]])
        cuts.add(tuple(r["ids"][: int(np.searchsorted(ends, len(word))) + 1]))
    assert len(cuts) > 1


def test_encoding_in_spark(spark, monkeypatch):
    texts = [*TEXTS, None, None]
    rows = spark.createDataFrame([(i if i else None, t, "old") for i, t in enumerate(texts)], "doc_id long, text string, ids string")
    got = sp.encoded_and_checked(rows.repartition(4)).collect()
    assert len(got) == len(texts) and all(r["lossless"] for r in got)
    back = sp.encode(rows).select("text", sp.decoded(F.col("ids"), spark.sparkContext).alias("back")).collect()
    assert all(r["back"] == (r["text"] or "") for r in back)
    again = {r["doc_id"]: r["ids"] for r in sp.encode(rows.coalesce(1)).collect()}
    assert {r["doc_id"]: r["ids"] for r in got} == again
    assert sp.encode(rows.limit(0)).count() == 0
    assert sp.encode(rows.withColumn("extra", F.lit(1))).columns == ["doc_id", "text", "extra", "ids"]


def test_best_fit():
    rng = np.random.default_rng(2)
    for row in (7, 64):
        lengths = rng.integers(1, row + 1, 200)
        rows = packing.best_fit_decreasing(lengths, row)
        assert sorted(i for r in rows for i in r) == list(range(200))
        free, want = [], []
        for i in np.argsort(-lengths, kind="stable").tolist():
            fits = [f for f in free if f >= lengths[i]]
            if fits:
                free.remove(min(fits))
                free.append(min(fits) - lengths[i])
            else:
                free.append(row - lengths[i])
        want = sorted(free)
        assert sorted(row - lengths[r].sum() for r in rows) == want


def test_packed_rows_hold_every_token(spark, tmp_path):
    texts = [*TEXTS, None, "long text here " * 3000]
    rows = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, ids string").repartition(2)
    packing.write_packed(packing.pack_tokens(rows, row=64, group=500), str(tmp_path / "packed"))
    found = {}
    for r in spark.read.parquet(str(tmp_path / "packed")).collect():
        ids = packing.matrix([r["ids"]])[0]
        assert len(ids) == 64 and r["cu_seqlens"][0] == 0 and r["cu_seqlens"][-1] == r["n_tokens"] and r["position_resets"] == r["cu_seqlens"][:-1]
        assert (ids[r["n_tokens"] :] == packing.END).all() and r["n_segments"] == len(r["doc_ids"])
        for doc, start, a, b in zip(r["doc_ids"], r["doc_starts"], r["cu_seqlens"], r["cu_seqlens"][1:], strict=False):
            found.setdefault(doc, {})[start] = ids[a:b]
    with open(packing.VOCABULARY, "rb") as f:
        encoding = packing._encoding(f.read())
    for i, text in enumerate(texts):
        ids = np.concatenate([found[i][k] for k in sorted(found[i])])
        assert ids.tolist() == [*encoding.encode_ordinary(text or ""), packing.END]
    assert packing.pack_tokens(rows.limit(0)).count() == 0
    assert "".join(p for p, _ in packing.pieces("a b\n" * 1000, 37)) == "a b\n" * 1000


CONTROL = ["</s>", "<s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "[NEXT]", "[ROLE]", "[/ROLE]", "␛", "␛␛", "[", "<", "\n", " ", "ok", "[␛INST]"]


def test_chat_is_read_back(spark):
    rng = random.Random(9)
    text = lambda: rng.choice([None, "", "".join(rng.choice(CONTROL) for _ in range(rng.randrange(12)))])
    rows = [(c if c else None, t, rng.choice(["user", "assistant", "system", "tool", "odd [/ROLE] <s>", "two\nlines␛␊", "␛\n␊\n", None]), text(), "x") for c in range(40) for t in range(rng.randrange(1, 9))]
    rows += [(99, 1, "user", "b", ""), (99, 1, "user", "a", ""), (99, None, "assistant", "first", ""), (98, 1, "assistant", "long " * 100_000, "")]
    got = {r["conv_id"]: r for r in chat.digests(chat.format_chat(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, turns string").repartition(3))).collect()}
    for c in {r[0] for r in rows}:
        own = sorted(((t is not None, t or 0, role or "", x or "") for cc, t, role, x, _ in rows if cc == c))
        joined = "".join(f"{role}\n{x}\n" for *_, role, x in own)
        loss = "".join(x for *_, role, x in own if role == "assistant")
        r = got[c]
        assert r["n_turns"] == len(own)
        assert r["turns_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert (r["loss_chars"], r["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.format_chat(empty).count() == 0
    assert {r["conv_id"] for r in chat.digests(chat.format_chat(chat.with_planted(spark, empty))).collect()} == {-1}


def test_spans_are_code_points_and_bytes(spark):
    rows = [(1, 0, "user", "é<s>"), (1, 1, "assistant", "日本 </s> x"), (1, 2, "assistant", ""), (1, 3, "odd\nrole", "y"), (1, 4, "assistant", "end 🎉")]
    r = chat.format_chat(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).first()
    text, data = r["formatted"], r["formatted"].encode()
    want = ["日本 <␛/s> x", "", "end 🎉"]
    assert [text[s["start"] : s["start"] + s["length"]] for s in r["loss_spans"]] == want
    assert [data[s["byte_start"] : s["byte_start"] + s["n_bytes"]].decode() for s in r["loss_spans"]] == want


def test_sums_before(spark):
    for n in (0, 1, 4, 5, 23):
        numbers = [k * k % 7 for k in range(n)]
        got = spark.range(1).select(chat.sums_before(F.lit(numbers).cast("array<bigint>"), 5).alias("s")).first()["s"]
        assert got == [sum(numbers[:k]) for k in range(n)]


def test_long_chats_take_linear_time(spark):
    def seconds(n):
        rows = spark.range(n).select(F.lit(1).alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"), F.concat(F.lit("é </s> "), F.col("id").cast("string")).alias("text"))
        began = time.time()
        r = chat.digests(chat.format_chat(rows)).first()
        assert r["n_turns"] == n and r["loss_chars"] == sum(len(f"é </s> {i}") for i in range(1, n, 2))
        return time.time() - began

    seconds(100)
    assert seconds(50_000) < 12 * max(seconds(10_000), 0.5)


def test_adjacent_turns_share_a_block(spark):
    rows = [(1, 0, "user", "a"), (1, 1, "user", "b"), (1, 2, "assistant", "c")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert chat.format_chat(df).first()["formatted"] == "<s>[INST] a[NEXT]b [/INST] c</s>"


def test_ids_do_not_depend_on_pieces(monkeypatch):
    """Every size of pieces and of runs, on texts with white space of all kinds at either end and inside, and long words."""
    with open(packing.VOCABULARY, "rb") as f:
        encoding = packing._encoding(f.read())
    rng = random.Random(8)
    bits = [" ", "  ", "\n", "\n\n", "\t ", "\x1c", "\x85", "\u3000", "\u200b", "it's", "'", "12", "word", "naïve", "日本", "x" * 30, "!?", " " * 40, "\n" * 40]
    texts = ["", " ", "\n" * 50, "x" * 60] + ["".join(rng.choice(bits) for _ in range(rng.randrange(30))) for _ in range(150)]
    for text in texts:
        whole = encoding.encode_ordinary(text)
        for size in range(1, 51):
            parts = list(packing.pieces(text, size, 1 + size % 7))
            assert "".join(p for p, _ in parts) == text
            assert [i for p, alone in parts for i in (encoding._encode_single_piece(p) if alone else encoding.encode_ordinary(p))] == whole, (text, size)


@pytest.mark.parametrize("text", [" " * 2_000_000, "\n" * 2_000_000, "a" * 2_000_000, "b" + " " * 1_500_000 + "\n" * 700_000 + "c"])
def test_very_long_runs(text):
    with open(packing.VOCABULARY, "rb") as f:
        encoding = packing._encoding(f.read())
    ids = packing.token_ids(encoding, text)
    assert ids[-1] == packing.END and encoding.decode(ids[:-1].tolist()) == text


def test_packing_with_other_ids(spark):
    rows = packing.pack_tokens(spark.createDataFrame([("a", "x y"), (None, None)], "doc_id string, text string").repartition(1)).collect()
    assert sorted(map(str, rows[0]["doc_ids"])) == ["None", "a"]
