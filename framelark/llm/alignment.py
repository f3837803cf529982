"""Cross-tokenizer alignment: where two tokenizers' tokens of one text end together, and which ids do so most."""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from framelark.llm.common import checkpointed, written

BYTE_BPE, PIECE_BPE = "/opt/tokenizers/byte_bpe_50k.json", "/opt/tokenizers/piece_bpe_32k.model"
#: Pairs that hold at least one in so many of all links are looked up in a broadcast table, so of that many rows at most.
HEAVY = 1 << 16
#: A pair is the first tokenizer's id and then B_BITS bits of the second one's.
B_BITS = 16
#: Chunks that a task remembers, the longest of them in characters, and characters of texts that are aligned together.
REMEMBERED, LONGEST, AT_ONCE = 300_000, 64, 1 << 20
#: A chunk ends before a space or line feed that follows none of: white space, what some hold for it, and U+2581.
CHUNK = re.compile("[\\s\\S][^ \n]*(?:(?<=[\\s▁\u180e])[ \n][^ \n]*)*")
NO_BORDER = re.compile("[\\s▁\u180e][ \n]")
#: Of each byte, whether no token ends there, one of A, one of B, or one of both; a span reaches to the next "both".
LABELS = bytes.maketrans(b"\0\1\2\3", b".ABX")
SPAN = re.compile(rb"[AB]*X")


def byte_values() -> dict[str, int]:
    """What a byte-level vocabulary writes for each byte: printable ones themselves, the others characters from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(0x100 + i): b for i, b in enumerate(others)}


class Pair:
    """Two tokenizers, A byte-level BPE and B pieces, with what their ids stand for in bytes."""

    def __init__(self, a: bytes, b: bytes):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # tasks are parallel enough
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(a.decode())
        self.a.encode_special_tokens = True  # their strings in a text are text
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b)
        value = byte_values()
        self.a_bytes = [b""] * self.a.get_vocab_size()
        for token, i in self.a.get_vocab().items():
            self.a_bytes[i] = bytes(value[c] for c in token) if all(c in value for c in token) else token.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        if len(pieces) > 1 << B_BITS:
            raise ValueError(f"the second vocabulary has over {1 << B_BITS} ids")
        self.a_sizes, self.b_sizes = (np.array([len(t) for t in of], np.int64) for of in (self.a_bytes, self.b_bytes))
        # how each id is written: A's followed by a comma or, at the end of its part of a group, a bar; B's by a comma or semicolon
        self.names = [f"{i}{end}" for n, ends in ((len(self.a_bytes), ",|"), (len(pieces), ",;")) for i in range(n) for end in ends]
        self.name_sizes = np.array([len(x) for x in self.names], np.int64)
        self.b_from = 2 * len(self.a_bytes)
        self.space = self.b.piece_to_id("▁")
        # Texts may be cut into chunks if no token of A crosses a border between other characters and white space after them,
        # and no piece of B one before a space or line feed.
        shape = json.loads(a)
        own = shape.get("pre_tokenizer") or {}
        byte_level = own.get("type") == "ByteLevel" and own.get("use_regex", True) and not own.get("add_prefix_space") and not shape.get("normalizer")
        self.in_chunks = bool(byte_level) and not any("▁" in p.lstrip("▁") or "\n" in p for p in pieces)

    def chunks(self, text: str) -> Iterator[list[str]]:
        """The parts of space+text that can be encoded alone, some at a time. A part's first space is left out, unless it is
        followed by white space."""
        if not self.in_chunks:
            yield [text if text[:1] not in (" ", "\n") else " " + text]
            return
        text = " " + text
        if len(text) <= AT_ONCE and not NO_BORDER.search(text):  # each space and line feed starts a chunk
            lines = text[1:].split("\n")
            out = lines[0].split(" ")
            for line in lines[1:]:
                first, *rest = line.split(" ")
                out.append("\n" + first)
                out += rest
            yield out
            return
        found = (m[0] for m in CHUNK.finditer(text))
        while some := list(islice(found, AT_ONCE // 8)):
            yield [c[1:] if c[0] == " " and not c[1:2].isspace() else c for c in some]

    def can_follow(self, chunk: str) -> bool:
        """Whether chunk can stand in a row with others and be encoded with them as one text."""
        return self.in_chunks and chunk[0] in " \n" and chunk[-1] not in "▁\u180e" and not chunk[-1].isspace() and "▁" not in chunk

    def aligned(self, chunks: list[str]) -> tuple[np.ndarray, list[str], np.ndarray] | None:
        """Of chunks that can follow one another: n_a, n_b and n_groups of each, its groups as text, and the linked pairs of
        all; None if the tokens don't spell them."""
        text = "".join(chunks)
        data = text.encode()
        a = self.a.encode_batch_fast([text], add_special_tokens=False)[0].ids
        # B puts a space before what it encodes: the text's own, or one that is taken off again
        b = self.b.encode(text[1:]) if text[0] == " " else self.b.encode(text)[1:]
        if text == " ":  # B doesn't put a space before an empty text
            b = [self.space]
        if b"".join([self.a_bytes[i] for i in a]) != data or b"".join([self.b_bytes[i] for i in b]) != data:
            return None
        a, b = np.array(a, np.int64), np.array(b, np.int64)
        a_ends, b_ends = np.cumsum(self.a_sizes[a]), np.cumsum(self.b_sizes[b])
        labels = np.zeros(len(data) + 1, np.uint8)
        labels[a_ends] += 1
        labels[b_ends] += 2
        spans = SPAN.findall(labels.tobytes().translate(LABELS, b"\0"))
        n, m = (np.array([s.count(mark) for s in spans], np.int64) + 1 for mark in (b"A", b"B"))
        last_a, last_b = np.cumsum(n) - 1, np.cumsum(m) - 1
        # what to write, token by token, a group's tokens of A before those of B
        written_a, written_b = 2 * a, 2 * b + self.b_from
        written_a[last_a] += 1
        written_b[last_b] += 1
        group = np.concatenate([np.repeat(np.arange(len(n)), n) * 2, np.repeat(np.arange(len(m)), m) * 2 + 1])
        ids = np.concatenate([written_a, written_b])[np.argsort(group, kind="stable")]
        out = "".join(map(self.names.__getitem__, ids.tolist()))
        # chunks end where a token of both does
        ends = np.cumsum([len(c.encode()) for c in chunks])
        in_a, in_b, of = (np.searchsorted(e, ends, "right") for e in (a_ends, b_ends, a_ends[last_a]))
        at = np.concatenate([[0], np.cumsum(self.name_sizes[ids])])[in_a + in_b].tolist()
        sizes = np.diff(np.stack([in_a, in_b, of], 1), axis=0, prepend=0)
        return sizes, [out[i : j - 1] for i, j in zip([0, *at], at, strict=False)], a[last_a] << B_BITS | b[last_b]


class Memory:
    """What chunks were aligned to. Words recur, so most chunks are found here; it is emptied when it is full."""

    def __init__(self, pair: Pair):
        self.pair = pair
        self.forget()

    def forget(self) -> None:
        self.place: dict[str, int] = {}
        self.groups: list[str | None] = []
        self.sizes, self.pairs, self.ends = np.zeros((0, 3), np.int64), np.zeros(0, np.int64), np.zeros(1, np.int64)

    def places(self, lists: list[list[str]]) -> list[np.ndarray]:
        """For each list of chunks, where groups, sizes and pairs have them."""
        if len(self.place) > REMEMBERED:
            self.forget()
        missing = list({c for chunks in lists for c in chunks}.difference(self.place))
        whole = [c if c[:1] in (" ", "\n") and c else " " + c for c in missing]
        follow = [self.pair.can_follow(c) for c in whole]
        self._learn([c for c, f in zip(missing, follow, strict=True) if f], [c for c, f in zip(whole, follow, strict=True) if f])
        for c, w, f in zip(missing, whole, follow, strict=True):
            if not f:
                self._learn([c], [w])
        self.ends = np.concatenate([[0], np.cumsum(self.sizes[:, 2])])
        out = [np.array([self.place[c] for c in chunks], np.int64) for chunks in lists]
        for c in missing:
            if len(c) > LONGEST:
                del self.place[c]
        return out

    def _learn(self, names: list[str], chunks: list[str]) -> None:
        if not names:
            return
        found = self.pair.aligned(chunks)
        if found is None and len(names) > 1:
            for name, chunk in zip(names, chunks, strict=True):
                self._learn([name], [chunk])
            return
        sizes, groups, pairs = found or (np.zeros((1, 3), np.int64), [None], np.zeros(0, np.int64))
        self.place.update(zip(names, range(len(self.groups), len(self.groups) + len(names)), strict=True))
        self.groups += groups
        self.sizes, self.pairs = np.concatenate([self.sizes, sizes]), np.concatenate([self.pairs, pairs])

    def pairs_of(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The linked pairs of chunks, and how many each chunk has."""
        n = self.sizes[places, 2]
        within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        return self.pairs[np.repeat(self.ends[places], n) + within], n


class Text:
    """A text's sums so far; spelt: whether all its tokens spell it."""

    def __init__(self) -> None:
        self.n_a = self.n_b = self.n_groups = 0
        self.spelt, self.digest = True, hashlib.sha256()
        self.pairs, self.counts = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, memory: Memory, places: np.ndarray) -> None:
        groups = [memory.groups[i] for i in places.tolist()]
        if None in groups:
            self.spelt = False
            return
        self.digest.update(((";" if self.n_groups else "") + ";".join(groups)).encode())
        sums = memory.sizes[places].sum(0).tolist()
        self.n_a, self.n_b, self.n_groups = self.n_a + sums[0], self.n_b + sums[1], self.n_groups + sums[2]
        pairs, _ = memory.pairs_of(places)
        self.pairs, place = np.unique(np.concatenate([self.pairs, pairs]), return_inverse=True)
        weights = np.concatenate([self.counts, np.ones(len(pairs), np.int64)])
        self.counts = np.bincount(place, weights, len(self.pairs)).astype(np.int64)

    def row(self) -> tuple[int, int, int, str, np.ndarray, np.ndarray]:
        if not self.spelt or not self.n_groups:
            return 0, 0, 0, "", np.zeros(0, np.int64), np.zeros(0, np.int64)
        return self.n_a, self.n_b, self.n_groups, self.digest.hexdigest(), self.pairs, self.counts


def align(memory: Memory, texts: list[str | None]) -> list[tuple[int, int, int, str, np.ndarray, np.ndarray]]:
    """For each text n_a, n_b, n_groups, the groups' SHA-256, the distinct linked pairs and how many links each has."""
    out = [Text() for _ in texts]
    held: list[tuple[Text, list[str]]] = []
    n = 0

    def add() -> None:
        for (text, _), places in zip(held, memory.places([chunks for _, chunks in held]), strict=True):
            text.add(memory, places)
        held.clear()

    for one, text in zip(out, texts, strict=True):
        for chunks in memory.pair.chunks(text) if text else ():
            held.append((one, chunks))
            n += sum(map(len, chunks))
            if n > AT_ONCE:
                add()
                n = 0
    add()
    return [one.row() for one in out]


def _flat(lists: list[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    ends = np.cumsum([0, *(len(x) for x in lists)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(lists) if lists else [], kind))


def _aligned(docs: DataFrame, a: bytes, b: bytes) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast((a, b))  # two vocabularies, some megabytes
    schema = T.StructType([docs.schema["doc_id"], *T.StructType.fromDDL("n_a long, n_b long, n_groups long, groups_sha256 string, pairs array<long>, counts array<long>").fields])

    def aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = Memory(Pair(*shared.value))
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                n_a, n_b, n_groups, sha, pairs, counts = zip(*align(memory, part.column(1).to_pylist()), strict=True)
                columns = [part.column(0), *(pa.array(x, pa.int64()) for x in (n_a, n_b, n_groups)), pa.array(sha, pa.string()), _flat(pairs, pa.int64()), _flat(counts, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, schema.names)

    return docs.mapInArrow(aligned, schema)


def pair_counts(links: DataFrame) -> DataFrame:
    """(pair, n, best): how many links of all rows hold a pair, and whether no pair of its B id has more."""
    each = links.select(F.explode(F.arrays_zip("pairs", "counts")).alias("x")).groupBy(F.col("x.pairs").alias("pair")).agg(F.sum("x.counts").alias("n"))
    counts = checkpointed(each.withColumn("b", F.col("pair").bitwiseAND((1 << B_BITS) - 1)))
    most = counts.groupBy("b").agg(F.max("n").alias("most"))  # as many rows as B has ids, 2^B_BITS at most
    return checkpointed(counts.join(F.broadcast(most), "b").select("pair", "n", (F.col("n") == F.col("most")).alias("best")))


_LOOKED = "n_best long, count_sum long, light array<long>, light_counts array<long>"


def _looked_up(links: DataFrame, heavy: tuple[np.ndarray, np.ndarray, np.ndarray]) -> DataFrame:
    """links with n_best and count_sum of their heavy pairs; the others are left in light and light_counts."""
    shared = links.sparkSession.sparkContext.broadcast(heavy)  # HEAVY rows at most
    rest = [c for c in links.columns if c not in ("pairs", "counts")]
    schema = T.StructType([*(links.schema[c] for c in rest), *T.StructType.fromDDL(_LOOKED).fields])

    def looked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, n, best = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            flat = [batch.column(batch.schema.get_field_index(c)) for c in ("pairs", "counts")]
            sizes = flat[0].value_lengths().to_numpy(zero_copy_only=False)
            pairs, counts = (f.flatten().to_numpy(zero_copy_only=False) for f in flat)
            row = np.repeat(np.arange(batch.num_rows), sizes)
            at = np.minimum(np.searchsorted(key, pairs), max(len(key) - 1, 0))
            hit = key[at] == pairs if len(key) else np.zeros(len(pairs), bool)
            own, of = counts[hit], at[hit]
            n_best, count_sum = np.zeros((2, batch.num_rows), np.int64)
            np.add.at(n_best, row[hit], own * best[of])
            np.add.at(count_sum, row[hit], own * n[of])
            ends = pa.array(np.concatenate([[0], np.cumsum(np.bincount(row[~hit], minlength=batch.num_rows))]), pa.int32())
            light = [pa.ListArray.from_arrays(ends, pa.array(x[~hit], pa.int64())) for x in (pairs, counts)]
            columns = [*(batch.column(batch.schema.get_field_index(c)) for c in rest), pa.array(n_best), pa.array(count_sum), *light]
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    return links.mapInArrow(looked, schema)


def alignment(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", a: str = BYTE_BPE, b: str = PIECE_BPE, heavy: int = HEAVY) -> DataFrame:
    """One row for each row of docs: id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    A encodes space+text, B text, before which it puts a space itself. Each byte gets a label: no token ends there, one of A,
    one of B, or of both; spans up to each "both" are the groups, and the two tokens that end there are a link. A link's
    count is how many links of all rows have its two ids; it is a best one if no pair of its B id has a higher count.

    Texts are aligned in chunks: no token crosses the border before a space or line feed that follows something else
    (checked on both vocabularies; if one has such tokens, texts are encoded whole). So a task aligns each word once.
    Counts go over all rows. Pairs with at least one in `heavy` of all links, of which there are `heavy` at most, are
    broadcast; the few occurrences of the others meet their counts in a shuffle.

    Null and empty texts have no tokens, nor have texts that the tokens of A or B don't spell: zeros and ''. Null ids stay
    null, repeated rows each count. No rows give no rows. Other columns are ignored. A text without spaces and line feeds
    is one chunk, however long."""
    with open(a, "rb") as f, open(b, "rb") as g:
        vocabularies = f.read(), g.read()
    links = _aligned(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), *vocabularies)
    links = written(links.withColumn("row", F.monotonically_increasing_id()), "links")
    counts = pair_counts(links)
    total = counts.agg(F.sum("n")).first()[0] or 0
    is_heavy = F.col("n") * heavy >= F.lit(total)
    found = sorted((r["pair"], r["n"], r["best"]) for r in counts.filter(is_heavy).collect())  # `heavy` rows at most
    table = tuple(np.array([r[i] for r in found], np.int64) for i in range(3))
    looked = checkpointed(_looked_up(links, table))
    some = F.size("light") > 0
    light = looked.filter(some).select("row", F.explode(F.arrays_zip("light", "light_counts")).alias("x")).select("row", F.col("x.light").alias("pair"), F.col("x.light_counts").alias("k"))
    sums = light.join(counts.filter(~is_heavy), "pair").groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("k")).otherwise(0)).alias("more_best"), F.sum(F.col("k") * F.col("n")).alias("more_sum"))
    late = looked.filter(some).join(sums, "row").withColumns({"n_best": F.col("n_best") + F.col("more_best"), "count_sum": F.col("count_sum") + F.col("more_sum")})
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_best", "count_sum", "groups_sha256"]
    out = looked.filter(~some).select(*names).unionByName(late.select(*names))
    return out.select(F.col("doc_id").alias(id_col), "n_a", "n_b", "n_groups", F.col("n_groups").alias("n_links"), "n_best", "count_sum", "groups_sha256")
