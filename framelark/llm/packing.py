"""Token ids packed into rows of fixed length: best-fit decreasing, with the fitting row found in a segment tree."""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: how the vocabulary's texts were cut before merging.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
END = 50256
ROW = 2048
#: Tokens of the documents that are packed together; a task holds about so many at once.
GROUP = 4_000_000
#: Characters that are tokenised at once, or more up to the next border: white space after something else. No token crosses it.
PIECE = 1 << 20
#: Runs of white space of so many characters are encoded without the pattern, which can't match runs of a million.
RUN = 100_000
#: What the pattern takes for white space.
WHITE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_BORDER = re.compile(f"(?<=[^\\s{WHITE}])[{WHITE}]")

SCHEMA = "doc_starts array<int>, ids binary, cu_seqlens array<int>, position_resets array<int>, n_tokens int, n_segments int"


class Capacities:
    """Open rows by free capacity. A segment tree over capacities counts the rows, so the tightest fit takes log(row) steps."""

    def __init__(self, row: int):
        self.leaves = 1 << row.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.rows: list[list[int]] = [[] for _ in range(row + 1)]

    def _add(self, free: int, by: int) -> None:
        i = free + self.leaves
        while i:
            self.count[i] += by
            i >>= 1

    def put(self, free: int, which: int) -> None:
        self.rows[free].append(which)
        self._add(free, 1)

    def tightest(self, need: int) -> int | None:
        """Takes out a row of the smallest capacity that is at least need; the last one put there."""
        i = need + self.leaves
        if not self.count[i]:
            while i > 1 and (i & 1 or not self.count[i + 1]):  # up, until there is something to the right
                i >>= 1
            if i <= 1:
                return None
            i += 1
            while i < self.leaves:
                i = 2 * i if self.count[2 * i] else 2 * i + 1
        free = i - self.leaves
        self._add(free, -1)
        return self.rows[free].pop()


def best_fit_decreasing(lengths: np.ndarray, row: int) -> list[list[int]]:
    """Indexes of lengths (each 1 to row) by row: longest first, each into the open row that it fills best; ties by index."""
    open_rows, out, free = Capacities(row), [], []
    for i in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[i])
        k = open_rows.tightest(n)
        if k is None:
            k = len(out)
            out.append([])
            free.append(row)
        out[k].append(i)
        free[k] -= n
        if free[k]:
            open_rows.put(free[k], k)
    return out


def pieces(text: str, size: int = PIECE, run: int = RUN) -> Iterator[tuple[str, bool]]:
    """text in parts that can be encoded alone, and of each whether it is one match of the pattern.

    Before white space that follows something else a match always ends, and what it is doesn't depend on what follows. A
    long run of white space is a match without its last character, which goes with what follows, if anything does."""

    def plain(start: int, end: int) -> Iterator[tuple[str, bool]]:
        while end - start > size and (border := _BORDER.search(text, start + size, end)):
            yield text[start : border.start()], False
            start = border.start()
        if start < end:
            yield text[start:end], False

    at = 0
    for long in re.finditer(f"(?<![{WHITE}])[{WHITE}]{{{run},}}", text):
        yield from plain(at, long.start())
        at = long.end() - (long.end() < len(text))
        if at > long.start():
            yield text[long.start() : at], True
    yield from plain(at, len(text))


@lru_cache(1)
def _encoding(vocabulary: bytes) -> tiktoken.Encoding:
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, vocabulary.splitlines())}
    return tiktoken.Encoding("packing", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def token_ids(encoding: tiktoken.Encoding, text: str) -> np.ndarray:
    parts = (encoding._encode_single_piece(p) if alone else encoding.encode_to_numpy(p, disallowed_special=()) for p, alone in pieces(text))
    return np.concatenate([*parts, [END]]).astype(np.uint16)


def packed(docs: list[tuple[object, np.ndarray]], row: int) -> Iterator[dict]:
    """Rows of at most row tokens that hold all tokens of docs. A document of more is cut every row tokens."""
    segments = [(doc, at, ids[at : at + row]) for doc, ids in docs for at in range(0, len(ids), row)]
    for members in best_fit_decreasing(np.array([len(s[2]) for s in segments]), row):
        own = [segments[i] for i in members]
        ends = np.cumsum([len(s[2]) for s in own])
        matrix_row = np.full(row, END, "<u2")
        matrix_row[: ends[-1]] = np.concatenate([s[2] for s in own])
        yield {
            "doc_ids": [s[0] for s in own], "doc_starts": [s[1] for s in own], "ids": matrix_row.tobytes(), "cu_seqlens": [0, *ends.tolist()],
            "position_resets": [0, *ends[:-1].tolist()], "n_tokens": int(ends[-1]), "n_segments": len(own),
        }


def pack_tokens(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", row: int = ROW, vocabulary: str = VOCABULARY, group: int = GROUP) -> DataFrame:
    """Packed rows of token ids: ids (row little-endian 16-bit numbers, padded with END), cu_seqlens (cumulative lengths of
    the row's segments, from 0), position_resets (where positions start again at 0), doc_ids and doc_starts (which
    document's tokens a segment holds, from which token on), n_tokens, n_segments.

    Every document is its tokens and END. Each task packs the documents it reads, about `group` tokens at a time: nothing is
    shuffled, memory is bounded, and rows that stay partly empty are few. Documents longer than a row are cut into full
    rows and a rest; by doc_starts all segments of a document make its tokens again. Which documents share a row depends
    on how the input is split into tasks, what they hold doesn't.

    Null and empty texts are a lone END. Ids may be of any type; null ids stay null; repeated rows are packed each. No rows
    give no rows. Other columns are ignored."""
    with open(vocabulary, "rb") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())  # the vocabulary, under a megabyte

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding, held, n, ids = _encoding(shared.value), [], 0, None
        rest = pa.schema([("doc_starts", pa.list_(pa.int32())), ("ids", pa.binary()), ("cu_seqlens", pa.list_(pa.int32())),
                            ("position_resets", pa.list_(pa.int32())), ("n_tokens", pa.int32()), ("n_segments", pa.int32())])

        def full() -> Iterator[pa.RecordBatch]:
            nonlocal held, n
            made = list(packed(held, row))
            held, n = [], 0
            for at in range(0, len(made), 1000):
                yield pa.RecordBatch.from_pylist(made[at : at + 1000], pa.schema([("doc_ids", pa.list_(ids)), *rest]))

        for batch in batches:
            ids = batch.schema.field(0).type
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                held.append((doc, token_ids(encoding, text.as_py() or "")))
                n += len(held[-1][1])
                if n >= group:
                    yield from full()
        if held:
            yield from full()

    own = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return own.mapInArrow(rows, T.StructType([T.StructField("doc_ids", T.ArrayType(own.schema["doc_id"].dataType)), *T.StructType.fromDDL(SCHEMA).fields]))


def write_packed(packed_rows: DataFrame, path: str) -> None:
    """Packed rows as Parquet; the column ids of any file is a matrix of ids, one row after the other."""
    packed_rows.write.parquet(path)


def matrix(ids: list[bytes]) -> np.ndarray:
    """The id matrix of rows that were read back."""
    return np.stack([np.frombuffer(x, "<u2") for x in ids]) if ids else np.zeros((0, 0), np.uint16)
