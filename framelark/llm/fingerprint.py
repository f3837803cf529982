"""Document fingerprints: digests of byte triplets by quartile, and how alike two digests are."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from framelark.llm.common import checkpointed

#: Buckets of triplets, each two bits of the digest; a triplet's bucket is the top bits of its product with FACTOR.
BITS, FACTOR = 9, 2654435761
BUCKETS = 1 << BITS
#: What a step of the length, a quarter of a doubling, counts in the difference, and how many steps do at most.
STEP, STEPS = 32, 16
#: The largest difference of two digests.
BOUND = 3 * BUCKETS + STEP * STEPS
#: Bytes whose triplets are counted at once.
PIECE = 1 << 20


def counted(data: bytes, piece: int = PIECE) -> np.ndarray:
    """How many triplets of consecutive bytes fall in each bucket."""
    out = np.zeros(BUCKETS, np.int64)
    for at in range(0, len(data) - 2, piece):
        b = np.frombuffer(data[at : at + piece + 2], np.uint8).astype(np.uint32)
        triplets = b[:-2] << np.uint32(16) | b[1:-1] << np.uint32(8) | b[2:]
        out += np.bincount((triplets * np.uint32(FACTOR)) >> np.uint32(32 - BITS), minlength=BUCKETS)
    return out


def length_code(n: int) -> int:
    """Quarters of doublings of n, rounded down: 0 for 0 and 1."""
    n = max(n, 1)
    e = n.bit_length() - 1
    return 4 * e + (4 * n >> e & 3)


def digest(data: bytes) -> bytes:
    """The length's code, then of each bucket how many of the quartiles of all counts its count exceeds, two bits each."""
    counts = counted(data)
    ranked = np.sort(counts)
    codes = sum((counts > ranked[BUCKETS * k // 4 - 1]).astype(np.uint8) for k in (1, 2, 3))
    four = codes.reshape(-1, 4)
    return bytes([min(length_code(len(data)), 255)]) + (four[:, 0] << 6 | four[:, 1] << 4 | four[:, 2] << 2 | four[:, 3]).astype(np.uint8).tobytes()


def difference(a: bytes, b: bytes) -> int:
    """0 for equal digests, BOUND at most: steps between the codes of each bucket, and of the length."""
    x, y = (np.frombuffer(d, np.uint8)[1:, None] >> np.array([6, 4, 2, 0], np.uint8) & 3 for d in (a, b))
    return int(np.abs(x.astype(np.int8) - y.astype(np.int8)).sum()) + STEP * min(abs(a[0] - b[0]), STEPS)


def likeness(a: bytes, b: bytes) -> float:
    """1 for equal digests, 0 for those as different as can be."""
    return 1 - difference(a, b) / BOUND


def edited(text: str, after: str) -> str:
    """text with its last half, rounded down, replaced by the first as many code points of after, or all of them."""
    half = len(text) // 2
    return text[: len(text) - half] + after[:half]


def compared(text: str, own: bytes, after: str, next_own: bytes) -> tuple:
    """n_chars, the edited text's SHA-256 and digest, and the two likenesses."""
    new = edited(text, after).encode()
    of_new = digest(new)
    return len(text), hashlib.sha256(new).digest(), of_new, likeness(own, of_new), likeness(own, next_own)


_FOUND = "n_chars long, edited_sha binary, own binary, new binary, near_edited double, near_next double"
#: What a row of a task says: a document and its next one; the task's first document; its last one.
DONE, FIRST, LAST = 0, 1, 2


def _walked(ids: T.StructField) -> tuple:
    schema = T.StructType([T.StructField("task", T.IntegerType()), T.StructField("kind", T.IntegerType()), T.StructField("doc_id", ids.dataType), *T.StructType.fromDDL(_FOUND).fields, T.StructField("text", T.StringType())])

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, before = TaskContext.get().partitionId(), None
        types = None
        for batch in batches:
            types = types or [pa.int32(), pa.int32(), batch.schema.field(0).type, pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.float64(), pa.float64(), pa.string()]
            out = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                text = text.as_py()
                here = (doc_id, text, digest(text.encode()))
                if before is None:
                    out.append((task, FIRST, doc_id, None, None, here[2], None, None, None, text))
                else:
                    n, sha, new, near_edited, near_next = compared(before[1], before[2], text, here[2])
                    out.append((task, DONE, before[0], n, sha, before[2], new, near_edited, near_next, None))
                before = here
            if out:
                yield _batch(out, types, schema.names)
        if before is not None:
            yield _batch([(task, LAST, before[0], None, None, before[2], None, None, None, before[1])], types, schema.names)

    return walk, schema


def _batch(rows: list[tuple], types: list, names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (doc_id, own, text, next_own, next_text) as those of a task's inside."""
    for batch in batches:
        if batch.num_rows:
            found = [compared(r["text"], r["own"], r["next_text"], r["next_own"]) for r in batch.select(["own", "text", "next_own", "next_text"]).to_pylist()]
            n, sha, new, near_edited, near_next = zip(*found, strict=True)
            columns = [batch.column(0), pa.array(n, pa.int64()), pa.array(sha, pa.binary()), batch.column(1), pa.array(new, pa.binary()), pa.array(near_edited, pa.float64()), pa.array(near_next, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_chars", "edited_sha", "own", "new", "near_edited", "near_next"])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of docs: id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    A fingerprint is 258 hex digits: a code of the length in bytes and, for each of 512 buckets of byte triplets, which
    quartile of all buckets its count is in. Two fingerprints' likeness is 1 less their difference's share of the largest
    one. The edited text is the first half of a document and as much of the next one.

    Documents are dealt to tasks by ranges of ids and sorted there, which is the only shuffle of texts; a task compares each
    with the next, and hands its first and last one to a small join of neighbouring tasks.

    Null text counts as empty. Texts of under three bytes have no triplets: their fingerprints tell their length only. Null
    ids come last, equal ids are in the order of a hash of their texts, equal rows in any. After the last row comes the
    first, which may be itself. No rows give no rows. Other columns are ignored."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    # the row's number only deals equal rows, which may be many, to several tasks
    order = [F.col("_last"), F.col("doc_id"), F.col("_tie"), F.col("_row")]
    rows = rows.withColumns({"_last": F.col("doc_id").isNull(), "_tie": F.xxhash64("text"), "_row": F.monotonically_increasing_id()})
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    walk, schema = _walked(rows.schema["doc_id"])
    walked = checkpointed(rows.mapInArrow(walk, schema))
    # two rows for each task; their texts meet by the tasks' numbers
    first, last = walked.filter(F.col("kind") == FIRST), walked.filter(F.col("kind") == LAST)
    tasks = first.select("task", F.lead("task").over(Window.orderBy("task")).alias("next"), F.min("task").over(Window.partitionBy()).alias("least"))
    tasks = tasks.select("task", F.coalesce("next", "least").alias("next"))
    pairs = last.select("task", "doc_id", "own", "text").join(tasks, "task")
    pairs = pairs.join(first.select(F.col("task").alias("next"), F.col("own").alias("next_own"), F.col("text").alias("next_text")), "next")
    names = ["doc_id", "n_chars", "edited_sha", "own", "new", "near_edited", "near_next"]
    met = pairs.select("doc_id", "own", "text", "next_own", "next_text").mapInArrow(_met, T.StructType([schema[n] for n in names]))
    out = walked.filter(F.col("kind") == DONE).select(*names).unionByName(met)
    hexed = lambda c, name: F.lower(F.hex(c)).alias(name)
    return out.select(
        F.col("doc_id").alias(id_col), "n_chars", hexed("edited_sha", "edited_sha256"), hexed("own", "fingerprint"), hexed("new", "edited_fingerprint"), "near_edited", "near_next"
    )


SQL = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS x, row_number() OVER (ORDER BY doc_id) AS r, count(*) OVER () AS n FROM documents),
     e AS (SELECT a.r, a.doc_id, a.x, left(a.x, length(a.x) - length(a.x) // 2) || left(b.x, length(a.x) // 2) AS y
           FROM d a JOIN d b ON b.r = a.r % a.n + 1),
     t AS (SELECT r, 0 AS w, x FROM e UNION ALL SELECT r, 1, y FROM e),
     b AS (SELECT r, w, list_transform(regexp_extract_all(hex(encode(x)), '..'), lambda h: ('0x' || h)::BIGINT) AS b FROM t),
     h AS (SELECT r, w, unnest(list_transform(range(1, len(b) - 1), lambda i: (b[i] * 65536 + b[i + 1] * 256 + b[i + 2]) * {FACTOR} % 4294967296 // {1 << (32 - BITS)})) AS k FROM b),
     c AS (SELECT r, w, k, count(*) AS n FROM h GROUP BY r, w, k),
     g AS (SELECT t.r, t.w, k.k, coalesce(c.n, 0) AS n FROM t CROSS JOIN range({BUCKETS}) AS k(k) LEFT JOIN c ON c.r = t.r AND c.w = t.w AND c.k = k.k),
     q AS (SELECT r, w, list(n ORDER BY n) AS s, list(n ORDER BY k) AS n FROM g GROUP BY r, w),
     v AS (SELECT r, w, list_transform(n, lambda x: (x > s[{BUCKETS // 4}])::INT + (x > s[{BUCKETS // 2}])::INT + (x > s[{3 * BUCKETS // 4}])::INT) AS v FROM q),
     l AS (SELECT r, w, greatest(strlen(x), 1) AS n, length(bin(greatest(strlen(x), 1))) - 1 AS e FROM t),
     f AS (SELECT r, w, v, 4 * e + ((4 * n) >> e) % 4 AS l FROM v JOIN l USING (r, w)),
     p AS (SELECT r, w, v, l, printf('%02x', l) || list_aggregate(list_transform(range(0, {BUCKETS}, 4), lambda i: printf('%02x', v[i + 1] * 64 + v[i + 2] * 16 + v[i + 3] * 4 + v[i + 4])), 'string_agg', '') AS f FROM f),
     z AS (SELECT e.r, doc_id, length(x) AS n_chars, sha256(y) AS edited_sha256, p.f AS fingerprint, o.f AS edited_fingerprint, p.v, p.l, o.v AS ov, o.l AS ol, s.v AS sv, s.l AS sl
           FROM e JOIN p ON p.r = e.r AND p.w = 0 JOIN p o ON o.r = e.r AND o.w = 1 JOIN p s ON s.r = e.r % (SELECT max(r) FROM e) + 1 AND s.w = 0)
SELECT doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
       1 - (list_sum(list_transform(range(1, {BUCKETS + 1}), lambda i: abs(v[i] - ov[i]))) + {STEP} * least(abs(l - ol), {STEPS}))::DOUBLE / {BOUND} AS near_edited,
       1 - (list_sum(list_transform(range(1, {BUCKETS + 1}), lambda i: abs(v[i] - sv[i]))) + {STEP} * least(abs(l - sl), {STEPS}))::DOUBLE / {BOUND} AS near_next
FROM z
"""
