"""Vector code compression: product quantisation in whole numbers; nearest entries by branch and bound over ball trees."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from decimal import Decimal
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from framelark.llm.common import checkpointed, left_join_by_key, written

SCALE, PARTS, ENTRIES, ROUNDS = 1024, 4, 256, 4
#: Entries of a ball that are compared one by one.
LEAF = 32
#: Whole components are held to so much; a distance to one of them is beyond a long in any case.
MOST = 1 << 62
#: Share by which distances and radii are widened, far more than what rounding takes from them.
MARGIN = 1e-9


def exact_below(width: int) -> int:
    """Components below this in size have squared distances that double precision holds exactly, in any order of summing."""
    return isqrt((1 << 51) // max(width, 1))


class Ball:
    """Entries around a centre: a leaf's indexes, or two smaller balls."""

    def __init__(self, entries: np.ndarray, own: np.ndarray):
        points = entries[own]
        self.centre = points.mean(0)
        far = np.sqrt(((points - self.centre) ** 2).sum(1))
        self.radius = float(far.max()) * (1 + MARGIN)  # rounded up: no entry lies outside
        self.own, self.halves = own, None
        if len(own) > LEAF and self.radius > 0:
            one = points[far.argmax()]
            from_one = ((points - one) ** 2).sum(1)
            other = points[from_one.argmax()]
            near = from_one <= ((points - other) ** 2).sum(1)
            if not near.all():
                self.halves = (Ball(entries, own[near]), Ball(entries, own[~near]))

    def least(self, q: np.ndarray) -> np.ndarray:
        """A lower bound of the squared distances from q to the entries inside, rounded down."""
        gap = np.maximum(np.sqrt(((q - self.centre) ** 2).sum(1)) * (1 - MARGIN) - self.radius, 0)
        return gap * gap * (1 - MARGIN)


class Codebook:
    """Entries of one part position. nearest() is exact: ties go to the lower index."""

    def __init__(self, entries: list[tuple[int, ...]]):
        self.entries = np.array(entries, dtype=object)
        self.limit = exact_below(self.entries.shape[1])
        self.exact = bool((abs(self.entries) < self.limit).all())
        if self.exact:
            self.points = self.entries.astype(np.float64)
            self.squares = (self.points**2).sum(1)
            self.tree = Ball(self.points, np.arange(len(entries)))

    def nearest(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index and squared distance of each row of q, whole numbers. Rows and entries that double precision can't hold
        exactly are compared by Python's integers."""
        at, error = np.zeros(len(q), np.int64), np.zeros(len(q), dtype=object)
        small = (abs(q) < self.limit).all(1) if self.exact else np.zeros(len(q), bool)
        if small.any():
            at[small], found = self._by_tree(q[small].astype(np.float64))
            error[small] = found.astype(np.int64).tolist()
        for i in np.flatnonzero(~small).tolist():
            distances = ((self.entries - np.array(q[i].tolist(), dtype=object)) ** 2).sum(1).tolist()
            error[i] = min(distances)
            at[i] = distances.index(error[i])
        return at, error

    def _by_tree(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        best, at = np.full(len(q), np.inf), np.full(len(q), len(self.points))
        squares = (q**2).sum(1)

        def visit(ball: Ball, rows: np.ndarray) -> None:
            if not len(rows):
                return
            if ball.halves:
                one, other = ball.halves
                a, b = one.least(q[rows]), other.least(q[rows])
                nearer = a <= b
                visit(one, rows[nearer])
                visit(other, rows[~nearer])
                # not strictly: an entry as near as the best so far may have a lower index
                visit(other, rows[nearer & (b <= best[rows])])
                visit(one, rows[~nearer & (a <= best[rows])])
                return
            distances = squares[rows, None] - 2 * (q[rows] @ self.points[ball.own].T) + self.squares[ball.own]  # whole numbers
            which = distances.argmin(1)  # own ascends, so the lowest index of equal ones
            least, index = distances[np.arange(len(rows)), which], ball.own[which]
            better = (least < best[rows]) | (least == best[rows]) & (index < at[rows])
            best[rows[better]], at[rows[better]] = least[better], index[better]

        visit(self.tree, np.arange(len(q)))
        return at, best


def whole(vectors: np.ndarray) -> np.ndarray:
    """floor(SCALE * x); scaling by a power of two rounds nothing."""
    with np.errstate(over="ignore"):
        scaled = np.floor(vectors.astype(np.float64) * SCALE)
    return np.where(scaled >= MOST, MOST, np.where(scaled <= -MOST, -MOST, np.clip(scaled, -MOST, MOST).astype(np.int64)))


def _packed(rows: np.ndarray) -> list[bytes]:
    """Each row as little-endian integers of four bytes, or of eight where four don't do."""
    narrow = (np.abs(rows) < 1 << 31).all(1)
    out = [r.tobytes() for r in rows.astype("<i4")]
    for i in np.flatnonzero(~narrow).tolist():
        out[i] = rows[i].astype("<i8").tobytes()
    return out


def _unpacked(column: pa.Array, width: int) -> np.ndarray:
    rows = column.to_pylist()
    if all(len(r) == 4 * width for r in rows):
        return np.frombuffer(b"".join(rows), "<i4").reshape(-1, width).astype(np.int64)
    return np.stack([np.frombuffer(r, "<i4" if len(r) == 4 * width else "<i8").astype(np.int64) for r in rows])


def usable(vector: Column) -> Column:
    """Whether a vector has finite components only, some, and as many for each part."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return F.coalesce(F.forall(vector, finite) & (F.size(vector) > 0) & (F.size(vector) % PARTS == 0), F.lit(False))


def _columns(width: int) -> list[str]:
    return [f"s{j}" for j in range(width)]


def _sums(rows: DataFrame, books: list[Codebook], width: int) -> DataFrame:
    """(part, entry, n, s0, s1, ...): of each task, how many parts each entry has and the sums of their components."""
    part = width // PARTS
    shared = rows.sparkSession.sparkContext.broadcast(books)  # PARTS * ENTRIES entries

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros((PARTS, ENTRIES), np.int64)
        sums = np.zeros((PARTS, ENTRIES, part), dtype=object)
        for batch in batches:
            if not batch.num_rows:
                continue
            q = _unpacked(batch.column(0), width)
            large = (np.abs(q) >= 1 << 31).any(1)
            for p, book in enumerate(shared.value):
                own = q[:, p * part : (p + 1) * part]
                at, _ = book.nearest(own)
                n[p] += np.bincount(at, minlength=ENTRIES)
                few = np.zeros((ENTRIES, part), np.int64)
                np.add.at(few, at[~large], own[~large])
                sums[p] += few
                for i in np.flatnonzero(large).tolist():
                    sums[p, at[i]] += np.array(own[i].tolist(), dtype=object)
        used = np.argwhere(n > 0)
        if len(used):
            columns = [pa.array(used[:, 0], pa.int32()), pa.array(used[:, 1], pa.int32()), pa.array(n[n > 0], pa.int64())]
            columns += [pa.array([Decimal(int(sums[p, k, j])) for p, k in used.tolist()], pa.decimal128(38, 0)) for j in range(part)]
            yield pa.RecordBatch.from_arrays(columns, ["part", "entry", "n", *_columns(part)])

    schema = "part int, entry int, n long, " + ", ".join(f"{c} decimal(38,0)" for c in _columns(part))
    return rows.select("q").mapInArrow(summed, schema)


def _moved(book: list[tuple[int, ...]], found: dict[int, tuple[int, list[int]]]) -> list[tuple[int, ...]]:
    """Entries replaced by the rounded-down means of their parts; unused ones stay."""
    return [tuple(s // found[k][0] for s in found[k][1]) if k in found else entry for k, entry in enumerate(book)]


def fitted(rows: DataFrame, first: list[np.ndarray], width: int, rounds: int = ROUNDS) -> list[list[tuple[int, ...]]]:
    """The entries of each part position after `rounds` rounds over all rows (q), starting from the parts of first.

    What comes to the driver each round: counts and sums of PARTS * ENTRIES entries, added up by Spark."""
    part = width // PARTS
    books = [[tuple(map(int, q[p * part : (p + 1) * part])) for q in first] for p in range(PARTS)]
    for _ in range(rounds):
        sums = _sums(rows, [Codebook(b) for b in books], width).groupBy("part", "entry").agg(F.sum("n").alias("n"), *[F.sum(c).alias(c) for c in _columns(part)])
        found: list[dict] = [{} for _ in range(PARTS)]
        for r in sums.collect():
            found[r["part"]][r["entry"]] = (r["n"], [int(r[c]) for c in _columns(part)])
        books = [_moved(b, f) for b, f in zip(books, found, strict=True)]
    return books


def books_sha256(books: list[list[tuple[int, ...]]]) -> str:
    return hashlib.sha256(",".join(str(x) for book in books for entry in book for x in entry).encode()).hexdigest()


def encoded(rows: DataFrame, books: list[list[tuple[int, ...]]], width: int) -> DataFrame:
    """rows (vec_id, label, q) with code and error instead of q."""
    part = width // PARTS
    shared = rows.sparkSession.sparkContext.broadcast([Codebook(b) for b in books])
    schema = T.StructType([rows.schema["vec_id"], rows.schema["label"], T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            q = _unpacked(batch.column(2), width)
            found = [book.nearest(q[:, p * part : (p + 1) * part]) for p, book in enumerate(shared.value)]
            codes = np.stack([at for at, _ in found], 1).astype(np.uint8)
            errors = sum(e for _, e in found).tolist()
            columns = [batch.column(0), batch.column(1), pa.array([c.tobytes().hex() for c in codes]), pa.array([e if e < 1 << 63 else None for e in errors], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "label", "code", "error"])

    return rows.select("vec_id", "label", "q").mapInArrow(coded, schema)


def vector_codes(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", rounds: int = ROUNDS) -> DataFrame:
    """One row for each usable row of vectors: id, code (one byte for each of PARTS parts, in hex), error (squared distance
    to what the code stands for), label_error (errors summed over equal labels, nulls together), codebooks_sha256.

    Components become floor(1024 * x). The first codebook is the parts of the 256 smallest ids' vectors; each round moves
    every entry to the rounded-down mean of the parts that are nearest to it. All of it is whole numbers, so nothing depends
    on how rows are dealt. Nearest entries are found in a ball tree for each part position, bounds rounded to the safe
    side, balls as near as the best visited too, distances compared as integers.

    Null vectors go, and those with null or non-finite components. Vectors that PARTS doesn't divide, or of another length
    than that of the smallest id, have no parts to compare and go, too. Null ids come last; of equal ids the smaller vector
    comes first. Each row of a repeated id gets a row. Fewer rows than entries make a smaller codebook; no rows give no
    rows. Whole components are held to 2^62 in size; an error that a long can't hold is null, and so is its label's sum.
    Other columns are ignored."""
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.col(label_col).alias("label"), F.col(vector_col).alias("v")).filter(usable(F.col("v")))
    head = rows.orderBy(F.asc_nulls_last("vec_id"), "v").limit(ENTRIES)
    width = (head.agg(F.min_by(F.size("v"), F.struct(F.col("vec_id").isNull(), "vec_id", "v"))).first()[0] or PARTS)
    rows = rows.filter(F.size("v") == width)
    first = [whole(np.array(r["v"], np.float64)) for r in rows.orderBy(F.asc_nulls_last("vec_id"), "v").limit(ENTRIES).select("v").collect()]
    schema = T.StructType([rows.schema["vec_id"], rows.schema["label"], T.StructField("q", T.BinaryType())])

    def scaled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = batch.column(2).flatten().to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(_packed(whole(flat).reshape(-1, width)), pa.binary())], ["vec_id", "label", "q"])

    kept = written(rows.mapInArrow(scaled, schema), "vectors")
    books = fitted(kept, first, width, rounds if first else 0)
    codes = kept.select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"))
    if first:
        codes = encoded(kept, books, width)
    key = F.coalesce(F.concat(F.lit("="), F.col("label").cast("string")), F.lit("")).cast("binary")
    codes = checkpointed(codes.select("vec_id", "code", "error", key.alias("key")))
    total = F.when(F.count("error") == F.count(F.lit(1)), F.sum(F.col("error").cast("decimal(38,0)")).try_cast("long"))
    labels = checkpointed(codes.groupBy("key").agg(total.alias("label_error"), F.count(F.lit(1)).alias("size")))
    out = left_join_by_key(codes, labels, "key", "size")
    return out.select(F.col("vec_id").alias(id_col), "code", "error", "label_error", F.lit(books_sha256(books)).alias("codebooks_sha256"))


def _sql() -> str:
    parts = [
        f"""v AS (SELECT vec_id, label, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS q FROM embeddings
                 WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
            p AS MATERIALIZED (SELECT vec_id, label, part, x, list_inner_product(x, x) AS xx FROM
                 (SELECT vec_id, label, part, q[part * (len(q) // {PARTS}) + 1 : (part + 1) * (len(q) // {PARTS})] AS x FROM v, range({PARTS}) AS t(part))),
            c0 AS MATERIALIZED (SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS k, x FROM p
                 QUALIFY row_number() OVER (PARTITION BY part ORDER BY vec_id) <= {ENTRIES})"""
    ]
    for i in range(ROUNDS + 1):
        parts.append(
            f"""a{i} AS MATERIALIZED (SELECT part, vec_id, label, x, min({{'d': d, 'k': k}}) AS best FROM
                    (SELECT p.part, vec_id, label, p.x, k, xx - 2 * list_inner_product(p.x, c.x) + list_inner_product(c.x, c.x) AS d
                     FROM p JOIN c{i} c ON p.part = c.part) GROUP BY part, vec_id, label, x)"""
        )
        if i < ROUNDS:
            parts.append(
                f"""s{i} AS (SELECT part, best.k AS k, j, sum(xj::HUGEINT) AS s, count(*) AS n FROM
                        (SELECT part, best, unnest(x) AS xj, unnest(range(len(x))) AS j FROM a{i}) GROUP BY part, best.k, j),
                    m{i} AS (SELECT part, k, list(((s - ((s % n) + n) % n) // n)::DOUBLE ORDER BY j) AS x FROM s{i} GROUP BY part, k),
                    c{i + 1} AS MATERIALIZED (SELECT c.part, c.k, coalesce(m.x, c.x) AS x FROM c{i} c LEFT JOIN m{i} m ON c.part = m.part AND c.k = m.k)"""
            )
    return f"""WITH {', '.join(parts)},
        b AS (SELECT sha256(string_agg(xj::BIGINT::VARCHAR, ',' ORDER BY part, k, j)) AS h FROM
              (SELECT part, k, unnest(x) AS xj, unnest(range(len(x))) AS j FROM c{ROUNDS})),
        e AS (SELECT vec_id, label, lower(string_agg(printf('%02x', best.k), '' ORDER BY part)) AS code, sum(best.d)::BIGINT AS error FROM a{ROUNDS} GROUP BY vec_id, label)
        SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, h AS codebooks_sha256 FROM e, b"""


SQL = _sql()
