"""SimHash near-duplicates by meet-in-the-middle ball hashing."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from framelark.llm.common import checkpointed, left_join_by_key, long_key
from framelark.llm.graph import components

SHINGLE, SEED, RADIUS = 3, 42, 3
#: Bytes of a text that are split into words at once.
PIECE = 1 << 20
#: More fingerprints than this with the same half are linked by a second ball instead of pair by pair.
DENSE = 64


def word_lists(data: bytes, overlap: int) -> Iterator[list[bytes]]:
    """The words of data, a few megabytes at a time; each list repeats the last `overlap` words before it."""
    carried: list[bytes] = []
    at, told = 0, False
    while at < len(data):
        space = re.compile(rb"[\x20\x09-\x0D]").search(data, min(len(data), at + PIECE))
        end = space.start() if space else len(data)
        words = carried + data[at:end].lower().split()
        at = end
        if at < len(data) and len(words) <= overlap:
            carried = words
            continue
        if told and len(words) == len(carried):  # only white space has come
            continue
        yield words
        told = True
        carried = words[len(words) - overlap :] if overlap else []


def shingle_hashes(data: bytes, size: int = SHINGLE, seed: int = SEED) -> Iterator[np.ndarray]:
    """XXH64 of the word shingles of data, as big-endian arrays; fewer words than size make one shingle."""
    digest = xxhash.xxh64_intdigest
    for words in word_lists(data, size - 1):
        if len(words) <= size:
            if words:
                yield np.array([digest(b" ".join(words), seed)], ">u8")
            continue
        joined = b" ".join(words)
        starts = np.cumsum([0, *(len(w) + 1 for w in words)])
        spans = zip(starts[:-size].tolist(), (starts[size:] - 1).tolist(), strict=True)
        yield np.array([digest(joined[a:b], seed) for a, b in spans], ">u8")


def simhash(data: bytes) -> int:
    """64 bits, each 1 if it is set in over half the shingles' hashes; 0 without words. Signed, as Spark's long."""
    ones, n = np.zeros(64, np.int64), 0
    for hashes in shingle_hashes(data):
        for part in np.array_split(hashes, len(hashes) // 65536 + 1):
            ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
        n += len(hashes)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big", signed=True)


@F.pandas_udf(T.LongType())
def simhash_of(text: pd.Series) -> pd.Series:
    return text.map(lambda x: simhash(x.encode()) if x else 0)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    return docs.select(F.col(id_col).alias("doc_id"), simhash_of(F.col(text_col)).alias("fp"))


def _half(fp: Column, high: int) -> Column:
    return F.shiftrightunsigned(fp, 32) if high else fp.bitwiseAND(F.lit(0xFFFFFFFF))


def _ball(value: Column, radius: int) -> Column:
    """Array of all 32-bit values within radius (0 to 2) bits of value."""
    masks = [0] + [1 << i for i in range(32) if radius] + [1 << i | 1 << j for i in range(32) for j in range(i) if radius > 1]
    return F.transform(F.array(*[F.lit(m).cast("long") for m in masks]), lambda m: value.bitwiseXOR(m))


def links(prints: DataFrame, dense: int = DENSE) -> DataFrame:
    """(a, b): enough pairs of distinct fingerprints fp within RADIUS = 3 bits to connect all such pairs.

    Two fingerprints within 3 bits differ by 1 bit at most in one of their 32-bit halves. So for each half every
    fingerprint emits all variants within half the radius, 1 bit, and meets those whose half is that variant; both
    shuffle on (half, variant). Pairs that meet are verified in the join over all 64 bits. Emitting balls over whole
    fingerprints would take 2,146 variants each (1 + 64, and 1 + 64 + 2,016 for its partner); over halves it is 66.

    Where more than `dense` fingerprints share a half, pairs would grow with the square. There both sides emit variants
    of the other half as well: members (S: has this half; P: one bit off) meet in a middle that is within 1 bit of some S,
    and within 2 bits of an S or 1 bit of a P. All that meet are within 3 bits of that S, so they are linked to the
    smallest such S without forming pairs; a middle has 1,585 members at most, as fingerprints are distinct."""
    halves = F.array(*[F.struct(F.lit(h).alias("half"), _half(F.col("fp"), h).alias("value"), _half(F.col("fp"), 1 - h).alias("rest")) for h in (0, 1)])
    own = prints.select("fp", F.inline(halves))
    ball = own.select("half", F.explode(_ball(F.col("value"), 1)).alias("value"), "fp")
    crowded = checkpointed(own.groupBy("half", "value").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > dense).select("half", "value"))
    any_crowded = not crowded.isEmpty()
    centres = own.select("half", "value", F.col("fp").alias("to"))
    plain = centres.join(crowded, ["half", "value"], "left_anti") if any_crowded else centres
    near = F.bit_count(F.col("fp").bitwiseXOR(F.col("to"))) <= RADIUS
    same = (F.col("x.half") == F.col("y.half")) & (F.col("x.value") == F.col("y.value"))
    pairs = ball.alias("x").join(plain.alias("y"), same & (F.col("fp") != F.col("to")) & near)
    pairs = pairs.select(F.greatest("fp", "to").alias("a"), F.least("fp", "to").alias("b"))
    if any_crowded:
        inner = ball.join(crowded, ["half", "value"]).withColumn("rest", F.when(F.col("half") == 0, _half(F.col("fp"), 1)).otherwise(_half(F.col("fp"), 0)))
        is_centre = F.col("value") == F.when(F.col("half") == 0, _half(F.col("fp"), 0)).otherwise(_half(F.col("fp"), 1))
        inner = inner.withColumn("is_centre", is_centre)
        middles = inner.select(
            "half", "value", "fp", F.col("is_centre").alias("s"), "rest",
            F.explode(F.when(F.col("is_centre"), _ball(F.col("rest"), 2)).otherwise(_ball(F.col("rest"), 1))).alias("middle"),
        )
        hub = F.when(F.col("s") & (F.bit_count(F.col("rest").bitwiseXOR(F.col("middle"))) <= 1), F.col("fp"))
        window = Window.partitionBy("half", "value", "middle")
        stars = middles.withColumn("hub", F.min(hub).over(window)).filter("hub <> fp")
        pairs = pairs.unionByName(stars.select(F.greatest("fp", "hub").alias("a"), F.least("fp", "hub").alias("b")))
    return pairs


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", dense: int = DENSE) -> DataFrame:
    """One row for each row of docs: id, fingerprint (16 hex digits), component_id.

    Fingerprints link at 3 or fewer differing bits; component_id is the smallest id that links reach. Texts without words
    (null, empty, white space) have fingerprint zero, which links like any other. Rows with equal fingerprints are one
    node. Null ids: component_id ignores them unless all ids of a component are null; then it is null. Repeated ids each
    give a row. No rows give no rows. Other columns are ignored."""
    prints = checkpointed(fingerprints(docs, id_col, text_col))
    nodes = checkpointed(prints.groupBy("fp").agg(F.min("doc_id").alias("low"), F.count(F.lit(1)).alias("n")))
    roots = components(links(nodes, dense))
    rooted = nodes.join(roots, F.col("fp") == F.col("node"), "left").withColumn("root", F.coalesce("root", "fp"))
    joined = checkpointed(rooted.select("fp", "n", "low", long_key(F.col("root")).alias("root")))
    # a large component's fingerprints are many rows of one root: their join is dealt with like that of hot fingerprints
    smallest = checkpointed(joined.groupBy("root").agg(F.min("low").alias("component_id"), F.count(F.lit(1)).alias("size")))
    of_print = left_join_by_key(joined.select("fp", "n", "root"), smallest, "root", "size")
    of_print = checkpointed(of_print.select(long_key(F.col("fp")).alias("key"), "component_id", "n"))
    out = left_join_by_key(prints.select("doc_id", long_key(F.col("fp")).alias("key")), of_print, "key", "n")
    return out.select(F.col("doc_id").alias(id_col), F.lower(F.hex("key")).alias("fingerprint"), "component_id")
