"""Near-duplicate documents by SimHash, compared around the anchors of a covering code.

A fingerprint has 64 bits. Two that differ in at most 3 bits differ in at most 1
bit of their left or of their right half. In each half the anchors are the words of
the [31, 26] Hamming code over 31 of the 32 bits, a perfect covering code of radius
1: every half lies within one bit of exactly one anchor, its home. A fingerprint is
replicated to every anchor within radius plus threshold, 1 + 1 = 2 bits, which are
16 per half (1 if the half is itself an anchor). Whatever lies within one bit of a
half therefore meets it at that half's home, and comparing homes with visitors per
anchor finds every linked pair.

Fingerprints are collapsed to distinct values first, so groups of copies of any size
cost one row. 2^26 anchors per half keep the groups small: at 10^10 different
fingerprints an anchor is visited by some thousands.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hitloom.llm import common

common.ship(sys.modules[__name__])

SHINGLE = 3
MAX_DISTANCE = 2
SEED = 42
_CHUNK = 1 << 16


def fingerprint(text: bytes | None, size: int = SHINGLE) -> int:
    """Unsigned SimHash of a UTF-8 text; 0 for null and for texts without words."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    if len(words) < size:
        shingles = [b" ".join(words)]
    else:
        shingles = list(map(b" ".join, zip(*(words[k:] for k in range(size)))))
    votes = np.zeros(64, dtype=np.int64)
    for start in range(0, len(shingles), _CHUNK):
        part = shingles[start : start + _CHUNK]
        hashes = np.fromiter((xxhash.xxh64_intdigest(s, SEED) for s in part), np.dtype(">u8"), len(part))
        votes += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(votes * 2 > len(shingles)).tobytes(), "big")


def _fingerprint_batch(batch: pa.RecordBatch, size: int) -> pa.RecordBatch:
    texts = batch.column(batch.num_columns - 1).cast(pa.large_binary())
    prints = np.fromiter((fingerprint(t.as_py(), size) for t in texts), np.uint64, len(texts))
    columns = batch.columns[:-1] + [pa.array(prints.view(np.int64))]
    return pa.RecordBatch.from_arrays(columns, names=batch.schema.names[:-1] + ["fingerprint"])


def fingerprints(docs: DataFrame, keep: list[str], text: str = "text", size: int = SHINGLE) -> DataFrame:
    """The ``keep`` columns and ``fingerprint`` (bigint with the 64 bits) of every row."""
    narrow = docs.select(*keep, F.col(text).alias("__text"))
    schema = narrow.drop("__text").withColumn("fingerprint", F.lit(0).cast("long")).schema
    return narrow.mapInArrow(common.per_batch(_fingerprint_batch, size), schema)


def _syndrome(half: Column) -> Column:
    """XOR of the places (1 to 31) of the bits set; 0 for words of the code."""
    bits = F.lit(0)
    for k in range(5):
        mask = sum(1 << (place - 1) for place in range(1, 32) if place >> k & 1)
        bits = bits + F.bit_count(half.bitwiseAND(F.lit(mask))) % 2 * (1 << k)
    return bits


def _flip(half: Column, place: Column) -> Column:
    """The half with the bit of a place flipped; place 0 flips none."""
    return half.bitwiseXOR(F.when(place > 0, F.call_function("shiftleft", F.lit(1).cast("long"), place - 1)).otherwise(0))


def _anchors(half: Column) -> Column:
    """All words of the code within 2 bits of a half."""
    syndrome = _syndrome(half)
    # Flipping places i and j leads to a word exactly if i XOR j is the syndrome.
    near = F.transform(
        F.filter(F.sequence(F.lit(1), F.lit(31)), lambda i: (i > i.bitwiseXOR(syndrome)) & (syndrome > 0)),
        lambda i: _flip(_flip(half, i), i.bitwiseXOR(syndrome)),
    )
    return F.when(syndrome == 0, F.array(half)).otherwise(near)


def _sided(anchors: Column, offset: Column) -> Column:
    return F.transform(anchors, lambda anchor: anchor + offset)


def _home(half: Column) -> Column:
    return _flip(half, _syndrome(half))


def _halves(value: Column) -> list[tuple[int, Column]]:
    low31 = F.lit((1 << 31) - 1)
    return [(0, value.bitwiseAND(low31)), (1, F.shiftrightunsigned(value, 32).bitwiseAND(low31))]


def linked_fingerprints(prints: DataFrame, max_distance: int = MAX_DISTANCE) -> DataFrame:
    """Pairs ``a < b`` of the distinct ``fingerprint`` values at most ``max_distance`` bits apart."""
    if not 0 <= max_distance <= 3:
        raise ValueError("halves and a code of radius 1 find distances of 0 to 3 bits")
    # Some bytes each, but every one is replicated to some thirty anchors: a number of
    # partitions that adaptive execution leaves alone.
    partitions = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    distinct = prints.select(F.col("fingerprint").alias("a")).distinct().repartition(partitions, "a")
    value = F.col("a")

    homes, visits = [], []
    for side, half in _halves(value):
        offset = F.lit(side << 31)
        homes.append(_home(half) + offset)
        visits.append(_sided(_anchors(half), offset))
    homes = distinct.select("a", F.explode(F.array(*homes)).alias("anchor"))
    visits = distinct.select(F.col("a").alias("b"), F.explode(F.concat(*visits)).alias("anchor"))
    near = (F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_distance)
    # Spark sizes both sides as if nothing were exploded and would broadcast thirty times that.
    return homes.hint("merge").join(visits, (homes["anchor"] == visits["anchor"]) & near).select("a", "b").distinct()


def simhash_components(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SHINGLE, max_distance: int = MAX_DISTANCE
) -> DataFrame:
    """The near-duplicate component of every row.

    Returns ``doc_id``, ``fingerprint`` (16 hexadecimal digits) and ``component_id``,
    the smallest id reachable over links of at most ``max_distance`` bits. Null and
    empty texts have fingerprint zero and link like any other. Repeated rows give
    repeated rows. A null id is never the smallest; a component of null ids only has
    a null ``component_id``. Other columns are ignored; no rows give no rows.
    """
    prints = common.store(fingerprints(docs.select(F.col(doc_id).alias("doc_id"), text), ["doc_id"], text, size), "prints")
    labels = _label(prints, max_distance)
    hexed = F.lpad(F.lower(F.hex("fingerprint")), 16, "0")
    return prints.join(labels, "fingerprint").select("doc_id", hexed.alias("fingerprint"), "component_id")


def _label(prints: DataFrame, max_distance: int) -> DataFrame:
    """``component_id`` of each fingerprint."""
    stars = common.components(linked_fingerprints(prints, max_distance), "simhash")
    classes = prints.groupBy("fingerprint").agg(F.min("doc_id").alias("least"))
    roots = classes.join(stars, classes["fingerprint"] == stars["node"], "left").select(
        "fingerprint", "least", F.coalesce("component", "fingerprint").alias("root")
    )
    smallest = roots.groupBy("root").agg(F.min("least").alias("component_id"))
    return common.store(roots.join(smallest, "root").select("fingerprint", "component_id"), "simhash-labels")


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", max_distance: int = MAX_DISTANCE) -> DataFrame:
    """One row of each component: that of the smallest id (null ids last), with all columns.

    Of rows alike in id and fingerprint any one stays. Every component keeps exactly one row.
    """
    rows = common.store(docs.withColumn("__row", F.monotonically_increasing_id()), "rows")
    prints = common.store(fingerprints(rows.withColumnRenamed(doc_id, "doc_id"), ["__row", "doc_id"], text), "prints")
    stars = common.components(linked_fingerprints(prints, max_distance), "simhash")
    rank = F.struct(F.col("doc_id").isNull(), "doc_id", "__row")
    best = prints.groupBy("fingerprint").agg(F.min(rank).alias("best"))
    chosen = (
        best.join(stars, best["fingerprint"] == stars["node"], "left")
        .groupBy(F.coalesce("component", "fingerprint").alias("root"))
        .agg(F.min("best").alias("best"))
        .select(F.col("best.__row").alias("__row"))
    )
    # Fewer rows go than stay.
    gone = common.bounded(prints.join(chosen, "__row", "left_anti").select("__row"))
    return rows.join(gone, "__row", "left_anti").drop("__row")
