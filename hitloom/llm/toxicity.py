"""Toxicity: FTRL-proximal logistic regression over hashed n-grams and skip-grams.

Features of a text are the words present in it, adjacent pairs, and pairs with one or
two words between them, hashed into two tables (words, pairs). FTRL-proximal keeps a
sum ``z`` and a squared-gradient sum ``n`` per coordinate, so each coordinate has its
own rate, and the L1 term sets the weight of every coordinate with ``|z| <= l1`` to
zero: the model that goes to the scoring tasks is the few non-zero weights.

Training takes at most ``SAMPLE_ROWS`` labelled documents, the ones with the smallest
hash of their id. They are cut into groups of about ``SHARD_ROWS`` that learn in parallel; after
each round the states are averaged per coordinate. The tables have a fixed size, so
have the states that meet on the driver. Scoring is one pass over the documents
without a shuffle.
"""

from __future__ import annotations

import re
import sys
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hitloom.llm import common

common.ship(sys.modules[__name__])

SAMPLE_ROWS = 20_000
SHARD_ROWS = 2_500
ROUNDS = 2
PASSES = 2
WORD_BITS, PAIR_BITS = 18, 20
#: Rate, its smoothing, and the two regularisers.
ALPHA, BETA, L1, L2 = 1.0, 1.0, 5.0, 0.1
#: Coordinates of a smaller sum are not passed on between rounds.
LEAST = 1.0
SIZE = (1 << WORD_BITS) + (1 << PAIR_BITS) + 1
_BIAS = SIZE - 1
_WORD = re.compile(rb"[a-z0-9\x80-\xff]+")
#: Odd multipliers of the hashes; a pair's depends on the gap.
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], dtype=np.uint64)


@dataclass
class Model:
    """The non-zero weights: sorted coordinates and their values."""

    places: np.ndarray
    weights: np.ndarray


def coordinates(text: bytes | None) -> np.ndarray:
    """Coordinates of a UTF-8 text, repeats included; the bias is always one."""
    found = _WORD.findall((text or b"").lower())
    words = np.fromiter(map(zlib.crc32, found), np.uint64, len(found))
    parts = [(words * _MIX[0]) >> np.uint64(64 - WORD_BITS)]
    for gap in (1, 2, 3):
        pairs = (words[:-gap] * _MIX[gap]) ^ (words[gap:] * _MIX[0])
        pairs = (pairs ^ (pairs >> np.uint64(29))) * _MIX[gap]
        parts.append((pairs >> np.uint64(64 - PAIR_BITS)) + np.uint64(1 << WORD_BITS))
    parts.append(np.array([_BIAS], dtype=np.uint64))
    return np.concatenate(parts).astype(np.int64)


def _weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
    shrunk = np.sign(z) * np.maximum(np.abs(z) - L1, 0)
    return -shrunk / ((BETA + np.sqrt(n)) / ALPHA + L2)


def _sigmoid(value: float) -> float:
    return 1 / (1 + np.exp(-np.clip(value, -60, 60)))


def _learn(texts: list[np.ndarray], toxic: np.ndarray, z: np.ndarray, n: np.ndarray, passes: int) -> None:
    """FTRL-proximal over the texts in order, changing ``z`` and ``n``."""
    for _ in range(passes):
        for at, y in zip(texts, toxic):
            old_z, old_n = z[at], n[at]
            w = _weights(old_z, old_n)
            g = _sigmoid(w.sum()) - y
            new_n = old_n + g * g
            z[at] = old_z + g - (np.sqrt(new_n) - np.sqrt(old_n)) / ALPHA * w
            n[at] = new_n


def _train_shard(state, passes: int):
    def train(table: pa.Table) -> pa.Table:
        z, n = np.zeros(SIZE), np.zeros(SIZE)
        if state is not None:
            places, before_z, before_n = state.value
            z[places], n[places] = before_z, before_n
        table = table.sort_by([("place", "ascending"), ("doc_id", "ascending")])
        texts = [np.unique(coordinates(t.as_py())) for t in table["text"].cast(pa.large_binary())]
        _learn(texts, table["toxic"].to_numpy(), z, n, passes)
        # What has had little effect so far starts anew; most coordinates have.
        seen = np.flatnonzero(np.abs(z) >= LEAST)
        return pa.table([pa.array(seen), pa.array(z[seen]), pa.array(n[seen])], names=["at", "z", "n"])

    return train


def labelled_sample(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, may_learn: Column | None = None) -> DataFrame:
    """Stored ``doc_id``, ``text``, ``toxic``, ``place`` of at most ``rows`` labelled ids.

    Labels without id or mark are ignored; an id marked both ways counts as toxic;
    repeated documents of an id all count.
    """
    marked = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL")
    if may_learn is not None:
        marked = marked.where(may_learn)
    marked = marked.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    chosen = marked.withColumn("place", F.xxhash64("doc_id")).orderBy("place", "doc_id").limit(rows)
    # At most `rows` pairs of numbers.
    chosen = F.broadcast(chosen)
    return common.store(docs.select("doc_id", "text").join(chosen, "doc_id"), "labelled")


def train(sample: DataFrame, rounds: int = ROUNDS, passes: int = PASSES) -> Model:
    """The model of a labelled sample; without rows, one that scores everything 0.5."""
    context, state = sample.sparkSession.sparkContext, None
    shards = max(1, -(-sample.count() // SHARD_ROWS))
    sharded = sample.withColumn("shard", F.pmod("place", F.lit(shards)))
    for _ in range(rounds):
        states = sharded.groupBy("shard").applyInArrow(_train_shard(state, passes), "at long, z double, n double")
        # A coordinate that a shard hasn't seen is zero there; the mean is over all shards.
        merged = states.groupBy("at").agg((F.sum("z") / shards).alias("z"), (F.sum("n") / shards).alias("n"))
        table = merged.toArrow().sort_by("at")
        places, z, n = (table[name].to_numpy() for name in ("at", "z", "n"))
        state = context.broadcast((places, z, n))
    weights = _weights(z, n)
    used = np.flatnonzero(weights)
    return Model(places[used], weights[used])


def _score_batches(model, name: str):
    def score(batches):
        table = np.zeros(SIZE)
        places, weights = model.value
        table[places] = weights
        used = table != 0
        for batch in batches:
            texts = batch.column(batch.num_columns - 1).cast(pa.large_binary())
            out = np.empty(len(texts))
            for k, text in enumerate(texts):
                at = coordinates(text.as_py())
                out[k] = _sigmoid(table[np.unique(at[used[at]])].sum())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(out)], names=[*batch.schema.names[:-1], name])

    return score


def score(docs: DataFrame, model: Model, keep: list[str], text: str = "text", name: str = "score") -> DataFrame:
    """The ``keep`` columns and ``name``, the probability of being toxic, of every row.

    Null and empty texts get the score of the bias alone. Long texts are scored whole.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model.places, model.weights))
    narrow = docs.select(*keep, F.col(text).alias("__text"))
    schema = narrow.drop("__text").withColumn(name, F.lit(0.0)).schema
    return narrow.mapInArrow(_score_batches(shared, name), schema)


def _fold(folds: int) -> Column:
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(folds))


def score_documents(docs: DataFrame, labels: DataFrame, folds: int = 5) -> DataFrame:
    """Scores of all documents by a model that has seen none of fold 0.

    Returns ``doc_id``, ``held_out``, ``score``, ``predicted`` for every row, repeated
    ones and those without an id (never held out, never learned from) included.
    """
    model = train(labelled_sample(docs, labels, may_learn=_fold(folds) != 0))
    scored = score(docs, model, ["doc_id"])
    return scored.select(
        "doc_id",
        F.coalesce(_fold(folds) == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The rows, with all columns, that the model learned from all labels scores below the threshold."""
    model = train(labelled_sample(docs, labels))
    columns = docs.columns
    return score(docs, model, columns, name="__score").where(F.col("__score") < threshold).select(*columns)
