"""Quality by compression: Zstandard dictionaries of good and of bad labelled text.

A dictionary holds what texts of its class have in common, so a text is compressed
better by the dictionary of the class it resembles. The difference of the two
compressed sizes, divided by the size of the text, becomes a probability by a
logistic curve fitted on labelled texts that no dictionary has seen.

At most ``SAMPLE_ROWS`` labelled documents of each class, the ones with the smallest
hash of their id, are learned from: one half gives the dictionaries (from at most
``PIECES`` pieces of ``PIECE_BYTES`` a class, again by hash), the other the curve.
Texts are compressed whole, in pieces of the same size, since only the first
kilobytes behind a dictionary profit from it. Scoring is one pass over the documents
without a shuffle; two dictionaries of at most ``DICTIONARY_BYTES`` are broadcast.
"""

from __future__ import annotations

import sys
import zlib
from dataclasses import astuple, dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hitloom.llm import common

common.ship(sys.modules[__name__])

SAMPLE_ROWS = 10_000
PIECES = 4_000
PIECE_BYTES = 2_048
DICTIONARY_BYTES = 112_640
LEVEL = 3
#: Pulls the curve towards the mean label; keeps it finite for classes that separate.
RIDGE = 1e-3
#: Sizes differ by some hundredths of the text.
SCALE = 100.0


@dataclass
class Model:
    """Dictionaries by label (empty: none) and the curve ``sigmoid(base + slope * difference)``."""

    bad: bytes
    good: bytes
    base: float = 0.0
    slope: float = 0.0


def pieces(text: bytes) -> list[bytes]:
    return [text[k : k + PIECE_BYTES] for k in range(0, len(text), PIECE_BYTES)]


def _texts(column: pa.Array):
    for text in column.cast(pa.large_binary()):
        yield text.as_py() or b""


def _cut(batches):
    for batch in batches:
        for text, quality in zip(_texts(batch["text"]), batch["quality"].to_pylist()):
            found = sorted({(zlib.crc32(piece), piece) for piece in pieces(text)})
            if found:
                order, cut = zip(*found)
                yield pa.RecordBatch.from_arrays([pa.array([quality] * len(cut), pa.int32()), pa.array(order, pa.int64()), pa.array(cut, pa.binary())], names=["quality", "place", "piece"])


def dictionary(samples: list[bytes]) -> bytes:
    """A trained dictionary, or the samples themselves where they are too few to train one."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-DICTIONARY_BYTES:]


def _compressor(content: bytes) -> zstandard.ZstdCompressor:
    if not content:
        return zstandard.ZstdCompressor(level=LEVEL, write_content_size=False)
    held = zstandard.ZstdCompressionDict(content)
    held.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(dict_data=held, write_content_size=False, write_dict_id=False)


def differences(texts, model: Model) -> np.ndarray:
    """By how much the good dictionary does worse than the bad one, in hundredths of the text."""
    good, bad = _compressor(model.good), _compressor(model.bad)
    out = []
    for text in texts:
        apart = sum(len(good.compress(piece)) - len(bad.compress(piece)) for piece in pieces(text))
        out.append(SCALE * apart / max(len(text), 1))
    return np.array(out)


def _sigmoid(value):
    return 1 / (1 + np.exp(-np.clip(value, -60, 60)))


def fit_curve(apart: np.ndarray, good: np.ndarray, weight: np.ndarray, steps: int = 50) -> tuple[float, float]:
    """Weighted logistic regression of the label on the difference, by Newton's method.

    With one label only, or none, the curve is level at the mean of the labels and a half.
    """
    total = weight.sum()
    mean = ((weight * good).sum() + 0.5) / (total + 1)
    level = float(np.log(mean / (1 - mean)))
    if not len(good) or good.min() == good.max():
        return level, 0.0
    x, w, at = np.stack([np.ones_like(apart), apart], 1), weight / total, np.array([level, 0.0])
    pull = np.diag([0.0, RIDGE])

    def loss(point):
        value = x @ point
        return (w * (np.logaddexp(0, value) - good * value)).sum() + RIDGE / 2 * point[1] ** 2

    for _ in range(steps):
        p = _sigmoid(x @ at)
        slope = x.T @ (w * (p - good)) + pull @ at
        bend = (x * (w * p * (1 - p))[:, None]).T @ x + pull + 1e-12 * np.eye(2)
        step, size = np.linalg.solve(bend, slope), 1.0
        while loss(at - size * step) > loss(at) and size > 1e-6:
            size /= 2
        at = at - size * step
        if np.abs(size * step).max() < 1e-10:
            break
    return float(at[0]), float(at[1])


def _measure_sample(model):
    def measure(batches):
        held = Model(*model.value)
        for batch in batches:
            apart = differences(_texts(batch["text"]), held)
            yield pa.RecordBatch.from_arrays([batch["quality"], pa.array(apart, pa.float64())], names=["quality", "apart"])

    return measure


def labelled_sample(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, may_learn: Column | None = None) -> DataFrame:
    """Stored ``text``, ``quality``, ``place``, ``weight`` of at most ``rows`` ids a class.

    Labels without id or mark are ignored; an id marked both ways counts as bad;
    repeated documents of an id all count. ``weight`` is the number of labelled ids
    that one of the sample stands for.
    """
    marked = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL")
    if may_learn is not None:
        marked = marked.where(may_learn)
    marked = marked.groupBy("doc_id").agg(F.min("quality").cast("int").alias("quality"))
    marked = common.store(marked.withColumn("place", F.xxhash64("doc_id")), "marked")
    counts = {r["quality"]: r["count"] for r in marked.groupBy("quality").count().collect()}
    classes = [
        marked.where(F.col("quality") == quality).orderBy("place", "doc_id").limit(rows).withColumn("weight", F.lit(max(1.0, count / rows)))
        for quality, count in ((q, counts.get(q, 0)) for q in (0, 1))
    ]
    # At most twice `rows` ids.
    chosen = F.broadcast(classes[0].union(classes[1]))
    return common.store(docs.select("doc_id", "text").join(chosen, "doc_id").drop("doc_id"), "labelled")


def train(sample: DataFrame) -> Model:
    """The model of a labelled sample; without rows, one that scores everything 0.5."""
    half = F.pmod(F.col("place"), F.lit(2))
    cut = sample.where(half == 0).select("text", "quality").mapInArrow(_cut, "quality int, place long, piece binary")
    cut = common.store(cut.distinct(), "pieces")
    found = {}
    for quality in (0, 1):
        # At most PIECES pieces of PIECE_BYTES come to the driver.
        chosen = cut.where(F.col("quality") == quality).orderBy("place", "piece").limit(PIECES)
        found[quality] = dictionary(chosen.select("piece").toArrow().column("piece").to_pylist())
    model = Model(found[0], found[1])
    shared = sample.sparkSession.sparkContext.broadcast(astuple(model))
    rest = sample.where(half == 1).select("text", "quality", "weight")
    measured = rest.select("text", F.struct("quality", "weight").alias("quality")).mapInArrow(
        _measure_sample(shared), "quality struct<quality: int, weight: double>, apart double"
    )
    # Three numbers for each document of the sample.
    table = measured.select("quality.quality", "quality.weight", "apart").toArrow()
    order = np.lexsort([table[name].to_numpy() for name in ("quality", "weight", "apart")])
    quality, weight, apart = (table[name].to_numpy().astype(float)[order] for name in ("quality", "weight", "apart"))
    model.base, model.slope = fit_curve(apart, quality, weight)
    return model


def _score_batches(model, name: str):
    def score(batches):
        held = Model(*model.value)
        for batch in batches:
            apart = differences(_texts(batch.column(batch.num_columns - 1)), held)
            out = pa.array(_sigmoid(held.base + held.slope * apart), pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], out], names=[*batch.schema.names[:-1], name])

    return score


def score(docs: DataFrame, model: Model, keep: list[str], text: str = "text", name: str = "score") -> DataFrame:
    """The ``keep`` columns and ``name``, the probability of good quality, of every row.

    Null and empty texts get the score of no difference. Long texts are scored whole.
    Other columns, also one called ``name``, have no influence.
    """
    shared = docs.sparkSession.sparkContext.broadcast(astuple(model))
    narrow = docs.select(*keep, F.col(text).alias("__text"))
    schema = narrow.drop("__text").withColumn(name, F.lit(0.0)).schema
    return narrow.mapInArrow(_score_batches(shared, name), schema)


def _fold(folds: int) -> Column:
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(folds))


def score_documents(docs: DataFrame, labels: DataFrame, folds: int = 5, threshold: float = 0.3) -> DataFrame:
    """Scores of all documents by a model that has seen none of fold 0.

    Returns ``doc_id``, ``held_out``, ``score``, ``predicted`` for every row, repeated
    ones and those without an id (never held out, never learned from) included. An
    empty table of documents gives no rows.
    """
    model = train(labelled_sample(docs, labels, may_learn=_fold(folds) != 0))
    return score(docs, model, ["doc_id"]).select(
        "doc_id",
        F.coalesce(_fold(folds) == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
