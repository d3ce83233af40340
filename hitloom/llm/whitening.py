"""Whitening of vectors by polarisation: cross-covariances from variances of sums.

For integers x, the covariance of two dimensions is half of what the variance of their
sum has beyond their own variances, so the only aggregate needed is one exact sum of
squares for every dimension and for every sum of two dimensions:

1. entries become integers (``floor(64 * c) + 1000000``); each distinct vector counts
   once. Vectors are packed into the fewest bytes that hold them before the shuffle
   that makes them distinct, which combines copies in each task first;
2. one pass gives the number of vectors and the sum of each dimension;
3. one pass gives the squares of values centred at the integer next to the mean, and
   of their pairwise sums. They are integers, added without rounding; what the mean is
   off that integer is taken out exactly, as n times the squares less the squared sum;
4. differences of those variances are the covariances. Their matrix, of the size of
   one vector squared, goes to ``eigh`` on the driver;
5. one more pass over the distinct vectors measures the covariance of the result.

Tasks keep one number per pair of dimensions, whatever their rows, and the driver gets
their sums only. No vector passes through it.
"""

from __future__ import annotations

import sys
from dataclasses import astuple, dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitloom.llm import common

common.ship(sys.modules[__name__])

STEP, SHIFT = 64.0, 1_000_000
COMPONENTS = 16
#: Entries times 64 are held within this, as a cast to long would.
_LIMIT = 2.0**61
_LONG = (1 << 63) - 1
#: Variances below this share of the largest are rounding noise and count as zero.
_NOISE = 1e-13
_ROWS = 512
_SPLIT = 1 << 32


@dataclass
class Whitening:
    """The rows are ``(x - total / n) @ turn``; ``turn`` holds components over the square roots of variances."""

    n: int
    total: list[int]
    variance: np.ndarray
    explained: np.ndarray
    turn: np.ndarray
    identity_error: float = 0.0


def pack(x: np.ndarray) -> list[bytes]:
    """One canonical byte string per row: its width, then the entries less the shift in that width."""
    x = x - SHIFT
    low, high = x.min(1), x.max(1)
    out: list[bytes] = [b""] * len(x)
    left = np.ones(len(x), dtype=bool)
    for width in (1, 2, 4, 8):
        kind = np.iinfo(f"i{width}")
        fits = left & (low >= kind.min) & (high <= kind.max)
        left &= ~fits
        rows = np.flatnonzero(fits)
        packed = x[rows].astype(f"<i{width}")
        for at, row in zip(rows, packed):
            out[at] = bytes([width]) + row.tobytes()
    return out


def unpack(packed: list[bytes]) -> np.ndarray:
    """The integer rows of packed vectors, less the shift."""
    return np.stack([np.frombuffer(p, f"<i{p[0]}", offset=1).astype(np.int64) for p in packed])


def _pack_batches(batches):
    for batch in batches:
        if not batch.num_rows:
            continue
        entries = batch["vector"].flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
        x = np.clip(np.floor(STEP * entries), -_LIMIT, _LIMIT).astype(np.int64) + SHIFT
        yield pa.RecordBatch.from_arrays([batch["vec_id"], pa.array(pack(x), pa.binary())], names=["vec_id", "packed"])


def integer_vectors(table: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """Stored ``vec_id``, ``packed`` of the rows that take part.

    Left out are vectors that are null, empty, hold null or non-finite entries, or have
    another length than most (the shorter of equally frequent lengths counts). Rows
    without an id and repeated ids stay. Entries beyond the range of a long are held at it.
    """
    rows = table.select(F.col(vec_id).alias("vec_id"), F.col(embedding).cast("array<double>").alias("vector"))
    bad = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.where(F.col("vector").isNotNull() & (F.size("vector") > 0) & ~bad)
    lengths = rows.groupBy(F.size("vector").alias("length")).count().orderBy(F.desc("count"), "length").first()
    rows = rows.where(F.size("vector") == (lengths["length"] if lengths else 0))
    schema = rows.withColumn("packed", F.lit(b"")).drop("vector").schema
    return common.store(rows.mapInArrow(_pack_batches, schema), "integers")


def exact_sum(values: np.ndarray) -> list[int]:
    """Sums over rows without rounding."""
    if not len(values):
        return [0] * values.shape[1]
    most = max(-int(values.min()), int(values.max()))
    if most * len(values) <= _LONG:
        return values.sum(0).tolist()
    return values.astype(object).sum(0).tolist()


def polar_squares(y: np.ndarray) -> list[int]:
    """Sums over rows of ``y[i] ** 2``, then of ``(y[i] + y[j]) ** 2`` for i < j, in order."""
    size = y.shape[1]
    if 4 * max(-int(y.min()), int(y.max())) ** 2 * len(y) > _LONG:
        y = y.astype(object)
    out = (y * y).sum(0).tolist()
    for one in range(size - 1):
        both = y[:, one + 1 :] + y[:, one : one + 1]
        out += (both * both).sum(0).tolist()
    return out


def _halves(totals: list[int]) -> pa.RecordBatch:
    """Integers of any size as rows (at, piece, value): value * 2^32^piece, which add up as longs."""
    at, piece, value = [], [], []
    for key, total in enumerate(totals):
        rest, k, sign = abs(total), 0, -1 if total < 0 else 1
        while rest or not k:
            at.append(key)
            piece.append(k)
            value.append(sign * (rest % _SPLIT))
            rest, k = rest // _SPLIT, k + 1
    columns = [pa.array(at, pa.int64()), pa.array(piece, pa.int32()), pa.array(value, pa.int64())]
    return pa.RecordBatch.from_arrays(columns, names=["at", "piece", "value"])


def _per_task(work):
    """Exact sums of ``work`` over all rows of a task."""

    def run(batches):
        total: list[int] | None = None
        for batch in batches:
            packed = batch["packed"].to_pylist()
            for start in range(0, len(packed), _ROWS):
                found = work(unpack(packed[start : start + _ROWS]))
                total = found if total is None else [a + b for a, b in zip(total, found)]
        if total is not None:
            yield _halves(total)

    return run


def _added(vectors: DataFrame, work) -> list[int]:
    """Exact sums of ``work`` over all vectors: as many numbers as it returns reach the driver."""
    sums = vectors.select("packed").mapInArrow(_per_task(work), "at long, piece int, value long")
    merged = sums.groupBy("at", "piece").agg(F.sum("value").alias("value")).toArrow()
    out: dict[int, int] = {}
    for at, piece, value in zip(*(merged[name].to_pylist() for name in ("at", "piece", "value"))):
        out[at] = out.get(at, 0) + value * _SPLIT**piece
    return [out[k] for k in sorted(out)]


def covariance(vectors: DataFrame) -> tuple[int, list[int], np.ndarray]:
    """Number of vectors, sums of each dimension (with the shift), and the covariances.

    Each covariance is one division of exact integers.
    """
    counted = _added(vectors, lambda y: [len(y), *exact_sum(y)])
    if not counted:
        return 0, [], np.zeros((0, 0))
    n, sums = counted[0], counted[1:]
    centre = [(2 * s + n) // (2 * n) for s in sums]
    held = np.array(centre, dtype=np.int64)
    squares = _added(vectors, lambda y: polar_squares(y - held))
    size, off = len(sums), [s - n * c for s, c in zip(sums, centre)]
    own = [n * squares[i] - off[i] ** 2 for i in range(size)]
    matrix = np.zeros((size, size))
    at = size
    for i in range(size):
        matrix[i, i] = own[i] / n**2
        for j in range(i + 1, size):
            both = n * squares[at] - (off[i] + off[j]) ** 2
            matrix[i, j] = matrix[j, i] = (both - own[i] - own[j]) / (2 * n**2)
            at += 1
    return n, [s + n * SHIFT for s in sums], matrix


def _turned(y: np.ndarray, model: Whitening) -> np.ndarray:
    mean = np.array([(s - model.n * SHIFT) / model.n for s in model.total])
    return (y - mean) @ model.turn


def _measure(model):
    def run(batches):
        held = Whitening(*model.value)
        for batch in batches:
            packed = batch["packed"].to_pylist()
            for start in range(0, len(packed), _ROWS):
                w = _turned(unpack(packed[start : start + _ROWS]), held)
                found = np.concatenate([w.sum(0), (w.T @ w).ravel()])
                yield pa.RecordBatch.from_arrays([pa.array(range(len(found)), pa.int64()), pa.array(found)], names=["at", "value"])

    return run


def fit(vectors: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of the distinct vectors; none without vectors.

    Components of zero variance have no whitened values: their columns of ``turn`` are
    zero, and they are left out of ``identity_error``.
    """
    distinct = common.store(vectors.select("packed").distinct(), "distinct")
    n, total, matrix = covariance(distinct)
    if not n:
        return None
    values, axes = np.linalg.eigh(matrix)
    values, axes = np.maximum(values[::-1], 0), axes[:, ::-1]
    kept = slice(0, min(components, len(values)))
    live = values[kept] > _NOISE * max(values[0], 0) if values[0] > 0 else np.zeros(len(values[kept]), bool)
    turn = np.where(live, axes[:, kept] / np.sqrt(np.where(live, values[kept], 1)), 0.0)
    trace = matrix.trace()
    share = values[kept] / trace if trace > 0 else np.zeros(len(values[kept]))
    model = Whitening(n, total, values[kept], share, turn)
    shared = vectors.sparkSession.sparkContext.broadcast(astuple(model))
    sums = distinct.mapInArrow(_measure(shared), "at long, value double").groupBy("at").agg(F.sum("value").alias("value"))
    found = np.array([r["value"] for r in sorted(sums.collect(), key=lambda r: r["at"])])
    size = turn.shape[1]
    mean, second = found[:size] / n, found[size:].reshape(size, size) / n
    apart = np.abs(second - np.outer(mean, mean) - np.eye(size))[np.ix_(live, live)]
    model.identity_error = float(apart.max(initial=0.0))
    common.discard(distinct)
    return model


def deviations(y: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Per row the exact sum of ``(n * y - sums) ** 2``; null where that exceeds a long."""
    most = n * max(-int(y.min()), int(y.max())) + max(abs(s) for s in sums)
    if y.shape[1] * most**2 <= _LONG:
        v = n * y - np.array(sums, dtype=np.int64)
        return (v * v).sum(1).tolist()
    v = n * y.astype(object) - np.array(sums, dtype=object)
    return [value if value <= _LONG else None for value in (v * v).sum(1).tolist()]


def _transform(model):
    def run(batches):
        held = Whitening(*model.value)
        size = held.turn.shape[1]
        for batch in batches:
            packed = batch["packed"].to_pylist()
            for start in range(0, len(packed), _ROWS):
                y = unpack(packed[start : start + _ROWS])
                apart = deviations(y, held.n, [s - held.n * SHIFT for s in held.total])
                ids = batch["vec_id"].slice(start, len(y)).take(pa.array(np.repeat(np.arange(len(y)), size)))
                yield pa.RecordBatch.from_arrays(
                    [
                        ids,
                        pa.array(np.tile(np.arange(1, size + 1, dtype=np.int32), len(y))),
                        pa.array([held.n] * (len(y) * size), pa.int64()),
                        pa.array([a for a in apart for _ in range(size)], pa.int64()),
                        pa.array(_turned(y, held).ravel()),
                        pa.array(np.tile(held.explained, len(y))),
                        pa.array(np.full(len(y) * size, held.identity_error)),
                    ],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return run


def whiten(table: DataFrame, components: int = COMPONENTS, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """One row per vector that takes part and component, as listed in `_transform`.

    A table without such vectors, or an empty one, gives no rows. Repeated rows give
    repeated results but count once in the fit. With fewer dimensions than
    ``components`` there are as many components as dimensions. Other columns are ignored.
    """
    vectors = integer_vectors(table, vec_id, embedding)
    model = fit(vectors, components)
    out = f"vec_id {vectors.schema['vec_id'].dataType.simpleString()}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if model is None:
        return vectors.sparkSession.createDataFrame([], out)
    return vectors.mapInArrow(_transform(vectors.sparkSession.sparkContext.broadcast(astuple(model))), out)
