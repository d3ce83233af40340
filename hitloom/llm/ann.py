"""Approximate nearest neighbours by inner product over balanced posting lists.

1. A bounded sample gives the centroids of the lists, about the square root of the
   number of vectors. Inner products become distances by one more component,
   sqrt(M^2 - |x|^2) for vectors, 0 for queries.
2. Every vector goes to the list of its nearest centroid; boundary vectors, with other
   centroids within ``BOUNDARY`` times that distance, are replicated there as well
   unless a centroid already taken is nearer to the new one than the vector is.
3. Lists are balanced: one of more than ``LIST_ROWS`` vectors is cut into parts of
   that size by hash, and parts are packed into shards of ``SHARD_ROWS``. A list that
   holds a third of all vectors is thus spread over many shards.
4. A query walks the centroids' neighbour graph, held in memory, and takes every list
   whose centroid is within a ratio of the nearest centroid's distance. The ratio is
   calibrated on the sample to reach ``TARGET_RECALL`` there, so data without
   clusters get more lists, clustered data few.
5. Queries meet shards in blocks; each block returns its best per query, scored in
   double precision on the original vectors.

The centroid table and graph are broadcast; ``MAX_LISTS`` bounds them (and the sample).
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hitloom.llm import common

common.ship(sys.modules[__name__])

K = 20
MAX_LISTS = 4096
SAMPLE_PER_LIST = 32
LIST_ROWS = 1024
SHARD_ROWS = 8192
QUERY_BLOCK = 8192
BOUNDARY = 1.1
REPLICAS = 4
TARGET_RECALL = 0.97
GRAPH_DEGREE = 16
_CALIBRATION = 256
_BATCH = 256
_SCORED = 1 << 14


def usable(table: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """Stored ``row``, ``vec_id``, ``vector`` (doubles) of the rows that take part.

    Left out are vectors that are null, all zero, hold null or non-finite components or
    have another length than most (the shorter of equally frequent lengths counts).
    """
    vector = F.col(embedding).cast("array<double>")
    rows = table.select(F.col(vec_id).cast("long").alias("vec_id"), vector.alias("vector"))
    bad = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.where(~bad & F.exists("vector", lambda x: x != 0))
    lengths = rows.groupBy(F.size("vector").alias("length")).count().orderBy(F.desc("count"), "length").first()
    rows = rows.where(F.size("vector") == (lengths["length"] if lengths else 0))
    return common.store(rows.withColumn("row", F.monotonically_increasing_id()).select("row", "vec_id", "vector"), "vectors")


def _squared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(1)[:, None] + (y * y).sum(1)[None, :] - 2 * x @ y.T, 0)


def _augmented(x: np.ndarray, norm: float) -> np.ndarray:
    """One more component that makes all norms equal."""
    return np.hstack([x, np.sqrt(np.maximum(norm * norm - (x * x).sum(1), 0))[:, None]])


def _centroids(sample: np.ndarray, count: int, steps: int = 8) -> np.ndarray:
    """k-means from evenly drawn rows; in each step the smallest clusters move into the largest."""
    centres = sample[np.linspace(0, len(sample) - 1, count).astype(int)].copy()
    for step in range(steps):
        nearest = _squared(sample, centres).argmin(1)
        sizes = np.bincount(nearest, minlength=count)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, sample)
        centres = np.where(sizes[:, None] > 0, sums / np.maximum(sizes, 1)[:, None], centres)
        if step < steps - 2:
            small = np.flatnonzero(sizes * 4 < len(sample) / count)
            large = np.argsort(-sizes, kind="stable")[: len(small)]
            large = large[sizes[large] * 2 > len(sample) / count]
            for one, other in zip(small, large):
                members = np.flatnonzero(nearest == other)
                centres[one] = (centres[other] + sample[members[len(members) // 2]]) / 2
    return centres


def _graph(centres: np.ndarray, degree: int = GRAPH_DEGREE) -> np.ndarray:
    """Neighbours of each centroid: the nearest, and the two next to it in order, which connect all."""
    count = len(centres)
    distance = _squared(centres, centres)
    near = np.argsort(distance, axis=1, kind="stable")[:, 1 : degree + 1]
    ring = (np.arange(count)[:, None] + np.array([-1, 1])) % count
    return np.hstack([near, ring])


def search_graph(x: np.ndarray, centres: np.ndarray, graph: np.ndarray, ratio: float) -> np.ndarray:
    """Distances to the centroids reached, infinity elsewhere.

    Starts at spread entry points and expands, nearest first, every centroid within
    ``ratio`` of the nearest distance seen, until none is left.
    """
    found = np.full((len(x), len(centres)), np.inf)
    done = np.zeros(found.shape, dtype=bool)
    entries = np.unique(np.linspace(0, len(centres) - 1, min(len(centres), 32)).astype(int))
    found[:, entries] = np.sqrt(_squared(x, centres[entries]))
    while True:
        limit = found.min(1) * ratio + 1e-12 if np.isfinite(ratio) else np.full(len(x), np.inf)
        waiting = np.where(done | (found > limit[:, None]), np.inf, found)
        width = min(8, waiting.shape[1])
        best = np.argpartition(waiting, width - 1, axis=1)[:, :width]
        rows, slots = np.nonzero(np.isfinite(np.take_along_axis(waiting, best, 1)))
        if not len(rows):
            return found
        nodes = best[rows, slots]
        done[rows, nodes] = True
        rows, nodes = np.repeat(rows, graph.shape[1]), graph[nodes].ravel()
        new = np.unique((rows * len(centres) + nodes)[np.isinf(found[rows, nodes])])
        rows, nodes = new // len(centres), new % len(centres)
        found[rows, nodes] = np.sqrt(((x[rows] - centres[nodes]) ** 2).sum(1))


def _assigned(x: np.ndarray, centres: np.ndarray, graph: np.ndarray) -> list[np.ndarray]:
    """Lists of each vector, the nearest first."""
    found = search_graph(x, centres, graph, BOUNDARY)
    out = []
    for row in found:
        order = np.argsort(row, kind="stable")
        order = order[row[order] <= row[order[0]] * BOUNDARY + 1e-12]
        taken = [order[0]]
        for c in order[1:]:
            if len(taken) == REPLICAS:
                break
            if ((centres[taken] - centres[c]) ** 2).sum(1).min() > row[c] ** 2:
                taken.append(c)
        out.append(np.array(taken))
    return out


def _calibrate(sample: np.ndarray, plain: np.ndarray, centres: np.ndarray, graph: np.ndarray, k: int) -> float:
    """The ratio at which lists of the sample hold the target share of the sample's neighbours."""
    lists = [one for start in range(0, len(sample), _BATCH) for one in _assigned(sample[start : start + _BATCH], centres, graph)]
    asked = np.linspace(0, len(plain) - 1, min(_CALIBRATION, len(plain))).astype(int)
    queries = np.hstack([plain[asked], np.zeros((len(asked), 1))])
    scores = plain[asked] @ plain.T
    scores[np.arange(len(asked)), asked] = -np.inf
    distance = np.sqrt(_squared(queries, centres))
    nearest = np.maximum(distance.min(1), 1e-12)
    needed = []
    for q in range(len(asked)):
        for hit in np.argsort(-scores[q], kind="stable")[: min(k, len(plain) - 1)]:
            needed.append(distance[q, lists[hit]].min() / nearest[q])
    return float(np.quantile(needed, TARGET_RECALL)) if needed else 1.0


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(len(flat), -1)


def _assign_batches(shared):
    def assign(batches):
        centres, graph, norm = shared.value
        for batch in batches:
            rows, lists = [], []
            x = _augmented(_matrix(batch.column("vector")), norm)
            for start in range(0, len(x), _BATCH):
                for k, taken in enumerate(_assigned(x[start : start + _BATCH], centres, graph)):
                    rows.extend([start + k] * len(taken))
                    lists.extend(taken)
            picked = batch.take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays([*picked.columns, pa.array(lists, pa.int32())], names=[*batch.schema.names, "list"])

    return assign


def _route_batches(shared, parts, shards: int, ratio: float, least: int):
    """Queries with the (list, part) pairs they search, one row per shard."""

    def route(batches):
        centres, graph, _ = shared.value
        counts, sizes = parts.value
        names = ["query_row", "query_id", "query", "block", "shard", "wanted"]
        for batch in batches:
            x = _matrix(batch.column("vector"))
            padded = np.hstack([x, np.zeros((len(x), 1))])
            at, shard, wanted = [], [], []
            for start in range(0, len(x), _BATCH):
                found = search_graph(padded[start : start + _BATCH], centres, graph, ratio)
                for k, row in enumerate(found):
                    by_shard: dict[int, list[int]] = {}
                    near = _lists_within(row, ratio, sizes, least)
                    if near is None:
                        row = search_graph(padded[start + k : start + k + 1], centres, graph, np.inf)[0]
                        near = _lists_within(row, ratio, sizes, least)
                    for c in near:
                        for part in range(counts[c]):
                            by_shard.setdefault(_shard(c, part, shards), []).append(_slot(c, part))
                    for number, slots in by_shard.items():
                        at.append(start + k)
                        shard.append(number)
                        wanted.append(slots)
            picked = batch.take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [picked.column("row"), picked.column("vec_id"), picked.column("vector"), picked.column("block"), pa.array(shard, pa.int32()), pa.array(wanted, pa.list_(pa.int64()))],
                names=names,
            )

    return route


def _lists_within(distances: np.ndarray, ratio: float, sizes: np.ndarray, least: int) -> np.ndarray | None:
    """Lists within the ratio, and further ones until they hold ``least`` postings; None if those reached don't."""
    order = np.argsort(distances, kind="stable")
    held = np.cumsum(np.where(np.isfinite(distances[order]), sizes[order], 0))
    enough = np.searchsorted(held, least) + 1
    if held[-1] < least and not np.isfinite(distances).all():
        return None
    close = int((distances <= distances[order[0]] * ratio + 1e-12).sum()) if np.isfinite(ratio) else len(order)
    return order[: max(close, min(enough, len(order)))]


def _slot(c, part) -> int:
    return int(c) << 32 | int(part)


def _shard(c, part, shards: int) -> int:
    return (int(c) * 7919 + int(part)) % shards


def _best(k: int):
    """Best ``k`` of one shard for each query of one block."""
    schema = pa.schema([("query_row", pa.int64()), ("query_id", pa.int64()), ("row", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])

    def best(postings: pa.Table, queries: pa.Table) -> pa.Table:
        if not postings.num_rows or not queries.num_rows:
            return schema.empty_table()
        slots, rows = postings["slot"].to_numpy(), postings["row"].to_numpy()
        # Rows without id come last among ties.
        ids = postings["vec_id"].fill_null(np.iinfo(np.int64).max).to_numpy()
        vectors, asked = _matrix(postings["vector"]), _matrix(queries["query"])
        query_rows, query_ids = queries["query_row"].to_numpy(), queries["query_id"].to_numpy()
        wanted = queries["wanted"].combine_chunks()
        lengths = np.diff(wanted.offsets.to_numpy())
        owner, slot = np.repeat(np.arange(len(asked)), lengths), wanted.flatten().to_numpy()
        order, by_slot = np.argsort(slots, kind="stable"), np.argsort(slot, kind="stable")
        hits = []
        for value in np.unique(slot):
            here = order[np.searchsorted(slots[order], value) : np.searchsorted(slots[order], value, "right")]
            who = owner[by_slot[np.searchsorted(slot[by_slot], value) : np.searchsorted(slot[by_slot], value, "right")]]
            if len(here):
                # A first look by matrix product; the margin covers its rounding.
                scores = asked[who] @ vectors[here].T
                scores[query_rows[who][:, None] == rows[here][None, :]] = -np.inf
                if len(here) > k:
                    least = np.partition(scores, len(here) - k, axis=1)[:, len(here) - k]
                else:
                    least = np.full(len(who), -np.inf)
                margin = 1e-9 * (1 + np.abs(np.where(np.isfinite(least), least, 0)))
                a, b = np.nonzero((scores >= (least - margin)[:, None]) & np.isfinite(scores))
                hits.append((who[a], here[b]))
        if not any(len(h[0]) for h in hits):
            return schema.empty_table()
        q, p = np.concatenate([h[0] for h in hits]), np.concatenate([h[1] for h in hits])
        q, p = np.divmod(_distinct(q, p, rows), len(rows))
        # The same sum for the same two vectors wherever they lie.
        cuts = range(0, len(q), _SCORED)
        scores = np.concatenate([(asked[q[c : c + _SCORED]] * vectors[p[c : c + _SCORED]]).sum(axis=1) for c in cuts])
        order = np.lexsort((rows[p], ids[p], -scores, q))
        q, p, scores = q[order], p[order], scores[order]
        first = np.searchsorted(q, q)
        keep = np.arange(len(q)) - first < k
        q, p, scores = q[keep], p[keep], scores[keep]
        return pa.table([query_rows[q], query_ids[q], rows[p], postings["vec_id"].take(pa.array(p)), scores], schema=schema)

    return best


def _distinct(q: np.ndarray, p: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Pairs of query and posting without replicas, as query * postings + posting."""
    pairs = np.stack([q, rows[p]])
    _, first = np.unique(pairs, axis=1, return_index=True)
    return q[first] * len(rows) + p[first]


def nearest(table: DataFrame, is_query: Column, k: int = K, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """The ``k`` rows of largest inner product found for each query row.

    Returns ``query_id``, ``rank``, ``vec_id``, ``score`` (ties to the smaller id).
    ``is_query`` is a condition on ``vec_id``. A row is never its own neighbour;
    repeated rows are rows of their own, and a query row that repeats answers twice
    under the same id. Vectors that `usable` leaves out neither ask nor answer. With
    fewer than ``k`` candidates all come. An empty table gives no rows. Ids may be
    null (such rows answer, last among ties, and never ask). Other columns are ignored.
    """
    spark = table.sparkSession
    schema = "query_row long, query_id long, row long, vec_id long, score double"
    vectors = usable(table, vec_id, embedding)
    rows, norm = vectors.agg(F.count("*"), F.sqrt(F.max(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x)))).first()
    if not rows:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    lists = int(min(MAX_LISTS, max(1, round(rows**0.5))))
    drawn = vectors.orderBy(F.xxhash64("row", F.lit(1)), "row").limit(lists * SAMPLE_PER_LIST).select("vector").toArrow()
    plain = _matrix(drawn["vector"])
    sample = _augmented(plain, norm)
    centres = _centroids(sample, lists)
    graph = _graph(centres)
    ratio = _calibrate(sample, plain, centres, graph, k)
    shared = spark.sparkContext.broadcast((centres, graph, norm))
    listed = vectors.mapInArrow(_assign_batches(shared), "row long, vec_id long, vector array<double>, list int")
    listed = common.store(listed, "postings")
    sizes = np.zeros(lists, dtype=np.int64)
    for number, size in listed.groupBy("list").count().collect():  # MAX_LISTS rows
        sizes[number] = size
    counts = -(-sizes // LIST_ROWS)
    parts = spark.sparkContext.broadcast((counts, sizes))
    shards = max(1, -(-int(listed.count()) // SHARD_ROWS))
    part_of = F.pmod(F.xxhash64("row"), F.element_at(F.array(*map(F.lit, counts.tolist())), F.col("list") + 1).cast("long"))
    asking = vectors.where(is_query & F.col("vec_id").isNotNull())
    blocks = max(1, -(-asking.count() // QUERY_BLOCK))
    postings = listed.withColumn("part", part_of).select(
        "row", "vec_id", "vector",
        (F.shiftleft(F.col("list").cast("long"), 32) + F.col("part")).alias("slot"),
        F.pmod(F.col("list").cast("long") * 7919 + F.col("part"), F.lit(shards)).cast("int").alias("shard"),
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"),
    )
    queries = asking.withColumn("block", F.pmod(F.xxhash64("row", F.lit(2)), F.lit(blocks)).cast("int"))
    queries = queries.mapInArrow(
        _route_batches(shared, parts, shards, ratio, 2 * REPLICAS * (k + 1)),
        "query_row long, query_id long, query array<double>, block int, shard int, wanted array<long>",
    )
    found = postings.groupBy("shard", "block").cogroup(queries.groupBy("shard", "block")).applyInArrow(_best(k), schema)
    # A vector replicated to lists of several shards is found more than once.
    found = found.groupBy("query_row", "query_id", "row", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "row")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
