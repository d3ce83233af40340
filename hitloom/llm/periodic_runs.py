"""Runs of repeated word sequences, found by uniting suffixes in order of falling LCP.

A run is a stretch of consecutive words of smallest period q, at least ``TIMES`` * q and
``LEAST`` words long, that no neighbouring word extends. For a run that starts at s and
is L words long, the suffixes at s and s + q share exactly L - q words, and no suffix
between them shares as many (else the period would be smaller). So:

1. the words of some texts become integers, different for each text. Only stretches
   that share as many words as a run needs with another stretch go on; prefix doubling
   ranks equal stretches of 1, 2, 4, ... of their words, which gives suffix order and LCP;
2. neighbours in suffix order are united by decreasing LCP with union-find. Each class
   keeps its positions in order, and the smaller class is put into the larger;
3. a position put in becomes adjacent to its two neighbours there. If two newly
   adjacent positions are q apart and share at least max(``TIMES`` * q, ``LEAST``) - q
   words, they seed a run of period q; it is reported if it can't start earlier.

A text is the unit of work, so this is one pass over the documents without a shuffle;
texts are taken in pieces of about ``PIECE_BYTES`` so that memory stays bounded by that
and the longest text.
"""

from __future__ import annotations

import sys
from bisect import bisect_left
from collections import defaultdict
from itertools import chain, count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hitloom.llm import common

common.ship(sys.modules[__name__])

TIMES, LEAST = 3, 24
PIECE_BYTES = 4 << 20
RUN_TYPE = "array<struct<start: long, length: long, period: long>>"
_BLOCK = 1024
#: Odd multipliers of the hashes.
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], dtype=np.uint64)


class Positions:
    """Integers in order, in blocks of at most twice ``_BLOCK``."""

    __slots__ = ("blocks", "lasts", "size")

    def __init__(self, value: int) -> None:
        self.blocks, self.lasts, self.size = [[value]], [value], 1

    def add(self, value: int) -> tuple[int, int]:
        """Put in a new value; the ones before and after it, or -1."""
        k = min(bisect_left(self.lasts, value), len(self.blocks) - 1)
        block = self.blocks[k]
        at = bisect_left(block, value)
        before = block[at - 1] if at else (self.lasts[k - 1] if k else -1)
        after = block[at] if at < len(block) else (self.blocks[k + 1][0] if k + 1 < len(self.blocks) else -1)
        block.insert(at, value)
        self.lasts[k] = block[-1]
        self.size += 1
        if len(block) > 2 * _BLOCK:
            self.blocks[k : k + 1] = [block[:_BLOCK], block[_BLOCK:]]
            self.lasts[k : k + 1] = [block[_BLOCK - 1], block[-1]]
        return before, after

    def __iter__(self):
        return chain.from_iterable(self.blocks)


def fewest_shared(times: int = TIMES, least: int = LEAST) -> int:
    """The fewest words that two suffixes of a run can share, over all periods."""
    return min(max(times * q, least) - q for q in range(1, least + 1))


def covered(codes: np.ndarray, shared: int) -> np.ndarray:
    """Which positions lie in a stretch of ``shared`` codes that may occur twice.

    Decided by a hash, so a few may be marked in vain, but none is missed.
    """
    inside = np.zeros(len(codes), dtype=bool)
    windows = len(codes) - shared + 1
    if windows < 2:
        return inside
    part, width, hashed, done = codes.astype(np.uint64) * _MIX[0], 1, None, 0
    while width <= shared:
        if shared & width:
            tail = part[done : done + windows]
            hashed = tail if hashed is None else (hashed * _MIX[1]) ^ tail
            done += width
        if 2 * width <= shared:
            both = part[:-width] * _MIX[2] + part[width:]
            part = (both ^ (both >> np.uint64(31))) * _MIX[0]
        width *= 2
    order = np.argsort(hashed)
    ranked = hashed[order]
    same = ranked[1:] == ranked[:-1]
    twice = np.zeros(windows, dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    steps = np.zeros(len(codes) + 1, dtype=np.int64)
    steps[:windows] += twice
    steps[shared : shared + windows] -= twice
    return np.cumsum(steps[:-1]) > 0


def rank_by_doubling(codes: np.ndarray) -> list[np.ndarray]:
    """``ranks[k]``: equal for two positions just if their next 2^k codes are equal.

    A rank is the number of positions that sort before; the last ranks are all
    different. The last code must occur once.
    """
    size, width = len(codes), 1
    _, place, counts = np.unique(codes, return_inverse=True, return_counts=True)
    ranks = [(np.cumsum(counts) - counts)[place]]
    active = np.flatnonzero(counts[place] > 1)
    while len(active):
        rank = ranks[-1]
        key = rank[active] * size + rank[active + width]
        order = np.argsort(key, kind="stable")
        active, key = active[order], key[order]
        parent = rank[active]
        fresh = np.ones(len(active), dtype=bool)
        fresh[1:] = key[1:] != key[:-1]
        first = np.ones(len(active), dtype=bool)
        first[1:] = parent[1:] != parent[:-1]
        starts, group = np.flatnonzero(fresh), np.cumsum(fresh) - 1
        base = np.flatnonzero(first)[np.cumsum(first) - 1]
        rank = rank.copy()
        rank[active] = parent + starts[group] - base
        ranks.append(rank)
        sizes = np.diff(np.append(starts, len(active)))
        active = np.sort(active[sizes[group] > 1])
        width *= 2
    return ranks


def neighbours(ranks: list[np.ndarray], shared: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Neighbours in suffix order that share at least ``shared`` codes, by decreasing LCP."""
    order = np.argsort(ranks[-1])
    left, right = order[:-1], order[1:]
    common_length = np.zeros(len(left), dtype=np.int64)
    size = len(order)
    for k in range(len(ranks) - 1, -1, -1):
        one, other = left + common_length, right + common_length
        # Positions behind the last one equal nothing.
        equal = (one < size) & (other < size)
        equal[equal] = ranks[k][one[equal]] == ranks[k][other[equal]]
        common_length += equal * (1 << k)
    kept = np.flatnonzero(common_length >= shared)
    kept = kept[np.argsort(-common_length[kept], kind="stable")]
    return left[kept], right[kept], common_length[kept]


def seeds(left: np.ndarray, right: np.ndarray, lcp: np.ndarray, where: np.ndarray, times: int, least: int):
    """(position, period, shared words) of positions that become adjacent in a class close enough.

    ``where`` gives the place in the texts of a position in the suffix order.
    """
    parent: dict[int, int] = {}
    classes: dict[int, Positions] = {}

    def root(x: int) -> int:
        while (above := parent.get(x, x)) != x:
            parent[x] = x = parent.get(above, above)
        return x

    for a, b, length in zip(where[left].tolist(), where[right].tolist(), lcp.tolist()):
        a, b = root(a), root(b)
        large, small = classes.get(a) or Positions(a), classes.pop(b, None) or (b,)
        if large.size < (small.size if isinstance(small, Positions) else 1):
            a, b = b, a
            classes.pop(b, None)
            large, small = small, large
        parent[b] = a
        classes[a] = large
        pending, last = None, -1
        for value in small:
            before, after = large.add(value)
            if pending and value > pending[1]:
                q = pending[1] - pending[0]
                if max(times * q, least) - q <= length:
                    yield pending[0], q, length
            q = value - before
            # Two positions of the smaller class were adjacent before.
            if before > last and max(times * q, least) - q <= length:
                yield before, q, length
            pending, last = ((value, after) if after >= 0 else None), value
        if pending:
            q = pending[1] - pending[0]
            if max(times * q, least) - q <= length:
                yield pending[0], q, length


def find_runs(codes: np.ndarray, times: int = TIMES, least: int = LEAST) -> list[tuple[int, int, int]]:
    """All runs (start, length, period) in a sequence of integers, in order of start and period.

    Texts may follow each other if no integer occurs in two of them.
    """
    shared = fewest_shared(times, least)
    kept = np.flatnonzero(covered(codes, shared))
    if not len(kept):
        return []
    # Between stretches, and at the end, stands an integer that occurs once.
    gaps = np.append(np.flatnonzero(np.diff(kept) > 1), len(kept) - 1)
    where = np.insert(kept, gaps + 1, -1)
    short = np.insert(codes[kept], gaps + 1, codes.max() + 1 + np.arange(len(gaps)))
    found: dict[tuple[int, int], int] = {}
    for start, q, length in seeds(*neighbours(rank_by_doubling(short), shared), where, times, least):
        if start and codes[start - 1] == codes[start - 1 + q]:
            continue
        # Among unions of one LCP, two positions may be adjacent for a while whose
        # distance is a multiple of the period; the run is the same.
        run = (start, q + length)
        found[run] = min(q, found.get(run, q))
    return sorted(((start, length, q) for (start, length), q in found.items()), key=lambda r: (r[0], r[2]))


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words without those that a run contains after its first period."""
    dropped = np.zeros(len(words) + 1, dtype=np.int64)
    for start, length, q in runs:
        dropped[start + q] += 1
        dropped[start + length] -= 1
    kept = np.cumsum(dropped[:-1]) == 0
    return b" ".join(word for word, keep in zip(words, kept.tolist()) if keep)


def _piece(texts: list[bytes], times: int, least: int) -> list[tuple[int, list, bytes]]:
    """Number of words, runs and collapsed text of each text."""
    fresh = count()
    codes, sizes, plain = [], [], []
    for text in texts:
        words = text.split()
        named = defaultdict(fresh.__next__)
        codes.append(np.fromiter(map(named.__getitem__, words), np.int64, len(words)))
        sizes.append(len(words))
        plain.append(b" ".join(words))
    ends = np.cumsum(sizes)
    runs: dict[int, list] = defaultdict(list)
    for start, length, q in find_runs(np.concatenate(codes), times, least) if sum(sizes) else []:
        at = int(np.searchsorted(ends, start, side="right"))
        runs[at].append((start - int(ends[at]) + sizes[at], length, q))
    for at, found in runs.items():
        plain[at] = collapse(plain[at].split(), found)
    return [(size, runs.get(k, []), text) for k, (size, text) in enumerate(zip(sizes, plain))]


def _work(times: int, least: int):
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(batches):
        for batch in batches:
            texts = batch.column(batch.num_columns - 1).cast(pa.large_binary())
            start = 0
            while start < len(texts):
                piece, held = [], 0
                while start + len(piece) < len(texts) and (not piece or held < PIECE_BYTES):
                    piece.append(texts[start + len(piece)].as_py() or b"")
                    held += len(piece[-1])
                found = _piece(piece, times, least)
                runs = [[{"start": s, "length": n, "period": q} for s, n, q in f[1]] for f in found]
                more = [pa.array([f[0] for f in found], pa.int64()), pa.array(runs, kind), pa.array([f[2].decode("utf-8", "replace") for f in found])]
                kept = batch.slice(start, len(piece)).columns[:-1]
                yield pa.RecordBatch.from_arrays([*kept, *more], names=[*batch.schema.names[:-1], "n_words", "runs", "collapsed"])
                start += len(piece)

    return run


def periodic_runs(docs: DataFrame, keep: list[str], text: str | Column = "text", times: int = TIMES, least: int = LEAST) -> DataFrame:
    """The ``keep`` columns of every row with ``n_words``, ``runs`` and ``collapsed``.

    Words are what white space of ASCII separates. ``runs`` holds (start, length,
    period) in words, in order of start and period, of every run of at least ``times``
    periods and ``least`` words; ``collapsed`` is the text, its words joined by one
    space, with one period of each run. Null and empty texts have no words, no runs and
    an empty ``collapsed``. Repeated rows are treated alike, an empty table gives no
    rows; a kept column must not have the name of a new one.
    """
    clash = {"n_words", "runs", "collapsed"} & set(keep)
    if clash:
        raise ValueError(f"rename these columns first: {sorted(clash)}")
    narrow = docs.select(*keep, (F.col(text) if isinstance(text, str) else text).alias("__text"))
    schema = narrow.drop("__text").select("*", F.lit(0).cast("long").alias("n_words"), F.lit(None).cast(RUN_TYPE).alias("runs"), F.lit("").alias("collapsed")).schema
    return narrow.mapInArrow(_work(times, least), schema)


def planted_periods(doc_id: Column, text: Column) -> Column:
    """The text with a tail made periodic, for a tenth of the ids.

    With h the CRC-32 of the decimal id, g = h / 10 and n words: if h % 10 is 0, words
    from a = g % n on repeat with period 1 + (n - a) / (3 + g % 8). Other texts, those
    without words and those without an id stay.
    """
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10)
    words = F.filter(F.split(text, r"[ \x09-\x0D]+"), lambda w: w != "")

    def repeated(ws: Column) -> Column:
        n = F.size(ws).cast("long")
        a = g % n
        p = F.floor((n - a) / (F.lit(3) + g % 8)) + 1
        return F.transform(ws, lambda w, i: F.when(i < a, w).otherwise(F.get(ws, (a + (i - a) % p).cast("int"))))

    # The one-element array names the words, so that they are split once.
    tail = F.flatten(F.transform(F.array(words), lambda ws: F.when(F.size(ws) > 0, repeated(ws)).otherwise(ws)))
    return F.when((h % 10 == 0) & text.isNotNull(), F.array_join(tail, " ")).otherwise(text)


def _rational_first(one: Column, other: Column) -> Column:
    """Order of runs by falling length / period, then start, then period."""
    left, right = one["length"] * other["period"], other["length"] * one["period"]
    order = F.when(left > right, -1).when(left < right, 1)
    for name in ("start", "period"):
        order = order.when(one[name] < other[name], -1).when(one[name] > other[name], 1)
    return order.otherwise(0)


def run_report(docs: DataFrame) -> DataFrame:
    """Digest of the runs of all documents whose ids have planted periods, one row per document.

    The best run is the one with the greatest length / period, compared as integers.
    """
    found = periodic_runs(docs, ["doc_id"], planted_periods(F.col("doc_id"), F.col("text")))
    best = F.get(F.array_sort("runs", _rational_first), F.lit(0))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
