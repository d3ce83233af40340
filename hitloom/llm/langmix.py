"""Language identification by multilingual mixture inference.

A text is a mixture of languages: each of its character n-grams (three bytes of the
lower-cased UTF-8 letters, words set apart by spaces) is drawn from one of them.
Expectation-maximisation estimates each document's proportions from the n-gram
likelihoods of the learned languages. The language set is the number of languages, in
order of proportion, whose likelihood less a penalty per language is largest.

Counts per language cover all documents that may be learned from; they are summed per
task first. The table of likelihoods is 2^16 values per language and is broadcast: its
size follows the number of languages, not of documents. Prediction is one pass
without a shuffle.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hitloom.llm import common

common.ship(sys.modules[__name__])

BUCKETS = 1 << 16
SMOOTHING = 0.5
#: Price of one more language in units of the logarithm of the number of n-grams.
PENALTY = 3.0
STEPS = 20
UNKNOWN = "und"
_CHUNK = 1 << 20
_KEEP = np.zeros(256, dtype=np.uint8)
_KEEP[97:123] = np.arange(97, 123)
_KEEP[128:] = np.arange(128, 256)


def grams(data: bytes) -> np.ndarray:
    """Buckets of the n-grams of lower-cased UTF-8; those around a gap between words are left out."""
    if not data:
        return np.zeros(0, dtype=np.int64)
    raw = _KEEP[np.frombuffer(data, dtype=np.uint8)]
    # One gap between words, one at each end.
    keep = (raw > 0) | (np.concatenate(([1], raw[:-1])) > 0)
    body = np.concatenate(([0], raw[keep], [0])).astype(np.uint32)
    codes = (body[:-2] * 40503 + body[1:-1] * 7919 + body[2:] * 31337) % 65521
    return codes[body[1:-1] > 0].astype(np.int64)


def _pieces(text: str | None) -> Iterator[bytes]:
    """A text's lower-cased bytes in pieces of bounded size, cut at spaces where there are any."""
    data = (text or "").lower().encode()
    at = 0
    while at < len(data):
        end = at + _CHUNK
        cut = data.rfind(b" ", at, end) if end < len(data) else -1
        end = cut + 1 if cut > at else end
        yield data[at:end]
        at = end


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals: dict[str, np.ndarray] = {}
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            counts = totals.setdefault(lang, np.zeros(BUCKETS, dtype=np.int64))
            for piece in _pieces(text.as_py()):
                counts += np.bincount(grams(piece), minlength=BUCKETS)
    for lang, counts in totals.items():
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(used)), pa.array(used), pa.array(counts[used])], names=["lang", "gram", "n"])


def learn(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages in order and their n-gram likelihoods (n-grams by languages) from ``text`` and ``lang``.

    Rows without language or text are ignored; so are languages without any n-gram.
    """
    rows = docs.select("lang", "text").where("lang IS NOT NULL AND text IS NOT NULL")
    counted = rows.mapInArrow(_count_batches, "lang string, gram long, n long")
    table = counted.groupBy("lang", "gram").agg(F.sum("n").alias("n")).toArrow()  # languages * BUCKETS rows
    langs = sorted(set(table["lang"].to_pylist()))
    place = {lang: k for k, lang in enumerate(langs)}
    counts = np.full((BUCKETS, len(langs)), SMOOTHING)
    columns = np.array([place[lang] for lang in table["lang"].to_pylist()], dtype=np.int64)
    np.add.at(counts, (table["gram"].to_numpy(), columns), table["n"].to_numpy())
    return langs, (counts / counts.sum(0)).astype(np.float32)


class _Batch:
    """N-gram counts of several documents, sorted by document, with their likelihoods."""

    def __init__(self, owner, counts, likelihood):
        self.counts, self.likelihood = counts.astype(np.float32), likelihood
        self.docs, self.starts = np.unique(owner, return_index=True)
        self.sizes = np.diff(np.append(self.starts, len(owner)))
        self.total = np.add.reduceat(self.counts, self.starts)

    def only(self, rows: np.ndarray) -> "_Batch":
        """Some of its documents."""
        chosen = np.zeros(len(self.docs), dtype=bool)
        chosen[rows] = True
        entries = np.repeat(chosen, self.sizes)
        return _Batch(np.repeat(self.docs, self.sizes)[entries], self.counts[entries], self.likelihood[entries])

    def fit(self, share: np.ndarray, steps: int = STEPS) -> tuple[np.ndarray, np.ndarray]:
        """Proportions after expectation-maximisation from ``share``, and the log-likelihood."""
        for _ in range(steps):
            mixed = (self.likelihood * np.repeat(share, self.sizes, axis=0)).sum(1)
            weight = self.likelihood * (self.counts / mixed)[:, None]
            after = share * np.add.reduceat(weight, self.starts, axis=0) / self.total[:, None]
            moved = np.abs(after - share).max()
            share = after
            if moved < 1e-3:
                break
        mixed = (self.likelihood * np.repeat(share, self.sizes, axis=0)).sum(1)
        return share, np.add.reduceat(self.counts * np.log(mixed), self.starts)


def mixtures(texts: list[str | None], likelihood: np.ndarray) -> np.ndarray:
    """Proportions of the selected languages per text; all zero for texts without n-grams."""
    languages = likelihood.shape[1]
    shares = np.zeros((len(texts), languages), dtype=np.float32)
    owners, codes, counts = [], [], []
    for k, text in enumerate(texts):
        buckets = np.zeros(0, dtype=np.int64)
        total: np.ndarray | None = None
        for piece in _pieces(text):
            if total is None and len(buckets) == 0:
                buckets = grams(piece)
            else:
                total = np.bincount(buckets, minlength=BUCKETS) if total is None else total
                total += np.bincount(grams(piece), minlength=BUCKETS)
        if total is None:
            found, number = np.unique(buckets, return_counts=True)
        else:
            found = np.flatnonzero(total)
            number = total[found]
        owners.append(np.full(len(found), k))
        codes.append(found)
        counts.append(number)
    owner, code, count = np.concatenate(owners), np.concatenate(codes), np.concatenate(counts)
    if not len(owner) or not languages:
        return shares
    batch = _Batch(owner, count, likelihood[code])
    even = np.full((len(batch.docs), languages), 1 / languages, dtype=np.float32)
    full, best_fit = batch.fit(even)
    # Languages in order of proportion; ties go to the earlier.
    order = np.argsort(-full, axis=1, kind="stable")
    singles = np.add.reduceat(batch.counts[:, None] * np.log(batch.likelihood), batch.starts, axis=0)
    first = order[:, 0]
    here = np.arange(len(first))
    # Alone, the likeliest language counts, which need not be the largest share.
    alone = singles.argmax(1)
    first = np.where(singles[here, alone] > singles[here, first], alone, first)
    chosen = np.zeros_like(full)
    chosen[here, first] = 1
    price = PENALTY * np.log(batch.total + 1)
    value = singles[here, first].copy()
    open_ = np.flatnonzero(best_fit - price > value)
    for size in range(2, languages + 1):
        # No larger set can beat the best so far by more than the whole set's likelihood allows.
        open_ = open_[best_fit[open_] - (size - 1) * price[open_] > value[open_]]
        if not len(open_):
            break
        allowed = np.zeros((len(open_), languages), dtype=np.float32)
        np.put_along_axis(allowed, order[open_, :size], 1 / size, axis=1)
        share, fit = batch.only(open_).fit(allowed)
        gain = fit - (size - 1) * price[open_]
        better = gain > value[open_]
        rows = open_[better]
        chosen[rows], value[rows] = share[better], gain[better]
    shares[batch.docs] = chosen
    return shares


def _predict_batches(shared):
    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs, likelihood = shared.value
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            start, held, taken = 0, 0, []
            for k in range(len(texts)):
                taken.append(texts[k].as_py())
                held += len(taken[-1] or "")
                if held > _CHUNK or k + 1 == len(texts):
                    yield _predicted(batch.slice(start, len(taken)), taken, langs, likelihood)
                    start, held, taken = k + 1, 0, []

    return predict


def _predicted(rows: pa.RecordBatch, texts: list[str | None], langs: list[str], likelihood: np.ndarray) -> pa.RecordBatch:
    shares = mixtures(texts, likelihood)
    lettered = [any(map(str.isalpha, t or "")) for t in texts]
    names, scores, parts = [], [], []
    for share, known in zip(shares, lettered):
        if not known or not share.any():
            names.append(UNKNOWN)
            scores.append(0.0)
            parts.append([])
            continue
        main = int(share.argmax())
        names.append(langs[main])
        scores.append(float(min(1.0, share[main])))
        parts.append([{"lang": langs[k], "share": float(share[k])} for k in np.argsort(-share, kind="stable") if share[k] > 0])
    kind = pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())]))
    columns = [*rows.columns[:-1], pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(parts, kind)]
    return pa.RecordBatch.from_arrays(columns, names=[*rows.schema.names[:-1], "lang_pred", "score", "languages"])


def identify(docs: DataFrame, langs: list[str], likelihood: np.ndarray, keep: list[str], text: str = "text") -> DataFrame:
    """The ``keep`` columns, ``lang_pred``, its proportion ``score`` and all ``languages`` with shares.

    Null texts and texts without a letter are ``und`` with score 0.
    """
    shared = docs.sparkSession.sparkContext.broadcast((langs, likelihood))
    narrow = docs.select(*keep, F.col(text).alias("__text"))
    extra = "lang_pred string, score double, languages array<struct<lang: string, share: double>>"
    kept = narrow.drop("__text").schema
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept] + [extra])
    return narrow.mapInArrow(_predict_batches(shared), schema)


def _fold(folds: int) -> Column:
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(folds))


def identify_documents(docs: DataFrame, folds: int = 3, held: int = 1) -> DataFrame:
    """Predictions for all documents by a model that has seen none of the fold held out.

    Returns ``doc_id``, ``held_out``, ``lang_pred``, ``score``, ``languages`` for every
    row, repeated rows and rows without id (neither held out nor learned from)
    included. Without anything to learn from every text is ``und``. Very long texts
    are counted in pieces, whole.
    """
    langs, likelihood = learn(docs.where(_fold(folds) != held))
    found = identify(docs, langs, likelihood, ["doc_id"])
    held_out = F.coalesce(_fold(folds) == held, F.lit(False)).alias("held_out")
    return found.select("doc_id", held_out, "lang_pred", "score", "languages")
