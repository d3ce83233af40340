"""Mixing sources to target weights by temperature.

A source with share s of all tokens gets the weight s^a / sum(s^a). The exponent a
runs from 0 (all sources alike) to 1 (as they are). It is bisected twice: to the
largest one whose weights reach a target entropy, and to the smallest one under
which no source repeats more often than allowed; the larger of both holds, so the
repetition limit wins.

The weights become token budgets. Each pass over a source (an epoch) is a permutation
of blocks of about ``BLOCK_TOKENS`` tokens, shuffled inside, keyed by seed and epoch;
the last epoch is cut where its budget ends. Running sums go over block totals first
and inside blocks then, so no source, however large, is sorted or summed in one task.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hitloom.llm import common

TARGET_ENTROPY = 0.9
MAX_REPEATS = 4.0
BLOCK_TOKENS = 100_000
STEPS = 24
SEED = 7


def token_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def keyed(*parts: Column) -> Column:
    """A number of 52 bits from a keyed hash of the parts; null counts as an empty text."""
    joined = F.concat_ws("|", *(F.coalesce(p.cast("string"), F.lit("")) for p in parts))
    return F.conv(F.substring(F.md5(joined), 1, 13), 16, 10).cast("long")


def source_totals(docs: DataFrame) -> DataFrame:
    """Stored ``source``, ``tokens`` of the sources with tokens; null is a source of its own."""
    totals = docs.groupBy("source").agg(F.sum("n_tokens").alias("tokens"))
    return common.store(totals.where("tokens > 0"), "source-totals")


def _power(exponent: float) -> Column:
    return F.pow(F.col("tokens").cast("double"), F.lit(exponent))


def _measures(totals: DataFrame, exponent: float, budget: int) -> tuple[float, float]:
    """Entropy relative to its maximum and largest repetition at an exponent."""
    power = _power(exponent)
    sums = totals.agg(F.sum(power), F.sum(power * F.log(power)), F.max(power / F.col("tokens")), F.count("*"))
    whole, logs, most, sources = sums.first()
    entropy = math.log(whole) - logs / whole
    return (entropy / math.log(sources) if sources > 1 else 1.0), most * budget / whole


def exponent_for(totals: DataFrame, budget: int, entropy: float = TARGET_ENTROPY, repeats: float = MAX_REPEATS) -> float:
    """The exponent that meets the entropy if it can without breaking the repetition limit."""
    plain = _measures(totals, 1.0, budget)
    if plain[1] > repeats:
        raise ValueError(f"a budget of {budget} tokens repeats every source more than {repeats} times")
    if plain[0] >= entropy:
        return 1.0
    low, high = 0.0, 1.0
    for _ in range(STEPS):
        middle = (low + high) / 2
        reached, repeated = _measures(totals, middle, budget)
        # Both fall as the exponent grows: too even or too repetitive means going up.
        if reached >= entropy or repeated > repeats:
            low = middle
        else:
            high = middle
    return high


def budgets(totals: DataFrame, exponent: float, budget: int) -> DataFrame:
    """``source``, ``tokens``, ``weight``, ``quota``, ``epochs`` (full passes), ``rest`` (tokens of the last)."""
    whole = totals.agg(F.sum(_power(exponent))).first()[0]
    weighted = totals.withColumn("weight", _power(exponent) / F.lit(whole))
    quota = F.round(F.col("weight") * budget).cast("long")
    return weighted.withColumn("quota", quota).select(
        "source", "tokens", "weight", "quota", F.floor(F.col("quota") / F.col("tokens")).alias("epochs"), (F.col("quota") % F.col("tokens")).alias("rest")
    )


def mix(docs: DataFrame, budget: int | None = None, entropy: float = TARGET_ENTROPY, repeats: float = MAX_REPEATS, seed: int = SEED, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """The plan of a mixture: one row per use of a document.

    ``docs`` has ``row_id`` (unique or at least the same for rows that are alike),
    ``source`` and ``n_tokens``. Returns ``row_id``, ``source``, ``n_tokens``,
    ``epoch`` (from 0), ``block`` and ``start``, the tokens of the source's epoch that
    come before it. Documents without tokens are used once per full epoch of their source;
    a source without any token has no share, and none of its documents is used. ``budget``
    defaults to all tokens. A table without tokens gives no rows.
    """
    docs = common.store(docs.select("row_id", "source", F.coalesce("n_tokens", F.lit(0)).cast("long").alias("n_tokens")), "mix-docs")
    totals = source_totals(docs)
    total = totals.agg(F.sum("tokens")).first()[0] or 0
    if not total:
        return docs.limit(0).select("row_id", "source", "n_tokens", *(F.lit(0).cast("long").alias(c) for c in ("epoch", "block", "start")))
    budget = total if budget is None else budget
    planned = common.store(budgets(totals, exponent_for(totals, budget, entropy, repeats), budget), "budgets")
    same = F.col("d.source").eqNullSafe(F.col("p.source"))
    uses = docs.alias("d").join(planned.alias("p"), same).select(
        "row_id", F.col("d.source").alias("source"), "n_tokens", "rest", "epochs",
        F.pmod(keyed(F.lit(seed), F.col("row_id")), F.ceil(F.col("tokens") / block_tokens)).alias("block"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("epochs"))).alias("epoch"),
    ).where("epoch < epochs OR rest > 0")
    blocks = uses.groupBy("source", "epoch", "block").agg(F.sum("n_tokens").alias("block_tokens"))
    order = Window.partitionBy("source", "epoch").orderBy(keyed(F.lit(seed), F.col("epoch"), F.lit("block"), F.col("block")), "block")
    before = F.coalesce(F.sum("block_tokens").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    blocks = common.store(blocks.select("source", "epoch", "block", before.alias("block_start")), "blocks")
    inside = Window.partitionBy("source", "epoch", "block").orderBy(keyed(F.lit(seed), F.col("epoch"), F.col("row_id")), "row_id", "n_tokens")
    ahead = F.coalesce(F.sum("n_tokens").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = uses.withColumn("ahead", ahead).alias("u").join(
        blocks.alias("b"),
        F.col("u.source").eqNullSafe(F.col("b.source")) & (F.col("u.epoch") == F.col("b.epoch")) & (F.col("u.block") == F.col("b.block")),
    )
    start = F.col("block_start") + F.col("ahead")
    fits = (F.col("u.epoch") < F.col("epochs")) | (start + F.col("n_tokens") <= F.col("rest"))
    return placed.where(fits).select("row_id", "u.source", "n_tokens", "u.epoch", "u.block", start.alias("start"))


def mix_documents(docs: DataFrame, **options) -> DataFrame:
    """`mix` of documents named by ``doc_id``; repeated ids count as rows of their own."""
    named = docs.select(F.col("doc_id").alias("row_id"), "source", token_count(F.col("text")).alias("n_tokens"))
    return mix(named, **options).withColumnRenamed("row_id", "doc_id")


def mixed_texts(docs: DataFrame, **options) -> DataFrame:
    """The documents themselves, all columns, once per use, with ``epoch``, ``block`` and ``start``."""
    rows = common.store(docs.withColumn("__row", F.monotonically_increasing_id()), "rows")
    plan = mix(rows.select(F.col("__row").alias("row_id"), "source", token_count(F.col("text")).alias("n_tokens")), **options)
    plan = plan.select("row_id", F.col("epoch").alias("__epoch"), F.col("block").alias("__block"), F.col("start").alias("__start"))
    extra = [F.col(f"__{c}").alias(c) for c in ("epoch", "block", "start") if c not in docs.columns]
    return rows.join(plan, rows["__row"] == plan["row_id"]).select(*docs.columns, *extra)
