"""Labels for coded columns, and tables of names that expressions can look into."""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hitloom.session import checkpoint_folder

#: A table of names for expressions has at most so many rows; more are an error.
MAX_NAMES = 1_000_000
NAME_SLOTS = 4096


def unique_lookup(lookup: DataFrame) -> DataFrame:
    """One row per id, so that a label join never multiplies hits."""
    return lookup.filter(F.col("id").isNotNull()).groupBy("id").agg(F.min("name").alias("name"))


def reduce_lookup(lookup: DataFrame, hits: DataFrame, key: str) -> DataFrame:
    """Only the ids that occur in ``hits``; written out, it is small to join."""
    present = hits.select(F.col(key).try_cast("bigint").alias("id")).filter(F.col("id").isNotNull()).distinct()
    return lookup.join(present, "id", "left_semi")


def reduce_lookups(lookups: Mapping[str, tuple[DataFrame, str]], hits: DataFrame) -> dict[str, DataFrame]:
    """`reduce_lookup` and `unique_lookup` of several (lookup, key column) in one pass over the hits.

    The ids that occur are one small table of (lookup, id), kept in the checkpoint folder.
    """
    pairs = F.array(
        *[F.struct(F.lit(name).alias("lookup"), F.col(key).try_cast("bigint").alias("id")) for name, (_, key) in lookups.items()]
    )
    checkpoint_folder(hits.sparkSession)
    present = hits.select(F.explode(pairs).alias("p")).select("p.*").filter("id IS NOT NULL").distinct().checkpoint()
    return {
        name: unique_lookup(table).join(present.filter(F.col("lookup") == name), "id", "left_semi")
        for name, (table, _) in lookups.items()
    }


def label(code: str, name: str, prefix: str) -> Column:
    """The looked-up name, else the prefix with the code; NULL for no code."""
    return F.coalesce(F.col(name), F.concat(F.lit(prefix + " "), F.col(code)))


def join_label(df: DataFrame, lookup: DataFrame, key: str, prefix: str, out: str) -> DataFrame:
    """Left join on the safely cast code.

    No hint: a lookup under ``spark.sql.autoBroadcastJoinThreshold`` is broadcast
    by its size, a larger one is merge-joined with adaptive skew splitting.
    """
    found = unique_lookup(lookup).select(F.col("id").cast("bigint").alias("_id"), F.col("name").alias("_name"))
    return (
        df.join(found, F.col(key).try_cast("bigint") == F.col("_id"), "left")
        .withColumn(out, label(key, "_name", prefix))
        .drop("_id", "_name")
    )


def code_counts(codes: DataFrame) -> DataFrame:
    """``rows`` of each ``code`` that occurs, kept in the checkpoint folder."""
    checkpoint_folder(codes.sparkSession)
    return codes.filter("code IS NOT NULL").groupBy("code").agg(F.count(F.lit(1)).alias("rows")).checkpoint()


def occurring_names(names: DataFrame, codes: DataFrame, key: str = "code") -> DataFrame:
    """The rows of ``names`` whose key occurs among the ``codes``, one per key, read back from a folder.

    Of rows with the same key the least of each other column counts, as in `name_table`.
    ``codes`` has the key and may repeat it. The folder is in the checkpoint folder; being
    a file, the result is broadcast in joins if it is small, however large ``names`` is.
    """
    spark = names.sparkSession
    others = [F.min(name).alias(name) for name in names.columns if name != key]
    unique = names.filter(F.col(key).isNotNull()).groupBy(key).agg(*others)
    path = f"{checkpoint_folder(spark).rstrip('/')}/names-{uuid.uuid4().hex}"
    unique.join(codes.select(key).distinct(), key, "left_semi").write.parquet(path)
    return spark.read.schema(unique.schema).parquet(path)


def fits_in_memory(names: DataFrame) -> bool:
    """Whether `name_table` takes so many names."""
    return names.limit(MAX_NAMES + 1).count() <= MAX_NAMES


def name_table(names: DataFrame, key: str = "code") -> Column:
    """All rows of ``names`` by ``key`` in one value, for `find_name` in any expression.

    Of rows with the same key the least of each other column counts; NULL keys are left
    out. The value is computed by a scalar subquery once when a plan that uses it runs: no
    job while planning, no join, no shuffle of the rows that look into it, and it works on
    a stream. Where a lambda needs it, select it as a column first; the optimizer puts it
    in its place. A map in Spark is read from its start, so codes are dealt to
    ``NAME_SLOTS`` short ones. A table of more than ``MAX_NAMES`` keys, too large to be
    sent to every task, fails with a message that names the way to join it instead.
    """
    others = [name for name in names.columns if name != key]
    code = F.col(key).cast("bigint")
    keyed = names.select(code.alias("_code"), *others, F.pmod(code, F.lit(NAME_SLOTS)).cast("int").alias("_slot"))
    # One row without a key for each slot: there are no gaps between slots then.
    empty = names.sparkSession.range(NAME_SLOTS).select(F.col("id").cast("int").alias("_slot"))
    dealt = keyed.filter("_code IS NOT NULL").unionByName(empty, allowMissingColumns=True).repartition("_slot")
    unique = dealt.groupBy("_slot", "_code").agg(*[F.min(name).alias(name) for name in others])
    entry = F.when(F.col("_code").isNotNull(), F.struct(F.col("_code"), F.struct(*others)))
    slots = unique.groupBy("_slot").agg(F.map_from_entries(F.collect_list(entry)).alias("_names"), F.count("_code").alias("_rows"))
    by_slot = F.array_sort(F.collect_list(F.struct("_slot", "_names")), lambda a, b: a["_slot"] - b["_slot"])
    whole = slots.agg(F.transform(by_slot, lambda s: s["_names"]).alias("names"), F.sum("_rows").alias("rows"))
    message = F.lit(f"more than {MAX_NAMES} names for a table in memory: use event_lookup = 'join'")
    checked = F.when(F.col("rows") <= MAX_NAMES, F.col("names")).otherwise(F.raise_error(message))
    return whole.select(checked.alias("names")).scalar()


def find_name(table: Column, code: Column) -> Column:
    """The struct of the other columns that a `name_table` has for a code, or NULL."""
    return F.try_element_at(F.get(table, F.pmod(code, F.lit(NAME_SLOTS)).cast("int")), code.cast("bigint"))
