"""What several operators share: stored intermediates, text identity, components."""

from __future__ import annotations

import gc
import uuid
from collections.abc import Callable

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hitloom.session import checkpoint_folder

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ship(module) -> None:
    """Send a module's functions with the job, so that executors need no copy of this package."""
    cloudpickle.register_pickle_by_value(module)


def work_folder(spark: SparkSession) -> str:
    """This application's folder below the shared ``spark.checkpoint.dir``."""
    return f"{checkpoint_folder(spark).rstrip('/')}/hitloom-llm-{spark.sparkContext.applicationId}"


def store(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: a lost executor repeats no earlier work."""
    path = f"{work_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    stored = df.sparkSession.read.schema(df.schema).parquet(path)
    stored.hitloom_path = path
    return stored


def discard(*stored: DataFrame) -> None:
    """Delete tables made by `store` that no later result reads."""
    for df in stored:
        path = getattr(df, "hitloom_path", None)
        if path:
            spark = df.sparkSession
            target = spark._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def release(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files of plans that nothing refers to any more."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


#: So many 16-byte keys may be broadcast; above, the other side is shuffled to them.
BROADCAST_KEYS = 1_000_000


def bounded(keys: DataFrame) -> DataFrame:
    """Stored distinct keys, marked for broadcasting if a count shows that they are few."""
    keys = store(keys.distinct(), "keys")
    return F.broadcast(keys) if keys.count() <= BROADCAST_KEYS else keys


def ascii_lower(word: Column) -> Column:
    """Lower-case A-Z and no other letter."""
    # lower() takes a short way on ASCII words, which most are.
    return F.when(F.octet_length(word) == F.char_length(word), F.lower(word)).otherwise(
        F.translate(word, UPPER, LOWER)
    )


def text_key(text: Column) -> Column:
    """16 bytes that stand for a text (null counts as empty)."""
    return F.unhex(F.md5(F.coalesce(text, F.lit(""))))


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """Smallest reachable id per node of an undirected graph.

    ``edges`` has two columns of one orderable type. Returns ``node`` and
    ``component`` for every node that is not itself the smallest of its component
    (nodes without edges have no row). Self-loops, repeated edges, nulls and an
    empty table are allowed.

    Alternates large-star and small-star steps, each of which is an aggregate and
    a join over the edges, until the edges stay the same. A hub is an ordinary
    skewed join key; nothing is gathered per node or on the driver.
    """
    left, right = edges.columns
    current = edges.where(F.col(left) != F.col(right)).select(
        F.greatest(left, right).alias("hi"), F.least(left, right).alias("lo")
    )
    current = store(current.distinct(), name)
    mark = _mark(current)
    while mark[0]:
        following = store(_small_star(_large_star(current)), name)
        discard(current)
        current, before, mark = following, mark, _mark(following)
        if mark == before:
            break
    return current.select(F.col("hi").alias("node"), F.col("lo").alias("component"))


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("hi", "lo"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node links its larger neighbours to the smallest of its neighbours and itself."""
    both = edges.select(F.col("hi").alias("node"), F.col("lo").alias("other")).union(
        edges.select(F.col("lo").alias("node"), F.col("hi").alias("other"))
    )
    least = both.groupBy("node").agg(F.min("other").alias("least"))
    linked = both.join(least, "node").where("other > node")
    return linked.select(F.col("other").alias("hi"), F.least("node", "least").alias("lo")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node links itself and its smaller neighbours to the smallest of them."""
    least = edges.groupBy("hi").agg(F.min("lo").alias("least"))
    moved = edges.join(least, "hi").where("lo != least").select(F.col("lo").alias("hi"), F.col("least").alias("lo"))
    return moved.union(least.select("hi", F.col("least").alias("lo"))).distinct()


def per_batch(work: Callable, *args) -> Callable:
    """An iterator function for ``mapInArrow`` from a function of one batch."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                yield work(batch, *args)

    return run
