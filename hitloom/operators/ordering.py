"""Row numbers and previous values that survive a hot key.

A plain window puts every row of one key into one task, and a window without a
key puts all rows into one. Each function here first counts rows per key, in one
narrow pass that combines before the shuffle. If no key holds more than ``share``
of all rows, a plain window per key is right and is used.

Otherwise those keys become trees. A node's rows are dealt to its children by
arithmetic pieces of the sort key that never decrease along it: the day of a time,
its hour, minute, second and fraction; the first 4, 8, ... characters of a string;
the upper bits of a number. Only nodes that still hold more than the share are cut
further. Rows are windowed per leaf, and sums over the leaves of a key (or their last
values) carry the result from one leaf to the next.

Fewer than ``1 / share`` nodes of a level can be that large, which bounds the tables
of cut nodes; these tell a row its leaf. Leaves, which can be many, are only ever
aggregated and joined on the column that the window is already partitioned by.

Rows that agree in every sort column have no order among them. Where numbers are
given, such rows are cut by a hash of the whole row, since any order of them is
right; only rows equal in every column stay together. For previous values they are
ordered, and cut, by the value itself.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hitloom.session import checkpoint_folder

SHARE = 0.0001
MIN_ROWS = 1_000_000
#: Microseconds of a day, an hour, a minute, a second.
TIME_STEPS = (86_400_000_000, 3_600_000_000, 60_000_000, 1_000_000)
#: Bits left out of a whole number.
BIT_STEPS = (40, 30, 20, 10)
#: First characters of a string.
CHAR_STEPS = (4, 8, 12, 16, 20)
TIE_BITS = 16


def _stored(df: DataFrame) -> DataFrame:
    checkpoint_folder(df.sparkSession)
    return df.checkpoint()


def _few(heavy: DataFrame) -> DataFrame | None:
    """Heavy nodes (fewer than ``1 / share``) as a local table; None if there are none."""
    rows = heavy.collect()
    return heavy.sparkSession.createDataFrame(rows, heavy.schema) if rows else None


def _match(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Broadcast join in which NULL keys meet; ``right`` is a bounded table."""
    renamed = right.select(*[F.col(k).alias(f"_r_{k}") if k in keys else F.col(k) for k in right.columns])
    condition = [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys]
    return left.join(F.broadcast(renamed), condition, how).drop(*[f"_r_{k}" for k in keys])


def _with_total(sizes: DataFrame) -> DataFrame:
    if "_total" in sizes.columns:
        return sizes
    return sizes.crossJoin(F.broadcast(sizes.agg(F.sum("_rows").alias("_total"))))


def heavy_keys(sizes: DataFrame, share: float = SHARE, min_rows: int = MIN_ROWS) -> DataFrame:
    """Keys of ``sizes`` (with ``_rows``) above the share: fewer than ``1 / share``.

    ``_limit`` is the number of rows that a node may hold without being cut.
    """
    limit = F.greatest((F.col("_total") * share).cast("bigint"), F.lit(min_rows - 1))
    counted = _with_total(sizes).withColumn("_limit", limit)
    return counted.filter("_rows > _limit").drop("_rows", "_total")


def _sizes(narrow: DataFrame, keys: Sequence[str]) -> DataFrame:
    return narrow.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))


def pieces(schema: T.StructType, order: Sequence[str]) -> list[Column]:
    """Columns, coarse to fine, none of which decreases along the order among rows alike in those before."""
    found = []
    for name in order:
        column, kind = F.col(f"`{name}`"), schema[name].dataType
        if isinstance(kind, T.TimestampType):
            micros = F.unix_micros(column)
            found += [micros - F.pmod(micros, F.lit(step)) for step in TIME_STEPS]
        elif isinstance(kind, T.StringType):
            found += [F.substring(column, 1, chars) for chars in CHAR_STEPS]
        elif isinstance(kind, (T.LongType, T.IntegerType)):
            found += [F.shiftright(column, bits) for bits in BIT_STEPS if bits < 32 or isinstance(kind, T.LongType)]
        found.append(column)
    return found


def _tie(df: DataFrame) -> Column:
    """A piece for rows that agree in all others: any order of them is right."""
    hashed = [F.col(f"`{f.name}`") for f in df.schema.fields if not isinstance(f.dataType, T.MapType)]
    return F.shiftright(F.xxhash64(*hashed), 64 - TIE_BITS)


def _cut(rows: DataFrame, heavy: DataFrame, keys: Sequence[str], parts: Sequence[Column]) -> list[DataFrame]:
    """Per level the nodes to be cut: first the heavy keys, then those of their children still heavy.

    ``rows`` holds the rows of the heavy keys.
    """
    limit = heavy.first()["_limit"]
    levels, place = [heavy.select(*keys)], list(keys)
    for level in range(len(parts) - 1):
        place = [*place, f"_p{level}"]
        inside = _with_places(rows, levels, keys, parts).filter(F.col(f"_h{level}"))
        found = _few(_sizes(inside, place).filter(F.col("_rows") > limit).drop("_rows"))
        if found is None:
            break
        levels.append(found)
    return levels


def _with_places(df: DataFrame, levels: Sequence[DataFrame], keys: Sequence[str], parts: Sequence[Column]) -> DataFrame:
    """``_p0``, ``_p1``, ...: a row's place on each level, NULL below a node that is not cut.

    ``_h0``, ``_h1``, ... tell whether the node above is cut.
    """
    place = list(keys)
    for level, nodes in enumerate(levels):
        marked = nodes.select(*place, F.lit(True).alias(f"_m{level}"))
        df = _match(df, marked, place, "left")
        cut = F.col(f"_m{level}").isNotNull()
        df = df.withColumns({f"_h{level}": cut, f"_p{level}": F.when(cut, parts[level])}).drop(f"_m{level}")
        place = [*place, f"_p{level}"]
    return df


def _with_leaf(df: DataFrame, levels: Sequence[DataFrame], keys: Sequence[str], parts: Sequence[Column]) -> DataFrame:
    """``_leaf``: key and place of a row in one value, in which NULLs are alike."""
    placed = _with_places(df, levels, keys, parts)
    steps = range(len(levels))
    names = [F.col(k).alias(f"k{n}") for n, k in enumerate(keys)] + [F.col(f"_p{n}").alias(f"p{n}") for n in steps]
    drop = [f"_{kind}{n}" for kind in "hp" for n in steps]
    return placed.withColumn("_leaf", F.struct(*names)).drop(*drop)


def _over_leaves(keys: Sequence[str], levels: Sequence[DataFrame]) -> Window:
    """The leaves of one key in order."""
    return Window.partitionBy(*[F.col(f"_leaf.k{n}") for n in range(len(keys))]).orderBy(
        *[F.col(f"_leaf.p{n}") for n in range(len(levels))]
    )


def previous_value(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, out: str, **limits: float
) -> DataFrame:
    """``out`` = ``value`` of the row before, per key in the given order, then by value."""
    order = list(dict.fromkeys([*order, value]))
    narrow = df.select(*dict.fromkeys([*keys, *order]))
    heavy = _few(heavy_keys(_sizes(narrow, keys), **limits))
    if heavy is None:
        return df.withColumn(out, F.lag(value).over(Window.partitionBy(*keys).orderBy(*order)))

    parts = pieces(df.schema, order)
    rows = _stored(_match(narrow, heavy.select(*keys), keys, "left_semi"))
    levels = _cut(rows, heavy, keys, parts)
    last = _with_leaf(rows, levels, keys, parts).groupBy("_leaf").agg(F.max_by(value, F.struct(*order)).alias("_last"))
    carried = F.lag("_last").over(_over_leaves(keys, levels))
    border = _stored(last.select("_leaf", carried.alias("_carried")))

    within = Window.partitionBy("_leaf").orderBy(*order)
    numbered = _with_leaf(df, levels, keys, parts).withColumns(
        {"_nth": F.row_number().over(within), out: F.lag(value).over(within)}
    )
    # The join has the key of the window: rows are not shuffled again for it.
    return (
        numbered.join(border, "_leaf", "left")
        .withColumn(out, F.when(F.col("_nth") == 1, F.col("_carried")).otherwise(F.col(out)))
        .drop("_nth", "_leaf", "_carried")
    )


def number_within(df: DataFrame, keys: Sequence[str], order: Sequence[str], out: str, **limits: float) -> DataFrame:
    """``out`` = 1, 2, ... per key in the given order.

    A large key needs a large first part of the key, which is cheaper to count.
    """
    narrow = df.select(*dict.fromkeys([*keys, *order]))
    heavy = _few(heavy_keys(_sizes(narrow, keys[:1]), **limits))
    if heavy is not None and len(keys) > 1:
        within_large = _match(narrow, heavy.drop("_limit"), keys[:1], "left_semi")
        limit = heavy.first()["_limit"]
        heavy = _few(_sizes(within_large, keys).filter(F.col("_rows") > limit).select(*keys, F.lit(limit).alias("_limit")))
    if heavy is None:
        return df.withColumn(out, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))

    parts = [*pieces(df.schema, order), _tie(df)]
    rows = _stored(_match(df, heavy.select(*keys), keys, "left_semi").select(*keys, *_named(parts)))
    levels = _cut(rows, heavy, keys, _renamed(parts))
    counts = _sizes(_with_leaf(rows, levels, keys, _renamed(parts)), ["_leaf"])
    before = F.sum("_rows").over(_over_leaves(keys, levels).rowsBetween(Window.unboundedPreceding, -1))
    offsets = _stored(counts.select("_leaf", before.alias("_before")))
    return _numbered(df, offsets, levels, keys, parts, order, out)


def number_rows(df: DataFrame, bucket: Column, order: Sequence[str], out: str, **limits: float) -> DataFrame:
    """``out`` = 1, 2, ... over all rows, without a window over all rows.

    ``bucket`` must not decrease along ``order`` and not be NULL. Rows are numbered
    per bucket (per leaf of a large bucket) and shifted by the rows of earlier ones.
    Only the table of bucket sizes is summed up in one place, so the caller picks a
    bucket with few values, such as a day.
    """
    tagged = df.withColumn("_bucket", bucket)
    keys = ["_bucket"]
    parts = [*pieces(df.schema, order), _tie(df)]
    sizes = _stored(_with_total(_sizes(tagged.select("_bucket"), keys)))
    heavy = _few(heavy_keys(sizes, **limits))
    so_far = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    earlier = sizes.select("_bucket", F.coalesce(F.sum("_rows").over(so_far), F.lit(0)).alias("_before"))
    if heavy is None:
        return (
            tagged.withColumn("_nth", F.row_number().over(Window.partitionBy("_bucket").orderBy(*order)))
            .join(earlier, "_bucket")
            .withColumn(out, F.col("_nth") + F.col("_before"))
            .drop("_nth", "_before", "_bucket")
        )
    rows = _stored(_match(tagged, heavy.select("_bucket"), keys, "left_semi").select("_bucket", *_named(parts)))
    levels = _cut(rows, heavy, keys, _renamed(parts))
    cut = _sizes(_with_leaf(rows, levels, keys, _renamed(parts)), ["_leaf"])
    # A bucket that is not cut is its own leaf.
    uncut = [F.lit(None).cast(rows.schema[f"_s{n}"].dataType).alias(f"p{n}") for n in range(len(levels))]
    leaf = F.struct(F.col("_bucket").alias("k0"), *uncut).alias("_leaf")
    whole = _match(sizes, heavy.select("_bucket"), keys, "left_anti").select(leaf, "_rows")
    before = F.sum("_rows").over(_over_leaves(keys, levels).rowsBetween(Window.unboundedPreceding, -1))
    inside = cut.unionByName(whole).select("_leaf", F.coalesce(before, F.lit(0)).alias("_inside"))
    offsets = inside.join(earlier, F.col("_leaf.k0") == F.col("_bucket")).select(
        "_leaf", (F.col("_inside") + F.col("_before")).alias("_before")
    )
    return _numbered(tagged, _stored(offsets), levels, keys, parts, order, out).drop("_bucket")


def _named(parts: Sequence[Column]) -> list[Column]:
    return [part.alias(f"_s{n}") for n, part in enumerate(parts)]


def _renamed(parts: Sequence[Column]) -> list[Column]:
    return [F.col(f"_s{n}") for n in range(len(parts))]


def _numbered(
    df: DataFrame,
    offsets: DataFrame,
    levels: Sequence[DataFrame],
    keys: Sequence[str],
    parts: Sequence[Column],
    order: Sequence[str],
    out: str,
) -> DataFrame:
    within = Window.partitionBy("_leaf").orderBy(*order)
    return (
        _with_leaf(df, levels, keys, parts)
        .withColumn("_nth", F.row_number().over(within))
        .join(offsets, "_leaf", "left")
        .withColumn(out, F.col("_nth") + F.coalesce("_before", F.lit(0)))
        .drop("_nth", "_before", "_leaf")
    )
