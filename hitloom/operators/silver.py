"""Bronze to silver: named events, page views, business column names."""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hitloom.config import Settings
from hitloom.functions import events as E
from hitloom.functions.text import alias_name, unique_names
from hitloom.operators.lookups import code_counts, find_name, fits_in_memory, name_table, occurring_names
from hitloom.operators.ordering import previous_value
from hitloom.session import checkpoint_folder

# Hits of one visitor follow each other in this order.
HIT_ORDER = ("ts_utc", "hitid_high", "hitid_low")


def _enhance_by_join(df: DataFrame, names: DataFrame, out: str) -> DataFrame:
    """The way for maps of any size: explode, join the names, gather again.

    Rows get a number that must not change between uses, so they are stored once, as a
    table bucketed by it, written without a shuffle: events are gathered where their hit
    lies, and hits don't move. If the names are few enough to be broadcast, no event moves
    either. Gathering is per hit, hence never larger than one event list.
    """
    spark, table = df.sparkSession, f"numbered_hits_{uuid.uuid4().hex}"
    writer = df.withColumn("_hit", F.monotonically_increasing_id()).write.format("parquet")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    writer.bucketBy(buckets, "_hit").option("path", f"{checkpoint_folder(spark).rstrip('/')}/{table}").saveAsTable(table)
    numbered = spark.table(table)
    events = numbered.select("_hit", F.posexplode(E.enhanced_events(F.col("events_array"))).alias("_pos", "e"))
    named = events.join(names.withColumnRenamed("code", "_code"), F.col("e.event_code") == F.col("_code"), "left")
    full = F.struct(
        "_pos", "e.event_code", "e.event_value",
        F.coalesce("name", "e.event_name").alias("event_name"), "e.event_type", "e.is_measurement",
    )
    gathered = named.groupBy("_hit").agg(F.array_sort(F.collect_list(full)).alias("_all"))
    fields = ("event_code", "event_value", "event_name", "event_type", "is_measurement")
    array = F.transform("_all", lambda e: F.struct(*[e[name].alias(name) for name in fields]))
    empty = E.enhanced_events(F.filter("events_array", lambda e: F.lit(False)))
    return numbered.join(gathered, "_hit", "left").select(*df.columns, F.coalesce(array, empty).alias(out))


def enhance_events(
    df: DataFrame,
    name_source: str = "literal",
    event_map: DataFrame | None = None,
    out: str = "events_enhanced",
    lookup: str = "inline",
) -> DataFrame:
    """Events with name, type and measurement flag, as an array per hit.

    Names come from the event map through `name_table`, so nothing runs while this is
    planned, hits are not moved, and hits may be a stream. With ``lookup="auto"`` the map is
    first reduced to the codes that occur, in one narrow pass over the hits, so that a map of
    any size will do; if even these are beyond the limit of a table, names are joined. With
    ``lookup="join"`` they always are: events are joined and gathered, and hits are stored on
    the way. These two give the frame its `code_counts` as ``event_codes``.
    """
    if name_source == "literal":
        return df.select("*", E.enhanced_events(F.col("events_array")).alias(out))
    if name_source != "event_map" or event_map is None:
        raise ValueError("name_source is 'literal', or 'event_map' with an event map")
    if lookup not in ("auto", "inline", "join"):
        raise ValueError("lookup is 'auto', 'inline' or 'join'")
    names = event_map.select(F.col("code").cast("bigint").alias("code"), "name").filter("code IS NOT NULL AND name IS NOT NULL")
    counts = None
    if lookup != "inline":
        # Of an inner explode Spark makes a filter that parses every list a second time.
        counts = code_counts(df.select(F.explode_outer("events_array.event_code").alias("code")))
        names = occurring_names(names, counts)
    if lookup == "join" or (lookup == "auto" and not fits_in_memory(names)):
        enhanced = _enhance_by_join(df, names, out)
    else:
        name_of = lambda code: F.coalesce(find_name(F.col("_names"), code)["name"], E.literal_event_name(code))
        tabled = df.select("*", name_table(names).alias("_names"))
        columns = [F.col(f"`{c}`") for c in df.columns]
        enhanced = tabled.select(*columns, E.enhanced_events(F.col("events_array"), name_of).alias(out))
    enhanced.event_codes = counts
    return enhanced


def evar_instances(df: DataFrame, number_offset: int = 9999) -> DataFrame:
    return df.select("*", E.evar_instances(F.col("events_array"), number_offset).alias("evar_instances"))


def classify_hits(df: DataFrame) -> DataFrame:
    """Whether a hit has any event with a code."""
    has_events = F.when(F.size("events_enhanced") > 0, "has_events").otherwise("no_events")
    return df.select("*", has_events.alias("event_classification"))


def detect_page_view(
    df: DataFrame,
    use_post_page_event: bool = True,
    use_url_change: bool = True,
    use_evar_instances: bool = False,
    **limits: float,
) -> DataFrame:
    """Adds ``prev_url`` and ``is_page_view``; hits keep their place in time."""
    tied = [name for name in HIT_ORDER if name in df.columns]
    ordered = previous_value(df, ["distinct_id"], tied, "page_url", "prev_url", **limits)
    rules = []
    if use_post_page_event:
        rules.append((F.col("post_page_event") == "0") | (F.col("post_page_event").try_cast("bigint") == 0))
    if use_url_change:
        rules.append(F.col("prev_url") != F.col("page_url"))
    if use_evar_instances:
        rules.append(F.size("evar_instances") > 0)
    seen = F.lit(False)
    for rule in rules:
        seen = seen | F.coalesce(rule, F.lit(False))
    return ordered.withColumn("is_page_view", seen)


def _named_evars(sdr: DataFrame) -> DataFrame:
    return sdr.filter("code BETWEEN 100 AND 199 AND name_override != ''").selectExpr(
        "'post_evar' AS source", "'evar_' AS prefix", "CAST(code - 99 AS STRING) AS number", "name_override AS name"
    )


def _named_props(sdr: DataFrame) -> DataFrame:
    return sdr.filter("PropertyNumber IS NOT NULL AND Name != ''").selectExpr(
        "'prop' AS source", "'prop_' AS prefix", "PropertyNumber AS number", "Name AS name"
    )


def sdr_alias_pairs(named: DataFrame, taken: Iterable[str] = ()) -> list[tuple[str, str]]:
    """(source column, alias) per naming row, in code order.

    An alias that repeats, or meets a ``taken`` column name, gets a suffix.

    The naming tables describe columns, so they are as short as a table is wide
    (at most 100 eVars here); they are read to the driver like a schema.
    """
    found = sorted(
        map(tuple, named.distinct().collect()), key=lambda row: (row[0], len(row[2]), row[2], row[3])
    )
    aliases = unique_names((alias_name(name, prefix) for _, prefix, _, name in found), taken)
    return [(source + number, alias) for (source, _, number, _), alias in zip(found, aliases)]


def alias_columns(df: DataFrame, pairs: list[tuple[str, str]]) -> list[Column]:
    """Aliased copies; a source column the feed lacks gives a NULL string."""
    have = set(df.columns)
    return [
        F.expr(f"`{source}` AS `{alias}`" if source in have else f"CAST(NULL AS STRING) AS `{alias}`")
        for source, alias in pairs
    ]


def alias_evars(df: DataFrame, sdr_evars: DataFrame) -> DataFrame:
    return df.select("*", *alias_columns(df, sdr_alias_pairs(_named_evars(sdr_evars), df.columns)))


def alias_props(df: DataFrame, sdr_props: DataFrame) -> DataFrame:
    return df.select("*", *alias_columns(df, sdr_alias_pairs(_named_props(sdr_props), df.columns)))


def to_silver(
    bronze: DataFrame,
    sdr_evars: DataFrame,
    sdr_props: DataFrame,
    settings: Settings = Settings(),
    event_map: DataFrame | None = None,
    **limits: float,
) -> DataFrame:
    """Hits without a time take part in the URL comparison, then drop out.

    The counts of their event codes, if the names needed them, stay as ``event_codes``.
    """
    enhanced = enhance_events(bronze, settings.name_source, event_map, lookup=settings.event_lookup)
    named = evar_instances(enhanced, settings.evar_number_offset)
    viewed = detect_page_view(
        named, settings.use_post_page_event, settings.use_url_change, settings.use_evar_instances, **limits
    ).filter(F.col("ts_utc").isNotNull())
    pairs = sdr_alias_pairs(_named_evars(sdr_evars).unionByName(_named_props(sdr_props)), viewed.columns)
    silver = classify_hits(viewed.drop("events_array")).select("*", *alias_columns(viewed, pairs))
    silver.event_codes = vars(enhanced).get("event_codes")
    return silver
