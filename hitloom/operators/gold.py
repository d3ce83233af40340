"""Silver hits to gold events: one row per event, labelled and numbered."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hitloom.config import MEASUREMENT_CODES, Settings
from hitloom.functions import events as E
from hitloom.operators.lookups import code_counts, find_name, fits_in_memory, join_label, name_table, occurring_names
from hitloom.operators.ordering import number_rows, number_within

# Labelled column -> (lookup, code column, label for a miss).
LABELS = {
    "browser_name": ("browser", "browser", "Browser"),
    "operating_system_name": ("operating_systems", "os", "OS"),
    "connection_type_name": ("connection_type", "connection_type", "Connection"),
    "country_name": ("country", "geo_country", "Country"),
    "referrer_type_name": ("referrer_type", "ref_type", "Referrer Type"),
}

# Gold column -> silver column it renames.
RENAMED = {
    "page_name": "pagename",
    "visitor_id": "distinct_id",
    "color_depth": "c_color",
    "javascript_version": "javascript",
    "referrer_url": "post_referrer",
    "original_timestamp": "ts_utc",
}

# Gold columns that no source fills yet.
EMPTY_COLUMNS = ("primary_category_prop", "visitor_id_prop", "form_page_url_prop", "location_prop", "tag_name")

# Columns set per event; all others belong to the hit.
EVENT_COLUMNS = (
    "insert_id", "ts_utc", "event_name", "original_event_code", "original_event_name", "is_page_view",
    "is_link_tracking", "page_title", "event_value", "event_sequence", "hit_type",
)

# The columns of gold, in order.
GOLD_COLUMNS = (
    "insert_id", "ts_utc", "distinct_id", "event_name", "original_event_code", "original_event_name",
    "is_page_view", "is_link_tracking", "page_url", "page_name", "page_title",
    "page_load_time", "time_on_page", "scroll_depth", "form_starts", "form_completions", "video_plays",
    "downloads", "external_links", "custom_link_clicks",
    "measurement_209_page_load_time", "measurement_236_page_scroll_75", "measurement_240", "event_value",
    "visitor_id", "visit_num", "visitor_type", "yearly_visitor", "monthly_visitor", "daily_visitor",
    "hourly_visitor", "browser", "browser_name", "os", "operating_system_name", "user_agent", "color_depth",
    "javascript_version", "java_enabled", "connection_type", "connection_type_name", "geo_country",
    "country_name", "geo_region", "geo_city", "referrer_url", "ref_domain", "ref_type", "referrer_type_name",
    "va_closer_detail", "va_finder_detail",
    "evar_page_name", "evar_current_url", "evar_time_since_last_use", "evar_primary_category",
    "evar_visitor_id", "evar_form_page_url", "evar_visit_duration", "evar_conductor_export_variable",
    "evar_location", "prop_page_name", "prop_current_url", "prop_previous_page", "prop_new_vs_repeat_visitors",
    "primary_category_prop", "visitor_id_prop", "form_page_url_prop", "location_prop", "tag_name",
    "visit_page_num", "event_sequence", "original_timestamp", "hit_type", "original_hit_no",
)

PAGE_VIEW = "Page Viewed"
FALLBACK = "Action Tracked"
NUDGE_SECONDS = 5

_EVENT_TYPE = (
    "array<struct<hit_type:string,event_name:string,event_code:bigint,event_value:double,event_sequence:int>>"
)


def extract_measurements(
    df: DataFrame,
    patterns: Mapping[str, Sequence[str]] = E.MEASUREMENT_PATTERNS,
    codes: Mapping[str, int] = E.MEASUREMENT_CODE_COLUMNS,
) -> DataFrame:
    return df.select("*", E.measurements(F.col("events_enhanced"), patterns, codes).alias("measurements"))


def business_events(
    df: DataFrame, measurement_codes: Sequence[int] = MEASUREMENT_CODES, ignore_codes: Sequence[int] = ()
) -> DataFrame:
    chosen = E.business_events(F.col("events_enhanced"), measurement_codes, ignore_codes)
    return df.select("*", chosen.alias("business_events"))


def primary_event(df: DataFrame) -> DataFrame:
    first = F.get("business_events", 0)["event_name"]
    name = F.when(F.col("is_page_view"), PAGE_VIEW).when(F.size("business_events") > 0, first).otherwise(FALLBACK)
    return df.select("*", name.alias("primary_event"))


def hit_ids(df: DataFrame, **limits: float) -> DataFrame:
    """``hit_id``: visitor, second, and a number among hits at the same time."""
    tied = [name for name in ("hitid_high", "hitid_low") if name in df.columns]
    numbered = number_within(df, ["distinct_id", "ts_utc"], tied, "_n", **limits)
    second = F.unix_seconds("ts_utc").cast("string")
    return numbered.withColumn(
        "hit_id", F.concat("distinct_id", F.lit("-"), second, F.lit("-"), F.col("_n").cast("string"))
    ).drop("_n")


def hit_numbers(df: DataFrame, out: str = "original_hit_no", **limits: float) -> DataFrame:
    """Number all hits by time, then visitor, then hit id.

    Ten- and thirteen-digit clocks span at most 115,741 days, so the table of
    day sizes stays small.
    """
    tied = [name for name in ("hitid_high", "hitid_low") if name in df.columns]
    day = F.coalesce(F.to_date("ts_utc"), F.lit("0001-01-01").cast("date"))
    return number_rows(df, day, ["ts_utc", "distinct_id", *tied], out, **limits)


def lookup_labels(df: DataFrame, lookups: Mapping[str, DataFrame]) -> DataFrame:
    for out, (table, key, prefix) in LABELS.items():
        df = join_label(df, lookups[table], key, prefix, out)
    return df


def _hit_columns(silver: DataFrame) -> list[Column]:
    """The hit-level columns of gold that silver holds, under their gold names."""
    have = set(silver.columns)
    columns = []
    for name in GOLD_COLUMNS:
        source = RENAMED.get(name, name)
        if name in EVENT_COLUMNS or name in LABELS or name == "original_hit_no" or name == "visitor_type":
            continue
        if name in E.MEASUREMENT_PATTERNS or name in E.MEASUREMENT_CODE_COLUMNS:
            columns.append(F.col(f"measurements.{name}"))
        elif name in EMPTY_COLUMNS or source not in have:
            columns.append(F.expr(f"CAST(NULL AS STRING) AS {name}"))
        else:
            columns.append(F.expr(f"{source} AS {name}"))
    return columns


def _events_of_hit(branches: Sequence[str]) -> Column:
    """All events of a hit in one array: page view, business events, fallback."""
    none = F.array().cast(_EVENT_TYPE)
    no_code, no_value = F.lit(None).cast("bigint"), F.lit(None).cast("double")

    def event(hit_type: Column | str, name: Column | str, code: Column, value: Column, sequence: Column) -> Column:
        as_col = lambda v: F.lit(v) if isinstance(v, str) else v
        return F.struct(
            as_col(hit_type).alias("hit_type"),
            as_col(name).alias("event_name"),
            code.alias("event_code"),
            value.alias("event_value"),
            sequence.cast("int").alias("event_sequence"),
        )

    named = F.greatest(*[F.col(f"measurements.{m}").isNotNull() for m in E.MEASUREMENT_PATTERNS])
    parts = {
        "page_view": F.when(
            F.col("is_page_view"), F.array(event("page_view", PAGE_VIEW, no_code, no_value, F.lit(0)))
        ).otherwise(none),
        "business": F.transform(
            "business_events",
            lambda e, i: event(
                F.when(F.col("is_page_view"), "event_on_page").otherwise("link_tracking"),
                e["event_name"], e["event_code"], e["event_value"], i + 1,
            ),
        ),
        "fallback": F.when(
            ~F.col("is_page_view") & (F.size("business_events") == 0) & named,
            F.array(event("measurement_only", FALLBACK, no_code, no_value, F.lit(999))),
        ).otherwise(none),
    }
    return F.concat(*[parts[branch] for branch in branches])


def event_names(event_map: DataFrame, base_events: DataFrame) -> DataFrame:
    """Rows (code, mapped, original) of both tables, not yet one per code."""
    mapped = event_map.select(F.col("code").cast("bigint").alias("code"), F.col("name").alias("mapped"))
    original = base_events.select(F.col("id").cast("bigint").alias("code"), F.col("name").alias("original"))
    return mapped.unionByName(original, allowMissingColumns=True).filter(F.col("code").isNotNull())


def hot_salts(counts: DataFrame, parts: int) -> Column:
    """Scalar map from hot codes (more than one part in ``parts`` of all) to their shares, rounded up.

    ``counts`` has the rows of each code. At most ``parts`` codes are hot, and their
    shares add up to at most twice that.
    """
    all_rows = counts.agg(F.sum("rows").alias("total"))
    share = F.ceil(F.col("rows") * parts / F.col("total")).cast("int")
    hot = counts.crossJoin(F.broadcast(all_rows)).filter(F.col("rows") * parts > F.col("total"))
    return hot.agg(F.map_from_entries(F.collect_list(F.struct("code", share.alias("salts")))).alias("salts")).scalar()


def _join_salted(df: DataFrame, names: DataFrame, counts: DataFrame, code: Column) -> DataFrame:
    """Names joined on (code, salt): a hot code's events meet as many copies of its names as it has salts.

    Rows without a code get distinct negative keys, or all page views would meet in one task.
    ``names`` has one row per code; if its file is small the join is a broadcast and no event moves.
    """
    # Several salts for each task, so that tasks get about as many.
    parts = min(1000, 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    salts = hot_salts(counts, parts)
    some = F.xxhash64("distinct_id", "ts_utc", code, "event.event_sequence")
    many = lambda key: F.coalesce(F.try_element_at(salts, key), F.lit(1))
    keyed = df.withColumn("_key", F.coalesce(code, -1 - F.pmod(some, F.lit(100_000)))).withColumn(
        "_salt", F.pmod(some, many(code).cast("bigint")).cast("int")
    )
    spread = names.withColumn("_salt", F.explode(F.sequence(F.lit(0), many(F.col("code")) - 1)))
    return keyed.join(spread.withColumnRenamed("code", "_key"), ["_key", "_salt"], "left").drop("_key", "_salt")


def join_event_names(
    df: DataFrame,
    event_map: DataFrame,
    base_events: DataFrame,
    codes: DataFrame | None = None,
    lookup: str = "join",
) -> DataFrame:
    """``mapped`` and ``original`` name of each exploded event.

    Both are looked up where the event is; no event moves. With ``codes``, the codes of
    all events (one row each, or their `code_counts`), tables of any size are reduced to
    these codes and joined with salted hot codes; with ``lookup="auto"`` only if the reduced
    tables are beyond the limit of a table in memory.
    """
    names, code = event_names(event_map, base_events), F.col("event.event_code")
    if codes is not None:
        counts = codes if "rows" in codes.columns else code_counts(codes)
        names = occurring_names(names, counts)
        if lookup == "join" or not fits_in_memory(names):
            return _join_salted(df, names, counts, code)
    return df.withColumn("_found", find_name(name_table(names), code)).select(*df.columns, "_found.mapped", "_found.original")


def to_gold(
    silver: DataFrame,
    event_map: DataFrame,
    base_events: DataFrame,
    lookups: Mapping[str, DataFrame],
    settings: Settings = Settings(),
    branches: Sequence[str] = ("page_view", "business", "fallback"),
    **limits: float,
) -> DataFrame:
    """Number and label each hit once, explode its events, name the events."""
    timed = silver.filter(F.col("ts_utc").isNotNull())
    hits = business_events(
        extract_measurements(timed), settings.measurement_codes, settings.ignore_codes
    ).select(
        "ts_utc",
        "is_page_view",
        "hitid_high",
        "hitid_low",
        *_hit_columns(silver),
        E.visitor_type(F.col("visit_num")).alias("visitor_type"),
        _events_of_hit(branches).alias("events"),
    )
    labelled = lookup_labels(hit_numbers(hits, **limits), lookups)
    exploded = labelled.withColumn("event", F.explode("events")).drop("events")
    if settings.event_lookup == "inline":
        named = join_event_names(exploded, event_map, base_events)
    else:
        codes = vars(silver).get("event_codes")
        if codes is None:
            codes = timed.select(F.explode("events_enhanced.event_code").alias("code"))
        named = join_event_names(exploded, event_map, base_events, codes, settings.event_lookup)

    kind = F.col("event.hit_type")
    business = kind.isin("event_on_page", "link_tracking")
    nudge = F.when(business, F.col("event.event_sequence") * NUDGE_SECONDS).otherwise(0)
    at = F.timestamp_add("SECOND", nudge, "ts_utc")
    title = F.coalesce("page_name", "page_url", F.when(kind == "measurement_only", "Unknown"))
    name = F.coalesce(F.when(business, F.col("mapped")), F.col("event.event_name"))
    per_event = {
        "insert_id": E.insert_id(F.col("distinct_id"), name, at),
        "ts_utc": at,
        "event_name": name,
        "original_event_code": F.col("event.event_code"),
        "original_event_name": F.when(business, F.coalesce("original", "event.event_name")),
        "is_page_view": kind == "page_view",
        "is_link_tracking": kind.isin("link_tracking", "measurement_only"),
        "page_title": title,
        "event_value": F.col("event.event_value"),
        "event_sequence": F.col("event.event_sequence"),
        "hit_type": kind,
    }
    # One select: every expression reads the columns of the hit, not new ones.
    return named.select(*[per_event[c].alias(c) if c in per_event else F.col(c) for c in GOLD_COLUMNS])


#: Bits of the filter that tells which rows may share an id; a bound, not a share of the rows.
FILTER_BITS = 1 << 24


def _id_filter(ids: DataFrame, bits: int) -> Callable[[Column], Column]:
    """A test that is true for all of these ids and, with few of them, for few others.

    The bits are words of 64 in one array, made by a scalar subquery when the plan runs.
    """
    place = lambda column: F.pmod(F.xxhash64(column), F.lit(bits))
    at = place(F.col("insert_id"))
    words = ids.select(F.shiftright(at, 6).cast("int").alias("_word"), (at % 64).cast("int").alias("_bit")).groupBy("_word").agg(
        F.bit_or(F.expr("shiftleft(1L, _bit)")).alias("_bits")
    )
    some = ids.sparkSession.range(bits // 64).select(F.col("id").cast("int").alias("_word")).join(words, "_word", "left")
    listed = F.array_sort(F.collect_list(F.struct("_word", F.coalesce("_bits", F.lit(0).cast("bigint")).alias("_bits"))))
    table = some.agg(F.transform(listed, lambda w: w["_bits"]).alias("bits")).scalar()

    def may_be(column: Column) -> Column:
        here = place(column)
        return F.getbit(F.get(table, F.shiftright(here, 6).cast("int")), (here % 64).cast("int")) == 1

    return may_be


def dedupe_events(gold: DataFrame, bits: int = FILTER_BITS) -> DataFrame:
    """One row per insert id, the one of the first hit and event; equal-time events of one visitor share theirs.

    Events without an id are not taken for one another: all of them stay. Ids are
    counted alone, combined before the shuffle. A filter of fixed size over those that
    occur twice or more then lets all other rows pass where they are; only rows that may
    share their id are moved and compared. The more ids repeat, the more rows move; the
    result is the same.
    """
    keep = F.struct("original_hit_no", "event_sequence")
    rest = [name for name in gold.columns if name != "insert_id"]
    counted = gold.filter(F.col("insert_id").isNotNull()).groupBy("insert_id").agg(F.count(F.lit(1)).alias("_rows"))
    shared = F.coalesce(_id_filter(counted.filter("_rows > 1"), bits)(F.col("insert_id")), F.lit(False)) & F.col("insert_id").isNotNull()
    first = gold.filter(shared).groupBy("insert_id").agg(F.min_by(F.struct(*rest), keep).alias("_row"))
    return first.select("insert_id", "_row.*").select(*gold.columns).union(gold.filter(~shared))
