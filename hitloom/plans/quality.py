"""Quality reports of each layer.

Counts of one layer come from one aggregation, and percentages and verdicts are
computed on its single row. Exact distinct counts combine before the shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hitloom.config import Settings
from hitloom.functions import hits as H


def _pct(part: Column, whole: Column) -> Column:
    return F.try_divide(part.cast("double"), whole.cast("double")) * 100


def _share(part: Column, whole: Column, digits: int) -> Column:
    return F.round(_pct(part, whole), digits)


# -- raw ---------------------------------------------------------------------


def raw_quality(raw: DataFrame, digits: int = 3) -> DataFrame:
    """Malformed clocks and hit ids: counts, shares and clean rows."""
    counts = raw.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_if(H.bad_hit_time()).alias("malformed_hit_time_gmt"),
        F.count_if(H.bad_hitid_high()).alias("malformed_hitid_high"),
        F.count_if(H.bad_hitid_low()).alias("malformed_hitid_low"),
        F.count_if(H.malformed_hit()).alias("malformed_record_count"),
    )
    total = F.col("total_records")
    clean = total - F.col("malformed_record_count")
    return counts.select(
        "*",
        _share(F.col("malformed_hit_time_gmt"), total, digits).alias("malformed_hit_time_gmt_pct"),
        _share(F.col("malformed_hitid_high"), total, digits).alias("malformed_hitid_high_pct"),
        _share(F.col("malformed_hitid_low"), total, digits).alias("malformed_hitid_low_pct"),
        _share(F.col("malformed_record_count"), total, digits).alias("malformed_record_pct"),
        clean.alias("clean_records"),
        _share(clean, total, digits).alias("clean_record_pct"),
    )


def raw_summary(raw: DataFrame) -> DataFrame:
    """The same figures in the layout of the preprocessing check, four digits."""
    return raw_quality(raw, 4).select(
        "total_records",
        "malformed_hit_time_gmt",
        "malformed_hitid_high",
        "malformed_hitid_low",
        F.col("malformed_record_count").alias("total_malformed_records"),
        "malformed_hit_time_gmt_pct",
        "malformed_hitid_high_pct",
        "malformed_hitid_low_pct",
        F.col("malformed_record_pct").alias("total_malformed_pct"),
        F.col("clean_records").alias("clean_records_for_bronze"),
    )


def malformed_verdict(quality: DataFrame) -> DataFrame:
    pct = F.col("malformed_record_pct")
    return quality.select(
        "malformed_record_pct",
        F.when(pct > 5, "high").when(pct > 1, "moderate").when(pct > 0, "low").otherwise("perfect").alias("verdict"),
    )


def _issue(col: str, bad: Column, what: str) -> Column:
    return (
        F.when(F.col(col).isNull(), f"NULL_{what}").when(bad, f"bad_{what}_format").otherwise(f"good_{what}")
    )


def bad_rows(raw: DataFrame, limit: int = 100) -> DataFrame:
    """The ``limit`` worst malformed rows with the fault of each field."""
    flags = [H.bad_hit_time(), H.bad_hitid_high(), H.bad_hitid_low()]
    faults = sum((flag.cast("int") for flag in flags[1:]), flags[0].cast("int"))
    fields = ["hit_time_gmt", "hitid_high", "hitid_low"]
    rest = ["accept_language", "pagename", "page_url"]
    return (
        raw.filter(H.malformed_hit())
        .select(
            *fields,
            F.length("hit_time_gmt").alias("hit_time_length"),
            F.length("hitid_high").alias("hitid_high_length"),
            F.length("hitid_low").alias("hitid_low_length"),
            _issue("hit_time_gmt", flags[0], "timestamp").alias("timestamp_issue"),
            _issue("hitid_high", flags[1], "hitid_high").alias("hitid_high_issue"),
            _issue("hitid_low", flags[2], "hitid_low").alias("hitid_low_issue"),
            *rest,
            faults.alias("_faults"),
        )
        .orderBy(F.desc("_faults"), *[F.asc_nulls_first(name) for name in [*fields, *rest]])
        .limit(limit)
        .drop("_faults")
    )


def field_lengths(raw: DataFrame) -> DataFrame:
    """Length distribution of the three key fields, as shares of all rows."""
    fields = ("hit_time_gmt", "hitid_high", "hitid_low")
    pairs = F.array(
        *[F.struct(F.lit(f"{f}_length_distribution").alias("analysis_type"), F.length(f).alias("field_length")) for f in fields]
    )
    counted = (
        raw.select(F.explode(pairs).alias("pair"))
        .select("pair.*")
        .groupBy("analysis_type", "field_length")
        .agg(F.count(F.lit(1)).alias("record_count"))
    )
    # Every row gives one pair per field, so any one field sums to all rows.
    total = counted.filter(F.col("analysis_type").startswith("hit_time_gmt")).agg(F.sum("record_count").alias("_total"))
    return (
        counted.filter(F.col("field_length").isNotNull())
        .crossJoin(F.broadcast(total))
        .select(
            "analysis_type",
            "field_length",
            "record_count",
            _share(F.col("record_count"), F.col("_total"), 2).alias("percentage"),
        )
        .orderBy("analysis_type", "field_length")
    )


def row_drift(counted: DataFrame, expected_rows: int, column: str = "total_rows") -> DataFrame:
    """Distance of a row count from the expected one; over 10 % is a warning."""
    expected = F.lit(expected_rows)
    pct = F.try_divide(F.abs(F.col(column) - expected).cast("double"), expected.cast("double")) * 100
    return counted.select(
        F.col(column).alias("total_rows"),
        expected.cast("bigint").alias("expected_rows"),
        F.round(pct, 1).alias("difference_pct"),
        F.when(expected <= 0, "not_checked").when(pct > 10, "warn").otherwise("ok").alias("verdict"),
    )


# Two letters or more, then optional subtags; or a list of them with weights.
LANGUAGE_PATTERN = r"^(\*|[A-Za-z]{2,8}(-[A-Za-z0-9]{1,8})*)(\s*;\s*q=[0-9.]+)?(\s*,.*)?\z"


def language_drift(raw: DataFrame, pattern: str = LANGUAGE_PATTERN) -> DataFrame:
    """Filled language fields that hold no language code: a sign of shifted columns."""
    value = F.col("accept_language")
    filled = value.isNotNull() & ~value.isin("", ":", "-", "--")
    counts = raw.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(filled).alias("filled_rows"),
        F.count_if(filled & ~value.rlike(pattern)).alias("drifted_rows"),
    )
    return counts.select("*", _share(F.col("drifted_rows"), F.col("filled_rows"), 4).alias("drifted_pct"))


# -- row counts ---------------------------------------------------------------

# Table -> category of the load summary.
TABLE_CATEGORIES = {
    "lookup_events": "Events",
    "sdr_custom_events_raw": "SDR Raw",
    "sdr_evars_raw": "SDR Raw",
    "sdr_props_raw": "SDR Raw",
    "sdr_custom_events": "SDR Processed",
    "sdr_evars": "SDR Processed",
    "event_map": "SDR Processed",
}


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    parts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    return union


def load_tables(tables: Mapping[str, DataFrame], raw_name: str = "raw") -> DataFrame:
    category = F.when(F.col("table_name") == raw_name, "Raw Data").when(
        F.col("table_name").isin(*TABLE_CATEGORIES), F.lit(None)
    )
    for table, kind in TABLE_CATEGORIES.items():
        category = F.when(F.col("table_name") == table, kind).otherwise(category)
    return row_counts(tables).select(F.coalesce(category, F.lit("Lookup")).alias("category"), "table_name", "row_count")


def load_summary(tables: Mapping[str, DataFrame], raw_name: str = "raw") -> DataFrame:
    """Tables and rows per category."""
    return load_tables(tables, raw_name).groupBy("category").agg(
        F.count(F.lit(1)).alias("tables"), F.sum("row_count").alias("total_rows")
    )


# -- bronze -------------------------------------------------------------------


def bronze_metrics(bronze: DataFrame) -> DataFrame:
    return bronze.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_distinct("distinct_id").alias("unique_visitors"),
        F.count("ts_utc").alias("valid_timestamps"),
        F.count("events_array").alias("rows_with_events"),
        F.sum(F.size("events_array")).alias("total_events"),
    )


def bronze_checks(bronze: DataFrame, settings: Settings = Settings()) -> DataFrame:
    pair = F.concat("hitid_high", F.lit("-"), "hitid_low")
    counts = bronze.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(F.col("ts_utc").isNull()).alias("_no_time"),
        F.count_if(F.coalesce("distinct_id", F.lit("")) == "").alias("_no_visitor"),
        (F.count(pair) - F.count_distinct(pair)).alias("duplicate_hit_count"),
    )
    no_time, no_visitor = _pct(F.col("_no_time"), F.col("total_rows")), _pct(F.col("_no_visitor"), F.col("total_rows"))
    warn = lambda test: F.when(test, "warn").otherwise("ok")
    return counts.select(
        "total_rows",
        F.round(no_time, 6).alias("pct_null_timestamp"),
        F.round(no_visitor, 6).alias("pct_empty_visitor_id"),
        "duplicate_hit_count",
        warn(no_time > settings.null_timestamp_warn_pct * 100).alias("timestamp_verdict"),
        warn(no_visitor > settings.empty_visitor_id_warn_pct * 100).alias("visitor_verdict"),
        warn(F.col("duplicate_hit_count") > 0).alias("duplicate_verdict"),
    )


# -- silver -------------------------------------------------------------------


def silver_metrics(silver: DataFrame) -> DataFrame:
    return silver.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_distinct("distinct_id").alias("unique_visitors"),
        F.count_if("is_page_view").alias("page_views"),
        F.count_if(~F.col("is_page_view")).alias("link_tracking_hits"),
        F.sum(F.size("events_enhanced")).alias("total_events"),
        F.count_distinct(F.to_date("ts_utc")).alias("unique_days"),
    )


def event_code_counts(df: DataFrame, events: str = "events_enhanced") -> DataFrame:
    """Instances per event code: reduces the events before any join."""
    return (
        df.select(F.explode(events).alias("e"))
        .groupBy(F.col("e.event_code").alias("event_code"))
        .agg(F.count(F.lit(1)).alias("instances"))
    )


def unknown_events(silver: DataFrame, event_map: DataFrame) -> DataFrame:
    """Codes without a mapped name and how often they occur."""
    named = event_map.select(F.col("code").alias("_code"), "name").distinct()
    return (
        event_code_counts(silver)
        .join(named, F.col("event_code") == F.col("_code"), "left")
        .filter(F.col("name").isNull())
        .select("event_code", "instances")
    )


def silver_checks(silver: DataFrame, event_map: DataFrame, settings: Settings = Settings()) -> DataFrame:
    unknown = unknown_events(silver, event_map).agg(
        F.coalesce(F.sum("instances"), F.lit(0)).alias("unknown_event_count")
    )
    counts = silver.agg(
        F.sum(F.size("events_enhanced")).alias("total_event_count"),
        F.count_if("is_page_view").alias("page_views"),
        F.count_if(~F.col("is_page_view")).alias("non_page_views"),
        F.count(F.lit(1)).alias("total_hits"),
    )
    no_name = _pct(F.col("unknown_event_count"), F.col("total_event_count"))
    views = _pct(F.col("page_views"), F.col("total_hits"))
    # Both sides have exactly one row.
    return unknown.crossJoin(F.broadcast(counts)).select(
        "unknown_event_count",
        "total_event_count",
        F.round(no_name, 6).alias("pct_unknown_events"),
        "page_views",
        "non_page_views",
        "total_hits",
        F.round(views, 6).alias("pct_page_views"),
        F.when(no_name > settings.unknown_events_warn_pct * 100, "warn").otherwise("ok").alias("mapping_verdict"),
        F.when(views < 10, "low").when(views > 90, "high").otherwise("ok").alias("page_view_verdict"),
    )


# -- gold ---------------------------------------------------------------------


def _distinct_values(df: DataFrame, **columns: Column) -> DataFrame:
    """One row of distinct counts, each from a reduction of its own.

    Several distinct counts in one aggregate would multiply every row before the
    shuffle. Here each value is reduced to distinct ones in the tasks first, and the
    scan reads one column.
    """
    parts = [
        df.select(value.alias("_value")).filter("_value IS NOT NULL").distinct().agg(F.count(F.lit(1)).alias(name))
        for name, value in columns.items()
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.crossJoin(F.broadcast(part))  # one row each
    return result


def gold_metrics(gold: DataFrame) -> DataFrame:
    plain = gold.agg(
        F.count(F.lit(1)).alias("total_events"),
        F.count_if(F.col("event_name") == "Page Viewed").alias("page_view_events"),
        F.count_if("is_link_tracking").alias("link_tracking_events"),
        F.round(F.avg(F.col("visit_page_num").try_cast("double")), 2).alias("avg_pages_per_visit"),
        F.round(F.avg(F.col("event_sequence").cast("double")), 2).alias("avg_events_per_hit"),
    )
    distinct = _distinct_values(
        gold,
        unique_visitors=F.col("distinct_id"),
        unique_events=F.col("insert_id"),
        unique_event_types=F.col("event_name"),
        date_range_days=F.to_date("ts_utc"),
    )
    return plain.crossJoin(F.broadcast(distinct)).select(
        "total_events", "unique_visitors", "unique_events", "page_view_events", "link_tracking_events",
        "unique_event_types", "date_range_days", "avg_pages_per_visit", "avg_events_per_hit",
    )


def event_breakdown(gold: DataFrame) -> DataFrame:
    return gold.agg(
        F.count_if(F.col("event_name") == "Page Viewed").alias("page_views"),
        F.count_if(F.col("event_name") != "Page Viewed").alias("business_events"),
        F.count_distinct("event_name").alias("unique_event_types"),
    )


def gold_checks(silver: DataFrame, gold: DataFrame) -> DataFrame:
    hits = silver.agg(
        F.count(F.lit(1)).alias("silver_rows"), F.count_distinct("distinct_id").alias("silver_visitors")
    )
    events = gold.agg(
        F.count(F.lit(1)).alias("total_events"),
        F.count_if(F.col("event_name") == "Page Viewed").alias("page_views"),
        F.count_if(F.col("event_name") != "Page Viewed").alias("business_events"),
        F.count_distinct("event_name").alias("unique_event_types"),
        F.count_distinct("distinct_id").alias("unique_visitors"),
    )
    ratio = F.try_divide(F.col("total_events").cast("double"), F.col("silver_rows").cast("double"))
    warn = lambda test: F.when(test, "warn").otherwise("ok")
    return events.crossJoin(F.broadcast(hits)).select(
        "*",
        F.round(ratio, 2).alias("expansion_ratio"),
        F.when(ratio < 1, "loss").when(ratio > 10, "excess").otherwise("ok").alias("expansion_verdict"),
        warn(F.col("unique_visitors") != F.col("silver_visitors")).alias("visitor_verdict"),
        warn(F.col("page_views") == 0).alias("page_view_verdict"),
        warn(F.col("unique_event_types") < 2).alias("event_type_verdict"),
    )


# -- across layers --------------------------------------------------------------


def _union(parts: Sequence[DataFrame]) -> DataFrame:
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def raw_visitor() -> Column:
    return F.concat("post_visid_high", F.lit("-"), "post_visid_low")


def layer_summary(raw: DataFrame, bronze: DataFrame, silver: DataFrame, gold: DataFrame) -> DataFrame:
    """Rows, visitors, days and time span of each layer."""
    # The names of the layers.
    parts = [
        raw.agg(
            F.count(F.lit(1)).alias("total_rows"),
            F.count_distinct(raw_visitor()).alias("unique_visitors"),
            F.lit(0).cast("bigint").alias("date_range_days"),
            F.lit(None).cast("timestamp").alias("earliest_timestamp"),
            F.lit(None).cast("timestamp").alias("latest_timestamp"),
        ).select(F.lit(0).alias("layer_no"), F.lit("Raw").alias("layer"), "*")
    ]
    for number, (name, df) in enumerate((("Bronze", bronze), ("Silver", silver), ("Gold", gold)), start=1):
        stats = df.filter(F.col("ts_utc").isNotNull()).agg(
            F.count(F.lit(1)).alias("total_rows"),
            F.count_distinct("distinct_id").alias("unique_visitors"),
            F.count_distinct(F.to_date("ts_utc")).alias("date_range_days"),
            F.min("ts_utc").alias("earliest_timestamp"),
            F.max("ts_utc").alias("latest_timestamp"),
        )
        parts.append(stats.select(F.lit(number).alias("layer_no"), F.lit(name).alias("layer"), "*"))
    return _union(parts)


def layer_ratios(summary: DataFrame) -> DataFrame:
    """Rows and visitors of each layer against the layer before (four rows)."""
    order = Window.orderBy("layer_no")
    ratio = lambda col: F.try_divide(F.col(col).cast("double"), F.lag(col).over(order).cast("double"))
    rows, visitors = ratio("total_rows"), ratio("unique_visitors")
    return summary.select("layer_no", "layer", rows.alias("_rows"), visitors.alias("_visitors")).select(
        "layer_no",
        "layer",
        F.round("_rows", 2).alias("row_ratio"),
        F.when(F.col("_rows") > 1.1, "expansion").when(F.col("_rows") < 0.9, "reduction")
        .when(F.col("_rows").isNotNull(), "similar").alias("row_trend"),
        F.round("_visitors", 3).alias("visitor_ratio"),
        F.when(F.col("_visitors") == 1, "preserved").when(F.col("_visitors").isNotNull(), "changed").alias("visitor_trend"),
    )


def layer_counts(raw: DataFrame, bronze: DataFrame, silver: DataFrame, gold: DataFrame) -> DataFrame:
    """Rows and visitors per layer in layer order; raw only where the clock is set."""
    set_clock = raw.filter(F.col("post_cust_hit_time_gmt").isNotNull())
    # The names of the layers.
    parts = [("Raw", set_clock, raw_visitor())]
    parts += [(name, df, F.col("distinct_id")) for name, df in (("Bronze", bronze), ("Silver", silver), ("Gold", gold))]
    rank = F.when(F.col("layer") == "Raw", 1).when(F.col("layer") == "Bronze", 2).when(F.col("layer") == "Silver", 3)
    return _union(
        [
            df.agg(
                F.count(F.lit(1)).alias("row_count"), F.count_distinct(visitor).alias("unique_visitors")
            ).select(F.lit(name).alias("layer"), "*")
            for name, df, visitor in parts
        ]
    ).orderBy(rank.asc_nulls_last())


def mapping_effectiveness(event_map: DataFrame, custom: DataFrame, evars: DataFrame) -> DataFrame:
    named = {
        "Total Events": event_map,
        "SDR Custom Event Overrides": custom,
        "SDR eVar Overrides": evars,
    }
    return row_counts(named).select(F.col("table_name").alias("metric"), F.col("row_count").alias("count"))


def quality_passes(gold: DataFrame) -> DataFrame:
    """Three checks as rows; one pass over gold."""
    page_view = F.col("event_name") == "Page Viewed"
    counts = gold.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count("ts_utc").alias("timed"),
        F.count_if(F.col("distinct_id") != "").alias("known"),
        F.count_if(page_view & F.col("is_page_view")).alias("flagged"),
        F.count_if(page_view).alias("views"),
    )
    row = lambda name, good, total: F.struct(
        F.lit(name).alias("check_name"), F.col(good).alias("pass_count"), F.col(total).alias("total_count")
    )
    checks = F.array(
        row("Valid Timestamps", "timed", "rows"),
        row("Valid Distinct IDs", "known", "rows"),
        row("Page Views Properly Flagged", "flagged", "views"),
    )
    return counts.select(F.explode(checks).alias("c")).select(
        "c.*", _share(F.col("c.pass_count"), F.col("c.total_count"), 2).alias("pass_percentage")
    )


def null_rates(bronze: DataFrame, silver: DataFrame, gold: DataFrame) -> DataFrame:
    empty = lambda name: F.col(name).isNull() | (F.col(name) == "")
    layers = [
        ("Bronze", bronze, empty("events_list_clean")),
        ("Silver", silver, F.coalesce(F.size("events_enhanced"), F.lit(0)) <= 0),
        ("Gold", gold, empty("event_name")),
    ]
    stats = _union(
        [
            df.agg(
                F.count(F.lit(1)).alias("total_rows"),
                F.count_distinct("distinct_id").alias("unique_visitors"),
                F.count_if(F.col("ts_utc").isNull()).alias("null_timestamps"),
                F.count_if(no_events).alias("null_events"),
            ).select(F.lit(name).alias("layer"), "*")
            for name, df, no_events in layers
        ]
    )
    return stats.select(
        "*",
        _share(F.col("null_timestamps"), F.col("total_rows"), 2).alias("pct_null_timestamps"),
        _share(F.col("null_events"), F.col("total_rows"), 2).alias("pct_null_events"),
    )


def eventification_check(silver: DataFrame, gold: DataFrame, limit: int | None = 10) -> DataFrame:
    """Hits against events per day, newest first."""
    day = F.to_date("ts_utc").alias("date_utc")
    hits = silver.filter(F.col("ts_utc").isNotNull()).groupBy(day).agg(
        F.count(F.lit(1)).alias("silver_hits"), F.count_distinct("distinct_id").alias("silver_visitors")
    )
    page_view = F.col("event_name") == "Page Viewed"
    timed = gold.filter(F.col("ts_utc").isNotNull())
    # Reduced to one row per hit first, so that no event row is multiplied.
    per_hit = timed.groupBy(day, "original_hit_no").agg(
        F.count(F.lit(1)).alias("_events"),
        F.max(page_view).alias("_viewed"),
        F.count_if(~page_view).alias("_business"),
    )
    hit = F.col("original_hit_no").isNotNull()
    events = per_hit.groupBy("date_utc").agg(
        F.sum("_events").alias("gold_events"),
        F.count_if(hit).alias("unique_hits"),
        F.count_if(hit & F.col("_viewed")).alias("page_views"),
        F.sum("_business").alias("business_events"),
    )
    visitors = timed.select(day, "distinct_id").distinct().groupBy("date_utc").agg(F.count("distinct_id").alias("gold_visitors"))
    events = events.join(visitors, "date_utc")
    # The texts of the two outcomes.
    same = lambda a, b, what: F.when(F.col(a) == F.col(b), f"✓ {what} preservation").otherwise(f"✗ {what} count mismatch")
    result = hits.join(events, "date_utc").select(
        "date_utc",
        "silver_hits",
        "gold_events",
        "unique_hits",
        "page_views",
        "business_events",
        F.round(F.col("gold_events") / F.col("silver_hits"), 2).alias("expansion_ratio"),
        same("unique_hits", "silver_hits", "Hit").alias("hit_validation"),
        same("silver_visitors", "gold_visitors", "Visitor").alias("visitor_validation"),
    ).orderBy(F.desc("date_utc"))
    return result if limit is None else result.limit(limit)
