"""One entry per operator: each reads the given tables and returns rows that
another engine can reproduce (arrays exploded, times as microseconds)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hitloom.config import Settings
from hitloom.operators import bronze as B
from hitloom.operators import event_map as M
from hitloom.operators import gold as G
from hitloom.operators import lookups as K
from hitloom.operators import repair as R
from hitloom.operators import silver as S
from hitloom.plans import quality as Q
from hitloom.plans import reports as P
from hitloom.plans import traces as X
from hitloom.plans.layers import Inputs, Layers, plan_layers
from hitloom.sources import feed as FD
from hitloom.sources import layers as LY
from workload import inputs as I

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Names as they stand in the feed: the mapping tables are not consulted.
LITERAL = Settings(name_source="literal", custom_event_base=200, evar_code_offset=9999)

# The codes the trace reports ask for.
TRACE_RAW, TRACE_MAPPED, TRACE_LOW, TRACE_HIGH = 214, 213, 210, 220
TRACE_NUMBERS = (5, 12, 14, 33)
TRACE_CODES = (204, 211, 213, 232)
TRACE_EVENT = "Asset Download"


def plain(df: DataFrame) -> DataFrame:
    """Times as microseconds, dates as text, all whole numbers as long."""
    columns = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.TimestampType):
            columns.append(f"unix_micros(`{f.name}`) AS `{f.name}`")
        elif isinstance(f.dataType, T.DateType):
            columns.append(f"CAST(`{f.name}` AS STRING) AS `{f.name}`")
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            columns.append(f"CAST(`{f.name}` AS BIGINT) AS `{f.name}`")
        else:
            columns.append(f"`{f.name}`")
    return df.selectExpr(*columns)


def query(function: Callable[[Inputs], DataFrame]) -> Callable[[Inputs], DataFrame]:
    """Register a query over the feed-shaped inputs."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return plain(function(I.inputs(spark, sf_dir)))

    QUERIES[function.__name__] = run
    return function


def layered(function: Callable[[Layers], DataFrame]) -> Callable[[Layers], DataFrame]:
    """Register a query over the planned layers."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return plain(function(plan_layers(I.inputs(spark, sf_dir))))

    QUERIES[function.__name__] = run
    return function


def tabled(function: Query) -> Query:
    """Register a query over other tables."""
    QUERIES[function.__name__] = lambda spark, sf_dir: plain(function(spark, sf_dir))
    return function


def _bronze(i: Inputs) -> DataFrame:
    return B.to_bronze(i.raw)


def _silver(i: Inputs, settings: Settings = Settings()) -> DataFrame:
    evars = M.sdr_evars(i.evars_raw, settings.evar_code_offset)
    return S.to_silver(B.to_bronze(i.raw, settings), evars, i.props_raw, settings, _map(i, settings))


def _map(i: Inputs, settings: Settings = Settings()) -> DataFrame:
    return M.event_map_ranked(
        i.base_events, i.custom_events_raw, i.evars_raw, settings.custom_event_base, settings.evar_code_offset
    )


KEY = ("hitid_high", "hitid_low", "ts_utc")


def _exploded(df: DataFrame, array: str, *keep: str) -> DataFrame:
    return df.select(*(keep or KEY), F.posexplode(array).alias("pos", "e")).select(*(keep or KEY), "pos", "e.*")


# -- raw and bronze ------------------------------------------------------------


@query
def raw_quality(i):
    return Q.raw_quality(i.raw)


@query
def raw_quality_4dp(i):
    return Q.raw_summary(i.raw)


@query
def malformed_verdict(i):
    return Q.malformed_verdict(Q.raw_quality(i.raw))


@query
def bad_rows(i):
    return Q.bad_rows(i.raw)


@query
def field_lengths(i):
    return Q.field_lengths(i.raw)


@query
def row_drift(i):
    return Q.row_drift(Q.bronze_metrics(_bronze(i)), 9000)


@query
def language_drift(i):
    return Q.language_drift(i.raw)


@query
def parse_hit_time(i):
    return B.parse_hit_time(i.raw).select("hitid_high", "hitid_low", "ts_utc")


@query
def resolve_visitor(i):
    return B.resolve_visitor(i.raw).groupBy("distinct_id").agg(F.count(F.lit(1)).alias("hits"))


@query
def resolve_visitor_reordered(i):
    order = ("post_cust_visid", "mcvisid", "fallback")
    return B.resolve_visitor(i.raw, order).groupBy("distinct_id").agg(F.count(F.lit(1)).alias("hits"))


@query
def parse_event_list(i):
    return _exploded(B.parse_event_list(i.raw), "events_array", "hitid_high", "hitid_low", "events_list_clean")


@query
def null_markers(i):
    return B.clean_null_markers(i.raw)


@query
def timed_hits(i):
    return B.keep_timed(i.raw).select("hitid_high", "hitid_low", "hit_time_gmt")


@query
def bronze(i):
    return _bronze(i).withColumn("n_events", F.size("events_array")).drop("events_array")


@query
def bronze_well_formed(i):
    kept = B.to_bronze(i.raw, Settings(drop_malformed=True, keep_raw=True))
    return kept.select(*KEY, "distinct_id", "post_event_list", "mcvisid", "events_list_clean")


@query
def bronze_basic(i):
    basic = B.to_bronze_basic(i.raw)
    return _exploded(basic, "events_array", *KEY, "distinct_id", "events_list_clean", "event_list")


# -- mapping tables ------------------------------------------------------------


@query
def sdr_custom_events(i):
    return M.sdr_custom_events(i.custom_events_raw)


@query
def sdr_evars(i):
    return M.sdr_evars(i.evars_raw)


@query
def event_map_join(i):
    return M.event_map_join(i.base_events, M.sdr_custom_events(i.custom_events_raw), M.sdr_evars(i.evars_raw))


@query
def event_map_ranked(i):
    return M.event_map_ranked(i.base_events, i.custom_events_raw, i.evars_raw)


@query
def sdr_join_trace(i):
    trace = M.event_map_trace(i.base_events, M.sdr_custom_events(i.custom_events_raw), M.sdr_evars(i.evars_raw))
    return trace.filter(F.col("code").isin(*TRACE_CODES)).orderBy("code")


@query
def mapping_trace(i):
    custom = M.sdr_custom_events(i.custom_events_raw)
    joined = M.event_map_join(i.base_events, custom, M.sdr_evars(i.evars_raw))
    return X.trace_mapping(i.custom_events_raw, custom, joined, i.base_events, TRACE_NUMBERS, TRACE_CODES)


@query
def mapping_effectiveness(i):
    custom, evars = M.sdr_custom_events(i.custom_events_raw), M.sdr_evars(i.evars_raw)
    return Q.mapping_effectiveness(M.event_map_join(i.base_events, custom, evars), custom, evars)


def _alias_counts(aliased: DataFrame, prefix: str) -> DataFrame:
    names = [name for name in aliased.columns if name.startswith(prefix)]
    counted = aliased.agg(*[F.expr(f"count(`{n}`) AS `{n}`") for n in names])
    rows = ", ".join(f"'{n}', `{n}`" for n in names)
    return counted.selectExpr(f"stack({len(names)}, {rows}) AS (alias, filled)")


@query
def evar_aliases(i):
    return _alias_counts(S.alias_evars(_bronze(i), M.sdr_evars(i.evars_raw)), "evar_")


@query
def evar_aliases_taken(i):
    """An alias that meets a column of the feed gets a suffix."""
    taken = _bronze(i).withColumn("evar_page_name", F.lit("taken"))
    return _alias_counts(S.alias_evars(taken, M.sdr_evars(i.evars_raw)), "evar_")


@query
def prop_aliases(i):
    return _alias_counts(S.alias_props(_bronze(i), i.props_raw), "prop_")


# -- silver ---------------------------------------------------------------------


@query
def enhance_events(i):
    return _exploded(S.enhance_events(_bronze(i)), "events_enhanced")


@query
def enhance_events_named(i):
    return _exploded(S.enhance_events(_bronze(i), "event_map", _map(i), lookup="auto"), "events_enhanced")


@query
def evar_instances(i):
    return _exploded(S.evar_instances(_bronze(i)), "evar_instances")


@query
def page_views(i):
    viewed = S.detect_page_view(_bronze(i))
    return viewed.filter("ts_utc IS NOT NULL").select(*KEY, "distinct_id", "prev_url", "is_page_view")


@query
def page_views_flag_only(i):
    viewed = S.detect_page_view(_bronze(i), use_url_change=False)
    return viewed.filter("ts_utc IS NOT NULL").groupBy("is_page_view").agg(F.count(F.lit(1)).alias("hits"))


@query
def silver(i):
    rows = _silver(i).withColumn("n_events", F.size("events_enhanced"))
    return rows.withColumn("n_evars", F.size("evar_instances")).select(
        *KEY, "distinct_id", "prev_url", "is_page_view", "event_classification", "n_events", "n_evars",
        "page_url", "evar_page_name", "evar_location", "prop_page_name", "prop_current_url",
    )


# -- gold -----------------------------------------------------------------------


@query
def measurements(i):
    named = S.enhance_events(_bronze(i), "event_map", _map(i), lookup="auto")
    return G.extract_measurements(named).select(*KEY, "measurements.*")


@query
def business_events(i):
    named = S.enhance_events(_bronze(i), "event_map", _map(i), lookup="auto")
    return _exploded(G.business_events(named, ignore_codes=(7, 211)), "business_events")


@query
def primary_event(i):
    hits = G.primary_event(G.business_events(_silver(i)))
    return hits.groupBy("primary_event").agg(F.count(F.lit(1)).alias("hits"))


@query
def hit_numbers(i):
    timed = _bronze(i).filter("ts_utc IS NOT NULL")
    return G.hit_numbers(timed.select(*KEY, "distinct_id"))


@query
def hit_ids(i):
    timed = _bronze(i).filter("ts_utc IS NOT NULL")
    return G.hit_ids(timed.select(*KEY, "distinct_id"))


#: Limits that cut keys of a few rows already.
CUT = {"share": 0.02, "min_rows": 10}


@query
def hit_numbers_cut(i):
    timed = _bronze(i).filter("ts_utc IS NOT NULL")
    return G.hit_numbers(timed.select(*KEY, "distinct_id"), **CUT)


@query
def page_views_cut(i):
    viewed = S.detect_page_view(_bronze(i), **CUT)
    return viewed.filter("ts_utc IS NOT NULL").select(*KEY, "distinct_id", "prev_url", "is_page_view")


@query
def hit_ids_cut(i):
    """Numbers among the hits of a visitor on one day, where a few hits make a key hot."""
    day = F.date_trunc("DAY", "ts_utc")
    timed = _bronze(i).filter("ts_utc IS NOT NULL").withColumn("ts_utc", day)
    return G.hit_ids(timed.select(*KEY, "distinct_id"), share=0.0002, min_rows=2)


@query
def bronze_basic_cut(i):
    basic = B.to_bronze_basic(i.raw, **CUT)
    return _exploded(basic, "events_array", *KEY, "distinct_id", "events_list_clean", "event_list")


@query
def gold_joined_names(i):
    """Gold by joins with salted event codes instead of tables in memory."""
    return _gold(i, settings=Settings(event_lookup="join"))


@query
def lookup_labels(i):
    coded = _bronze(i).select("hitid_high", "hitid_low", "browser", "os", "connection_type", "geo_country", "ref_type")
    return G.lookup_labels(coded, i.lookups)


@query
def reduced_lookup(i):
    return K.reduce_lookup(i.lookups["browser"], _bronze(i), "browser")


def _gold(i: Inputs, *branches: str, settings: Settings = Settings()) -> DataFrame:
    chosen = branches or ("page_view", "business", "fallback")
    return G.to_gold(
        _silver(i, settings), _map(i, settings), i.base_events, i.lookups, settings, branches=chosen
    )


@query
def gold_page_views(i):
    return _gold(i, "page_view")


@query
def gold_business(i):
    return _gold(i, "business")


@query
def gold_fallback(i):
    # With standard and custom codes ignored, hits keep only their measurements.
    return _gold(i, "fallback", settings=Settings(use_url_change=False, ignore_codes=tuple(range(1, 300))))


@query
def gold(i):
    return _gold(i)


@query
def gold_literal_names(i):
    return _gold(i, settings=LITERAL)


@query
def deduped_events(i):
    return G.dedupe_events(_gold(i)).select("insert_id", "ts_utc", "event_name", "original_hit_no", "event_sequence")


@query
def deduped_no_fallback(i):
    """Hits without any identity keep their events: a NULL id is no common id."""
    strict = Settings(visitor_precedence=("post_visid", "mcvisid"))
    return G.dedupe_events(_gold(i, settings=strict)).select("insert_id", "ts_utc", "event_name", "original_hit_no", "event_sequence")


@query
def export_rows(i):
    return LY.export_rows(_gold(i))


@query
def date_range(i):
    return P.between_dates(_gold(i), "2024-01-05", "2024-01-12").select("insert_id", "ts_utc", "event_name")


# -- quality reports --------------------------------------------------------------


@query
def bronze_metrics(i):
    return Q.bronze_metrics(_bronze(i))


@query
def bronze_checks(i):
    return Q.bronze_checks(_bronze(i))


@query
def silver_metrics(i):
    return Q.silver_metrics(_silver(i))


@query
def silver_checks(i):
    return Q.silver_checks(_silver(i), M.event_map_ranked(i.base_events, i.custom_events_raw, i.evars_raw))


@query
def unknown_events(i):
    return Q.unknown_events(S.enhance_events(_bronze(i)), _map(i))


@layered
def gold_metrics(layers):
    return Q.gold_metrics(layers.gold)


@layered
def gold_checks(layers):
    return Q.gold_checks(layers.silver, layers.gold)


@layered
def event_breakdown(layers):
    return layers.events()


@layered
def layer_summary(layers):
    return layers.summary()


@layered
def layer_ratios(layers):
    return layers.ratios()


@layered
def layer_counts(layers):
    return Q.layer_counts(layers.raw, layers.bronze, layers.silver, layers.gold)


@layered
def quality_passes(layers):
    return Q.quality_passes(layers.gold)


@layered
def null_rates(layers):
    return Q.null_rates(layers.bronze, layers.silver, layers.gold)


@layered
def eventification_check(layers):
    return Q.eventification_check(layers.silver, layers.gold)


def _load_tables(i: Inputs) -> dict[str, DataFrame]:
    tables = {"raw": i.raw, "lookup_events": i.base_events, "sdr_custom_events_raw": i.custom_events_raw,
              "sdr_evars_raw": i.evars_raw, "sdr_props_raw": i.props_raw,
              "sdr_custom_events": M.sdr_custom_events(i.custom_events_raw), "sdr_evars": M.sdr_evars(i.evars_raw),
              "event_map": _map(i)}
    return tables | {f"lookup_{name}": df for name, df in i.lookups.items()}


@query
def row_counts(i):
    return Q.load_tables(_load_tables(i))


@query
def load_summary(i):
    return Q.load_summary(_load_tables(i))


# -- traces -----------------------------------------------------------------------


@query
def event_trace_layers(i):
    return X.trace_layer_codes(_bronze(i), _silver(i), (TRACE_RAW, TRACE_MAPPED))


@query
def event_trace_bronze(i):
    return X.trace_bronze_codes(_bronze(i), TRACE_RAW, TRACE_LOW, TRACE_HIGH)


@query
def event_trace_codes(i):
    return X.trace_bronze_silver(_bronze(i), (TRACE_MAPPED, TRACE_RAW), TRACE_LOW, TRACE_HIGH)


@layered
def event_trace_explosion(layers):
    return X.trace_explosion(layers.raw, layers.silver, layers.gold, TRACE_RAW, TRACE_MAPPED, TRACE_EVENT)


@layered
def event_trace_short(layers):
    return X.trace_explosion_short(layers.raw, layers.silver, layers.gold, TRACE_RAW, TRACE_MAPPED, TRACE_EVENT)


@query
def hits_with_code(i):
    return X.hits_with_code(_bronze(i), "events_array", TRACE_RAW).select(*KEY, "distinct_id")


# -- reports ------------------------------------------------------------------------


@layered
def monthly_visitors(layers):
    return P.monthly_visitors(layers.gold)


@layered
def monthly_views_country(layers):
    return P.monthly_views_by_country(layers.gold)


@layered
def top5_countries(layers):
    return P.top_countries(layers.gold)


@layered
def event_frequency(layers):
    return P.event_frequency(layers.gold)


@layered
def user_journey(layers):
    return P.user_journeys(layers.gold)


@layered
def top_events(layers):
    return P.top_events(layers.gold)


# -- feed repair ----------------------------------------------------------------------


@tabled
def read_hits(spark, sf_dir):
    """Lines to hits: short rows padded, long ones rejected."""
    lines = I.table(spark, sf_dir, I.RECORDS, **I.ONE_LINE)
    return FD.split_hits(lines, FD.hit_schema(f"Field {n}" for n in range(I.LINE_WIDTH + 1)))


@tabled
def feed_line_counts(spark, sf_dir):
    """Lines kept, padded and rejected in the feed that `read_hits` reads."""
    lines = I.table(spark, sf_dir, I.RECORDS, **I.ONE_LINE)
    return FD.feed_line_counts(lines, FD.hit_schema(f"Field {n}" for n in range(I.LINE_WIDTH + 1)))


@tabled
def lookup_rows(spark, sf_dir):
    """Lookup lines with one, two and three columns and some ids that are no numbers."""
    return FD.lookup_rows(I.table(spark, sf_dir, I.LOOKUP_LINES))


@tabled
def sdr_rows(spark, sf_dir):
    named = FD.sdr_rows(I.table(spark, sf_dir, "SELECT CAST(p_partkey AS STRING) AS k, p_name, p_type FROM part"), "evars")
    bare = FD.sdr_rows(I.table(spark, sf_dir, "SELECT n_name FROM nation"), "evars")
    return named.union(bare)


@tabled
def sanitize_columns(spark, sf_dir):
    names = ("Event ID", "2nd id", "'user'", "User", "value %", "__", "!")
    events = I.table(spark, sf_dir, "SELECT event_id, user_id, event_type, value, props, {S} AS s, user_id FROM events")
    return FD.sanitize_columns(events.toDF(*names)).drop("_")


def _indexed(spark, sf_dir) -> DataFrame:
    return R.index_lines(I.feed_lines(spark, sf_dir))


@tabled
def find_anchors(spark, sf_dir):
    found = R.find_anchors(I.feed_lines(spark, sf_dir))
    return found.select("path", "row", "tabs", F.explode("anchors").alias("anchor"))


@tabled
def tab_histogram(spark, sf_dir):
    return R.tab_histogram(_indexed(spark, sf_dir))


@tabled
def canonical_tabs(spark, sf_dir):
    return R.canonical_tabs(R.tab_histogram(_indexed(spark, sf_dir)))


def _assembled(spark, sf_dir) -> DataFrame:
    indexed = _indexed(spark, sf_dir)
    return R.assemble_records(indexed, R.canonical_tabs(R.tab_histogram(indexed)))


@tabled
def assemble_records(spark, sf_dir):
    return _assembled(spark, sf_dir).select("path", "record_row", "record", "tabs", "oversize")


def _single(spark, sf_dir) -> DataFrame:
    records = I.table(spark, sf_dir, I.RECORDS, **I.ONE_LINE).withColumnRenamed("value", "record")
    sized = records.select("*", R.count_tabs(F.col("record")).alias("tabs"), F.lit(I.LINE_WIDTH).alias("width"))
    return R.classify_records(sized, anchor_field=I.LINE_ANCHOR)


@tabled
def record_verdicts(spark, sf_dir):
    return _single(spark, sf_dir).groupBy("verdict").agg(F.count(F.lit(1)).alias("records"))


@tabled
def repaired_records(spark, sf_dir):
    return _single(spark, sf_dir).select("event_id", "verdict", "fixed")


@tabled
def repair_stats(spark, sf_dir):
    records = R.classify_records(_assembled(spark, sf_dir), anchor_field=I.LINE_ANCHOR)
    return R.repair_stats(records)


@tabled
def repair_unsized(spark, sf_dir):
    """Statistics of a feed in which one file has no anchor and another only one."""
    indexed = R.index_lines(I.unsized_lines(spark, sf_dir))
    records = R.assemble_records(indexed, R.canonical_tabs(R.tab_histogram(indexed)))
    return R.repair_stats(R.classify_records(records, anchor_field=I.LINE_ANCHOR))


@tabled
def assemble_records_limited(spark, sf_dir):
    """Records cut at a small size limit, from lines that end in carriage returns."""
    lines = I.feed_lines(spark, sf_dir)
    ended = lines.withColumn("value", F.concat("value", F.lit("\r")))
    indexed = R.index_lines(ended)
    widths = R.canonical_tabs(R.tab_histogram(indexed))
    records = R.assemble_records(indexed, widths, max_chars=I.SMALL_RECORD)
    return records.select("path", "record_row", "record", "tabs", "oversize")
