"""Raw hits to bronze: clean strings, one clock, one visitor, parsed events."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hitloom.config import Settings
from hitloom.functions import hits as H
from hitloom.functions.text import NULL_MARKERS, null_if_blank, null_if_marker
from hitloom.operators.ordering import number_rows
from hitloom.sources.feed import field_columns, split_lines

# Raw columns that bronze replaces by derived ones.
REPLACED = ("post_cust_hit_time_gmt", "post_visid_high", "post_visid_low", "mcvisid", "post_event_list", "event_list")
# The same for the basic variant, which keeps the raw event list.
REPLACED_BASIC = REPLACED[:5]


def clean_columns(df: DataFrame, exclude: Sequence[str] = (), markers: Sequence[str] = NULL_MARKERS) -> list:
    """Select list: every string column with markers as NULL, the rest as is.

    One SQL text per column: with a thousand columns that builds much faster than
    chains of column calls.
    """
    listed = ", ".join(f"'{marker}'" for marker in markers)
    return [
        F.expr(f"CASE WHEN `{field.name}` NOT IN ({listed}) THEN `{field.name}` END AS `{field.name}`")
        if isinstance(field.dataType, T.StringType)
        else F.col(f"`{field.name}`")
        for field in df.schema.fields
        if field.name not in exclude
    ]


def clean_null_markers(
    df: DataFrame, exclude: Sequence[str] = (), markers: Sequence[str] = NULL_MARKERS
) -> DataFrame:
    return df.select(*clean_columns(df, exclude, markers))


def parse_hit_time(df: DataFrame) -> DataFrame:
    return df.select("*", H.hit_time().alias("ts_utc"))


def resolve_visitor(df: DataFrame, precedence: Sequence[str] = Settings.visitor_precedence) -> DataFrame:
    return df.select("*", H.visitor_id(precedence).alias("distinct_id"))


def parse_event_list(df: DataFrame) -> DataFrame:
    return df.select(
        "*", H.parsed_events().alias("events_array"), H.clean_event_list().alias("events_list_clean")
    )


def keep_timed(df: DataFrame) -> DataFrame:
    """Drop hits on which all three clocks are NULL."""
    return df.filter(H.has_any_time())


def to_bronze(raw: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One select over the raw columns, so nothing reads an already cleaned one."""
    kept = keep_timed(raw)
    if settings.drop_malformed:
        kept = kept.filter(~H.malformed_hit())
    return kept.select(
        *clean_columns(raw, () if settings.keep_raw else REPLACED),
        H.hit_time().alias("ts_utc"),
        H.visitor_id(settings.visitor_precedence).alias("distinct_id"),
        H.parsed_events().alias("events_array"),
        H.clean_event_list().alias("events_list_clean"),
    )


# Raw columns that the derived ones are made of.
_READ = (
    *REPLACED, "cust_hit_time_gmt", "hit_time_gmt", "date_time", "post_cust_visid", "ip", "user_agent",
    "accept_language", "hitid_high", "hitid_low",
)


def lines_to_bronze(
    lines: DataFrame,
    schema: T.StructType,
    settings: Settings = Settings(),
    bad: Observation | str | None = None,
    markers: Sequence[str] = NULL_MARKERS,
) -> DataFrame:
    """`to_bronze` of feed lines, for feeds of a thousand columns and more.

    Markers become NULL once, in the array of fields, and only then the array becomes
    columns: a test for each column costs more than reading, splitting and writing do.
    The derived columns are made of the fields as they came.
    """
    clean = F.transform("f", lambda field: F.when((F.octet_length(field) > max(map(len, markers))) | ~field.isin(*markers), field))
    used = [name for name in schema.names if name in _READ]
    fields = split_lines(lines, len(schema.fields), bad).select(
        clean.alias("_clean"), *[F.expr(column) for column in field_columns(schema, "f", used)]
    )
    kept = keep_timed(fields)
    if settings.drop_malformed:
        kept = kept.filter(~H.malformed_hit())
    passed = [name for name in schema.names if settings.keep_raw or name not in REPLACED]
    return kept.select(
        *[F.expr(column) for column in field_columns(schema, "_clean", passed)],
        H.hit_time().alias("ts_utc"),
        H.visitor_id(settings.visitor_precedence).alias("distinct_id"),
        H.parsed_events().alias("events_array"),
        H.clean_event_list().alias("events_list_clean"),
    )


def _basic_time(name: str):
    number = F.col(name).try_cast("bigint")
    return F.when((F.length(name) == 10) & number.isNotNull(), F.timestamp_seconds(number)).when(
        (F.length(name) == 13) & number.isNotNull(), F.timestamp_millis(number)
    )


def _basic_events():
    text = F.coalesce(null_if_blank(F.col("post_event_list")), null_if_blank(F.col("event_list")))
    items = F.filter(F.split(F.regexp_replace(text, r"^\s+|\s+$", ""), ","), lambda item: item != "")
    events = F.transform(
        items,
        lambda item: F.struct(
            F.substring_index(item, "=", 1).alias("event_code"),
            F.when(item.contains("="), F.regexp_replace(item, r"(?s)^[^=]*=", ""))
            .try_cast("double")
            .alias("event_value"),
        ),
    )
    return F.coalesce(events, F.array().cast("array<struct<event_code:string,event_value:double>>"))


def clock_bucket(clock: Column) -> Column:
    """Leading characters of a raw clock string that never decrease along its order.

    Six digits (some hours), or as far as the digits go and one character more: the
    text is not checked yet, and this takes a bounded number of values for any text.
    """
    return F.regexp_extract(F.coalesce(clock, F.lit("")), "^(?:[0-9]{6}|[0-9]{0,5}[^0-9]?)", 0)


def to_bronze_basic(raw: DataFrame, **limits: float) -> DataFrame:
    """The older variant: clocks told apart by length, text event codes.

    Hits without any identity become ``fallback-n``, n being the position of the
    hit among all hits by its raw time string.
    """
    numbered = number_rows(
        keep_timed(raw),
        clock_bucket(F.col("post_cust_hit_time_gmt")),
        ["post_cust_hit_time_gmt", "hitid_high", "hitid_low"],
        "_n",
        **limits,
    )
    markers = ("", ":", "-")
    visitor = F.coalesce(
        F.concat("post_visid_high", F.lit("-"), "post_visid_low"),
        null_if_marker(F.col("mcvisid"), markers),
        null_if_marker(F.col("post_cust_visid"), markers),
        F.concat(F.lit("fallback-"), F.col("_n").cast("string")),
    )
    return numbered.select(
        *[F.col(f"`{name}`") for name in raw.columns if name not in REPLACED_BASIC],
        F.coalesce(*[_basic_time(name) for name in H.TIME_COLUMNS]).alias("ts_utc"),
        visitor.alias("distinct_id"),
        _basic_events().alias("events_array"),
        H.clean_event_list().alias("events_list_clean"),
    )
