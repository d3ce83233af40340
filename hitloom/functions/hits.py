"""Time, visitor and event list of one raw hit."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from hitloom.config import VISITOR_PRECEDENCE
from hitloom.functions.text import all_digits, malformed, null_if_blank, null_if_marker

TIME_COLUMNS = ("post_cust_hit_time_gmt", "cust_hit_time_gmt", "hit_time_gmt")


def epoch_time(col: Column) -> Column:
    """13 digits are milliseconds, 10 digits seconds, anything else NULL."""
    number = col.try_cast("bigint")
    return F.when(all_digits(col, 13), F.timestamp_millis(number)).when(
        all_digits(col, 10), F.timestamp_seconds(number)
    )


def hit_time() -> Column:
    """The first usable clock of a hit, ``date_time`` last."""
    clocks = [epoch_time(F.col(name)) for name in TIME_COLUMNS]
    return F.coalesce(*clocks, F.try_to_timestamp(F.col("date_time"), F.lit("yyyy-MM-dd HH:mm:ss")))


def has_any_time() -> Column:
    present = [F.col(name).isNotNull() for name in TIME_COLUMNS]
    return present[0] | present[1] | present[2]


def _not_empty(name: str) -> Column:
    return F.when(F.col(name) != "", F.col(name))


def fingerprint() -> Column:
    parts = [F.coalesce(F.col(name), F.lit("")) for name in ("ip", "user_agent", "accept_language")]
    return F.concat(F.lit("fp:"), F.md5(F.concat_ws("|", *parts)))


def visitor_id(precedence: Sequence[str] = VISITOR_PRECEDENCE) -> Column:
    """First known identity; NULL only if ``fallback`` is left out.

    Markers such as ``-`` are not screened in the high/low pair, only in the
    single-column identities.
    """
    sources = {
        "post_visid": F.concat(_not_empty("post_visid_high"), F.lit("-"), _not_empty("post_visid_low")),
        "mcvisid": null_if_marker(F.col("mcvisid")),
        "post_cust_visid": F.concat(F.lit("cust:"), null_if_marker(F.col("post_cust_visid"))),
        "fallback": fingerprint(),
    }
    return F.coalesce(*[sources[name] for name in precedence])


def event_text() -> Column:
    """The processed event list, else the raw one, else NULL."""
    return F.coalesce(null_if_blank(F.col("post_event_list")), null_if_blank(F.col("event_list")))


def parsed_events() -> Column:
    """Array of (event_code, event_value); empty, never NULL."""
    tokens = F.split(F.regexp_replace(event_text(), r"\s+", ""), ",")
    coded = F.filter(tokens, lambda token: token.rlike(r"^[0-9]"))
    events = F.transform(
        coded,
        lambda token: F.struct(
            F.regexp_extract(token, r"^([0-9]+)", 1).try_cast("bigint").alias("event_code"),
            F.regexp_extract(token, r"=([-+]?[0-9]*\.?[0-9]+)", 1).try_cast("double").alias("event_value"),
        ),
    )
    return F.coalesce(events, F.array().cast("array<struct<event_code:bigint,event_value:double>>"))


def clean_event_list() -> Column:
    return F.coalesce(null_if_marker(F.col("post_event_list")), null_if_marker(F.col("event_list")))


def bad_hit_time() -> Column:
    return malformed(F.col("hit_time_gmt"), 10)


def bad_hitid_high() -> Column:
    return malformed(F.col("hitid_high"), 10, 20)


def bad_hitid_low() -> Column:
    return malformed(F.col("hitid_low"), 10, 20)


def malformed_hit() -> Column:
    return bad_hit_time() | bad_hitid_high() | bad_hitid_low()
