"""Expressions over the event array of a hit."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Measurement column -> parts of an event name that feed it.
MEASUREMENT_PATTERNS = {
    "page_load_time": ("Page Load Time",),
    "time_on_page": ("Time on Page",),
    "scroll_depth": ("Scroll",),
    "form_starts": ("Form Start", "Form Initialize"),
    "form_completions": ("Form Success", "Form Completion"),
    "video_plays": ("Video",),
    "downloads": ("Download",),
    "external_links": ("External",),
    "custom_link_clicks": ("Link Click",),
}

# Measurement column -> event code that feeds it.
MEASUREMENT_CODE_COLUMNS = {
    "measurement_209_page_load_time": 209,
    "measurement_236_page_scroll_75": 236,
    "measurement_240": 240,
}


def literal_event_name(code: Column) -> Column:
    return F.concat(F.lit("Event "), code.cast("string"))


def event_type(code: Column) -> Column:
    return (
        F.when(code.between(200, 299), "custom_event")
        .when(code.between(1, 199), "standard_event")
        .when(code >= 10000, "evar_instance")
        .otherwise("unknown")
    )


def enhanced_events(events: Column, name: Callable[[Column], Column] = literal_event_name) -> Column:
    return F.transform(
        F.filter(events, lambda e: e["event_code"].isNotNull()),
        lambda e: F.struct(
            e["event_code"].alias("event_code"),
            e["event_value"].alias("event_value"),
            name(e["event_code"]).alias("event_name"),
            event_type(e["event_code"]).alias("event_type"),
            F.coalesce(e["event_value"] > 1, F.lit(False)).alias("is_measurement"),
        ),
    )


def evar_instances(events: Column, number_offset: int = 9999) -> Column:
    return F.transform(
        F.filter(events, lambda e: e["event_code"] >= 10000),
        lambda e: F.struct(
            e["event_code"].alias("event_code"),
            e["event_value"].alias("event_value"),
            (e["event_code"] - number_offset).alias("evar_number"),
        ),
    )


def _first_value(events: Column, wanted: Callable[[Column], Column]) -> Column:
    return F.get(F.filter(events, wanted), 0)["event_value"]


def measurements(
    events: Column,
    patterns: dict[str, Sequence[str]] = MEASUREMENT_PATTERNS,
    codes: dict[str, int] = MEASUREMENT_CODE_COLUMNS,
) -> Column:
    """One struct of first matching values: by part of the name, then by code."""

    def named(parts: Sequence[str]) -> Callable[[Column], Column]:
        def test(e: Column) -> Column:
            hit = e["event_name"].contains(parts[0])
            for part in parts[1:]:
                hit = hit | e["event_name"].contains(part)
            return hit

        return test

    def coded(code: int) -> Callable[[Column], Column]:
        return lambda e: e["event_code"] == code

    fields = [_first_value(events, named(parts)).alias(out) for out, parts in patterns.items()]
    fields += [_first_value(events, coded(code)).alias(out) for out, code in codes.items()]
    return F.struct(*fields)


def business_events(events: Column, measurement_codes: Sequence[int], ignore_codes: Sequence[int] = ()) -> Column:
    """Named events that are neither eVar instances, measurements nor ignored."""
    excluded = sorted({*measurement_codes, *ignore_codes})

    def wanted(e: Column) -> Column:
        code = e["event_code"]
        keep = code.isNotNull() & (e["event_name"] != "") & ~code.between(100, 199) & (code < 10000)
        return keep & ~code.isin(*excluded) if excluded else keep

    return F.transform(
        F.filter(events, wanted),
        lambda e: F.struct(
            e["event_name"].alias("event_name"),
            e["event_code"].alias("event_code"),
            e["event_value"].alias("event_value"),
            e["event_type"].alias("event_type"),
        ),
    )


def visitor_type(visit_num: Column) -> Column:
    return F.when(visit_num.try_cast("bigint") == 1, "New").otherwise("Returning")


def insert_id(visitor: Column, name: Column, at: Column) -> Column:
    return F.md5(F.concat(visitor, F.lit("-"), name, F.lit("-"), F.unix_micros(at).cast("string")))
