"""Follow chosen event codes through the mapping tables and the layers.

The texts in ``layer`` and ``source`` columns are fixed values of these reports.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def has_code(events: str, *codes: int) -> Column:
    return F.exists(events, lambda e: e["event_code"].isin(*codes))


def code_instances(events: str, *codes: int) -> Column:
    return F.size(F.filter(events, lambda e: e["event_code"].isin(*codes)))


def hits_with_code(df: DataFrame, events: str, *codes: int) -> DataFrame:
    return df.filter(has_code(events, *codes))


def _union(*parts: DataFrame) -> DataFrame:
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def _null() -> Column:
    return F.lit(None).cast("bigint")


def trace_layer_codes(bronze: DataFrame, silver: DataFrame, codes: Sequence[int]) -> DataFrame:
    """Hits of bronze and silver that contain each code, one column per code."""

    def part(name: str, df: DataFrame, events: str) -> DataFrame:
        counts = [F.count_if(has_code(events, code)).alias(f"hits_with_{code}") for code in codes]
        return df.agg(F.count(F.lit(1)).alias("total_hits"), *counts).select(F.lit(name).alias("layer"), "*")

    return _union(part("Bronze Layer", bronze, "events_array"), part("Silver Layer", silver, "events_enhanced")).orderBy(
        "layer"
    )


def trace_bronze_codes(bronze: DataFrame, code: int, low: int, high: int) -> DataFrame:
    """Text match against parsed match, and the codes seen in a range."""
    hits = bronze.agg(
        F.count(F.lit(1)).alias("total_hits"),
        F.count_if(F.col("events_list_clean").contains(str(code))).alias("hits_with_raw_code"),
        F.count_if(has_code("events_array", code)).alias("hits_with_parsed_code"),
    ).select(F.lit("Bronze Layer").alias("layer"), "*")
    seen = bronze.select(F.explode("events_array").alias("e")).filter(F.col("e.event_code").between(low, high))
    spread = seen.agg(
        F.count_if(F.col("e.event_code") == code).alias("hits_with_raw_code"),
        F.count_distinct("e.event_code").alias("hits_with_parsed_code"),
    ).select(
        F.lit("Bronze Event Distribution").alias("layer"),
        _null().alias("total_hits"),
        "hits_with_raw_code",
        "hits_with_parsed_code",
    )
    return _union(hits, spread).orderBy("layer")


def trace_bronze_silver(bronze: DataFrame, codes: Sequence[int], low: int, high: int, sample: int = 10) -> DataFrame:
    """Hits with any of the codes, distinct codes in a range, size of a sample."""
    hits = bronze.agg(
        F.count(F.lit(1)).alias("total_hits"), F.count_if(has_code("events_array", *codes)).alias("hits_with_codes")
    ).select(F.lit("Bronze Layer").alias("layer"), "*")
    seen = (
        bronze.select(F.explode("events_array").alias("e"))
        .select("e.event_code")
        .filter(F.col("event_code").between(low, high))
    )
    distinct = seen.agg(F.count_distinct("event_code").alias("hits_with_codes")).select(
        F.lit("Bronze Event Codes").alias("layer"), _null().alias("total_hits"), "hits_with_codes"
    )
    sampled = seen.limit(sample).agg(F.count(F.lit(1)).alias("total_hits")).select(
        F.lit("Bronze Sample").alias("layer"), "total_hits", _null().alias("hits_with_codes")
    )
    return _union(hits, distinct, sampled).orderBy("layer")


def trace_explosion(
    raw: DataFrame,
    silver: DataFrame,
    gold: DataFrame,
    raw_code: int,
    silver_code: int,
    event_name: str,
    sample: int = 3,
) -> DataFrame:
    """One event through raw text, silver arrays and gold rows."""
    in_text = F.col("post_event_list").contains(f"{raw_code},") | (
        F.col("post_event_list").endswith(f",{raw_code}") | (F.col("post_event_list") == str(raw_code))
    )
    raw_part = raw.agg(
        F.count(F.lit(1)).alias("total_hits"),
        F.count_if(in_text).alias("hits_with_event"),
    ).select(F.lit("Raw Layer").alias("layer"), "*", _null().alias("total_instances"))
    silver_part = silver.agg(
        F.count(F.lit(1)).alias("total_hits"),
        F.count_if(has_code("events_enhanced", silver_code)).alias("hits_with_event"),
        F.sum(code_instances("events_enhanced", silver_code)).alias("total_instances"),
    ).select(F.lit("Silver Layer").alias("layer"), "*")
    gold_part = gold.agg(
        F.count_distinct("original_hit_no").alias("hits_with_event"),
        F.count_if(F.col("event_name") == event_name).alias("total_instances"),
    ).select(F.lit("Gold Layer").alias("layer"), _null().alias("total_hits"), "hits_with_event", "total_instances")
    sampled = (
        raw.select("post_event_list")
        .filter(F.col("post_event_list").contains(str(raw_code)))
        .limit(sample)
        .agg(F.count(F.lit(1)).alias("total_instances"))
        .select(
            F.lit("Sample Raw").alias("layer"),
            _null().alias("total_hits"),
            _null().alias("hits_with_event"),
            "total_instances",
        )
    )
    divider = raw_part.select(
        F.lit("Sample Check").alias("layer"),
        _null().alias("total_hits"),
        _null().alias("hits_with_event"),
        _null().alias("total_instances"),
    )
    return _union(raw_part, silver_part, gold_part, divider, sampled).orderBy("layer")


def trace_explosion_short(
    raw: DataFrame, silver: DataFrame, gold: DataFrame, raw_code: int, silver_code: int, event_name: str
) -> DataFrame:
    """Hits with the event in raw, silver and gold."""
    parts = [
        ("Raw Layer", raw, F.count(F.lit(1)), F.count_if(F.col("post_event_list").contains(str(raw_code)))),
        ("Silver Layer", silver, F.count(F.lit(1)), F.count_if(has_code("events_enhanced", silver_code))),
        ("Gold Layer", gold, F.count_distinct("original_hit_no"), F.count_if(F.col("event_name") == event_name)),
    ]
    return _union(
        *[
            df.agg(total.alias("total_hits"), found.alias("hits_with_event")).select(F.lit(name).alias("layer"), "*")
            for name, df, total, found in parts
        ]
    ).orderBy("layer")


def trace_mapping(
    custom_raw: DataFrame, custom: DataFrame, event_map: DataFrame, base: DataFrame, numbers: Sequence[int], codes: Sequence[int]
) -> DataFrame:
    """What each mapping stage knows about chosen custom events."""
    labels = [f"event{n}" for n in numbers]
    null_text = F.lit(None).cast("string")
    raw_part = custom_raw.filter(F.col("Event").isin(*labels)).select(
        F.lit("Raw SDR Data").alias("source"),
        F.col("Event").alias("item"),
        _null().alias("code"),
        F.col("Name").alias("name"),
        F.length("Name").cast("bigint").alias("name_length"),
    )
    done = custom.filter(F.col("custom_event_number").isin(*numbers)).select(
        F.lit("Processed SDR Data").alias("source"),
        F.col("custom_event_number").cast("string").alias("item"),
        "code",
        F.col("name_override").alias("name"),
        _null().alias("name_length"),
    )
    rest = [
        df.filter(F.col(key).isin(*codes)).select(
            F.lit(source).alias("source"),
            null_text.alias("item"),
            F.col(key).cast("bigint").alias("code"),
            "name",
            _null().alias("name_length"),
        )
        for source, df, key in (("Final Event Map", event_map, "code"), ("Base Events", base, "id"))
    ]
    return _union(raw_part, done, *rest).orderBy("source", "item", "code")
