"""Business naming of events: two ways to merge the mapping sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _number(col: str, pattern: str) -> Column:
    """The first group as a number; NULL without a match or when too large."""
    return F.regexp_extract(col, pattern, 1).try_cast("bigint")


def _evar_code(number: Column, offset: int) -> Column:
    return F.when(number.between(1, 100), number + 99).when(number > 100, number + offset)


def sdr_custom_events(raw: DataFrame, custom_event_base: int = 199) -> DataFrame:
    number = _number("Event", r"(?i)event([0-9]+)")
    return raw.filter(F.col("Event").rlike(r"(?i)^event[0-9]+\z") & F.col("Name").rlike(r"\S")).select(
        number.alias("custom_event_number"),
        F.col("Name").alias("name_override"),
        (number + custom_event_base).alias("code"),
    )


def sdr_evars(raw: DataFrame, evar_code_offset: int = 9899) -> DataFrame:
    number = _number("EvarNumber", r"([0-9]+)")
    return raw.filter(F.col("Name").isNotNull() & number.isNotNull()).select(
        _evar_code(number, evar_code_offset).alias("code"), F.col("Name").alias("name_override")
    )


def event_map_trace(base: DataFrame, custom: DataFrame, evars: DataFrame) -> DataFrame:
    """Base events with every override next to the name that wins."""
    events = custom.select(F.col("code").alias("sdr_code"), F.col("name_override").alias("sdr_name"))
    props = evars.select(F.col("code").alias("_evar_code"), F.col("name_override").alias("_evar_name"))
    return (
        base.select(F.col("id").cast("bigint").alias("code"), F.col("name").alias("base_name"))
        .join(events, F.col("code") == F.col("sdr_code"), "left")
        .join(props, F.col("code") == F.col("_evar_code"), "left")
        .select(
            "code",
            "base_name",
            "sdr_code",
            "sdr_name",
            F.coalesce("sdr_name", "_evar_name", "base_name").alias("final_name"),
        )
    )


def event_map_join(base: DataFrame, custom: DataFrame, evars: DataFrame) -> DataFrame:
    """Base codes only, each with the first known name."""
    return event_map_trace(base, custom, evars).select("code", F.col("final_name").alias("name"))


def event_map_ranked(
    base: DataFrame,
    custom_raw: DataFrame,
    evars_raw: DataFrame,
    custom_event_base: int = 200,
    evar_code_offset: int = 9999,
) -> DataFrame:
    """All codes of all sources; custom events win over eVars, these over base."""
    event = _number("Event", r"event([0-9]+)")
    evar = _number("EvarNumber", r"evar([0-9]+)")
    named = F.col("Name") != ""
    ranked = (
        base.select(
            F.col("id").try_cast("bigint").alias("code"), "name", F.lit("base").alias("source"), F.lit(3).alias("priority")
        )
        .unionByName(
            evars_raw.filter(named).select(
                _evar_code(evar, evar_code_offset).alias("code"),
                F.concat(F.lit("Instance of "), "Name").alias("name"),
                F.lit("sdr_evar").alias("source"),
                F.lit(2).alias("priority"),
            )
        )
        .unionByName(
            custom_raw.filter(named).select(
                (event + custom_event_base).alias("code"),
                F.col("Name").alias("name"),
                F.lit("sdr_custom").alias("source"),
                F.lit(1).alias("priority"),
            )
        )
        .filter(F.col("code").isNotNull())
    )
    # The least (priority, name) per code: combines before the shuffle and needs
    # no sort, unlike a row number. A NULL name loses against any name.
    best = F.min(F.struct("priority", F.col("name").isNull().alias("unnamed"), "name", "source"))
    return (
        ranked.groupBy("code")
        .agg(best.alias("best"))
        .select("code", F.col("best.name").alias("name"), F.col("best.source").alias("mapping_source"))
    )
