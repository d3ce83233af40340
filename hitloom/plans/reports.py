"""Audience and event reports over gold."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def between_dates(df: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """Rows of the given days, both included; prunes a table partitioned by day."""
    day = F.col("ts_date") if "ts_date" in df.columns else F.to_date("ts_utc")
    if start is not None:
        df = df.filter(day >= F.lit(start).cast("date"))
    if end is not None:
        df = df.filter(day <= F.lit(end).cast("date"))
    return df


def _month():
    return F.trunc(F.to_date("ts_utc"), "MONTH").alias("month_utc")


def monthly_visitors(gold: DataFrame) -> DataFrame:
    return (
        gold.filter(F.col("ts_utc").isNotNull())
        .groupBy(_month())
        .agg(F.count_distinct("distinct_id").alias("unique_visitors"))
        .orderBy("month_utc")
    )


def _views_by_country(gold: DataFrame) -> DataFrame:
    return gold.groupBy(_month(), "country_name").agg(F.count_if("is_page_view").alias("page_views"))


def monthly_views_by_country(gold: DataFrame) -> DataFrame:
    return _views_by_country(gold).orderBy("month_utc", F.desc("page_views"), "country_name")


def top_countries(gold: DataFrame, top: int = 5) -> DataFrame:
    """The countries with most page views per month; equal counts by name."""
    order = Window.partitionBy("month_utc").orderBy(F.desc("page_views"), F.asc_nulls_first("country_name"))
    return (
        _views_by_country(gold)
        .withColumn("_rn", F.row_number().over(order))
        .filter(F.col("_rn") <= top)
        .drop("_rn")
        .orderBy("month_utc", F.desc("page_views"), "country_name")
    )


def event_frequency(gold: DataFrame, limit: int | None = 20) -> DataFrame:
    """Counts, users and share of each event other than page views."""
    counted = (
        gold.filter(F.col("event_name") != "Page Viewed")
        .groupBy("event_name")
        .agg(F.count(F.lit(1)).alias("event_count"), F.count_distinct("distinct_id").alias("unique_users"))
    )
    # The total is one row taken from the grouped counts, not from the events.
    total = counted.agg(F.sum("event_count").alias("_total"))
    share = F.round(F.col("event_count") * 100.0 / F.col("_total"), 2).alias("percentage")
    ranked = (
        counted.crossJoin(F.broadcast(total))
        .select("event_name", "event_count", "unique_users", share)
        .orderBy(F.desc("event_count"), "event_name")
    )
    return ranked if limit is None else ranked.limit(limit)


def user_journeys(gold: DataFrame, limit: int | None = 100) -> DataFrame:
    """Activity per visitor with a page view, most active first.

    Events are first reduced to one row per visitor, day and event name, which
    combines before the shuffle; the distinct counts then run on those rows.
    """
    reduced = gold.groupBy("distinct_id", F.to_date("ts_utc").alias("_day"), "event_name").agg(
        F.count_if("is_page_view").alias("_views"),
        F.count_if(~F.col("is_page_view")).alias("_others"),
        F.min("ts_utc").alias("_first"),
        F.max("ts_utc").alias("_last"),
    )
    journeys = (
        reduced.groupBy("distinct_id")
        .agg(
            F.count_distinct("_day").alias("active_days"),
            F.sum("_views").alias("page_views"),
            F.sum("_others").alias("interactions"),
            F.count_distinct("event_name").alias("unique_event_types"),
            F.min("_first").alias("first_seen"),
            F.max("_last").alias("last_seen"),
        )
        .filter(F.col("page_views") > 0)
        .orderBy(F.desc("active_days"), F.desc("page_views"), "distinct_id")
    )
    return journeys if limit is None else journeys.limit(limit)


def top_events(gold: DataFrame, limit: int = 10) -> DataFrame:
    return (
        gold.groupBy("event_name")
        .agg(F.count(F.lit(1)).alias("event_count"))
        .orderBy(F.desc("event_count"), "event_name")
        .limit(limit)
    )
