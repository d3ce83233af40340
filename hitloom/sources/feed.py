"""Tab-separated feed files, lookups and naming tables.

Lines are read as text and split: the feed has no quoting, and the CSV reader
would drop blank lines and flag short rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hitloom.functions.text import sanitize_name, unique_names


def hit_schema(header: str | Iterable[str]) -> T.StructType:
    """All-string schema from a comma-separated header line or a list of names."""
    fields = header.strip().split("\n")[0].split(",") if isinstance(header, str) else list(header)
    names = unique_names(sanitize_name(name) for name in fields)
    return T.StructType([T.StructField(name, T.StringType(), True) for name in names])


def read_hit_schema(spark: SparkSession, header_path: str) -> T.StructType:
    """Schema from the first line of a header file."""
    first = spark.read.text(header_path, wholetext=True).head()
    if first is None:
        raise ValueError(f"empty header file: {header_path}")
    return hit_schema(first[0])


def sanitize_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*unique_names(sanitize_name(name) for name in df.columns))


def split_lines(lines: DataFrame, width: int, bad: Observation | str | None = None) -> DataFrame:
    """Lines (column ``value``) as arrays ``f`` of fields, without the lines of more than ``width``.

    ``bad`` counts the long lines during the same pass that uses the hits: an
    observation, or for a stream the name under which each batch reports them.
    """
    fields = lines.select(F.split("value", "\t", -1).alias("f"))
    too_long = F.size("f") > width
    if bad is not None:
        fields = fields.observe(bad, F.count_if(too_long).alias("bad_records"), F.count(F.lit(1)).alias("lines"))
    return fields.filter(~too_long)


def field_columns(schema: T.StructType, array: str = "f", names: Iterable[str] | None = None) -> list[str]:
    """SQL of columns from an array of fields; missing ones are NULL."""
    wanted = None if names is None else set(names)
    return [
        f"get({array}, {i}) AS `{field.name}`"
        for i, field in enumerate(schema.fields)
        if wanted is None or field.name in wanted
    ]


def split_hits(lines: DataFrame, schema: T.StructType, bad: Observation | str | None = None) -> DataFrame:
    """Lines (column ``value``) as hits: short ones padded, long ones left out and counted (`split_lines`)."""
    return split_lines(lines, len(schema.fields), bad).selectExpr(*field_columns(schema))


@dataclass
class HitFeed:
    """Hits and the counter of rejected lines, filled by the first action."""

    hits: DataFrame
    rejected: Observation
    max_bad: int

    def check(self) -> int:
        """The number of rejected lines; raises when above the limit.

        Call it after an action on ``hits``, such as writing the raw table.
        """
        count = self.rejected.get["bad_records"]
        if count > self.max_bad:
            raise ValueError(f"{count} bad records in the feed, {self.max_bad} allowed")
        return count


def read_hits(
    spark: SparkSession, paths: str | Sequence[str], schema: T.StructType, max_bad: int = 10000
) -> HitFeed:
    """Hits of one or many files or globs, plain or gzipped."""
    rejected = Observation()
    lines = spark.read.text(paths if isinstance(paths, str) else list(paths))
    return HitFeed(split_hits(lines, schema, rejected), rejected, max_bad)


def feed_line_counts(lines: DataFrame, schema: T.StructType) -> DataFrame:
    """One row: lines ``kept``, of these ``padded``, and lines ``rejected`` as too long."""
    width, size = len(schema.fields), F.size(F.split("value", "\t", -1))
    return lines.agg(
        F.count_if(size <= width).alias("kept"),
        F.count_if(size < width).alias("padded"),
        F.count_if(size > width).alias("rejected"),
    )


def external_hits(
    spark: SparkSession, paths: str | Sequence[str], schema: T.StructType, view: str, max_bad: int = 10000
) -> DataFrame:
    """The same rows as a view over the files, nothing copied.

    The lines are counted once when the view is made, since a view has no run of its
    own to count them in; more than ``max_bad`` long ones are an error.
    """
    lines = spark.read.text(paths if isinstance(paths, str) else list(paths))
    count = feed_line_counts(lines, schema).first()["rejected"]
    if count > max_bad:
        raise ValueError(f"{count} bad records in the feed, {max_bad} allowed")
    hits = split_hits(lines, schema)
    hits.createOrReplaceTempView(view)
    return hits


def lookup_rows(lines: DataFrame) -> DataFrame:
    """(id, name) of lookup lines (column ``value``); missing names are NULL, more columns ignored."""
    f = lines.select(F.split("value", "\t", -1).alias("f"))
    return f.select(F.get("f", 0).try_cast("int").alias("id"), F.get("f", 1).alias("name"))


def read_lookup(spark: SparkSession, path: str) -> DataFrame:
    """A lookup file without header."""
    return lookup_rows(spark.read.text(path))


# Kind of naming table -> its key column.
SDR_KEYS = {"events": "Event", "evars": "EvarNumber", "props": "PropertyNumber"}


def sdr_rows(table: DataFrame, kind: str) -> DataFrame:
    """The first two columns of a naming table; a missing second one gives NULL names."""
    names = [F.col(f"`{name}`") for name in table.columns[:2]] + [F.lit(None).cast("string")]
    return table.select(names[0].alias(SDR_KEYS[kind]), names[1].alias("Name"))


def read_sdr(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """A naming file, header line skipped."""
    # The CSV reader is used for its header handling only: tabs, no quotes.
    table = spark.read.csv(path, sep="\t", header=True, quote="", escape="", inferSchema=False, mode="PERMISSIVE")
    return sdr_rows(table, kind)
