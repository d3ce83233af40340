"""Row-wise operators on a stream.

The operators that look at one hit at a time take a streaming DataFrame unchanged:
those up to event parsing, and of the later layers names, types and measurements of
events. Page views, hit numbers and reports compare hits and are built from the stored
bronze table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from hitloom.config import Settings
from hitloom.operators import gold as G
from hitloom.operators import silver as S
from hitloom.operators.bronze import lines_to_bronze

#: Name of the counts in a query's progress.
FEED_METRICS = "feed_lines"


def stream_bronze(
    spark: SparkSession, folder: str, schema: T.StructType, settings: Settings = Settings()
) -> DataFrame:
    """Bronze rows of feed files as they arrive in a folder.

    Each batch reports its ``lines`` and ``bad_records`` (long lines, left out) as the
    observed metrics ``feed_lines`` of the query's progress.
    """
    return lines_to_bronze(spark.readStream.text(folder), schema, settings, FEED_METRICS)


def stream_events(bronze: DataFrame, event_map: DataFrame | None = None, settings: Settings = Settings()) -> DataFrame:
    """Bronze hits of a stream with everything that silver and gold derive from one hit's events.

    Adds ``events_enhanced``, ``evar_instances``, ``event_classification``,
    ``measurements`` and ``business_events``. The event map is read anew by each batch.
    """
    named = S.enhance_events(bronze, settings.name_source, event_map)
    sorted_out = S.classify_hits(S.evar_instances(named, settings.evar_number_offset))
    return G.business_events(G.extract_measurements(sorted_out), settings.measurement_codes, settings.ignore_codes)


class BadRecordLimit:
    """The number of bad records in the batches of one query, and the limit to it."""

    def __init__(self, query: StreamingQuery, max_bad: int = Settings.max_bad_records):
        self.query, self.max_bad = query, max_bad
        self.lines = self.bad = 0
        self._last = -1

    def _count(self) -> None:
        for progress in self.query.recentProgress:
            if progress.batchId > self._last:
                self._last = progress.batchId
                counts = progress.observedMetrics.get(FEED_METRICS)
                if counts is not None:
                    self.lines += counts["lines"]
                    self.bad += counts["bad_records"]

    def watch(self, seconds: float | None = None, every: float = 0.5) -> int:
        """Follow the query until it ends, or for some seconds; bad records so far.

        When they exceed the limit, the query is stopped and ``ValueError`` raised. The
        batch that exceeded it has been written by then. Totals belong to this run of the
        query; look at least once per hundred batches, of which Spark keeps no more.
        """
        left = seconds
        while True:
            ended = not self.query.isActive
            self._count()
            if self.bad > self.max_bad:
                self.query.stop()
                raise ValueError(f"{self.bad} bad records in the feed, {self.max_bad} allowed")
            if ended or (left is not None and left <= 0):
                return self.bad
            self.query.awaitTermination(every if left is None else min(every, left))
            left = None if left is None else left - every
