"""Feed-shaped inputs, derived from the given tables by the same SQL in both engines.

``{S}``, ``{MS}`` and ``{DT}`` are the places where the two dialects differ.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hitloom.plans.layers import Inputs

#: The smallest data set.
SMALL = "/root/testdata/sf0.001"
TABLES = ("events", "part", "nation", "region", "supplier")

SPARK_TERMS = {
    "S": "unix_seconds(cast(ts as timestamp))",
    "MS": "unix_millis(cast(ts as timestamp))",
    "DT": "date_format(ts, 'yyyy-MM-dd HH:mm:ss')",
    "TAB": "char(9)",
}
DUCK_TERMS = {
    "S": "(epoch_us(ts) // 1000000)",
    "MS": "(epoch_us(ts) // 1000)",
    "DT": "strftime(ts, '%Y-%m-%d %H:%M:%S')",
    "TAB": "chr(9)",
}

# Names that the gold layer expects among the naming tables.
EVAR_NAMES = (
    "Page Name", "Current URL", "Time Since Last Use", "Primary Category", "Visitor ID", "Form Page URL",
    "Visit Duration", "Conductor Export Variable", "Location",
)
PROP_NAMES = ("Page Name", "Current URL", "Previous Page", "New vs Repeat Visitors")
MEASURED_NAMES = (
    "Page Load Time", "Time on Page", "Page Scroll 75", "Form Start", "Form Success", "Video Start",
    "Asset Download", "External Link", "Link Click",
)

_PASSED = ("yearly_visitor", "monthly_visitor", "daily_visitor", "hourly_visitor")
_EMPTY = ("javascript", "geo_region", "geo_city", "post_referrer", "va_finder_detail")


def _case(expr: str, names: tuple[str, ...], other: str) -> str:
    arms = " ".join(f"WHEN {i} THEN '{name}'" for i, name in enumerate(names, start=1))
    return f"CASE {expr} {arms} ELSE {other} END"


HITS = f"""
SELECT
 CAST(1000000000000 + event_id - (CASE WHEN event_id % 50 = 1 THEN 1 ELSE 0 END) AS STRING) AS hitid_high,
 CASE WHEN event_id % 89 = 0 THEN 'abc' ELSE CAST(2000000000000 + event_id - (CASE WHEN event_id % 50 = 1 THEN 1 ELSE 0 END) AS STRING) END AS hitid_low,
 CASE WHEN event_id % 97 = 0 THEN 'bad' WHEN event_id % 121 = 0 THEN CAST(NULL AS STRING) ELSE CAST({{S}} AS STRING) END AS hit_time_gmt,
 CASE WHEN event_id % 121 = 0 THEN CAST(NULL AS STRING) WHEN event_id % 7 = 0 THEN '' ELSE CAST({{S}} AS STRING) END AS cust_hit_time_gmt,
 CASE WHEN event_id % 11 = 0 THEN CAST(NULL AS STRING) WHEN event_id % 5 = 0 THEN '' WHEN event_id % 3 = 0 THEN CAST({{MS}} AS STRING) ELSE CAST({{S}} AS STRING) END AS post_cust_hit_time_gmt,
 CASE WHEN event_id % 5 = 0 THEN '' ELSE {{DT}} END AS date_time,
 CASE WHEN user_id % 4 = 0 THEN '' ELSE CAST(100000 + user_id AS STRING) END AS post_visid_high,
 CASE WHEN user_id % 4 = 0 THEN '' ELSE CAST(200000 + user_id AS STRING) END AS post_visid_low,
 CASE WHEN user_id % 8 = 0 THEN '--' ELSE 'mc' || CAST(user_id AS STRING) END AS mcvisid,
 CASE WHEN user_id % 16 = 0 THEN ':' ELSE 'c' || CAST(user_id AS STRING) END AS post_cust_visid,
 '10.0.0.' || CAST(user_id % 250 AS STRING) AS ip,
 CASE WHEN user_id % 5 = 0 THEN '-' ELSE 'ua' || CAST(user_id % 9 AS STRING) END AS user_agent,
 CASE WHEN user_id % 3 = 0 THEN CAST(NULL AS STRING) WHEN event_id % 71 = 0 THEN 'Page 1 title' ELSE 'en-US' END AS accept_language,
 CASE WHEN event_id % 10 = 0 THEN ' ' WHEN event_id % 9 = 0 THEN CAST(NULL AS STRING) ELSE
   CAST(1 + event_id % 40 AS STRING) || ', ' || CAST(200 + event_id % 45 AS STRING) || '=' ||
   CAST(CAST(floor(value * 100) AS BIGINT) AS STRING) || ',,' || CAST(100 + event_id % 60 AS STRING) ||
   ',x9,' || CAST(10000 + event_id % 130 AS STRING) END AS post_event_list,
 CASE WHEN event_id % 10 = 0 THEN '209=' || CAST(event_id % 13 AS STRING) ELSE '' END AS event_list,
 CASE WHEN event_type = 'view' THEN '0' WHEN event_type = 'click' THEN '10' ELSE '-' END AS post_page_event,
 CASE WHEN event_id % 19 = 0 THEN '' ELSE 'https://site.example/p/' || CAST(event_id % 6 AS STRING) END AS page_url,
 CASE WHEN event_id % 4 = 0 THEN '--' ELSE 'Page ' || CAST(event_id % 6 AS STRING) END AS pagename,
 CAST(1 + user_id % 3 AS STRING) AS visit_num,
 CAST(1 + event_id % 12 AS STRING) AS visit_page_num,
 CAST(user_id % 120 AS STRING) AS browser,
 CAST(user_id % 7 AS STRING) AS os,
 CASE WHEN user_id % 6 = 0 THEN ':' ELSE CAST(user_id % 5 AS STRING) END AS connection_type,
 CAST(user_id % 30 AS STRING) AS geo_country,
 CAST(event_id % 8 AS STRING) AS ref_type,
 CASE WHEN user_id % 2 = 0 THEN 'Y' ELSE 'N' END AS java_enabled,
 CAST(user_id % 4 AS STRING) AS c_color,
 'ref' || CAST(event_id % 3 AS STRING) || '.example' AS ref_domain,
 CASE WHEN event_id % 2 = 0 THEN '-' ELSE event_type END AS va_closer_detail,
 {" ".join(f"CAST(user_id % {n} AS STRING) AS {name}," for n, name in enumerate(_PASSED, start=2))}
 {" ".join(f"CAST(NULL AS STRING) AS {name}," for name in _EMPTY)}
 {" ".join(f"'v{n}-' || CAST(event_id % {5 + n} AS STRING) AS post_evar{n}," for n in range(1, 10))}
 {", ".join(f"CASE WHEN event_id % {n + 2} = 0 THEN '' ELSE 'p{n}-' || CAST(event_id % 5 AS STRING) END AS prop{n}" for n in range(1, 5))}
FROM events
"""

BASE_EVENTS = f"SELECT CAST(p_partkey AS INT) AS id, {_case('p_partkey % 10', MEASURED_NAMES, 'p_name')} AS name FROM part"
CUSTOM_EVENTS = """
SELECT CASE WHEN p_partkey % 7 = 0 THEN 'Event' WHEN p_partkey % 11 = 0 THEN 'xevent' ELSE 'event' END || CAST(p_partkey AS STRING) AS Event,
 CASE WHEN p_partkey % 13 = 0 THEN ' ' WHEN p_partkey % 17 = 0 THEN '' WHEN p_partkey % 19 = 0 THEN CAST(NULL AS STRING) ELSE 'Custom ' || p_name END AS Name
FROM part
"""
EVARS = f"""
SELECT 'evar' || CAST(p_partkey AS STRING) AS EvarNumber,
 CASE WHEN p_partkey % 23 = 0 THEN '' WHEN p_partkey % 29 = 0 THEN CAST(NULL AS STRING) ELSE {_case('p_partkey % 25', EVAR_NAMES, 'p_name')} END AS Name
FROM part
"""
PROPS = f"SELECT CAST(n_nationkey AS STRING) AS PropertyNumber, {_case('n_nationkey % 10', PROP_NAMES, 'n_name')} AS Name FROM nation"
LOOKUPS = {
    "browser": "SELECT CAST(s_suppkey AS INT) AS id, s_name AS name FROM supplier",
    "operating_systems": "SELECT r_regionkey AS id, r_name AS name FROM region",
    "connection_type": "SELECT r_regionkey AS id, r_name AS name FROM region",
    "country": "SELECT n_nationkey AS id, n_name AS name FROM nation",
    "referrer_type": "SELECT r_regionkey AS id, r_name AS name FROM region",
}

# Lines of a lookup file: no name, a name, a name and more; every ninth id is text.
LOOKUP_LINES = """
SELECT CASE WHEN s_suppkey % 9 = 0 THEN 'x' ELSE '' END || CAST(s_suppkey AS STRING) ||
 CASE s_suppkey % 3 WHEN 0 THEN '' WHEN 1 THEN {TAB} || s_name ELSE {TAB} || s_name || {TAB} || 'more' END AS value
FROM supplier
"""

# A record of 12 fields with the hit time in field 4: whole, short, long, shifted
# or without anchor. With ``{NL}`` as a line break, some fields span lines.
LINE_WIDTH = 11
LINE_ANCHOR = 4
# A record limit in characters that some records of the feed exceed.
SMALL_RECORD = 60
_ANCHOR = "CAST(1700000000 + event_id AS STRING) || {TAB} || CAST(1000000000000 + event_id AS STRING) || {TAB} || CAST(2000000000000 + event_id AS STRING)"
RECORDS = f"""
SELECT event_id,
 CASE WHEN event_id % 12 IN (1, 2) THEN repeat('s' || {{TAB}}, CAST(3 + event_id % 12 AS INT)) WHEN event_id % 12 = 3 THEN repeat('s' || {{TAB}}, 7) ELSE '' END ||
 CASE WHEN event_id % 12 = 4 THEN 'a' ELSE 'a' || {{TAB}} || 'b' || {{TAB}} || 'c' || {{TAB}} || CAST(user_id AS STRING) END || {{TAB}} ||
 CASE WHEN event_id % 12 = 3 THEN 'none' ELSE {_ANCHOR} END || {{TAB}} ||
 CASE WHEN event_id % 5 = 0 THEN 'h' || {{NL}} || {{NL}} || 'more' ELSE 'h' END || {{TAB}} || event_type || {{TAB}} || 'j' ||
 CASE WHEN event_id % 12 = 11 THEN '' ELSE {{TAB}} || 'k' END ||
 CASE WHEN event_id % 12 IN (5, 11) THEN '' WHEN event_id % 12 = 6 THEN {{TAB}} || 'l' || {{TAB}} || 'm' || {{TAB}} || 'n'
  WHEN event_id % 12 = 4 THEN repeat({{TAB}} || 'x', 9) ELSE {{TAB}} || 'l' END AS value
FROM events
"""
ONE_LINE = {"NL": "''"}
SPARK_BREAK = {"NL": "char(10)"}
DUCK_BREAK = {"NL": "chr(10)"}


def _sql(text: str, terms: dict[str, str]) -> str:
    for key, term in terms.items():
        text = text.replace("{" + key + "}", term)
    return text


def spark_sql(text: str, **more: str) -> str:
    return _sql(text, {**SPARK_TERMS, **more})


def duck_sql(text: str, **more: str) -> str:
    return _sql(text, {**DUCK_TERMS, **more}).replace(" AS STRING)", " AS VARCHAR)")


def spread(events: DataFrame) -> DataFrame:
    """The same rows, dealt to all cores if their files give fewer tasks than there are cores.

    A hit costs far more than the event it is made from, and a few megabytes of events are
    one task. Adaptive execution sets the number of partitions; only rows that agree in all
    three columns stay together.
    """
    if events.rdd.getNumPartitions() >= events.sparkSession.sparkContext.defaultParallelism:
        return events
    return events.repartition("event_id", "ts", "user_id")


def table(spark: SparkSession, sf_dir: str, text: str, **more: str) -> DataFrame:
    """Run one of the projections above over the parquet files of ``sf_dir``."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    select, source = text.rsplit("FROM ", 1)
    given = spark.read.parquet(f"{sf_dir}/{source.strip()}.parquet")
    if source.strip() == "events":
        given = spread(given)
    return spark.sql(spark_sql(select, **more) + " FROM {given}", given=given)


def inputs(spark: SparkSession, sf_dir: str) -> Inputs:
    def read(text: str) -> DataFrame:
        return table(spark, sf_dir, text)

    return Inputs(
        raw=read(HITS),
        base_events=read(BASE_EVENTS),
        custom_events_raw=read(CUSTOM_EVENTS),
        evars_raw=read(EVARS),
        props_raw=read(PROPS),
        lookups={name: read(text) for name, text in LOOKUPS.items()},
    )


def feed_lines(spark: SparkSession, sf_dir: str, keep_id: bool = False) -> DataFrame:
    """Physical lines of eight feed files, as the line scan would give them."""
    records = table(spark, sf_dir, RECORDS, **SPARK_BREAK)
    return records.selectExpr("event_id", "posexplode(split(value, '\n'))").selectExpr(
        *(["event_id"] if keep_id else []),
        "concat('feed-', event_id % 8, '.tsv') AS path",
        "event_id div 4000 AS block",
        "event_id * 100 + pos AS row",
        "col AS value",
    )


def unsized_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same feed with all anchors of one file spoilt, and all but one of another."""
    spoilt = F.expr("path = 'feed-6.tsv' OR (path = 'feed-7.tsv' AND event_id <> 7)")
    lines = feed_lines(spark, sf_dir, keep_id=True)
    return lines.withColumn("value", F.when(spoilt, F.regexp_replace("value", "[0-9]", "x")).otherwise(F.col("value"))).drop("event_id")
