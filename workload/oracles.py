"""The same results in DuckDB SQL, written on their own from the semantics."""

from __future__ import annotations

from workload import inputs as I
from workload.queries import (
    TRACE_CODES,
    TRACE_EVENT,
    TRACE_HIGH,
    TRACE_LOW,
    TRACE_MAPPED,
    TRACE_NUMBERS,
    TRACE_RAW,
)

CLOCKS = ("post_cust_hit_time_gmt", "cust_hit_time_gmt", "hit_time_gmt")
PASSED = (
    "hitid_high hitid_low hit_time_gmt cust_hit_time_gmt date_time post_cust_visid ip user_agent accept_language "
    "post_page_event page_url pagename visit_num visit_page_num browser os connection_type geo_country ref_type "
    "java_enabled c_color ref_domain va_closer_detail yearly_visitor monthly_visitor daily_visitor hourly_visitor "
    "javascript geo_region geo_city post_referrer va_finder_detail "
    "post_evar1 post_evar2 post_evar3 post_evar4 post_evar5 post_evar6 post_evar7 post_evar8 post_evar9 "
    "prop1 prop2 prop3 prop4"
).split()
DROPPED = ("post_cust_hit_time_gmt", "post_visid_high", "post_visid_low", "mcvisid", "post_event_list", "event_list")


def clean(col: str) -> str:
    return f"CASE WHEN {col} IN ('', ':', '-', '--') THEN NULL ELSE {col} END"


def _clock(col: str) -> str:
    n = f"TRY_CAST({col} AS BIGINT)"
    return (
        f"WHEN regexp_matches({col}, '^[0-9]{{13}}$') THEN make_timestamp({n} * 1000) "
        f"WHEN regexp_matches({col}, '^[0-9]{{10}}$') THEN make_timestamp({n} * 1000000) "
    )


TIME = "CASE " + "".join(map(_clock, CLOCKS)) + "ELSE try_strptime(date_time, '%Y-%m-%d %H:%M:%S') END"
_FP = "'fp:' || md5(coalesce(ip, '') || '|' || coalesce(user_agent, '') || '|' || coalesce(accept_language, ''))"
_MC = "WHEN mcvisid IS NOT NULL AND mcvisid NOT IN ('', ':', '-', '--') THEN mcvisid"
_CUST = "WHEN post_cust_visid IS NOT NULL AND post_cust_visid NOT IN ('', ':', '-', '--') THEN 'cust:' || post_cust_visid"
VISITOR = (
    "CASE WHEN post_visid_high <> '' AND post_visid_low <> '' THEN post_visid_high || '-' || post_visid_low "
    f"{_MC} {_CUST} ELSE {_FP} END"
)
LIST = "coalesce(nullif(trim(post_event_list), ''), nullif(trim(event_list), ''))"
EVENTS = (
    "[{'code': TRY_CAST(regexp_extract(t, '^([0-9]+)', 1) AS BIGINT), "
    "'value': TRY_CAST(nullif(regexp_extract(t, '=([-+]?[0-9]*\\.?[0-9]+)', 1), '') AS DOUBLE)} "
    f"for t in string_split(regexp_replace({LIST}, '\\s+', '', 'g'), ',') if regexp_matches(t, '^[0-9]')]"
)
LIST_CLEAN = f"coalesce({clean('post_event_list')}, {clean('event_list')})"
BAD_TIME = "(hit_time_gmt IS NULL OR NOT regexp_matches(hit_time_gmt, '^[0-9]{10}$'))"
BAD_HIGH = "(hitid_high IS NULL OR NOT regexp_matches(hitid_high, '^[0-9]{10,20}$'))"
BAD_LOW = "(hitid_low IS NULL OR NOT regexp_matches(hitid_low, '^[0-9]{10,20}$'))"
BAD_ANY = f"({BAD_TIME} OR {BAD_HIGH} OR {BAD_LOW})"
TIMED = "NOT (post_cust_hit_time_gmt IS NULL AND cust_hit_time_gmt IS NULL AND hit_time_gmt IS NULL)"

# Common table expressions, each with those it reads.
CTES: dict[str, tuple[str, tuple[str, ...]]] = {}


def cte(name: str, body: str, *needs: str) -> None:
    CTES[name] = (body, needs)


def with_ctes(select: str, *needs: str) -> str:
    ordered: list[str] = []

    def add(name: str) -> None:
        if name not in ordered:
            for need in CTES[name][1]:
                add(need)
            ordered.append(name)

    for need in needs:
        add(need)
    return "WITH " + ", ".join(f"{n} AS MATERIALIZED ({CTES[n][0]})" for n in ordered) + " " + select


cte("raw", f"SELECT row_number() OVER () AS rid, * FROM ({I.duck_sql(I.HITS)})")
cte("base_events", I.duck_sql(I.BASE_EVENTS))
cte("custom_raw", I.duck_sql(I.CUSTOM_EVENTS))
cte("evars_raw", I.duck_sql(I.EVARS))
cte("props_raw", I.duck_sql(I.PROPS))
for _name, _text in I.LOOKUPS.items():
    cte(f"l_{_name}", I.duck_sql(_text))

cte(
    "bronze",
    f"SELECT rid, {', '.join(f'{clean(c)} AS {c}' for c in PASSED)}, {TIME} AS ts_utc, {VISITOR} AS distinct_id, "
    f"coalesce({EVENTS}, []) AS evs, {LIST_CLEAN} AS events_list_clean FROM raw WHERE {TIMED}",
    "raw",
)
cte(
    "custom",
    "SELECT TRY_CAST(regexp_extract(Event, '(?i)event([0-9]+)', 1) AS BIGINT) AS custom_event_number, Name AS name_override, "
    "199 + TRY_CAST(regexp_extract(Event, '(?i)event([0-9]+)', 1) AS BIGINT) AS code FROM custom_raw "
    "WHERE regexp_matches(Event, '(?i)^event[0-9]+$') AND trim(Name) <> ''",
    "custom_raw",
)
cte(
    "evars",
    "SELECT CASE WHEN n BETWEEN 1 AND 100 THEN 99 + n WHEN n >= 101 THEN 10000 + (n - 101) END AS code, Name AS name_override "
    "FROM (SELECT TRY_CAST(nullif(regexp_extract(EvarNumber, '([0-9]+)', 1), '') AS BIGINT) AS n, Name FROM evars_raw WHERE Name IS NOT NULL) "
    "WHERE n IS NOT NULL",
    "evars_raw",
)
cte(
    "map_join",
    "SELECT CAST(b.id AS BIGINT) AS code, b.name AS base_name, c.code AS sdr_code, c.name_override AS sdr_name, "
    "coalesce(c.name_override, e.name_override, b.name) AS final_name FROM base_events b "
    "LEFT JOIN custom c ON b.id = c.code LEFT JOIN evars e ON b.id = e.code",
    "base_events", "custom", "evars",
)


def _ranked(custom_base: int, offset: int) -> str:
    return f"""
SELECT code, name, source AS mapping_source FROM (
 SELECT *, row_number() OVER (PARTITION BY code ORDER BY priority, name NULLS LAST) AS rn FROM (
  SELECT CAST(id AS BIGINT) AS code, name, 'base' AS source, 3 AS priority FROM base_events
  UNION ALL SELECT CASE WHEN n BETWEEN 1 AND 100 THEN n + 99 WHEN n > 100 THEN n + {offset} END, 'Instance of ' || Name, 'sdr_evar', 2
   FROM (SELECT TRY_CAST(nullif(regexp_extract(EvarNumber, 'evar([0-9]+)', 1), '') AS BIGINT) AS n, Name FROM evars_raw WHERE Name <> '')
  UNION ALL SELECT {custom_base} + TRY_CAST(nullif(regexp_extract(Event, 'event([0-9]+)', 1), '') AS BIGINT), Name, 'sdr_custom', 1
   FROM custom_raw WHERE Name <> ''
 ) WHERE code IS NOT NULL) WHERE rn = 1"""


cte("ranked_parity", _ranked(200, 9999), "base_events", "custom_raw", "evars_raw")
cte("event_map", _ranked(199, 9899), "base_events", "custom_raw", "evars_raw")

cte("ev", "SELECT rid, e.code AS event_code, e.value AS event_value, pos FROM "
    "(SELECT rid, unnest(evs) AS e, generate_subscripts(evs, 1) - 1 AS pos FROM bronze)", "bronze")
_TYPE = ("CASE WHEN event_code BETWEEN 200 AND 299 THEN 'custom_event' WHEN event_code BETWEEN 1 AND 199 THEN 'standard_event' "
         "WHEN event_code >= 10000 THEN 'evar_instance' ELSE 'unknown' END")
_MEASURED = "coalesce(event_value > 1, false)"
cte("sev_literal", f"SELECT rid, event_code, event_value, 'Event ' || CAST(event_code AS VARCHAR) AS event_name, {_TYPE} AS event_type, "
    f"{_MEASURED} AS is_measurement, row_number() OVER (PARTITION BY rid ORDER BY pos) - 1 AS pos FROM ev WHERE event_code IS NOT NULL", "ev")
cte("sev", f"SELECT rid, event_code, event_value, coalesce(m.name, 'Event ' || CAST(event_code AS VARCHAR)) AS event_name, {_TYPE} AS event_type, "
    f"{_MEASURED} AS is_measurement, row_number() OVER (PARTITION BY rid ORDER BY pos) - 1 AS pos FROM ev LEFT JOIN event_map m ON event_code = m.code "
    "WHERE event_code IS NOT NULL", "ev", "event_map")


def _silver(url_change: bool) -> str:
    change = "OR coalesce(prev_url <> page_url, false)" if url_change else ""
    return f"""
SELECT b.*, (SELECT count(*) FROM ev WHERE ev.rid = b.rid AND event_code IS NOT NULL) AS n_events,
 (SELECT count(*) FROM ev WHERE ev.rid = b.rid AND event_code >= 10000) AS n_evars,
 coalesce(TRY_CAST(post_page_event AS BIGINT) = 0, false) {change} AS is_page_view
FROM (SELECT *, lag(page_url) OVER (PARTITION BY distinct_id ORDER BY ts_utc NULLS FIRST, hitid_high NULLS FIRST, hitid_low NULLS FIRST) AS prev_url FROM bronze) b
WHERE ts_utc IS NOT NULL"""


cte("silver", _silver(True), "bronze", "ev")
cte("silver_flag", _silver(False), "bronze", "ev")

PATTERNS = {
    "page_load_time": ["Page Load Time"], "time_on_page": ["Time on Page"], "scroll_depth": ["Scroll"],
    "form_starts": ["Form Start", "Form Initialize"], "form_completions": ["Form Success", "Form Completion"],
    "video_plays": ["Video"], "downloads": ["Download"], "external_links": ["External"], "custom_link_clicks": ["Link Click"],
}
CODED = {"measurement_209_page_load_time": 209, "measurement_236_page_scroll_75": 236, "measurement_240": 240}


def _measures(sev: str) -> str:
    likes = {k: " OR ".join(f"event_name LIKE '%{p}%'" for p in ps) for k, ps in PATTERNS.items()}
    tests = likes | {k: f"event_code = {c}" for k, c in CODED.items()}
    cols = ", ".join(f"(list(event_value ORDER BY pos) FILTER (WHERE {t}))[1] AS {k}" for k, t in tests.items())
    return f"SELECT rid, {cols} FROM {sev} GROUP BY rid"


def _business(sev: str, ignored: str) -> str:
    return (
        f"SELECT rid, event_name, event_code, event_value, event_type, row_number() OVER (PARTITION BY rid ORDER BY pos) - 1 AS pos FROM {sev} "
        "WHERE event_name <> '' AND NOT event_code BETWEEN 100 AND 199 AND NOT event_code >= 10000 "
        f"AND event_code NOT IN (200, 209, 236, 240) {ignored}"
    )


cte("measures", _measures("sev"), "sev")
cte("measures_literal", _measures("sev_literal"), "sev_literal")
cte("business", _business("sev", ""), "sev")
cte("business_literal", _business("sev_literal", ""), "sev_literal")
cte("business_ignoring", _business("sev", "AND event_code NOT IN (7, 211)"), "sev")
cte("business_none", _business("sev", "AND event_code NOT BETWEEN 1 AND 299"), "sev")

HIT_ORDER = "ts_utc, distinct_id, hitid_high NULLS FIRST, hitid_low NULLS FIRST"
EVAR_NAMES = ("page_name", "current_url", "time_since_last_use", "primary_category", "visitor_id", "form_page_url",
              "visit_duration", "conductor_export_variable", "location")
PROP_NAMES = ("page_name", "current_url", "previous_page", "new_vs_repeat_visitors")


def _gold(silver: str, measures: str, business: str, event_map: str, branches: str = "pbf") -> str:
    shared = [
        "distinct_id", "page_url", "pagename AS page_name", *PATTERNS, *CODED, "distinct_id AS visitor_id", "visit_num",
        "CASE WHEN TRY_CAST(visit_num AS BIGINT) = 1 THEN 'New' ELSE 'Returning' END AS visitor_type",
        "yearly_visitor", "monthly_visitor", "daily_visitor", "hourly_visitor", "browser",
        "coalesce(lb.name, 'Browser ' || browser) AS browser_name", "os", "coalesce(lo.name, 'OS ' || os) AS operating_system_name",
        "user_agent", "c_color AS color_depth", "javascript AS javascript_version", "java_enabled", "connection_type",
        "coalesce(lc.name, 'Connection ' || connection_type) AS connection_type_name", "geo_country",
        "coalesce(ln.name, 'Country ' || geo_country) AS country_name", "geo_region", "geo_city", "post_referrer AS referrer_url",
        "ref_domain", "ref_type", "coalesce(lr.name, 'Referrer Type ' || ref_type) AS referrer_type_name", "va_closer_detail",
        "va_finder_detail",
        *[f"post_evar{n} AS evar_{name}" for n, name in enumerate(EVAR_NAMES, start=1)],
        *[f"prop{n} AS prop_{name}" for n, name in enumerate(PROP_NAMES, start=1)],
        *[f"CAST(NULL AS VARCHAR) AS {n}" for n in ("primary_category_prop", "visitor_id_prop", "form_page_url_prop", "location_prop", "tag_name")],
        "visit_page_num", "ts_utc AS original_timestamp", "original_hit_no",
    ]
    labels = (
        "LEFT JOIN l_browser lb ON TRY_CAST(browser AS BIGINT) = lb.id LEFT JOIN l_operating_systems lo ON TRY_CAST(os AS BIGINT) = lo.id "
        "LEFT JOIN l_connection_type lc ON TRY_CAST(connection_type AS BIGINT) = lc.id LEFT JOIN l_country ln ON TRY_CAST(geo_country AS BIGINT) = ln.id "
        "LEFT JOIN l_referrer_type lr ON TRY_CAST(ref_type AS BIGINT) = lr.id"
    )
    hits = f"(SELECT s.*, row_number() OVER (ORDER BY {HIT_ORDER}) AS original_hit_no FROM {silver} s) h LEFT JOIN {measures} m ON m.rid = h.rid"
    cols = ", ".join(shared)
    stamp = "CAST(epoch_us({t}) AS VARCHAR)"
    nudged = "ts_utc + to_seconds((b.pos + 1) * 5)"
    named = " OR ".join(f"{p} IS NOT NULL" for p in PATTERNS)
    page = f"""SELECT md5(distinct_id || '-Page Viewed-' || {stamp.format(t='ts_utc')}) AS insert_id, ts_utc AS ts, 'Page Viewed' AS event_name,
 CAST(NULL AS BIGINT) AS original_event_code, CAST(NULL AS VARCHAR) AS original_event_name, true AS pv, false AS is_link_tracking,
 coalesce(pagename, page_url) AS page_title, CAST(NULL AS DOUBLE) AS event_value, CAST(0 AS BIGINT) AS event_sequence, 'page_view' AS hit_type, {cols}
 FROM {hits} {labels} WHERE is_page_view"""
    events = f"""SELECT md5(distinct_id || '-' || coalesce(em.name, b.event_name) || '-' || {stamp.format(t=nudged)}), {nudged},
 coalesce(em.name, b.event_name), b.event_code, coalesce(be.name, b.event_name), false, NOT is_page_view, coalesce(pagename, page_url),
 b.event_value, b.pos + 1, CASE WHEN is_page_view THEN 'event_on_page' ELSE 'link_tracking' END, {cols}
 FROM {hits} JOIN {business} b ON b.rid = h.rid LEFT JOIN {event_map} em ON b.event_code = em.code LEFT JOIN base_events be ON b.event_code = be.id {labels}"""
    fallback = f"""SELECT md5(distinct_id || '-Action Tracked-' || {stamp.format(t='ts_utc')}), ts_utc, 'Action Tracked', NULL, NULL, false, true,
 coalesce(pagename, page_url, 'Unknown'), NULL, 999, 'measurement_only', {cols}
 FROM {hits} {labels} WHERE NOT is_page_view AND h.rid NOT IN (SELECT rid FROM {business}) AND ({named})"""
    parts = [text for key, text in (("p", page), ("b", events), ("f", fallback)) if key in branches]
    # The column names come from the page-view branch.
    if "p" not in branches:
        parts.insert(0, page + " AND false")
    return f"SELECT * RENAME (ts AS ts_utc, pv AS is_page_view) FROM ({' UNION ALL '.join(parts)})"


_LABELS = ("l_browser", "l_operating_systems", "l_connection_type", "l_country", "l_referrer_type", "base_events")
cte("gold", _gold("silver", "measures", "business", "event_map"), "silver", "measures", "business", "event_map", *_LABELS)
cte("gold_p", _gold("silver", "measures", "business", "event_map", "p"), "silver", "measures", "business", "event_map", *_LABELS)
cte("gold_b", _gold("silver", "measures", "business", "event_map", "b"), "silver", "measures", "business", "event_map", *_LABELS)
cte("gold_f", _gold("silver_flag", "measures", "business_none", "event_map", "f"), "silver_flag", "measures", "business_none", "event_map", *_LABELS)
cte("gold_literal", _gold("silver", "measures_literal", "business_literal", "ranked_parity"),
    "silver", "measures_literal", "business_literal", "ranked_parity", *_LABELS)

US_GOLD = "SELECT * REPLACE (epoch_us(ts_utc) AS ts_utc, epoch_us(original_timestamp) AS original_timestamp) FROM "
US = "epoch_us(ts_utc) AS ts_utc"
KEYS = f"hitid_high, hitid_low, {US}"


def pct(part: str, whole: str, digits: int) -> str:
    return f"round(CAST({part} AS DOUBLE) / nullif({whole}, 0) * 100, {digits})"


def _quality(digits: int) -> str:
    return with_ctes(
        f"""SELECT *, {pct('malformed_hit_time_gmt', 'total_records', digits)} AS malformed_hit_time_gmt_pct,
 {pct('malformed_hitid_high', 'total_records', digits)} AS malformed_hitid_high_pct, {pct('malformed_hitid_low', 'total_records', digits)} AS malformed_hitid_low_pct,
 {pct('malformed_record_count', 'total_records', digits)} AS malformed_record_pct, total_records - malformed_record_count AS clean_records,
 {pct('(total_records - malformed_record_count)', 'total_records', digits)} AS clean_record_pct
 FROM (SELECT count(*) AS total_records, count(*) FILTER (WHERE {BAD_TIME}) AS malformed_hit_time_gmt, count(*) FILTER (WHERE {BAD_HIGH}) AS malformed_hitid_high,
  count(*) FILTER (WHERE {BAD_LOW}) AS malformed_hitid_low, count(*) FILTER (WHERE {BAD_ANY}) AS malformed_record_count FROM raw)""",
        "raw",
    )


def _issue(col: str, bad: str, what: str) -> str:
    return f"CASE WHEN {col} IS NULL THEN 'NULL_{what}' WHEN {bad} THEN 'bad_{what}_format' ELSE 'good_{what}' END"


ORACLES: dict[str, str] = {}
O = ORACLES

O["raw_quality"] = _quality(3)
O["raw_quality_4dp"] = (
    "SELECT total_records, malformed_hit_time_gmt, malformed_hitid_high, malformed_hitid_low, malformed_record_count AS total_malformed_records, "
    "malformed_hit_time_gmt_pct, malformed_hitid_high_pct, malformed_hitid_low_pct, malformed_record_pct AS total_malformed_pct, "
    f"clean_records AS clean_records_for_bronze FROM ({_quality(4)})"
)
O["malformed_verdict"] = (
    "SELECT malformed_record_pct, CASE WHEN malformed_record_pct > 5 THEN 'high' WHEN malformed_record_pct > 1 THEN 'moderate' "
    f"WHEN malformed_record_pct > 0 THEN 'low' ELSE 'perfect' END AS verdict FROM ({_quality(3)})"
)
_ALL = ", ".join(f"{c} NULLS FIRST" for c in ("hit_time_gmt", "hitid_high", "hitid_low", "accept_language", "pagename", "page_url"))
O["bad_rows"] = with_ctes(
    f"""SELECT hit_time_gmt, hitid_high, hitid_low, length(hit_time_gmt) AS hit_time_length, length(hitid_high) AS hitid_high_length,
 length(hitid_low) AS hitid_low_length, {_issue('hit_time_gmt', BAD_TIME, 'timestamp')} AS timestamp_issue,
 {_issue('hitid_high', BAD_HIGH, 'hitid_high')} AS hitid_high_issue, {_issue('hitid_low', BAD_LOW, 'hitid_low')} AS hitid_low_issue,
 accept_language, pagename, page_url FROM raw WHERE {BAD_ANY}
 ORDER BY CAST({BAD_TIME} AS INT) + CAST({BAD_HIGH} AS INT) + CAST({BAD_LOW} AS INT) DESC, {_ALL} LIMIT 100""",
    "raw",
)
O["field_lengths"] = with_ctes(
    " UNION ALL ".join(
        f"SELECT '{c}_length_distribution' AS analysis_type, length({c}) AS field_length, count(*) AS record_count, "
        f"{pct('count(*)', '(SELECT count(*) FROM raw)', 2)} AS percentage FROM raw WHERE {c} IS NOT NULL GROUP BY 1, 2"
        for c in ("hit_time_gmt", "hitid_high", "hitid_low")
    ),
    "raw",
)
O["row_drift"] = with_ctes(
    "SELECT n AS total_rows, CAST(9000 AS BIGINT) AS expected_rows, round(abs(n - 9000) / 9000 * 100, 1) AS difference_pct, "
    "CASE WHEN abs(n - 9000) / 9000 * 100 > 10 THEN 'warn' ELSE 'ok' END AS verdict FROM (SELECT count(*) AS n FROM bronze)",
    "bronze",
)
_FILLED = "coalesce(accept_language NOT IN ('', ':', '-', '--'), false)"
O["language_drift"] = with_ctes(
    f"""SELECT *, {pct('drifted_rows', 'filled_rows', 4)} AS drifted_pct FROM (SELECT count(*) AS total_rows, count(*) FILTER (WHERE {_FILLED}) AS filled_rows,
 count(*) FILTER (WHERE {_FILLED} AND NOT regexp_matches(accept_language, '^(\\*|[A-Za-z]{{2,8}}(-[A-Za-z0-9]{{1,8}})*)(\\s*;\\s*q=[0-9.]+)?(\\s*,.*)?$')) AS drifted_rows FROM raw)""",
    "raw",
)
O["parse_hit_time"] = with_ctes(f"SELECT hitid_high, hitid_low, epoch_us({TIME}) AS ts_utc FROM raw", "raw")
O["resolve_visitor"] = with_ctes(f"SELECT {VISITOR} AS distinct_id, count(*) AS hits FROM raw GROUP BY 1", "raw")
O["resolve_visitor_reordered"] = with_ctes(
    f"SELECT CASE {_CUST} {_MC} ELSE {_FP} END AS distinct_id, count(*) AS hits FROM raw GROUP BY 1", "raw"
)
O["parse_event_list"] = with_ctes(
    f"""SELECT hitid_high, hitid_low, events_list_clean, pos, e.code AS event_code, e.value AS event_value
 FROM (SELECT hitid_high, hitid_low, {LIST_CLEAN} AS events_list_clean, unnest({EVENTS}) AS e, generate_subscripts({EVENTS}, 1) - 1 AS pos FROM raw)""",
    "raw",
)
O["null_markers"] = with_ctes(f"SELECT {', '.join(f'{clean(c)} AS {c}' for c in [*PASSED, *DROPPED])} FROM raw", "raw")
O["timed_hits"] = with_ctes(f"SELECT hitid_high, hitid_low, hit_time_gmt FROM raw WHERE {TIMED}", "raw")
O["bronze"] = with_ctes(
    "SELECT * EXCLUDE (rid, evs) REPLACE (epoch_us(ts_utc) AS ts_utc), len(evs) AS n_events FROM bronze", "bronze"
)
O["bronze_well_formed"] = with_ctes(
    f"SELECT {clean('hitid_high')} AS hitid_high, {clean('hitid_low')} AS hitid_low, epoch_us({TIME}) AS ts_utc, {VISITOR} AS distinct_id, "
    f"{clean('post_event_list')} AS post_event_list, {clean('mcvisid')} AS mcvisid, {LIST_CLEAN} AS events_list_clean FROM raw WHERE {TIMED} AND NOT {BAD_ANY}",
    "raw",
)


def _basic_clock(c: str) -> str:
    n = f"TRY_CAST({c} AS BIGINT)"
    return (f"WHEN length({c}) = 10 AND {n} IS NOT NULL THEN make_timestamp({n} * 1000000) "
            f"WHEN length({c}) = 13 AND {n} IS NOT NULL THEN make_timestamp({n} * 1000) ")


O["bronze_basic"] = with_ctes(
    f"""SELECT hitid_high, hitid_low, epoch_us(ts_utc) AS ts_utc, distinct_id, events_list_clean, event_list, pos,
 CASE WHEN strpos(item, '=') > 0 THEN substr(item, 1, strpos(item, '=') - 1) ELSE item END AS event_code,
 CASE WHEN strpos(item, '=') > 0 THEN TRY_CAST(substr(item, strpos(item, '=') + 1) AS DOUBLE) END AS event_value
 FROM (SELECT *, unnest(items) AS item, generate_subscripts(items, 1) - 1 AS pos FROM (
  SELECT hitid_high, hitid_low, event_list, CASE {''.join(map(_basic_clock, CLOCKS))} END AS ts_utc, {LIST_CLEAN} AS events_list_clean,
   coalesce(post_visid_high || '-' || post_visid_low, nullif(nullif(nullif(mcvisid, ''), ':'), '-'), nullif(nullif(nullif(post_cust_visid, ''), ':'), '-'),
    'fallback-' || CAST(row_number() OVER (ORDER BY post_cust_hit_time_gmt NULLS FIRST, hitid_high NULLS FIRST, hitid_low NULLS FIRST) AS VARCHAR)) AS distinct_id,
   [i for i in string_split({LIST}, ',') if i <> ''] AS items FROM raw WHERE {TIMED}))""",
    "raw",
)

O["sdr_custom_events"] = with_ctes("SELECT * FROM custom", "custom")
O["sdr_evars"] = with_ctes("SELECT * FROM evars", "evars")
O["event_map_join"] = with_ctes("SELECT code, final_name AS name FROM map_join", "map_join")
O["event_map_ranked"] = with_ctes("SELECT * FROM ranked_parity", "ranked_parity")
_CODES = ", ".join(map(str, TRACE_CODES))
_NUMBERS = ", ".join(map(str, TRACE_NUMBERS))
O["sdr_join_trace"] = with_ctes(f"SELECT * FROM map_join WHERE code IN ({_CODES})", "map_join")
O["mapping_trace"] = with_ctes(
    f"""SELECT 'Raw SDR Data' AS source, Event AS item, CAST(NULL AS BIGINT) AS code, Name AS name, length(Name) AS name_length FROM custom_raw
 WHERE Event IN ({', '.join(f"'event{n}'" for n in TRACE_NUMBERS)})
 UNION ALL SELECT 'Processed SDR Data', CAST(custom_event_number AS VARCHAR), code, name_override, NULL FROM custom WHERE custom_event_number IN ({_NUMBERS})
 UNION ALL SELECT 'Final Event Map', NULL, code, final_name, NULL FROM map_join WHERE code IN ({_CODES})
 UNION ALL SELECT 'Base Events', NULL, id, name, NULL FROM base_events WHERE id IN ({_CODES})""",
    "custom_raw", "custom", "map_join", "base_events",
)
O["mapping_effectiveness"] = with_ctes(
    "SELECT 'Total Events' AS metric, count(*) AS count FROM map_join UNION ALL SELECT 'SDR Custom Event Overrides', count(*) FROM custom "
    "UNION ALL SELECT 'SDR eVar Overrides', count(*) FROM evars",
    "map_join", "custom", "evars",
)


def _aliases(named: str, source: str, have: int, *needs: str, taken: str = "") -> str:
    counts = " ".join(f"WHEN {n} THEN (SELECT count({source}{n}) FROM bronze)" for n in range(1, have + 1))
    return with_ctes(
        f"""SELECT alias || CASE WHEN nth = 1 THEN '' ELSE '_' || CAST(nth AS VARCHAR) END AS alias,
 CASE n {counts} ELSE CAST(0 AS BIGINT) END AS filled
 FROM (SELECT n, alias, row_number() OVER (PARTITION BY alias ORDER BY n) + CAST(alias = '{taken}' AS BIGINT) AS nth FROM ({named}))""",
        "bronze", *needs,
    )


_EVAR_NAMES = (
    "SELECT code - 99 AS n, 'evar_' || regexp_replace(lower(name_override), '[^a-z0-9]', '_', 'g') AS alias FROM evars "
    "WHERE name_override <> '' AND code BETWEEN 100 AND 199"
)
O["evar_aliases"] = _aliases(_EVAR_NAMES, "post_evar", 9, "evars")
O["evar_aliases_taken"] = (
    _aliases(_EVAR_NAMES, "post_evar", 9, "evars", taken="evar_page_name") + " UNION ALL SELECT 'evar_page_name', count(*) FROM bronze"
)
O["prop_aliases"] = _aliases(
    "SELECT CAST(PropertyNumber AS BIGINT) AS n, 'prop_' || regexp_replace(lower(Name), '[^a-z0-9]', '_', 'g') AS alias FROM props_raw WHERE Name <> ''",
    "prop", 4, "props_raw",
)

_SEV = f"SELECT hitid_high, hitid_low, {US}, s.pos, s.event_code, s.event_value, s.event_name, s.event_type, s.is_measurement FROM {{sev}} s JOIN bronze USING (rid)"
O["enhance_events"] = with_ctes(_SEV.format(sev="sev_literal"), "sev_literal", "bronze")
O["enhance_events_named"] = with_ctes(_SEV.format(sev="sev"), "sev", "bronze")
O["evar_instances"] = with_ctes(
    f"SELECT {KEYS}, row_number() OVER (PARTITION BY rid ORDER BY pos) - 1 AS pos, event_code, event_value, event_code - 9999 AS evar_number "
    "FROM ev JOIN bronze USING (rid) WHERE event_code >= 10000",
    "ev", "bronze",
)
O["page_views"] = with_ctes(f"SELECT {KEYS}, distinct_id, prev_url, is_page_view FROM silver", "silver")
O["page_views_flag_only"] = with_ctes("SELECT is_page_view, count(*) AS hits FROM silver_flag GROUP BY 1", "silver_flag")
O["silver"] = with_ctes(
    f"SELECT {KEYS}, distinct_id, prev_url, is_page_view, CASE WHEN n_events > 0 THEN 'has_events' ELSE 'no_events' END AS event_classification, "
    "n_events, n_evars, page_url, post_evar1 AS evar_page_name, post_evar9 AS evar_location, prop1 AS prop_page_name, prop2 AS prop_current_url FROM silver",
    "silver",
)

O["measurements"] = with_ctes(f"SELECT {KEYS}, m.* EXCLUDE (rid) FROM bronze LEFT JOIN measures m USING (rid)", "bronze", "measures")
O["business_events"] = with_ctes(
    f"SELECT {KEYS}, pos, event_name, event_code, event_value, event_type FROM business_ignoring JOIN bronze USING (rid)",
    "business_ignoring", "bronze",
)
O["primary_event"] = with_ctes(
    "SELECT CASE WHEN is_page_view THEN 'Page Viewed' ELSE coalesce(b.event_name, 'Action Tracked') END AS primary_event, count(*) AS hits "
    "FROM silver s LEFT JOIN business b ON b.rid = s.rid AND b.pos = 0 GROUP BY 1",
    "silver", "business",
)
O["hit_numbers"] = with_ctes(
    f"SELECT {KEYS}, distinct_id, row_number() OVER (ORDER BY {HIT_ORDER.replace('ts_utc', 'bronze.ts_utc')}) AS original_hit_no FROM bronze WHERE bronze.ts_utc IS NOT NULL", "bronze"
)
O["hit_ids"] = with_ctes(
    f"""SELECT {KEYS}, distinct_id, distinct_id || '-' || CAST(epoch_us(bronze.ts_utc) // 1000000 AS VARCHAR) || '-' ||
 CAST(row_number() OVER (PARTITION BY distinct_id, bronze.ts_utc ORDER BY hitid_high NULLS FIRST, hitid_low NULLS FIRST) AS VARCHAR) AS hit_id
 FROM bronze WHERE bronze.ts_utc IS NOT NULL""",
    "bronze",
)
O["lookup_labels"] = with_ctes(
    """SELECT hitid_high, hitid_low, browser, os, connection_type, geo_country, ref_type, coalesce(lb.name, 'Browser ' || browser) AS browser_name,
 coalesce(lo.name, 'OS ' || os) AS operating_system_name, coalesce(lc.name, 'Connection ' || connection_type) AS connection_type_name,
 coalesce(ln.name, 'Country ' || geo_country) AS country_name, coalesce(lr.name, 'Referrer Type ' || ref_type) AS referrer_type_name FROM bronze
 LEFT JOIN l_browser lb ON TRY_CAST(browser AS BIGINT) = lb.id LEFT JOIN l_operating_systems lo ON TRY_CAST(os AS BIGINT) = lo.id
 LEFT JOIN l_connection_type lc ON TRY_CAST(connection_type AS BIGINT) = lc.id LEFT JOIN l_country ln ON TRY_CAST(geo_country AS BIGINT) = ln.id
 LEFT JOIN l_referrer_type lr ON TRY_CAST(ref_type AS BIGINT) = lr.id""",
    "bronze", *_LABELS[:5],
)
O["reduced_lookup"] = with_ctes(
    "SELECT CAST(id AS BIGINT) AS id, name FROM l_browser WHERE id IN (SELECT TRY_CAST(browser AS BIGINT) FROM bronze)", "l_browser", "bronze"
)
O["gold_page_views"] = with_ctes(US_GOLD + "gold_p", "gold_p")
O["gold_business"] = with_ctes(US_GOLD + "gold_b", "gold_b")
O["gold_fallback"] = with_ctes(US_GOLD + "gold_f", "gold_f")
O["gold"] = with_ctes(US_GOLD + "gold", "gold")
O["gold_literal_names"] = with_ctes(US_GOLD + "gold_literal", "gold_literal")
O["deduped_events"] = with_ctes(
    f"SELECT insert_id, {US}, event_name, original_hit_no, event_sequence FROM gold "
    "QUALIFY row_number() OVER (PARTITION BY insert_id ORDER BY original_hit_no, event_sequence) = 1", "gold"
)
# Without the last two sources some hits have no visitor, and their events no id.
_STRICT = VISITOR.replace(f" {_CUST} ELSE {_FP} END", " END")
O["deduped_no_fallback"] = (
    O["deduped_events"].replace(VISITOR, _STRICT).replace("QUALIFY row_number()", "QUALIFY insert_id IS NULL OR row_number()")
)
O["hit_numbers_cut"], O["page_views_cut"] = O["hit_numbers"], O["page_views"]
O["bronze_basic_cut"], O["gold_joined_names"] = O["bronze_basic"], O["gold"]
O["hit_ids_cut"] = O["hit_ids"].replace(
    "FROM bronze WHERE", "FROM (SELECT * REPLACE (CAST(date_trunc('day', ts_utc) AS TIMESTAMP) AS ts_utc) FROM bronze) AS bronze WHERE"
)
O["export_rows"] = with_ctes(
    f"SELECT {US}, distinct_id, is_page_view, page_url, geo_country, country_name, browser_name, operating_system_name, user_agent FROM gold", "gold"
)
O["date_range"] = with_ctes(
    f"SELECT insert_id, {US}, event_name FROM gold WHERE CAST(gold.ts_utc AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-12'", "gold"
)

O["bronze_metrics"] = with_ctes(
    "SELECT count(*) AS total_rows, count(DISTINCT distinct_id) AS unique_visitors, count(ts_utc) AS valid_timestamps, count(evs) AS rows_with_events, "
    "CAST(sum(len(evs)) AS BIGINT) AS total_events FROM bronze", "bronze"
)
O["bronze_checks"] = with_ctes(
    f"""SELECT total_rows, {pct('no_time', 'total_rows', 6)} AS pct_null_timestamp, {pct('no_visitor', 'total_rows', 6)} AS pct_empty_visitor_id, duplicate_hit_count,
 CASE WHEN no_time * 100.0 / total_rows > 10 THEN 'warn' ELSE 'ok' END AS timestamp_verdict,
 CASE WHEN no_visitor * 100.0 / total_rows > 5 THEN 'warn' ELSE 'ok' END AS visitor_verdict,
 CASE WHEN duplicate_hit_count > 0 THEN 'warn' ELSE 'ok' END AS duplicate_verdict
 FROM (SELECT count(*) AS total_rows, count(*) FILTER (WHERE ts_utc IS NULL) AS no_time, count(*) FILTER (WHERE coalesce(distinct_id, '') = '') AS no_visitor,
  count(hitid_high || '-' || hitid_low) - count(DISTINCT hitid_high || '-' || hitid_low) AS duplicate_hit_count FROM bronze)""",
    "bronze",
)
O["silver_metrics"] = with_ctes(
    "SELECT count(*) AS total_rows, count(DISTINCT distinct_id) AS unique_visitors, count(*) FILTER (WHERE is_page_view) AS page_views, "
    "count(*) FILTER (WHERE NOT is_page_view) AS link_tracking_hits, CAST(sum(n_events) AS BIGINT) AS total_events, "
    "count(DISTINCT CAST(ts_utc AS DATE)) AS unique_days FROM silver", "silver"
)
O["silver_checks"] = with_ctes(
    f"""SELECT unknown_event_count, total_event_count, {pct('unknown_event_count', 'total_event_count', 6)} AS pct_unknown_events, page_views, non_page_views, total_hits,
 {pct('page_views', 'total_hits', 6)} AS pct_page_views, CASE WHEN unknown_event_count * 100.0 / total_event_count > 10 THEN 'warn' ELSE 'ok' END AS mapping_verdict,
 CASE WHEN page_views * 100.0 / total_hits < 10 THEN 'low' WHEN page_views * 100.0 / total_hits > 90 THEN 'high' ELSE 'ok' END AS page_view_verdict
 FROM (SELECT count(*) AS unknown_event_count FROM ev JOIN silver USING (rid) LEFT JOIN ranked_parity m ON ev.event_code = m.code WHERE event_code IS NOT NULL AND m.name IS NULL),
 (SELECT CAST(sum(n_events) AS BIGINT) AS total_event_count, count(*) FILTER (WHERE is_page_view) AS page_views, count(*) FILTER (WHERE NOT is_page_view) AS non_page_views,
  count(*) AS total_hits FROM silver)""",
    "silver", "ev", "ranked_parity",
)
O["unknown_events"] = with_ctes(
    "SELECT event_code, count(*) AS instances FROM ev LEFT JOIN event_map m ON event_code = m.code WHERE event_code IS NOT NULL AND m.name IS NULL GROUP BY 1",
    "ev", "event_map",
)
_DAY = "CAST(ts_utc AS DATE)"
_PV = "event_name = 'Page Viewed'"
O["gold_metrics"] = with_ctes(
    f"""SELECT count(*) AS total_events, count(DISTINCT distinct_id) AS unique_visitors, count(DISTINCT insert_id) AS unique_events,
 count(*) FILTER (WHERE {_PV}) AS page_view_events, count(*) FILTER (WHERE is_link_tracking) AS link_tracking_events,
 count(DISTINCT event_name) AS unique_event_types, count(DISTINCT {_DAY}) AS date_range_days,
 round(avg(TRY_CAST(visit_page_num AS DOUBLE)), 2) AS avg_pages_per_visit, round(avg(CAST(event_sequence AS DOUBLE)), 2) AS avg_events_per_hit FROM gold""",
    "gold",
)
O["gold_checks"] = with_ctes(
    f"""SELECT *, round(total_events / silver_rows, 2) AS expansion_ratio,
 CASE WHEN total_events / silver_rows < 1 THEN 'loss' WHEN total_events / silver_rows > 10 THEN 'excess' ELSE 'ok' END AS expansion_verdict,
 CASE WHEN unique_visitors <> silver_visitors THEN 'warn' ELSE 'ok' END AS visitor_verdict, CASE WHEN page_views = 0 THEN 'warn' ELSE 'ok' END AS page_view_verdict,
 CASE WHEN unique_event_types < 2 THEN 'warn' ELSE 'ok' END AS event_type_verdict
 FROM (SELECT count(*) AS total_events, count(*) FILTER (WHERE {_PV}) AS page_views, count(*) FILTER (WHERE NOT {_PV}) AS business_events,
  count(DISTINCT event_name) AS unique_event_types, count(DISTINCT distinct_id) AS unique_visitors FROM gold),
 (SELECT count(*) AS silver_rows, count(DISTINCT distinct_id) AS silver_visitors FROM silver)""",
    "gold", "silver",
)
O["event_breakdown"] = with_ctes(
    f"SELECT count(*) FILTER (WHERE {_PV}) AS page_views, count(*) FILTER (WHERE NOT {_PV}) AS business_events, count(DISTINCT event_name) AS unique_event_types FROM gold",
    "gold",
)
cte(
    "summary",
    f"""SELECT CAST(0 AS BIGINT) AS layer_no, 'Raw' AS layer, count(*) AS total_rows, count(DISTINCT post_visid_high || '-' || post_visid_low) AS unique_visitors,
 CAST(0 AS BIGINT) AS date_range_days, CAST(NULL AS BIGINT) AS earliest_timestamp, CAST(NULL AS BIGINT) AS latest_timestamp FROM raw"""
    + "".join(
        f" UNION ALL SELECT {n}, '{t.title()}', count(*), count(DISTINCT distinct_id), count(DISTINCT {_DAY}), epoch_us(min(ts_utc)), epoch_us(max(ts_utc)) FROM {t} WHERE ts_utc IS NOT NULL"
        for n, t in enumerate(("bronze", "silver", "gold"), start=1)
    ),
    "raw", "bronze", "silver", "gold",
)
O["layer_summary"] = with_ctes("SELECT * FROM summary", "summary")
O["layer_ratios"] = with_ctes(
    """SELECT layer_no, layer, round(r, 2) AS row_ratio, CASE WHEN r > 1.1 THEN 'expansion' WHEN r < 0.9 THEN 'reduction' WHEN r IS NOT NULL THEN 'similar' END AS row_trend,
 round(v, 3) AS visitor_ratio, CASE WHEN v = 1 THEN 'preserved' WHEN v IS NOT NULL THEN 'changed' END AS visitor_trend
 FROM (SELECT layer_no, layer, total_rows / lag(total_rows) OVER (ORDER BY layer_no) AS r, unique_visitors / lag(unique_visitors) OVER (ORDER BY layer_no) AS v FROM summary)""",
    "summary",
)
O["layer_counts"] = with_ctes(
    "SELECT 'Raw' AS layer, count(*) AS row_count, count(DISTINCT post_visid_high || '-' || post_visid_low) AS unique_visitors FROM raw WHERE post_cust_hit_time_gmt IS NOT NULL"
    + "".join(f" UNION ALL SELECT '{t.title()}', count(*), count(DISTINCT distinct_id) FROM {t}" for t in ("bronze", "silver", "gold")),
    "raw", "bronze", "silver", "gold",
)


def _pass(name: str, good: str, total: str) -> str:
    return (f"SELECT '{name}' AS check_name, count(*) FILTER (WHERE {good}) AS pass_count, count(*) FILTER (WHERE {total}) AS total_count, "
            f"{pct(f'count(*) FILTER (WHERE {good})', f'count(*) FILTER (WHERE {total})', 2)} AS pass_percentage FROM gold")


O["quality_passes"] = with_ctes(
    " UNION ALL ".join((
        _pass("Valid Timestamps", "ts_utc IS NOT NULL", "true"),
        _pass("Valid Distinct IDs", "distinct_id IS NOT NULL AND distinct_id <> ''", "true"),
        _pass("Page Views Properly Flagged", f"is_page_view AND {_PV}", _PV),
    )),
    "gold",
)
O["null_rates"] = with_ctes(
    f"SELECT *, {pct('null_timestamps', 'total_rows', 2)} AS pct_null_timestamps, {pct('null_events', 'total_rows', 2)} AS pct_null_events FROM ("
    + " UNION ALL ".join(
        f"SELECT '{t.title()}' AS layer, count(*) AS total_rows, count(DISTINCT distinct_id) AS unique_visitors, "
        f"count(*) FILTER (WHERE ts_utc IS NULL) AS null_timestamps, count(*) FILTER (WHERE {empty}) AS null_events FROM {t}"
        for t, empty in (("bronze", "coalesce(events_list_clean, '') = ''"), ("silver", "n_events = 0"), ("gold", "coalesce(event_name, '') = ''"))
    )
    + ")",
    "bronze", "silver", "gold",
)
O["eventification_check"] = with_ctes(
    f"""SELECT CAST(s.d AS VARCHAR) AS date_utc, silver_hits, gold_events, unique_hits, page_views, business_events, round(gold_events / silver_hits, 2) AS expansion_ratio,
 CASE WHEN unique_hits = silver_hits THEN '✓ Hit preservation' ELSE '✗ Hit count mismatch' END AS hit_validation,
 CASE WHEN silver_visitors = gold_visitors THEN '✓ Visitor preservation' ELSE '✗ Visitor count mismatch' END AS visitor_validation
 FROM (SELECT {_DAY} AS d, count(*) AS silver_hits, count(DISTINCT distinct_id) AS silver_visitors FROM silver GROUP BY 1) s
 JOIN (SELECT {_DAY} AS d, count(*) AS gold_events, count(DISTINCT distinct_id) AS gold_visitors, count(DISTINCT original_hit_no) AS unique_hits,
  count(DISTINCT CASE WHEN {_PV} THEN original_hit_no END) AS page_views, count(*) FILTER (WHERE NOT {_PV}) AS business_events FROM gold GROUP BY 1) g ON s.d = g.d
 ORDER BY s.d DESC LIMIT 10""",
    "silver", "gold",
)
_TABLES = {
    "raw": ("raw", "Raw Data"), "lookup_events": ("base_events", "Events"), "sdr_custom_events_raw": ("custom_raw", "SDR Raw"),
    "sdr_evars_raw": ("evars_raw", "SDR Raw"), "sdr_props_raw": ("props_raw", "SDR Raw"), "sdr_custom_events": ("custom", "SDR Processed"),
    "sdr_evars": ("evars", "SDR Processed"), "event_map": ("event_map", "SDR Processed"),
    **{f"lookup_{n}": (f"l_{n}", "Lookup") for n in I.LOOKUPS},
}
_ROWS = " UNION ALL ".join(
    f"SELECT '{kind}' AS category, '{name}' AS table_name, count(*) AS row_count FROM {source}" for name, (source, kind) in _TABLES.items()
)
_SOURCES = tuple(source for source, _ in _TABLES.values())
O["row_counts"] = with_ctes(_ROWS, *_SOURCES)
O["load_summary"] = with_ctes(
    f"SELECT category, count(*) AS tables, CAST(sum(row_count) AS BIGINT) AS total_rows FROM ({_ROWS}) GROUP BY 1", *_SOURCES
)


def _has(layer: str, *codes: int) -> str:
    return f"count(*) FILTER (WHERE rid IN (SELECT rid FROM ev WHERE event_code IN ({', '.join(map(str, codes))})))"


O["event_trace_layers"] = with_ctes(
    " UNION ALL ".join(
        f"SELECT '{t.title()} Layer' AS layer, count(*) AS total_hits, {_has(t, TRACE_RAW)} AS hits_with_{TRACE_RAW}, {_has(t, TRACE_MAPPED)} AS hits_with_{TRACE_MAPPED} FROM {t}"
        for t in ("bronze", "silver")
    ),
    "ev", "bronze", "silver",
)
_RANGE = f"event_code BETWEEN {TRACE_LOW} AND {TRACE_HIGH}"
O["event_trace_bronze"] = with_ctes(
    f"""SELECT 'Bronze Layer' AS layer, count(*) AS total_hits, count(*) FILTER (WHERE events_list_clean LIKE '%{TRACE_RAW}%') AS hits_with_raw_code,
 {_has('bronze', TRACE_RAW)} AS hits_with_parsed_code FROM bronze
 UNION ALL SELECT 'Bronze Event Distribution', NULL, count(*) FILTER (WHERE event_code = {TRACE_RAW}), count(DISTINCT event_code) FROM ev WHERE {_RANGE}""",
    "ev", "bronze",
)
O["event_trace_codes"] = with_ctes(
    f"""SELECT 'Bronze Layer' AS layer, count(*) AS total_hits, {_has('bronze', TRACE_MAPPED, TRACE_RAW)} AS hits_with_codes FROM bronze
 UNION ALL SELECT 'Bronze Event Codes', NULL, count(DISTINCT event_code) FROM ev WHERE {_RANGE}
 UNION ALL SELECT 'Bronze Sample', count(*), NULL FROM (SELECT 1 FROM ev WHERE {_RANGE} LIMIT 10)""",
    "ev", "bronze",
)
O["event_trace_explosion"] = with_ctes(
    f"""SELECT 'Raw Layer' AS layer, count(*) AS total_hits, count(*) FILTER (WHERE post_event_list LIKE '%{TRACE_RAW},%' OR post_event_list LIKE '%,{TRACE_RAW}'
  OR post_event_list = '{TRACE_RAW}') AS hits_with_event, CAST(NULL AS BIGINT) AS total_instances FROM raw
 UNION ALL SELECT 'Silver Layer', count(*), {_has('silver', TRACE_MAPPED)}, (SELECT count(*) FROM ev JOIN silver USING (rid) WHERE event_code = {TRACE_MAPPED}) FROM silver
 UNION ALL SELECT 'Gold Layer', NULL, count(DISTINCT original_hit_no), count(*) FILTER (WHERE event_name = '{TRACE_EVENT}') FROM gold
 UNION ALL SELECT 'Sample Check', NULL, NULL, NULL
 UNION ALL SELECT 'Sample Raw', NULL, NULL, count(*) FROM (SELECT 1 FROM raw WHERE post_event_list LIKE '%{TRACE_RAW}%' LIMIT 3)""",
    "raw", "ev", "silver", "gold",
)
O["event_trace_short"] = with_ctes(
    f"""SELECT 'Raw Layer' AS layer, count(*) AS total_hits, count(*) FILTER (WHERE post_event_list LIKE '%{TRACE_RAW}%') AS hits_with_event FROM raw
 UNION ALL SELECT 'Silver Layer', count(*), {_has('silver', TRACE_MAPPED)} FROM silver
 UNION ALL SELECT 'Gold Layer', count(DISTINCT original_hit_no), count(*) FILTER (WHERE event_name = '{TRACE_EVENT}') FROM gold""",
    "raw", "ev", "silver", "gold",
)
O["hits_with_code"] = with_ctes(
    f"SELECT {KEYS}, distinct_id FROM bronze WHERE rid IN (SELECT rid FROM ev WHERE event_code = {TRACE_RAW})", "bronze", "ev"
)

_MONTH = "CAST(CAST(date_trunc('month', ts_utc) AS DATE) AS VARCHAR)"
O["monthly_visitors"] = with_ctes(f"SELECT {_MONTH} AS month_utc, count(DISTINCT distinct_id) AS unique_visitors FROM gold GROUP BY 1", "gold")
_VIEWS = f"SELECT {_MONTH} AS month_utc, country_name, count(*) FILTER (WHERE is_page_view) AS page_views FROM gold GROUP BY 1, 2"
O["monthly_views_country"] = with_ctes(_VIEWS, "gold")
O["top5_countries"] = with_ctes(
    f"SELECT * FROM ({_VIEWS}) QUALIFY row_number() OVER (PARTITION BY month_utc ORDER BY page_views DESC, country_name NULLS FIRST) <= 5", "gold"
)
O["event_frequency"] = with_ctes(
    "SELECT event_name, count(*) AS event_count, count(DISTINCT distinct_id) AS unique_users, round(count(*) * 100.0 / sum(count(*)) OVER (), 2) AS percentage "
    f"FROM gold WHERE NOT {_PV} GROUP BY 1 ORDER BY event_count DESC, event_name LIMIT 20", "gold"
)
O["user_journey"] = with_ctes(
    f"""SELECT distinct_id, count(DISTINCT {_DAY}) AS active_days, count(*) FILTER (WHERE is_page_view) AS page_views, count(*) FILTER (WHERE NOT is_page_view) AS interactions,
 count(DISTINCT event_name) AS unique_event_types, epoch_us(min(ts_utc)) AS first_seen, epoch_us(max(ts_utc)) AS last_seen FROM gold GROUP BY 1
 HAVING count(*) FILTER (WHERE is_page_view) > 0 ORDER BY active_days DESC, page_views DESC, distinct_id LIMIT 100""",
    "gold",
)
O["top_events"] = with_ctes("SELECT event_name, count(*) AS event_count FROM gold GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10", "gold")

# -- feed repair -------------------------------------------------------------------

W, A = I.LINE_WIDTH, I.LINE_ANCHOR
TAB = "chr(9)"
cte("one", f"SELECT event_id, value AS record, string_split(value, {TAB}) AS f FROM ({I.duck_sql(I.RECORDS, **I.ONE_LINE)})")
cte(
    "lines",
    "SELECT 'feed-' || CAST(event_id % 8 AS VARCHAR) || '.tsv' AS path, event_id * 100 + pos AS row, value, len(string_split(value, chr(9))) - 1 AS tabs "
    "FROM (SELECT event_id, unnest(string_split(value, chr(10))) AS value, generate_subscripts(string_split(value, chr(10)), 1) - 1 AS pos "
    f"FROM ({I.duck_sql(I.RECORDS, **I.DUCK_BREAK)}))",
)


def _is_anchor(at: str) -> str:
    parts = (("", "10"), (" + 1", "10,20"), (" + 2", "10,20"))
    return " AND ".join(f"coalesce(regexp_matches(f[{at}{plus}], '^[0-9]{{{n}}}$'), false)" for plus, n in parts)


cte(
    "anchors",
    f"SELECT path, row, tabs, unnest([i - 1 for i in range(1, len(f) - 1) if {_is_anchor('i')}]) AS anchor "
    "FROM (SELECT *, string_split(value, chr(9)) AS f FROM lines)", "lines",
)
cte(
    "histogram",
    """SELECT path, delta, count(*) AS records FROM (
 SELECT path, spot - lag(spot) OVER (PARTITION BY path ORDER BY spot) AS delta FROM (
  SELECT a.path, l.before + a.anchor AS spot FROM anchors a JOIN
   (SELECT path, row, sum(tabs) OVER (PARTITION BY path ORDER BY row) - tabs AS before FROM lines) l ON a.path = l.path AND a.row = l.row))
 WHERE delta IS NOT NULL GROUP BY 1, 2""",
    "anchors", "lines",
)
O["read_hits"] = with_ctes(
    f"SELECT {', '.join(f'f[{n + 1}] AS field_{n}' for n in range(W + 1))} FROM one WHERE len(f) <= {W + 1}", "one"
)
O["feed_line_counts"] = with_ctes(
    f"SELECT count(*) FILTER (WHERE len(f) <= {W + 1}) AS kept, count(*) FILTER (WHERE len(f) < {W + 1}) AS padded, "
    f"count(*) FILTER (WHERE len(f) > {W + 1}) AS rejected FROM one", "one"
)
O["lookup_rows"] = (
    "SELECT TRY_CAST(f[1] AS BIGINT) AS id, f[2] AS name FROM (SELECT string_split(value, chr(9)) AS f "
    f"FROM ({I.duck_sql(I.LOOKUP_LINES)}))"
)
O["sdr_rows"] = (
    'SELECT CAST(p_partkey AS VARCHAR) AS "EvarNumber", p_name AS "Name" FROM part UNION ALL SELECT n_name, NULL FROM nation'
)
O["sanitize_columns"] = "SELECT event_id, user_id AS f_2nd_id, event_type AS \"user\", value AS user_2, props AS value, epoch_us(ts) // 1000000 AS col, user_id AS col_2 FROM events"
O["find_anchors"] = with_ctes("SELECT * FROM anchors", "anchors")
O["tab_histogram"] = with_ctes("SELECT path, CAST(delta AS BIGINT) AS delta, records FROM histogram", "histogram")
O["canonical_tabs"] = with_ctes(
    "SELECT path, CAST(delta AS BIGINT) AS width FROM histogram QUALIFY row_number() OVER (PARTITION BY path ORDER BY records DESC, delta DESC) = 1",
    "histogram",
)


def _verdict(tabs: str, width: str, found: str) -> str:
    return (f"CASE WHEN {tabs} = {width} THEN 'exact' WHEN {tabs} < {width} AND {width} - {tabs} <= 3 THEN 'pad' "
            f"WHEN {tabs} > {width} AND {tabs} - {width} <= 3 THEN 'trim' WHEN {tabs} < 10 OR {tabs} < floor({width} * 0.6) THEN 'fragment' "
            f"WHEN {found} IS NOT NULL THEN 'realigned' ELSE 'reject' END")


cte(
    "judged",
    f"SELECT *, {_verdict('tabs', str(W), 'shift')} AS verdict FROM (SELECT *, len(f) - 1 AS tabs, "
    f"[o for o in range(-{min(5, A)}, 6) if {_is_anchor(f'o + {A} + 1')}][1] AS shift FROM one)", "one",
)
_EMPTY = "list_transform(range({n}), lambda x: '')"
_FITTED = f"list_concat({{f}}, {_EMPTY.format(n=W + 1)})[1:{W + 1}]"
_RIGHT = _FITTED.format(f="f[shift + 1:]")
_LEFT = f"list_concat({_EMPTY.format(n='-shift')}, f)[1:{W + 1}]"
O["record_verdicts"] = with_ctes("SELECT verdict, count(*) AS records FROM judged GROUP BY 1", "judged")
O["repaired_records"] = with_ctes(
    f"""SELECT event_id, verdict, CASE verdict WHEN 'exact' THEN record WHEN 'pad' THEN record || repeat(chr(9), {W} - tabs)
 WHEN 'trim' THEN array_to_string(f[1:{W + 1}], chr(9))
 WHEN 'realigned' THEN array_to_string(CASE WHEN shift > 0 THEN {_RIGHT} WHEN shift < 0 THEN {_LEFT} ELSE f[1:{W + 1}] END, chr(9)) END AS fixed FROM judged""",
    "judged",
)

# The sequential fold over lines, as a recursion that advances all files at once.


def _fold(lines: str = CTES["lines"][0], max_chars: int = 64 * 1024 * 1024) -> str:
    return f"""
WITH RECURSIVE lines AS MATERIALIZED ({lines}), anchors AS MATERIALIZED ({CTES['anchors'][0]}), histogram AS MATERIALIZED ({CTES['histogram'][0]}),
widths AS MATERIALIZED (SELECT path, CAST(delta AS BIGINT) AS width FROM histogram QUALIFY row_number() OVER (PARTITION BY path ORDER BY records DESC, delta DESC) = 1),
n AS MATERIALIZED (SELECT l.*, width, row_number() OVER (PARTITION BY l.path ORDER BY row) AS i FROM lines l JOIN widths USING (path) WHERE value <> ''),
fold AS (
 SELECT path, CAST(0 AS BIGINT) AS i, CAST(NULL AS BIGINT) AS first, '' AS cur, CAST(0 AS BIGINT) AS curtabs, true AS done, CAST(0 AS BIGINT) AS width FROM widths
 UNION ALL
 SELECT n.path, n.i, CASE WHEN done THEN n.row ELSE first END, CASE WHEN done THEN n.value ELSE cur || '\\n' || n.value END,
  CASE WHEN done THEN n.tabs ELSE curtabs + n.tabs END, (CASE WHEN done THEN n.tabs ELSE curtabs + n.tabs END) >= n.width
   OR length(CASE WHEN done THEN n.value ELSE cur || '\\n' || n.value END) > {max_chars}, n.width
 FROM fold JOIN n ON n.path = fold.path AND n.i = fold.i + 1),
records AS MATERIALIZED (SELECT path, first AS record_row, cur AS record, curtabs AS tabs, curtabs > 8 * width OR length(cur) > {max_chars} AS oversize, width FROM fold
 WHERE i > 0 AND (done OR i = (SELECT max(i) FROM n WHERE n.path = fold.path)))
"""


_FOLD = _fold()
O["assemble_records"] = _FOLD + "SELECT path, record_row, record, tabs, oversize FROM records"
O["assemble_records_limited"] = _fold(max_chars=I.SMALL_RECORD) + "SELECT path, record_row, record, tabs, oversize FROM records"
_JUDGED = f"""SELECT path, CASE WHEN oversize THEN 'oversize' ELSE {_verdict('tabs', 'width', 'shift')} END AS verdict FROM (
 SELECT *, [o for o in range(-{min(5, A)}, 6) if {_is_anchor(f'o + {A} + 1')}][1] AS shift FROM (SELECT *, string_split(record, chr(9)) AS f FROM records))"""
_STATS = """SELECT path, count(*) FILTER (WHERE verdict <> 'oversize') AS records,
 count(*) FILTER (WHERE verdict NOT IN ('fragment', 'reject', 'oversize', 'no_width')) AS ok,
 count(*) FILTER (WHERE verdict IN ('fragment', 'reject', 'oversize', 'no_width')) AS bad,
 count(*) FILTER (WHERE verdict = 'realigned') AS realigned FROM verdicts GROUP BY ROLLUP (path)"""
O["repair_stats"] = f"{_FOLD}, verdicts AS ({_JUDGED}) {_STATS}"
_SPOILT = f"""SELECT path, row, CASE WHEN path = 'feed-6.tsv' OR (path = 'feed-7.tsv' AND row // 100 <> 7)
 THEN regexp_replace(value, '[0-9]', 'x', 'g') ELSE value END AS value, tabs FROM ({CTES['lines'][0]})"""
O["repair_unsized"] = f"""{_fold(_SPOILT)}, verdicts AS ({_JUDGED}
 UNION ALL SELECT path, 'no_width' FROM lines WHERE value <> '' AND path NOT IN (SELECT path FROM widths WHERE width > 0)) {_STATS}"""
