"""Edge cases of one hit: clocks, identities, event lists, page views."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from hitloom.operators import bronze as B
from hitloom.operators import event_map as M
from hitloom.operators import gold as G
from hitloom.operators import lookups as K
from hitloom.operators import silver as S

COLUMNS = (
    "post_cust_hit_time_gmt cust_hit_time_gmt hit_time_gmt date_time post_visid_high post_visid_low mcvisid "
    "post_cust_visid ip user_agent accept_language post_event_list event_list hitid_high hitid_low"
).split()


def hits(spark, *rows):
    filled = [tuple(row.get(c) for c in COLUMNS) for row in rows]
    return spark.createDataFrame(filled, ", ".join(f"{c} string" for c in COLUMNS))


def test_clock_precedence(spark):
    at = lambda s, ms=0: dt.datetime(2023, 11, 14, 22, 13, 20 + s, ms * 1000)
    cases = [
        ({"post_cust_hit_time_gmt": "1700000000001", "hit_time_gmt": "1700000009"}, at(0, 1)),
        ({"post_cust_hit_time_gmt": "170000000000", "cust_hit_time_gmt": "1700000001"}, at(1)),
        ({"post_cust_hit_time_gmt": "", "hit_time_gmt": "1700000002"}, at(2)),
        ({"hit_time_gmt": "1700000002\n", "date_time": "2023-11-14 22:13:23"}, at(3)),
        ({"hit_time_gmt": "x", "date_time": "2023-13-40 00:00:00"}, None),
    ]
    got = B.parse_hit_time(hits(spark, *[c for c, _ in cases])).select("ts_utc").collect()
    assert [r.ts_utc for r in got] == [want for _, want in cases]


def test_hits_without_any_clock_are_dropped(spark):
    df = hits(spark, {}, {"hit_time_gmt": ""}, {"date_time": "2023-11-14 22:13:23"})
    assert B.to_bronze(df).count() == 1


def test_identity(spark):
    rows = [
        {"post_visid_high": "-", "post_visid_low": "2", "mcvisid": "m"},
        {"post_visid_high": "1", "post_visid_low": "", "mcvisid": "m"},
        {"mcvisid": "--", "post_cust_visid": "c"},
        {"post_cust_visid": ":", "ip": None, "user_agent": "", "accept_language": "en"},
        {"ip": "", "user_agent": None, "accept_language": "en"},
        {"ip": "--", "accept_language": "en"},
    ]
    got = [r.distinct_id for r in B.resolve_visitor(hits(spark, *rows)).collect()]
    assert got[:3] == ["--2", "m", "cust:c"]
    assert got[3] == got[4] != got[5] and got[3].startswith("fp:") and len(got[3]) == 35


def test_event_list(spark):
    df = hits(
        spark,
        {"post_event_list": " 1, 200 = 3.5,,x9,10005,7=-.5,8=abc,99999999999999999999=1"},
        {"post_event_list": " \t", "event_list": "5=2"},
        {},
    )
    got = [[tuple(e) for e in r.events_array] for r in B.parse_event_list(df).collect()]
    assert got[0] == [(1, None), (200, 3.5), (10005, None), (7, -0.5), (8, None), (None, 1.0)]
    assert got[1:] == [[(5, 2.0)], []]


def test_cleaning_reads_raw_columns(spark):
    row = B.to_bronze(hits(spark, {"hit_time_gmt": "1", "ip": "--", "event_list": ":", "post_event_list": "--"})).first()
    assert row.ip is None and row.events_list_clean is None
    assert row.distinct_id == B.resolve_visitor(hits(spark, {"ip": "--"})).first().distinct_id


def test_wide_feed_is_cleaned_in_one_projection(spark):
    wide = spark.range(1).select(*[F.lit("--").alias(f"c{n}") for n in range(1189)])
    cleaned = B.clean_null_markers(wide)
    assert len(cleaned.columns) == 1189
    assert all(v is None for v in cleaned.first())


def _events(spark, rows):
    schema = "hit int, events_array array<struct<event_code:bigint,event_value:double>>"
    return spark.createDataFrame(rows, schema)


def test_names_by_join_equal_names_in_memory(spark):
    df = _events(spark, [(1, [(1, None), (7, 2.0), (None, 1.0), (1, 9.0)]), (2, []), (3, [(205, 1.0)])])
    names = spark.createDataFrame([(1, "One"), (7, None), (205, "It's \"x\" \\ {y}"), (999, "never")], "code long, name string")
    as_rows = lambda d: [(r.hit, [tuple(e) for e in r.events_enhanced]) for r in d.orderBy("hit").collect()]
    fast = S.enhance_events(df, "event_map", names)
    wide = S.enhance_events(df, "event_map", names, lookup="join")
    assert as_rows(fast) == as_rows(wide)
    assert fast.dtypes == wide.dtypes
    assert as_rows(fast)[0][1] == [
        (1, None, "One", "standard_event", False), (7, 2.0, "Event 7", "standard_event", True),
        (1, 9.0, "One", "standard_event", True),
    ]
    assert as_rows(fast)[2][1][0][2] == "It's \"x\" \\ {y}"


def test_hits_with_joined_names_are_not_moved(spark):
    """Hits are stored once, in buckets of their number; with few names no event moves either."""
    df = _events(spark, [(h, [(h % 5, None), (7, float(h))]) for h in range(200)])
    names = spark.createDataFrame([(k, f"n{k}") for k in range(4)], "code long, name string")
    named = S.enhance_events(df, "event_map", names, lookup="join")
    assert "Exchange hashpartitioning" not in named._jdf.queryExecution().executedPlan().toString()
    got = {r.hit: [e.event_name for e in r.events_enhanced] for r in named.collect()}
    assert got == {h: [f"n{h % 5}" if h % 5 < 4 else "Event 4", "Event 7"] for h in range(200)}


def test_evar_instances(spark):
    df = _events(spark, [(1, [(9999, None), (10005, 2.0)])])
    assert [tuple(e) for e in S.evar_instances(df).first().evar_instances] == [(10005, 2.0, 6)]


def test_page_view_rules(spark):
    rows = [
        ("v", 1, "a", "10"), ("v", 2, "a", "00"), ("v", 3, "b", None), ("v", 4, None, "x"), ("v", 5, "c", "x"),
        ("v", 6, "d", "1.0"), ("w", 9, "z", "-"),
    ]
    df = spark.createDataFrame(rows, "distinct_id string, ts_utc int, page_url string, post_page_event string")
    flags = lambda **kw: [r.is_page_view for r in S.detect_page_view(df, **kw).orderBy("ts_utc").collect()]
    assert flags() == [False, True, True, False, False, True, False]
    assert flags(use_url_change=False) == [False, True, False, False, False, False, False]
    assert flags(use_post_page_event=False) == [False, False, True, False, False, True, False]


def test_alias_collisions_and_missing_columns(spark):
    df = spark.createDataFrame([("a", "b")], "prop1 string, prop2 string")
    sdr = spark.createDataFrame([("2", "Page Name"), ("1", "page-name"), ("9", "Gone"), ("3", "")], "PropertyNumber string, Name string")
    assert S.alias_props(df, sdr).first().asDict() == {
        "prop1": "a", "prop2": "b", "prop_page_name": "a", "prop_page_name_2": "b", "prop_gone": None,
    }


def test_two_map_numberings(spark):
    base = spark.createDataFrame([(100, "b100"), (205, "b205"), (10000, "b10000")], "id int, name string")
    events = spark.createDataFrame([("event5", "Five"), ("EVENT6", "Six"), ("event7", " ")], "Event string, Name string")
    evars = spark.createDataFrame([("evar1", "E1"), ("evar101", "E101"), ("evar100", "")], "EvarNumber string, Name string")
    joined = M.event_map_join(base, M.sdr_custom_events(events), M.sdr_evars(evars))
    assert {tuple(r) for r in joined.collect()} == {(100, "E1"), (205, "Six"), (10000, "E101")}
    ranked = M.event_map_ranked(base, events, evars)
    assert {tuple(r) for r in ranked.collect()} == {
        (100, "Instance of E1", "sdr_evar"), (205, "Five", "sdr_custom"), (207, " ", "sdr_custom"),
        (10000, "b10000", "base"), (10100, "Instance of E101", "sdr_evar"),
    }


def test_labels_do_not_multiply(spark):
    df = spark.createDataFrame([("1",), ("2",), ("x",), (None,)], "code string")
    lookup = spark.createDataFrame([(1, "b"), (1, "a"), (None, "n"), (3, "c")], "id int, name string")
    got = [r.out for r in K.join_label(df, lookup, "code", "Code", "out").collect()]
    assert sorted(got, key=str) == sorted(["a", "Code 2", "Code x", None], key=str)
    assert [r.id for r in K.reduce_lookup(lookup, df, "code").collect()] == [1, 1]


def test_business_events_and_measurements(spark):
    df = _events(spark, [(1, [(5, None), (150, 1.0), (10000, 1.0), (209, 4.0), (300, 2.0), (209, 8.0), (6, 1.0)])])
    named = S.enhance_events(df, "event_map", spark.createDataFrame([(300, "Video Start"), (6, "")], "code long, name string"))
    row = G.business_events(G.extract_measurements(named), ignore_codes=[5]).first()
    assert [e.event_code for e in row.business_events] == [300]
    assert (row.measurements.video_plays, row.measurements.measurement_209_page_load_time) == (2.0, 4.0)
    assert row.measurements.downloads is None


def test_naming_starts_no_job_and_moves_no_hit(spark):
    df = _events(spark, [(1, [(1, None)]), (2, [(7, 1.0)])])
    names = spark.createDataFrame([(k, f"n{k}") for k in range(5000)], "code long, name string")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("naming", "naming")
    try:
        named = S.enhance_events(df, "event_map", names)
        plan = named._jdf.queryExecution().executedPlan().toString()
        assert list(tracker.getJobIdsForGroup("naming")) == []
    finally:
        spark.sparkContext.setJobGroup("", "")
    # All exchanges belong to the subquery that gathers the names.
    assert "Join" not in plan and "Exchange" not in plan.split("Subquery")[0]
    assert [e[2] for r in named.orderBy("hit").collect() for e in r.events_enhanced] == ["n1", "n7"]


def test_tables_of_names(spark, monkeypatch):
    names = spark.createDataFrame([(1, "b", "y"), (1, "a", None), (None, "z", "z"), (-4097, "c", "x"), (2**40, "d", "w")], "code long, name string, other string")
    codes = spark.createDataFrame([(1,), (-4097,), (2**40,), (5,), (None,)], "code long")
    found = codes.select("code", K.find_name(K.name_table(names), F.col("code")).alias("f")).collect()
    assert {r.code: r.f and tuple(r.f) for r in found} == {1: ("a", "y"), -4097: ("c", "x"), 2**40: ("d", "w"), 5: None, None: None}
    none = codes.select(K.find_name(K.name_table(names.limit(0)), F.col("code")).alias("f")).collect()
    assert all(r.f is None for r in none)
    monkeypatch.setattr(K, "MAX_NAMES", 2)
    with pytest.raises(Exception, match="event_lookup = 'join'"):
        codes.select(K.find_name(K.name_table(names), F.col("code")).alias("f")).collect()


@pytest.mark.parametrize("limit", [3, 1])
def test_maps_beyond_the_limit_are_reduced_or_joined(spark, monkeypatch, limit):
    """Three of a thousand names occur: they fit a table of three, and are joined if it may have one."""
    monkeypatch.setattr(K, "MAX_NAMES", limit)
    df = _events(spark, [(1, [(1, None), (7, 2.0), (None, 1.0), (1, 9.0)]), (2, []), (3, [(205, 1.0), (5000, 1.0)])])
    names = spark.createDataFrame([(k, f"n{k}") for k in range(1000)] + [(7, "m7"), (None, "none"), (5000, None)], "code long, name string")
    named = S.enhance_events(df, "event_map", names, lookup="auto")
    got = {r.hit: [(e.event_code, e.event_name) for e in r.events_enhanced] for r in named.collect()}
    assert got == {1: [(1, "n1"), (7, "m7"), (1, "n1")], 2: [], 3: [(205, "n205"), (5000, "Event 5000")]}
    assert ("Join" in named._jdf.queryExecution().executedPlan().toString()) == (limit == 1)
    base = names.selectExpr("code AS id", "concat('b', name) AS name")
    events = df.selectExpr("'v' AS distinct_id", "timestamp_seconds(hit) AS ts_utc", "posexplode(events_array) AS (pos, e)").selectExpr(
        "distinct_id", "ts_utc", "named_struct('event_code', e.event_code, 'event_sequence', pos) AS event"
    )
    mapped = G.join_event_names(events, names.filter("code <> 7"), base, events.select("event.event_code").toDF("code"), "auto")
    found = sorted(((r.event.event_code, r.mapped, r.original) for r in mapped.collect()), key=str)
    want = [(1, "n1", "bn1"), (1, "n1", "bn1"), (205, "n205", "bn205"), (5000, None, None), (7, None, "bm7"), (None, None, None)]
    assert found == want


def test_hot_event_code_is_spread(spark):
    """With broadcasting off and nine of ten events on one code, no task gets many times what others do."""
    events = spark.range(20_000).selectExpr(
        "concat('v', id % 500) AS distinct_id", "timestamp_seconds(id) AS ts_utc",
        "named_struct('event_code', CASE WHEN id % 10 < 9 THEN 7L WHEN id % 20 = 9 THEN NULL ELSE id % 300 END, 'event_sequence', CAST(id % 4 AS INT)) AS event",
    )
    names = spark.createDataFrame([(k, f"n{k}") for k in range(200)], "code long, name string")
    base = spark.createDataFrame([(k, f"b{k}") for k in range(100, 400)], "id long, name string")
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        joined = G.join_event_names(events, names, base, events.selectExpr("event.event_code AS code"))
        assert "SortMergeJoin" in joined._jdf.queryExecution().executedPlan().toString()
        sizes = sorted(r["count"] for r in joined.groupBy(F.spark_partition_id().alias("p")).count().collect())
        got = joined.selectExpr("distinct_id", "ts_utc", "event.event_code", "mapped", "original")
        want = G.join_event_names(events, names, base).selectExpr("distinct_id", "ts_utc", "event.event_code", "mapped", "original")
        assert got.exceptAll(want).isEmpty() and got.count() == 20_000
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len(sizes) == 16 and sizes[-1] <= 4 * sizes[8]
    assert {(r.mapped, r.original) for r in got.filter("event_code = 7 OR event_code IS NULL").distinct().collect()} == {("n7", None), (None, None)}


@pytest.mark.parametrize("bits", [64, 1 << 16])
def test_only_rows_that_may_share_an_id_are_moved(spark, bits):
    gold = spark.range(900).selectExpr(
        "IF(id % 50 = 0, NULL, md5(CAST(IF(id < 300, id % 90, id) AS STRING))) AS insert_id",
        "id % 7 AS original_hit_no", "CAST(id AS INT) AS event_sequence", "concat('r', id) AS rest",
    )
    got = G.dedupe_events(gold, bits)
    rows = gold.collect()
    best = {}
    for r in rows:
        if r.insert_id is not None:
            key = (r.original_hit_no, r.event_sequence)
            if r.insert_id not in best or key < best[r.insert_id][0]:
                best[r.insert_id] = (key, r.rest)
    want = sorted([v[1] for v in best.values()] + [r.rest for r in rows if r.insert_id is None])
    assert sorted(r.rest for r in got.collect()) == want and got.columns == gold.columns
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    # Ids alone are counted; whole rows are grouped behind the filter, or pass it.
    assert plan.count("getbit") == 2 and "Join" not in plan.split("scalar-subquery")[0]
