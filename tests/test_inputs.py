from workload import inputs as I


def test_events_of_one_task_are_dealt_to_all_cores(spark, tmp_path):
    rows = [(n, 1_700_000_000 + n, n % 7, "view", 1.0) for n in range(500)] + [(None, None, None, "click", 2.0)] * 2 + [(3, 1_700_000_003, 3, "view", 1.0)]
    given = spark.createDataFrame(rows, "event_id long, s long, user_id long, event_type string, value double")
    given = given.selectExpr("event_id", "timestamp_seconds(s) AS ts", "user_id", "event_type", "value", "'{}' AS props")
    given.coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    read = spark.read.parquet(f"{tmp_path}/events.parquet")
    assert read.rdd.getNumPartitions() == 1
    hits = I.table(spark, str(tmp_path), I.HITS)
    assert "hashpartitioning(event_id" in hits._jdf.queryExecution().executedPlan().toString()
    spread = I.spread(read)
    assert spread.count() == 503 and spread.exceptAll(read).count() == 0
    given.repartition(8).write.parquet(f"{tmp_path}/many.parquet")
    many = spark.read.option("openCostInBytes", 1).parquet(f"{tmp_path}/many.parquet")
    if many.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism:
        assert I.spread(many) is many


def test_codes_are_counted_without_parsing_lists_twice(spark, tmp_path, monkeypatch):
    from hitloom.operators import silver as S

    seen, counts = [], S.code_counts
    monkeypatch.setattr(S, "code_counts", lambda codes: seen.append(codes) or counts(codes))
    hits = spark.createDataFrame([("5,6=2,x",), ("",), (None,)], "post_event_list string")
    parsed = hits.selectExpr("*", "transform(split(post_event_list, ','), i -> struct(try_cast(substring_index(i, '=', 1) AS bigint) AS event_code, try_cast(1 AS double) AS event_value)) AS events_array")
    names = spark.createDataFrame([(5, "five")], "code long, name string")
    named = S.enhance_events(parsed, "event_map", names, lookup="auto")
    events = [(e["event_code"], e["event_name"]) for row in named.collect() for e in row["events_enhanced"] or []]
    assert sorted(events) == [(5, "five"), (6, "Event 6")]
    assert sorted(tuple(row) for row in named.event_codes.collect()) == [(5, 1), (6, 1)]
    assert seen[0]._jdf.queryExecution().optimizedPlan().toString().count("post_event_list") <= 2 + 1
