import gzip

import pytest
from pyspark.sql import functions as F

from hitloom.sources import feed as FD
from hitloom.sources import layers as LY
from hitloom.streaming import FEED_METRICS, BadRecordLimit, stream_bronze, stream_events
from hitloom.operators.bronze import to_bronze


@pytest.fixture()
def files(tmp_path):
    (tmp_path / "a.tsv").write_text('1\t"x\t3\n\n  \t\tz\n1\t2\t3\t4\n5\n')
    with gzip.open(tmp_path / "b.tsv.gz", "wt") as out:
        out.write("7\t8\t9\n")
    return str(tmp_path)


def test_short_rows_are_padded_and_long_ones_rejected(spark, files):
    feed = FD.read_hits(spark, f"{files}/*.tsv*", FD.hit_schema("a,b,c"), max_bad=1)
    rows = {tuple(r) for r in feed.hits.collect()}
    assert rows == {("1", '"x', "3"), ("", None, None), ("  ", "", "z"), ("5", None, None), ("7", "8", "9")}
    assert feed.check() == 1


def test_too_many_bad_records(spark, files):
    feed = FD.read_hits(spark, f"{files}/a.tsv", FD.hit_schema("a"), max_bad=2)
    feed.hits.count()
    with pytest.raises(ValueError, match="3 bad records"):
        feed.check()


def test_external_view_sees_new_files(spark, tmp_path):
    (tmp_path / "a.tsv").write_text("1\t2\n")
    FD.external_hits(spark, str(tmp_path), FD.hit_schema("a,b"), "external_hits")
    assert spark.table("external_hits").count() == 1


def test_header_file(spark, tmp_path):
    (tmp_path / "columns.csv").write_text("Hit Time,ip,IP\nignored\n")
    assert FD.read_hit_schema(spark, str(tmp_path / "columns.csv")).names == ["hit_time", "ip", "ip_2"]


def test_lookups_and_naming_tables(spark, tmp_path):
    (tmp_path / "l.tsv").write_text("1\tone\textra\n2\nx\ty\n")
    assert [tuple(r) for r in FD.read_lookup(spark, str(tmp_path / "l.tsv")).collect()] == [(1, "one"), (2, None), (None, "y")]
    (tmp_path / "s.tsv").write_text('Event\tName\tMore\nevent1\t"A\tq\nevent2\tB\tr\n')
    sdr = FD.read_sdr(spark, str(tmp_path / "s.tsv"), "events")
    assert sdr.columns == ["Event", "Name"]
    assert [tuple(r) for r in sdr.collect()] == [("event1", '"A'), ("event2", "B")]


def test_layer_sink_skips_replaces_and_partitions(spark):
    df = spark.range(100).selectExpr("id", "timestamp_seconds(1700000000 + id * 3600) AS ts_utc", "id % 3 AS k")
    plan = LY.laid_out_by_day(df, "ts_utc", ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning(ts_date" in plan and "REPARTITION_BY_COL" in plan
    LY.write_layer(df, "sink_t", by="ts_utc", cluster=["k"])
    assert LY.write_layer(df.limit(1), "sink_t", if_exists="skip").count() == 100
    table = spark.table("sink_t")
    day = table.filter("ts_date = DATE '2023-11-15'")
    assert "PartitionFilters: [isnotnull" in day._jdf.queryExecution().toString()
    assert day.count() == 24
    assert LY.write_layer(df.limit(1), "sink_t").count() == 1
    with pytest.raises(ValueError):
        LY.write_layer(df, "sink_t", if_exists="append")


def test_view_over_too_many_long_lines(spark, files):
    schema = FD.hit_schema("a,b,c")
    assert FD.external_hits(spark, f"{files}/*.tsv*", schema, "few_bad", max_bad=1).count() == 5
    with pytest.raises(ValueError, match="1 bad records"):
        FD.external_hits(spark, f"{files}/*.tsv*", schema, "many_bad", max_bad=0)
    counts = FD.feed_line_counts(spark.read.text(f"{files}/*.tsv*"), schema).first()
    assert tuple(counts) == (5, 2, 1)


def test_export_is_gzipped_json(spark, tmp_path):
    df = spark.range(3).selectExpr("CAST(id AS STRING) AS user_agent", "id AS other", "'u' AS page_url")
    LY.export_json(df, str(tmp_path / "out"))
    assert list((tmp_path / "out").glob("*.json.gz"))
    assert spark.read.json(str(tmp_path / "out")).columns == ["page_url", "user_agent"]


def test_row_wise_operators_on_a_stream(spark, tmp_path):
    names = (
        "post_cust_hit_time_gmt cust_hit_time_gmt hit_time_gmt date_time post_visid_high post_visid_low mcvisid "
        "post_cust_visid ip user_agent accept_language post_event_list event_list"
    ).split()
    folder = tmp_path / "in"
    folder.mkdir()
    lines = [["1700000000", "", "", "", "1", "2", "", "", "", "", "", "1,200=2", ""], ["", "", "", "x", "", "", "m"], ["x"] * 20]
    (folder / "a.tsv").write_text("".join("\t".join(line) + "\n" for line in lines))
    schema = FD.hit_schema(names)
    stream = stream_bronze(spark, str(folder), schema)
    query = (
        stream.writeStream.format("memory").queryName("streamed").trigger(availableNow=True)
        .option("checkpointLocation", str(tmp_path / "c")).start()
    )
    query.awaitTermination(120)
    seen = [p.observedMetrics[FEED_METRICS] for p in query.recentProgress if FEED_METRICS in p.observedMetrics]
    assert [(m.bad_records, m.lines) for m in seen] == [(1, 3)]
    batch = to_bronze(FD.read_hits(spark, str(folder), schema).hits)
    text = lambda df: sorted(str(r) for r in df.select(F.to_json(F.struct("*")).alias("j")).collect())
    assert text(spark.table("streamed")) == text(batch) and batch.count() == 2


def test_event_operators_on_a_stream(spark, tmp_path):
    from hitloom.config import Settings
    from hitloom.operators import gold as G
    from hitloom.operators import silver as S

    rows = [(1, [(1, None), (205, 2.0), (10005, 1.0), (209, 3.0)]), (2, []), (3, [(300, 9.0), (7, None)])]
    schema = "hit int, events_array array<struct<event_code:bigint,event_value:double>>"
    spark.createDataFrame(rows, schema).repartition(2).write.parquet(str(tmp_path / "bronze"))
    names = spark.createDataFrame([(1, "One"), (300, "Video Start")], "code long, name string")
    batch = spark.read.parquet(str(tmp_path / "bronze"))
    stream = stream_events(spark.readStream.schema(batch.schema).parquet(str(tmp_path / "bronze")), names)
    assert stream.isStreaming
    query = stream.writeStream.format("memory").queryName("named_events").trigger(availableNow=True).start()
    query.awaitTermination()
    want = S.classify_hits(S.evar_instances(S.enhance_events(batch, "event_map", names)))
    want = G.business_events(G.extract_measurements(want), Settings().measurement_codes)
    text = lambda df: sorted(r.v for r in df.selectExpr("to_json(struct(*)) AS v").collect())
    got = spark.table("named_events")
    assert got.columns == want.columns and text(got) == text(want) and got.count() == 3
    assert "Video Start" in text(got)[2] and "One" in text(got)[0]


def test_limit_of_bad_records_on_a_stream(spark, tmp_path):
    schema = FD.hit_schema(["a", "b"])
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "1.tsv").write_text("1\t2\n1\t2\t3\n")

    def start(checkpoint):
        lines = spark.readStream.text(str(folder))
        hits = FD.split_hits(lines, schema, FEED_METRICS)
        return hits.writeStream.format("noop").option("checkpointLocation", str(tmp_path / checkpoint)).start()

    query = start("one")
    limit = BadRecordLimit(query, max_bad=2)
    try:
        query.processAllAvailable()
        assert limit.watch(seconds=0) == 1 and limit.lines == 2 and query.isActive
        (folder / "2.tsv").write_text("1\t2\t3\n\t\t\t\n")
        query.processAllAvailable()
        with pytest.raises(ValueError, match="3 bad records in the feed, 2 allowed"):
            limit.watch(seconds=60)
        assert not query.isActive
    finally:
        query.stop()
    ended = spark.readStream.text(str(folder))
    query = FD.split_hits(ended, schema, FEED_METRICS).writeStream.format("noop").option("checkpointLocation", str(tmp_path / "two")).trigger(availableNow=True).start()
    assert BadRecordLimit(query, max_bad=3).watch() == 3


def test_files_of_a_day_do_not_overlap(spark):
    """One visitor's rows of a day lie in at most two files, and a hot visitor's in several."""
    made = spark.range(40_000).selectExpr(
        "timestamp_seconds(1700000000 + (id * 37) % 172800) AS ts_utc",
        "IF(id % 3 = 0, 'hot', concat('v', xxhash64(id) % 97)) AS distinct_id", "id",
    )
    merging = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set("spark.sql.shuffle.partitions", "12")
    spark.conf.set(merging, "false")
    try:
        table = LY.write_layer(made, "laid_out", by="ts_utc", cluster=["distinct_id"])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset(merging)
    placed = table.select("*", F.col("_metadata.file_path").alias("file"))
    spread = placed.groupBy("ts_date", "distinct_id").agg(F.count_distinct("file").alias("files"), F.count("*").alias("rows"))
    plain = spread.filter("distinct_id != 'hot'")
    assert plain.agg(F.max("files")).first()[0] <= 2 and placed.select("file").distinct().count() >= 10
    assert spread.filter("distinct_id = 'hot'").agg(F.max("files")).first()[0] > 2
    bounds = placed.groupBy("ts_date", "file").agg(F.min("distinct_id").alias("low"), F.max("distinct_id").alias("high"))
    read = bounds.filter("low <= 'v5' AND high >= 'v5'").groupBy("ts_date").count().collect()
    assert max(r["count"] for r in read) <= 2
    assert table.count() == 40_000 and table.filter("distinct_id = 'v5'").count() == made.filter("distinct_id = 'v5'").count()


def _build_folders(spark, name):
    system, pattern = LY._files(spark, LY._base_folder(spark, name) + "*")
    return [s.getPath().getName() for s in system.globStatus(pattern)]


def test_failed_replacement_leaves_the_old_table(spark):
    good = spark.range(10).selectExpr("id", "id * 2 AS v")
    LY.write_layer(good, "replaced")
    broken = good.select("id", F.when(F.col("id") < 9, F.col("v")).otherwise(F.raise_error(F.lit("lost"))).alias("v"))
    with pytest.raises(Exception, match="lost"):
        LY.write_layer(broken.repartition(4), "replaced")
    assert sorted(spark.table("replaced").collect()) == good.collect()

    def refuse():
        raise ValueError("too many rejects")

    with pytest.raises(ValueError, match="too many rejects"):
        LY.write_layer(good.limit(1), "replaced", verify=refuse)
    assert spark.table("replaced").count() == 10 and len(_build_folders(spark, "replaced")) == 1
    with pytest.raises(ValueError, match="too many rejects"):
        LY.write_layer(good, "never_there", verify=refuse)
    assert not spark.catalog.tableExists("never_there") and _build_folders(spark, "never_there") == []
    again = LY.write_layer(good.limit(3), "replaced")
    assert again.count() == 3 and len(_build_folders(spark, "replaced")) == 1


def test_what_a_lost_driver_leaves_is_no_hindrance(spark):
    df = spark.range(5).toDF("id")
    # Lost in mid-write: files without a table, and a staged table without its name.
    df.write.parquet(LY._base_folder(spark, "resumed") + "0" * 32)
    df.write.option("path", LY._base_folder(spark, "resumed") + "1" * 32).saveAsTable(f"resumed{LY.STAGED}{'1' * 32}")
    assert not LY.table_exists(spark, "resumed")
    assert LY.write_layer(df, "resumed", if_exists="skip").count() == 5
    assert len(_build_folders(spark, "resumed")) == 1
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith(f"resumed{LY.STAGED}")]
    # Lost between the two renames: the old table is put back and kept, or replaced.
    spark.sql(f"ALTER TABLE resumed RENAME TO resumed{LY.OLD}")
    assert LY.table_exists(spark, "resumed")
    assert LY.write_layer(df.limit(1), "resumed", if_exists="skip").count() == 5
    spark.sql(f"ALTER TABLE resumed RENAME TO resumed{LY.OLD}")
    assert LY.write_layer(df.limit(2), "resumed").count() == 2
    # Lost before the old table was dropped: the new one counts.
    spark.range(7).write.option("path", LY._base_folder(spark, "resumed") + "2" * 32).saveAsTable(f"resumed{LY.OLD}")
    assert LY.write_layer(df, "resumed", if_exists="skip").count() == 2
    assert not spark.catalog.tableExists(f"resumed{LY.OLD}")
    assert LY.write_layer(df, "resumed").count() == 5 and len(_build_folders(spark, "resumed")) == 1


def test_tables_of_another_database_and_managed_ones(spark, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS other_layers LOCATION '{tmp_path}/other'")
    df = spark.range(4).toDF("id")
    assert LY.write_layer(df, "other_layers.kept").count() == 4
    assert LY.write_layer(df.limit(2), "other_layers.kept").count() == 2
    df.write.saveAsTable("managed_before")
    assert LY.write_layer(df.limit(3), "managed_before").count() == 3
    spark.sql("DROP DATABASE other_layers CASCADE")


@pytest.mark.parametrize("options", [{}, {"keep_raw": True, "drop_malformed": True}])
def test_bronze_of_lines_equals_bronze_of_hits(spark, tmp_path, options):
    from hitloom.config import Settings
    from hitloom.operators.bronze import lines_to_bronze
    from workload import inputs

    raw = inputs.inputs(spark, inputs.SMALL).raw
    raw = raw.select(*raw.columns, *[F.element_at(F.array(*map(F.lit, ["", ":", "-", "--", "---", " -", "x"])), F.lit(k % 7 + 1)).alias(f"more_{k}") for k in range(300)])
    fields = [F.coalesce(F.col(c), F.lit("")) for c in raw.columns]
    raw.select(F.concat_ws("\t", *fields)).limit(400).write.text(str(tmp_path / "feed"))
    (tmp_path / "feed" / "short.txt").write_text("a\tb\n\n" + "\t" * 400 + "\n")
    schema, settings = FD.hit_schema(raw.columns), Settings(**options)
    bad = FD.Observation()
    got = lines_to_bronze(spark.read.text(str(tmp_path / "feed")), schema, settings, bad)
    want = to_bronze(FD.read_hits(spark, str(tmp_path / "feed"), schema).hits, settings)
    assert got.columns == want.columns and got.dtypes == want.dtypes
    text = lambda df: sorted(r.j for r in df.select(F.to_json(F.struct("*")).alias("j")).collect())
    assert text(got) == text(want) and len(text(got)) > 100
    assert (bad.get["bad_records"], bad.get["lines"]) == (1, 403)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "CASE WHEN NOT more_" not in plan and plan.count("transform(f") == 1
