"""Layers as tables: invariants across them, re-runs, plans that scale."""

import pytest
from pyspark.sql import functions as F

from hitloom.config import Settings
from hitloom.operators import lookups as K
from hitloom.operators import gold as G
from hitloom.plans import quality as Q
from hitloom.plans import reports as P
from hitloom.plans.layers import LayerWarning, check_layers, load_broken_inputs, load_inputs, plan_layers, run_layers
from workload import inputs
from workload.inputs import SMALL


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_row_invariants(small_layers):
    counts = {r.layer: r for r in small_layers.summary().collect()}
    assert counts["Raw"].total_rows >= counts["Bronze"].total_rows >= counts["Silver"].total_rows
    silver, gold = small_layers.silver, small_layers.gold
    assert gold.filter("is_page_view").count() == silver.filter("is_page_view").count()
    assert tuple(c for c in gold.columns if c != "ts_date") == G.GOLD_COLUMNS
    assert gold.groupBy("original_hit_no", "event_sequence").count().filter("count > 1").isEmpty()
    numbers = gold.agg(F.min("original_hit_no"), F.max("original_hit_no")).first()
    assert numbers[0] >= 1 and numbers[1] <= silver.count()


def test_stored_layers_equal_the_lazy_plan(spark, small_layers):
    lazy = plan_layers(inputs.inputs(spark, SMALL))
    for name in ("bronze", "silver", "gold"):
        stored, planned = getattr(small_layers, name).drop("ts_date"), getattr(lazy, name)
        assert stored.columns == planned.columns, name
        assert planned.exceptAll(stored).isEmpty() and stored.exceptAll(planned).isEmpty(), name


def test_second_run_keeps_tables(spark, small_layers):
    changed = Settings(measurement_codes=())
    again = run_layers(inputs.inputs(spark, SMALL), changed, prefix="small_")
    assert again.gold.count() == small_layers.gold.count()


def test_kept_tables_start_no_job(spark, small_layers):
    tracker, found = spark.sparkContext.statusTracker(), inputs.inputs(spark, SMALL)
    spark.sparkContext.setJobGroup("kept", "kept")
    run_layers(found, prefix="small_")
    assert list(tracker.getJobIdsForGroup("kept")) == []
    spark.sparkContext.setJobGroup("", "")


def test_rebuild_on_more_hits_equals_a_fresh_run(spark, small_layers):
    """Labels and names of an earlier, smaller build are not taken over."""
    found = inputs.inputs(spark, SMALL)
    part = inputs.inputs(spark, SMALL)
    part.raw = found.raw.filter("geo_country = '1'")
    run_layers(part, prefix="grown_")
    for name in ("bronze", "silver", "gold"):
        spark.sql(f"DROP TABLE grown_{name}")
    gold = run_layers(found, prefix="grown_").gold
    assert gold.exceptAll(small_layers.gold).isEmpty() and small_layers.gold.exceptAll(gold).isEmpty()


def test_checks_of_a_run(spark, small_layers):
    notes = check_layers(small_layers, Settings(expected_rows=5))
    assert any(n.startswith("raw: ") for n in notes)
    with pytest.warns(LayerWarning, match="raw: verdict is 'warn'"):
        run_layers(inputs.inputs(spark, SMALL), Settings(expected_rows=5), prefix="small_", check=True)


def test_no_window_over_all_hits(spark, small_layers):
    lazy = plan_layers(inputs.inputs(spark, SMALL))
    plan = plan_text(lazy.gold)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    # Single partitions hold the day sizes, read back from a checkpoint, and the slots
    # of the tables of names.
    for part in plan.split("Exchange SinglePartition")[1:]:
        assert "Scan ExistingRDD" in part[:600] or "partial_collect_list(struct(_slot" in part[:600]


def test_reports_read_few_columns_and_days(small_layers):
    few = P.monthly_visitors(P.between_dates(small_layers.gold, "2024-01-03", "2024-01-04"))
    plan = plan_text(few)
    assert "ReadSchema: struct<ts_utc:timestamp,distinct_id:string>" in plan
    assert "PartitionFilters: [isnotnull(ts_date" in plan


def test_hot_visitor_and_hot_day_change_nothing(spark, small_layers):
    cut = {"share": 0.02, "min_rows": 10}
    from hitloom.operators import silver as S

    bronze = small_layers.bronze
    key = ["hitid_high", "hitid_low", "ts_utc", "distinct_id", "prev_url", "is_page_view"]
    plain, split = (S.detect_page_view(bronze, **kw).select(*key) for kw in ({}, cut))
    assert plain.exceptAll(split).isEmpty() and split.exceptAll(plain).isEmpty()
    hits = small_layers.silver.select("ts_utc", "distinct_id", "hitid_high", "hitid_low")
    plain, split = G.hit_numbers(hits), G.hit_numbers(hits, **cut)
    assert plain.exceptAll(split).isEmpty() and split.exceptAll(plain).isEmpty()


def test_verdict_thresholds(spark):
    quality = spark.createDataFrame([(6.0,), (2.0,), (0.5,), (0.0,)], "malformed_record_pct double")
    assert [r.verdict for r in Q.malformed_verdict(quality).collect()] == ["high", "moderate", "low", "perfect"]
    drift = lambda n, want: Q.row_drift(spark.createDataFrame([(n,)], "total_rows long"), want).first().verdict
    assert (drift(89, 100), drift(90, 100), drift(5, 0)) == ("warn", "ok", "not_checked")


def test_empty_inputs(spark, small_layers):
    none = small_layers.gold.limit(0)
    assert Q.gold_metrics(none).first().total_events == 0
    assert Q.bronze_checks(small_layers.bronze.limit(0)).first().pct_null_timestamp is None
    assert P.event_frequency(none).count() == 0


def test_dedupe_keeps_one_row_per_insert_id(small_layers):
    twice = small_layers.gold.union(small_layers.gold)
    assert G.dedupe_events(twice).count() == small_layers.gold.select("insert_id").distinct().count()


def test_dedupe_keeps_events_without_id(spark, small_layers):
    rows = small_layers.gold.limit(5).withColumn("insert_id", F.lit(None).cast("string"))
    assert G.dedupe_events(rows).count() == 5


def test_distinct_counts_do_not_expand_rows(small_layers):
    for df in (Q.gold_metrics(small_layers.gold), Q.eventification_check(small_layers.silver, small_layers.gold)):
        assert "Expand" not in plan_text(df)


def lookup_folder(spark, tmp_path):
    """Column names of a feed, and a folder with its lookups."""
    names = inputs.inputs(spark, SMALL).raw.columns
    lookups = tmp_path / "lookups"
    for folder in (lookups / "values", lookups / "sdr", tmp_path / "feed"):
        folder.mkdir(parents=True)
    (lookups / "columns.csv").write_text(",".join(names))
    (lookups / "events.tsv").write_text("1\tStart\n205\tFive\n")
    (lookups / "sdr" / "custom-events.tsv").write_text("Event\tName\nevent6\tSix\n")
    (lookups / "sdr" / "evars.tsv").write_text("EvarNumber\tName\nevar1\tPage Name\n")
    (lookups / "sdr" / "custom-props.tsv").write_text("PropertyNumber\tName\n1\tPage Name\n")
    from hitloom.plans.layers import VALUE_LOOKUPS

    for name in VALUE_LOOKUPS:
        (lookups / "values" / f"{name}.tsv").write_text("1\tone\n")
    return names, lookups


def test_from_files_to_gold(spark, tmp_path):
    """A feed folder with lookups, read and run the way a user would."""
    names, lookups = lookup_folder(spark, tmp_path)
    row = dict.fromkeys(names, "") | {
        "post_cust_hit_time_gmt": "1700000000", "post_visid_high": "1", "post_visid_low": "2",
        "post_event_list": "1,205=3,209=7", "post_page_event": "0", "browser": "1", "post_evar1": "home", "page_url": "u",
    }
    (tmp_path / "feed" / "a.tsv").write_text("\t".join(row[n] for n in names) + "\n" + "\t" * (len(names) + 3) + "\n")
    found = load_inputs(spark, str(tmp_path / "feed" / "*.tsv"), str(lookups), raw_table="files_raw")
    layers = run_layers(found, prefix="files_")
    got = layers.gold.orderBy("event_sequence").collect()
    assert [(r.event_name, r.original_event_name, r.event_value) for r in got] == [
        ("Page Viewed", None, None), ("Start", "Start", None), ("Six", "Five", 3.0),
    ]
    assert {(r.browser_name, r.evar_page_name, r.measurement_209_page_load_time) for r in got} == {("one", "home", 7.0)}
    with pytest.raises(ValueError):
        load_inputs(
            spark, str(tmp_path / "feed" / "*.tsv"), str(lookups), Settings(max_bad_records=0), "files_raw_2"
        )
    assert not spark.catalog.tableExists("files_raw_2")
    assert not spark.catalog.tableExists("files_raw_2_unchecked")


def test_from_broken_lines_to_gold(spark, tmp_path):
    """One call repairs a feed and loads it: same gold as from the feed unbroken."""
    names, lookups = lookup_folder(spark, tmp_path)
    hit = ("hit_time_gmt", "hitid_high", "hitid_low")
    order = [*hit, *(n for n in names if n not in hit)]
    (lookups / "columns.csv").write_text(",".join(order))
    lines = []
    for k in range(60):
        row = dict.fromkeys(order, "") | {
            "hit_time_gmt": str(1_700_000_000 + k), "hitid_high": str(10**12 + k), "hitid_low": str(10**12 - k),
            "post_visid_high": "1", "post_visid_low": str(k % 7), "post_event_list": "1,205=3", "page_url": f"u{k % 3}",
            "pagename": "first\nsecond" if k % 4 == 0 else "plain",
        }
        lines.append("\t".join(row[n] for n in order))
    (tmp_path / "feed" / "a.tsv").write_text("\n".join(lines[:40]) + "\nlost\tline\n")
    (tmp_path / "feed" / "b.tsv").write_text("\r\n".join(lines[40:]) + "\r\n")
    clean = str(tmp_path / "clean")
    found = load_broken_inputs(spark, str(tmp_path / "feed" / "*.tsv"), str(lookups), clean, raw_table="broken_raw")
    assert found.raw.count() == 60
    rejected = spark.read.text(f"{clean}/outcome=reject").collect()
    assert [(r.value, r.source) for r in rejected] == [("lost\tline", "a.tsv")]
    gold = run_layers(found, prefix="broken_").gold
    (tmp_path / "whole").mkdir()
    (tmp_path / "whole" / "a.tsv").write_text("\n".join(line.replace("\n", "\\n") for line in lines) + "\n")
    other = load_inputs(spark, str(tmp_path / "whole" / "a.tsv"), str(lookups), raw_table="whole_raw")
    want = run_layers(other, prefix="whole_").gold
    assert gold.count() > 100 and gold.exceptAll(want).isEmpty() and want.exceptAll(gold).isEmpty()
    # A table that is kept is not repaired again.
    again = load_broken_inputs(spark, str(tmp_path / "none" / "*.tsv"), str(lookups), clean, raw_table="broken_raw")
    assert again.raw.count() == 60


def test_joined_names_give_the_same_gold(spark, small_layers):
    found = inputs.inputs(spark, SMALL)
    joined = plan_layers(found, Settings(event_lookup="join")).gold
    stored = small_layers.gold.drop("ts_date")
    assert joined.exceptAll(stored).isEmpty() and stored.exceptAll(joined).isEmpty()


def test_event_map_beyond_the_limit_gives_the_same_gold(spark, small_layers, monkeypatch):
    found = inputs.inputs(spark, SMALL)
    codes = small_layers.silver.selectExpr("explode(events_enhanced.event_code) AS code").distinct()
    limit = codes.count()
    base = spark.range(20_000, 20_001 + limit).selectExpr("CAST(id AS INT) AS id", "concat('unused ', id) AS name")
    found.base_events = found.base_events.unionByName(base)
    monkeypatch.setattr(K, "MAX_NAMES", limit)
    gold = plan_layers(found).gold
    stored = small_layers.gold.drop("ts_date")
    assert gold.exceptAll(stored).isEmpty() and stored.exceptAll(gold).isEmpty()
