"""Feed repair against a sequential fold, and each verdict on a real-size record."""

import gzip
import random

import pytest
from pyspark.sql import functions as F

from hitloom.operators import repair as R
from hitloom.sources.layers import write_repaired

WIDTH, ANCHOR = 11, 4


def record(rnd, width=WIDTH + 1, anchor=ANCHOR):
    fields = [f"v{rnd.randrange(100)}" for _ in range(width)]
    fields[anchor : anchor + 3] = [str(rnd.randrange(10**9, 10**10)), str(rnd.randrange(10**12, 10**13)), "1" * 19]
    return fields


def broken_feed(rnd, count):
    made = []
    for _ in range(count):
        fields, dice = record(rnd), rnd.random()
        if dice < 0.3:
            for _ in range(rnd.randrange(1, 5)):
                at = rnd.choice([i for i in range(WIDTH + 1) if not ANCHOR <= i < ANCHOR + 3])
                fields[at] += "\n" * rnd.randrange(1, 3) + "x"
        elif dice < 0.35:
            fields = fields[: -rnd.randrange(1, 4)]
        elif dice < 0.4:
            fields += ["e"] * rnd.randrange(1, 9)
        elif dice < 0.42:
            fields = fields * 12
        made.append("\t".join(fields))
    return "\n".join(made)


def fold(text, width, max_chars):
    """The line-by-line rule, as a plain loop."""
    done, cur, tabs = [], "", 0
    for line in text.split("\n"):
        if line:
            cur += ("\\n" if cur else "") + line
            tabs += line.count("\t")
            if len(cur) > max_chars or tabs > 8 * width:
                done.append((cur, tabs, True))
                cur, tabs = "", 0
        if cur and tabs >= width:
            done.append((cur, tabs, False))
            cur, tabs = "", 0
    return done + ([(cur, tabs, False)] if cur else [])


@pytest.fixture(scope="module")
def feed(tmp_path_factory):
    rnd, folder, texts = random.Random(11), tmp_path_factory.mktemp("feed"), {}
    for name in ("a.tsv", "b.tsv"):
        texts[name] = broken_feed(rnd, 120)
    # No line of this one fills the width, so every chunk depends on the last.
    texts["c.tsv"] = "\n".join("\t".join("x" * rnd.randrange(3) for _ in range(rnd.randrange(1, 7))) for _ in range(400))
    texts["d.tsv"] = "\n".join(rnd.choice(["", "word", "two words"]) for _ in range(200))
    for name, text in texts.items():
        (folder / name).write_text(text)
    texts["z.tsv.gz"] = broken_feed(rnd, 60).replace("\n", "\r\n")
    with gzip.open(folder / "z.tsv.gz", "wt", newline="") as out:
        out.write(texts["z.tsv.gz"])
    return folder, texts


@pytest.mark.parametrize("chunk_bits,max_chars", [(17, 10**6), (2, 10**6), (2, 45)])
def test_records_equal_the_fold(spark, feed, chunk_bits, max_chars):
    folder, texts = feed
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    try:
        indexed = R.index_lines(R.read_lines(spark, str(folder)), chunk_bits=chunk_bits)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    widths = indexed.select("path").distinct().withColumn("width", F.lit(WIDTH))
    got = R.assemble_records(indexed, widths, max_chars).collect()
    assert indexed.select(*R.CHUNK).distinct().count() > len(texts)
    for name, text in texts.items():
        mine = sorted((r.record, r.tabs, r.oversize) for r in got if r.path.endswith("/" + name))
        assert mine == sorted(fold(text.replace("\r", ""), WIDTH, max_chars)), name


def test_width_is_the_most_frequent_distance(spark, feed):
    folder, _ = feed
    indexed = R.index_lines(R.read_lines(spark, f"{folder}/*.tsv"), chunk_bits=3)
    widths = {r.path[-5:]: r.width for r in R.canonical_tabs(R.tab_histogram(indexed)).collect()}
    assert widths == {"a.tsv": WIDTH, "b.tsv": WIDTH}


def test_tie_goes_to_the_larger_distance(spark):
    histogram = spark.createDataFrame([("f", 5, 2), ("f", 9, 2), ("f", 7, 1)], "path string, delta int, records long")
    assert R.canonical_tabs(histogram).first().width == 9


def test_anchors_with_and_without_their_own_tabs(spark):
    triple = "1700000000\t1000000000000\t2000000000000"
    lines = spark.createDataFrame(
        [("f", 0, n, text) for n, text in enumerate([f"a\tb\t{triple}\tz", f"{triple}\tq\t{triple}", "none\there"])],
        "path string, block long, row long, value string",
    )
    take = lambda all_tabs: [(r.tabs, r.anchors) for r in R.find_anchors(lines, all_tabs).orderBy("row").collect()]
    assert take(True) == [(5, [2]), (6, [0, 4]), (1, [])]
    # Tabs inside a match (three, or two at the line start) are not counted.
    assert take(False) == [(2, [1]), (1, [0, 1]), (1, [])]


def real(shift=0, extra=0, width=329):
    """A record with the anchor at its usual field 317, moved by ``shift``."""
    fields = record(random.Random(1), width + 1, R.ANCHOR_FIELD)
    fields = ["s"] * shift + fields if shift >= 0 else fields[-shift:]
    return fields + ["e"] * extra


@pytest.mark.parametrize(
    "fields,verdict",
    [
        (real(), "exact"), (real()[:-3], "pad"), (real(extra=3), "trim"), (real()[:-4], "realigned"),
        (real(extra=4), "realigned"), (real(shift=5), "realigned"), (real(shift=-5, extra=9), "realigned"),
        (real(shift=6), "reject"), (real()[:150], "fragment"), (["a"] * 5, "fragment"), (["q"] * 340, "reject"),
    ],
)
def test_verdicts(spark, fields, verdict):
    text = "\t".join(fields)
    df = spark.createDataFrame([(text, len(fields) - 1, 329)], "record string, tabs int, width int")
    got = R.classify_records(df).first()
    assert got.verdict == verdict
    if verdict in ("fragment", "reject"):
        assert got.fixed is None
    else:
        fixed = got.fixed.split("\t")
        # A short record whose anchor is in place is only ever cut, never filled.
        assert len(fixed) == (326 if len(fields) == 326 else 330)
        assert fixed[R.ANCHOR_FIELD] == real()[R.ANCHOR_FIELD]


def test_statistics_and_dual_sink(spark, feed, tmp_path):
    folder, texts = feed
    store = str(tmp_path / "store")
    records = R.repair_files(spark, str(folder / "a.tsv"), anchor_field=ANCHOR, store=store)
    stats = {r.path: r for r in R.repair_stats(records).collect()}
    want = fold(texts["a.tsv"], WIDTH, R.MAX_RECORD_CHARS)
    total = stats[None]
    assert total.records == sum(not over for _, _, over in want)
    assert total.records + sum(over for _, _, over in want) == total.ok + total.bad
    write_repaired(records, str(tmp_path / "out"))
    clean = spark.read.text(str(tmp_path / "out" / "outcome=clean")).collect()
    rejected = spark.read.text(str(tmp_path / "out" / "outcome=reject")).collect()
    assert (len(clean), len(rejected)) == (total.ok, total.bad)
    assert {r.value.count("\t") for r in clean} == {WIDTH}


def test_given_width_and_carriage_returns(spark, tmp_path):
    (tmp_path / "f.tsv").write_bytes(b"a\tb\r\n\r\nc\td\r\ne")
    got = {r.record for r in R.repair_files(spark, str(tmp_path / "f.tsv"), width=2).collect()}
    assert got == {"a\tb\\nc\td", "e"}


def test_file_without_width_is_an_error_or_rejected(spark, tmp_path):
    rnd = random.Random(3)
    (tmp_path / "good.tsv").write_text("\n".join("\t".join(record(rnd)) for _ in range(5)) + "\n")
    (tmp_path / "none.tsv").write_text("a\tb\n\nc\n")
    (tmp_path / "one.tsv").write_text("\t".join(record(rnd)) + "\nrest\n")
    with pytest.raises(ValueError, match="none.tsv.*one.tsv"):
        R.repair_files(spark, str(tmp_path), anchor_field=ANCHOR)
    records = R.repair_files(spark, str(tmp_path), anchor_field=ANCHOR, missing_width="reject")
    found = {(r.path.rsplit("/", 1)[-1] if r.path else None): r for r in R.repair_stats(records).collect()}
    assert [(found[n].records, found[n].ok, found[n].bad) for n in ("good.tsv", "none.tsv", "one.tsv", None)] == [(5, 5, 0), (2, 0, 2), (2, 0, 2), (9, 5, 4)]
    write_repaired(records, str(tmp_path / "out"))
    assert spark.read.text(str(tmp_path / "out" / "outcome=reject")).count() == 4
    with pytest.raises(ValueError):
        R.repair_files(spark, str(tmp_path), missing_width="skip")


def test_only_lines_of_broken_records_move(spark, feed):
    folder, texts = feed
    records = R.repair_files(spark, f"{folder}/*.tsv", width=WIDTH)
    plan = records._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
    moved = plan.split("Exchange")[1].split("\n")[0]
    assert "record_block" in moved and "record_row" in moved
    assert plan.count("ShuffledHashJoin") == 2 and "SortMergeJoin" not in plan and "BroadcastExchange" not in plan
    assert records.count() == sum(len(fold(t, WIDTH, R.MAX_RECORD_CHARS)) for n, t in texts.items() if n.endswith(".tsv"))
    records.feed_store.drop(spark)


def test_store_goes_at_the_end(spark, feed, tmp_path):
    folder, _ = feed
    tables = lambda: {t.name for t in spark.catalog.listTables() if t.name.startswith("feed_")}
    before = tables()
    with R.repaired(spark, str(folder / "a.tsv"), width=WIDTH, store=str(tmp_path / "store")) as records:
        assert records.count() > 100 and (tmp_path / "store" / "lines").exists()
        assert tables() > before
    assert not (tmp_path / "store").exists() and tables() == before
    # Also when no width is found, and when the block fails.
    (tmp_path / "none.tsv").write_text("a\tb\n")
    with pytest.raises(ValueError, match="no record width"), R.repaired(spark, str(tmp_path / "none.tsv"), store=str(tmp_path / "two")):
        raise AssertionError("not reached")
    with pytest.raises(KeyError), R.repaired(spark, str(folder / "a.tsv"), width=WIDTH, store=str(tmp_path / "three")):
        raise KeyError("in the block")
    assert not (tmp_path / "two").exists() and not (tmp_path / "three").exists() and tables() == before


def test_outcomes_by_file(spark, feed, tmp_path):
    folder, texts = feed
    with R.repaired(spark, str(folder), width=WIDTH, anchor_field=ANCHOR) as records:
        want = {(r.path.rsplit("/", 1)[-1]): r for r in R.repair_stats(records).collect() if r.path}
        write_repaired(records, str(tmp_path / "out"))
        write_repaired(records, str(tmp_path / "flat"), per_file=False)
    for outcome, count in (("clean", lambda r: r.ok), ("reject", lambda r: r.bad)):
        whole = tmp_path / "out" / f"outcome={outcome}"
        rows = spark.read.text(str(whole)).groupBy("source").count().collect()
        assert {r.source: r["count"] for r in rows} == {n: count(r) for n, r in want.items() if count(r)}
        flat = spark.read.text(str(tmp_path / "flat" / f"outcome={outcome}"))
        assert flat.columns == ["value"]
        assert sorted(r.value for r in flat.collect()) == sorted(r.value for r in spark.read.text(str(whole)).collect())
    assert set(texts) == set(want)


def test_empty_and_blank_files(spark, tmp_path):
    (tmp_path / "empty.tsv").write_text("")
    (tmp_path / "blank.tsv").write_text("\n\n\r\n")
    with R.repaired(spark, str(tmp_path), width=3) as records:
        assert records.collect() == []


def test_chunks_pass_through_python_in_batches(spark, tmp_path):
    """Many small chunks share a batch, and one chunk may span batches; neither is a call of its own."""
    (tmp_path / "a.tsv").write_text("".join(f"l{n}\tx\n{n}\ty\n\n" for n in range(100)))
    records = {}
    for bits, size in ((1, 10_000), (10, 7), (10, 10_000)):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(size))
        try:
            indexed = R.index_lines(R.read_lines(spark, str(tmp_path / "a.tsv")), chunk_bits=bits)
            widths = indexed.select("path").distinct().withColumn("width", F.lit(2))
            assert R.place_chunks(indexed, widths).count() == (150 if bits == 1 else 1)
            found = R.assemble_records(indexed, widths).select("record_row", "record", "tabs")
            records[bits, size] = sorted(map(tuple, found.collect()))
        finally:
            spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
        indexed.feed_store.drop(spark)
    first = records[10, 10_000]
    assert [r[1] for r in first] == [f"l{n}\tx\\n{n}\ty" for n in range(100)]
    assert records[1, 10_000] == first and records[10, 7] == first
    kept = spark.range(600).selectExpr("'p' AS path", "0L AS block", "id div 2 AS part", "id AS row", "1 AS tabs", "1 AS chars", "2 AS width")
    plan = R._in_chunks(kept, R._report_chunk, R._REPORT_TYPES, R._REPORT, 99)._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "FlatMapGroups" not in plan
