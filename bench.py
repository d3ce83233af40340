"""Headline timings as one JSON line.

The layers are written once (raw, bronze, silver, gold, as a user would); the
reports then read the stored gold table. Each timing is the median of the runs
after one warm-up of the reports; layers are timed on their second build.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import functions as F  # noqa: E402

from hitloom import Settings, build_session  # noqa: E402
from hitloom.operators import bronze as B  # noqa: E402
from hitloom.operators import event_map as M  # noqa: E402
from hitloom.operators import gold as G  # noqa: E402
from hitloom.operators import repair as R  # noqa: E402
from hitloom.operators import silver as S  # noqa: E402
from hitloom.plans import quality as Q  # noqa: E402
from hitloom.plans import reports as P  # noqa: E402
from hitloom.plans.layers import run_layers  # noqa: E402
from hitloom.sources.layers import GOLD_CLUSTER, SILVER_CLUSTER, write_layer  # noqa: E402
from hitloom.sources.feed import hit_schema  # noqa: E402
from workload import inputs as I  # noqa: E402

RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def drain(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(work, runs: int = RUNS) -> float:
    seconds = []
    for _ in range(runs):
        started = time.perf_counter()
        work()
        seconds.append(time.perf_counter() - started)
    return round(statistics.median(seconds), 3)


#: Columns of a full feed.
WIDE = 1189


def wide_feed(raw, work: str, settings: Settings) -> float:
    """Feed files of full width, read, split, cleaned and written as bronze."""
    spark = raw.sparkSession
    names = [*raw.columns, *(f"col_{n}" for n in range(WIDE - len(raw.columns)))]
    fields = [F.coalesce(F.col(f"`{c}`"), F.lit("")) for c in raw.columns]
    line = F.concat(F.concat_ws("\t", *fields), F.repeat(F.lit("\tx"), WIDE - len(raw.columns)))
    raw.select(line.alias("value")).write.mode("overwrite").text(f"{work}/wide")
    schema = hit_schema(names)
    return timed(lambda: write_layer(B.lines_to_bronze(spark.read.text(f"{work}/wide"), schema, settings), "bench_wide"))


def feed_files(spark, sf_dir: str, folder: str):
    """The lines of eight feed files, as the repair reads them."""
    lines = I.feed_lines(spark, sf_dir)
    lines.repartition("path").sortWithinPartitions("path", "block", "row").select("value", "path").write.partitionBy("path").text(folder)
    return lambda: R.read_lines(spark, folder)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    work = tempfile.mkdtemp(prefix="hitloom-bench-")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "12g",
            "spark.sql.warehouse.dir": f"{work}/warehouse",
            "spark.checkpoint.dir": f"{work}/checkpoints",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    settings = Settings()
    inputs = I.inputs(spark, sf_dir)
    # A feed arrives as many files; the given table is one, hence one read task.
    inputs.raw = write_layer(inputs.raw.repartition(int(cpus)), "raw")
    layers = run_layers(inputs, settings, if_exists="replace")  # warm-up

    def silver():
        return S.to_silver(layers.bronze, layers.evars, inputs.props_raw, settings, layers.event_map)

    def gold():
        return G.to_gold(layers.silver, layers.event_map, inputs.base_events, inputs.lookups, settings)

    steps = {
        "to_bronze": lambda: write_layer(B.to_bronze(inputs.raw, settings), "bench_bronze"),
        "to_silver": lambda: write_layer(silver(), "bench_silver", "ts_utc", SILVER_CLUSTER),
        "to_gold": lambda: write_layer(gold(), "bench_gold", "ts_utc", GOLD_CLUSTER),
        "event_map": lambda: drain(M.event_map_ranked(inputs.base_events, inputs.custom_events_raw, inputs.evars_raw)),
    }
    reports = {
        "raw_quality": lambda: Q.raw_quality(inputs.raw),
        "monthly_visitors": lambda: P.monthly_visitors(layers.gold),
        "monthly_views_country": lambda: P.monthly_views_by_country(layers.gold),
        "top5_countries": lambda: P.top_countries(layers.gold),
        "event_frequency": lambda: P.event_frequency(layers.gold),
        "user_journey": lambda: P.user_journeys(layers.gold),
        "layer_summary": layers.summary,
        "eventification_check": lambda: Q.eventification_check(layers.silver, layers.gold),
    }
    queries = {name: timed(step) for name, step in steps.items()}
    for name, report in reports.items():
        drain(report())
        queries[name] = timed(lambda: drain(report()))

    lines = feed_files(spark, sf_dir, f"{work}/feed")
    indexed = R.index_lines(lines())
    queries["canonical_tabs"] = timed(lambda: drain(R.canonical_tabs(R.tab_histogram(indexed))))
    indexed.feed_store.drop(spark)

    def repair() -> None:
        """From lines to classified records, line store and widths included."""
        stored = R.index_lines(lines())
        records = R.assemble_records(stored, R.canonical_tabs(R.tab_histogram(stored)))
        drain(R.classify_records(records, anchor_field=I.LINE_ANCHOR))
        stored.feed_store.drop(spark)

    queries["repair_records"] = timed(repair)
    queries["wide_feed_to_bronze"] = wide_feed(inputs.raw, work, settings)
    hits = inputs.raw.count()
    print(
        json.dumps(
            {
                "metric": "layers_and_reports_total",
                "value": round(sum(queries.values()), 3),
                "unit": "sec",
                "queries": queries,
                "sf": Path(sf_dir).name.removeprefix("sf"),
                "raw_hits": hits,
                "gold_events": layers.gold.count(),
            }
        )
    )


if __name__ == "__main__":
    main()
