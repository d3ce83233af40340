"""All layers of one dataset, from raw hits to gold, as tables."""

from __future__ import annotations

import warnings
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hitloom.config import Settings
from hitloom.operators import bronze as B
from hitloom.operators import event_map as M
from hitloom.operators import gold as G
from hitloom.operators import silver as S
from hitloom.operators.lookups import reduce_lookups
from hitloom.operators.repair import repaired
from hitloom.plans import quality as Q
from hitloom.sources.feed import HitFeed, read_hit_schema, read_hits, read_lookup, read_sdr
from hitloom.sources.layers import GOLD_CLUSTER, SILVER_CLUSTER, table_exists, write_layer, write_repaired

# Lookup files, each ``<name>.tsv``.
VALUE_LOOKUPS = (
    "browser", "browser_type", "connection_type", "languages", "referrer_type", "country", "operating_systems",
    "resolution", "color_depth", "javascript_version", "plugins", "search_engines",
)

# Verdicts of the layer checks that ask for attention.
WARNING_VERDICTS = ("warn", "low", "high", "loss", "excess")

# Naming file -> kind.
SDR_FILES = {"custom-events": "events", "evars": "evars", "custom-props": "props"}


@dataclass
class Inputs:
    """What the layers are built from."""

    raw: DataFrame
    base_events: DataFrame
    custom_events_raw: DataFrame
    evars_raw: DataFrame
    props_raw: DataFrame
    lookups: Mapping[str, DataFrame] = field(default_factory=dict)


def load_lookups(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {name: read_lookup(spark, f"{folder}/values/{name}.tsv") for name in VALUE_LOOKUPS}


def load_inputs(
    spark: SparkSession,
    feed_paths: str | list[str],
    lookup_folder: str,
    settings: Settings = Settings(),
    raw_table: str = "raw",
    if_exists: str = "skip",
) -> Inputs:
    """Write the raw table unless present, check rejected lines, read the rest."""
    if if_exists == "skip" and table_exists(spark, raw_table):
        raw = spark.table(raw_table)
    else:
        schema = read_hit_schema(spark, f"{lookup_folder}/columns.csv")
        feed: HitFeed = read_hits(spark, feed_paths, schema, settings.max_bad_records)
        # The table gets its name once it is checked: one with too many rejects, or what
        # a lost driver leaves behind, is never taken for a finished one.
        raw = write_layer(feed.hits, raw_table, verify=feed.check)
    sdr = {kind: read_sdr(spark, f"{lookup_folder}/sdr/{file}.tsv", kind) for file, kind in SDR_FILES.items()}
    return Inputs(
        raw=raw,
        base_events=read_lookup(spark, f"{lookup_folder}/events.tsv"),
        custom_events_raw=sdr["events"],
        evars_raw=sdr["evars"],
        props_raw=sdr["props"],
        lookups=load_lookups(spark, lookup_folder),
    )


def load_broken_inputs(
    spark: SparkSession,
    feed_paths: str | list[str],
    lookup_folder: str,
    clean_folder: str,
    settings: Settings = Settings(),
    raw_table: str = "raw",
    if_exists: str = "skip",
    **repair_options,
) -> Inputs:
    """`load_inputs` for a feed whose records span lines, are shifted or of wrong width.

    The feed is repaired into ``clean_folder`` (clean and rejected records of each file,
    see `write_repaired`), and the raw table is loaded from the clean ones. A raw table
    that is kept needs no repair, so none is run.
    """
    if if_exists != "skip" or not table_exists(spark, raw_table):
        options = {"tolerance": settings.padding_tolerance, **repair_options}
        with repaired(spark, feed_paths, **options) as records:
            write_repaired(records, clean_folder)
    return load_inputs(spark, f"{clean_folder}/outcome=clean", lookup_folder, settings, raw_table, if_exists)


@dataclass
class Layers:
    raw: DataFrame
    bronze: DataFrame
    silver: DataFrame
    gold: DataFrame
    event_map: DataFrame
    custom_events: DataFrame
    evars: DataFrame

    def summary(self) -> DataFrame:
        return Q.layer_summary(self.raw, self.bronze, self.silver, self.gold)

    def ratios(self) -> DataFrame:
        return Q.layer_ratios(self.summary())

    def events(self) -> DataFrame:
        return Q.event_breakdown(self.gold)


def plan_layers(inputs: Inputs, settings: Settings = Settings()) -> Layers:
    """All layers as one lazy plan; nothing is written."""
    evars = M.sdr_evars(inputs.evars_raw, settings.evar_code_offset)
    custom = M.sdr_custom_events(inputs.custom_events_raw, settings.custom_event_base)
    event_map = M.event_map_ranked(
        inputs.base_events,
        inputs.custom_events_raw,
        inputs.evars_raw,
        settings.custom_event_base,
        settings.evar_code_offset,
    )
    bronze = B.to_bronze(inputs.raw, settings)
    silver = S.to_silver(bronze, evars, inputs.props_raw, settings, event_map)
    gold = G.to_gold(silver, event_map, inputs.base_events, inputs.lookups, settings)
    return Layers(inputs.raw, bronze, silver, gold, event_map, custom, evars)


def run_layers(
    inputs: Inputs, settings: Settings = Settings(), prefix: str = "", if_exists: str = "skip", check: bool = False
) -> Layers:
    """Write each layer once and build the next one from its table.

    Layers that exist are kept unless ``if_exists="replace"``; of a kept layer
    nothing is planned or read. The naming tables and the event map are rebuilt
    whenever silver is, the reduced label lookups whenever gold is, since they
    belong to the hits of that build. With ``check`` the layers built are checked
    and `LayerWarning` is issued for each verdict that asks for it.
    """
    spark = inputs.raw.sparkSession
    if if_exists not in ("replace", "skip"):
        raise ValueError("if_exists is 'replace' or 'skip'")

    def present(name: str) -> bool:
        return if_exists == "skip" and table_exists(spark, prefix + name)

    def put(df: DataFrame, name: str, by: str | None = None, cluster=()) -> DataFrame:
        return write_layer(df, prefix + name, by=by, cluster=cluster)

    def kept(name: str) -> DataFrame:
        return spark.table(prefix + name)

    built = [name for name in ("bronze", "silver", "gold") if not present(name)]
    bronze = put(B.to_bronze(inputs.raw, settings), "bronze") if "bronze" in built else kept("bronze")
    naming = ("sdr_evars", "sdr_custom_events", "event_map")
    if "silver" in built or not all(map(present, naming)):
        evars = put(M.sdr_evars(inputs.evars_raw, settings.evar_code_offset), "sdr_evars")
        custom = put(M.sdr_custom_events(inputs.custom_events_raw, settings.custom_event_base), "sdr_custom_events")
        ranked = M.event_map_ranked(
            inputs.base_events,
            inputs.custom_events_raw,
            inputs.evars_raw,
            settings.custom_event_base,
            settings.evar_code_offset,
        )
        event_map = put(ranked, "event_map")
    else:
        evars, custom, event_map = map(kept, naming)
    if "silver" in built:
        made = S.to_silver(bronze, evars, inputs.props_raw, settings, event_map)
        silver = put(made, "silver", "ts_utc", SILVER_CLUSTER)
    else:
        silver = kept("silver")
    silver = silver.drop("ts_date")
    if "gold" in built:
        wanted = {table: (inputs.lookups[table], key) for table, key, _ in G.LABELS.values()}
        labels = dict(inputs.lookups)
        for table, reduced in reduce_lookups(wanted, silver).items():
            labels[table] = put(reduced, f"label_{table}")
        made = G.to_gold(silver, event_map, inputs.base_events, labels, settings)
        gold = put(made, "gold", "ts_utc", GOLD_CLUSTER)
    else:
        gold = kept("gold")
    layers = Layers(inputs.raw, bronze, silver, gold, event_map, custom, evars)
    if check:
        for note in check_layers(layers, settings, built):
            warnings.warn(note, LayerWarning, stacklevel=2)
    return layers


class LayerWarning(UserWarning):
    """A layer that was built but looks wrong."""


def check_layers(layers: Layers, settings: Settings = Settings(), names: Sequence[str] = ("bronze", "silver", "gold")) -> list[str]:
    """Notes on the checks that warn, of the raw table and the layers named."""
    notes = []

    def look(layer: str, df: DataFrame) -> None:
        row = df.first().asDict()
        notes.extend(f"{layer}: {name} is {value!r}" for name, value in row.items() if _asks(value))

    if settings.expected_rows:
        counted = layers.raw.agg(F.count(F.lit(1)).alias("total_rows"))
        look("raw", Q.row_drift(counted, settings.expected_rows))
    if "bronze" in names:
        look("bronze", Q.bronze_checks(layers.bronze, settings))
    if "silver" in names:
        look("silver", Q.silver_checks(layers.silver, layers.event_map, settings))
    if "gold" in names:
        look("gold", Q.gold_checks(layers.silver, layers.gold))
    return notes


def _asks(verdict: object) -> bool:
    return isinstance(verdict, str) and (verdict in WARNING_VERDICTS or verdict.startswith("✗"))
