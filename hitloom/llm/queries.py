"""One query for each operator, over whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hitloom.llm import (
    ann,
    compression,
    decontaminate,
    html_template,
    langmix,
    line_dedup,
    mixing,
    periodic_runs,
    pseudonyms,
    simhash,
    toxicity,
    warc,
    whitening,
)

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op2_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_and_read(_table(spark, sf_dir, "pages"))


def op4_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_template.extract(_table(spark, sf_dir, "pages"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(_table(spark, sf_dir, "documents"))


def op6_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonyms.replace_values(_table(spark, sf_dir, "documents"))


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(_table(spark, sf_dir, "documents"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_documents(_table(spark, sf_dir, "documents"))


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langmix.identify_documents(_table(spark, sf_dir, "documents"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(_table(spark, sf_dir, "embeddings"))


def op12_compression(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compression.score_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op13_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.run_report(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    "op1_toxicity": op1_toxicity,
    "op2_ann": op2_ann,
    "op3_warc": op3_warc,
    "op4_html": op4_html,
    "op5_line_dedup": op5_line_dedup,
    "op6_pseudonyms": op6_pseudonyms,
    "op7_decontaminate": op7_decontaminate,
    "op8_simhash": op8_simhash,
    "op9_mixing": op9_mixing,
    "op10_language": op10_language,
    "op11_whitening": op11_whitening,
    "op12_compression": op12_compression,
    "op13_runs": op13_runs,
}
