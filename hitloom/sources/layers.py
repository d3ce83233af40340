"""Layer tables, exports and the two outputs of the feed repair."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hitloom.operators.repair import BAD_VERDICTS

# Columns that rows are laid out by within a day.
SILVER_CLUSTER = ("distinct_id", "is_page_view")
GOLD_CLUSTER = ("distinct_id", "event_name", "is_page_view")

# Columns of the export, as far as the table has them.
EXPORT_COLUMNS = (
    "ts_utc", "distinct_id", "is_page_view", "hits_found", "events", "page_url", "pagename", "geo_country",
    "country_name", "browser_name", "operating_system_name", "user_agent",
)


OLD, STAGED = "__old", "__staged_"


def table_exists(spark: SparkSession, name: str) -> bool:
    """Whether a finished table of that name is there; one set aside by a lost driver is put back."""
    recover(spark, name)
    return spark.catalog.tableExists(name)


def laid_out_by_day(df: DataFrame, by: str, cluster: Sequence[str] = ()) -> DataFrame:
    """Rows with ``ts_date``, in ranges of day, cluster columns and time over the tasks, sorted in each.

    The bounds are sampled, so a large day, and a visitor with many rows on it, are
    spread over several tasks; small ranges are merged by adaptive execution.
    """
    order = ["ts_date", *cluster, by]
    return df.withColumn("ts_date", F.to_date(by)).repartitionByRange(*order).sortWithinPartitions(*order)


def _base_folder(spark: SparkSession, name: str) -> str:
    """Where the folders of a table's builds are: ``<database folder>/<table>__build_<id>``."""
    *database, table = name.split(".")
    home = spark.catalog.getDatabase(database[0] if database else spark.catalog.currentDatabase()).locationUri
    return f"{home.rstrip('/')}/{table}__build_"


def _files(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def _leftover_builds(spark: SparkSession, name: str, kept: str) -> list[str]:
    """Folders of builds of a table other than ``kept``."""
    system, pattern = _files(spark, _base_folder(spark, name) + "*")
    found = [status.getPath().toString() for status in system.globStatus(pattern) or []]
    last = lambda path: path.rstrip("/").rsplit("/", 1)[-1]
    return [path for path in found if last(path) != last(kept)]


def recover(spark: SparkSession, name: str) -> None:
    """Finish or undo a replacement that a lost driver left half done.

    Until the new table has the name, the old one is kept aside; so one of both is
    there and whole at any time.
    """
    exists = spark.catalog.tableExists
    if exists(name + OLD):
        if exists(name):
            spark.sql(f"DROP TABLE {name + OLD}")
        else:
            spark.sql(f"ALTER TABLE {name + OLD} RENAME TO {name}")


def _commit(spark: SparkSession, staged: str, name: str) -> None:
    if spark.catalog.tableExists(name):
        spark.sql(f"ALTER TABLE {name} RENAME TO {name + OLD}")
    spark.sql(f"ALTER TABLE {staged} RENAME TO {name}")
    spark.sql(f"DROP TABLE IF EXISTS {name + OLD}")


def write_layer(
    df: DataFrame,
    name: str,
    by: str | None = None,
    cluster: Sequence[str] = (),
    if_exists: str = "replace",
    verify: Callable[[], object] | None = None,
) -> DataFrame:
    """Write a table and read it back; ``if_exists="skip"`` keeps a present one.

    With ``by`` (a time column) the table is partitioned by day in ``ts_date``, its rows
    laid out in ranges (`laid_out_by_day`): the files of a day do not overlap in the
    cluster columns, so a filter on the first one skips most of them.

    Each build goes to a folder of its own under a staged name, is checked by ``verify``
    (which raises), and then takes the name; no data move. If anything fails, or the
    driver is lost, the table of before is still there, and the next write removes what
    is left of other builds. One driver at a time may write a table.
    """
    spark = df.sparkSession
    if if_exists not in ("replace", "skip"):
        raise ValueError("if_exists is 'replace' or 'skip'")
    if table_exists(spark, name) and if_exists == "skip":
        return spark.table(name)
    build = uuid.uuid4().hex
    staged, folder = f"{name}{STAGED}{build}", _base_folder(spark, name) + build
    writer = (df if by is None else laid_out_by_day(df, by, cluster)).write.format("parquet").option("path", folder)
    try:
        (writer if by is None else writer.partitionBy("ts_date")).saveAsTable(staged)
        if verify is not None:
            verify()
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {staged}")
        system, target = _files(spark, folder)
        system.delete(target, True)
        raise
    _commit(spark, staged, name)
    _remove_leftovers(spark, name, folder)
    return spark.table(name)


def _remove_leftovers(spark: SparkSession, name: str, folder: str) -> None:
    """Staged tables and folders of other builds. A table not written here lost its files when it was dropped."""
    *database, table = name.split(".")
    for other in spark.catalog.listTables(*database):
        if other.name.startswith(f"{table}{STAGED}".lower()):
            spark.sql(f"DROP TABLE {'.'.join([*database, other.name])}")
    for path in _leftover_builds(spark, name, folder):
        system, target = _files(spark, path)
        system.delete(target, True)


def export_rows(df: DataFrame, columns: Sequence[str] = EXPORT_COLUMNS) -> DataFrame:
    """The export columns that exist, in the given order."""
    return df.select(*[name for name in columns if name in df.columns])


def export_json(df: DataFrame, path: str, columns: Sequence[str] = EXPORT_COLUMNS) -> None:
    """Gzipped JSON lines, one file per task."""
    export_rows(df, columns).write.mode("overwrite").json(path, compression="gzip")


def write_repaired(records: DataFrame, path: str, compression: str = "gzip", per_file: bool = True) -> None:
    """Clean and rejected records in one pass, as ``outcome=clean`` and ``outcome=reject``.

    With ``per_file`` each holds a folder ``source=<name>`` for every feed file; files
    of one name from several folders share theirs. A task writes one file for each feed
    file and outcome it has records of, and tasks have the records of few feed files.
    """
    outcome = F.when(F.col("verdict").isin(*BAD_VERDICTS), "reject").otherwise("clean")
    rows = records.select(F.coalesce("fixed", "record").alias("value"), outcome.alias("outcome"), F.element_at(F.split("path", "/"), -1).alias("source"))
    places = ["outcome", "source"] if per_file else ["outcome"]
    rows.select("value", *places).write.mode("overwrite").partitionBy(*places).text(path, compression=compression)
