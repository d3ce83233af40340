"""Repair of feed lines: records broken over lines, shifted or of wrong width.

A record ends at the line on which its tabs reach the width of the file, so the
end of one record depends on where the record before ended. To do that without
reading a file in one task, and without moving text:

1. lines are stored with their tab counts in a table bucketed by chunk, so that
   whatever concerns one chunk later happens where its lines lie;
2. each chunk reports, for the record open at its start, on which line it may
   end and which record is open at the chunk's end in each case;
3. one pass per file over these reports gives the state at each chunk's start
   (a report holds a few numbers per line of the chunk's first record);
4. each chunk then knows where all its records begin and end. It keeps one row:
   a bit for each line of a record over several lines, and one for each first line.

Only line lengths and tab counts pass through Python. Single-line records, nearly
all, are read from the table past those bits; only lines of other records move.
"""

from __future__ import annotations

import sys
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hitloom.session import checkpoint_folder

# The Arrow functions below travel with the job: executors need not have this
# package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Hit time and the two hit ids next to each other.
ANCHOR_PATTERN = r"(?:^|\t)[0-9]{10}\t[0-9]{10,20}\t[0-9]{10,20}(?=\t|\z)"
ANCHOR_FIELD = 317  # zero-based field of the hit time
ANCHOR_RANGE = 5
MAX_RECORD_CHARS = 64 * 1024 * 1024
MAX_TAB_FACTOR = 8
PADDING_TOLERANCE = 3
# Verdicts on records that are not repaired.
BAD_VERDICTS = ("fragment", "reject", "oversize", "no_width")
LINE_BREAK = "\\n"
CHUNK_BITS = 17  # chunks of at most 2 ** 17 lines
CHUNK = ("path", "block", "part")


def count_tabs(col: Column) -> Column:
    return F.length(col) - F.length(F.replace(col, F.lit("\t"), F.lit("")))


# -- lines ---------------------------------------------------------------------


def read_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Lines with their file and their place in it; read in file order."""
    return spark.read.text(paths if isinstance(paths, str) else list(paths)).select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
        "value",
    )


def find_anchors(lines: DataFrame, count_all: bool = True) -> DataFrame:
    """Adds ``tabs`` and ``anchors``: tabs of the line before each anchor's time.

    With ``count_all=False`` the tabs inside an anchor match are not counted, as
    the original width discovery does; widths then come out three too small.
    """
    text = F.translate("value", "\r", "")
    between = F.transform(F.split("_text", ANCHOR_PATTERN, -1), count_tabs)
    # An anchor spans two inner tabs, and a leading one unless it opens the line.
    leading = F.transform(
        F.regexp_extract_all("_text", F.lit(ANCHOR_PATTERN), F.lit(0)),
        lambda match: F.when(match.startswith("\t"), 1).otherwise(0),
    )
    if count_all:
        positions = F.transform(
            "_leading",
            lambda lead, i: lead
            + F.aggregate(F.slice("_between", 1, i + 1), F.lit(0), lambda a, x: a + x)
            + F.aggregate(F.slice("_leading", 1, i), F.lit(0), lambda a, x: a + x + 2),
        )
        tabs = count_tabs(F.col("_text"))
    else:
        positions = F.transform(
            "_leading", lambda lead, i: F.aggregate(F.slice("_between", 1, i + 1), F.lit(0), lambda a, x: a + x)
        )
        tabs = F.aggregate("_between", F.lit(0), lambda a, x: a + x)
    return (
        lines.withColumn("_text", text)
        .select("*", between.alias("_between"), leading.alias("_leading"))
        .select(*lines.columns, F.col("_text").alias("text"), tabs.alias("tabs"), positions.alias("anchors"))
    )


@dataclass
class FeedStore:
    """The tables of one repair, in a folder that all executors reach."""

    name: str
    path: str
    buckets: int

    def write(self, df: DataFrame, part: str) -> DataFrame:
        """A table of the store, bucketed by chunk without a shuffle."""
        table = f"{self.name}_{part}"
        writer = df.write.mode("overwrite").format("parquet").option("path", f"{self.path}/{part}")
        writer.bucketBy(self.buckets, *CHUNK).saveAsTable(table)
        return df.sparkSession.table(table)

    def drop(self, spark: SparkSession) -> None:
        """Remove the tables and their files; frames that read them end here."""
        for part in ("lines", "chunks"):
            spark.sql(f"DROP TABLE IF EXISTS {self.name}_{part}")
        target = spark._jvm.org.apache.hadoop.fs.Path(self.path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def index_lines(
    lines: DataFrame,
    chunk_bits: int = CHUNK_BITS,
    store: str | None = None,
    count_all: bool = True,
    buckets: int | None = None,
    anchors: bool = True,
) -> DataFrame:
    """Lines with chunk and position, stored so that later steps agree on them.

    (``block``, ``row``) orders the lines of a file. ``row`` grows by one per line
    within a read task, so its upper bits cut a task's lines into chunks without a
    shuffle. ``store`` is a new folder in a shared file system, by default one in the
    checkpoint folder; the returned frame has it as ``feed_store``, whose ``drop``
    removes it. ``buckets`` defaults to ``spark.sql.shuffle.partitions``. Without
    ``anchors`` (the widths are known) no anchor is searched.
    """
    spark, ident = lines.sparkSession, uuid.uuid4().hex
    path = store or f"{checkpoint_folder(spark).rstrip('/')}/feed-{ident}"
    held = FeedStore(f"feed_{ident}", path, buckets or int(spark.conf.get("spark.sql.shuffle.partitions")))
    if anchors:
        found = find_anchors(lines, count_all)
    else:
        text = F.translate("value", "\r", "")
        found = lines.select(*lines.columns, text.alias("text")).select(
            "*", count_tabs(F.col("text")).alias("tabs"), F.array().cast("array<int>").alias("anchors")
        )
    indexed = held.write(
        found.select(
            "path",
            "block",
            F.shiftright("row", chunk_bits).alias("part"),
            "row",
            "text",
            "tabs",
            F.length("text").alias("chars"),
            "anchors",
        ),
        "lines",
    )
    indexed.feed_store = held
    return indexed


# -- width ---------------------------------------------------------------------


def tab_histogram(indexed: DataFrame) -> DataFrame:
    """How often each tab distance between consecutive anchors occurs, per file.

    Distances inside a chunk need that chunk only. Those across chunks come from
    a table with one row per chunk.
    """
    by_line = Window.partitionBy(*CHUNK).orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    placed = indexed.select(
        *CHUNK, "row", "tabs", "anchors", F.coalesce(F.sum("tabs").over(by_line), F.lit(0)).alias("_before")
    )
    anchored = placed.filter(F.size("anchors") > 0).select(
        *CHUNK, "row", F.transform("anchors", lambda a: a + F.col("_before")).alias("at")
    )
    in_chunk = Window.partitionBy(*CHUNK).orderBy("row")
    steps = anchored.select(
        "path",
        "at",
        F.lag(F.element_at("at", -1)).over(in_chunk).alias("_last"),
    ).select(
        "path",
        F.explode(
            F.transform("at", lambda a, i: a - F.when(i == 0, F.col("_last")).otherwise(F.get("at", i - 1)))
        ).alias("delta"),
    )
    ends = placed.groupBy(*CHUNK).agg(
        F.sum("tabs").alias("_tabs"),
        F.min(F.when(F.size("anchors") > 0, F.col("_before") + F.get("anchors", 0))).alias("_first"),
        F.max(F.when(F.size("anchors") > 0, F.col("_before") + F.element_at("anchors", -1))).alias("_final"),
    )
    by_chunk = Window.partitionBy("path").orderBy("block", "part").rowsBetween(Window.unboundedPreceding, -1)
    shifted = ends.select("*", F.coalesce(F.sum("_tabs").over(by_chunk), F.lit(0)).alias("_shift"))
    across = shifted.select(
        "path",
        (
            F.col("_first") + F.col("_shift") - F.last(F.col("_final") + F.col("_shift"), ignorenulls=True).over(by_chunk)
        ).alias("delta"),
    )
    return (
        steps.unionByName(across)
        .filter(F.col("delta").isNotNull())
        .groupBy("path", "delta")
        .agg(F.count(F.lit(1)).alias("records"))
    )


def canonical_tabs(histogram: DataFrame) -> DataFrame:
    """The most frequent distance per file, the larger one on a tie."""
    best = F.max(F.struct("records", "delta"))
    return histogram.groupBy("path").agg(best.alias("_best")).select("path", F.col("_best.delta").alias("width"))


# -- records -------------------------------------------------------------------


class _Chunk:
    """Lines of one chunk in file order, as arrays, and what all of them share, as ``same``."""

    def __init__(self, same: dict, rows: np.ndarray, tabs: np.ndarray, chars: np.ndarray, max_chars: int):
        self.same, self.width, self.rows = same, same["width"], rows
        self.place = {name: same[name] for name in (*CHUNK, "width")}
        self.count = len(self.rows)
        self.filled = chars > 0
        # Running tabs and characters; a line added to a record brings a break.
        self.tabs = np.cumsum(tabs)
        self.chars = np.cumsum(np.where(self.filled, chars + len(LINE_BREAK), 0))
        # For a record whose first line is i: the line that closes it, or count.
        before_tabs = np.concatenate(([0], self.tabs[:-1]))
        before_chars = np.concatenate(([0], self.chars[:-1]))
        by_tabs = np.searchsorted(self.tabs, before_tabs + self.width, side="left")
        by_chars = np.searchsorted(self.chars, before_chars + max_chars + len(LINE_BREAK), side="right")
        self.close = np.maximum(np.minimum(by_tabs, by_chars), np.arange(self.count)).tolist()
        # The first filled line at or after i, or count.
        spots = np.where(self.filled, np.arange(self.count), self.count)
        self.next_filled = np.minimum.accumulate(spots[::-1])[::-1].tolist()

    def open_record(self, start: int) -> tuple[int, int, int]:
        """Row, tabs and characters of a record from ``start`` to the chunk's end."""
        if start >= self.count or self.next_filled[start] >= self.count:
            return -1, 0, 0
        tabs, chars = (int(self.tabs[start - 1]), int(self.chars[start - 1])) if start else (0, 0)
        size = int(self.chars[-1]) - chars - len(LINE_BREAK)
        return int(self.rows[self.next_filled[start]]), int(self.tabs[-1]) - tabs, size


def _open_starts(starts: Sequence[int], close: list[int]) -> dict[int, int]:
    """For each start line: first line of the record open at the chunk's end."""
    count = len(close)
    known: dict[int, int] = {count: count}
    for start in starts:
        trail, at = [], start
        while at not in known:
            if close[at] >= count:
                known[at] = at
                break
            trail.append(at)
            at = close[at] + 1
        for passed in trail:
            known[passed] = known[at]
    return known


_LINE = ("row", "tabs", "chars")


def _in_chunks(lines: DataFrame, give: Callable[[_Chunk], dict], kinds: pa.Schema, schema: str, max_chars: int) -> DataFrame:
    """``give`` for each chunk of the lines; its dicts become rows of ``schema``.

    A number along the chunk brings the lines of each together, in order. Chunks can be
    small and many, so they pass through Python in batches of lines, not each by itself.
    """
    numbered = lines.withColumn("nth", F.row_number().over(Window.partitionBy(*CHUNK).orderBy("row")))

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[list[_Chunk]]:
        same, parts = None, []

        def finished() -> list[_Chunk]:
            return [_Chunk(same, *map(np.concatenate, zip(*parts)), max_chars)] if parts else []

        for batch in batches:
            out, columns = [], [batch.column(name).to_numpy(zero_copy_only=False) for name in _LINE]
            firsts = np.flatnonzero(batch.column("nth").to_numpy() == 1).tolist()
            shared = batch.drop_columns([*_LINE, "nth"]).take(pa.array(firsts, pa.int64())).to_pylist()
            bounds = [*firsts, batch.num_rows]
            if bounds[0]:
                parts.append([column[: bounds[0]] for column in columns])
            for row, start, end in zip(shared, bounds, bounds[1:]):
                out += finished()
                same, parts = row, [[column[start:end] for column in columns]]
            yield out
        yield finished()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in chunks(batches):
            yield pa.RecordBatch.from_pylist([give(chunk) for chunk in some], kinds)

    return numbered.mapInArrow(run, schema)


_PLACE_TYPES = [("path", pa.string()), ("block", pa.int64()), ("part", pa.int64()), ("width", pa.int32())]
_ENDS = ("end_tabs", "end_chars", "open_row", "open_tabs", "open_chars")
_REPORT = "path string, block bigint, part bigint, width int, tabs bigint, chars bigint, " + ", ".join(
    f"{name} array<bigint>" for name in _ENDS
)
_REPORT_TYPES = pa.schema(
    [*_PLACE_TYPES, ("tabs", pa.int64()), ("chars", pa.int64())] + [(name, pa.list_(pa.int64())) for name in _ENDS]
)


def _report_chunk(c: _Chunk) -> dict:
    """Step 2: what may happen in a chunk to the record open at its start."""
    # Whatever was open, it has ended once this chunk alone fills the width.
    certain = min(int(np.searchsorted(c.tabs, c.width, side="left")), c.count - 1)
    starts = [0, *range(1, certain + 2)]
    opened = _open_starts(starts, c.close)
    # The first entry is the chunk entered with no open record; then one
    # entry per line on which an open record may end.
    ends = [(0, 0, *c.open_record(opened[0]))]
    ends += [(int(c.tabs[i]), int(c.chars[i]), *c.open_record(opened[i + 1])) for i in range(certain + 1)]
    lists = dict(zip(_ENDS, map(list, zip(*ends))))
    return {**c.place, "tabs": int(c.tabs[-1]), "chars": int(c.chars[-1]), **lists}


_STATE = (
    "path string, block bigint, part bigint, width int, open_block bigint, open_row bigint, "
    "open_tabs bigint, open_chars bigint"
)
_STATE_TYPES = pa.schema(
    _PLACE_TYPES
    + [(name, pa.int64()) for name in ("open_block", "open_row", "open_tabs", "open_chars")]
)


def _carry_states(max_chars: int):
    """Step 3: reports of whole files in order -> state at each chunk's start."""

    def carry(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = None
        block, row, tabs, chars = -1, -1, 0, 0
        for batch in batches:
            out = []
            for item in batch.to_pylist():
                if item["path"] != path:
                    path, block, row, tabs, chars = item["path"], -1, -1, 0, 0
                start = (block, row, tabs, chars)
                out.append(dict(zip(_STATE_TYPES.names, (path, item["block"], item["part"], item["width"], *start))))
                end = 0
                if row >= 0:
                    passed = zip(item["end_tabs"][1:], item["end_chars"][1:])
                    closing = (tabs + t >= item["width"] or chars + n > max_chars for t, n in passed)
                    end = next((i for i, closes in enumerate(closing, start=1) if closes), None)
                if end is None:
                    # Still the same record: nothing in this chunk closed it.
                    tabs, chars = tabs + item["tabs"], chars + item["chars"]
                elif item["open_row"][end] < 0:
                    block, row, tabs, chars = -1, -1, 0, 0
                else:
                    block = item["block"]
                    row, tabs, chars = (item[name][end] for name in ("open_row", "open_tabs", "open_chars"))
            yield pa.RecordBatch.from_pylist(out, _STATE_TYPES)

    return carry


_PLACES = (
    "path string, block bigint, part bigint, width int, first_row bigint, members array<bigint>, "
    "firsts array<bigint>, open_block bigint, open_row bigint"
)


_PLACES_TYPES = pa.schema(
    [*_PLACE_TYPES, ("first_row", pa.int64()), ("members", pa.list_(pa.int64())), ("firsts", pa.list_(pa.int64()))]
    + [("open_block", pa.int64()), ("open_row", pa.int64())]
)


def _bits(offsets: np.ndarray) -> np.ndarray | None:
    """Longs with the bits of these offsets, or None without any."""
    if not len(offsets):
        return None
    marked = np.zeros((int(offsets[-1]) // 64 + 1) * 64, dtype=np.uint8)
    marked[offsets] = 1
    return np.packbits(marked, bitorder="little").view("<i8")


def _place_records(max_chars: int):
    """Step 4: which lines of a chunk belong to records over several lines, and which begin one.

    A record that is not closed by one filled line of this chunk counts as such.
    """

    def place(c: _Chunk) -> dict:
        open_block, open_row, open_tabs, open_chars = (
            c.same[name] for name in ("open_block", "open_row", "open_tabs", "open_chars")
        )
        member, first_of = c.filled.copy(), np.zeros(c.count, dtype=bool)
        filled_to = np.cumsum(c.filled).tolist()
        at = 0
        if open_row >= 0:
            full = int(np.searchsorted(c.tabs, c.width - open_tabs, side="left"))
            over = int(np.searchsorted(c.chars, max_chars - open_chars, side="right"))
            at = min(full, over, c.count - 1) + 1
        while at < c.count:
            end, first = min(c.close[at], c.count - 1), c.next_filled[at]
            if first <= end:
                alone = c.close[at] < c.count and filled_to[end] == filled_to[first]
                member[first], first_of[first] = not alone, not alone
            at = end + 1
        offsets = c.rows - c.rows[0]
        members, firsts = (_bits(offsets[np.flatnonzero(marks)]) for marks in (member, first_of))
        marks = {"first_row": int(c.rows[0]), "members": members, "firsts": firsts}
        return {**c.place, **marks, "open_block": open_block, "open_row": open_row}

    return place


def _by_chunk(lines: DataFrame, chunks: DataFrame, how: str = "inner") -> DataFrame:
    """Lines with the row of their chunk, joined where the lines lie.

    A bucket has few chunks, so their rows make a small hash table past which the
    lines stream; they are neither shuffled nor sorted.
    """
    return lines.join(chunks.hint("shuffle_hash"), list(CHUNK), how)


def place_chunks(indexed: DataFrame, widths: DataFrame, max_chars: int = MAX_RECORD_CHARS) -> DataFrame:
    """Stored steps 2 to 4: one row per chunk of a file with a width above zero."""
    # Widths come by file; chunks are few, lines are not.
    sized = indexed.select(*CHUNK).distinct().join(known_widths(widths), "path")
    narrow = indexed.select(*CHUNK, "row", "tabs", "chars")
    reports = _in_chunks(_by_chunk(narrow, sized), _report_chunk, _REPORT_TYPES, _REPORT, max_chars)
    states = (
        reports.repartition("path").sortWithinPartitions(*CHUNK).mapInArrow(_carry_states(max_chars), _STATE)
    )
    placed = _in_chunks(_by_chunk(narrow, states), _place_records(max_chars), _PLACES_TYPES, _PLACES, max_chars)
    return indexed.feed_store.write(placed, "chunks")


def assemble_records(indexed: DataFrame, widths: DataFrame, max_chars: int = MAX_RECORD_CHARS) -> DataFrame:
    """Whole records of each file with the number of their tabs.

    ``indexed`` comes from `index_lines`, ``widths`` has one row per file. A record that
    outgrows ``max_chars`` or eight widths ends right there and is marked ``oversize``.
    In a file without a width above zero each line that is not empty is a record of its
    own, with a NULL width. The chunk table is written at once, the records are lazy and
    read the store.
    """
    chunks = place_chunks(indexed, widths, max_chars)
    lines = indexed.select(*CHUNK, "row", "text", "tabs", "chars")
    offset = F.col("row") - F.col("first_row")

    def marked(bits: str) -> Column:
        word = F.get(bits, F.shiftright(offset, 6).cast("int"))
        return F.coalesce(F.getbit(word, (offset % 64).cast("int")) == 1, F.lit(False))

    too_large = (F.length("record") > max_chars) | (F.col("tabs") > F.col("width") * MAX_TAB_FACTOR)
    alone = _by_chunk(lines, chunks.select(*CHUNK, "width", "first_row", "members"), "left")
    single = alone.filter((F.col("chars") > 0) & ~marked("members")).selectExpr(
        "path", "block AS record_block", "row AS record_row", "text AS record", "CAST(tabs AS BIGINT) AS tabs", "width"
    )
    broken = _by_chunk(lines, chunks.filter("members IS NOT NULL"))
    before = Window.partitionBy(*CHUNK).orderBy("row").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    owned = broken.filter(marked("members")).select(
        *CHUNK, "row", "text", "tabs", "width", "open_block", "open_row",
        F.last(F.when(marked("firsts"), F.col("row")), ignorenulls=True).over(before).alias("own_row"),
    )
    ordered = F.array_sort(F.collect_list(F.struct("block", "row", "text")))
    joined = (
        owned.withColumn("record_block", F.when(F.col("own_row").isNull(), F.col("open_block")).otherwise(F.col("block")))
        .withColumn("record_row", F.coalesce("own_row", "open_row"))
        .groupBy("path", "record_block", "record_row")
        .agg(
            F.array_join(F.transform(ordered, lambda line: line["text"]), LINE_BREAK).alias("record"),
            F.sum("tabs").alias("tabs"),
            F.max("width").alias("width"),
        )
    )
    oversize = F.when(F.col("width").isNull(), False).otherwise(too_large)
    records = single.unionByName(joined).select("*", oversize.alias("oversize"))
    records.feed_store = indexed.feed_store
    return records


def known_widths(widths: DataFrame) -> DataFrame:
    return widths.filter("width > 0").select("path", F.col("width").cast("int").alias("width"))


def require_widths(indexed: DataFrame, widths: DataFrame, named: int = 20) -> None:
    """Raise if a file has no width, naming the first ``named`` such files."""
    lost = indexed.select("path").distinct().join(known_widths(widths), "path", "left_anti")
    paths = [row.path for row in lost.orderBy("path").limit(named).collect()]
    if paths:
        raise ValueError(f"no record width was found in {', '.join(paths)}; give one, or reject their lines")


# -- verdicts ------------------------------------------------------------------


def is_fragment(tabs: Column, width: Column) -> Column:
    return (tabs < 10) | (tabs < F.floor(width * 0.6))


def _fit(fields: Column, size: Column) -> Column:
    """Exactly ``size`` fields: cut, or filled up with empty ones."""
    missing = F.greatest(size - F.size(fields), F.lit(0))
    return F.concat(F.slice(fields, 1, size), F.array_repeat(F.lit(""), missing))


def anchor_shift(fields: Column, anchor_field: int = ANCHOR_FIELD, search: int = ANCHOR_RANGE) -> Column:
    """How far the anchor is from its place, leftmost first; NULL without one."""
    tests = ((0, r"^[0-9]{10}\z"), (1, r"^[0-9]{10,20}\z"), (2, r"^[0-9]{10,20}\z"))

    def anchored(offset: Column) -> Column:
        found = [F.coalesce(F.get(fields, offset + anchor_field + i).rlike(p), F.lit(False)) for i, p in tests]
        return found[0] & found[1] & found[2]

    low = -min(search, anchor_field)
    return F.get(F.filter(F.sequence(F.lit(low), F.lit(search)), anchored), 0)


def realigned(fields: Column, shift: Column, size: Column) -> Column:
    """Fields with the anchor back in place, cut or filled to ``size``."""
    right = _fit(F.slice(fields, F.greatest(shift, F.lit(0)) + 1, F.size(fields)), size)
    left = F.slice(F.concat(F.array_repeat(F.lit(""), F.greatest(-shift, F.lit(0))), fields), 1, size)
    return F.when(shift > 0, right).when(shift < 0, left).when(shift == 0, F.slice(fields, 1, size))


def classify_records(
    records: DataFrame,
    tolerance: int = PADDING_TOLERANCE,
    anchor_field: int = ANCHOR_FIELD,
    search: int = ANCHOR_RANGE,
) -> DataFrame:
    """Adds ``verdict`` and ``fixed`` (the repaired text, NULL for rejects).

    Most records are exact and are not split at all; the search for a shifted
    anchor runs once, and only for records that nothing else explains.
    """
    tabs, width, record = F.col("tabs"), F.col("width"), F.col("record")
    missing = width - tabs
    oversize = F.col("oversize") if "oversize" in records.columns else F.lit(False)
    first = (
        F.when(width.isNull(), "no_width")
        .when(oversize, "oversize")
        .when(missing == 0, "exact")
        .when((missing > 0) & (missing <= tolerance), "pad")
        .when((missing < 0) & (-missing <= tolerance), "trim")
        .when(is_fragment(tabs, width), "fragment")
        .otherwise("search")
    )
    kept = records.columns
    split = F.when(F.col("_first").isin("trim", "search"), F.split(record, "\t", -1))
    shift = F.when(F.col("_first") == "search", anchor_shift(F.col("_fields"), anchor_field, search))
    found = F.when(F.col("_shift").isNotNull(), "realigned").otherwise("reject")
    size = width + 1
    fixed = (
        F.when(F.col("_first") == "exact", record)
        .when(F.col("_first") == "pad", F.concat(record, F.repeat(F.lit("\t"), missing)))
        .when(F.col("_first") == "trim", F.array_join(F.slice("_fields", 1, size), "\t"))
        .when(F.col("_shift").isNotNull(), F.array_join(realigned(F.col("_fields"), F.col("_shift"), size), "\t"))
    )
    return (
        records.withColumn("_first", first)
        .withColumn("_fields", split)
        .withColumn("_shift", shift)
        .select(*kept, F.when(F.col("_first") == "search", found).otherwise(F.col("_first")).alias("verdict"), fixed.alias("fixed"))
    )


def repair_stats(classified: DataFrame) -> DataFrame:
    """Records, good, bad and realigned per file, and in total (NULL path).

    An oversize record counts as bad but not as a record. Lines of files without a
    width are bad records.
    """
    verdict = F.col("verdict")
    bad = verdict.isin(*BAD_VERDICTS)
    return classified.rollup("path").agg(
        F.count_if(verdict != "oversize").alias("records"),
        F.count_if(~bad).alias("ok"),
        F.count_if(bad).alias("bad"),
        F.count_if(verdict == "realigned").alias("realigned"),
    )


def repair_files(
    spark: SparkSession,
    paths: str | Sequence[str],
    width: int | None = None,
    tolerance: int = PADDING_TOLERANCE,
    anchor_field: int = ANCHOR_FIELD,
    search: int = ANCHOR_RANGE,
    max_chars: int = MAX_RECORD_CHARS,
    store: str | None = None,
    missing_width: str = "error",
) -> DataFrame:
    """Classified records of all files; the width is discovered unless given.

    A file in which none is found is an error, or with ``missing_width="reject"`` all
    its lines are rejects with the verdict ``no_width``. The records read the line
    store; remove it with ``records.feed_store.drop(spark)`` when they are no longer
    needed, or use `repaired`, which does.
    """
    if missing_width not in ("error", "reject"):
        raise ValueError("missing_width is 'error' or 'reject'")
    indexed = index_lines(read_lines(spark, paths), store=store, anchors=width is None)
    try:
        if width is None:
            # One small row per file, kept so that the anchors are read once.
            found = canonical_tabs(tab_histogram(indexed))
            found.write.parquet(f"{indexed.feed_store.path}/widths")
            widths = spark.read.schema(found.schema).parquet(f"{indexed.feed_store.path}/widths")
            if missing_width == "error":
                require_widths(indexed, widths)
        else:
            widths = indexed.select("path").distinct().withColumn("width", F.lit(width))
        assembled = assemble_records(indexed, widths, max_chars)
    except Exception:
        indexed.feed_store.drop(spark)
        raise
    records = classify_records(assembled, tolerance, anchor_field, search)
    records.feed_store = indexed.feed_store
    return records


@contextmanager
def repaired(spark: SparkSession, paths: str | Sequence[str], **options) -> Iterator[DataFrame]:
    """The records of `repair_files` for a ``with`` block, at whose end the line store goes."""
    records = repair_files(spark, paths, **options)
    try:
        yield records
    finally:
        records.feed_store.drop(spark)
