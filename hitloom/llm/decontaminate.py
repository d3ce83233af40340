"""Benchmark decontamination over a distributed positional inverted index.

1. Items are cut into windows of consecutive words; equal items are one class.
2. One pass over the documents counts how often each benchmark word occurs there.
   The two rarest words of each window are its search terms.
3. The index: a second pass stores the postings (word, text, position) of the search
   terms. Equal texts are one entry, so copies are searched once.
4. Postings are shifted by the word's offset in the item; lists of one (text, item)
   are intersected by grouping on the shifted position: a window can only occur
   where both its rarest words agree on it.
5. Texts with such a place are read again and their words compared with the item's,
   which gives the exact phrase matches.

Common words never enter the index unless a window has nothing rarer. The benchmark
sides are small tables; Spark broadcasts them if they are below its threshold and
otherwise joins by word, splitting hot words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hitloom.llm import common

WINDOW = 10
RAREST = 2
_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Words as written: runs of letters, digits and non-ASCII characters."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(_WORD), F.lit(0))


def lowered(text: Column) -> Column:
    return F.transform(words(text), common.ascii_lower)


def item_classes(items: DataFrame, item_id: str = "item_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """Distinct word sequences (``item``, ``words``) and the ids of each (``item``, ``item_id``)."""
    listed = items.select(F.col(item_id).alias("item_id"), lowered(F.col(text)).alias("words")).where(F.size("words") > 0)
    listed = listed.withColumn("item", common.text_key(F.concat_ws(" ", "words")))
    # A class of copies keeps one word list.
    return listed.select("item", "words").dropDuplicates(["item"]), listed.select("item", "item_id").distinct()


def term_counts(docs: DataFrame, terms: DataFrame, text: str = "text") -> DataFrame:
    """How often each of ``terms`` (column ``term``) occurs in the documents."""
    tokens = docs.select(F.explode(words(F.col(text))).alias("word")).select(common.ascii_lower(F.col("word")).alias("term"))
    return tokens.join(terms.select("term").distinct(), "term").groupBy("term").agg(F.count("*").alias("n"))


def search_terms(classes: DataFrame, counts: DataFrame, window: int = WINDOW, rarest: int = RAREST) -> DataFrame:
    """``item``, ``place``, ``term``: the rarest words of each window that can occur at all.

    Ties go to the smaller word, then to the earlier place. Windows with a word that
    no document has are left out.
    """
    placed = classes.select("item", F.size("words").alias("length"), F.posexplode("words").alias("place", "term"))
    counted = placed.join(counts, "term", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    last = F.greatest(F.col("length") - window, F.lit(0))
    first = F.greatest(F.col("place") - window + 1, F.lit(0))
    starts = F.sequence(first, F.least(F.col("place"), last))
    slots = counted.where(first <= F.least(F.col("place"), last)).withColumn("start", F.explode(starts))
    per_window = Window.partitionBy("item", "start")
    ranked = slots.withColumn("rank", F.row_number().over(per_window.orderBy("n", "term", "place")))
    ranked = ranked.withColumn("least", F.min("n").over(per_window))
    return ranked.where((F.col("rank") <= rarest) & (F.col("least") > 0)).select("item", "place", "term").distinct()


def posting_index(docs: DataFrame, terms: DataFrame, text: str = "text") -> DataFrame:
    """Stored postings ``term``, ``text_key``, ``position`` of the terms asked for."""
    tokens = docs.select(common.text_key(F.col(text)).alias("text_key"), F.posexplode(words(F.col(text))).alias("position", "word"))
    tokens = tokens.select(common.ascii_lower(F.col("word")).alias("term"), "text_key", "position")
    found = tokens.join(terms.select("term").distinct(), "term")
    return common.store(found.distinct(), "postings")


def aligned(index: DataFrame, searched: DataFrame, slack: int = 0) -> DataFrame:
    """Offset-adjusted lists, intersected: ``item``, ``text_key``, ``shift``, ``places``, ``first``.

    ``shift`` is where the item's first word would stand in the text. With ``slack``
    the postings may disagree by that many words: each posting enters every band of
    ``slack + 1`` shifts that holds its own, so a band holds just the postings whose
    shifts differ by at most ``slack``. ``first`` is the least shift in the band.
    """
    lists = index.join(searched, "term").withColumn("own", F.col("position") - F.col("place"))
    bands = F.explode(F.sequence(F.col("own") - slack, F.col("own"))) if slack else F.col("own")
    lists = lists.withColumn("shift", bands)
    return lists.groupBy("item", "text_key", "shift").agg(F.collect_set("place").alias("places"), F.min("own").alias("first"))


def phrase_matches(docs: DataFrame, classes: DataFrame, index: DataFrame, searched: DataFrame, text: str = "text", window: int = WINDOW) -> DataFrame:
    """``text_key``, ``item``, ``hits``: word positions inside exact windows of an item, per place it stands."""
    lists = aligned(index, searched)
    sized = classes.withColumn("need", F.least(F.size("words"), F.lit(RAREST)))
    candidates = lists.join(sized, "item").where(F.size("places") >= F.col("need"))
    candidates = common.store(candidates.select("text_key", "item", "shift", F.col("words").alias("item_words")), "candidates")
    keys = common.bounded(candidates.select("text_key"))
    texts = docs.select(common.text_key(F.col(text)).alias("text_key"), F.col(text).alias("text"))
    texts = texts.join(keys, "text_key", "left_semi").dropDuplicates(["text_key"])
    texts = texts.select("text_key", lowered(F.col("text")).alias("doc_words"))
    both = candidates.join(texts, "text_key")
    length = F.least(F.size("item_words"), F.lit(window))

    def same(start: Column) -> Column:
        here = F.col("shift") + start
        return (here >= 0) & (F.slice("doc_words", F.greatest(here, F.lit(0)) + 1, length) == F.slice("item_words", start + 1, length))

    starts = F.filter(F.sequence(F.lit(0), F.size("item_words") - length), same)
    hits = F.flatten(F.transform(starts, lambda s: F.sequence(F.col("shift") + s, F.col("shift") + s + length - 1)))
    return both.select("text_key", "item", F.array_distinct(hits).alias("hits")).where(F.size("hits") > 0)


def proximity_matches(docs: DataFrame, items: DataFrame, slack: int = 3, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """Texts in which all words of an item stand near their places.

    ``text_key``, ``item_id``, ``near``: the first word position from which postings of
    every word of the item stand where they should, each at most ``slack`` words late.
    Works on the index alone, for items of any length. Null and empty texts and items
    match nothing; repeated texts give one row.
    """
    classes, members = item_classes(items, item_id, text)
    searched = classes.select("item", F.posexplode("words").alias("place", "term"))
    index = posting_index(docs, searched, text)
    found = aligned(index, searched, slack).join(classes, "item").where(F.size("places") == F.size("words"))
    nearest = found.groupBy("text_key", "item").agg(F.min("first").alias("near"))
    return nearest.join(members, "item").select("text_key", "item_id", "near")


def contamination(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", window: int = WINDOW) -> DataFrame:
    """Which documents hold passages of which items.

    Returns per row ``doc_id``, ``n_words``, ``n_hit`` (words inside any occurrence of
    a window), ``n_items``, ``items_sha256`` (of the sorted, comma-joined ids) and
    ``contaminated``. An item of fewer words than a window is one window. Null and
    empty texts have no words and no hits, also as items; ids may be null or repeat
    (null item ids count as no item); other columns are ignored.
    """
    classes, members = item_classes(items, item_id, text)
    classes, members = common.store(classes, "items"), common.store(members, "item-ids")
    vocabulary = common.store(classes.select(F.explode("words").alias("term")).distinct(), "vocabulary")
    counts = common.store(term_counts(docs, vocabulary, text), "term-counts")
    searched = common.store(search_terms(classes, counts, window), "search-terms")
    index = posting_index(docs, common.store(searched.select("term").distinct(), "terms"), text)
    matches = common.store(phrase_matches(docs, classes, index, searched, text, window), "matches")
    hits = matches.groupBy("text_key").agg(F.size(F.array_distinct(F.flatten(F.collect_list("hits")))).alias("n_hit"))
    named = matches.select("text_key", "item").distinct().join(members, "item").groupBy("text_key")
    named = named.agg(F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("ids"))
    found = hits.join(named, "text_key", "left")
    found = found.select("text_key", "n_hit", F.size("ids").alias("n_items"), F.sha2(F.concat_ws(",", "ids"), 256).alias("items_sha256"))
    found = common.store(found, "contaminated-texts")
    rows = docs.select(
        F.col(doc_id).alias("doc_id"),
        common.text_key(F.col(text)).alias("text_key"),
        F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(_WORD)).cast("long").alias("n_words"),
    )
    zero = F.lit(0).cast("long")
    return rows.join(found, "text_key", "left").select(
        "doc_id",
        "n_words",
        F.coalesce(F.col("n_hit").cast("long"), zero).alias("n_hit"),
        F.coalesce(F.col("n_items").cast("long"), zero).alias("n_items"),
        F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"),
        (F.coalesce(F.col("n_hit"), zero) > 0).alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", window: int = WINDOW) -> DataFrame:
    """The rows, with all columns, whose text holds no window of any item."""
    classes, _ = item_classes(items, item_id, text)
    classes = common.store(classes, "items")
    vocabulary = common.store(classes.select(F.explode("words").alias("term")).distinct(), "vocabulary")
    counts = common.store(term_counts(docs, vocabulary, text), "term-counts")
    searched = common.store(search_terms(classes, counts, window), "search-terms")
    index = posting_index(docs, common.store(searched.select("term").distinct(), "terms"), text)
    hit = common.bounded(phrase_matches(docs, classes, index, searched, text, window).select("text_key"))
    keyed = docs.withColumn("__text_key", common.text_key(F.col(text)))
    return keyed.join(hit, keyed["__text_key"] == hit["text_key"], "left_anti").drop("__text_key")
