"""Benchmark passages in a corpus, found with a stored positional inverted index."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from monthmill.llm.tables import ascii_lower, numbered, small_side, stored

#: Words of benchmark items that are looked up at a time; their tables are then small enough to send to all executors.
BLOCK_WORDS = 200_000
#: Text positions per block when postings meet candidates.
_BLOCK = 64
#: Anything but a word character; A-Z are lowered after the split.
_BREAK = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


class Index(NamedTuple):
    """Stored postings (row, term, position) of the terms of one block, documents (row, key, n_words), and the block's items."""

    postings: DataFrame
    documents: DataFrame
    items: DataFrame
    frequencies: DataFrame


def words_of(text: Column) -> Column:
    """The words of a text in order, A-Z lowered; null has none."""
    return F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), _BREAK), ascii_lower), lambda w: w != "")


def item_words(items: DataFrame, item: str = "item_id", text: str = "text") -> DataFrame:
    """(item, at, word, n) for each word of each distinct item; items without words have no rows."""
    words = items.select(F.coalesce(F.col(item).cast("string"), F.lit("null")).alias("item_id"), words_of(F.col(text)).alias("words")).distinct()
    numbered = words.filter(F.size("words") > 0).select(F.xxhash64("item_id", "words").alias("item"), "item_id", "words")
    return numbered.select("item", "item_id", F.size("words").alias("n"), F.posexplode("words").alias("at", "word"))


def index(docs: DataFrame, words: DataFrame, *, key: str = "doc_id", text: str = "text", row: str | None = None) -> Index:
    """A positional inverted index of the corpus for the terms of ``words`` (from ``item_words``).

    One pass over the texts: each word position that holds such a term becomes a
    posting, stored in text order without a shuffle. An extra posting of term 0
    per document carries its number of words. ``row`` names a column that
    numbers the documents already.
    """
    words = stored(words, "items")
    terms = stored(words.select("word").distinct().withColumn("term", F.row_number().over(Window.orderBy("word"))), "terms")
    known = terms.unionByName(terms.sparkSession.createDataFrame([("", 0)], terms.schema))
    parts = F.split(F.coalesce(F.col(text), F.lit("")), _BREAK)
    whole = docs.select((F.col(row) if row else F.monotonically_increasing_id()).alias("row"), F.col(key).alias("key"), parts.alias("parts"))
    lead, trail = F.element_at("parts", 1) == "", F.element_at("parts", -1) == ""
    sized = whole.select("row", "key", "parts", lead.cast("int").alias("lead"), F.greatest(F.lit(0), F.size("parts") - lead.cast("int") - trail.cast("int")).alias("n_words"))
    each = sized.select("row", "key", "lead", "n_words", F.posexplode(F.concat("parts", F.array(F.lit("")))).alias("at", "part"))
    # Empty parts at the ends of a text are no words; the last one is the extra posting.
    last = F.col("at") == F.col("n_words") + F.col("lead") + F.when(F.col("n_words") == 0, 1 - F.col("lead")).otherwise(0)
    named = each.select("row", "key", F.when(F.col("part") == "", F.col("n_words")).otherwise(F.col("at") - F.col("lead")).alias("at"), ascii_lower(F.col("part")).alias("word"), ((F.col("part") != "") | last).alias("real")).filter("real")
    postings = stored(named.join(F.broadcast(known), "word").select("row", "key", "term", "at"), "postings")
    documents = postings.filter("term = 0").groupBy("row").agg(F.min("key").alias("key"), F.max("at").cast("long").alias("n_words"))
    real = postings.filter("term <> 0").select("row", "term", "at")
    frequencies = stored(real.groupBy("term").count(), "frequencies")
    return Index(real, documents, stored(words.join(F.broadcast(terms), "word").select("item", "item_id", "n", "at", "term"), "item-terms"), frequencies)


def windows(found: Index, length: int) -> DataFrame:
    """(item, start, size, rank, place, term) for the words of each window of ``length`` words, rarest first.

    An item of fewer words is one window. Windows with a term that the corpus
    lacks cannot occur and are left out.
    """
    items = found.items.withColumn("size", F.least("n", F.lit(length)))
    first = F.greatest(F.lit(0), F.col("at") - F.col("size") + 1)
    spread = items.select("item", "size", "at", "term", F.explode(F.sequence(first, F.least("at", F.col("n") - F.col("size")))).alias("start"))
    rated = spread.join(F.broadcast(found.frequencies), "term", "left")
    window = Window.partitionBy("item", "start")
    rank = F.row_number().over(window.orderBy(F.col("count"), "at"))
    whole = F.count("count").over(window) == F.col("size")
    return rated.select("item", "start", "size", F.col("at").alias("place"), "term", rank.alias("rank"), whole.alias("whole")).filter("whole").drop("whole")


def _anchored(found: Index, anchors: DataFrame, slop: int = 0) -> DataFrame:
    """Postings of anchors, offset-adjusted: (row, item, place, base), base being the text position of the item's first word."""
    lists = found.postings.join(F.broadcast(anchors), "term")
    base = F.col("at") - F.col("place")
    if not slop:
        return lists.select("row", "item", "place", base.alias("base"))
    return lists.select("row", "item", "place", F.explode(F.sequence(base - slop, base + slop)).alias("base"))


def _candidates(found: Index, wins: DataFrame, slop: int = 0) -> DataFrame:
    """(row, item, base) where the lists of a window's two rarest terms meet."""
    rarest = wins.filter("rank = 1").select("item", "start", F.col("term").alias("term"), F.col("place").alias("place"), "size")
    second = wins.filter("rank = 2").select("item", "start", F.col("term").alias("term2"), F.col("place").alias("place2"))
    pairs = stored(rarest.join(second, ["item", "start"], "left").select("item", "term", "place", "term2", "place2").distinct(), "anchors")
    first = _anchored(found, pairs.select("item", "term", "place").distinct())
    alone = first.join(F.broadcast(pairs.filter("term2 is null").select("item", "place").distinct()), ["item", "place"], "left_semi")
    wanted = first.join(F.broadcast(pairs.filter("term2 is not null").select("item", "place", "place2").distinct()), ["item", "place"]).select("row", "item", "base", "place2")
    other = _anchored(found, pairs.filter("term2 is not null").select("item", F.col("term2").alias("term"), F.col("place2").alias("place")).distinct(), slop).withColumnRenamed("place", "place2")
    both = wanted.join(other, ["row", "item", "base", "place2"], "left_semi")
    return both.select("row", "item", "base").union(alone.select("row", "item", "base")).distinct()


def _verified(found: Index, candidates: DataFrame, slop: int = 0) -> DataFrame:
    """(row, item, base, at): the item's words that stand at their place, give or take ``slop``, counted from the base."""
    lengths = found.items.select("item", "n").distinct()
    spans = candidates.join(F.broadcast(lengths), "item")
    low = F.shiftright(F.greatest(F.lit(0), F.col("base") - slop), 6)
    high = F.shiftright(F.greatest(F.lit(0), F.col("base") + F.col("n") - 1 + slop), 6)
    blocked = stored(spans.select("row", "item", "base", F.explode(F.sequence(low, high)).alias("block")), "candidates")
    near = found.postings.withColumn("block", F.shiftright("at", 6)).join(small_side(blocked, 64), ["row", "block"])
    shifts = F.array(*[F.lit(k) for k in range(-slop, slop + 1)])
    placed = near.withColumn("place", F.explode(F.transform(shifts, lambda k: F.col("at") - F.col("base") + k))) if slop else near.withColumn("place", F.col("at") - F.col("base"))
    terms = found.items.select("item", F.col("at").alias("place"), "term")
    return placed.join(F.broadcast(terms), ["item", "place", "term"]).select("row", "item", "base", F.col("place").alias("at")).distinct()


def phrases(found: Index, length: int = 10) -> DataFrame:
    """(row, item, start, end): stretches of documents, end excluded, in which windows of the item occur word for word."""
    exact = _verified(found, _candidates(found, windows(found, length)))
    # Consecutive places at one base form an island; a window occurs where an island is long enough.
    island = F.col("at") - F.row_number().over(Window.partitionBy("row", "item", "base").orderBy("at"))
    runs = exact.withColumn("island", island).groupBy("row", "item", "base", "island").agg(F.min("at").alias("low"), F.count("*").alias("run"))
    sizes = found.items.select("item", F.least("n", F.lit(length)).alias("size")).distinct()
    long = runs.join(F.broadcast(sizes), "item").filter("run >= size")
    return long.select("row", "item", (F.col("base") + F.col("low")).alias("start"), (F.col("base") + F.col("low") + F.col("run")).alias("end"))


def proximity(docs: DataFrame, items: DataFrame, length: int = 10, slop: int = 2, *, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """(key, item_id, start, at): windows of items whose words all stand within ``slop`` places of where the rarest one puts them.

    ``start`` is the window's first word in the item, ``at`` its place in the
    document. With slop 0 these are the exact phrases. One block of items only:
    at most ``BLOCK_WORDS`` words.
    """
    words = item_words(items, item, item_text)
    if words.count() > BLOCK_WORDS:
        raise ValueError(f"more than {BLOCK_WORDS} words of items at a time")
    found = index(docs, words, key=key, text=text)
    wins = windows(found, length)
    near = _verified(found, _candidates(found, wins, slop), slop)
    held = near.join(F.broadcast(wins.select("item", "start", "size", F.col("place").alias("at"))), ["item", "at"])
    full = held.groupBy("row", "item", "base", "start").agg(F.count("*").alias("n"), F.max("size").alias("size")).filter("n = size")
    names = found.items.select("item", "item_id").distinct()
    return full.join(F.broadcast(names), "item").join(found.documents, "row").select(F.col("key").alias(key), "item_id", "start", (F.col("base") + F.col("start")).alias("at"))


def contamination(docs: DataFrame, items: DataFrame, length: int = 10, *, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row per document: row, key, n_words, n_hit (words inside any occurrence of a window), items (sorted item ids).

    Items are worked on in blocks of ``BLOCK_WORDS`` words, so what is sent to
    all executors is bounded however many items there are. Null texts have no
    words; an item without words never occurs; an item of one text and id given
    twice counts once; a null item id is named ``null``. Rows that repeat a key
    are rows of their own. Empty tables: no rows, or no hits.
    """
    words = stored(item_words(items, item, item_text), "items")
    blocks = max(1, -(-words.count() // BLOCK_WORDS))
    stretches, documents = None, None
    row = None
    if blocks > 1:  # every block must number the documents alike
        docs, row = numbered(docs.select(key, text))
    for block in range(blocks):
        found = index(docs, words.filter(F.pmod(F.col("item"), F.lit(blocks)) == block), key=key, text=text, row=row)
        names = found.items.select("item", "item_id").distinct()
        part = phrases(found, length).join(F.broadcast(names), "item").select("row", "item_id", "start", "end")
        documents = documents or found.documents
        stretches = part if stretches is None else stretches.union(part)
    stretches = stored(stretches, "stretches")
    reach = F.max("end").over(Window.partitionBy("row").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.greatest(F.lit(0), F.col("end") - F.greatest("start", F.coalesce(reach, F.lit(0))))
    hits = stretches.select("row", "start", "end").distinct().select("row", fresh.alias("fresh")).groupBy("row").agg(F.sum("fresh").alias("n_hit"))
    listed = stretches.groupBy("row").agg(F.sort_array(F.collect_set("item_id")).alias("items"))
    marked = stored(hits.join(listed, "row"), "hits")
    joined = documents.join(small_side(marked, 256), "row", "left")
    none = F.array().cast("array<string>")
    return joined.select("row", F.col("key").alias(key), "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.coalesce("items", none).alias("items"))


def without_contaminated(docs: DataFrame, items: DataFrame, length: int = 10, *, key: str = "doc_id", **names: str) -> DataFrame:
    """``docs`` without the rows whose text holds a window of an item; decided per row, whatever its key. Other columns are kept as they are."""
    rows, row = numbered(docs)
    bad = stored(contamination(rows, items, length, key=row, **names).filter("n_hit > 0").select(row), "contaminated")
    return rows.join(small_side(bad, 16), row, "left_anti").select(*docs.columns)
