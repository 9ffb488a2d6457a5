"""Ranked lexical search: best-first over document intervals, bounded by range maxima of posting lists."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from monthmill.llm.tables import ascii_lower, buffers, small_side, stored

#: Bytes of query terms that are sent to all tasks at once; more items are searched in further blocks.
BLOCK_BYTES = 4 << 20
#: Documents and postings at which a task closes a shard and searches it.
SHARD_DOCS = 8192
SHARD_POSTINGS = 1 << 20
#: Bytes of text cut into terms at a time.
WINDOW = 8 << 20
#: Intervals of an item that are split at a time, the best ones first.
SPLITS = 16
#: Kept posting ranges at which those of finished intervals are let go.
POOL = 1 << 22
#: Parts of an item's candidates that are ranked apart before the last ranking.
PARTS = 64

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_IN_TERM = np.zeros(256, bool)
for _first, _last in (("0", "9"), ("A", "Z"), ("a", "z"), ("\x80", "\xff")):
    _IN_TERM[ord(_first) : ord(_last) + 1] = True
_FOLDED = np.arange(256, dtype=np.uint8)
_FOLDED[ord("A") : ord("Z") + 1] += 32


def _windows(inside: np.ndarray) -> Iterator[tuple[int, int]]:
    """Parts of a buffer of about ``WINDOW`` bytes that no term crosses."""
    start = 0
    while start < len(inside):
        stop = min(start + WINDOW, len(inside))
        if stop < len(inside) and inside[stop]:
            gaps = np.flatnonzero(~inside[stop : stop + WINDOW])
            while not len(gaps) and stop < len(inside):
                stop += WINDOW
                gaps = np.flatnonzero(~inside[stop : stop + WINDOW])
            stop = min(stop + int(gaps[0]), len(inside)) if len(gaps) else len(inside)
        yield start, stop
        start = stop


def postings(texts: pa.Array, vocabulary: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The terms of a column of texts: (terms of each text, text * len(vocabulary) + term, occurrences), the last two for known terms, sorted."""
    data, ends = buffers(texts)
    inside = _IN_TERM[data]
    n = np.zeros(len(ends) - 1, np.int64)
    found, counts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for start, stop in _windows(inside):
        part = inside[start:stop]
        # A term ends where its text ends.
        cut = ends[np.searchsorted(ends, start) : np.searchsorted(ends, stop)] - start
        opens = part.copy()
        opens[1:] &= ~part[:-1]
        opens[cut] = part[cut]
        begins = np.flatnonzero(opens)
        lengths = np.add.reduceat(part, begins, dtype=np.int64) if len(begins) else begins
        text = np.searchsorted(ends, begins + start, side="right") - 1
        n += np.bincount(text, minlength=len(n))
        offsets = np.concatenate(([0], np.cumsum(lengths)))
        terms = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(begins), [None, pa.py_buffer(offsets), pa.py_buffer(_FOLDED[data[start:stop][part]])])
        known = pc.index_in(terms, value_set=vocabulary).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
        pairs, times = np.unique((text * len(vocabulary) + known)[known >= 0], return_counts=True)
        found.append(pairs)
        counts.append(times)
    pairs, place = np.unique(np.concatenate(found), return_inverse=True)
    return n, pairs, np.bincount(place, np.concatenate(counts), len(pairs)).astype(np.int64)


class RangeMaxima:
    """Sparse tables of the greatest impact over any range of a posting list.

    The lists lie one after another and a range never leaves its list, so one
    array per level serves all of them: entry i of level j is the place of the
    greatest of the 2**j impacts from i on, the first of equal ones.
    """

    def __init__(self, impacts: np.ndarray, longest: int):
        self.impacts = impacts
        self.levels = np.zeros((max(longest, 1).bit_length(), len(impacts)), np.int32)
        self.levels[0] = np.arange(len(impacts))
        for j in range(1, len(self.levels)):
            half, below = 1 << (j - 1), self.levels[j - 1]
            count = len(impacts) - 2 * half + 1
            left, right = below[:count], below[half : half + count]
            self.levels[j, :count] = np.where(impacts[left] >= impacts[right], left, right)

    def places(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """The place of the greatest impact of each range [start, stop), none of which is empty."""
        level = np.frexp(stop - start)[1] - 1
        left, right = self.levels[level, start], self.levels[level, stop - (1 << level)]
        return np.where(self.impacts[left] >= self.impacts[right], left, right)


class Best:
    """The ``k`` highest scores of each item with their documents, equal scores by document; no document is (maximum, 1)."""

    def __init__(self, items: int, k: int):
        self.items, self.k = items, k
        self.score = np.zeros((items, k), np.int64)
        self.doc = np.full((items, k), np.iinfo(np.int64).max)
        self.unnamed = np.ones((items, k), np.int8)

    def open(self, item: np.ndarray, score: np.ndarray, doc: np.ndarray, unnamed: np.ndarray) -> np.ndarray:
        """Whether a score of a document, or a bound of documents from this one on, can enter the ``k``."""
        least, last, rest = self.score[item, -1], self.doc[item, -1], self.unnamed[item, -1]
        before = (unnamed < rest) | ((unnamed == rest) & (doc < last))
        return (score > least) | ((score == least) & (score > 0) & before)

    def offer(self, item: np.ndarray, score: np.ndarray, doc: np.ndarray, unnamed: np.ndarray) -> None:
        fits = self.open(item, score, doc, unnamed)
        if not fits.any():
            return
        items = np.unique(item[fits])
        all_items = np.concatenate((np.repeat(items, self.k), item[fits]))
        all_scores = np.concatenate((self.score[items].ravel(), score[fits]))
        all_docs = np.concatenate((self.doc[items].ravel(), doc[fits]))
        all_unnamed = np.concatenate((self.unnamed[items].ravel(), unnamed[fits]))
        order = np.lexsort((all_docs, all_unnamed, -all_scores, all_items))
        first = np.searchsorted(all_items[order], items)
        kept = order[first[:, None] + np.arange(self.k)]
        self.score[items], self.doc[items], self.unnamed[items] = all_scores[kept], all_docs[kept], all_unnamed[kept]


def search_shard(postings_by_term: np.ndarray, impacts: np.ndarray, docs: np.ndarray, unnamed: np.ndarray, item_starts: np.ndarray, item_terms: np.ndarray, best: Best) -> int:
    """Offers ``best`` every document of a shard that belongs to it; returns how many documents were scored.

    ``postings_by_term`` are the sorted numbers term * len(docs) + document,
    documents numbered in the order of (unnamed, docs). An interval of
    documents is kept as its range in each posting list of the item. The sum
    of the ranges' maxima bounds the score of all its documents. The intervals
    with the highest bounds are split at the document that has the greatest
    impact: this is scored, and the two sides get bounds of their own. An
    interval is given up when its bound cannot enter the item's best.
    """
    n, scored = len(docs), 0
    if not len(postings_by_term):
        return scored
    borders = np.searchsorted(postings_by_term, np.arange(item_terms.max(initial=-1) + 2) * n)
    maxima = RangeMaxima(impacts, int(np.diff(borders).max(initial=1)))

    def bounded(owner, item, start, stop):
        """Intervals from ranges sorted by owner: (item, bound, first document, split, ranges from, ranges, start, stop), open ones only."""
        filled = stop > start
        owner, start, stop = owner[filled], start[filled], stop[filled]
        if not len(owner):
            return None
        first = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
        size = np.diff(np.concatenate((first, [len(owner)])))
        place = maxima.places(start, stop)
        greatest = impacts[place]
        bound = np.add.reduceat(greatest, first)
        lowest = np.minimum.reduceat(postings_by_term[start] % n, first)
        top = np.repeat(np.maximum.reduceat(greatest, first), size) == greatest
        split = np.minimum.reduceat(np.where(top, postings_by_term[place] % n, n), first)
        item = item[owner[first]]
        held = best.open(item, bound, docs[lowest], unnamed[lowest])
        kept = np.repeat(held, size)
        size = size[held]
        return item[held], bound[held], lowest[held], split[held], np.cumsum(size) - size, size, start[kept], stop[kept]

    def joined(parts):
        """The intervals of several results of ``bounded`` in one."""
        parts = [p for p in parts if p is not None]
        shift = np.cumsum([0] + [len(p[6]) for p in parts])
        columns = [np.concatenate([p[c] for p in parts]) if parts else np.zeros(0, np.int64) for c in range(8)]
        if parts:
            columns[4] = np.concatenate([p[4] + shift[i] for i, p in enumerate(parts)])
        return columns

    sizes = np.diff(item_starts)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    item, bound, lowest, split, at, size, start, stop = joined([bounded(owner, np.arange(len(sizes)), borders[item_terms], borders[item_terms + 1])])
    while len(item):
        order = np.lexsort((lowest, -bound, item))
        ranked = item[order]
        chosen = order[np.arange(len(order)) - np.searchsorted(ranked, ranked) < SPLITS]
        chosen.sort()
        rest = np.ones(len(item), bool)
        rest[chosen] = False
        own = np.repeat(np.arange(len(chosen)), size[chosen])
        flat = np.arange(len(own)) - np.repeat(np.cumsum(size[chosen]) - size[chosen], size[chosen]) + np.repeat(at[chosen], size[chosen])
        low, high, doc = start[flat], stop[flat], split[chosen]
        wanted = postings_by_term[low] // n * n + doc[own]
        place = np.searchsorted(postings_by_term, wanted)
        there = place < high
        there[there] = postings_by_term[place[there]] == wanted[there]
        gain = np.zeros(len(own), np.int64)
        gain[there] = impacts[place[there]]
        best.offer(item[chosen], np.add.reduceat(gain, np.cumsum(size[chosen]) - size[chosen]), docs[doc], unnamed[doc])
        scored += len(chosen)
        left, right = bounded(own, item[chosen], low, place), bounded(own, item[chosen], place + there, high)
        held = rest & best.open(item, bound, docs[lowest], unnamed[lowest])
        if len(start) > POOL:
            flat = np.arange(size[held].sum()) + np.repeat(at[held] - (np.cumsum(size[held]) - size[held]), size[held])
            start, stop = start[flat], stop[flat]
            at = at.copy()
            at[held] = np.cumsum(size[held]) - size[held]
        old = item[held], bound[held], lowest[held], split[held], at[held], size[held], start, stop
        item, bound, lowest, split, at, size, start, stop = joined([old, left, right])
    return scored


def _statistics(docs: DataFrame, text: str, vocabulary: list[bytes]) -> tuple[int, int, np.ndarray]:
    """(documents with terms, terms of all documents, documents holding each term of the vocabulary)."""

    def counted(batches):
        terms = pa.array(vocabulary, pa.large_binary())
        holding, total = np.zeros(len(vocabulary) + 2, np.int64), len(vocabulary)
        for batch in batches:
            for start in range(0, batch.num_rows, SHARD_DOCS):
                n, pairs, _ = postings(batch.column(0).slice(start, SHARD_DOCS), terms)
                holding[:total] += np.bincount(pairs % total, minlength=total) if total else 0
                holding[total:] += (n > 0).sum(), n.sum()
        place = np.flatnonzero(holding)
        yield pa.RecordBatch.from_arrays([pa.array(place), pa.array(holding[place])], ["term", "n"])

    found = docs.select(text).mapInArrow(counted, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    every = np.zeros(len(vocabulary) + 2, np.int64)
    for row in found.collect():  # a row per term of the block, two for all documents
        every[row.term] = row.n
    return int(every[-2]), int(every[-1]), every[:-2]


def _candidates(docs: DataFrame, key: str, text: str, items: list, k: int) -> DataFrame:
    """The best ``k`` documents of each task for each item of a block: (item row, key, score)."""
    vocabulary = sorted({bytes(t) for _, terms in items for t in terms})
    number = {t: i for i, t in enumerate(vocabulary)}
    item_rows = np.array([row for row, _ in items], np.int64)
    item_starts = np.concatenate(([0], np.cumsum([len(terms) for _, terms in items]))).astype(np.int64)
    item_terms = np.array([number[bytes(t)] for _, terms in items for t in terms], np.int64)
    some, length, holding = _statistics(docs, text, vocabulary)
    weights = np.array([math.floor(1000 * math.log((2.0 * some + 2) / (2.0 * h + 1))) for h in holding.tolist()], np.int64)

    def searched(batches):
        terms = pa.array(vocabulary, pa.large_binary())
        best = Best(len(item_rows), k)
        shard: list[tuple] = []

        def close():
            shift = np.cumsum([0] + [len(s[0]) for s in shard])
            ids, unnamed, n = (np.concatenate([s[c] for s in shard]) for c in range(3))
            pairs = np.concatenate([s[3] + shift[i] * len(terms) for i, s in enumerate(shard)])
            times = np.concatenate([s[4] for s in shard])
            order = np.lexsort((ids, unnamed))
            number_of = np.empty(len(order), np.int64)
            number_of[order] = np.arange(len(order))
            doc, term = pairs // len(terms), pairs % len(terms)
            damped = 10 + (90 * n[doc] * some) // max(length, 1)
            impact = weights[term] * ((1_000_000_000 * times) // (1000 * times + 8 * damped))
            place = term * len(ids) + number_of[doc]
            sorted_by_term = np.argsort(place[impact > 0])
            search_shard(place[impact > 0][sorted_by_term], impact[impact > 0][sorted_by_term], ids[order], unnamed[order], item_starts, item_terms, best)
            shard.clear()

        for batch in batches:
            for start in range(0, batch.num_rows, SHARD_DOCS):
                part = batch.slice(start, SHARD_DOCS)
                ids = part.column(0)
                n, pairs, times = postings(part.column(1), terms)
                named = ids.is_null().to_numpy(zero_copy_only=False).astype(np.int8)
                shard.append((pc.fill_null(ids, np.iinfo(np.int64).max).to_numpy(), named, n, pairs, times))
                if sum(len(s[0]) for s in shard) >= SHARD_DOCS or sum(len(s[3]) for s in shard) >= SHARD_POSTINGS:
                    close()
        if shard:
            close()
        item, place = np.nonzero(best.score)
        ids = pa.array(best.doc[item, place], mask=best.unnamed[item, place].astype(bool))
        yield pa.RecordBatch.from_arrays([pa.array(item_rows[item]), ids, pa.array(best.score[item, place])], ["item", "doc", "score"])

    return docs.select(F.col(key).cast("long"), text).mapInArrow(searched, "item long, doc long, score long")


def search(docs: DataFrame, items: DataFrame, k: int = 10, *, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text") -> DataFrame:
    """The ``k`` highest-scoring documents of each item: rows (item_key, rank, key, score), scores above 0 only.

    Terms are runs of ASCII letters and digits and of all characters beyond
    ASCII, with A-Z in lower case. A term's impact in a document is its weight
    (from the number of documents holding it) times its damped frequency, all
    in whole numbers; a document's score is the sum over the distinct terms of
    the item. Equal scores go to the smaller key.

    One pass over the documents counts terms, one more searches. Each task
    makes shards of the documents it reads: a posting list per term of the
    items, with sparse tables for range maxima, searched best-first
    (``search_shard``). What the items have found in earlier shards of a task
    bounds the later ones. No text or posting is moved; a task sends ``k``
    rows an item. Items are taken in blocks of about ``BLOCK_BYTES`` of terms,
    an item in whole.

    The key is an integer. Null texts have no terms; rows with a null key rank
    behind equal scores; rows that repeat a key are documents of their own, and
    items that repeat an id are items of their own. Items without terms or
    without a hit have no row. Texts of any length are cut into terms in
    windows. Empty tables give an empty table. Other columns are ignored.
    """
    terms = F.array_distinct(F.transform(F.regexp_extract_all(ascii_lower(F.coalesce(F.col(item_text), F.lit(""))), F.lit(TERM), F.lit(0)), lambda t: t.cast("binary")))
    held = stored(items.select(F.monotonically_increasing_id().alias("_item"), F.col(item_key).alias("_item_key"), terms.alias("_terms")), "items")
    size = F.aggregate("_terms", F.lit(0).cast("long"), lambda total, t: total + F.octet_length(t) + 40)
    blocks = max(1, math.ceil((held.agg(F.sum(size)).first()[0] or 0) / BLOCK_BYTES))
    found = docs.sparkSession.createDataFrame([], "item long, doc long, score long")
    for number in range(blocks):
        block = held.filter((F.pmod(F.xxhash64("_item"), F.lit(blocks)) == number) & (F.size("_terms") > 0)).select("_item", "_terms").collect()
        if block:
            found = found.union(_candidates(docs, key, text, [tuple(row) for row in block], k))
    order = [F.col("score").desc(), F.col("doc").asc_nulls_last()]
    part = F.pmod(F.xxhash64("doc", "score"), F.lit(PARTS))
    ahead = found.withColumn("part", part).withColumn("rank", F.row_number().over(Window.partitionBy("item", "part").orderBy(*order))).filter(F.col("rank") <= k)
    ranked = ahead.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).filter(F.col("rank") <= k)
    names = small_side(held.select("_item", "_item_key"), 64)
    return ranked.join(names, ranked["item"] == names["_item"]).select(F.col("_item_key").alias(item_key), "rank", F.col("doc").alias(key), "score")
