"""Language-model scores: cross-entropy difference between a target and a background model of words.

Tokens are words: runs of ASCII letters, digits and characters beyond ASCII,
A-Z lowered. Characters of scripts without blanks and ASCII marks are a token
each. The models count every word and every pair of words of the corpus, by
64-bit hashes. Pairs that occur once in the whole corpus are known by their
number only, as is usual; all others are in the models, which grow with the
corpus and stay in Spark. Executors hold the commonest words and pairs and a
filter of the remaining pairs, all three of a fixed size; tokens whose pair the
filter may hold are joined with the counts.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from monthmill.llm.tables import buffers, small_side, stored

#: Weight of the next shorter model in each estimate, in counts.
PRIOR = 5.0
#: Words and word pairs, at most, whose counts are sent to every executor (24 bytes each).
WORDS = 1 << 20
PAIRS = 1 << 20
#: Bits of the filter of all other pairs. It never loses a pair; a full one only makes more tokens move.
FILTER_BITS = 1 << 27
#: Losses are summed as whole numbers of 1 / UNIT nats, so that no order of adding shows.
UNIT = 1 << 20
#: The part of an estimate that comes from the word alone is rounded to so many nats, which lets it travel in four bytes.
STEP = 1 / 512
_PIECE = 1 << 20
#: Word pairs that a task gathers before it sends their counts on.
_GATHERED = 1 << 21
_BEGIN = np.uint64(0x9E3779B97F4A7C15)

_LOWERED = np.arange(256, dtype=np.uint8)
_LOWERED[0x41:0x5B] += 32
_BLANK, _MARK, _WORD, _SIGN, _REST = range(5)
_KIND = np.full(256, _MARK, np.uint8)
_KIND[:0x21] = _KIND[0x7F] = _BLANK
_KIND[0x30:0x3A] = _KIND[0x41:0x5B] = _KIND[0x61:0x7B] = _KIND[0xC0:] = _WORD
_KIND[0x80:0xC0] = _REST  # further bytes of a character
_KIND[0xE3:0xEA] = _KIND[0xF0:] = _SIGN  # first bytes of kana, Han, and all beyond U+FFFF
_BYTE_VALUES = np.random.default_rng(8).integers(1, 1 << 63, 256, dtype=np.uint64)


class Known(NamedTuple):
    """Counts under both models by sorted key."""

    keys: np.ndarray
    counts: np.ndarray

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The counts of each key, and whether it is here at all; 0 where it is not."""
        if not len(self.keys):
            return np.zeros((2, len(keys))), np.zeros(len(keys), bool)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        here = self.keys[at] == keys
        return np.where(here, self.counts[:, at], 0.0), here


class Models(NamedTuple):
    """The commonest words and pairs, a filter of the other pairs and, in Spark, their counts.

    ``mean`` is the mean count of a word that is not among the commonest,
    ``tokens`` each side's number of tokens, ``once`` the share of them whose
    pair occurs once in the corpus, ``vocabulary`` the number of words.
    """

    words: Known
    pairs: Known
    filter: np.ndarray
    others: DataFrame
    mean: np.ndarray
    tokens: np.ndarray
    once: np.ndarray
    vocabulary: int

    @property
    def scale(self) -> np.ndarray:
        """What brings the larger side down to the size of the smaller one."""
        return self.tokens.min() / np.maximum(self.tokens, 1) if self.tokens.min() else np.ones(2)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


# Keys of pairs are odd, those of words even, so that both are counted in one go.
def _word_key(word: np.ndarray) -> np.ndarray:
    return (word & ~np.uint64(1)).view(np.int64)


def _pair_key(prev: np.ndarray, word: np.ndarray) -> np.ndarray:
    return (_mixed(prev * np.uint64(0xD6E8FEB86659FD93) + word) | np.uint64(1)).view(np.int64)


def words_of(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The hash and the first byte's place of each token of some UTF-8."""
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    low = _LOWERED[data]
    kind = _KIND[low]
    # Further bytes are of the kind of their character.
    lead = np.maximum.accumulate(np.where(kind != _REST, np.arange(len(kind)), 0))
    own = kind[lead]
    before = np.concatenate(([_BLANK], own[:-1]))
    begins = (kind != _REST) & ((own == _MARK) | (own == _SIGN) | ((own == _WORD) & (before != _WORD)))
    inside = np.flatnonzero(own != _BLANK)
    starts = np.flatnonzero(begins[inside])
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    lengths = np.diff(np.append(starts, len(inside)))
    place = np.arange(len(inside)) - np.repeat(starts, lengths)
    powers = np.cumprod(np.full(int(lengths.max()), 0x5851F42D4C957F2D, np.uint64))
    return _mixed(np.add.reduceat(_BYTE_VALUES[low[inside]] * powers[place], starts)), inside[starts]


def _pieces(data: np.ndarray, ends: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, bool]]:
    """(first text, bytes, bounds of texts, whether the first goes on): whole texts of about ``_PIECE`` bytes; longer ones are cut between tokens."""
    first, n = 0, len(ends) - 1
    while first < n:
        last = int(np.searchsorted(ends, ends[first] + _PIECE, side="right")) - 1
        if last > first:
            yield first, data[ends[first] : ends[last]], ends[first : last + 1] - ends[first], False
            first = last
            continue
        at, stop, reach = int(ends[first]), int(ends[first + 1]), _PIECE
        while at < stop:
            cut = min(stop, at + reach)
            if cut < stop:
                apart = np.flatnonzero(np.isin(_KIND[data[at + 1 : cut]], (_BLANK, _MARK, _SIGN)))
                if not len(apart):  # a word longer than this
                    reach *= 2
                    continue
                cut = at + 1 + int(apart[-1])
            yield first, data[at:cut], np.array([0, cut - at]), at > ends[first]
            at, reach = cut, _PIECE
        first += 1


def _apart(part: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts with a blank after each, so that no word spans two of them, and where each begins."""
    lengths = np.diff(bounds)
    begins = bounds[:-1] + np.arange(len(lengths))
    out = np.full(len(part) + len(lengths), 0x20, np.uint8)
    keep = np.ones(len(out), bool)
    keep[begins + lengths] = False
    out[keep] = part
    return out, begins


def word_pairs(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(text number, previous word, word) of all tokens of a column, piece by piece; before a text's first word stands ``_BEGIN``."""
    data, ends = buffers(column)
    held = _BEGIN
    for first, part, bounds, goes_on in _pieces(data, ends):
        spaced, begins = _apart(part, bounds)
        word, at = words_of(spaced)
        if not goes_on:
            held = _BEGIN
        if not len(word):
            continue
        text = np.searchsorted(begins, at, side="right") - 1
        prev = np.concatenate((word[:1], word[:-1]))
        prev[np.flatnonzero(np.diff(text, prepend=-1))] = _BEGIN
        if goes_on:
            prev[0] = held
        held = word[-1]
        yield first + text, prev, word


def _counted(docs: DataFrame) -> DataFrame:
    """(key, target, background): counts of words, of texts (as the word ``_BEGIN``) and of pairs; ``docs`` is (text, whether of the target)."""

    def summed(gathered: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        prev, word, wanted = (np.concatenate(x) for x in zip(*gathered))
        # Either side by itself: keys are then sorted, which is fast, and not their places.
        for k, of in enumerate((wanted, ~wanted)):
            first, own = prev[of], word[of]
            for keys in (_pair_key(first, own), _word_key(np.append(own, first[first == _BEGIN]))):
                once, n = np.unique(keys, return_counts=True)
                counts = [n, np.zeros(len(n), np.int64)]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (once, counts[k], counts[1 - k])], names=["key", "target", "background"])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gathered, n = [], 0
        for part in parts:
            wanted = part.column(1).to_numpy(zero_copy_only=False).astype(bool)
            for text, prev, word in word_pairs(part.column(0)):
                gathered.append((prev, word, wanted[text]))
                n += len(word)
                if n >= _GATHERED:
                    yield from summed(gathered)
                    gathered, n = [], 0
        if gathered:
            yield from summed(gathered)

    counts = docs.mapInArrow(run, "key long, target long, background long")
    return counts.groupBy("key").agg(F.sum("target").alias("target"), F.sum("background").alias("background"))


def _least(rows_by_size: dict[int, int], room: int) -> int:
    """The smallest 2^k so that no more than ``room`` keys occur as often."""
    least = 62
    for k in sorted(rows_by_size, reverse=True):
        room -= rows_by_size[k]
        if room < 0:
            break
        least = k
    return 1 << least


def _known(rows: DataFrame) -> Known:
    found = rows.select("key", "target", "background").toArrow()
    order = np.argsort(found.column("key").to_numpy())
    return Known(found.column("key").to_numpy()[order], np.stack([found.column(c).to_numpy()[order] for c in ("target", "background")]).astype(np.float64))


def _places(keys: np.ndarray, bits: int) -> list[np.ndarray]:
    """The two bits of each key in a filter."""
    h = keys.view(np.uint64)
    return [((h >> np.uint64(shift)) & np.uint64(bits - 1)).astype(np.int64) for shift in (1, 33)]


def _filter(pairs: DataFrame) -> np.ndarray:
    """A bit per place of any pair, put together in Spark; the driver sees at most a row per 64 bits."""
    spots = F.explode(F.array(*[F.shiftrightunsigned("key", shift).bitwiseAND(FILTER_BITS - 1) for shift in (1, 33)]))
    spots = pairs.select(spots.alias("at")).select(F.shiftright("at", 6).alias("slot"), F.call_function("shiftleft", F.lit(1).cast("long"), F.col("at").bitwiseAND(63).cast("int")).alias("bits"))
    found = spots.groupBy("slot").agg(F.bit_or("bits").alias("bits")).toArrow()
    bits = np.zeros(FILTER_BITS >> 6, np.int64)
    bits[found.column("slot").to_numpy()] = found.column("bits").to_numpy()
    return bits


def fit(docs: DataFrame, targets: DataFrame, *, key: str = "doc_id", text: str = "text") -> Models:
    """Models from the documents whose key is in ``targets`` and, as background, from all others.

    Both count all their whole texts. They are matched by weight: counts of the
    larger side are scaled down to the size of the smaller one, and no text is
    left out. Null keys are in no target; rows that repeat count as often as
    they stand there. Without documents, or without a target, a model knows no
    more than the vocabulary. Beyond ``WORDS`` words, the rarer ones share
    their mean count; counts of pairs are exact at any size.
    """
    wanted = stored(targets.select(F.col(key).alias("_key")).filter("_key is not null").distinct(), "targets")
    flagged = docs.select(key, text).join(small_side(wanted, 16), F.col(key) == F.col("_key"), "left").select(text, F.col("_key").isNotNull().alias("wanted"))
    n, pair = F.col("target") + F.col("background"), F.col("key").bitwiseAND(1) == 1
    counts = stored(_counted(flagged).filter(~pair | (n > 1)), "word-counts")
    begin = int(_word_key(np.array([_BEGIN]))[0])
    sums = [F.sum("target").alias("target"), F.sum("background").alias("background"), F.count("*").alias("rows")]
    sizes = counts.groupBy(pair.alias("pair"), (F.col("key") == begin).alias("begin"), F.floor(F.log2(n)).cast("int").alias("k")).agg(*sums).collect()  # a row per power of two
    least = [_least({r.k: r.rows for r in sizes if r.pair == kind and not r.begin}, room) for kind, room in ((False, WORDS - 1), (True, PAIRS))]

    def total(rows) -> np.ndarray:
        return np.array([[r.target, r.background] for r in rows], np.float64).reshape(-1, 2).sum(axis=0)

    words = [r for r in sizes if not r.pair and not r.begin]
    rare = [r for r in words if 1 << r.k < least[0]]
    tokens = total(words)
    others = counts.filter(pair & (n < least[1]))
    return Models(
        _known(counts.filter(~pair & ((n >= least[0]) | (F.col("key") == begin)))),
        _known(counts.filter(pair & (n >= least[1]))),
        _filter(others),
        others,
        total(rare) / max(1, sum(r.rows for r in rare)),
        tokens,
        1 - total(r for r in sizes if r.pair) / np.maximum(tokens, 1),
        sum(r.rows for r in words),
    )


def _estimates(models: Models, prev: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For both models: minus the log of what a token has by its word alone, in steps of ``STEP``, and the whole it is a share of.

    A word leans on the even chance of all words and an unknown one, a pair on
    its word with a weight of ``PRIOR`` counts and the share of the context's
    tokens whose pair occurs once.
    """
    m, scale = models, models.scale[:, None]
    size = m.tokens.min() or m.tokens[:, None]
    begin = m.words.find(_word_key(np.array([_BEGIN])))[0]
    # A context is the word before, so one search serves both.
    found, here = m.words.find(_word_key(np.append(prev[:1], word)))
    counts = np.where(here, found, m.mean[:, None])
    context = np.where(prev == _BEGIN, begin, counts[:, :-1]) * scale
    by_word = (counts[:, 1:] * scale + PRIOR / (m.vocabulary + 1)) / (size + PRIOR)
    once = m.once[:, None] * context
    return np.rint(-np.log((PRIOR + once) * by_word) / STEP), context + once + PRIOR


def score(docs: DataFrame, models: Models, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_tokens, target_loss, background_loss, score) for every row; a low score is close to the target.

    The score is the mean over a text's tokens of target loss less background
    loss. Null and empty texts, and texts of blanks alone, have no tokens, null
    losses and score 0. Repeated rows give repeated rows. Words and pairs the
    models have not seen have counts of 0. Rows are numbered by partition and
    place, so ``docs`` should be a stored table.
    """
    others = models.others
    sent = docs.sparkSession.sparkContext.broadcast(models._replace(others=None))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        bits, some = 64 * len(m.filter), bool(m.filter.any())
        row = TaskContext.get().partitionId() << 33
        for part in parts:
            n, sums = part.num_rows, np.zeros((3, part.num_rows), np.int64)
            for owner, prev, word in word_pairs(part.column(1)):
                first, texts = owner[0], owner[-1] - owner[0] + 1
                steps, whole = _estimates(m, prev, word)
                pair = _pair_key(prev, word)
                seen, here = m.pairs.find(pair)
                loss = np.rint(-np.log((seen * m.scale[:, None] + np.exp(-STEP * steps)) / whole) * UNIT)
                for k, weights in enumerate((None, *loss)):
                    sums[k, first : first + texts] += np.bincount(owner - first, weights, texts).astype(np.int64)
                rest = np.flatnonzero(~here) if some else []
                if len(rest):
                    held = [(m.filter[at >> 6] >> (at & 63) & 1).astype(bool) for at in _places(pair[rest], bits)]
                    rest = rest[held[0] & held[1]]
                    packed = (steps[:, rest] + 32768).astype(np.int64)
                    yield batch(row + owner[rest], pa.nulls(len(rest), part.column(0).type), np.zeros((3, len(rest)), np.int64), pair[rest], packed[0] << 16 | packed[1])
            rows = np.arange(row, row + n)
            yield batch(rows, part.column(0), sums, rows << 1, np.zeros(n, np.int64))
            row += n

    def batch(rows, keys, sums, pairs, steps) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([keys, *(pa.array(x, pa.int64()) for x in (rows, *sums, pairs, steps))], names=schema.names)

    longs = [T.StructField(c, T.LongType()) for c in ("_row", "_n", "_target", "_background", "_pair", "_steps")]
    schema = T.StructType([T.StructField("_key", docs.schema[key].dataType), *longs])
    # A row per text, with an even number that no pair has, and one for each token that has to be looked up.
    found = docs.select(key, text).mapInArrow(run, schema).join(others, F.col("_pair") == F.col("key"), "left")
    by_word = {"target": F.shiftright("_steps", 16), "background": F.col("_steps").bitwiseAND(65535)}

    def gained(side: str, scale: float) -> Column:
        """So much less loss than by its word alone has a token whose pair has counts."""
        gain = F.log1p(F.col(side) * scale * F.exp((by_word[side] - 32768) * STEP))
        return F.sum(F.col(f"_{side}") - F.coalesce(F.round(gain * UNIT).cast("long"), F.lit(0))).alias(f"_{side}")

    sums = [F.sum("_n").alias("_n"), *(gained(side, float(scale)) for side, scale in zip(("target", "background"), models.scale))]
    whole = found.groupBy("_row").agg(F.first("_key", ignorenulls=True).alias("_key"), *sums)
    target, background = (F.col(c) / UNIT / F.nullif("_n", F.lit(0)) for c in ("_target", "_background"))
    return whole.select(F.col("_key").alias(key), F.col("_n").alias("n_tokens"), target.alias("target_loss"), background.alias("background_loss"), F.coalesce(target - background, F.lit(0.0)).alias("score"))
