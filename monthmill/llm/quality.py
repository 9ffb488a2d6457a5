"""Document quality: a linear-chain conditional random field labels lines good or bad."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthmill.llm.tables import buffers, remainder, share

#: Labelled documents, about, on which the field is fitted (a hash sample).
SAMPLE = 3000
_NAMES = 19


def _among(chars: str) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(chars.encode())] = True
    return table


_LOWER, _UPPER, _DIGIT = _among("abcdefghijklmnopqrstuvwxyz"), _among("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), _among("0123456789")
_BLANK, _STOP, _LOUD, _PIPE = _among(" \t\x0b\x0c\r\n"), _among(".,;:"), _among("!?"), _among("|")
_SYMBOL, _VOWEL = _among("#$%&*@^~<>{}[]()=_+\\/`"), _among("aeiouAEIOU")
_HIGH = np.arange(256) >= 0x80
#: A random number per byte: words with equal sums and lengths count as equal.
_MARK = np.random.default_rng(0).integers(0, 1 << 62, 256).astype(np.uint64)


#: Bytes of text scored at a time; each costs about 30 bytes of working memory.
PIECE = 4 << 20


class Field(NamedTuple):
    """Weights of a line's and its neighbours' features for the label good, and of label pairs (log factors)."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    pairs: np.ndarray


def line_features(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of every line of every text, the first line of each text (and the end), and line lengths in bytes."""
    breaks = np.flatnonzero(data == 0x0A)
    place = np.searchsorted(ends[1:], breaks, side="right")  # the text of each line break
    per = np.bincount(place, minlength=len(ends) - 1) + 1
    first = np.concatenate(([0], np.cumsum(per)))
    low, high = np.empty(first[-1], np.int64), np.empty(first[-1], np.int64)
    low[first[:-1]], high[first[1:] - 1] = ends[:-1], ends[1:]
    nth = np.arange(len(breaks)) + place  # the line that each break ends
    high[nth], low[nth + 1] = breaks, breaks + 1
    size = high - low

    def total(mask: np.ndarray) -> np.ndarray:
        sums = np.zeros(len(mask) + 1, np.int32)
        np.cumsum(mask, out=sums[1:])
        return (sums[high] - sums[low]).astype(np.float32)

    blank = _BLANK[data]
    begins = ~blank & np.concatenate(([True], blank[:-1]))[: len(data)]
    begins[low[size > 0]] = ~blank[low[size > 0]]
    ends_word = ~blank & np.concatenate((blank[1:], [True]))[: len(data)]
    ends_word[high[size > 0] - 1] = ~blank[high[size > 0] - 1]
    from_, to = np.flatnonzero(begins), np.flatnonzero(ends_word) + 1
    marks = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_MARK[data])))
    word = marks[to] - marks[from_] + (to - from_).astype(np.uint64)
    again = np.zeros(len(data), bool)
    again[from_[1:]] = word[1:] == word[:-1]
    ahead = np.concatenate((blank, np.ones(3, bool)))
    short = begins & (ahead[1 : len(data) + 1] | ahead[2 : len(data) + 2] | ahead[3 : len(data) + 3])
    same = np.concatenate(([False], data[1:] == data[:-1]))[: len(data)]
    n, words = np.maximum(size, 1).astype(np.float32), np.maximum(total(begins), 1)
    end = np.zeros(len(size), bool)
    end[size > 0] = (_STOP | _LOUD)[data[high[size > 0] - 1]]
    start = np.zeros(len(size), bool)
    start[size > 0] = _UPPER[data[low[size > 0]]]
    shares = [total(t[data]) / n for t in (_LOWER, _UPPER, _DIGIT, _STOP, _LOUD, _PIPE, _SYMBOL, _VOWEL, _HIGH)]
    x = np.column_stack((np.log1p(size), *shares, total(blank) / n, total(same) / n, np.log1p(words), (n - total(blank)) / words, total(short) / words, total(again) / words, end, start, size == 0))
    return x.astype(np.float32), first, size


def _inputs(x: np.ndarray, first: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Each line's features beside those of the lines before and after it, border marks, and 1."""
    z = np.clip((x - mean) / scale, -5, 5)
    before, after = np.zeros_like(z), np.zeros_like(z)
    before[1:], after[:-1] = z[:-1], z[1:]
    top, end = np.zeros(len(z), np.float32), np.zeros(len(z), np.float32)
    top[first[:-1]], end[first[1:] - 1] = 1, 1
    before[first[:-1]], after[first[1:] - 1] = 0, 0
    return np.column_stack((z, before, after, top, end, np.ones(len(z), np.float32)))


def marginals(scores: np.ndarray, first: np.ndarray, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward-backward over all texts at once: each line's probability of good, and expected numbers of label pairs."""
    counts = np.diff(first)
    order = np.argsort(-counts, kind="stable")
    starts, counts = first[:-1][order], counts[order]
    factor = np.exp(pairs)
    own = np.column_stack((np.exp(-np.clip(scores, -30, 30) / 2), np.exp(np.clip(scores, -30, 30) / 2)))
    alpha, beta = np.empty_like(own), np.ones_like(own)
    active = [int(np.searchsorted(-counts, -t, side="left")) for t in range(int(counts[0]))]
    for t, n in enumerate(active):
        at = starts[:n] + t
        a = own[at] * (alpha[at - 1] @ factor if t else 1.0)
        alpha[at] = a / a.sum(axis=1, keepdims=True)
    expected = np.zeros((2, 2))
    for t in range(len(active) - 1, 0, -1):
        at = starts[: active[t]] + t
        right = own[at] * beta[at]
        pair = alpha[at - 1][:, :, None] * factor * right[:, None, :]
        expected += (pair / pair.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
        b = right @ factor.T
        beta[at - 1] = b / b.sum(axis=1, keepdims=True)
    p = alpha * beta
    return p[:, 1] / p.sum(axis=1), expected


def train(texts: pa.Array, good: np.ndarray, rounds: int = 150, decay: float = 1e-3) -> Field:
    """Maximum likelihood by gradient ascent with adapted steps; every line of a text carries the text's label."""
    x, first, size = line_features(*buffers(texts))
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-3
    inputs = _inputs(x, first, mean, scale)
    counts = np.diff(first)
    labels = np.repeat(good, counts).astype(float)
    within = np.ones(len(labels), bool)
    within[first[:-1]] = False
    to = labels[within].astype(int)
    seen = np.zeros((2, 2))
    np.add.at(seen, (to, to), 1)  # the label never changes inside a text
    theta = np.zeros(inputs.shape[1] + 4)
    step, square = np.zeros_like(theta), np.zeros_like(theta)
    for t in range(1, rounds + 1):
        pairs = theta[-4:].reshape(2, 2)
        p, expected = marginals(inputs @ theta[:-4], first, pairs)
        gradient = np.concatenate((inputs.T @ (labels - p), (seen - expected).ravel())) / len(counts) - decay * theta
        step, square = 0.9 * step + 0.1 * gradient, 0.99 * square + 0.01 * gradient**2
        theta += 0.1 * (step / (1 - 0.9**t)) / (np.sqrt(square / (1 - 0.99**t)) + 1e-6)
    return Field(mean, scale, theta[:-4].astype(np.float32), theta[-4:].reshape(2, 2))


def quality(field: Field, texts: pa.Array) -> np.ndarray:
    """Quality of each text: its lines' probabilities of good, weighted by length. An empty text is one line of weight 1."""
    x, first, size = line_features(*buffers(texts))
    if not len(texts):
        return np.zeros(0)
    p, _ = marginals(_inputs(x, first, field.mean, field.scale) @ field.weights, first, field.pairs)
    weight = size + (np.repeat(first[1:] - first[:-1], np.diff(first)) == 1) + 1e-9
    return np.clip(np.add.reduceat(p * weight, first[:-1]) / np.add.reduceat(weight, first[:-1]), 0, 1)


def fit(docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text", label: str = "quality") -> Field:
    """A field from labelled documents whose crc32 of the key, modulo 4, is not 2: about ``SAMPLE``, by a hash of the key."""
    usable = labels.filter(F.col(label).isNotNull() & (remainder(key, 4) != 2)).select(key, F.col(label).cast("int").alias("good")).distinct()
    n = max(1, usable.count())
    picked = usable.filter(share(key) < SAMPLE / n)
    taken = docs.select(key, text).join(F.broadcast(picked), key).toArrow().sort_by(key)
    if not len(taken):
        return Field(np.zeros(_NAMES, np.float32), np.ones(_NAMES, np.float32), np.zeros(3 * _NAMES + 3, np.float32), np.zeros((2, 2)))
    return train(taken.column(text).combine_chunks(), taken.column("good").to_numpy())


def score(docs: DataFrame, field: Field, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, score) for every row, from the text alone; null is an empty text. Repeated rows give repeated rows.

    Equal texts have equal scores. Texts are worked on in slices of about
    ``PIECE`` bytes, whole texts each; an empty table gives an empty table.
    """
    sent = docs.sparkSession.sparkContext.broadcast(field)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            ends = buffers(part.column(1))[1]
            at = 0
            while at < part.num_rows:
                stop = max(at + 1, int(np.searchsorted(ends, ends[at] + PIECE, side="right")) - 1)
                piece = part.slice(at, min(stop, at + 1000) - at)
                at += piece.num_rows
                yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(quality(sent.value, piece.column(1)), pa.float64())], names=[key, "score"])

    return docs.select(key, text).mapInArrow(run, docs.select(key).schema.add("score", "double"))
