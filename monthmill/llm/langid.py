"""Language identification: averaged embeddings of hashed subwords under a linear softmax."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthmill.llm.tables import buffers, remainder, share

#: Labelled documents per language, about, on which the model is fitted (a hash sample).
PER_LANGUAGE = 600
BUCKETS = 1 << 14
DIMENSIONS = 16
_GRAMS = (2, 3, 4)
#: Rows, and bytes of text, scored at a time; they bound a task's memory.
_ROWS = 500
_PIECE = 1 << 18

#: Bytes as the model sees them: letters lowered, all else of ASCII a space.
_SEEN = np.full(256, 0x20, np.uint8)
_SEEN[0x61:0x7B] = np.arange(0x61, 0x7B)
_SEEN[0x41:0x5B] = np.arange(0x61, 0x7B)
_SEEN[0x80:] = np.arange(0x80, 0x100)


class Model(NamedTuple):
    """``table`` folds embeddings and output weights: a bucket's share of each language's logit."""

    languages: list[str]
    table: np.ndarray
    bias: np.ndarray
    temperature: float
    threshold: float


def _buckets(seen: np.ndarray, n: int) -> np.ndarray:
    """The bucket of the n bytes that begin at each place."""
    size = max(0, len(seen) - n + 1)
    key = np.zeros(size, np.uint32)
    for k in range(n):
        key = (key << np.uint32(8)) | seen[k : k + size]
    return ((key * np.uint32(2654435761) + np.uint32(n * 40503)) >> np.uint32(18)).astype(np.int64)  # 14 bits


def _bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    data, ends = buffers(pc.binary_join_element_wise(pa.scalar(" ", pa.large_string()), texts, pa.scalar(" ", pa.large_string()), pa.scalar("", pa.large_string())))
    return _SEEN[data], ends


def _sums(seen: np.ndarray, ends: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per text the sum of table rows over all its subwords, and their number. Long texts are added up in pieces."""
    n = len(ends) - 1
    out, count = np.zeros((n, table.shape[1])), np.zeros(n)
    first = 0
    while first < n:
        last = max(first + 1, int(np.searchsorted(ends, ends[first] + _PIECE, side="right")) - 1)
        if last == first + 1:
            for at in range(ends[first], ends[last], _PIECE):
                for g in _GRAMS:
                    b = _buckets(seen[at : min(ends[last], at + _PIECE + g - 1)], g)
                    out[first] += table[b].sum(axis=0, dtype=np.float64)
                    count[first] += len(b)
        else:
            part, bounds = seen[ends[first] : ends[last]], ends[first : last + 1] - ends[first]
            for g in _GRAMS:
                b = _buckets(part, g)
                low, high = bounds[:-1], np.maximum(bounds[:-1], bounds[1:] - g + 1)
                full = high > low
                rows = np.concatenate((table[b], np.zeros((g, table.shape[1]), table.dtype)))
                sums = np.add.reduceat(rows, np.column_stack((low[full], high[full])).ravel(), axis=0)[::2]
                out[first:last][full] += sums
                count[first:last] += high - low
        first = last
    return out, count


def _letters(texts: pa.Array, seen: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Whether each text has a letter. Texts of ASCII letters are settled by their bytes."""
    ascii_letters = np.zeros(len(seen) + 1, np.int32)
    np.cumsum((seen >= 0x61) & (seen < 0x7B), out=ascii_letters[1:])
    found = ascii_letters[ends[1:]] > ascii_letters[ends[:-1]]
    for i in np.flatnonzero(~found):
        found[i] = any(c.isalpha() for c in texts[int(i)].as_py() or "")
    return found


def _slices(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in parts:
        yield from (part.slice(at, _ROWS) for at in range(0, part.num_rows, _ROWS))


def softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(texts: pa.Array, labels: list[str], epochs: int = 12, steps: int = 900, seed: int = 0) -> Model:
    """Stochastic gradient descent over mini-batches; a fifth of the texts sets temperature and rejection threshold.

    Few texts are gone through more often, until there were ``steps`` steps. The
    temperature minimises the loss on the fifth. The threshold is the highest,
    up to one half, that rejects no more than one in a thousand of its correctly
    labelled texts; where they are fewer, half the score of the least certain.
    """
    languages = sorted(set(labels))
    y = np.searchsorted(languages, labels)
    seen, ends = _bytes(texts)
    rows = []
    for i in range(len(y)):
        b = np.concatenate([_buckets(seen[ends[i] : ends[i + 1]], g) for g in _GRAMS])
        which, counts = np.unique(b, return_counts=True)
        rows.append((which, (counts / max(1, len(b))).astype(np.float32)))
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(y))
    held, rest = order[: len(order) // 5], order[len(order) // 5 :]

    def dense(which: np.ndarray) -> np.ndarray:
        x = np.zeros((len(which), BUCKETS), np.float32)
        for k, i in enumerate(which):
            x[k, rows[i][0]] = rows[i][1]
        return x

    k = len(languages)
    embed = rng.normal(0, 1, (BUCKETS, DIMENSIONS)).astype(np.float32)
    weight, bias = np.zeros((DIMENSIONS, k), np.float32), np.zeros(k, np.float32)
    epochs = max(epochs, -(-32 * steps // max(1, len(rest))))
    for epoch in range(epochs):
        rate = 1 - epoch / epochs
        for start in range(0, len(rest), 32):
            batch = rng.permutation(rest)[:32] if start + 32 > len(rest) else rest[start : start + 32]
            x = dense(batch)
            mean = x @ embed
            error = softmax(mean @ weight + bias)
            error[np.arange(len(batch)), y[batch]] -= 1
            error /= max(1, len(batch))
            back = error @ weight.T
            weight -= 2 * rate * mean.T @ error
            bias -= rate * error.sum(axis=0)
            embed -= 20 * rate * (x.T @ back)
        rest = rng.permutation(rest)
    table = embed @ weight
    if not len(held):
        return Model(languages, table, bias, 1.0, 0.0)
    logits = dense(held) @ table + bias
    truth = y[held]
    # One text more, of any language, keeps the scores honest where all held ones are right.
    aim = np.full(logits.shape, 1 / k / (len(held) + 1))
    aim[np.arange(len(held)), truth] += len(held) / (len(held) + 1)
    loss = {t: -(aim * np.log(softmax(logits / t) + 1e-12)).sum() for t in np.geomspace(0.01, 10, 61)}
    temperature = min(loss, key=loss.get)
    sure = softmax(logits / temperature).max(axis=1)
    right = np.sort(sure[logits.argmax(axis=1) == truth])
    lowest = float(right[len(right) // 1000]) if len(right) else 0.0
    threshold = min(0.5, lowest if len(right) >= 1000 else lowest / 2)
    return Model(languages, table, bias, float(temperature), threshold)


def fit(docs: DataFrame, *, key: str = "doc_id", text: str = "text", lang: str = "lang") -> Model:
    """A model from the texts and languages of documents whose crc32 of the key, modulo 5, is not 0.

    About ``PER_LANGUAGE`` documents of each language, picked by a hash of their
    key. Without labelled documents the model knows one language, ``und``.
    """
    labelled = docs.filter(F.col(lang).isNotNull() & F.col(text).isNotNull() & (remainder(key, 5) != 0)).select(key, text, lang)
    counts = labelled.groupBy(lang).count().withColumn("rate", PER_LANGUAGE / F.col("count"))
    taken = labelled.join(F.broadcast(counts), lang).filter(share(key) < F.col("rate")).select(key, text, lang).toArrow()
    order = pc.sort_indices(taken, [(key, "ascending")])  # the fit does not depend on how rows arrive
    taken = taken.take(order)
    if not len(taken):
        return Model(["und"], np.zeros((BUCKETS, 1), np.float32), np.zeros(1, np.float32), 1.0, 0.0)
    return train(taken.column(text).combine_chunks(), taken.column(lang).to_pylist())


def identify(docs: DataFrame, model: Model, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, lang_pred, score, rejected) for every row.

    A null text or one without a letter is ``und`` with score 0. The score is
    the calibrated probability of the language; ``rejected`` says that it is
    below the threshold, or ``und``. Repeated rows give repeated rows.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        for part in _slices(parts):
            texts = part.column(1)
            seen, ends = _bytes(texts)
            sums, count = _sums(seen, ends, m.table)
            p = softmax((sums / np.maximum(count, 1)[:, None] + m.bias) / m.temperature)
            known, best = _letters(texts, seen, ends), p.argmax(axis=1)
            score = np.where(known, p.max(axis=1), 0.0)
            names = np.where(known, np.array(m.languages, object)[best], "und")
            columns = [part.column(0), pa.array(names, pa.string()), pa.array(score), pa.array(~known | (score < m.threshold))]
            yield pa.RecordBatch.from_arrays(columns, names=[key, "lang_pred", "score", "rejected"])

    schema = docs.select(key).schema.add("lang_pred", "string").add("score", "double").add("rejected", "boolean")
    return docs.select(key, text).mapInArrow(run, schema)


def accepted(docs: DataFrame, model: Model, *, text: str = "text") -> DataFrame:
    """``docs`` without the documents that ``identify`` rejects; all columns stay as they are."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        for part in _slices(parts):
            seen, ends = _bytes(part.column(at))
            sums, count = _sums(seen, ends, m.table)
            score = softmax((sums / np.maximum(count, 1)[:, None] + m.bias) / m.temperature).max(axis=1)
            yield part.filter(pa.array(_letters(part.column(at), seen, ends) & (score >= m.threshold)))

    return docs.mapInArrow(run, docs.schema)
