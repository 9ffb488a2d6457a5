"""Exact token counts: huge texts in overlapping chunks that are spliced where both encodings must agree."""

from __future__ import annotations

import os
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthmill.llm.tables import buffers

#: Code points of a chunk, and by how many the next one overlaps it at first. Longer texts are huge.
CHUNK = 1 << 16
OVERLAP = 1 << 10
#: Bytes of shorter texts whose pieces are looked up at a time.
WINDOW = 16 << 20
#: Pieces whose counts a task remembers.
REMEMBERED = 500_000

_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True


@lru_cache(maxsize=1)
def _joins_before() -> frozenset[str]:
    """Characters that normalisation may move, or compose with the character before them."""
    joins = {chr(c) for c in [*range(0x1161, 0x1176), *range(0x11A8, 0x11C3)]}
    for code in range(0x110000):
        char = chr(code)
        parts = unicodedata.decomposition(char).split()
        if len(parts) == 2 and parts[0][0] != "<":
            joins.add(chr(int(parts[1], 16)))
        if unicodedata.combining(char):
            joins.add(char)
    return frozenset(joins)


def _kind(char: str) -> str:
    """The class of a character in the pattern that cuts words: blank, L, N or o (other); empty if it may depend on others."""
    category = unicodedata.category(char)
    if char in "\t\n\x0b\x0c\r \x85" or category in ("Zs", "Zl", "Zp"):
        return "blank"
    if category in ("Cn", "Cs", "Cc") or category[0] == "M":
        return ""
    return category[0] if category[0] in "LN" else "o"


def stable(left: str, right: str) -> bool:
    """Whether every text is cut into words between these two neighbours, whatever stands around them.

    A word of the vocabulary's pattern is a run of letters, one digit, a run
    of other characters, or an apostrophe with a short ending; blanks separate
    words. So two characters of different classes, or two blanks, belong to
    different words, except behind an apostrophe, and a digit stands alone.
    That holds for the normalised text as well if neither character composes
    with what stands before it and both keep their class when lowered.
    """
    kinds = []
    for char in (left, right):
        if ord(char) >= 128 and (char in _joins_before() or any(c in _joins_before() for c in unicodedata.normalize("NFD", char)[:1])):
            return False
        forms = {_kind(c) for c in unicodedata.normalize("NFC", char).lower()} | {_kind(char)}
        if len(forms) != 1 or "" in forms:
            return False
        kinds.append(forms.pop())
    if "blank" in kinds:
        return True
    if left in "'" or unicodedata.normalize("NFC", left) == "'":
        return False
    return kinds[0] != kinds[1] or kinds[0] == "N"


class Counter:
    """Counts tokens with a tokenizer given as the text of its JSON file."""

    def __init__(self, vocabulary: str):
        # One thread: Spark runs a task per core.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(vocabulary)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.known: dict[bytes, int] = {}

    def encode(self, texts: list[str]) -> list[int]:
        return [len(e) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _encoded(self, text: str, start: int, stop: int) -> tuple[np.ndarray, np.ndarray]:
        """First and last + 1 code point of every token of text[start:stop], counted in the whole text."""
        offsets = np.array(self.tokenizer.encode(text[start:stop], add_special_tokens=False).offsets, np.int64).reshape(-1, 2) + start
        return offsets[:, 0], offsets[:, 1]

    def _in_special(self, text: str, at: int) -> bool:
        """Whether a special string of the tokenizer lies across a place."""
        for special in self.special:
            found = text.find(special, max(0, at - len(special) + 1), at + len(special) - 1)
            if found != -1 and found < at:
                return True
        return False

    def _splice(self, text: str, start: int, stop: int, one: tuple, other: tuple) -> tuple[int, int, int] | None:
        """A place inside [start, stop] at which two encodings part: (place, tokens of the first before it, tokens of the second before it)."""
        middle = (start + stop) // 2
        for at in sorted(range(start + 1, stop), key=lambda p: abs(p - middle)):
            if not stable(text[at - 1], text[at]) or self._in_special(text, at):
                continue
            cuts = []
            for begins, ends in (one, other):
                before = int(np.searchsorted(ends, at, side="right"))
                # All tokens from there on start behind the place.
                cuts.append(before if before == len(begins) or begins[before] >= at else -1)
            if min(cuts) >= 0:
                return at, *cuts
        return None

    def huge(self, text: str) -> int:
        """Tokens of a text of any length.

        Chunks of ``CHUNK`` code points are encoded with offsets, each
        reaching back into the one before. In the overlap a place is sought
        that is stable and at which both encodings part two tokens; the first
        one counts up to there, the second one from there. Where there is none
        the overlap doubles, on both sides: the next chunk starts earlier and
        the chunk before goes on further, up to the whole text in one.
        """
        total, start, stop, base = 0, 0, min(CHUNK, len(text)), 0
        one = self._encoded(text, start, stop)
        # ``base`` tokens of the present chunk were counted with the chunk before.
        while stop < len(text):
            overlap = OVERLAP
            while True:
                low = max(start, stop - overlap)
                end = min(len(text), low + max(CHUNK, 2 * overlap))
                other = self._encoded(text, low, end)
                spliced = self._splice(text, low, stop, one, other)
                if spliced and spliced[1] >= base:
                    break
                overlap *= 2
                if low == start:
                    # No place in all of the chunk: it goes on further.
                    stop = end
                    one = self._encoded(text, start, stop)
                    if stop == len(text):
                        return total + len(one[0]) - base
            total += spliced[1] - base
            start, stop, base, one = low, end, spliced[2], other
        return total + len(one[0]) - base

    def pieces(self, texts: pa.Array) -> np.ndarray:
        """Tokens of each of a column of shorter texts.

        A text is cut at ASCII blanks, which are stable places and belong to no
        token and no special string; each distinct piece is encoded once.
        """
        data, ends = buffers(texts)
        out = np.zeros(len(ends) - 1, np.int64)
        first = 0
        while first < len(out):
            last = max(first + 1, int(np.searchsorted(ends, ends[first] + WINDOW, side="right")) - 1)
            part, borders = data[ends[first] : ends[last]], ends[first : last + 1] - ends[first]
            inside = ~_BLANK[part]
            opens = inside.copy()
            opens[1:] &= ~inside[:-1]
            cut = borders[borders < len(part)]
            opens[cut] = inside[cut]
            begins = np.flatnonzero(opens)
            if len(begins):
                lengths = np.add.reduceat(inside, begins, dtype=np.int64)
                words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(begins), [None, pa.py_buffer(np.concatenate(([0], np.cumsum(lengths)))), pa.py_buffer(part[inside])])
                coded = words.dictionary_encode()
                counts = self._counts(coded.dictionary.to_pylist())[coded.indices.to_numpy()]
                text = np.searchsorted(borders, begins, side="right") - 1
                out[first:last] = np.bincount(text, counts, last - first).astype(np.int64)
            first = last
        return out

    def _counts(self, words: list[bytes]) -> np.ndarray:
        unknown = [w for w in words if w not in self.known]
        if len(self.known) + len(unknown) > REMEMBERED:
            self.known, unknown = {}, words
        self.known.update(zip(unknown, self.encode([w.decode() for w in unknown])))
        return np.fromiter((self.known[w] for w in words), np.int64, len(words))


def count_tokens(docs: DataFrame, vocabulary: str, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (key, n_bytes, n_tokens), one per document: the tokens of its whole text as the tokenizer of the JSON file ``vocabulary`` gives them.

    No begin, end or other token is added, nothing is cut or filled up;
    special strings inside a text are special tokens, as is the library's
    default. Texts longer than ``CHUNK`` code points are encoded in
    overlapping chunks (``Counter.huge``); of the shorter ones every distinct
    piece between blanks is encoded once. Both rest on places where a word
    ends whatever surrounds it (``stable``), which holds for vocabularies that
    cut words by ``'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+``
    and drop blanks; others are refused.

    A null text is empty and has 0 tokens. Rows are independent: repeated rows
    and null keys stay as they are, an empty table gives an empty table, other
    columns are ignored. The file is read by the driver and sent to the tasks;
    vocabularies have some megabytes, whatever the documents.
    """
    with open(vocabulary, encoding="utf-8") as file:
        content = file.read()
    if r"[^\\s\\p{L}\\p{N}]+" not in content or '"behavior":"Removed"' not in "".join(content.split()):
        raise ValueError("the vocabulary must cut words by classes of characters and drop blanks")
    shared = docs.sparkSession.sparkContext.broadcast(content)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(shared.value)
        for batch in batches:
            texts = batch.column(2)
            long = pc.fill_null(pc.greater(pc.utf8_length(texts), CHUNK), False)
            tokens = counter.pieces(pc.if_else(long, pa.scalar(None, texts.type), texts))
            for row in np.flatnonzero(long.to_numpy(zero_copy_only=False)):
                tokens[row] = counter.huge(texts[row].as_py())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(tokens)], ["key", "n_bytes", "n_tokens"])

    name = docs.schema[key].dataType.simpleString()
    size = F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("long")
    found = docs.select(F.col(key).alias("key"), size.alias("n_bytes"), F.col(text).alias("text")).mapInArrow(counted, f"key {name}, n_bytes long, n_tokens long")
    return found.withColumnRenamed("key", key)
