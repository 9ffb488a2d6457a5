"""Removal of lines that repeat across documents, found with two Bloom filters."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from monthmill.llm.tables import BLANKS, byte_texts, small_side, stored

#: Hashes per shard of the filters, on average.
SHARD = 500_000
#: Filters of twice-seen hashes that are sent to the executors at a time, in bytes.
ROUND_BYTES = 32 << 20
#: Rounds, each of which reads the documents, up to which filters are sent to the lines; beyond, lines go to the filters.
MOST_ROUNDS = 8
#: Lines that meet a copy of their shard's filter in one task, about.
MEETING = 2_000_000
_PROBES = 4
_BLANKS = BLANKS.encode()


class Bloom:
    """A Bloom filter over 64-bit hashes: ``_PROBES`` places of a power of two of bits."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits

    @classmethod
    def sized(cls, entries: int) -> Bloom:
        """Room for so many entries at 8 to 16 bits each."""
        return cls(np.zeros(max(8, 1 << int(entries).bit_length()), np.uint8))

    def _places(self, hashes: np.ndarray) -> np.ndarray:
        step = (hashes * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(20) | np.uint64(1)
        return (hashes[:, None] + step[:, None] * np.arange(_PROBES, dtype=np.uint64)) & np.uint64(8 * len(self.bits) - 1)

    def add(self, hashes: np.ndarray) -> None:
        at = self._places(hashes).ravel()
        np.bitwise_or.at(self.bits, (at >> np.uint64(3)).astype(np.int64), np.uint8(1) << (at & np.uint64(7)).astype(np.uint8))

    def has(self, hashes: np.ndarray) -> np.ndarray:
        at = self._places(hashes)
        return (self.bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8) & 1).all(axis=1)


def keys_of(text: bytes | None) -> list[bytes]:
    """The keys of a text's lines: stripped of ASCII white space, A-Z in lower case."""
    return [line.strip(_BLANKS) for line in (text or b"").lower().split(b"\n")]


def _long_keys(text: bytes | None, least: int) -> set[bytes]:
    return {k for k in keys_of(text) if len(k) >= least and (len(k) >= 4 * least or len(k.decode("utf-8", "replace")) >= least)}


def _identity(key: bytes) -> bytes:
    return hashlib.blake2b(key, digest_size=16).digest()


def _shard(hashes: np.ndarray, shards: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int32)


def _twice_filters(docs: DataFrame, text: str, least: int) -> tuple[DataFrame, int]:
    """(shard, lines, bits): for each range of hashes its number of lines and a filter of those seen in two or more documents."""

    def gather(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A batch sends each hash once, with the number of its documents: a line in a third of all rows stays light.
        for part in parts:
            hashes = np.fromiter((xxh3_64_intdigest(k) for t in byte_texts(part.column(0)) for k in _long_keys(t, least)), np.uint64)
            once, counts = np.unique(hashes, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(once.view(np.int64)), pa.array(counts)], names=["h", "n"])

    hashes = stored(docs.select(text).mapInArrow(gather, "h long, n long"), "line-hashes")
    shards = max(1, -(-hashes.count() // SHARD))

    def place(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            of = _shard(part.column(0).to_numpy().view(np.uint64), shards)
            yield pa.RecordBatch.from_arrays([pa.array(of), *part.columns], names=["shard", "h", "n"])

    def build(group: pa.Table) -> pa.Table:
        h, n = group.column("h").to_numpy().view(np.uint64), group.column("n").to_numpy()
        seen, again = Bloom.sized(len(h)), [h[n > 1]]
        for at in range(0, len(h), 1 << 16):
            part, counts = np.unique(h[at : at + (1 << 16)], return_counts=True)
            again.append(part[(counts > 1) | seen.has(part)])
            seen.add(part)
        found = np.unique(np.concatenate(again))
        out = Bloom.sized(len(found))
        out.add(found)
        return pa.table({"shard": pa.array([group.column("shard")[0].as_py()], pa.int32()), "lines": pa.array([n.sum()], pa.int64()), "bits": pa.array([out.bits.tobytes()], pa.binary())})

    filters = hashes.mapInArrow(place, "shard int, h long, n long").repartition(shards, "shard").groupBy("shard").applyInArrow(build, "shard int, lines long, bits binary")
    return stored(filters, "line-filters"), shards


def _suspects(docs: DataFrame, key: str, text: str, least: int) -> DataFrame:
    """(key, line): the lines of each document, by 128-bit identity, that a twice-seen filter holds."""
    filters, shards = _twice_filters(docs, text, least)
    if (filters.agg(F.sum(F.length("bits"))).first()[0] or 0) > MOST_ROUNDS * ROUND_BYTES:
        return _moved_suspects(docs, filters, shards, key, text, least)
    spark = docs.sparkSession
    rounds: list[list[int]] = [[]]
    size = 0
    for row in filters.select("shard", F.length("bits").alias("size")).orderBy("shard").collect():
        if rounds[-1] and size + row["size"] > ROUND_BYTES:
            rounds.append([])
            size = 0
        rounds[-1].append(row["shard"])
        size += row["size"]

    def one_round(low: int, high: int) -> DataFrame:
        held = spark.sparkContext.broadcast({r.shard: bytes(r.bits) for r in filters.filter(F.col("shard").between(low, high)).collect()})

        def test(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            blooms = {shard: Bloom(np.frombuffer(bits, np.uint8)) for shard, bits in held.value.items()}
            for part in parts:
                lines, rows = [], []
                for row, t in enumerate(byte_texts(part.column(1))):
                    found = _long_keys(t, least)
                    lines += found
                    rows += [row] * len(found)
                hashes = np.fromiter(map(xxh3_64_intdigest, lines), np.uint64, len(lines))
                of, hit = _shard(hashes, shards), np.zeros(len(lines), bool)
                for shard, bloom in blooms.items():
                    mine = np.flatnonzero(of == shard)
                    hit[mine] = bloom.has(hashes[mine])
                at = np.flatnonzero(hit)
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(np.array(rows, np.int64)[at])), pa.array([_identity(lines[i]) for i in at], pa.binary())], names=[key, "line"])

        return docs.select(key, text).mapInArrow(test, docs.select(key).schema.add("line", "binary"))

    found = [one_round(r[0], r[-1]) for r in rounds if r]
    if not found:
        return docs.select(key, F.lit(b"").alias("line")).limit(0)
    whole = found[0]
    for more in found[1:]:
        whole = whole.union(more)
    return whole


def _moved_suspects(docs: DataFrame, filters: DataFrame, shards: int, key: str, text: str, least: int) -> DataFrame:
    """As ``_suspects``: every line's hash and identity moves to its filter, of which a shard with many lines has copies."""
    copies = filters.select("shard", F.ceil(F.col("lines") / MEETING).alias("copies"))

    def name(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            found = [(row, line) for row, t in enumerate(byte_texts(part.column(1))) for line in _long_keys(t, least)]
            hashes = np.fromiter((xxh3_64_intdigest(line) for _, line in found), np.uint64, len(found))
            columns = [part.column(0).take(pa.array([row for row, _ in found], pa.int64())), pa.array([_identity(line) for _, line in found], pa.binary())]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(hashes.view(np.int64)), pa.array(_shard(hashes, shards))], names=[key, "line", "_h", "_shard"])

    def test(lines: pa.Table, bits: pa.Table) -> pa.Table:
        held = bits.column("bits").to_pylist()
        if not held:
            return lines.select([key, "line"]).slice(0, 0)
        return lines.select([key, "line"]).filter(pa.array(Bloom(np.frombuffer(held[0], np.uint8)).has(lines.column("_h").to_numpy().view(np.uint64))))

    own = docs.select(key).schema.add("line", "binary")
    lines = docs.select(key, text).mapInArrow(name, docs.select(key).schema.add("line", "binary").add("_h", "long").add("_shard", "integer"))
    dealt = lines.join(small_side(copies, 32), F.col("_shard") == F.col("shard")).withColumn("_copy", F.pmod(F.xxhash64(key, "line"), F.col("copies")))
    spread = filters.join(copies, "shard").select(F.col("shard").alias("_shard"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)).alias("_copy"), "bits")
    return dealt.select(key, "line", "_h", "_shard", "_copy").groupBy("_shard", "_copy").cogroup(spread.groupBy("_shard", "_copy")).applyInArrow(test, own)


def repeated_lines(docs: DataFrame, least: int = 40, documents: int = 5, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, lines): for each document the identities of the lines it loses to a document with a larger key.

    A first pass sets up filters of hashes seen once and twice, one pair per
    range of hashes; a second one sends on only the lines that a twice-seen
    filter holds, and these are confirmed exactly, by 128-bit identity, with
    the number of distinct documents and the largest key.
    """
    suspects = stored(_suspects(docs, key, text, least).distinct(), "suspects")
    number = F.count("*")  # a null key is one document, and never the largest
    common = stored(suspects.groupBy("line").agg(number.alias("n"), F.max(key).alias("keeper")).filter(F.col("n") >= documents).select("line", "keeper"), "common")
    # The rows of a line that very many documents hold stay where they are, or are split by the skew join.
    lost = suspects.join(small_side(common, 64), "line").filter(~F.col(key).eqNullSafe(F.col("keeper")))
    return lost.groupBy(key).agg(F.collect_list("line").alias("lines"))


def drop_repeated_lines(docs: DataFrame, least: int = 40, documents: int = 5, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with the lines taken out whose key (stripped, A-Z lowered) has ``least`` code points and is in so many documents.

    All such lines go except those in the document with the largest key. Adds
    n_lines (before) and n_dropped; columns of these names are replaced. A null
    or empty text is one empty line and stays as it is; a text that loses all
    its lines is empty. Rows that repeat a key are one document; null keys are
    one document too, never the largest. An empty table stays empty.
    """
    own = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    lost = stored(repeated_lines(docs, least, documents, key=key, text=text).select(F.col(key).alias("_key"), F.col("lines").alias("_lines")), "lost-lines")
    size: Column = F.sum(F.size("_lines"))
    bytes_each = 48 + 24 * (lost.agg(size).first()[0] or 0) // max(1, lost.count())
    joined = docs.select(*own).join(small_side(lost, bytes_each), docs[key].eqNullSafe(F.col("_key")), "left").select(*own, "_lines")
    at = own.index(text)

    def rebuild(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            texts, counts, dropped = byte_texts(part.column(at)), [], []
            gone = part.column(len(own)).to_pylist()
            for row, t in enumerate(texts):
                lines = (t or b"").split(b"\n")
                counts.append(len(lines))
                if gone[row]:
                    out = set(gone[row])
                    kept = [line for line, k in zip(lines, keys_of(t)) if len(k) < least or _identity(k) not in out]
                    texts[row] = b"\n".join(kept)
                    dropped.append(len(lines) - len(kept))
                else:
                    dropped.append(0)
            columns = list(part.columns[: len(own)])
            columns[at] = pa.array(texts, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([*columns, pa.array(counts, pa.int64()), pa.array(dropped, pa.int64())], names=[*own, "n_lines", "n_dropped"])

    return joined.mapInArrow(rebuild, docs.select(*own).schema.add("n_lines", "long").add("n_dropped", "long"))
