"""Near duplicates by SimHash: fingerprints joined by Hamming distance in vantage-point trees."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from monthmill.llm.graph import components, local_components
from monthmill.llm.tables import byte_texts, numbered, share, small_side, stored

#: Fingerprints from which vantage points and radii are chosen. They shape the tree, not its results.
SAMPLE = 1 << 16
#: Fingerprints that live in one shard, on average.
SHARD = 8192
#: A part of a shard of so many fingerprints is compared directly.
DIRECT = 128
_BITS = (np.arange(256)[:, None] >> np.arange(8)) & 1
_BYTE = 256 * np.arange(8)


class Node(NamedTuple):
    """A vantage point: the left branch holds what lies within ``radius`` of it. A leaf has its number only."""

    leaf: int
    vantage: np.uint64 = np.uint64(0)
    radius: int = 0
    left: "Node | None" = None
    right: "Node | None" = None


def fingerprint(text: bytes | None, shingle: int = 3) -> int:
    """The 64-bit SimHash of a text's word shingles, as a signed number. No words: zero."""
    words = (text or b"").lower().split()  # on bytes: A-Z and ASCII white space only
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        hashes = np.array([xxh64_intdigest(joined, 42)], np.uint64)
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        parts = map(slice, starts[: len(words) - shingle + 1].tolist(), ends[shingle - 1 :].tolist())
        hashes = np.fromiter(map(xxh64_intdigest, map(joined.__getitem__, parts), repeat(42)), np.uint64, len(words) - shingle + 1)
    seen = np.bincount((hashes.view(np.uint8).reshape(-1, 8) + _BYTE).ravel(), minlength=2048).reshape(8, 256) @ _BITS
    return int(np.packbits(2 * seen.ravel() > len(hashes), bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, shingle: int = 3, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, fp) for every row of ``docs``; null texts have fingerprint zero."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            codes = pa.array([fingerprint(x, shingle) for x in byte_texts(part.column(1))], pa.int64())
            yield pa.RecordBatch.from_arrays([part.column(0), codes], names=[key, "fp"])

    schema = docs.select(key).schema.add("fp", "long")
    return docs.select(key, text).mapInArrow(run, schema)


def _distance(codes: np.ndarray, vantage: np.uint64) -> np.ndarray:
    return np.bitwise_count(codes ^ vantage).astype(np.int16)


def _split(codes: np.ndarray, bits: int) -> tuple[np.uint64, int] | None:
    """The vantage point, of eight, that leaves the fewest codes at its border, with its median distance as radius."""
    best = None
    for vantage in codes[:: max(1, len(codes) // 8)][:8]:
        d = _distance(codes, vantage)
        radius = int(np.partition(d, (len(d) - 1) // 2)[(len(d) - 1) // 2])
        if radius >= d.max():  # ties reach the end: all would be left
            radius = int(d.max()) - 1
        left = int((d <= radius).sum())
        if radius < 0 or left == 0 or left == len(d):
            continue
        cost = int(((d > radius - bits) & (d <= radius + bits)).sum()) + abs(len(d) - 2 * left)
        if best is None or cost < best[0]:
            best = cost, vantage, radius
    return best and best[1:]


def _branches(codes: np.ndarray, homes: np.ndarray, guests: np.ndarray, vantage: np.uint64, radius: int, bits: int):
    """Homes and guests (indexes into ``codes``) of the left and the right branch.

    By the triangle inequality a code beyond ``radius + bits`` has no partner
    on the left, and one within ``radius - bits`` none on the right. A home of
    the right within the border visits the left as a guest, so each pair across
    the border is met once.
    """
    at, of = _distance(codes[homes], vantage), _distance(codes[guests], vantage)
    inside = at <= radius
    border = homes[~inside & (at <= radius + bits)]
    return (homes[inside], np.concatenate((guests[of <= radius + bits], border))), (homes[~inside], guests[of > radius - bits])


def build(codes: np.ndarray, leaves: int, bits: int) -> Node:
    """A tree of about so many leaves over a sample of codes."""
    count = iter(range(2 * leaves + 1))

    def grow(part: np.ndarray, wanted: int) -> Node:
        cut = _split(part, bits) if wanted > 1 and len(part) > 1 else None
        if cut is None:
            return Node(next(count))
        inside = _distance(part, cut[0]) <= cut[1]
        return Node(-1, *cut, grow(part[inside], wanted // 2), grow(part[~inside], wanted // 2))

    return grow(codes, leaves)


def _route(tree: Node, codes: np.ndarray, bits: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    todo = [(tree, np.arange(len(codes)), np.zeros(0, np.int64))]
    while todo:
        node, homes, guests = todo.pop()
        if not len(homes) and not len(guests):
            continue
        if node.left is None:
            yield node.leaf, homes, guests
            continue
        left, right = _branches(codes, homes, guests, node.vantage, node.radius, bits)
        todo += [(node.left, *left), (node.right, *right)]


def _links(codes: np.ndarray, homes: np.ndarray, guests: np.ndarray, bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links of homes with homes and with guests, each group of a comparison reduced to a star."""
    todo = [(homes, guests)]
    while todo:
        homes, guests = todo.pop()
        if not len(homes) or len(homes) + len(guests) < 2:
            continue
        cut = _split(codes[homes], bits) if len(homes) > DIRECT else None
        if cut is not None:
            todo += _branches(codes, homes, guests, *cut, bits)
            continue
        for start in range(0, len(homes), DIRECT):
            own = homes[start : start + DIRECT]
            others = np.concatenate((homes[start:], guests))
            for at in range(0, len(others), 1 << 16):
                part = others[at : at + (1 << 16)]
                i, j = np.nonzero(np.bitwise_count(codes[own][:, None] ^ codes[part]) <= bits)
                i, j = own[i], part[j]
                i, j = i[i != j], j[i != j]
                if len(i):
                    members, places = np.unique(np.concatenate((i, j)), return_inverse=True)
                    root = local_components(len(members), places[: len(i)], places[len(i) :])
                    yield members[root != np.arange(len(root))], members[root[root != np.arange(len(root))]]


def near_links(codes: DataFrame, bits: int = 3) -> DataFrame:
    """Edges (a, b) that connect the distinct codes ``fp`` as links of at most ``bits`` differing bits do.

    A vantage-point tree over a sample of the codes (at most about ``SAMPLE``)
    deals all codes out to shards; a code near the border of a branch is sent
    to the other one as well, so every pair meets in a shard. Each shard goes on
    with a tree of its own and gives back one star per group it finds: rows
    follow the number of codes, whatever the number of pairs.
    """
    n = codes.count()
    spark = codes.sparkSession
    picked = codes.filter(share("fp") < SAMPLE / max(n, 1)).select("fp").toArrow().column("fp").to_numpy().view(np.uint64)
    leaves = 1 << max(0, int(np.ceil(np.log2(max(n, 1) / SHARD))))
    tree = spark.sparkContext.broadcast(build(np.sort(picked), leaves, bits))

    def deal(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            values = part.column(0).to_numpy()
            for leaf, homes, guests in _route(tree.value, values.view(np.uint64), bits):
                rows = np.concatenate((homes, guests))
                columns = [np.full(len(rows), leaf, np.int32), values[rows], np.arange(len(rows)) < len(homes)]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=["shard", "fp", "home"])

    def join(table: pa.Table) -> pa.Table:
        values, home = table.column("fp").to_numpy(), table.column("home").to_numpy()
        order = np.argsort(values)
        values, home = values[order], home[order]
        found = list(_links(values.view(np.uint64), np.flatnonzero(home), np.flatnonzero(~home), bits))
        a, b = (np.concatenate([x[k] for x in found] or [np.zeros(0, np.int64)]) for k in (0, 1))
        root = local_components(len(values), a, b)
        below = np.flatnonzero(root != np.arange(len(root)))
        return pa.table({"a": values[below], "b": values[root[below]]}, schema=pa.schema([("a", pa.int64()), ("b", pa.int64())]))

    dealt = codes.select("fp").mapInArrow(deal, "shard int, fp long, home boolean")
    tasks = max(leaves // 2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return dealt.repartition(tasks, "shard").groupBy("shard").applyInArrow(join, "a long, b long")


def near_duplicates(docs: DataFrame, shingle: int = 3, bits: int = 3, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: key, fp, group (a code of its component) and component_id, the smallest key of the component.

    Only distinct fingerprints are joined; copies share theirs. Null and
    wordless texts have fingerprint zero and are linked like any other. A null
    key is passed over when the smallest is taken; a component of null keys has
    a null component_id. Rows with one key twice are two rows. Other columns
    are not read. An empty table gives an empty table.
    """
    prints = stored(fingerprints(docs, shingle, key=key, text=text), "fingerprints")
    codes = stored(prints.groupBy("fp").agg(F.min(key).alias("first")), "codes")
    group = components(near_links(codes, bits)).withColumnsRenamed({"node": "fp", "component": "group"})
    grouped = stored(codes.join(group, "fp", "left").select("fp", "first", F.coalesce("group", "fp").alias("group")), "groups")
    firsts = grouped.groupBy("group").agg(F.min("first").alias("component_id"))
    named = grouped.select("fp", "group").join(firsts, "group")
    return prints.join(named, "fp").select(key, "fp", "group", "component_id")


def hexadecimal(column: str):
    """A signed 64-bit number as 16 lower-case hexadecimal digits."""
    return F.lower(F.lpad(F.hex(column), 16, "0"))


def without_near_duplicates(docs: DataFrame, shingle: int = 3, bits: int = 3, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each group of near duplicates, the one with the smallest key, a null key last.

    Decisions are made per row: rows that share a key are documents of their
    own, and one of several equal rows stays. Columns of any type and name are
    kept as they are. An empty table gives an empty table.
    """
    rows, row = numbered(docs)
    who = F.struct(F.col(key).isNull().alias("unnamed"), F.col(key).alias("key"), F.col(row).alias("row"))
    found = near_duplicates(rows.select(who.alias("who"), F.col(text).alias("text")), shingle, bits, key="who", text="text")
    gone = stored(found.filter(F.col("who") != F.col("component_id")).select(F.col("who.row").alias(row)), "removed")
    return rows.join(small_side(gone, 16), row, "left_anti").select(*docs.columns)
