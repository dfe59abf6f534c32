"""Near-duplicates by SimHash fingerprints, found with BK-trees.

A BK-tree keeps under each node one child per Hamming distance to that node.  A
search within radius r follows only children at distances d - r to d + r, since
by the triangle inequality nothing else can be near.  One tree over all
fingerprints would have to be sent everywhere and would grow with the corpus.
So the fingerprints are cut into shards that lose no pair: of radius + 1 equal
blocks of bits at least one agrees between two fingerprints within the radius,
and every fingerprint goes to one shard per block.  Each task builds the trees
of its shards and searches them with the same shards' fingerprints.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dialwright.llm.common import first_of_each, prepare, stored
from dialwright.llm.graph import components

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def fingerprint(text: str | None, shingle_words: int = 3, seed: int = 42) -> int:
    """64-bit SimHash: a bit is set if it is set in over half the shingles' XXH64 values.

    Repeated shingles count each time; a text with fewer words is one shingle,
    and one without words has fingerprint 0.
    """
    from xxhash import xxh64_intdigest

    words = (text or "").encode().translate(_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle_words:
        return xxh64_intdigest(joined, seed)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: len(words) - shingle_words + 1].tolist()
    hashes = np.array(
        [xxh64_intdigest(joined[s:e], seed) for s, e in zip(starts, ends[shingle_words - 1 :].tolist(), strict=True)], "<u8"
    )
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 15):
        octets = hashes[at : at + (1 << 15)].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(hashes), bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, *, shingle_words: int = 3, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The key and ``fp``, the fingerprint as a signed long, per row."""
    prepare(docs.sparkSession)
    source = docs.select(F.col(key), F.col(text).alias("__text"))
    kind = source.schema[key].dataType.simpleString()

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t, shingle_words) for t in batch.column("__text").to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(key), pa.array(found.view(np.int64))], names=[key, "fp"])

    return source.mapInArrow(mark, f"`{key}` {kind}, fp long")


class BKTree:
    """Fingerprints in a tree by Hamming distance."""

    def __init__(self) -> None:
        self.values: list[int] = []
        self.children: list[dict[int, int]] = []

    def near(self, value: int, radius: int) -> list[int]:
        """Places of all members within ``radius`` of ``value``."""
        found = []
        stack = [0] if self.values else []
        values, children = self.values, self.children
        while stack:
            at = stack.pop()
            distance = (values[at] ^ value).bit_count()
            if distance <= radius:
                found.append(at)
            if below := children[at]:
                low, high = distance - radius, distance + radius
                stack += [child for edge, child in below.items() if low <= edge <= high]
        return found

    def add(self, value: int) -> None:
        """Hang ``value`` under the last node its distances lead to."""
        new = len(self.values)
        self.values.append(value)
        self.children.append({})
        at = 0
        while at != new:
            distance = (self.values[at] ^ value).bit_count()
            at = self.children[at].setdefault(distance, new)


def _links(values: list[int], tree_rows: list[bool], query_rows: list[bool], radius: int) -> list[tuple[int, int]]:
    """A spanning forest of the links within one shard."""
    tree = BKTree()
    members: list[int] = []
    root = list(range(len(values)))
    edges = []

    def top(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    # In a mixed tile the tree comes first; elsewhere each value searches those before it.
    mixed = not all(t and q for t, q in zip(tree_rows, query_rows, strict=True))
    order = sorted(range(len(values)), key=lambda i: query_rows[i]) if mixed else range(len(values))
    for i in order:
        if query_rows[i]:
            for place in tree.near(values[i], radius):
                x, y = top(i), top(members[place])
                if x != y:
                    root[max(x, y)] = min(x, y)
                    edges.append((values[i], values[members[place]]))
        if tree_rows[i]:
            tree.add(values[i])
            members.append(i)
    return edges


def _shard_rows(unique: DataFrame, radius: int, bits: int, tile: int) -> DataFrame:
    """One row per fingerprint and block; a shard of more than ``tile`` rows is cut into tiles.

    Rows of a large shard are dealt into parts, and a tile holds two parts (or
    one with itself): together they meet every pair, no tile holds more than
    about two parts, and a part's rows go to as many tiles as there are parts.
    """
    width = bits // (radius + 1)
    blocks = [
        F.struct(F.lit(i).alias("block"), F.shiftrightunsigned("fp", i * width).bitwiseAND((1 << width) - 1).alias("value"))
        for i in range(radius + 1)
    ]
    rows = unique.select("fp", F.explode(F.array(*blocks)).alias("shard")).select("fp", "shard.*")
    sizes = rows.groupBy("block", "value").count().where(F.col("count") > tile)
    parts = F.coalesce(F.ceil(F.col("count") / tile), F.lit(1))
    dealt = (
        rows.join(sizes, ["block", "value"], "left")
        .withColumn("parts", parts)
        .withColumn("own", F.pmod(F.xxhash64("fp"), F.col("parts")))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    )
    low, high = F.least("own", "other"), F.greatest("own", "other")
    return dealt.select(
        F.struct("block", "value", low.alias("low"), high.alias("high")).alias("shard"),
        "fp",
        (F.col("own") == low).alias("in_tree"),
        (F.col("own") == high).alias("searches"),
    ).select(F.xxhash64("shard").alias("shard"), "fp", "in_tree", "searches")


def link_fingerprints(unique: DataFrame, *, radius: int = 3, bits: int = 64, tile: int = 2048) -> DataFrame:
    """Edges ``a``, ``b`` that connect all distinct fingerprints within ``radius`` of each other.

    Not all pairs are returned: within a shard's tile links that join nothing
    new are left out, so a task returns fewer edges than it has rows.
    """
    prepare(unique.sparkSession)
    # Two shards with the same 64-bit name only share a tree: still right.
    rows = _shard_rows(unique, radius, bits, tile).repartition("shard").sortWithinPartitions("shard")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None
        for batch in _with_end(batches):
            if batch is not None:
                new = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(4)]
                held = new if held is None else [np.concatenate(x) for x in zip(held, new, strict=True)]
            if held is None:
                continue
            shard, values, in_tree, searches = held
            cuts = np.flatnonzero(shard[1:] != shard[:-1]) + 1
            # The last shard may go on in the next batch.
            done = len(shard) if batch is None else int(cuts[-1]) if len(cuts) else 0
            starts = np.append(0, cuts)
            ends = np.append(cuts, len(shard))
            edges: list[tuple[int, int]] = []
            unsigned = values.view(np.uint64)
            for start, end in zip(starts.tolist(), ends.tolist(), strict=True):
                if end <= done and end - start > 1:
                    edges += _links(
                        unsigned[start:end].tolist(), in_tree[start:end].tolist(), searches[start:end].tolist(), radius
                    )
            held = [x[done:] for x in held]
            if edges:
                ends_of = np.array(edges, np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(ends_of[:, 0]), pa.array(ends_of[:, 1])], names=["a", "b"])

    return rows.mapInArrow(search, "a long, b long")


def _with_end(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    yield from batches
    yield None


def hex_digits(fp: Column) -> Column:
    """A fingerprint as 16 lower-case hexadecimal digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def near_duplicates(
    docs: DataFrame, *, radius: int = 3, shingle_words: int = 3, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``fingerprint`` and ``component_id`` (smallest key reachable by links) per row.

    Fingerprints that differ in at most ``radius`` bits are linked; equal ones
    are one node, so thousands of copies cost one search.  A null text has no
    words and so fingerprint 0, which links like any other.  Rows with a null
    key keep their fingerprint and take the smallest key of their group, null if
    it has none.  Repeated rows come back as often as they came, an empty table
    gives an empty result, further columns are left out.
    """
    marked = stored(fingerprints(docs, shingle_words=shingle_words, key=key, text=text), "fingerprints")
    unique = marked.groupBy("fp").agg(F.min(key).alias("least"))
    found = components(link_fingerprints(unique.select("fp"), radius=radius))
    grouped = unique.join(found.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("component")
    )
    smallest = grouped.groupBy("component").agg(F.min("least").alias("component_id"))
    classes = grouped.join(smallest, "component").select("fp", "component_id")
    return marked.join(classes, "fp").select(key, hex_digits(F.col("fp")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, *, radius: int = 3, shingle_words: int = 3, key: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` that stay: of each group of near-duplicates the one with the smallest key.

    Rows with the same key are one document and the one whose text has the
    smallest hash stays.  Rows
    without a key cannot be named and all stay.
    """
    grouped = near_duplicates(docs, radius=radius, shingle_words=shingle_words, key=key)
    stay = grouped.where(F.col("component_id") == F.col(key)).select(F.col(key).alias("__kept")).distinct()
    # Join and choice share the partitioning on the key: texts move once.
    kept = first_of_each(docs.join(stay, F.col(key) == F.col("__kept"), "left_semi"), key, "text")
    return kept.union(docs.where(F.col(key).isNull()))
