"""Near-duplicate texts: SimHash and BK-trees find candidates, exact shingle sets decide.

Two texts are linked if the sets of their shingles have a Jaccard similarity of
at least ``similarity``.  At 0.8 a SimHash bit differs with probability 0.15, so
equal blocks of bits that lose no pair would be three bits wide and shard
nothing.  The shards are therefore bands of minimum hashes, of which texts at
0.8 share one of 3 with probability 0.51 and one of 12 such bands almost surely.
Each task searches the BK-trees of its shards within a radius that loses few
pairs at the threshold.  What is found connects candidate groups only: every
group's sets then meet in tiles, where a pair is linked after an exact count.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dialwright.llm.common import first_of_each, prepare, runs, stored
from dialwright.llm.graph import components
from dialwright.llm.simhash import _LOWER, BKTree, _with_end

BANDS, ROWS = 12, 3
RADIUS = 34  # of 128 bits
PART_ROWS = 2048
PART_BYTES = 8 << 20
_RANDOM = np.random.default_rng(5)
_MASKS = _RANDOM.integers(0, 1 << 64, BANDS * ROWS, np.uint64)
_FACTORS = _RANDOM.integers(0, 1 << 64, BANDS * ROWS, np.uint64) | np.uint64(1)


def shingle_hashes(text: str | None, shingle_words: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct shingles in ascending order, and 128 bits of each.

    A text with fewer words is one shingle; one without words has none.
    """
    from xxhash import xxh3_128_digest

    words = (text or "").encode().translate(_LOWER).split()
    if not words:
        return np.zeros(0, np.uint64), np.zeros((0, 16), np.uint8)
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    n = max(len(words) - shingle_words + 1, 1)
    starts = (ends - lengths)[:n].tolist()
    stops = ends[min(shingle_words, len(words)) - 1 :].tolist()
    digests = b"".join([xxh3_128_digest(joined[s:e]) for s, e in zip(starts, stops, strict=True)])
    octets = np.frombuffer(digests, np.uint8).reshape(n, 16)
    hashes, first = np.unique(np.ascontiguousarray(octets[:, :8]).view("<u8")[:, 0], return_index=True)
    return hashes, octets[first]


def sketch(text: str | None, shingle_words: int) -> tuple[int, int, int, list[int]]:
    """A name for the set of shingles, the two halves of its 128-bit SimHash, and its bands; all as signed longs."""
    from xxhash import xxh64_intdigest

    hashes, octets = shingle_hashes(text, shingle_words)
    if not len(hashes):
        return 0, 0, 0, []
    counts = np.zeros(128, np.int64)
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(hashes), 1 << 12):
        counts += np.unpackbits(octets[at : at + (1 << 12)], axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        mixed = (hashes[at : at + (1 << 12), None] ^ _MASKS) * _FACTORS
        np.minimum(least, mixed.min(axis=0), out=least)
    halves = np.packbits(2 * counts > len(hashes), bitorder="little").view("<i8").tolist()
    bands = [xxh64_intdigest(band.tobytes(), i) for i, band in enumerate(least.reshape(BANDS, ROWS))]
    return (
        int(np.uint64(xxh64_intdigest(hashes.tobytes())).view(np.int64)),
        halves[0],
        halves[1],
        np.array(bands, np.uint64).view(np.int64).tolist(),
    )


def _sketches(docs: DataFrame, shingle_words: int, key: str, text: str) -> DataFrame:
    """Per row the key, ``words`` (a hash of the text), ``node`` (its shingle set), ``low``, ``high`` and ``bands``."""
    source = docs.select(F.col(key).alias("key"), F.xxhash64(text).alias("words"), F.col(text).alias("text"))
    kind = source.schema["key"].dataType.simpleString()

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sketch(t, shingle_words) for t in batch.column("text").to_pylist()]
            columns = [pa.array([f[i] for f in found], pa.int64()) for i in range(3)]
            bands = pa.array([f[3] for f in found], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("words"), *columns, bands],
                names=["key", "words", "node", "low", "high", "bands"],
            )

    return source.mapInArrow(mark, f"key {kind}, words long, node long, low long, high long, bands array<long>")


def _in_tiles(rows: DataFrame, parts: DataFrame, *group: str) -> DataFrame:
    """``rows`` of each group dealt to tiles of two of its parts, so that every pair meets.

    ``parts`` names the groups that are kept and how many parts each has.
    """
    dealt = (
        rows.join(parts, list(group))
        .withColumn("own", F.pmod(F.xxhash64("node"), F.col("parts")))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    )
    one, two = F.least("own", "other"), F.greatest("own", "other")
    # Two tiles with the same 64-bit name only share a tree: still right.
    return (
        dealt.withColumns({"tile": F.xxhash64(*group, one, two), "in_tree": F.col("own") == one, "searches": F.col("own") == two})
        .drop(*group, "parts", "own", "other")
        .repartition("tile")
        .sortWithinPartitions("tile", "in_tree")
    )


class _Forest:
    """Union by smallest place."""

    def __init__(self, n: int) -> None:
        self.root = list(range(n))

    def top(self, i: int) -> int:
        root = self.root
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    def join(self, i: int, j: int) -> bool:
        x, y = self.top(i), self.top(j)
        self.root[max(x, y)] = min(x, y)
        return x != y


def _walk(values: list[int], in_tree: list[bool], searches: list[bool], radius: int) -> Iterator[tuple[int, list[int]]]:
    """Each searching place with the places in the tree that are near it; no pair comes twice."""
    tree = BKTree()
    members: list[int] = []
    # In a mixed tile the tree comes first; elsewhere each value searches those before it.
    for i in sorted(range(len(values)), key=lambda i: searches[i]):
        if searches[i]:
            yield i, [members[place] for place in tree.near(values[i], radius)]
        if in_tree[i]:
            tree.add(values[i])
            members.append(i)


def candidate_links(classes: DataFrame, *, radius: int = RADIUS, tile: int = PART_ROWS) -> DataFrame:
    """Edges ``a``, ``b`` that connect all nodes which share a band and are near by fingerprint."""
    rows = classes.select("node", "low", "high", F.explode("bands").alias("band"))
    sizes = rows.groupBy("band").agg(F.count("*").alias("n")).where("n > 1")
    parts = sizes.select("band", F.ceil(F.col("n") / tile).alias("parts"))
    tiled = _in_tiles(rows, parts, "band").select("tile", "node", "low", "high", "in_tree", "searches")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None
        for batch in _with_end(batches):
            if batch is not None:
                new = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(6)]
                held = new if held is None else [np.concatenate(x) for x in zip(held, new, strict=True)]
            if held is None:
                continue
            name, nodes, low, high, in_tree, searches = held
            cuts = np.flatnonzero(name[1:] != name[:-1]) + 1
            # The last tile may go on in the next batch.
            done = len(name) if batch is None else int(cuts[-1]) if len(cuts) else 0
            edges: list[tuple[int, int]] = []
            for start, end in zip([0, *cuts.tolist()], [*cuts.tolist(), len(name)], strict=True):
                if end <= done and end - start > 1:
                    values = _values(low[start:end], high[start:end])
                    forest = _Forest(end - start)
                    for i, near in _walk(values, in_tree[start:end].tolist(), searches[start:end].tolist(), radius):
                        edges += [(start + i, start + j) for j in near if forest.join(i, j)]
            if edges:
                ends_of = nodes[np.array(edges)]
                yield pa.RecordBatch.from_arrays([pa.array(ends_of[:, 0]), pa.array(ends_of[:, 1])], names=["a", "b"])
            held = [x[done:] for x in held]

    return tiled.mapInArrow(search, "a long, b long")


def _values(low: np.ndarray, high: np.ndarray) -> list[int]:
    """Fingerprints of 128 bits."""
    return [b << 64 | a for a, b in zip(low.view(np.uint64).tolist(), high.view(np.uint64).tolist(), strict=True)]


def _verified(sets: list[np.ndarray], values: list[int], in_tree: list[bool], searches: list[bool], radius: int, similarity: float) -> list[tuple[int, int]]:
    """A spanning forest of the exact links between the sets of one tile."""
    flat, places = np.unique(np.concatenate(sets), return_inverse=True)
    sizes = np.array([len(s) for s in sets])
    coded = np.split(places.astype(np.int32), np.cumsum(sizes)[:-1])
    marked = np.zeros(len(flat), bool)
    forest = _Forest(len(sets))
    edges = []
    for i, near in _walk(values, in_tree, searches, radius):
        least, most = similarity * sizes[i], sizes[i] / similarity
        left = [j for j in near if least <= sizes[j] * (1 + 1e-9) and sizes[j] <= most * (1 + 1e-9)]
        marked[coded[i]] = True
        many = 1
        # Few at first: one link often joins the group that all others are in.
        while left := [j for j in left if forest.top(j) != forest.top(i)]:
            some, left = left[:many], left[many:]
            starts = np.append(0, np.cumsum(sizes[some])[:-1])
            shared = np.add.reduceat(marked[np.concatenate([coded[j] for j in some])].astype(np.int64), starts)
            union = sizes[i] + sizes[some] - shared
            edges += [(i, j) for j, near_enough in zip(some, shared >= similarity * union - 1e-9, strict=True) if near_enough and forest.join(i, j)]
            many = min(4 * many, 256)
        marked[coded[i]] = False
    return edges


def exact_links(members: DataFrame, *, similarity: float, radius: int = RADIUS, tile: int = PART_ROWS) -> DataFrame:
    """Edges ``a``, ``b`` that connect the nodes of each candidate group whose sets are similar enough.

    A large group is dealt into parts by rows and bytes; every two parts meet in one task.
    """
    sizes = members.groupBy("component").agg(F.count("*").alias("n"), F.sum(F.length("hashes")).alias("bytes"))
    parts = sizes.select("component", F.greatest(F.ceil(F.col("n") / tile), F.ceil(F.col("bytes") / PART_BYTES)).alias("parts"))
    tiled = _in_tiles(members, parts, "component")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in runs(batches, "tile"):
            sets = [np.frombuffer(h, "<u8") for h in group.column("hashes").to_pylist()]
            values = _values(group.column("low").to_numpy(), group.column("high").to_numpy())
            edges = _verified(sets, values, group.column("in_tree").to_pylist(), group.column("searches").to_pylist(), radius, similarity)
            if edges:
                ends_of = group.column("node").to_numpy()[np.array(edges)]
                yield pa.RecordBatch.from_arrays([pa.array(ends_of[:, 0]), pa.array(ends_of[:, 1])], names=["a", "b"])

    return tiled.mapInArrow(verify, "a long, b long")


def _shingle_sets(texts: DataFrame, shingle_words: int) -> DataFrame:
    """``text`` replaced by ``hashes``, its packed shingle hashes."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_hashes(t, shingle_words)[0].tobytes() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("component", "node", "low", "high")), pa.array(sets, pa.binary())],
                names=["component", "node", "low", "high", "hashes"],
            )

    return texts.mapInArrow(pack, "component long, node long, low long, high long, hashes binary")


def similar_texts(
    docs: DataFrame, *, similarity: float = 0.8, shingle_words: int = 5, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``key`` and ``component_id`` (smallest key reachable by links) per row.

    Rows are linked if the Jaccard similarity of their texts' sets of shingles
    (64-bit hashes, ASCII case folded) is at least ``similarity``; texts without
    words are equal.  Bands and radius are laid out for 0.8 and more: a lone pair
    at 0.8 is missed in less than 1 of 1,000 cases.  Rows with a null key link
    like others and take the smallest key of their group, null if it has none.
    """
    prepare(docs.sparkSession)
    marked = stored(_sketches(docs, shingle_words, key, text), "sketches")
    classes = stored(
        marked.groupBy("node").agg(
            F.min("key").alias("least"), F.min("words").alias("words"), *(F.first(c).alias(c) for c in ("low", "high", "bands"))
        ),
        "sketch-classes",
    )
    groups = components(candidate_links(classes))
    wanted = classes.join(groups, "node").select("component", "node", "low", "high", "words")
    # Only texts of classes with a candidate move; copies are combined before the shuffle.
    asked = wanted.select(F.col("words").alias("__asked")).distinct()
    held = docs.join(asked, F.xxhash64(text) == F.col("__asked"), "left_semi")
    texts = held.groupBy(F.xxhash64(text).alias("words")).agg(F.first(text).alias("text"))
    members = stored(
        _shingle_sets(wanted.join(texts, "words").select("component", "node", "low", "high", "text"), shingle_words), "shingle-sets"
    )
    found = components(exact_links(members, similarity=similarity))
    grouped = classes.join(found, "node", "left").select("node", "least", F.coalesce("component", "node").alias("component"))
    smallest = grouped.groupBy("component").agg(F.min("least").alias("component_id"))
    named = grouped.join(smallest, "component").select("node", "component_id")
    return marked.join(named, "node").select("key", "component_id")


def one_of_each(docs: DataFrame, *, similarity: float = 0.8, shingle_words: int = 5, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay: of each group of similar texts the one with the smallest key.

    Rows with the same key are one document and the one whose text has the
    smallest hash stays.  Rows
    without a key cannot be named and all stay.
    """
    grouped = similar_texts(docs, similarity=similarity, shingle_words=shingle_words, key=key, text=text)
    stay = grouped.where("component_id = key").select(F.col("key").alias("__kept")).distinct()
    # Join and choice share the partitioning on the key: texts move once.
    kept = first_of_each(docs.join(stay, F.col(key) == F.col("__kept"), "left_semi"), key, text)
    return kept.union(docs.where(F.col(key).isNull()))
