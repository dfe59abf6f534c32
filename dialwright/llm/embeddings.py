"""Embedding near-duplicates by sorted projection passes.

A pass gives every vector a key, the signs of many random projections written
one after another, and orders all vectors by it.  Vectors at a small angle
share long prefixes and stand close together, so each is compared with the
``window`` that follow it.  Passes use other projections; the union of their
verified pairs gives the groups.

Three things make this whole.  Equal vectors are one class from the start.
Vectors that share a key's first bits are a range; a range that is longer than
the window, as in a dense cluster, is compared whole in tiles.  So two vectors
are compared whenever they share a range in any pass, and the number of passes
follows the number of rows (:func:`passes_for`).  And windows and ranges only
have to *connect* a group: all links inside a group are then counted exactly,
tile by tile, however many members it has.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dialwright.llm.common import drop_stored, prepare, runs, stored
from dialwright.llm.graph import components

KEY_BITS = 62
#: Largest chance that a lone pair at the threshold is in no common range of any pass.
MISS = 0.005
LEAST_PASSES = 16
#: Passes whose sorted vectors are on disk at the same time.
ROUND = 16


def range_bits(n: int, window: int) -> int:
    """Leading key bits that cut ``n`` evenly spread vectors into ranges of half a window or less."""
    return min(KEY_BITS, max(0, math.ceil(math.log2(2 * max(n, 1) / window))))


def passes_for(n: int, window: int, threshold: float) -> int:
    """Passes after which two vectors at the threshold lack a common range with probability ``MISS`` at most."""
    shared = (1 - math.acos(max(-1.0, min(1.0, threshold))) / math.pi) ** range_bits(n, window)
    return LEAST_PASSES if shared >= 1 else max(LEAST_PASSES, math.ceil(math.log(MISS) / math.log1p(-shared)))


def unit_rows(vectors: list[bytes], dtype: str) -> np.ndarray:
    """The vectors as rows of length 1, in double precision."""
    rows = np.frombuffer(b"".join(vectors), dtype).astype(np.float64).reshape(len(vectors), -1)
    return scaled(rows)


def scaled(rows: np.ndarray) -> np.ndarray:
    """Rows divided by their lengths, by their largest component first so that squares neither overflow nor vanish."""
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def usable_vectors(vectors: DataFrame, key: str, embedding: str) -> DataFrame:
    """``id``, ``vec`` (packed components) of the rows that can link: no null, zero or non-finite vector, no null id."""
    kind = vectors.schema[embedding].dataType.elementType
    dtype = "<f4" if isinstance(kind, T.FloatType) else "<f8"
    source = vectors.select(F.col(key).cast("long").alias("id"), F.col(embedding).alias("vec")).where("id is not null and vec is not null")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, packed = [], []
            for number, values in zip(batch.column("id").to_pylist(), batch.column("vec"), strict=True):
                parts = values.values
                if parts.null_count or not len(parts):
                    continue
                row = parts.to_numpy(zero_copy_only=False).astype(dtype)
                if np.isfinite(row).all() and row.any():
                    ids.append(number)
                    packed.append(row.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(packed, pa.binary())], names=["id", "vec"])

    return source.mapInArrow(pack, "id long, vec binary")


def _sorted_by_pass(classes: DataFrame, dtype: str, passes: range, bits: int, seed: int) -> DataFrame:
    """Every vector once per pass, with its place in the order of (dimension, pass, key) and its ``range`` of ``bits`` bits."""

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = (1 << np.arange(KEY_BITS, dtype=np.int64))[::-1]
        planes: dict[int, np.ndarray] = {}
        for batch in batches:
            packed = batch.column("vec").to_pylist()
            sizes = np.array([len(v) for v in packed])
            for size in np.unique(sizes):
                rows = np.flatnonzero(sizes == size)
                units = unit_rows([packed[i] for i in rows], dtype)
                if size not in planes:
                    planes[size] = np.hstack(
                        [np.random.default_rng([seed, int(size), p]).standard_normal((units.shape[1], KEY_BITS)) for p in passes]
                    )
                signs = (units @ planes[size] > 0).reshape(len(rows), len(passes), KEY_BITS)
                keys = signs @ weights
                some = batch.take(pa.array(rows))
                for p in range(len(passes)):
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(len(rows), int(size) * len(passes) + p)),
                            pa.array(keys[:, p]),
                            some.column("rep"),
                            some.column("vec"),
                        ],
                        names=["pass", "key", "rep", "vec"],
                    )

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(n, part)),
                    pa.array(np.arange(at, at + n)),
                    batch.column("pass"),
                    pa.array(batch.column("key").to_numpy() >> (KEY_BITS - bits)),
                    batch.column("rep"),
                    batch.column("vec"),
                ],
                names=["part", "at", "pass", "range", "rep", "vec"],
            )
            at += n

    order = ["pass", "key", "rep"]
    ordered = (
        classes.select("rep", "vec")
        .mapInArrow(keyed, "pass long, key long, rep long, vec binary")
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
    )
    return stored(
        ordered.mapInArrow(placed, "part long, at long, pass long, range long, rep long, vec binary"), "sorted-passes"
    )


def _ranked(held: DataFrame) -> DataFrame:
    """Sorted vectors with their ``rank`` over all partitions."""
    # One row per partition; partitions follow each other in key order.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = held.groupBy("part").agg(F.count("*").alias("n"))
    bases = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    return held.join(bases, "part").select((F.col("base") + F.col("at")).alias("rank"), "rep", "vec")


def forest(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Smallest member of each one's group, for links between 0 .. n - 1."""
    label = np.arange(n)
    while len(left):
        low = np.minimum(label[left], label[right])
        before = label.copy()
        np.minimum.at(label, left, low)
        np.minimum.at(label, right, low)
        label = label[label]
        if np.array_equal(label, before):
            break
    return label


def linked_in_windows(held: DataFrame, dtype: str, *, threshold: float, window: int, block: int) -> DataFrame:
    """Edges ``a``, ``b`` between class representatives that a window verified.

    Blocks of ``block`` ranks, with the next ``window`` ranks behind them, are
    compared in a task each, so nothing depends on where Spark cuts its
    partitions.  A block returns a spanning forest of its links.
    """
    ranked = _ranked(held)
    own = F.floor(F.col("rank") / block).cast("long")
    # The first rows of a block also close the windows of the block before.
    also = F.when((F.col("rank") % block < window) & (own > 0), F.array(own, own - 1)).otherwise(F.array(own))
    rows = (
        ranked.select(F.explode(also).alias("block"), "rank", "rep", "vec")
        .repartition("block")
        .sortWithinPartitions("block", "rank")
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in runs(batches, "block"):
            packed = group.column("vec").to_pylist()
            reps = group.column("rep").to_numpy()
            sizes = np.array([len(v) for v in packed])
            lefts, rights = [], []
            for size in np.unique(sizes):
                rows_of = np.flatnonzero(sizes == size)
                units = unit_rows([packed[i] for i in rows_of], dtype)
                for start in range(0, len(units), window):
                    part = units[start : start + window]
                    ahead = units[start : start + 2 * window]
                    i, j = np.nonzero(part @ ahead.T >= threshold)
                    near = (j > i) & (j <= i + window)
                    lefts.append(rows_of[start + i[near]])
                    rights.append(rows_of[start + j[near]])
            label = forest(len(reps), np.concatenate(lefts), np.concatenate(rights))
            moved = np.flatnonzero(label != np.arange(len(label)))
            yield pa.RecordBatch.from_arrays([pa.array(reps[moved]), pa.array(reps[label[moved]])], names=["a", "b"])

    return rows.mapInArrow(compare, "a long, b long")


def linked_in_ranges(held: DataFrame, dtype: str, *, threshold: float, window: int, tile: int) -> DataFrame:
    """Edges ``a``, ``b`` that connect all links inside the ranges that are longer than a window.

    Any two vectors of a shorter range are in one window.  A longer range is
    dealt into parts and every two parts meet in one task, as in
    :func:`links_in_groups`.
    """
    sizes = held.groupBy("pass", "range").agg(F.count("*").alias("n")).where(F.col("n") > window)
    dealt = (
        held.select("pass", "range", "rep", "vec")
        .join(sizes, ["pass", "range"])
        .withColumn("parts", F.ceil(F.col("n") / tile))
        .withColumn("own", F.pmod(F.xxhash64("rep"), F.col("parts")))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    )
    order = ["pass", "range", "low", "high"]
    rows = dealt.select("pass", "range", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "own", "rep", "vec")
    named = rows.withColumn("tile", F.xxhash64(*order)).repartition("tile").sortWithinPartitions("tile", *order)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in runs(batches, "tile", *order):
            reps, own = (group.column(c).to_numpy() for c in ("rep", "own"))
            # A pass has vectors of one length only.
            units = unit_rows(group.column("vec").to_pylist(), dtype)
            mixed = group.column("low")[0].as_py() != group.column("high")[0].as_py()
            lefts, rights = [], []
            for start in range(0, len(units), 512):
                near = units[start : start + 512] @ units.T >= threshold
                if mixed:
                    near &= own[start : start + 512, None] != own[None, :]
                i, j = np.nonzero(near)
                i, j = start + i[j > start + i], j[j > start + i]
                label = forest(len(reps), i, j)
                moved = np.flatnonzero(label != np.arange(len(label)))
                lefts.append(moved)
                rights.append(label[moved])
            label = forest(len(reps), np.concatenate(lefts), np.concatenate(rights))
            moved = np.flatnonzero(label != np.arange(len(label)))
            yield pa.RecordBatch.from_arrays([pa.array(reps[moved]), pa.array(reps[label[moved]])], names=["a", "b"])

    return named.mapInArrow(compare, "a long, b long")


def links_in_groups(members: DataFrame, dtype: str, *, threshold: float, tile: int = 2048) -> DataFrame:
    """``rep`` and ``links``: vectors of other classes linked to it, counted over its whole group.

    A group of more than ``tile`` classes is dealt into parts and every pair of
    parts meets in one task, so no task holds more than about two parts and only
    counts leave it.
    """
    sizes = members.groupBy("component").agg(F.count("*").alias("n"))
    parts = F.ceil(F.col("n") / tile)
    dealt = (
        members.join(sizes, "component")
        .withColumn("parts", parts)
        .withColumn("own", F.pmod(F.xxhash64("rep"), F.col("parts")))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    )
    rows = dealt.select(
        "component", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "own", "rep", "vec", "copies"
    )
    order = ["component", "low", "high"]
    named = rows.withColumn("tile", F.xxhash64(*order)).repartition("tile").sortWithinPartitions("tile", *order)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found_reps, found = [], []
        for group in runs(batches, "tile", *order):
            reps, copies, own = (group.column(c).to_numpy() for c in ("rep", "copies", "own"))
            packed = group.column("vec").to_pylist()
            sizes_of = np.array([len(v) for v in packed])
            mixed = group.column("low")[0].as_py() != group.column("high")[0].as_py()
            links = np.zeros(len(reps), np.int64)
            for size in np.unique(sizes_of):
                same = np.flatnonzero(sizes_of == size)
                units = unit_rows([packed[i] for i in same], dtype)
                for start in range(0, len(same), 512):
                    rows_of = same[start : start + 512]
                    near = units[start : start + 512] @ units.T >= threshold
                    if mixed:
                        near &= own[rows_of][:, None] != own[same][None, :]
                    else:
                        near[np.arange(len(rows_of)), start + np.arange(len(rows_of))] = False
                    links[rows_of] += near @ copies[same]
            found_reps.append(reps)
            found.append(links)
            if sum(map(len, found)) >= 1 << 14:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found_reps)), pa.array(np.concatenate(found))], names=["rep", "links"])
                found_reps, found = [], []
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found_reps)), pa.array(np.concatenate(found))], names=["rep", "links"])

    return named.mapInArrow(count, "rep long, links long").groupBy("rep").agg(F.sum("links").alias("links"))


def near_duplicates(
    vectors: DataFrame,
    *,
    threshold: float = 0.9,
    passes: int | None = None,
    window: int = 256,
    block: int = 2048,
    seed: int = 11,
    key: str = "vec_id",
    embedding: str = "embedding",
) -> DataFrame:
    """Per vector the key, ``n_links``, ``component_id`` and ``kept`` (key equals component).

    Links are pairs with a cosine of at least ``threshold``, in double
    precision, between vectors of the same length.  Every link returned or
    counted is verified, and all links between members of one group are counted.
    A link is missed only if no chain of windows and ranges in any pass joins
    its two groups.  Without ``passes`` their number follows the rows, so that a
    lone pair at the threshold is missed with a probability of ``MISS`` at most,
    however many rows there are and however dense they lie around it.

    Null, zero or non-finite vectors and rows without a key link with nothing:
    ``n_links`` 0 and their own group.  A repeated row is a further vector; different
    vectors under one key count as one member, with the most links any of them has.  An empty table gives an empty result;
    other columns are left out.
    """
    spark = vectors.sparkSession
    prepare(spark)
    kind = vectors.schema[embedding].dataType.elementType
    dtype = "<f4" if isinstance(kind, T.FloatType) else "<f8"
    usable = stored(usable_vectors(vectors, key, embedding), "vectors")
    classes = stored(
        usable.groupBy("vec").agg(F.min("id").alias("rep"), F.count("*").alias("copies")), "vector-classes"
    )
    n = classes.count()
    bits = range_bits(n, window)
    total = passes_for(n, window, threshold) if passes is None else passes
    found = []
    for first in range(0, total, ROUND):
        held = _sorted_by_pass(classes, dtype, range(first, min(first + ROUND, total)), bits, seed)
        in_windows = linked_in_windows(held, dtype, threshold=threshold, window=window, block=block)
        in_ranges = linked_in_ranges(held, dtype, threshold=threshold, window=window, tile=block)
        found.append(stored(in_windows.union(in_ranges), "pass-links"))
        drop_stored(spark, held)
    edges = reduce(DataFrame.union, found)
    groups = components(edges)
    members = classes.join(groups.withColumnRenamed("node", "rep"), "rep")
    counted = links_in_groups(members, dtype, threshold=threshold)
    known = (
        classes.join(groups.withColumnRenamed("node", "rep"), "rep", "left")
        .join(counted, "rep", "left")
        .select(
            "vec",
            F.coalesce("component", "rep").alias("component_id"),
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        )
    )
    linked = (
        usable.join(known, "vec")
        .groupBy("id")
        .agg(F.max("n_links").alias("n_links"), F.min("component_id").alias("component_id"))
    )
    number = F.col(key).cast("long")
    return vectors.select(key, number.alias("id")).join(linked, "id", "left").select(
        key,
        F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
        F.coalesce("component_id", "id").alias("component_id"),
        (F.col("id") == F.coalesce("component_id", "id")).alias("kept"),
    )
