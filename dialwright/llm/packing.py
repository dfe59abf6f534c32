"""Sum-of-squares packing of token pieces into sequences of a fixed length.

A bin's gap is what is still free in it.  A piece goes where the sum over all
gaps of the squared number of open bins with that gap becomes smallest, so the
gaps stay spread out and later pieces find one that fits exactly.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dialwright.llm.common import prepare, stored
from dialwright.llm.encoding import encoded


def token_pieces(
    docs: DataFrame,
    tokenizer_path: str,
    *,
    capacity: int = 2048,
    end_id: int = 0,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Encode whole texts, add the end id and cut only what is longer than ``capacity``.

    The remainder of a long document is its first piece, so all later pieces
    fill a sequence.  Returns per piece: key, ``row_no`` (tells repeated keys
    apart), ``piece``, ``start`` (the document's ids before it), ``length`` and
    ``ids_crc32`` over the ids as little-endian uint32.  A null text is empty and
    gives one piece with the end id alone.
    """
    prepare(docs.sparkSession)
    source = docs.select(F.col(key), F.col(text).alias("__text"), F.monotonically_increasing_id().alias("row_no"))
    kind = source.schema[key].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple[int, int, int, int, int]] = []
            for i, ids in enumerate(encoded(tokenizer_path, batch.column("__text"), end_id)):
                first = len(ids) % capacity or capacity
                starts = [0, *range(first, len(ids), capacity)]
                for piece, start in enumerate(starts):
                    part = ids[start : start + (capacity if piece else first)]
                    rows.append((i, piece, start, len(part), zlib.crc32(part.tobytes())))
            of, piece, start, length, crc = (np.array(c, np.int64) for c in zip(*rows, strict=True)) if rows else [np.zeros(0, np.int64)] * 5
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(key).take(pa.array(of)),
                    batch.column("row_no").take(pa.array(of)),
                    pa.array(piece.astype(np.int32)),
                    pa.array(start),
                    pa.array(length),
                    pa.array(crc),
                ],
                names=[key, "row_no", "piece", "start", "length", "ids_crc32"],
            )

    fields = f"`{key}` {kind}, row_no long, piece int, start long, length long, ids_crc32 long"
    return source.mapInArrow(cut, fields)


def sum_of_squares(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each length, taken longest first; every length is 1 to ``capacity``.

    A new bin is opened only when no open one has room, since the aim is few
    bins; among equal sums the smallest remaining gap wins.
    """
    bins = np.empty(len(lengths), np.int64)
    offsets = np.zeros(len(lengths), np.int64)
    full = np.flatnonzero(lengths == capacity)
    bins[full] = np.arange(len(full))
    made = len(full)
    open_bins: list[list[int]] = [[] for _ in range(capacity)]  # by gap
    count = np.zeros(capacity, np.int64)  # of open bins, by gap
    for i in np.argsort(-lengths, kind="stable")[len(full) :]:
        size = int(lengths[i])
        # Index h: the gap afterwards.  A bin leaves gap h + size and, unless it
        # is full then, joins gap h; n squared turns into n squared -+ 2 n + 1.
        before = count[size:]
        change = 2 * (count[: capacity - size] - before)
        change[0] = -2 * before[0] - 1
        change[before == 0] = np.iinfo(np.int64).max
        gap = int(change.argmin())
        if before[gap]:
            number = open_bins[gap + size].pop()
            count[gap + size] -= 1
            offsets[i] = capacity - gap - size
        else:
            gap, number = capacity - size, made
            made += 1
        bins[i] = number
        if gap:
            open_bins[gap].append(number)
            count[gap] += 1
    return bins, offsets


def pack(
    pieces: DataFrame,
    *,
    capacity: int = 2048,
    shard_pieces: int = 1 << 16,
    length: str = "length",
) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces of 1 to ``capacity`` tokens.

    Pieces are dealt by hash into shards of about ``shard_pieces`` and each
    shard is packed on its own, so a task's work is bounded and a shard leaves
    at most a few sequences partly filled.  The deal uses ``row_no``, so equal
    keys, sources or lengths cannot pile up in one shard.  Sequence ids are
    shard + shards * bin, unique over all shards.  Evaluates ``pieces`` twice
    (a count and the packing): hand in a stored table.  An empty table gives an
    empty result; lengths outside 1 to ``capacity`` raise; further columns of
    ``pieces`` are kept.
    """
    shards = max(1, -(-pieces.count() // shard_pieces))
    schema = pieces.schema.add("sequence_id", "long").add("offset", "long")

    def packed(shard: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        sizes = rows[length].to_numpy(np.int64)
        if len(sizes) and not (1 <= sizes.min() and sizes.max() <= capacity):
            raise ValueError(f"a piece is not 1 to {capacity} tokens long")
        bins, offsets = sum_of_squares(sizes, capacity)
        rows["sequence_id"] = bins * shards + shard[0]
        rows["offset"] = offsets
        return rows.drop(columns="__shard")

    order = ["row_no", "piece"]
    dealt = pieces.withColumn("__shard", F.pmod(F.xxhash64(*order), F.lit(shards)))

    def ordered(shard: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        return packed(shard, rows.sort_values(order, ignore_index=True))

    return dealt.groupBy("__shard").applyInPandas(ordered, schema)


def pack_documents(docs: DataFrame, tokenizer_path: str, *, capacity: int = 2048, end_id: int = 0) -> DataFrame:
    """Encode, cut and pack documents; one row per piece.

    Rows with the same id are packed as separate documents.
    """
    pieces = stored(token_pieces(docs, tokenizer_path, capacity=capacity, end_id=end_id), "pieces")
    return pack(pieces, capacity=capacity)
