"""Mixture-controlled packing: every window holds the sources in their target token proportions.

Documents wait in one queue per source.  A window is filled by deficit round
robin: each queue's deficit grows by its share of the window, queues are served
in turn up to their deficits, and what a queue could not be given is carried to
the next window.  Documents are cut where a window or a queue's turn ends.

Queues are long, so they are cut into blocks of about ``block_windows`` windows
that are filled side by side.  Block ``b`` of ``B`` takes from a queue of ``n``
tokens those from ``floor(n * b / B)`` on; the fraction left out is the deficit
that the queue carries into the block.  Where a block's tokens end, the rest is
laid out in sequences whose lengths are powers of two, so nothing is padded.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dialwright.llm.common import prepare, stored
from dialwright.llm.encoding import encoded
from dialwright.session import local_frame

_PIECES = "row_no long, start long, length long, sequence_id long, offset long"
_SEQUENCES_PER_BLOCK = 1 << 20


def token_queues(docs: DataFrame, tokenizer_path: str, *, end_id: int, key: str, text: str, source: str) -> DataFrame:
    """Encode whole texts; per document its queue, its ids and the tokens of its queue before it in its part.

    A queue is a source: a null source is one of its own.  ``part`` is the input
    partition, which orders the queue together with the order of rows in it.
    """
    prepare(docs.sparkSession)
    queue = F.when(F.col(source).isNull(), "").otherwise(F.concat(F.lit("="), F.col(source).cast("string")))
    rows = docs.select(
        F.monotonically_increasing_id().alias("row_no"), F.col(key), queue.alias("__queue"), F.col(text).alias("__text")
    )
    kind = rows.schema[key].dataType.simpleString()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        passed: dict[str, int] = {}
        for batch in batches:
            before, lengths, wide, blobs = [], [], [], []
            for queue, ids in zip(batch.column("__queue").to_pylist(), encoded(tokenizer_path, batch.column("__text"), end_id), strict=True):
                before.append(passed.get(queue, 0))
                passed[queue] = before[-1] + len(ids)
                lengths.append(len(ids))
                wide.append(int(ids.max()) > 0xFFFF)
                blobs.append(ids.tobytes() if wide[-1] else ids.astype("<u2").tobytes())
            number = batch.column("row_no")
            yield pa.RecordBatch.from_arrays(
                [
                    number,
                    batch.column(key),
                    batch.column("__queue"),
                    pa.array(number.to_numpy() >> 33),  # the partition in a monotonically increasing id
                    pa.array(before, pa.int64()),
                    pa.array(lengths, pa.int64()),
                    pa.array(wide, pa.bool_()),
                    pa.array(blobs, pa.binary()),
                ],
                names=["row_no", key, "queue", "part", "before", "doc_tokens", "wide", "ids"],
            )

    return rows.mapInArrow(
        encode, f"row_no long, `{key}` {kind}, queue string, part long, before long, doc_tokens long, wide boolean, ids binary"
    )


def phases(totals: dict[str, int], targets: dict[str, float]) -> list[tuple[str, int, int, int]]:
    """Stretches (queue, phase, first token, tokens) in which the same queues keep their targets.

    A phase ends when its first queue is empty; the others go on with their
    targets scaled up.
    """
    used = dict.fromkeys(totals, 0)
    found, number = [], 0
    while True:
        left = {q: totals[q] - used[q] for q in totals if totals[q] > used[q] and targets[q] > 0}
        if not left:
            return found
        first = min(left, key=lambda q: (left[q] / targets[q], q))
        scale = left[first] / targets[first]
        for q in sorted(left):
            n = left[q] if q == first else min(left[q], int(targets[q] * scale))
            if n:
                found.append((q, number, used[q], n))
                used[q] += n
        number += 1


def _stretches(held: DataFrame, targets: dict[str, float] | None, capacity: int, block_windows: int) -> DataFrame:
    """Per queue its stretches, with the number of blocks of their phase and the first block's number."""
    spark = held.sparkSession
    sums = held.groupBy("queue").agg(F.sum("held").alias("tokens"))
    if targets is None:
        whole = sums.select("queue", F.lit(0).alias("phase"), F.lit(0).cast("long").alias("at"), "tokens")
    else:
        named = {f"={name}": share for name, share in targets.items()}
        # As many rows as the caller named sources.
        wanted = local_frame(spark, [(q,) for q in named], "queue string")
        totals = {r.queue: r.tokens for r in sums.join(wanted, "queue", "left_semi").collect()}
        made = phases(totals, {q: float(named[q]) for q in totals})
        planned = {q for q, *_ in made}
        last = 1 + max((p for _, p, _, _ in made), default=-1)
        rest = sums.join(local_frame(spark, [(q,) for q in planned], "queue string"), "queue", "left_anti")
        whole = local_frame(spark, made, "queue string, phase int, at long, tokens long").unionByName(
            rest.select("queue", F.lit(last).alias("phase"), F.lit(0).cast("long").alias("at"), "tokens")
        )
    # One row per phase: at most one more than the caller named sources.
    sizes = whole.groupBy("phase").agg(F.sum("tokens").alias("n")).orderBy("phase").collect()
    blocks, base, rows = 0, 0, []
    for size in sizes:
        blocks = max(1, round(size.n / (capacity * block_windows)))
        rows.append((size.phase, blocks, base))
        base += blocks
    return whole.join(local_frame(spark, rows, "phase int, blocks long, block_base long"), "phase")


def capacities(tokens: int, capacity: int) -> np.ndarray:
    """Lengths of a block's sequences: whole windows, then powers of two."""
    full, rest = divmod(tokens, capacity)
    tail = [1 << bit for bit in range(rest.bit_length() - 1, -1, -1) if rest >> bit & 1]
    return np.array([capacity] * full + tail, np.int64)


def round_robin(tokens: np.ndarray, carried: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Tokens that each window (row) takes from each queue (column).

    ``tokens`` is what the queues hold, the sizes' sum; a queue's share of a
    window is its share of all tokens.  ``carried`` are deficits from before the
    first window, fractions of a token; what all queues are owed alike changes
    nothing and is left out.  Deficits are kept in units of one over all tokens,
    so shares are exact.
    """
    total = int(tokens.sum())
    deficit = ((carried - carried.mean()) * total).astype(np.int64)
    left = tokens.astype(np.int64).copy()
    taken = np.zeros((len(sizes), len(tokens)), np.int32)
    for w, size in enumerate(sizes.tolist()):
        deficit += size * tokens
        # Another queue begins each window.
        turn = np.roll(np.arange(len(tokens)), -(w % len(tokens)))
        wanted = np.clip(deficit // total, 0, left)[turn]
        ahead = np.cumsum(wanted) - wanted
        served = np.zeros(len(tokens), np.int64)
        served[turn] = np.clip(size - ahead, 0, wanted)
        spare = size - int(served.sum())
        while spare:
            # Fractions make up the rest: one token each, the largest deficits first.
            able = np.flatnonzero(left > served)
            first = able[np.argsort(-(deficit - served * total)[able], kind="stable")][:spare]
            served[first] += 1
            spare -= len(first)
        deficit -= served * total
        left -= served
        taken[w] = served
    return taken


def filled(rows: pd.DataFrame, capacity: int) -> pd.DataFrame:
    """Pieces of one block's stretches of documents (queue, ``at`` in the queue, length)."""
    rows = rows.sort_values(["queue", "at"], ignore_index=True)
    queue = rows["queue"].to_numpy()
    heads = np.flatnonzero(np.append(True, queue[1:] != queue[:-1]))
    length = rows["length"].to_numpy(np.int64)
    tokens = np.add.reduceat(length, heads)
    sizes = capacities(int(tokens.sum()), capacity)
    taken = round_robin(tokens, rows["carried"].to_numpy()[heads], sizes)
    within = np.cumsum(taken, axis=1) - taken  # where a queue's tokens begin in a window
    parts = []
    for q, (head, tail) in enumerate(zip(heads, np.append(heads[1:], len(rows)), strict=True)):
        doc_at = np.cumsum(length[head:tail]) - length[head:tail]
        ends = np.cumsum(taken[:, q], dtype=np.int64)
        cuts = np.unique(np.concatenate([doc_at, (ends - taken[:, q])[taken[:, q] > 0]]))
        doc = np.searchsorted(doc_at, cuts, side="right") - 1
        window = np.searchsorted(ends, cuts, side="right")
        parts.append(
            pd.DataFrame(
                {
                    "row_no": rows["row_no"].to_numpy()[head + doc],
                    "start": rows["start"].to_numpy()[head + doc] + cuts - doc_at[doc],
                    "length": np.diff(np.append(cuts, tokens[q])),
                    "sequence_id": rows["block"].iloc[0] * _SEQUENCES_PER_BLOCK + window,
                    "offset": within[window, q] + cuts - (ends - taken[:, q])[window],
                }
            )
        )
    if len(sizes) > _SEQUENCES_PER_BLOCK:
        raise ValueError("a block holds too many sequences to number")
    return pd.concat(parts, ignore_index=True)


def _with_checksums(pieces: DataFrame, queues: DataFrame, key: str) -> DataFrame:
    """One row per piece with the checksum over its ids, which meet their pieces once per document."""
    lists = pieces.groupBy("row_no").agg(F.collect_list(F.struct("start", "length", "sequence_id", "offset")).alias("pieces"))
    rows = queues.select("row_no", F.col(key).alias("__key"), "doc_tokens", "wide", "ids").join(lists, "row_no").drop("row_no")
    kind = queues.schema[key].dataType.simpleString()

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("pieces")
            of = lists.value_parent_indices()
            flat = lists.flatten()
            start, length = (flat.field(i).to_numpy() for i in (0, 1))
            crc = np.empty(len(flat), np.int64)
            doc, ids = -1, np.zeros(0, "<u4")
            wide, blobs = batch.column("wide"), batch.column("ids")
            for i, d in enumerate(of.to_pylist()):
                if d != doc:
                    doc, ids = d, np.frombuffer(blobs[d].as_buffer(), "<u4" if wide[d].as_py() else "<u2").astype("<u4")
                crc[i] = zlib.crc32(ids[start[i] : start[i] + length[i]])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("__key").take(of),
                    flat.field(0),
                    flat.field(1),
                    pa.array(crc),
                    batch.column("doc_tokens").take(of),
                    flat.field(2),
                    flat.field(3),
                ],
                names=[key, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
            )

    return rows.mapInArrow(
        check, f"`{key}` {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    )


def pack_mixture(
    docs: DataFrame,
    tokenizer_path: str,
    *,
    capacity: int = 4096,
    end_id: int = 2,
    targets: dict[str, float] | None = None,
    block_windows: int = 256,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """Pack all documents into windows that hold the sources in target proportions; one row per piece.

    ``targets`` gives token shares per source; without it every window mirrors
    the whole corpus.  Sources without a target follow when the named ones are
    used up, and a source that ends early leaves its room to the others.
    ``capacity`` is a power of two.

    Columns: key, ``start`` (the document's ids before the piece), ``length``,
    ``ids_crc32`` (ids as little-endian uint32), ``doc_tokens`` (with the end
    id), ``sequence_id``, ``offset``.  Every id lies in exactly one piece.  A
    null or empty text gives the end id alone; a null source is a source; rows
    with the same or no key are documents of their own; an empty table gives an
    empty result.  Other columns are ignored, whatever their names.

    A source's queue is cut into blocks by arithmetic, so a dominant source
    spreads over as many tasks as its tokens need, and a task holds the pieces
    of one block of about ``block_windows * capacity`` tokens.
    """
    if capacity & (capacity - 1):
        raise ValueError("the capacity is not a power of two")
    if targets is not None and not all(0 <= share < float("inf") for share in targets.values()):
        raise ValueError("a target is negative or not finite")
    queues = stored(token_queues(docs, tokenizer_path, end_id=end_id, key=key, text=text, source=source), "queues")
    held = stored(queues.groupBy("queue", "part").agg(F.sum("doc_tokens").alias("held")), "queue-parts")
    # Rows per queue: the input's partitions.
    earlier = Window.partitionBy("queue").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = held.select("queue", "part", F.coalesce(F.sum("held").over(earlier), F.lit(0)).alias("base"))
    stretches = stored(_stretches(held, targets, capacity, block_windows), "stretches")

    placed = (
        queues.select("row_no", "queue", "part", "before", "doc_tokens")
        .join(bases, ["queue", "part"])
        .select("row_no", "queue", (F.col("base") + F.col("before")).alias("head"), "doc_tokens")
        .join(stretches, "queue")
        .withColumn("lo", F.greatest("head", "at") - F.col("at"))
        .withColumn("hi", F.least(F.col("head") + F.col("doc_tokens"), F.col("at") + F.col("tokens")) - F.col("at"))
        .filter("lo < hi")
    )
    # Token x of a stretch of n lies in block ceil((x + 1) * B / n) - 1; wide numbers, since the product may exceed a long.
    block_of = "(CAST({x} + 1 AS DECIMAL(19,0)) * CAST(blocks AS DECIMAL(18,0)) + tokens - 1) DIV tokens - 1"
    # Fewer tokens than blocks: each token has a block of its own, and blocks without one are not made.
    blocks = (
        f"CASE WHEN tokens >= blocks THEN sequence({block_of.format(x='lo')}, {block_of.format(x='(hi - 1)')}) "
        f"ELSE transform(sequence(lo, hi - 1), x -> {block_of.format(x='x')}) END"
    )
    bound = "CAST((CAST(tokens AS DECIMAL(19,0)) * CAST({b} AS DECIMAL(18,0))) DIV blocks AS LONG)"
    cut = (
        placed.withColumn("b", F.explode(F.expr(blocks)))
        .withColumn("from", F.greatest("lo", F.expr(bound.format(b="b"))))
        .withColumn("to", F.least("hi", F.expr(bound.format(b="(b + 1)"))))
        .select(
            "row_no",
            "queue",
            (F.col("block_base") + F.col("b")).alias("block"),
            F.col("from").alias("at"),
            (F.col("at") + F.col("from") - F.col("head")).alias("start"),
            (F.col("to") - F.col("from")).alias("length"),
            F.expr("CAST((CAST(tokens AS DECIMAL(19,0)) * CAST(b AS DECIMAL(18,0))) % blocks AS DOUBLE) / blocks").alias("carried"),
        )
    )
    pieces = cut.groupBy("block").applyInPandas(lambda rows: filled(rows, capacity), _PIECES)
    return _with_checksums(pieces, queues, key)
