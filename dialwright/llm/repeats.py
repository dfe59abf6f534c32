"""Removal of long passages that an earlier document already has, by suffix arrays.

A window (``size`` bytes) is removed where it also starts in a document with a
smaller key.  Suffix arrays of all texts on one machine are out of the question,
so the text is cut into shards that lose nothing:

1. Every window has an anchor, a short string chosen by the window's bytes
   alone, so equal windows have equal anchors.  A window whose anchor occurs in
   one document only cannot repeat; those are most of a corpus and go no further.
2. The others travel, as runs of neighbouring windows with one anchor, to the
   shard of their anchor, where equal windows must meet.
3. A shard sorts the suffixes of its distinct runs (Larsson-Sadakane), takes
   neighbours' common prefixes (Kasai) and so finds equal windows and the
   smallest key that has each.  A shard with too many runs is cut into parts;
   parts are sorted apart, and pairs of parts are merged by binary search of one
   part's windows among the other's.
4. The removed stretches go back to their documents.
"""

from __future__ import annotations

import gc
import hashlib
import time
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dialwright.llm.common import drop_stored, prepare, runs, stored
from dialwright.llm.suffix_arrays import (
    anchor_runs,
    matched,
    suffix_array,
    window_groups,
    window_keys,
)

BYTES_PER_SHARD = 2 << 20  # of corpus text, on average
RUNS_PER_PART = 100_000  # of a shard, some times what an average shard has; about 7 MB of text at most
_NOBODY = np.iinfo(np.int64).max
_SEVERAL = np.uint16(1 << 15)


def _version(text: str) -> Column:
    """Tells different texts under one key apart: 32 bits of their hash."""
    return F.xxhash64(text).bitwiseAND((1 << 32) - 1)


def _keyed(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(F.col(key).cast("long").alias("doc"), _version(text).alias("version"), F.col(text).alias("text"))


def _ids(batch: pa.RecordBatch, column: str) -> np.ndarray:
    return batch.column(column).to_numpy(zero_copy_only=False)


def _pieces(of: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """Value, start and end of each run of equal values in a sorted array."""
    cuts = np.append(np.flatnonzero(np.append(True, of[1:] != of[:-1])), len(of)) if len(of) else [0]
    for start, end in zip(cuts[:-1], cuts[1:], strict=True):
        yield int(of[start]), int(start), int(end)


def repeated_anchors(keyed: DataFrame, shards: int, size: int) -> DataFrame:
    """``doc``, ``version`` and the packed hashes of its anchors that several documents have.

    A batch of documents names each anchor to its shard once, with a mark if
    several of its documents have it, so an anchor in a third of all documents
    costs one entry per batch.  What is shared inside a batch needs no answer;
    the shard answers for the rest.
    """

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        first = TaskContext.get().partitionId() << 32
        for number, batch in enumerate(batches):
            docs = _ids(batch, "doc")
            row, _, _, anchor = anchor_runs([t.encode() for t in batch.column("text").to_pylist()], size)
            order = np.lexsort((row, anchor))
            row, anchor = row[order], anchor[order]
            fresh = np.append(True, (row[1:] != row[:-1]) | (anchor[1:] != anchor[:-1])) if len(row) else np.zeros(0, bool)
            row, anchor = row[fresh].astype(np.uint16), anchor[fresh]
            # Several documents: some row of the anchor differs in key from the first.
            opens = np.append(True, anchor[1:] != anchor[:-1]) if len(anchor) else np.zeros(0, bool)
            of = np.cumsum(opens) - 1
            heads = np.flatnonzero(opens)
            several = np.zeros(len(heads), bool)
            if len(heads):
                np.logical_or.at(several, of, docs[row] != docs[row[heads]][of])
            mine = several[of]
            send_row = row[heads] | np.where(several, _SEVERAL, np.uint16(0))
            send, part = anchor[heads], (anchor[heads] % np.uint64(shards)).astype(np.int64)
            by_part = np.argsort(part, kind="stable")
            send, send_row, part = send[by_part], send_row[by_part], part[by_part]
            rows = [(p, 0, send[s:e].tobytes(), send_row[s:e].tobytes()) for p, s, e in _pieces(part)]
            # These two kinds only pass through on their way back to the batch.
            anywhere = (first + number) % shards
            rows.append((anywhere, 1, anchor[mine].tobytes(), row[mine].tobytes()))
            rows.append((anywhere, 2, docs.astype(np.int64).tobytes(), _ids(batch, "version").astype(np.int64).tobytes()))
            part_of, kind, hashes, members = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(part_of, pa.int64()),
                    pa.array(np.full(len(rows), first + number)),
                    pa.array(kind, pa.int32()),
                    pa.array(hashes, pa.binary()),
                    pa.array(members, pa.binary()),
                ],
                names=["part", "batch", "kind", "hashes", "members"],
            )

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in runs(batches, "part"):
            kinds = group.column("kind").to_numpy()
            passing = group.filter(pa.array(kinds != 0)).drop_columns("part")
            if passing.num_rows:
                yield from passing.combine_chunks().to_batches()
            asked = group.filter(pa.array(kinds == 0))
            if not asked.num_rows:
                continue
            hashes = [np.frombuffer(h, np.uint64) for h in asked.column("hashes").to_pylist()]
            members = np.concatenate([np.frombuffer(m, np.uint16) for m in asked.column("members").to_pylist()])
            of = np.repeat(asked.column("batch").to_numpy(), [len(h) for h in hashes])
            anchor = np.concatenate(hashes)
            order = np.argsort(anchor)
            sorted_anchor = anchor[order]
            opens = np.append(True, sorted_anchor[1:] != sorted_anchor[:-1])
            heads = np.flatnonzero(opens)
            several = np.diff(np.append(heads, len(order))) > 1
            group_of = np.empty(len(order), np.int64)
            group_of[order] = np.cumsum(opens) - 1
            tell = several[group_of] & (members < _SEVERAL)
            of, anchor, members = of[tell], anchor[tell], members[tell]
            by_batch = np.argsort(of, kind="stable")
            of, anchor, members = of[by_batch], anchor[by_batch], members[by_batch]
            found = [(b, 1, anchor[s:e].tobytes(), members[s:e].tobytes()) for b, s, e in _pieces(of)]
            if found:
                columns = zip(*found, strict=True)
                kinds_of = [pa.int64(), pa.int32(), pa.binary(), pa.binary()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds_of, strict=True)],
                    names=["batch", "kind", "hashes", "members"],
                )

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in runs(batches, "batch"):
            rows = group.to_pylist()
            names = next(r for r in rows if r["kind"] == 2)
            docs, versions = (np.frombuffer(names[c], np.int64) for c in ("hashes", "members"))
            anchor = np.concatenate([np.frombuffer(r["hashes"], np.uint64) for r in rows if r["kind"] == 1])
            member = np.concatenate([np.frombuffer(r["members"], np.uint16) for r in rows if r["kind"] == 1])
            order = np.argsort(member, kind="stable")
            anchor, member = anchor[order], member[order]
            found = [(docs[m], versions[m], anchor[s:e].tobytes()) for m, s, e in _pieces(member)]
            columns = list(zip(*found, strict=True)) or [()] * 3
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.int64(), pa.binary()), strict=True)],
                names=["doc", "version", "anchors"],
            )

    named = keyed.mapInArrow(name, "part long, batch long, kind int, hashes binary, members binary")
    answered = (
        named.repartition("part")
        .sortWithinPartitions("part")
        .mapInArrow(answer, "batch long, kind int, hashes binary, members binary")
    )
    return (
        answered.repartition("batch")
        .sortWithinPartitions("batch")
        .mapInArrow(gather, "doc long, version long, anchors binary")
    )


def _shard_sizes(anchors: DataFrame, shards: int) -> DataFrame:
    """``shard`` and ``runs``: how many runs of windows each shard will get."""

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            joined = np.frombuffer(b"".join(batch.column("anchors").to_pylist()), np.uint64)
            number, count = np.unique((joined % np.uint64(shards)).astype(np.int64), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(number), pa.array(count)], names=["shard", "n"])

    return anchors.select("anchors").mapInArrow(tally, "shard long, n long").groupBy("shard").agg(F.sum("n").alias("runs"))


def _window_runs(keyed: DataFrame, anchors: DataFrame, shards: int, size: int) -> DataFrame:
    """The runs of windows whose anchors repeat, packed per batch of documents and shard.

    A batch sends each distinct run of bytes once, with its occurrences.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        first = TaskContext.get().partitionId() << 32
        for number, batch in enumerate(batches):
            texts = [t.encode() for t in batch.column("text").to_pylist()]
            wanted = [np.frombuffer(a, np.uint64) for a in batch.column("anchors").to_pylist()]
            row, low, high, anchor = anchor_runs(texts, size)
            salt = np.uint64(0xD6E8FEB86659FD93)
            with np.errstate(over="ignore"):
                asked = np.concatenate([w ^ (np.uint64(i) * salt) for i, w in enumerate(wanted)] or [np.zeros(0, np.uint64)])
                keep = np.isin(anchor ^ (row.astype(np.uint64) * salt), asked)
            row, low, high, anchor = row[keep], low[keep], high[keep], anchor[keep]
            shard = (anchor % np.uint64(shards)).astype(np.int64)
            order = np.argsort(shard, kind="stable")
            row, low, high, shard = row[order], low[order], high[order], shard[order]
            docs, versions = _ids(batch, "doc")[row], _ids(batch, "version")[row]
            strings = [texts[r][a:b] for r, a, b in zip(row.tolist(), low.tolist(), (high + size).tolist(), strict=True)]
            packed = []
            for part, start, end in _pieces(shard):
                place: dict[bytes, int] = {}
                member = [place.setdefault(s, len(place)) for s in strings[start:end]]
                lengths = np.array([len(s) for s in place], np.uint8)
                occurrences = (np.array(member, np.int32), docs[start:end], versions[start:end], low[start:end])
                packed.append((part, first + number, *_squeezed(b"".join(place), lengths, *occurrences)))
            columns = list(zip(*packed, strict=True)) or [()] * 5
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    names = ["shard", "batch", "distinct", "found", "packed"]
    schema = "shard long, batch long, distinct long, found long, packed binary"
    # One row of anchors per document version: repeated rows of a document ask alike.
    asked = anchors.dropDuplicates(["doc", "version"])
    return keyed.join(asked, ["doc", "version"]).mapInArrow(cut, schema)


def _squeezed(
    strings: bytes, lengths: np.ndarray, member: np.ndarray, docs: np.ndarray, versions: np.ndarray, starts: np.ndarray
) -> tuple[int, int, bytes]:
    """Number of distinct runs, of occurrences, and both compressed: runs are text, which Spark's own codec packs loosely."""
    numbers = (versions.astype(np.uint32), docs, starts, member)
    # Byte by byte, first all lowest bytes: the high ones are nearly all zero and vanish.
    planes = (np.ascontiguousarray(a).view(np.uint8).reshape(len(a), -1).T.tobytes() for a in numbers)
    joined = b"".join((*planes, lengths.tobytes(), strings))
    return len(lengths), len(member), len(joined).to_bytes(8, "little") + pa.compress(joined, "zstd", asbytes=True)


def _opened(distinct: int, found: int, packed: bytes) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """What :func:`_squeezed` packed, in its order of arguments."""
    data = pa.decompress(packed[8:], int.from_bytes(packed[:8], "little"), "zstd", asbytes=True)
    numbers, at = [], 0
    for kind in (np.uint32, np.int64, np.int64, np.int32):
        width = np.dtype(kind).itemsize
        planes = np.frombuffer(data, np.uint8, width * found, at).reshape(width, found)
        numbers.append(np.ascontiguousarray(planes.T).view(kind).ravel())
        at += width * found
    versions, docs, starts, member = numbers
    lengths = np.frombuffer(data, np.uint8, distinct, at)
    return data[at + distinct :], lengths, member, docs, versions.astype(np.int64), starts


class _Part:
    """The distinct runs of one part of a shard and where they occur."""

    def __init__(self, rows: list[dict]) -> None:
        place: dict[bytes, int] = {}
        member, docs, versions, starts = [], [], [], []
        for row in rows:
            data, lengths, own_member, own_docs, own_versions, own_starts = _opened(row["distinct"], row["found"], row["packed"])
            ends, at = np.cumsum(lengths.astype(np.int64)).tolist(), 0
            numbers = np.empty(len(ends), np.int64)
            for i, end in enumerate(ends):
                numbers[i] = place.setdefault(data[at:end], len(place))
                at = end
            member.append(numbers[own_member])
            docs.append(own_docs)
            versions.append(own_versions)
            starts.append(own_starts)
        self.member, self.docs, self.versions, self.starts = map(np.concatenate, (member, docs, versions, starts))
        self.lengths = np.array([len(s) for s in place], np.int64)
        self.text = np.frombuffer(b"\xff".join(place) + b"\xff", np.uint8)
        self.offsets = np.cumsum(self.lengths + 1) - self.lengths - 1

    def group(self, size: int) -> None:
        """Sort the suffixes and find the groups of equal windows with the smallest key of each."""
        least = np.full(len(self.lengths), _NOBODY)
        np.minimum.at(least, self.member, self.docs)
        owner = np.repeat(least, self.lengths + 1)
        left = np.repeat(self.offsets + self.lengths, self.lengths + 1) - np.arange(len(self.text))
        order = suffix_array(self.text)
        self.window_group, self.stands, self.least = window_groups(self.text, order, left >= size, owner, size)

    def keys(self, size: int) -> np.ndarray:
        """One window of each group, ascending."""
        return window_keys(self.text, self.stands, size)

    def removed(self, least: np.ndarray, size: int) -> tuple[np.ndarray, ...]:
        """Document, version, from and to of the stretches removed where ``least`` per group is a smaller key."""
        windows = self.lengths - size + 1
        many = windows[self.member]
        which = np.repeat(np.arange(len(many)), many)
        within = np.arange(len(which)) - np.repeat(np.cumsum(many) - many, many)
        out = least[self.window_group[self.offsets[self.member][which] + within]] < self.docs[which]
        which, within = which[out], within[out]
        opens = np.ones(len(which), bool)
        opens[1:] = (which[1:] != which[:-1]) | (within[1:] != within[:-1] + 1)
        heads = np.flatnonzero(opens)
        last = np.append(heads[1:], len(which)) - 1
        of = which[heads] if len(heads) else heads
        start = self.starts[of]
        return self.docs[of], self.versions[of], start + within[heads], start + within[last] + size


def removed_stretches(docs: DataFrame, *, size: int = 50, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc``, ``version`` (hash of its text) and ``stretch`` (from * 256 + length) of all removed bytes.

    Stretches of a document can touch and overlap; :func:`without_repeats` and
    :func:`repeat_digest` unite them.
    """
    spark = docs.sparkSession
    prepare(spark)
    keyed = _keyed(docs, key, text).where(f"doc is not null and text is not null and octet_length(text) >= {size}")
    held = keyed.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(1, -(-held // BYTES_PER_SHARD))
    anchors = stored(repeated_anchors(keyed, shards, size), "repeated-anchors")
    _release(spark)
    sizes = stored(
        _shard_sizes(anchors, shards).select("shard", F.ceil(F.col("runs") / RUNS_PER_PART).alias("parts")), "shard-parts"
    )
    dealt = (
        _window_runs(keyed, anchors, shards, size)
        .join(sizes, "shard")
        .withColumn("own", F.pmod(F.xxhash64("batch"), F.col("parts")))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
        .withColumns({"low": F.least("own", "other"), "high": F.greatest("own", "other")})
        .drop("parts", "other", "batch")
    )
    tiled = dealt.withColumn("tile", F.xxhash64("shard", "low", "high"))
    place = ["tile", "shard", "low", "high"]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in runs(batches, *place):
            low, high = group.column("low")[0].as_py(), group.column("high")[0].as_py()
            rows = group.drop_columns(place).to_pylist()
            parts = [_Part(own) for side in dict.fromkeys((low, high)) if (own := [r for r in rows if r["own"] == side])]
            for part in parts:
                part.group(size)
            found = []
            if low == high:
                found = [part.removed(part.least, size) for part in parts]
            elif len(parts) == 2:
                keys = [part.keys(size) for part in parts]
                for mine, other in ((0, 1), (1, 0)):
                    at = matched(keys[mine], keys[other])
                    there = np.append(parts[other].least, _NOBODY)[at]
                    found.append(parts[mine].removed(there, size))
            for doc, version, start, end in found:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc), pa.array(version), pa.array(start * 256 + (end - start))], names=["doc", "version", "stretch"]
                )

    found = tiled.repartition("tile").sortWithinPartitions(*place).mapInArrow(search, "doc long, version long, stretch long")
    result = stored(found, "removed-stretches")
    drop_stored(spark, anchors)
    _release(spark)
    return result


def _release(spark) -> None:
    """Let Spark delete the shuffle files of finished steps now rather than at its next collection.

    The first collection finds the plans unused, the second what only they held.
    """
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.5)  # Spark deletes in the background


def _united(stretches: list[int] | None) -> list[tuple[int, int]]:
    """Disjoint, maximal removed runs in order."""
    spans: list[tuple[int, int]] = []
    for stretch in sorted(stretches or ()):
        start, end = stretch >> 8, (stretch >> 8) + (stretch & 255)
        if spans and start <= spans[-1][1]:
            spans[-1] = spans[-1][0], max(end, spans[-1][1])
        else:
            spans.append((start, end))
    return spans


def _kept(data: bytes, spans: list[tuple[int, int]]) -> bytes:
    parts, at = [], 0
    for start, end in spans:
        parts.append(data[at:start])
        at = end
    parts.append(data[at:])
    return b"".join(parts)


def _with_stretches(docs: DataFrame, size: int, key: str, text: str) -> DataFrame:
    found = removed_stretches(docs, size=size, key=key, text=text)
    lists = found.groupBy(F.col("doc").alias("__doc"), F.col("version").alias("__version")).agg(
        F.collect_list("stretch").alias("__stretches")
    )
    same = (F.col(key).cast("long") == F.col("__doc")) & (_version(text) == F.col("__version"))
    return docs.join(lists, same, "left").drop("__doc", "__version")


def repeat_digest(docs: DataFrame, *, size: int = 50, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row the key, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256`` and the removed ``spans``.

    A byte goes if a ``size``-byte string over it also starts in a document with
    a smaller key; all strings are judged on the input.  A null text is empty.
    Rows without a key lose nothing and cost nobody anything; rows with equal
    keys do not compare with each other; repeated rows come back as often as
    they came; an empty table gives an empty result; other columns are left out.
    """
    marked = _with_stretches(docs.select(key, text), size, key, text)
    kind = docs.schema[key].dataType.simpleString()

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for body, stretches in zip(batch.column("__text").to_pylist(), batch.column("__stretches").to_pylist(), strict=True):
                data = (body or "").encode()
                spans = _united(stretches)
                kept = _kept(data, spans)
                rows.append((len(data), len(data) - len(kept), len(spans), hashlib.sha256(kept).hexdigest(), [{"start": s, "end": e} for s, e in spans]))
            columns = list(zip(*rows, strict=True)) or [()] * 5
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(key), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))],
                names=[key, "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"],
            )

    fields = f"`{key}` {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start: long, end: long>>"
    return marked.select(key, F.col(text).alias("__text"), "__stretches").mapInArrow(digest, fields)


def without_repeats(docs: DataFrame, *, size: int = 50, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with the removed bytes taken out of ``text``; all rows and other columns stay.

    What is left of a character that was cut in two is dropped.  A null text
    stays null.
    """
    columns = docs.columns
    marked = _with_stretches(docs, size, key, text)

    def strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(text)
            texts = [
                body if not stretches else _kept(body.encode(), _united(stretches)).decode(errors="ignore")
                for body, stretches in zip(batch.column(at).to_pylist(), batch.column("__stretches").to_pylist(), strict=True)
            ]
            yield batch.set_column(at, text, pa.array(texts, batch.schema.field(at).type)).select(columns)

    return marked.mapInArrow(strip, docs.schema)
