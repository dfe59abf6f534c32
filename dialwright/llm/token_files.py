"""Token ids in length-delimited binary records, with an offset index beside them.

File format: frames one after another, each

    length of the record    8 bytes, little-endian
    masked CRC-32 of those  4 bytes
    the record              ``length`` bytes
    masked CRC-32 of it     4 bytes

A record: key (8 bytes, signed), key present (1 byte), width of an id in bytes
(1 byte), tokens before it in its file (8 bytes), then the ids.  The index is a
Parquet table of key, file, position, size and token count, so a reader can
fetch any records in any order without scanning the files.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dialwright.llm.common import prepare
from dialwright.llm.encoding import encoded
from dialwright.session import shared_dir

# The public masking rule for checksums that are stored beside what they cover.
MASK_SHIFT = 15
MASK_DELTA = 0xA282EAD8

_LENGTH = struct.Struct("<Q")
_CRC = struct.Struct("<I")
_HEAD = struct.Struct("<qBBQ")


class CorruptRecord(ValueError):
    """A frame whose checksum or length does not hold."""


def masked_crc(data: bytes) -> int:
    """CRC-32, rotated and shifted so that a checksum of checksums stays meaningful."""
    crc = zlib.crc32(data)
    rotated = (crc >> MASK_SHIFT) | (crc << (32 - MASK_SHIFT))
    return (rotated + MASK_DELTA) & 0xFFFFFFFF


def frame(record: bytes) -> bytes:
    """One framed record."""
    length = _LENGTH.pack(len(record))
    return b"".join((length, _CRC.pack(masked_crc(length)), record, _CRC.pack(masked_crc(record))))


def unframe(data: bytes) -> bytes:
    """The record of one frame; raises :class:`CorruptRecord` when a check fails."""
    if len(data) < 16:
        raise CorruptRecord("frame cut short")
    (length,), (check,) = _LENGTH.unpack_from(data), _CRC.unpack_from(data, 8)
    if check != masked_crc(data[:8]) or len(data) != length + 16:
        raise CorruptRecord("length does not hold")
    record = data[12:-4]
    if _CRC.unpack_from(data, len(data) - 4)[0] != masked_crc(record):
        raise CorruptRecord("record does not hold")
    return record


def token_record(number: int | None, before: int, ids: np.ndarray) -> bytes:
    """The framed record of one document's ids."""
    narrow = int(ids.max(initial=0)) < 1 << 16
    head = _HEAD.pack(number or 0, number is not None, 2 if narrow else 4, before)
    return frame(head + ids.astype("<u2" if narrow else "<u4").tobytes())


def parsed_record(data: bytes) -> tuple[int | None, int, np.ndarray]:
    """Key, tokens before it in its file, and ids of a framed record."""
    record = unframe(data)
    number, present, width, before = _HEAD.unpack_from(record)
    return number if present else None, before, np.frombuffer(record, f"<u{width}", offset=_HEAD.size).astype("<u4")


def write_token_files(
    docs: DataFrame,
    folder: str,
    tokenizer_path: str,
    *,
    end_id: int = 0,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Encode whole texts in ascending key order into files of ``folder``; returns the index.

    Range partitions on the key give one file each; a file's name holds its
    partition, and a retried or speculative task writes another name, which only
    the index of the successful attempt mentions.  A null text is empty and gives
    the end id alone, null keys come first, repeated keys keep all their rows, in
    the order of a hash of their texts, which also splits a key of very many rows.
    The folder must be reachable by all executors.
    """
    prepare(docs.sparkSession)
    index = f"{folder}/index"
    ordered = (
        docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("__text"), F.xxhash64(text).alias("__tie"))
        .repartitionByRange("key", "__tie")
        .sortWithinPartitions("key", "__tie")
        .drop("__tie")
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        store, path = fs.FileSystem.from_uri(folder)
        part = TaskContext.get().partitionId()
        name = f"part-{part:06d}-{uuid.uuid4().hex}.bin"
        out, position, tokens = None, 0, 0
        for batch in batches:
            if out is None and batch.num_rows:
                store.create_dir(path, recursive=True)
                out = store.open_output_stream(f"{path}/{name}", buffer_size=1 << 20)
            rows = []
            keys = batch.column("key").to_pylist()
            for number, ids in zip(keys, encoded(tokenizer_path, batch.column("__text"), end_id), strict=True):
                data = token_record(number, tokens, ids)
                out.write(data)
                rows.append((number, name, position, len(data), len(ids)))
                position += len(data)
                tokens += len(ids)
            columns = list(zip(*rows, strict=True)) or [()] * 5
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                names=["key", "file", "position", "size", "n_tokens"],
            )
        if out is not None:
            out.close()

    schema = "key long, file string, position long, size long, n_tokens long"
    ordered.mapInArrow(write, schema).write.parquet(index)
    return docs.sparkSession.read.schema(schema).parquet(index)


def read_records(index: DataFrame, folder: str, *, with_ids: bool = False) -> DataFrame:
    """Read the records that ``index`` rows point at, in the order of those rows.

    Returns key, file, ``tokens_before`` (in its file), ``n_tokens``,
    ``ids_crc32`` (over the ids as little-endian uint32) and, on demand, the ids.
    A damaged frame raises :class:`CorruptRecord`.  The index may be filtered or
    shuffled first; each row costs one seek.
    """
    prepare(index.sparkSession)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = fs.FileSystem.from_uri(folder)
        opened, source = None, None
        for batch in batches:
            rows, all_ids = [], []
            for name, position, size in zip(*(batch.column(c).to_pylist() for c in ("file", "position", "size")), strict=True):
                if name != opened:
                    if source is not None:
                        source.close()
                    opened, source = name, store.open_input_file(f"{path}/{name}")
                source.seek(position)
                number, before, ids = parsed_record(source.read(size))
                rows.append((number, name, before, len(ids), zlib.crc32(ids.tobytes())))
                if with_ids:
                    all_ids.append(ids.astype(np.int64))
            columns = list(zip(*rows, strict=True)) or [()] * 5
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            names = ["key", "file", "tokens_before", "n_tokens", "ids_crc32"]
            if with_ids:
                arrays.append(pa.array(all_ids, pa.list_(pa.int64())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(arrays, names=names)
        if source is not None:
            source.close()

    schema = "key long, file string, tokens_before long, n_tokens long, ids_crc32 long"
    wanted = index.select("file", "position", "size")
    return wanted.mapInArrow(read, schema + (", ids array<long>" if with_ids else ""))


def token_file_digest(docs: DataFrame, tokenizer_path: str, *, end_id: int = 0, key: str = "doc_id") -> DataFrame:
    """Write all documents as token files, read the files back and describe each record.

    ``start`` counts the ids of all documents before it: the count stored in the
    record for its own file plus the totals of the files before, which are as
    many rows as there are files.
    """
    folder = shared_dir(docs.sparkSession, "token-files")
    index = write_token_files(docs, folder, tokenizer_path, end_id=end_id, key=key)
    totals = index.groupBy("file").agg(F.sum("n_tokens").alias("held"))
    # File names start with the number of their range, so they sort in key order.
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("file", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("base"))
    return (
        read_records(index, folder)
        .join(bases, "file")
        .select(
            F.col("key").alias(key),
            (F.col("base") + F.col("tokens_before")).alias("start"),
            "n_tokens",
            "ids_crc32",
        )
    )
