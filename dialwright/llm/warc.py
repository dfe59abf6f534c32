"""WARC files and a Merkle fixity audit between replicas.

Every record is hashed where it lies; the hashes of a file's records, in the
order of their offsets, are the leaves of a tree whose inner nodes hash a fixed
number of children each; the roots of the files are the leaves of the replica's
tree.  Two replicas agree if their roots do.  If not, the audit compares the
children of differing nodes only, level by level, down to the damaged records.
"""

from __future__ import annotations

import gzip
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dialwright.llm.common import prepare, runs, stored

FAN_OUT = 16
RECORD_DATE = "2024-01-01T00:00:00Z"  # files are reproducible: the date is a parameter, not the clock
_LENGTH = re.compile(rb"(?im)^content-length:\s*(\d+)\s*$")

FILES_PER_TASK = 4  # so a task writes some thousand records, whatever the size of the table


def warc_record(number: int | None, url: str | None, body: str | None, date: str = RECORD_DATE) -> bytes:
    """One WARC/1.1 resource record; its id is derived from the content."""
    payload = (body or "").encode()
    target = re.sub(r"[\r\n]+", " ", url or "")
    name = uuid.uuid5(uuid.NAMESPACE_URL, f"{number}:{target}:{hashlib.sha256(payload).hexdigest()}")
    head = (
        f"WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:uuid:{name}>\r\n"
        f"WARC-Date: {date}\r\nWARC-Target-URI: {target}\r\nX-Page-Id: {'' if number is None else number}\r\n"
        f"Content-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    )
    return head.encode() + payload + b"\r\n\r\n"


def write_warc(pages: DataFrame, folder: str, *, records_per_file: int = 1024, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Write pages as gzipped WARC files, one member per record; returns the record index.

    Pages are dealt into files by a hash of key, URL and body and ordered inside
    by the same, so files and offsets do not depend on partitions.  A
    retried task writes another file name, which only the successful attempt's
    index mentions.  Index: ``warc_file`` (logical number), ``path``, ``ordinal``,
    ``page_id``, ``offset``, ``size`` (of the compressed member).  Null keys,
    URLs and bodies are written as empty values; repeated rows are further
    records; an empty table writes nothing.
    """
    prepare(pages.sparkSession)
    files = max(1, -(-pages.count() // records_per_file))
    rows = pages.select(F.col(key).cast("long").alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html"))
    dealt = (
        rows.withColumn("warc_file", F.pmod(F.xxhash64("page_id", "url", "html"), F.lit(files)))
        .repartition(-(-files // FILES_PER_TASK), "warc_file")
        .sortWithinPartitions("warc_file", "page_id", "url", "html")
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = fs.FileSystem.from_uri(folder)
        store.create_dir(path, recursive=True)
        current, out, name, at, ordinal = None, None, "", 0, 0
        for batch in batches:
            index: list[tuple] = []
            for number, address, body, of in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html", "warc_file")), strict=True):
                if of != current:
                    if out is not None:
                        out.close()
                    current, name, at, ordinal = of, f"pages-{of:06d}-{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = store.open_output_stream(f"{path}/{name}", compression=None, buffer_size=1 << 20)
                member = gzip.compress(warc_record(number, address, body), compresslevel=6, mtime=0)
                out.write(member)
                index.append((of, name, ordinal, number, at, len(member)))
                at += len(member)
                ordinal += 1
            columns = list(zip(*index, strict=True)) or [()] * 6
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                names=["warc_file", "path", "ordinal", "page_id", "offset", "size"],
            )
        if out is not None:
            out.close()

    return stored(dealt.mapInArrow(write, "warc_file long, path string, ordinal long, page_id long, offset long, size long"), "warc-index")


def read_warc(index: DataFrame, folder: str) -> DataFrame:
    """The pages of the indexed records: ``page_id``, ``url``, ``html`` and where they lie."""
    prepare(index.sparkSession)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, members in _members(batches, folder):
            urls, bodies = [], []
            for member in members:
                url, body = parsed_record(gzip.decompress(member))
                urls.append(url)
                bodies.append(body)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(urls, pa.string()), pa.array(bodies, pa.string())],
                names=[*batch.schema.names, "url", "html"],
            )

    wanted = index.select("warc_file", "path", "ordinal", "page_id", "offset", "size")
    return wanted.mapInArrow(
        read, "warc_file long, path string, ordinal long, page_id long, offset long, size long, url string, html string"
    )


def parsed_record(record: bytes) -> tuple[str, str]:
    """URL and body of a WARC record."""
    head, _, rest = record.partition(b"\r\n\r\n")
    length = int(_LENGTH.search(head)[1])
    url = re.search(rb"(?im)^warc-target-uri: ?(.*?)\r?$", head)[1].decode()
    return url, rest[:length].decode()


def _members(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Each batch of index rows with the bytes they point at."""
    store, root = fs.FileSystem.from_uri(folder)
    opened, source = None, None
    for batch in batches:
        members = []
        for name, offset, size in zip(*(batch.column(c).to_pylist() for c in ("path", "offset", "size")), strict=True):
            if name != opened:
                if source is not None:
                    source.close()
                opened, source = name, store.open_input_file(f"{root}/{name}")
            source.seek(offset)
            members.append(source.read(size))
        yield batch, members
    if source is not None:
        source.close()


def damaged(data: bytes, offset: int, every: int) -> bytes:
    """``data`` with one bit turned if its checksum is a multiple of ``every``: a reproducible fault."""
    if not data or zlib.crc32(data) % every:
        return data
    at = (offset + len(data) // 2) % len(data)
    return data[:at] + bytes([data[at] ^ 1]) + data[at + 1 :]


def copy_replica(index: DataFrame, folder: str, to: str, *, damage_every: int | None = None) -> DataFrame:
    """Copy the indexed records to another folder, for tests with faults put in; returns the copy's index.

    A file is copied by one task, so the index keeps its files together.
    """
    prepare(index.sparkSession)
    ordered = index.repartition("warc_file").sortWithinPartitions("warc_file", "ordinal")

    def copy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(to)
        store.create_dir(root, recursive=True)
        for group in runs(batches, "warc_file"):
            name = f"pages-{group.column('warc_file')[0].as_py():06d}-{uuid.uuid4().hex}.warc.gz"
            with store.open_output_stream(f"{root}/{name}", compression=None, buffer_size=1 << 20) as out:
                for batch, members in _members(iter(group.to_batches()), folder):
                    for data, offset in zip(members, batch.column("offset").to_pylist(), strict=True):
                        out.write(damaged(data, offset, damage_every) if damage_every else data)
                    at = batch.schema.get_field_index("path")
                    yield batch.set_column(at, "path", pa.array([name] * batch.num_rows, pa.string()))

    return stored(ordered.mapInArrow(copy, index.schema), "warc-index")


def leaf_hashes(index: DataFrame, folder: str) -> DataFrame:
    """The index with ``digest``, the SHA-256 of each record's bytes as they lie in the file."""
    prepare(index.sparkSession)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, members in _members(batches, folder):
            found = pa.array([hashlib.sha256(m).hexdigest() for m in members], pa.string())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("warc_file", "ordinal", "page_id", "offset", "size")), found],
                names=["warc_file", "ordinal", "page_id", "offset", "size", "digest"],
            )

    wanted = index.select("warc_file", "path", "ordinal", "page_id", "offset", "size")
    return wanted.mapInArrow(digest, "warc_file long, ordinal long, page_id long, offset long, size long, digest string")


@dataclass(frozen=True)
class MerkleTrees:
    """A replica's trees: ``files`` from the records up to one node per file, ``corpus`` from those up to one root.

    Every level has ``tree`` (the file, or -1), ``place``, ``digest`` and the
    byte range ``from_byte`` to ``to_byte`` (of a file, or of the first and last
    file a corpus node spans).
    """

    files: list[DataFrame]
    corpus: list[DataFrame]


def merkle_trees(leaves: DataFrame) -> MerkleTrees:
    """Build all levels; a node hashes at most ``FAN_OUT`` children in order of place."""
    records = leaves.select(
        F.col("warc_file").alias("tree"),
        F.col("ordinal").alias("place"),
        "digest",
        F.col("offset").alias("from_byte"),
        (F.col("offset") + F.col("size")).alias("to_byte"),
    )
    files = _up_to_one(records)
    roots = files[-1].select(
        F.lit(-1).cast("long").alias("tree"), F.col("tree").alias("place"), "digest", "from_byte", "to_byte"
    )
    return MerkleTrees(files, _up_to_one(roots))


def _up_to_one(level: DataFrame) -> list[DataFrame]:
    levels = [level]
    while (levels[-1].agg(F.max("place")).first()[0] or 0) > 0:
        levels.append(stored(_parents(levels[-1]), "merkle-level"))
    return levels


def _parents(level: DataFrame) -> DataFrame:
    children = F.array_sort(F.collect_list(F.struct("place", "digest")))  # at most FAN_OUT
    grouped = level.groupBy("tree", F.floor(F.col("place") / FAN_OUT).cast("long").alias("parent")).agg(
        F.sha2(F.array_join(F.transform(children, lambda c: c["digest"]), ""), 256).alias("digest"),
        F.min("from_byte").alias("from_byte"),
        F.max("to_byte").alias("to_byte"),
    )
    return grouped.select("tree", F.col("parent").alias("place"), "digest", "from_byte", "to_byte")


def root_digest(trees: MerkleTrees) -> str | None:
    """The replica's root; null if it holds nothing."""
    row = trees.corpus[-1].select("digest").first()
    return row["digest"] if row else None


def differing_records(ours: MerkleTrees, theirs: MerkleTrees) -> DataFrame:
    """``warc_file`` and ``ordinal`` of the records that differ, are missing or are surplus.

    Walks down from the roots and joins only the children of differing nodes.
    Trees of different height, which a missing or surplus record can cause, do
    not line up level by level; their lowest levels are compared whole.
    """
    suspects = _descend(None, ours.corpus, theirs.corpus).select(
        F.col("place").alias("tree"), F.lit(0).cast("long").alias("place")
    )
    found = _descend(stored(suspects, "merkle-suspects"), ours.files, theirs.files)
    return found.select(F.col("tree").alias("warc_file"), F.col("place").alias("ordinal"))


def _descend(suspects: DataFrame | None, ours: list[DataFrame], theirs: list[DataFrame]) -> DataFrame:
    """Lowest nodes that differ below ``suspects``, nodes of the highest level (all of them if None)."""
    if len(ours) != len(theirs):
        return _below(_differing(ours[0], theirs[0]), suspects, 0)
    found = _below(_differing(ours[-1], theirs[-1]), suspects, 0)
    for mine, other in zip(ours[-2::-1], theirs[-2::-1], strict=True):
        found = stored(found, "merkle-suspects")
        found = _differing(_below(mine, found, 1), _below(other, found, 1))
    return found


def _below(nodes: DataFrame, suspects: DataFrame | None, levels: int) -> DataFrame:
    """The nodes whose ancestor ``levels`` up (in height-0 walks: whose tree) is suspect."""
    if suspects is None:
        return nodes
    named = suspects.select(F.col("tree").alias("of_tree"), F.col("place").alias("of_place"))
    inside = F.col("tree") == F.col("of_tree")
    if levels:
        inside = inside & (F.floor(F.col("place") / FAN_OUT**levels) == F.col("of_place"))
    return nodes.join(named, inside, "left_semi")


def _differing(mine: DataFrame, other: DataFrame) -> DataFrame:
    a = mine.select("tree", "place", F.col("digest").alias("da"))
    b = other.select("tree", "place", F.col("digest").alias("db"))
    both = a.join(b, ["tree", "place"], "full_outer")
    return both.where(~F.col("da").eqNullSafe(F.col("db"))).select("tree", "place")


def audit(ours: DataFrame, theirs: DataFrame) -> DataFrame:
    """One row per record of either replica, with ``intact``: the replicas hold the same bytes.

    ``ours`` and ``theirs`` are what :func:`leaf_hashes` returns, stored.  The
    columns describe our record, or theirs where ours is missing.
    """
    bad = differing_records(merkle_trees(ours), merkle_trees(theirs)).withColumn("differs", F.lit(True))
    columns = ["page_id", "offset", "size", "digest"]
    position = ["warc_file", "ordinal"]
    surplus = theirs.join(ours, position, "left_anti")
    every = ours.select(*position, *columns).unionByName(surplus.select(*position, *columns))
    return every.join(bad, position, "left").select(
        *position, *columns, F.col("differs").isNull().alias("intact")
    )


def fixity_audit(pages: DataFrame, folder: str, *, damage_every: int | None = None, records_per_file: int = 1024) -> DataFrame:
    """Write two replicas of WARC files, the second with faults if asked, and audit one against the other."""
    index = write_warc(pages, f"{folder}/a", records_per_file=records_per_file)
    copied = copy_replica(index, f"{folder}/a", f"{folder}/b", damage_every=damage_every)
    ours = stored(leaf_hashes(index, f"{folder}/a"), "leaf-hashes")
    theirs = stored(leaf_hashes(copied, f"{folder}/b"), "leaf-hashes")
    return audit(ours, theirs)
