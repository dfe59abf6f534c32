"""Conversation prefix trie by whole-sequence collapse.

Turns are reduced to a digest and a word count, so texts are read once and never
shuffled.  A prefix is known by sums of hashes of (position, digest), which are
running sums: a conversation of any length is scanned in segments, never held
whole.  Then

1. identical conversations collapse into one weighted sequence with the list of
   its ends;
2. sequences that are proper prefixes of others drop out by an anti-join; what is
   left are the leaves;
3. weighted prefixes of the sequences are aggregated to the nodes.

Sums over a node's subtree need no walk: each node is owned by the sequence of
its smallest member, a sequence owns the end of its own path, and both words
below a node and owned words below it are sums over the sequences through it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dialwright.llm.common import WORD, prepare, stored
from dialwright.operators import scans

SHARED_EVERY = 20  # conversations of one run of ids share the first turns of the first of them
ENDS_AT_ONCE = 4096
_SUMS = ["s1", "s2", "s3", "s4"]
_EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def turn_digests(conversations: DataFrame) -> DataFrame:
    """Per turn its conversation, order, digest of role and text, and number of words."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    framed = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    return conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        F.unhex(F.md5(framed)).alias("digest"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"),
    )


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns of the rebuilt conversations (conv_id, p from 1, digest, words), and all conversations with their length.

    Conversation c begins with the first h turns of conversation c - c % 20, where
    h = crc32(c) % 4, and goes on with its own turns after its first h.
    """
    order = ["turn", "digest"]
    placed = scans.segmented(turns, ["conv_id"], order)
    numbered = scans.running_sums(placed, ["conv_id"], order, {"i": F.lit(1)}).drop(scans.SEGMENT, scans.PLACE, "turn")

    first = numbered.filter((F.col("conv_id") % SHARED_EVERY == 0) & (F.col("i") <= 3))
    heads = first.groupBy(F.col("conv_id").alias("base")).agg(F.sort_array(F.collect_list(F.struct("i", "digest", "words"))).alias("head"))
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4
    # Up to 20 conversations refer to one base, with three turns at most.
    convs = stored(
        placed.groupBy("conv_id")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("conv_id", "n", h.cast("int").alias("h"), (F.col("conv_id") - F.col("conv_id") % SHARED_EVERY).alias("base"))
        .join(heads, "base", "left")
        .select("conv_id", "n", "h", F.when(F.col("head").isNull(), F.array().cast(heads.schema["head"].dataType)).otherwise(F.slice("head", 1, F.col("h"))).alias("head")),
        "trie-conversations",
    )
    lengths = convs.select("conv_id", "h", F.size("head").cast("long").alias("shared"), (F.size("head") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("total"))
    own = numbered.join(lengths.select("conv_id", "h", "shared"), "conv_id").filter("i > h")
    own = own.select("conv_id", (F.col("i") - F.col("h") + F.col("shared")).alias("p"), "digest", "words")
    shared = convs.select("conv_id", F.inline("head")).select("conv_id", F.col("i").cast("long").alias("p"), "digest", "words")
    return own.unionByName(shared), lengths.select("conv_id", "total")


def _key(depth: Column | str, sums: list[Column]) -> Column:
    """Identity of a prefix: its depth and 128 bits of summed hashes, as 16 bytes."""
    return F.unhex(F.md5(F.concat_ws("|", F.col(depth) if isinstance(depth, str) else depth, *sums)))


def prefixes(turns: DataFrame) -> DataFrame:
    """Per turn of a rebuilt conversation the keys of the prefix that it ends and of the one before, and the words so far."""
    hashes = [F.xxhash64(F.lit(seed), "p", "digest") for seed in (1, 2)]
    halves = [half for x in hashes for half in (F.shiftrightunsigned(x, 32), x.bitwiseAND(0xFFFFFFFF))]
    hashed = turns.select("conv_id", "p", "words", *[h.alias(f"h{i}") for i, h in enumerate(halves, 1)])
    placed = scans.segmented(hashed, ["conv_id"], ["p"])
    sums = {s: F.col(f"h{i}") for i, s in enumerate(_SUMS, 1)} | {"so_far": F.col("words")}
    run = scans.running_sums(placed, ["conv_id"], ["p"], sums)
    before = [F.col(s) - F.col(f"h{i}") for i, s in enumerate(_SUMS, 1)]
    return run.select(
        "conv_id",
        "p",
        _key("p", [F.col(s) for s in _SUMS]).alias("node"),
        _key(F.col("p") - 1, before).alias("parent"),
        "words",
        "so_far",
    )


def _root() -> Column:
    return _key(F.lit(0).cast("long"), [F.lit(0).cast("long")] * 4)


def ends_digest(ends: DataFrame) -> DataFrame:
    """Per node the SHA-256 of its ends' ids in numeric order, joined by commas.

    A hash is a chain, so the ids of one node pass one task in the end; they come
    as strings of up to 4096 ids that were sorted and joined in parallel, and are
    hashed one after another without being held.
    """
    prepare(ends.sparkSession)
    placed = scans.segmented(ends, ["node"], ["conv_id"])
    numbered = scans.running_sums(placed, ["node"], ["conv_id"], {"i": F.lit(1)})
    chunk = F.floor((F.col("i") - 1) / ENDS_AT_ONCE).alias("chunk")
    ids = F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string"))
    chunks = numbered.groupBy("node", chunk).agg(F.array_join(ids, ",").alias("ids"))

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, running = None, hashlib.sha256()
        done: list[tuple[bytes, str]] = []
        for batch in batches:
            for key, text in zip(batch.column("node").to_pylist(), batch.column("ids").to_pylist(), strict=True):
                if key == node:
                    running.update(b"," + text.encode())
                    continue
                if node is not None:
                    done.append((node, running.hexdigest()))
                node, running = key, hashlib.sha256(text.encode())
            yield _digests(done)
            done = []
        if node is not None:
            yield _digests([(node, running.hexdigest())])

    return chunks.repartition("node").sortWithinPartitions("node", "chunk").select("node", "ids").mapInArrow(digest, "node binary, ends_sha256 string")


def _digests(rows: list[tuple[bytes, str]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.string())], names=["node", "ends_sha256"]
    )


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row per distinct sequence of first turns of the rebuilt conversations, the textless root included.

    Columns: ``conv_id`` (smallest member), ``depth``, ``parent_conv_id`` (of the
    parent; null for the root), ``n_convs`` (members), ``n_children``,
    ``n_leaves`` (childless nodes below, itself included), ``saved_tokens`` (over
    the nodes below, itself included: members less one, times the words of the
    last text), ``ends_sha256`` (of the ids of the conversations that end here).

    Turns are ordered by ``turn``, a null first; turns of equal number by the MD5
    of role and text.  A null role or text is empty.  Rows without a conversation
    id belong to no conversation and are left out; repeated rows are turns of
    their own.  An empty table gives no row, not even a root.  Other columns are
    ignored, whatever their names.

    Largest unit of work: one segment of a scan.  First turns shared by very many
    conversations are aggregated before they are shuffled; joins on such a node go
    against stored tables, so Spark can split them.
    """
    turns, lengths = rebuilt(turn_digests(conversations))
    paths = stored(prefixes(turns), "trie-prefixes")

    last = paths.groupBy("conv_id").agg(F.max_by(F.struct("node", F.col("so_far").alias("all_words")), "p").alias("end")).select("conv_id", "end.*")
    turnless = lengths.filter("total = 0").select("conv_id", _root().alias("node"), F.lit(0).cast("long").alias("all_words"))
    ends = stored(last.unionByName(turnless), "trie-ends")
    sequences = ends.groupBy("node").agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("weight"), F.max("all_words").alias("all_words"))

    inner = paths.select(F.col("parent").alias("node")).distinct()
    leaves = sequences.join(inner, "node", "left_anti").select("conv_id", F.lit(1).alias("leaf"))
    weighted = stored(
        sequences.join(leaves, "conv_id", "left").select("conv_id", "weight", "all_words", F.coalesce("leaf", F.lit(0)).alias("leaf")),
        "trie-sequences",
    )

    below = F.col("all_words") - F.col("so_far") + F.col("words")
    path = paths.join(weighted, "conv_id").select("conv_id", "weight", "leaf", F.col("p").alias("depth"), "node", "parent", below.alias("below"))
    roots = weighted.select(
        "conv_id", "weight", "leaf", F.lit(0).cast("long").alias("depth"), _root().alias("node"), F.lit(None).cast("binary").alias("parent"), F.col("all_words").alias("below")
    )
    steps = stored(path.unionByName(roots), "trie-steps")

    nodes = stored(steps.groupBy("node").agg(F.min("conv_id").alias("owner"), F.min("depth").alias("depth"), F.min("parent").alias("parent")), "trie-nodes")
    owned = steps.select("conv_id", "node", "below").join(nodes.select("node", "owner"), "node").filter("conv_id = owner")
    tops = stored(owned.groupBy("conv_id").agg(F.max("below").alias("owned_below")), "trie-owned")

    once = F.least("below", F.coalesce("owned_below", F.lit(0)))
    sums = (
        steps.join(tops, "conv_id", "left")
        .groupBy("node")
        .agg(
            F.sum("weight").alias("n_convs"),
            F.sum("leaf").cast("long").alias("n_leaves"),
            F.sum(F.col("weight") * F.col("below") - once).alias("saved_tokens"),
        )
    )
    children = nodes.filter("parent IS NOT NULL").groupBy(F.col("parent").alias("node")).agg(F.count(F.lit(1)).alias("n_children"))
    above = nodes.select(F.col("node").alias("parent"), F.col("owner").alias("parent_conv_id"))
    return (
        nodes.join(above, "parent", "left")
        .join(sums, "node")
        .join(children, "node", "left")
        .join(ends_digest(ends.select("node", "conv_id")), "node", "left")
        .select(
            F.col("owner").alias("conv_id"),
            "depth",
            "parent_conv_id",
            "n_convs",
            F.coalesce("n_children", F.lit(0)).alias("n_children"),
            "n_leaves",
            "saved_tokens",
            F.coalesce("ends_sha256", F.lit(_EMPTY_SHA)).alias("ends_sha256"),
        )
    )
