"""Near-duplicates, repeated passages and vectors against brute force."""

from __future__ import annotations

import hashlib
import itertools
import math
import random
import re

import numpy as np
import pytest
import xxhash
from llm.fixtures import collected, documents, texts

from dialwright.llm import embeddings, graph, repeats, simhash, suffix_arrays


def groups_of(nodes, links):
    """Smallest reachable node by plain search."""
    around = {n: set() for n in nodes}
    for a, b in links:
        around[a].add(b)
        around[b].add(a)
    least = {}
    for node in sorted(nodes):
        if node not in least:
            stack = [node]
            while stack:
                at = stack.pop()
                if at not in least:
                    least[at] = node
                    stack += around[at]
    return least


def test_components(spark):
    rng = random.Random(5)
    links = [(i, i + 1) for i in range(0, 60)] + [(rng.randrange(100, 200), rng.randrange(100, 200)) for _ in range(70)] + [(7, 7)]
    found = dict(collected(graph.components(spark.createDataFrame(links, "a long, b long"))))
    want = groups_of({n for pair in links for n in pair}, links)
    assert found == {n: want[n] for n in want if n in found} and {n for a, b in links if a != b for n in (a, b)} == set(found)


def plain_fingerprint(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) > 2 else [" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints():
    for _, text, _ in texts():
        assert simhash.fingerprint(text) == plain_fingerprint(text)


def test_bk_tree_finds_all():
    rng = random.Random(1)
    centre = rng.getrandbits(64)
    values = [centre ^ sum(1 << rng.randrange(64) for _ in range(rng.randrange(4))) for _ in range(200)]
    tree = simhash.BKTree()
    for value in values:
        tree.add(value)
    for value in values[:50]:
        assert sorted(tree.near(value, 3)) == [i for i, v in enumerate(values) if (v ^ value).bit_count() <= 3]


@pytest.mark.parametrize("tile", [10_000, 7])
def test_linked_fingerprints(spark, tile):
    rng = random.Random(2)
    base = [rng.getrandbits(64) for _ in range(30)]
    values = {b ^ sum(1 << rng.randrange(64) for _ in range(rng.randrange(5))) for b in base for _ in range(8)}
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    edges = simhash.link_fingerprints(spark.createDataFrame([(v,) for v in signed], "fp long"), tile=tile).collect()
    want = groups_of(signed, [(a, b) for a, b in itertools.combinations(signed, 2) if ((a ^ b) & (1 << 64) - 1).bit_count() <= 3])
    assert groups_of(signed, [tuple(e) for e in edges]) == want


def test_near_duplicates(spark):
    found = simhash.near_duplicates(documents(spark)).collect()
    marked = [(k, plain_fingerprint(t)) for k, t, _ in texts()]
    values = {f for _, f in marked}
    group = groups_of(values, [(a, b) for a, b in itertools.combinations(values, 2) if (a ^ b).bit_count() <= 3])
    least = {}
    for key, value in marked:
        if key is not None:
            least[group[value]] = min(key, least.get(group[value], key))
    want = sorted([(k, f"{f:016x}", least.get(group[f])) for k, f in marked], key=repr)
    assert collected(simhash.near_duplicates(documents(spark))) == want and len(found) == len(want)


def test_one_of_each(spark):
    kept = simhash.one_of_each(documents(spark))
    assert kept.columns == documents(spark).columns
    keys = sorted((r.doc_id for r in kept.collect()), key=repr)
    want = {k for k, _, least in collected(simhash.near_duplicates(documents(spark))) if k is not None and k == least}
    assert [k for k in keys if k is not None] == sorted(want, key=repr) and keys.count(None) == 2


@pytest.mark.parametrize("alphabet, n", [(b"a", 700), (b"ab", 900), (b"abc\xff", 1500), (bytes(range(256)), 800), (b"a", 1)])
def test_suffix_array_and_prefixes(alphabet, n):
    rng = random.Random(n)
    text = bytes(rng.choice(alphabet) for _ in range(n))
    data = np.frombuffer(text, np.uint8)
    order = suffix_arrays.suffix_array(data)
    assert order.tolist() == sorted(range(n), key=lambda i: text[i:])
    shared = suffix_arrays.common_prefixes(data, order, 50)
    for r in range(1, n):
        a, b = text[order[r - 1] :][:50], text[order[r] :][:50]
        want = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
        assert shared[r] == want


def test_equal_windows_have_equal_anchors():
    passage = b"a passage that is shared by both of the texts and is longer than a single window is"
    one, two = b"zzz" + passage, b"something else before it " + passage + b" and behind"
    row, low, high, anchor = suffix_arrays.anchor_runs([one, two, b"short"], 50)
    of = {}
    for r, a, b, h in zip(row, low, high, anchor, strict=True):
        for p in range(a, b + 1):
            of.setdefault((one, two)[r][p : p + 50], set()).add(h)
    assert len(of) == len({w for t in (one, two) for w in (t[p : p + 50] for p in range(len(t) - 49))})
    assert all(len(hashes) == 1 for hashes in of.values())


def plain_removal(rows, size=50):
    first = {}
    for key, text in rows:
        data = (text or "").encode()
        for p in range(len(data) - size + 1):
            if key is not None:
                first[data[p : p + size]] = min(key, first.get(data[p : p + size], key))
    out = []
    for key, text in rows:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for p in range(len(data) - size + 1):
            if key is not None and first[data[p : p + size]] < key:
                gone[p : p + size] = b"\1" * size
        kept = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        out.append((key, len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("per_part, per_shard", [(150_000, 8 << 20), (40, 20_000)])
def test_repeated_passages(spark, monkeypatch, per_part, per_shard):
    monkeypatch.setattr(repeats, "RUNS_PER_PART", per_part)
    monkeypatch.setattr(repeats, "BYTES_PER_SHARD", per_shard)
    found = collected(repeats.repeat_digest(documents(spark)).drop("spans"))
    assert found == plain_removal([(k, t) for k, t, _ in texts()])


def test_texts_without_repeats(spark):
    docs = documents(spark)
    left = repeats.without_repeats(docs)
    assert left.columns == docs.columns and left.count() == docs.count()
    sizes = {(r.doc_id, len((r.text or "").encode())) for r in left.collect()}
    for key, total, gone, _, _ in plain_removal([(k, t) for k, t, _ in texts()]):
        assert any((key, total - gone - cut) in sizes for cut in range(7))  # at most a cut character per span
    assert left.where("doc_id = 100").first()["text"] is None


def vectors(seed=0):
    rng = np.random.default_rng(seed)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.standard_normal((60, 16)))]
    centre = rng.standard_normal(16)
    rows += [(100 + i, (centre + 0.1 * rng.standard_normal(16)).tolist()) for i in range(40)]
    rows += [(200 + i, rows[3][1]) for i in range(5)]
    rows += [(210, [x * 1e30 for x in rows[4][1]]), (211, [x * 1e-30 for x in rows[4][1]])]
    rows += [(300, None), (301, [0.0] * 16), (302, [math.nan] * 16), (303, [math.inf] * 16), (304, []), (305, [1.0, 2.0]), (306, [2.0, 4.0])]
    rows += [(307, [None] * 16), (None, rows[3][1]), (5, rows[5][1])]
    return rows


@pytest.mark.parametrize("tile, window", [(2048, 64), (9, 8)])
def test_vectors(spark, monkeypatch, tile, window):
    rows = vectors()
    whole = embeddings.links_in_groups
    monkeypatch.setattr(embeddings, "links_in_groups", lambda *a, **k: whole(*a, **k, tile=tile))
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 as rep", "2 as component")
    found = collected(embeddings.near_duplicates(table, passes=24, window=window, block=4 * window))
    good = [(k, np.array(v)) for k, v in rows if k is not None and v and None not in v and np.isfinite(v).all() and any(v)]
    links, count = [], {}
    for (i, (a, x)), (j, (b, y)) in itertools.permutations(enumerate(good), 2):
        if len(x) == len(y):
            x, y = x / np.abs(x).max(), y / np.abs(y).max()
            if x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= 0.9:
                links.append((a, b))
                count[i, a] = count.get((i, a), 0) + 1
    least = groups_of({k for k, _ in rows if k is not None}, links)
    n = {}
    for (_, a), c in count.items():
        n[a] = max(c, n.get(a, 0))
    want = [(k, n.get(k, 0), least.get(k), None if k is None else least[k] == k) for k, _ in rows]
    assert found == sorted(want, key=repr)


def test_empty_tables(spark):
    none = documents(spark, [])
    assert simhash.near_duplicates(none).count() == 0
    assert simhash.one_of_each(none).count() == 0
    assert repeats.repeat_digest(none).count() == 0
    assert repeats.without_repeats(none).count() == 0
    assert embeddings.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0
