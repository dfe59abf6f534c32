"""Mixture-controlled packing: exact tokens, full windows, proportions, carried deficits."""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from llm.fixtures import documents, texts
from tokenizers import Tokenizer

from dialwright.llm import encoding, mixture_packing

WORDS = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def ids_of():
    library = Tokenizer.from_file(WORDS)
    return lambda text: np.array([*library.encode(text or "", add_special_tokens=False).ids, 2], "<u4")


def test_word_encoder_equals_the_library(ids_of):
    tool = encoding.WordEncoder(WORDS, kept_words=20)
    assert tool.cuts and tool.drops_space
    sample = [t or "" for _, t, _ in texts()] + ["a ", " a", "　a", "don't we'll\nI'm 12 x1,", "a\x00b", "ΑΣ Σ. İx É é", "<|endoftext|>a"]
    for text, ids in zip(sample, tool.encode(sample), strict=True):
        assert ids.tolist() == ids_of(text)[:-1].tolist()


@pytest.mark.parametrize("seed", range(5))
def test_round_robin_keeps_shares_and_carries_deficits(seed):
    rng = np.random.default_rng(seed)
    tokens = np.append(rng.integers(1, 3000, rng.integers(1, 30)), 20_000)
    sizes = mixture_packing.capacities(int(tokens.sum()), 512)
    taken = mixture_packing.round_robin(tokens, rng.random(len(tokens)), sizes)
    assert taken.sum(axis=1).tolist() == sizes.tolist() and taken.sum(axis=0).tolist() == tokens.tolist()
    ideal = np.cumsum(sizes)[:, None] * tokens / tokens.sum()
    # A queue is never more than two tokens off its share, however many windows have passed.
    assert np.abs(np.cumsum(taken, axis=0) - ideal).max() <= 2


def test_lengths_of_sequences():
    assert mixture_packing.capacities(4096 * 2 + 5, 4096).tolist() == [4096, 4096, 4, 1]
    assert mixture_packing.capacities(3, 4096).tolist() == [2, 1]


def check(rows, given, ids_of, capacity):
    """Every id in exactly one piece, sequences without gaps or padding."""
    want = Counter((key, ids_of(text).tobytes()) for key, text, _ in given)
    by_key = defaultdict(list)
    for r in rows:
        by_key[r.doc_id].append(r)
    for key, pieces in by_key.items():
        whole = [ids for k, ids in want.elements() if k == key]
        assert sum(r.length for r in pieces) == sum(len(i) // 4 for i in whole)
        if len(whole) == 1:
            ids = np.frombuffer(whole[0], "<u4")
            at = 0
            for r in sorted(pieces, key=lambda r: r.start):
                assert r.start == at and r.doc_tokens == len(ids)
                assert r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
                at += r.length
            assert at == len(ids)
    assert set(by_key) == {key for key, _ in want}
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for inside in sequences.values():
        at = 0
        for offset, length in sorted(inside):
            assert offset == at
            at += length
        assert at <= capacity and at & (at - 1) == 0
    return sequences


def test_packed_documents(spark, ids_of):
    rows = mixture_packing.pack_mixture(documents(spark), WORDS, capacity=64, block_windows=40).collect()
    sequences = check(rows, texts(), ids_of, 64)
    total = sum(r.length for r in rows)
    # At most a binary tail per block.
    assert len(sequences) <= total // 64 + 6 * max(1, round(total / (64 * 40)))


def test_windows_mirror_the_corpus(spark, ids_of):
    given = [(i, f"word{i} " * (40 + i % 7), "hot" if i % 3 == 0 else f"s{i % 4}") for i in range(300)]
    rows = mixture_packing.pack_mixture(documents(spark, given), WORDS, capacity=256, block_windows=16).collect()
    check(rows, given, ids_of, 256)
    source = {i: s for i, _, s in given}
    tokens = Counter()
    windows = defaultdict(Counter)
    for r in rows:
        tokens[source[r.doc_id]] += r.length
        windows[r.sequence_id][source[r.doc_id]] += r.length
    total = sum(tokens.values())
    for inside in windows.values():
        if sum(inside.values()) == 256:
            assert all(abs(inside[s] - 256 * n / total) <= 3 for s, n in tokens.items())


def test_targets_hold_until_a_source_ends(spark, ids_of):
    given = [(i, "one two three four " * 10, "a" if i % 4 else "b") for i in range(200)] + [(999, "rest " * 50, None)]
    rows = mixture_packing.pack_mixture(documents(spark, given), WORDS, capacity=64, targets={"a": 0.5, "b": 0.5, "none": 1.0}, block_windows=8).collect()
    check(rows, given, ids_of, 64)
    source = {i: s for i, _, s in given}
    windows = defaultdict(Counter)
    for r in rows:
        windows[r.sequence_id][source[r.doc_id]] += r.length
    held = sum(r.length for r in rows if source[r.doc_id] == "b")
    even = [w for w in windows.values() if sum(w.values()) == 64 and abs(w["a"] - 32) <= 2 and abs(w["b"] - 32) <= 2]
    assert len(even) >= 2 * held // 64 * 0.9
    assert all(set(w) == {None} for w in windows.values() if None in w)


def test_phases():
    assert mixture_packing.phases({"a": 100, "b": 10}, {"a": 0.5, "b": 0.5}) == [("a", 0, 0, 10), ("b", 0, 0, 10), ("a", 1, 10, 90)]


def test_empty_table(spark):
    assert mixture_packing.pack_mixture(documents(spark, []), WORDS).count() == 0


def test_unusable_settings(spark):
    with pytest.raises(ValueError, match="power of two"):
        mixture_packing.pack_mixture(documents(spark, []), WORDS, capacity=100)
    with pytest.raises(ValueError, match="target"):
        mixture_packing.pack_mixture(documents(spark, []), WORDS, targets={"a": -1})
