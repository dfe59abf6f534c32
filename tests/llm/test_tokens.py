"""Token counts, token files and packing against the libraries."""

from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from llm.fixtures import documents, texts
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from dialwright.llm import encoding, packing, token_counts, token_files
from dialwright.session import shared_dir

PIECES = public_tokenizers.path("piece_bpe_32k.model")
BYTES = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PIECES)


def expected_ids(text):
    ids = Tokenizer.from_file(BYTES).encode(text or "", add_special_tokens=False).ids
    return np.array([*ids, 0], "<u4")


def test_prefix_tables_equal_the_library(library):
    tool = token_counts.PrefixCounter(PIECES)
    for _, text, _ in texts():
        cut = (text or "")[:200]
        assert tool.prefix_counts(cut) == [len(library.encode(cut[:i])) for i in range(1, len(cut) + 1)]


def test_forgetting_words_changes_nothing(library):
    tool = token_counts.PrefixCounter(PIECES, kept_words=5)
    assert [tool.count(t or "") for _, t, _ in texts()] == [len(library.encode(t or "")) for _, t, _ in texts()]


def test_counts_and_cuts(spark, library):
    found = token_counts.token_counts(documents(spark), PIECES, budget=50, keep_prefixes=True).collect()
    assert len(found) == len(texts())
    by_key = defaultdict(list)
    for key, text, _ in texts():
        by_key[key].append(text or "")
    for row in found:
        text = next(t for t in by_key[row.doc_id] if len(t) == len(row.prefix_tokens) and len(library.encode(t)) == row.n_tokens)
        assert row.n_bytes == len(text.encode())
        assert row.over_limit == (row.n_tokens > 50)
        fits = [i for i in range(len(text) + 1) if (0, *row.prefix_tokens)[i] <= 50]
        assert row.fit_chars == (max(fits) if row.over_limit else len(text))


def test_kept_tables_answer_budgets(spark, library):
    text = texts()[3][1]
    table = token_counts.token_counts(documents(spark, [(1, text, "s"), (2, None, "s")]), PIECES, keep_prefixes=True)
    row = table.select(
        "doc_id", token_counts.prefix_tokens_at(30).alias("at"), token_counts.longest_prefix(10).alias("fit")
    ).orderBy("doc_id").collect()
    assert row[0]["at"] == len(library.encode(text[:30]))
    assert len(library.encode(text[: row[0]["fit"]])) <= 10 < len(library.encode(text[: row[0]["fit"] + 1]))
    assert tuple(row[1])[1:] == (0, 0)


def test_word_encoder_equals_the_library():
    tool = encoding.WordEncoder(BYTES, kept_words=20)
    assert tool.cuts
    sample = [t or "" for _, t, _ in texts()] + ["a ", " a", "a\n", "\na", "don't we'll\nI'm 12 x1,", "a\x00b"]
    for text, ids in zip(sample, tool.encode(sample), strict=True):
        assert ids.tolist() == expected_ids(text)[:-1].tolist()


def test_token_files_round_trip(spark):
    docs = documents(spark)
    folder = shared_dir(spark, "t")
    index = token_files.write_token_files(docs, folder, BYTES)
    back = token_files.read_records(index.orderBy(F.rand(1)), folder, with_ids=True).collect()
    want = sorted((repr(k), expected_ids(t).tolist()) for k, t, _ in texts())
    assert sorted((repr(r.key), list(r.ids)) for r in back) == want


def test_token_file_digest(spark):
    found = token_files.token_file_digest(documents(spark), BYTES).collect()
    starts = sorted(r.start for r in found)
    lengths = {r.start: r.n_tokens for r in found}
    assert all(b == a + lengths[a] for a, b in zip(starts, starts[1:], strict=False))
    keys = [r.doc_id for r in sorted(found, key=lambda r: r.start)]
    assert keys == sorted(keys, key=lambda k: (k is not None, k or 0))
    want = sorted((repr(k), len(i := expected_ids(t)), zlib.crc32(i.tobytes())) for k, t, _ in texts())
    assert sorted((repr(r.doc_id), r.n_tokens, r.ids_crc32) for r in found) == want


def test_damaged_records_are_noticed():
    data = bytearray(token_files.token_record(7, 3, np.array([1, 70000], np.uint32)))
    number, before, ids = token_files.parsed_record(bytes(data))
    assert (number, before, ids.tolist()) == (7, 3, [1, 70000])
    for at in range(len(data)):
        broken = bytes(data[:at]) + bytes([data[at] ^ 4]) + bytes(data[at + 1 :])
        with pytest.raises(token_files.CorruptRecord):
            token_files.parsed_record(broken)
    with pytest.raises(token_files.CorruptRecord):
        token_files.parsed_record(bytes(data[:-1]))


@pytest.mark.parametrize("seed", range(4))
def test_sum_of_squares_packs_tightly(seed):
    lengths = np.random.default_rng(seed).integers(1, 65, 3000)
    bins, offsets = packing.sum_of_squares(lengths, 64)
    for number in range(bins.max() + 1):
        inside = sorted((offsets[i], lengths[i]) for i in np.flatnonzero(bins == number))
        assert all(a + n == b for (a, n), (b, _) in zip(inside, inside[1:], strict=False)) and inside[0][0] == 0
        assert sum(inside[-1]) <= 64
    assert bins.max() + 1 <= -(-lengths.sum() // 64) * 1.02


def test_packed_documents(spark):
    found = packing.pack_documents(documents(spark), BYTES, capacity=64).collect()
    whole = defaultdict(list)
    for row in found:
        whole[row.doc_id, row.row_no].append(row)
    ids_of = defaultdict(list)
    for key, text, _ in texts():
        ids_of[key].append(expected_ids(text))
    assert len(whole) == len(texts())
    for (key, _), pieces in whole.items():
        pieces.sort(key=lambda r: r.piece)
        crc = [p.ids_crc32 for p in pieces]
        ids = next(i for i in ids_of[key] if len(i) == sum(p.length for p in pieces) and zlib.crc32(i[: pieces[0].length].tobytes()) == crc[0])
        assert [p.length for p in pieces[1:]] == [64] * (len(pieces) - 1)
        assert crc == [zlib.crc32(ids[p.start : p.start + p.length].tobytes()) for p in pieces]
    sequences = defaultdict(list)
    for row in found:
        sequences[row.sequence_id].append((row.offset, row.length))
    for inside in sequences.values():
        at = 0
        for offset, length in sorted(inside):
            assert offset == at
            at += length
        assert at <= 64
    total = sum(r.length for r in found)
    assert len(sequences) <= -(-total // 64) + 2


def test_empty_tables(spark):
    none = documents(spark, [])
    assert token_counts.token_counts(none, PIECES).count() == 0
    assert token_files.token_file_digest(none, BYTES).count() == 0
    assert packing.pack_documents(none, BYTES).count() == 0
