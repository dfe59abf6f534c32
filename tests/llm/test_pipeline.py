"""The whole pipeline on the smallest tables: what every stage promises of its own input."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import corpus_pipeline
import public_tokenizers
from llm.fixtures import collected
from tokenizers import Tokenizer

from dialwright.llm import quality
from dialwright.llm.common import stored, table


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda c: c[0].lower(), text or ""))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def windows(text):
    data = (text or "").encode()
    return {data[i : i + 50] for i in range(len(data) - 49)}


def test_every_stage_keeps_its_promise(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    outputs, docs = {}, documents
    for name, stage in corpus_pipeline.STAGES:
        docs = outputs[name] = stored(stage(spark, docs, sf_dir), f"test-{name}")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert all(outputs[name].columns == documents.columns for name in names[:-1])
    good, single, clean, mixed, packed = (outputs[name] for name in names)

    scored = quality.score_documents(documents, quality.trusted_ids(table(spark, sf_dir, "labels")))
    kept = {r.doc_id for r in scored.where("kept").collect()}
    assert collected(good) == [r for r in collected(documents) if r[0] in kept] and 0 < len(kept) < documents.count()

    texts = {r.doc_id: r.text for r in good.collect()}
    sets = {key: shingles(text) for key, text in texts.items()}
    stay = {r.doc_id for r in single.collect()}
    assert stay < set(texts)
    for key in stay:
        near = [k for k in stay if k < key and len(sets[k] & sets[key]) >= 0.8 * len(sets[k] | sets[key])]
        assert not near
    assert all(r.text == texts[r.doc_id] for r in single.collect())

    seen: set[bytes] = set()
    cut = {r.doc_id: r for r in clean.collect()}
    assert set(cut) == stay and all(r.n_chars == len(r.text) for r in cut.values())
    for key in sorted(stay):
        own = windows(texts[key])
        assert (cut[key].text == texts[key]) == (not own & seen)
        seen |= own

    counts = Counter(r.doc_id for r in mixed.collect())
    assert set(counts) <= stay and abs(sum(counts.values()) - len(stay)) < 6 * len(stay) ** 0.5
    assert all(r.text == cut[r.doc_id].text for r in mixed.collect())

    tool = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokens = sum(n * (len(tool.encode(cut[k].text, add_special_tokens=False).ids) + 1) for k, n in counts.items())
    bins = defaultdict(list)
    for r in packed.collect():
        bins[r.sequence_id].append((r.offset, r.length))
    assert sum(length for pieces in bins.values() for _, length in pieces) == tokens
    for pieces in bins.values():
        end = 0
        for offset, length in sorted(pieces):
            assert offset == end
            end += length
        assert end <= 2048
    assert collected(corpus_pipeline.run(spark, sf_dir).select("doc_id", "piece", "length")) == collected(packed.select("doc_id", "piece", "length"))
