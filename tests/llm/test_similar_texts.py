"""The pipeline's near-duplicate stage against brute force."""

from __future__ import annotations

import itertools
import random
import re

import corpus_pipeline
import pytest
from llm.fixtures import collected, documents, texts
from llm.test_dedup import groups_of

from dialwright.llm import similar_texts


def shingles(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    return frozenset(tuple(words[i : i + 5]) for i in range(max(len(words) - 4, min(len(words), 1))))


def plain_groups(rows):
    """Smallest key of every row's group, by all pairs."""
    sets = [shingles(t) for _, t in rows]
    pairs = itertools.combinations(range(len(rows)), 2)
    links = [(i, j) for i, j in pairs if sets[i] == sets[j] or 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])]
    group = groups_of(range(len(rows)), links)
    least = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            least[group[i]] = min(key, least.get(group[i], key))
    return sorted([(key, least.get(group[i])) for i, (key, _) in enumerate(rows)], key=repr)


def near_copies(seed=1, pairs=150):
    """Lone pairs a little above and below 0.8, and a group of copies of one text with changes."""
    rng = random.Random(seed)

    def words(n):
        return [f"w{rng.randrange(5000)}" for _ in range(n)]

    def changed(own, edits):
        own = list(own)
        for at in rng.sample(range(0, len(own), 5), edits):
            own[at] = "other" + str(rng.random())
        return own

    out = []
    for _ in range(pairs):
        own = words(rng.randint(60, 300))
        # An edit takes five shingles from either text: J is about (n - 5 e) / (n + 5 e).
        out += [own, changed(own, max(1, round(len(own) * rng.uniform(0.016, 0.024))))]
    own = words(120)
    out += [changed(own, rng.randrange(4)) for _ in range(80)]
    rng.shuffle(out)
    return [(i, " ".join(o)) for i, o in enumerate(out)]


def as_documents(spark, rows):
    return documents(spark, [(k, t, "s") for k, t in rows])


@pytest.mark.parametrize("tile, part_bytes", [(2048, 8 << 20), (9, 20_000)])
def test_similar_texts(spark, monkeypatch, tile, part_bytes):
    for name in ("candidate_links", "exact_links"):
        whole = getattr(similar_texts, name)
        monkeypatch.setattr(similar_texts, name, lambda *a, whole=whole, **k: whole(*a, **k, tile=tile))
    monkeypatch.setattr(similar_texts, "PART_BYTES", part_bytes)
    rows = [(k, t) for k, t, _ in texts()] + [(1000 + k, t) for k, t in near_copies()]
    assert collected(similar_texts.similar_texts(as_documents(spark, rows))) == plain_groups(rows)


def test_stage_keeps_one_of_each(spark):
    rows = near_copies(seed=2)
    stage = dict(corpus_pipeline.STAGES)["near_duplicates"]
    kept = stage(spark, as_documents(spark, rows), "")
    want = sorted({least for _, least in plain_groups(rows)})
    assert len(want) < len(rows) - 100
    assert kept.columns == as_documents(spark, rows).columns
    assert sorted(r.doc_id for r in kept.collect()) == want


def test_rows_without_a_key_all_stay(spark):
    kept = similar_texts.one_of_each(documents(spark))
    keys = [r.doc_id for r in kept.collect()]
    named = [k for k in keys if k is not None]
    want = {k for k, least in plain_groups([(k, t) for k, t, _ in texts()]) if k is not None and k == least}
    assert sorted(named) == sorted(want) and keys.count(None) == 2
    assert similar_texts.one_of_each(documents(spark, [])).count() == 0


def test_two_texts_under_one_key_leave_the_same_one_each_time(spark):
    rows = [(1, f"text number {i} has its own words {i * 7} and {i * 13}", "s") for i in range(30)]
    kept = {similar_texts.one_of_each(documents(spark, rows).repartition(n)).first().text for n in (1, 3, 7)}
    assert len(kept) == 1
