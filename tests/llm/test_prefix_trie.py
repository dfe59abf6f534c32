"""The prefix trie against one that is built turn by turn."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import defaultdict

from dialwright.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, p long, node string, words long, h int, base long, i int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "n", 2, 3, 4, 5) for r in rows], SCHEMA).repartition(3)


def built(rows):
    """Brute force over lists of turns."""
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            said = (role or "", text or "")
            digest = hashlib.md5(f"{len(said[0])}:{said[0]}{said[1]}".encode()).hexdigest()
            own[conv].append(((turn is not None, turn or 0), digest, said))
    own = {c: [s for _, _, s in sorted(turns)] for c, turns in own.items()}
    whole = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 4
        base = c - c % 20 if c >= 0 else c + (-c) % 20
        whole[c] = tuple(own.get(base, [])[:h] + own[c][h:])
    members = defaultdict(list)
    for c, said in whole.items():
        for d in range(len(said) + 1):
            members[said[:d]].append(c)
    children = defaultdict(set)
    for path in members:
        if path:
            children[path[:-1]].add(path)
    found = []
    for path in members:
        below = [other for other in members if other[: len(path)] == path]
        words = {o: len(re.findall(r"[^\x20\x09-\x0D]+", o[-1][1])) if o else 0 for o in below}
        ends = sorted(c for c in members[path] if len(whole[c]) == len(path))
        found.append(
            (
                min(members[path]),
                len(path),
                min(members[path[:-1]]) if path else None,
                len(members[path]),
                len(children[path]),
                sum(not children[o] for o in below),
                sum((len(members[o]) - 1) * words[o] for o in below),
                hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
            )
        )
    return sorted(found, key=repr)


def run(spark, rows):
    return sorted((tuple(r) for r in prefix_trie.prefix_trie(frame(spark, rows)).collect()), key=repr)


def sample():
    rng = random.Random(11)
    rows = []
    for c in range(90):
        # Few different texts, so that prefixes are shared and whole conversations repeat.
        for t in range(rng.randint(1, 6)):
            rows.append((c, t, "user" if t % 2 else "system", " ".join(rng.choice(["hi", "you", "go on"]) for _ in range(rng.randint(0, 2)))))
    rows += [(c, t, "user", f"same {t}") for c in range(200, 240) for t in range(3)]  # a hot sequence
    rows += [(500, t, None if t % 5 else "user", f"t {t % 7}") for t in range(150)]  # a long conversation
    rows += [(501, t, "user", None) for t in (3, None, 1, 1, 2)]  # no number, equal numbers, a repeated row
    rows += [(501, 1, "a", "b"), (501, 1, "ab", "")]  # framing matters
    rows += [(None, 0, "user", "no id"), (None, None, None, None)]
    rows += [(-5, 0, "user", "below zero"), (-5, 1, "user", ""), (-20, 0, "user", "x y"), (999_999_999_999, 0, "user", "far")]
    rows += [(1001, 0, "user", "alone"), (1003, 0, "user", "alone"), (1009, 1, "user", "alone")]  # without a base
    return rows


def test_trie_equals_brute_force(spark):
    rows = sample()
    assert run(spark, rows) == built(rows)


def test_end_lists_of_any_length(spark, monkeypatch):
    """Ends that come in several strings and segments hash like one list."""
    monkeypatch.setattr(prefix_trie, "ENDS_AT_ONCE", 7)
    rows = [(c, 0, "user", "one") for c in range(1, 130)]
    assert run(spark, rows) == built(rows)


def test_one_conversation_and_none(spark):
    assert run(spark, []) == []
    assert run(spark, [(None, 1, "user", "x")]) == []
    rows = [(40, 1, "user", "b c"), (40, 0, "user", "a")]
    assert run(spark, rows) == built(rows)
