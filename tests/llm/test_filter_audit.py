"""The filter audit against a walk through every order of the filters."""

from __future__ import annotations

import re
from collections import defaultdict
from itertools import permutations

from llm.fixtures import documents, texts

from dialwright.llm import filter_audit

LABELS = "doc_id long, quality int, toxic int, part string, mask int"


def audited(given, labels):
    """Brute force: documents one by one, filter by filter."""
    good = {k for k, q, _ in labels if k is not None and q == 1}
    toxic = {k for k, _, t in labels if k is not None and t == 1}

    def fails(key, text):
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        return {
            "A": len(words) < 200,
            "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * sum("A" <= c <= "Z" for c in text) > 2 * len(text),
            "D": any(c in "#$%&*|" for c in text),
            "E": key is not None and any(k is not None and k < key and (t or "") == text for k, t, _ in given),
        }

    parts = defaultdict(list)
    for key, text, source in given:
        parts[source or ""].append((key, fails(key, text or "")))
    found = []
    for part, docs in parts.items():
        rows, shapley = [], dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left, gone = docs, []
            for step, letter in enumerate(order, 1):
                out = [d for d in left if d[1][letter]]
                only = [d for d in docs if d[1][letter] and sum(d[1].values()) == 1]
                again = [d for d in gone if d[1][letter]]
                left = [d for d in left if not d[1][letter]]
                gone = gone + out
                shapley[letter] += len(out)
                lost = [len([d for d in out if d[0] in marked]) for marked in (good, toxic)]
                rows.append((part, "".join(order), step, len(left), len(out), len(again), len(only), *lost))
        found += [(*r, shapley[r[1][r[2] - 1]]) for r in rows]
    return sorted(found)


def run(spark, given, labels):
    marked = spark.createDataFrame([(*label, "x", 1) for label in labels], LABELS)
    return sorted(tuple(r) for r in filter_audit.filter_audit(documents(spark, given), marked).collect())


def test_every_order_equals_brute_force(spark):
    given = texts()
    # A hot text, repeated and missing ids, a part of its own for null and for the empty string.
    given += [(500 + i, "Loud | TEXT " * 120, "hot") for i in range(30)] + [(None, "Loud | TEXT " * 120, None)] * 9
    given += [(600, "", ""), (601, None, ""), (601, "# x", None)]
    labels = [(k, 1, 0) for k in range(0, 20, 2)] + [(k, 0, 1) for k in range(0, 20, 3)] + [(510, 1, 1), (510, None, 0)]
    labels += [(None, 1, 1), (9999, 1, 1), (3, None, None)]
    rows = run(spark, given, labels)
    assert len(rows) == 600 * len({s or "" for _, _, s in given})
    assert rows == audited(given, labels)


def test_without_documents_or_labels(spark):
    assert run(spark, [], [(1, 1, 1)]) == []
    given = [(1, "a b", "s"), (2, "a b", "s")]
    assert run(spark, given, []) == audited(given, [])


def test_the_row_limit_of_the_session_is_kept(spark):
    name = "spark.sql.cteRecursionRowLimit"
    before = spark.conf.get(name)
    run(spark, [(1, "a", "s")], [])
    assert spark.conf.get(name) == before
