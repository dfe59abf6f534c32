"""Lone links of vectors in a dense cluster."""

from __future__ import annotations

import numpy as np
import pytest

from dialwright.llm import embeddings


def hot_cluster(pairs=150, others=5000, clustered=2000, dim=64, seed=4):
    """Lone pairs at cosine 0.90 to 0.92, two thirds of them in a cluster of mutual cosine 0.7, which does not link."""
    rng = np.random.default_rng(seed)

    def unit(x):
        return x / np.linalg.norm(x, axis=-1, keepdims=True)

    def around(centre, n):
        off = rng.standard_normal((n, dim))
        return unit(0.7**0.5 * centre + 0.3**0.5 * unit(off - (off @ centre)[:, None] * centre))

    centre = unit(rng.standard_normal(dim))
    ones = np.vstack([around(centre, 2 * pairs // 3), unit(rng.standard_normal((pairs - 2 * pairs // 3, dim)))])
    cos = rng.uniform(0.901, 0.92, (pairs, 1))
    off = rng.standard_normal(ones.shape)
    twos = cos * ones + (1 - cos**2) ** 0.5 * unit(off - (off * ones).sum(axis=1, keepdims=True) * ones)
    return np.vstack([ones, twos, around(centre, clustered), unit(rng.standard_normal((others, dim)))])


def test_lone_links_in_a_dense_cluster(spark):
    rows = hot_cluster()
    table = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(rows)], "vec_id long, embedding array<double>")
    found = {r.vec_id: r.n_links for r in embeddings.near_duplicates(table, window=16, block=512).collect()}
    links = (rows @ rows.T >= 0.9).sum(axis=1) - 1
    assert links.sum() >= 300
    missed = sum(found[i] < n for i, n in enumerate(links.tolist()))
    assert missed <= 0.02 * links.sum() and all(found[i] <= n for i, n in enumerate(links.tolist()))


@pytest.mark.parametrize("n", [100, 50_000, 2_000_000, 10**9])
def test_passes_hold_the_bound(n):
    bits = embeddings.range_bits(n, 256)
    shared = (1 - np.arccos(0.9) / np.pi) ** bits
    assert n / 2**bits <= 128 and (1 - shared) ** embeddings.passes_for(n, 256, 0.9) <= embeddings.MISS
