"""MaxScore on large numbers, and what it passes by."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfwright.llm import maxscore


@pytest.mark.parametrize("size", [2**20, 2**28, 2**31 - 1])
def test_large_components_are_scored_exactly(size):
    g = np.random.default_rng(size)
    rows = g.integers(-size, size, (50, 2))
    rows[::7] = rows[0]
    ids = g.permutation(50)
    for k in (1, 3, 60):
        best = maxscore._Best(ids[:6], k)
        for part in np.array_split(np.arange(50), 5):
            maxscore.score_shard(best, rows[:6], ids[part], rows[part])
        for i in range(6):
            exact = [sum(int(a) * int(b) for a, b in zip(rows[i], r)) for r in rows]
            want = sorted((-exact[j], int(ids[j])) for j in range(50) if ids[j] != ids[i])[:k]
            assert [(-s, r) for r, s in zip(*(x.tolist() for x in best.rows[i]))] == want


def test_bounds_beyond_64_bits(spark):
    rows = [(0, [400000001] + [0] * 63), (1, [400000003] + [0] * 63), (2, [400000002] + [0] * 63)]
    df = spark.createDataFrame(rows, "id long, terms array<long>")
    out = maxscore.top_k(df, F.col("id") == 0, 2).collect()
    assert sorted(tuple(r) for r in out) == [(0, 1, 1, 400000001 * 400000003), (0, 2, 2, 400000001 * 400000002)]


def test_a_shard_that_cannot_matter_is_not_traversed(monkeypatch):
    best = maxscore._Best(np.array([0]), 1)
    query = np.array([[5, 1]])
    maxscore.score_shard(best, query, np.array([1]), np.array([[9, 9]]))
    added = []
    monkeypatch.setattr(best, "add", lambda *a: added.append(a))
    read = []
    real = np.flatnonzero
    monkeypatch.setattr(maxscore.np, "flatnonzero", lambda x: read.append(x) or real(x))
    maxscore.score_shard(best, query, np.array([2, 3]), np.array([[9, 1], [1, 8]]))
    assert not added and len(read) == 1  # nothing alive, so no postings were chosen
