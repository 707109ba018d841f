"""Approximate nearest neighbours against brute force."""

import math

import numpy as np
import pytest
from llm_helpers import clashing, rng

from demandcast.llm import collision_ann as A
from demandcast.llm.common import Scratch


def brute(rows, every=20, k=20):
    def good(v):
        return v and all(x is not None and math.isfinite(x) for x in v) and any(v)

    taken = [(i, np.array(v, np.float64)) for i, v in rows if i is not None and good(v)]
    out = {}
    for q, x in taken:
        if q % every == 0:
            near = sorted((-float((x * y).sum()), i) for i, y in taken if i != q and len(y) == len(x))[:k]
            out.setdefault(q, []).append([(r + 1, i, -s) for r, (s, i) in enumerate(near)])
    return out


def run(spark, rows, parts=3, **options):
    df = clashing(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).repartition(parts)
    found = {}
    for r in A.nearest(df, df.filter("vec_id % 20 = 0"), Scratch(spark, "t"), **options).collect():
        found.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    return {q: sorted(x) for q, x in found.items()}


def gauss(r, n, dim, scale=1.0):
    return [float(np.float32(scale * r.gauss(0, 1))) for _ in range(dim)]


def test_small_tables_are_exact(spark):
    """With fewer vectors than wanted every vector is verified."""
    r = rng(3)
    rows = [(i, gauss(r, i, 12, 1 + i % 5)) for i in range(130)]
    rows += [(200 + i, rows[40][1]) for i in range(60)]  # copies of a query: ties
    rows += [(300, None), (320, []), (340, [None] + [1.0] * 11), (360, [math.nan] * 12), (380, [math.inf] * 12), (400, [0.0] * 12), (None, [1.0] * 12)]
    rows += [(500, [1.0, 2.0]), (501, [3.0, -1.0]), (520, [1.0] * 3), (540, [2.0**63] * 12), (541, [2.0**-66] * 12)]
    want = {q: x[0] for q, x in brute(rows).items() if x[0]}
    got = run(spark, rows, chunk_rows=16)
    assert run(spark, rows, parts=9, chunk_rows=40) == got
    assert got.keys() == want.keys()
    for q, near in want.items():
        assert [x[:2] for x in got[q]] == [x[:2] for x in near]
        assert np.allclose([x[2] for x in got[q]], [x[2] for x in near], rtol=1e-12)


def test_nothing_and_repeated_queries(spark):
    assert run(spark, []) == {}
    rows = [(0, [1.0, 0.0]), (0, [0.0, 1.0]), (1, [2.0, 3.0]), (2, [2.0, 3.0])]
    assert run(spark, rows) == {0: [(1, 1, 2.0), (1, 1, 3.0), (2, 2, 2.0), (2, 2, 3.0)]}


@pytest.mark.parametrize("kind", ["sphere", "clusters", "norms"])
def test_recall(spark, kind):
    """Candidates are a part of the table, and at least 0.9 of the nearest are found."""
    r = np.random.default_rng(5)
    x = r.normal(size=(3000, 48))
    if kind == "clusters":
        x = r.normal(size=(30, 48))[r.integers(0, 30, 3000)] + 0.3 * x
    x /= np.linalg.norm(x, axis=1)[:, None]
    if kind == "norms":
        x *= r.uniform(0.5, 1.5, 3000)[:, None]
    rows = [(i, [float(c) for c in v.astype(np.float32)]) for i, v in enumerate(x)]
    got, want = run(spark, rows, chunk_rows=700), brute(rows)
    hit = sum(len({i for _, i, _ in got[q]} & {i for _, i, _ in near[0]}) for q, near in want.items())
    assert hit >= 0.93 * 20 * len(want)


def test_level_is_the_first_with_enough():
    """Candidates and levels, by plain comparison of projections."""
    r = np.random.default_rng(6)
    x = r.normal(size=(500, 16))
    x /= np.linalg.norm(x, axis=1)[:, None]
    keys = (np.column_stack([x, np.zeros(500)]) @ A.directions(17, 32)).T.astype("<f4")
    ordered, ranks = A.sorted_arrays(keys)
    chunk = A.Chunk(500, ordered.tobytes(), ranks.tobytes(), 24)
    centres = np.concatenate([keys.T[:5], 9 + keys.T[5:7], keys.T[7:9] * 0])

    def plain(q, level):
        low, high = centres[q] - A.WIDTHS[level], centres[q] + A.WIDTHS[level]
        return np.flatnonzero(((keys.T >= low) & (keys.T <= high)).sum(axis=1) >= 24)

    for wanted in (1, 60, 499):
        for guess in (0, A.FIRST_GUESS, 198):
            found, levels = chunk.search(centres, wanted, guess)
            for q, (some, level) in enumerate(zip(found, levels)):
                assert some.tolist() == plain(q, level).tolist() and len(some) >= wanted
                assert level == 0 or len(plain(q, level - 1)) < wanted
    assert chunk.search(centres, 500, 3)[1].tolist() == [A.LEVELS - 1] * len(centres)
