"""Exact top-k against brute force."""

import math
from fractions import Fraction

import pytest
from llm_helpers import clashing, rng

from demandcast.llm import topk as K
from demandcast.llm.common import Scratch


def brute(rows, queries, k=5):
    def ints(v):
        if not v or any(x is None or not math.isfinite(x) for x in v):
            return None
        return [math.floor(256 * Fraction(x)) for x in v]

    good = [(i, v) for i, v in ((i, ints(v)) for i, v in rows) if i is not None and v]
    out = []
    for q, x in ((i, ints(v)) for i, v in queries):
        if q is None or not x:
            continue
        scored = sorted((-sum(a * b for a, b in zip(x, y)), i) for i, y in good if i != q and len(y) == len(x))
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored[:k])]
    return sorted(out)


def table(spark, rows):
    return clashing(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int"))


def run(spark, rows, every=5, **options):
    df = table(spark, [(i, v, 0) for i, v in rows]).repartition(3)
    found = K.top_k(df, df.filter(df.vec_id % every == 0), Scratch(spark, "t"), **options)
    return sorted(map(tuple, found.collect()))


def as_float(v):
    import numpy as np

    return None if v is None else [None if x is None else float(np.float32(x)) for x in v]


def test_matches_brute_force(spark):
    r = rng(3)
    rows = [(i, [r.gauss(0, 1) for _ in range(12)]) for i in range(150)]
    rows += [(200 + i, rows[7][1]) for i in range(40)]  # ties
    rows += [(300, None), (301, []), (302, [None] + [1.0] * 11), (303, [math.nan] * 12), (304, [math.inf] * 12), (None, [1.0] * 12)]
    rows += [(305, [1.0, 2.0]), (310, [3.0, -1.0]), (0, rows[0][1]), (10, [0.5] * 12), (400, [1e6] * 12)]
    rows = [(i, as_float(v)) for i, v in rows]
    want = brute(rows, [x for x in rows if x[0] is not None and x[0] % 5 == 0])
    assert run(spark, rows) == want
    assert run(spark, rows, chunk_rows=16, blocks=3) == want


def test_fewer_candidates_and_large_products(spark):
    rows = [(0, [1.0, -1.0]), (1, [2.0, 0.0]), (5, [-3.0, 4.0])]
    assert run(spark, rows) == brute(rows, [rows[0], rows[2]])
    rows = [(0, [1e10, 1.0]), (1, [1e3, 1e4]), (2, [1e3, 1e4 + 1])]
    rows = [(i, as_float(v)) for i, v in rows]
    assert run(spark, rows) == brute(rows, rows[:1])
    assert run(spark, []) == []


def test_components_of_any_size_take_part(spark):
    """No vector is left out for the size of its components, as long as its
    scores fit 64 bits."""
    rows = [(0, [0.0, 1.0]), (1, [2e16, 5.0]), (2, [1e300, 4.0]), (3, [1.7e308, 9.0]), (4, [-1e306, 2.0]), (6, [0.0, 3.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = sorted(map(tuple, K.top_k(df, df.filter("vec_id = 0"), Scratch(spark, "t")).collect()))
    assert found == brute(rows, rows[:1])
    with pytest.raises(Exception):
        K.top_k(df, df.filter("vec_id = 1"), Scratch(spark, "t")).collect()
