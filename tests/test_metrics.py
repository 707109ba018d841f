import math
import random

import pytest
from pyspark.sql import functions as F

from demandcast.functions.numeric import fixed_sums
from demandcast.operators.metrics import pinball_loss, score_by_series, wape

SCHEMA = "actual double, `q0.1` double, `q0.5` double, `q0.9` double"


def pairs(spark, ys, ps):
    return spark.createDataFrame([(float(y), float(p), float(p), float(p)) for y, p in zip(ys, ps)], SCHEMA)


def test_wape_known_value(spark):
    # errors 3, 0.5, 0, 6.5 of 3 + 4.5 + 16 + 1 sold
    assert wape(pairs(spark, [3, 4.5, 16, -1], [0, 5, 16, 5.5])).first()["wape"] == pytest.approx(10 / 24.5)


def test_wape_without_sales_divides_by_its_floor(spark):
    assert wape(pairs(spark, [0, 0, 0], [0.25, -0.5, 0])).first()["wape"] == pytest.approx(0.75 / 1e-9)


def test_wape_empty_is_zero(spark):
    assert wape(spark.createDataFrame([], SCHEMA)).first()["wape"] == 0.0


def test_wape_nan_propagates(spark):
    df = spark.createDataFrame([(1.0, 1.0, float("nan"), 1.0)], SCHEMA)
    assert math.isnan(wape(df).first()["wape"])


def test_pinball(spark):
    """Two sold above the forecast by 4 and 2.5, one below by 8, one met."""
    got = {r["quantile"]: r["pinball_loss"] for r in pinball_loss(pairs(spark, [9, 6.5, 1, 7], [5, 4, 9, 7])).collect()}
    for q in (0.1, 0.5, 0.9):
        assert got[q] == pytest.approx((q * 6.5 + (1 - q) * 8) / 4)
    assert {r["pinball_loss"] for r in pinball_loss(pairs(spark, [4, 8], [4, 8])).collect()} == {0.0}


def test_pinball_empty_is_null(spark):
    rows = pinball_loss(spark.createDataFrame([], SCHEMA)).collect()
    assert all(r["pinball_loss"] is None for r in rows)


def test_scores_independent_of_partitioning(spark):
    df = spark.createDataFrame(
        [("s", float(i % 7), i / 3.0, i / 7.0, i / 11.0) for i in range(500)],
        "sku string, actual double, `q0.1` double, `q0.5` double, `q0.9` double",
    ).withColumnRenamed("sku", "sku")
    a = score_by_series(df, keys=["sku"]).collect()
    b = score_by_series(df.repartition(13), keys=["sku"]).collect()
    assert a == b


def test_missing_infinite_tiny_and_huge_numbers_count(spark):
    nan, inf = float("nan"), float("inf")

    def scores(y, p):
        df = spark.createDataFrame([(a, b, b, b) for a, b in zip(y, p)], SCHEMA)
        return wape(df).first()["wape"], {r["quantile"]: r["pinball_loss"] for r in pinball_loss(df).collect()}

    for y, p in (([10.0, 10.0], [10.0, None]), ([10.0, None], [10.0, 1.0]), ([10.0, nan], [10.0, 1.0]), ([1.0], [nan])):
        w, loss = scores(y, p)
        assert math.isnan(w) and all(math.isnan(v) for v in loss.values())
    w, loss = scores([1.0, 2.0], [1.0, inf])
    assert w == inf and loss[0.5] == inf
    w, loss = scores([1e-8], [3e-8])
    assert w == pytest.approx(2.0) and loss[0.5] == pytest.approx(1e-8)
    w, loss = scores([1e25, 1.0], [2e25, 1.0])
    assert w == pytest.approx(1.0) and loss[0.1] == pytest.approx(0.9 * 1e25 / 2)


def test_close_numbers_are_not_taken_for_equal(spark):
    pairs = spark.createDataFrame([(1 + 4e-13, 1.0)], "actual double, `q0.5` double")
    got = wape(pairs).first()[0]
    assert abs(got - 4e-13) < 1e-15
    assert wape(spark.createDataFrame([(1e-20, 3e-20)], "actual double, `q0.5` double")).first()[0] > 0


def test_scores_do_not_depend_on_the_partitioning(spark):
    r = random.Random(11)
    rows = [(r.choice([-1, 1]) * 10 ** r.uniform(-20, 30), r.choice([-1, 1]) * 10 ** r.uniform(-20, 30)) for _ in range(3000)]
    rows += [(r.uniform(0, 1) / 3, r.uniform(0, 9) / 7) for _ in range(3000)]
    seen = set()
    for parts, seed in ((1, 0), (3, 1), (11, 2), (16, 3)):
        random.Random(seed).shuffle(rows)
        pairs = spark.createDataFrame(rows, "actual double, `q0.5` double").repartition(parts)
        total = fixed_sums(pairs, [], {"a": F.col("actual"), "q": F.col("`q0.5`")}).first()
        seen.add((wape(pairs).first()[0], *[x.pinball_loss for x in pinball_loss(pairs, [0.5]).collect()], *total))
    assert len(seen) == 1
    exact = math.fsum(a for a, _ in rows)
    assert abs(seen.pop()[2] - exact) <= 1e-12 * abs(exact)


def test_bands_hold_any_value_of_their_range(spark):
    r = random.Random(12)
    for low, high in ((-23, -15), (-12, 0), (0, 12), (28, 35)):
        values = [r.choice([-1, 1]) * 10 ** r.uniform(low, high) for _ in range(500)]
        got = spark.createDataFrame([(v,) for v in values], "v double").transform(lambda d: fixed_sums(d, [], {"v": F.col("v")})).first()[0]
        assert abs(got - math.fsum(values)) <= 1e-14 * math.fsum(map(abs, values))
    odd = [float("inf"), 1.0, 1e300, 1e-300]
    assert spark.createDataFrame([(v,) for v in odd], "v double").transform(lambda d: fixed_sums(d, [], {"v": F.col("v")})).first()[0] == float("inf")
