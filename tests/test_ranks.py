"""Quantiles by rank against plain ones."""

import random

import numpy as np
from pyspark.sql import functions as F

from demandcast.functions.ranks import counted_quantiles, order_bucket
from demandcast.operators.forecast import naive_quantile_forecast

SHARES = [0.0, 0.1, 0.25, 0.5, 0.9, 0.999, 1.0]


def test_equal_to_numpy_for_any_magnitude(spark):
    rng = random.Random(4)
    groups = {
        "whole": [float(rng.randrange(-40, 40)) for _ in range(3000)],
        "wide": [rng.choice([-1, 1]) * 10 ** rng.uniform(-300, 300) for _ in range(500)],
        "tiny": [5e-324, -5e-324, 0.0, 1.0],
        "one": [7.5],
        "same": [2.0] * 900,
        "zero": [0.0, -0.0, 0.0],
    }
    rows = [(g, v) for g, vs in groups.items() for v in vs]
    counts = spark.createDataFrame(rows, "g string, v double").repartition(5).groupBy("g", "v").agg(F.count(F.lit(1)).alias("n"))
    names = [f"q{i}" for i in range(len(SHARES))]
    found = {r.g: r for r in counted_quantiles(counts, ["g"], "v", "n", SHARES, names).collect()}
    assert found.keys() == groups.keys()
    for g, vs in groups.items():
        assert np.allclose([found[g][n] for n in names], np.quantile(vs, SHARES), rtol=1e-9, atol=1e-300)


def test_buckets_follow_the_order(spark):
    rng = random.Random(5)
    values = sorted({rng.choice([-1, 1]) * 10 ** rng.uniform(-307, 307) for _ in range(2000)} | {0.0, 1e308, -1e308, 5e-324, float("inf"), float("-inf")})
    rows = spark.createDataFrame([(v,) for v in values], "v double").select("v", order_bucket(F.col("v")).alias("b")).collect()
    buckets = [r.b for r in sorted(rows)]
    assert buckets == sorted(buckets)


def test_no_percentile_and_nothing_collected(spark):
    features = spark.createDataFrame([("a", "n", "2024-01-01", 3)], "sku string, region string, week string, units_sold long").withColumn("week", F.to_timestamp_ntz("week"))
    plan = naive_quantile_forecast(features)._jdf.queryExecution().optimizedPlan().toString().lower()
    assert "percentile" not in plan and "collect_list" not in plan


def test_thin_series_borrow_from_their_sku_alone(spark):
    rng = random.Random(6)
    rows = []
    for sku, region, n in (("a", "n", 30), ("a", "s", 3), ("b", "n", 25), ("b", "s", 25), ("c", "n", 1), ("d", "n", 4)):
        rows += [(sku, region, i, rng.randrange(100)) for i in range(n)]
    features = spark.createDataFrame(rows, "sku string, region string, i int, units_sold long").withColumn("week", F.date_add(F.lit("2024-01-01").cast("date"), F.col("i") * 7).cast("timestamp_ntz"))
    units = {}
    for sku, region, _, u in rows:
        units.setdefault((sku, region), []).append(float(u))
    steps = {k: list(np.diff(v)) for k, v in units.items()}
    for r in naive_quantile_forecast(features, horizon=1, clamp=False).collect():
        own = steps[r.sku, r.region]
        base = own if len(own) >= 8 else [c for k, v in steps.items() if k[0] == r.sku for c in v]
        for q in (0.1, 0.5, 0.9):
            want = units[r.sku, r.region][-1] + (float(np.quantile(base, q)) if base else 0.0)
            assert abs(r[f"q{q}"] - want) < 1e-6
    kept = {(r.sku, r.region) for r in naive_quantile_forecast(features, horizon=1, pooled=False).collect()}
    assert kept == {k for k, v in steps.items() if len(v) >= 8}
