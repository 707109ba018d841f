"""Property checks on random small inputs."""

import datetime as dt
import hashlib
import hmac
import random
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from demandcast.functions.hashing import hmac_sha256_hex
from demandcast.operators.linking import link_panel_credit
from demandcast.operators.lookup import lookup_forecasts
from demandcast.operators.weighting import rake
from demandcast.schemas import REQUEST_SCHEMA


@settings(max_examples=5, deadline=None)
@given(texts=st.lists(st.text(max_size=40), min_size=1, max_size=20), salt=st.text(min_size=1, max_size=90))
def test_hmac_equals_python(spark, texts, salt):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(hmac_sha256_hex(F.col("t"), salt)).collect()]
    want = [hmac.new(salt.encode(), t.encode(), hashlib.sha256).hexdigest() for t in texts]
    assert got == want


@settings(max_examples=4, deadline=None)
@given(seed=st.integers(0, 10_000))
def test_linked_rows_are_sum_of_products(spark, seed):
    rng = random.Random(seed)
    ids = [f"c{i}" for i in range(6)] + [None]
    panel = [(f"p{i}", rng.choice(ids)) for i in range(rng.randint(1, 10))]
    credit = [(i, rng.choice(ids)) for i in range(rng.randint(1, 30))]
    p = spark.createDataFrame(panel, "panel_id string, customer_id string")
    c = spark.createDataFrame(credit, "txn_id long, customer_id string")
    pc, cc = Counter(x for _, x in panel if x), Counter(x for _, x in credit if x)
    assert link_panel_credit(p, c).count() == sum(pc[k] * cc[k] for k in pc)


@settings(max_examples=3, deadline=None)
@given(seed=st.integers(0, 10_000), iters=st.integers(1, 4))
def test_raking_meets_last_margin(spark, seed, iters):
    rng = random.Random(seed)
    rows = [(rng.choice("abc"), rng.choice("xyz")) for _ in range(40)]
    df = spark.createDataFrame(rows, "g1 string, g2 string")
    targets = {"g1": {k: rng.uniform(5, 50) for k in "abc"}, "g2": {k: rng.uniform(5, 50) for k in "xyz"}}
    res = rake(df, targets, max_iter=iters, tol=0.0)
    totals = Counter()
    for r in res.weighted.collect():
        totals[r["g2"]] += r["weight"]
    for k, v in totals.items():
        assert abs(v - targets["g2"][k]) < 1e-9 * max(1.0, v)


@settings(max_examples=4, deadline=None)
@given(seed=st.integers(0, 10_000))
def test_batch_lookup_matches_brute_force(spark, seed):
    rng = random.Random(seed)
    series = [(s, r) for s in ("A", "B", "C") for r in ("N", "S")]
    fc = []
    for s, r in series:
        if rng.random() < 0.8:
            for k in rng.sample(range(20), rng.randint(1, 8)):
                fc.append((s, r, dt.date(2025, 1, 6) + dt.timedelta(weeks=k), float(k), k + 1.0, k + 2.0))
    reqs = [(f"q{i}", *rng.choice(series), rng.randint(0, 10)) for i in range(15)]
    f = spark.createDataFrame(fc, "sku string, region string, date date, `q0.1` double, `q0.5` double, `q0.9` double")
    q = spark.createDataFrame(reqs, REQUEST_SCHEMA)
    got = sorted((r["request_id"], r["date"]) for r in lookup_forecasts(f, q).collect())
    want = []
    for rid, s, r, h in reqs:
        dates = sorted(x[2] for x in fc if x[0] == s and x[1] == r)[:h]
        want += [(rid, d.isoformat()) for d in dates]
    assert got == sorted(want)
