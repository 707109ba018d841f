"""Poisson mixing: counts by inversion, means, and cases."""

import hashlib
import math

from llm_helpers import clashing, documents

from demandcast.llm import mixing as M
from demandcast.llm.common import Scratch


def brute_count(rate, u):
    k, p = 0, math.exp(-rate)
    total = p
    while total <= u:
        k += 1
        p *= rate / k
        total += p
    return k


def uniform(seed, i):
    return int(hashlib.md5(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:13], 16) / 2.0**52


def test_counts_are_inverted_poisson(spark):
    rows = [(i, f"t{i}", "big") for i in range(400)] + [(1000 + i, "x", None) for i in range(40)] + [(2000 + i, "y", "small") for i in range(10)]
    rows += [(None, "no id", "small"), (2000, "y", "small"), (3000, None, "gone")]
    targets = spark.createDataFrame([("big", 1.0), (None, 1.0), ("small", 2.0), ("gone", 0.0), ("nowhere", 5.0)], "source string, weight double")
    df = clashing(documents(spark, rows))
    out = M.mix(df, Scratch(spark, "t"), targets, total=300.0, seed="s")
    assert out.columns == [*df.columns, "copy", "shuffle_key"]
    got = {}
    for r in out.collect():
        got.setdefault((r.doc_id, r.source), []).append(r.copy)
    rates = {"big": 75.0 / 400, None: 75.0 / 40, "small": 150.0 / 12}
    want = {}
    for i, _, s in rows:
        if s in rates and (n := brute_count(rates[s], uniform("s", i))):
            want.setdefault((i, s), []).extend(range(1, n + 1))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}


def test_default_targets_hold_the_size(spark):
    rows = [(i, "t", "a" if i % 10 else "b") for i in range(3000)]
    out = M.mix(documents(spark, rows), Scratch(spark, "t"), copy_col=None, key_col=None)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    n = {r["source"]: r["count"] for r in out.groupBy("source").count().collect()}
    assert abs(n["a"] - 3000 * 0.75) < 150 and abs(n["b"] - 3000 * 0.25) < 150  # weights 3 : 1


def test_large_rates_and_nothing(spark):
    out = M.mix(documents(spark, [(7, "t", "a")]), Scratch(spark, "t"), total=2000.0)
    assert abs(out.count() - brute_count_large(2000.0, uniform(M.SEED, 7))) <= 1
    assert M.mix(documents(spark, []), Scratch(spark, "t")).collect() == []


def test_columns_named_like_the_added_ones_stay(spark):
    df = documents(spark, [(i, f"t{i}", "a") for i in range(20)]).withColumnRenamed("lang", "Copy").withColumnRenamed("n_chars", "shuffle_key")
    out = M.mix(df, Scratch(spark, "t"))
    assert out.columns == [*df.columns, "copy_", "shuffle_key_"]
    assert out.filter("Copy = 'en' and copy_ >= 1").count() == out.count() > 0
    assert M._new_name("a", ["A", "a_"]) == "a__" and M._new_name(None, ["a"]) is None


def brute_count_large(rate, u):
    total, k = 0.0, 0
    while True:
        total += math.exp(k * math.log(rate) - rate - math.lgamma(k + 1))
        if total > u:
            return k
        k += 1
