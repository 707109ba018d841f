"""Steps that read or shuffle their rows once, so that the bytes moved stay in
proportion to the input at any size."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from demandcast.functions.ranks import whole_quantiles
from demandcast.operators import forecast
from demandcast.operators.features import build_features, weekly_rollup
from demandcast.operators.forecast import naive_quantile_forecast, rolling_pairs
from demandcast.operators.lookup import missing_with_suggestions
from demandcast.operators.regression import training_examples
from demandcast.plans import inputs as I
from demandcast.schemas import REQUEST_SCHEMA, SERIES_KEYS

D = dt.datetime
WEEKLY = "sku string, region string, week timestamp_ntz, units_sold bigint, rolling_4w_mean double"


@pytest.fixture()
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def lines(df, mark, run=False):
    """Lines of the plan that hold ``mark``; the final plan if it has run."""
    if run:
        df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    return [x for x in plan.splitlines() if mark in x]


def test_the_rollup_shuffles_once_into_the_tasks_asked_for(credit):
    linked = credit.withColumnRenamed("customer_id", "customer")
    plan = lines(weekly_rollup(linked, tasks=37), "- Exchange ")
    assert len(plan) == 1 and "week" in plan[0] and ", 37)" in plan[0]
    assert len(lines(build_features(linked, tasks=3, cluster=SERIES_KEYS), "- Exchange ")) == 1


def test_clusters_of_the_rollup_agree(credit):
    rows = [sorted(map(repr, build_features(credit, tasks=t, cluster=c).collect())) for t, c in ((None, I.WEEK_KEYS), (3, I.WEEK_KEYS), (5, SERIES_KEYS))]
    assert rows[0] == rows[1] == rows[2] and rows[0]


def test_a_hot_series_is_parted_by_weeks(spark, monkeypatch):
    linked = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("sku"), F.lit("A").alias("region"))
    assert I.rollup_cluster(linked) == SERIES_KEYS  # less than a few tasks' worth
    monkeypatch.setattr(I, "ROWS_A_TASK", 100)
    assert I.rollup_cluster(linked) == I.WEEK_KEYS
    assert I.rollup_cluster(linked.filter("sku <> 'hot'")) == SERIES_KEYS


def test_examples_are_made_in_the_series_partitioning(spark, no_broadcast):
    start = dt.date(2024, 1, 1)
    days = [0, 7, 14, 21, 35, 38, 42, 84, 84, 98]  # gaps, a day off the week, a week that repeats
    rows = [(s, r, D.combine(start + dt.timedelta(days=x), dt.time()), 10 * i + j, 0.0)
            for j, (s, r) in enumerate([("a", "A"), ("a", "B"), (None, "A"), ("b", None)]) for i, x in enumerate(days)]
    df = spark.createDataFrame(rows, WEEKLY)
    got = training_examples(df, horizon=4)
    assert not lines(got, "Join") and len(lines(got, "- Exchange ")) == 1
    known = [x for x in rows if x[0] and x[1]]
    want = sorted((s, r, w.date(), int((v - w).days / 7), float(y)) for s, r, w, *_ in known for s2, r2, v, y, _ in known
                  if (s, r) == (s2, r2) and (v - w).days in (7, 14, 21, 28))
    assert sorted((x["sku"], x["region"], x["origin"], int(x["step"]), x["label"]) for x in got.collect()) == want
    assert all(x["target_date"] == x["origin"] + dt.timedelta(weeks=int(x["step"])) for x in got.collect())


def test_readers_of_the_changes_share_the_exchange(spark, no_broadcast, tmp_dir):
    rows = [(f"s{i % 5}", f"r{i % 3}", D(2024, 1, 1) + dt.timedelta(weeks=i // 15), i * i % 17, 0.0) for i in range(120)] + [(None, "r", D(2024, 1, 1), 3, 0.0), (None, "r", D(2024, 1, 8), 5, 0.0), (None, "q", D(2024, 1, 8), 5, 0.0)]
    spark.createDataFrame(rows, WEEKLY).write.parquet(f"{tmp_dir}/weekly")
    out = naive_quantile_forecast(spark.read.parquet(f"{tmp_dir}/weekly"), horizon=1)
    got = {(x["sku"], x["region"]): x for x in out.collect()}
    # series without a SKU have no pool: own changes (+2), or none
    assert got[(None, "r")]["q0.5"] == 7.0 and got[(None, "q")]["q0.9"] == 5.0
    assert len(lines(out, "FileScan")) == 1


def test_suggestions_read_the_forecasts_once(spark, no_broadcast, tmp_dir):
    day = dt.date(2024, 3, 4)
    rows = [(s, r, day + dt.timedelta(weeks=i), 1.0, 2.0, 3.0) for s, r in (("oat", "north"), ("oat", "east"), ("rye", None), (None, "north")) for i in range(3)]
    spark.createDataFrame(rows, "sku string, region string, date date, `q0.1` double, `q0.5` double, `q0.9` double").write.parquet(f"{tmp_dir}/f")
    requests = spark.createDataFrame([("a", "oat", "north", 1), ("b", "oat", "west", 1), ("c", "oat", None, 1), ("d", "rye", None, 1), ("e", None, "north", 1), ("f", "x", "north", 1)], REQUEST_SCHEMA)
    out = missing_with_suggestions(spark.read.parquet(f"{tmp_dir}/f"), requests)
    assert out.columns == ["sku", "region", "request_id", "horizon_weeks", "valid_regions"]
    assert {x["request_id"]: x["valid_regions"] for x in out.collect()} == {"b": "east,north", "c": "east,north", "d": "", "e": None, "f": None}
    assert len(lines(out, "FileScan")) == 1 and not lines(out, "collect_set")


def odd_weeks():
    """Weekly rows of long and thin series, some ended early, some keys unknown."""
    ends = {("a", "n"): 40, ("a", "s"): 5, ("b", "n"): 33, ("b", None): 4, (None, "n"): 38, ("c", "s"): 1, ("d", "n"): 12}
    rows = [(s, r, D(2024, 1, 1) + dt.timedelta(weeks=i), (i * 7 + len(s or "") * 3) % 11, 0.0) for (s, r), n in ends.items() for i in range(n)]
    return rows + [("a", "s", D(2024, 1, 1) + dt.timedelta(weeks=i), i % 5, 0.0) for i in range(28, 40, 3)]


def as_rows(df):
    return sorted(map(repr, df.collect()))


def test_histories_are_copied_behind_the_exchange_all_readers_share(spark, no_broadcast, tmp_dir):
    spark.createDataFrame(odd_weeks(), WEEKLY).write.parquet(f"{tmp_dir}/weekly")
    weekly = spark.read.parquet(f"{tmp_dir}/weekly")
    out = rolling_pairs(weekly, n_cutoffs=3, holdout_weeks=6, tasks=3)
    got = as_rows(out)
    dealt = [x for x in lines(out, "Exchange hashpartitioning(") if "Reused" not in x]
    assert len([x for x in dealt if "REPARTITION_BY_NUM" in x]) == 1
    assert not [x for x in dealt if "hashpartitioning(cutoff" in x and "sku" in x and "region" in x]
    # a cutoff at a time, every history on its own
    want, last = [], dt.date(2024, 1, 1) + dt.timedelta(weeks=39)
    for k in (1, 2, 3):
        cutoff = last - dt.timedelta(weeks=6 * k)
        ahead = naive_quantile_forecast(weekly.filter(F.to_date("week") <= F.lit(cutoff)), horizon=6).filter(F.col("date") > F.lit(cutoff))
        actual = weekly.select("sku", "region", F.to_date("week").alias("date"), F.col("units_sold").cast("double").alias("actual"))
        columns = ["sku", "region", "date", F.lit(cutoff).alias("cutoff"), "`q0.1`", "`q0.5`", "`q0.9`", "actual"]
        want += as_rows(ahead.join(actual, ["sku", "region", "date"]).select(*columns))
    assert got == sorted(want) and len(got) > 20


def test_skus_of_any_size_have_the_same_pool(spark, monkeypatch):
    weekly = spark.createDataFrame(odd_weeks(), WEEKLY)
    found = []
    for most in (0, 20, 100_000):
        monkeypatch.setattr(forecast, "POOL_ROWS", most)
        found.append(as_rows(naive_quantile_forecast(weekly, horizon=2)))
    assert found[0] == found[1] == found[2] and found[0]


def test_values_of_a_whole_group_may_repeat(spark):
    values = [3.0, 3.0, -1.0, 7.5, 3.0, 0.0, 7.5, 2.0, 2.0, 2.0]
    counts = spark.createDataFrame([("g", v, n) for v, n in zip(values, [1, 2, 1, 3, 1, 1, 1, 2, 1, 1])] + [(None, 4.0, 2)], "g string, v double, n long")
    plain = [v for v, n in zip(values, [1, 2, 1, 3, 1, 1, 1, 2, 1, 1]) for _ in range(n)]
    got = {r.g: r for r in whole_quantiles(counts, ["g"], "v", "n", [0.1, 0.5, 0.77], ["x", "y", "z"]).collect()}
    assert [got["g"][c] for c in "xyz"] == pytest.approx(list(np.quantile(plain, [0.1, 0.5, 0.77]))) and got[None]["y"] == 4.0
