"""Slots that are blended as their producers left them, and a fit in few tasks."""

import datetime as dt
import random

import pytest
from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from demandcast.operators import regression
from demandcast.operators.ensemble import ensemble
from demandcast.operators.regression import regression_quantile_forecast
from demandcast.plans import pipeline
from demandcast.plans.pipeline import forecast_from_features

DAY = dt.date(2024, 1, 1)


def as_rows(df):
    return sorted(map(repr, df.collect()))


@pytest.fixture(scope="module")
def weekly(spark, tmp_path_factory):
    rng = random.Random(3)
    rows = [(s, r, dt.datetime.combine(DAY + dt.timedelta(weeks=i), dt.time()), rng.randrange(30), 0.0)
            for s, r, n in (("a", "n", 60), ("a", "s", 58), ("b", "n", 60), ("c", "s", 3), ("b", None, 20)) for i in range(60 - n, 60)]
    path = str(tmp_path_factory.mktemp("weekly") / "weekly")
    spark.createDataFrame(rows, "sku string, region string, week timestamp_ntz, units_sold bigint, rolling_4w_mean double").write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture()
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_blends_agree_on_odd_keys(spark, no_broadcast):
    days = [DAY, DAY + dt.timedelta(weeks=1), DAY + dt.timedelta(weeks=2), None]
    series = [("a", "n"), ("a", None), (None, "n"), (None, None), ("b", "s"), ("", "")]

    def slot(suffix, seed):
        rng = random.Random(seed)
        rows = [(*s, d, *(rng.choice([None, -1.5, 2.0, 8.25]) for _ in range(3))) for s in series for d in days if rng.random() < 0.7]
        rows += rows[:2]  # keys that repeat
        return spark.createDataFrame(rows, f"sku string, region string, date date, `q0.1{suffix}` double, `q0.5{suffix}` double, `q0.9{suffix}` double")

    for seed in range(3):
        lgb, deepar = slot("_lgb", seed), slot("_deepar", seed + 10)
        assert as_rows(ensemble(lgb, deepar, by_series=True)) == as_rows(ensemble(lgb, deepar))


def test_the_pipeline_shuffles_no_forecast(weekly, no_broadcast, monkeypatch):
    slots = []
    monkeypatch.setattr(pipeline, "ensemble", lambda *a, **b: (slots.extend(a), ensemble(*a, **b))[1])
    out = forecast_from_features(weekly, horizon=4, tasks=3, stored=True)
    got = as_rows(out)
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "FullOuter" in plan
    assert not [x for x in plan.splitlines() if "Exchange hashpartitioning(" in x and "_l_" in x]
    assert got == as_rows(ensemble(*slots))
    assert len(got) == 5 * 4


def test_stored_features_are_not_kept(weekly):
    features = weekly.withColumn("units_sold", F.col("units_sold") + 0)
    found = {}
    for stored in (True, False):
        fitted = regression_quantile_forecast(features, horizon=3, max_iter=2, stored=stored)
        assert features.storageLevel.useMemory is not stored
        found[stored] = as_rows(fitted.forecast.select("sku", "region", "date"))
        fitted.release()
        assert not features.storageLevel.useMemory
    assert found[True] == found[False] and found[True]


def test_the_fit_has_tasks_by_examples(weekly, monkeypatch):
    parts, fit = [], Pipeline.fit
    monkeypatch.setattr(Pipeline, "fit", lambda self, df: (parts.append((df.rdd.getNumPartitions(), df.count())), fit(self, df))[1])
    regression_quantile_forecast(weekly, horizon=3, max_iter=1, tasks=40, stored=True).release()
    monkeypatch.setattr(regression, "EXAMPLES_A_TASK", 25)
    regression_quantile_forecast(weekly, horizon=3, max_iter=1, tasks=40, stored=True).release()
    (few, n), (more, _) = parts
    assert few == 4 * weekly.sparkSession.sparkContext.defaultParallelism
    assert few < more == -(-n // 25)


def test_only_forecasts_asked_for_are_scored(weekly):
    """A holdout asks for the dates after its cutoff: series that ended too early
    for one take part in the fit alone."""
    early = weekly.filter((F.col("sku") != "a") | (F.col("region") != "s") | (F.to_date("week") < F.lit(DAY + dt.timedelta(weeks=40))))
    after = DAY + dt.timedelta(weeks=50)
    keys = {}
    for name, asked in (("all", None), ("some", F.lit(after))):
        fitted = regression_quantile_forecast(early, horizon=4, max_iter=1, stored=True, after=asked)
        keys[name] = {(r["sku"], r["region"], r["date"]) for r in fitted.forecast.collect()}
        fitted.release()
    assert keys["some"] == {k for k in keys["all"] if k[2] > after}
    assert ("a", "s") in {k[:2] for k in keys["all"]} and ("a", "s") not in {k[:2] for k in keys["some"]}
