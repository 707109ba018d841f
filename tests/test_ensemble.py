import datetime as dt

import pytest

from demandcast.operators.ensemble import (
    NoForecastError,
    clip_nonnegative,
    ensemble,
    normalize_quantile_columns,
)
from demandcast.schemas import FORECAST_OUTPUT

LGB = "sku string, region string, date date, `q0.1_lgb` double, `q0.5_lgb` double, `q0.9_lgb` double"
DEEPAR = "sku string, region string, date date, `q0.1_deepar` double, `q0.5_deepar` double, `q0.9_deepar` double"
d1, d2 = dt.date(2023, 8, 7), dt.date(2023, 8, 14)


def test_lgb_only_passes_through_clamped(spark):
    rows = [("spelt", "east", d2, -0.75, 0.0, 11.5), ("spelt", "east", d1, 3.25, 6.5, None)]
    out = ensemble(lgb=spark.createDataFrame(rows, LGB))
    assert out.columns == FORECAST_OUTPUT
    assert sorted(tuple(r)[2:] for r in out.collect()) == [(d1, 3.25, 6.5, None), (d2, 0.0, 0.0, 11.5)]


def test_no_slots():
    with pytest.raises(NoForecastError, match="No forecast files"):
        ensemble()


def test_single_slot_missing_quantile_is_zero_and_overwrites(spark):
    df = spark.createDataFrame(
        [("S1", "NE", d1, 1.0, -2.0, 7.0)],
        "sku string, region string, date date, `q0.1_deepar` double, `q0.5_deepar` double, `q0.9` double",
    )
    row = ensemble(deepar=df).first()
    assert (row["q0.1"], row["q0.5"], row["q0.9"]) == (1.0, 0.0, 0.0)


def test_blend_halves_one_sided_rows_and_matches_null_keys(spark):
    lgb = spark.createDataFrame(
        [("S1", "NE", d1, 2.0, 4.0, 6.0), ("S1", "NE", d2, 2.0, 4.0, 6.0), (None, "NE", d1, 1.0, 1.0, 1.0)], LGB
    )
    deepar = spark.createDataFrame(
        [("S1", "NE", d1, 4.0, None, -10.0), ("S2", "W", d1, 8.0, 8.0, 8.0), (None, "NE", d1, 3.0, 3.0, 3.0)], DEEPAR
    )
    rows = {(r["sku"], r["date"]): r for r in ensemble(lgb, deepar).collect()}
    assert len(rows) == 4
    both = rows[("S1", d1)]
    assert (both["q0.1"], both["q0.5"], both["q0.9"]) == (3.0, 2.0, 0.0)
    assert rows[("S1", d2)]["q0.5"] == 2.0
    assert rows[("S2", d1)]["q0.5"] == 4.0
    assert rows[(None, d1)]["q0.5"] == 2.0


def test_blend_requires_quantile_columns(spark):
    lgb = spark.createDataFrame([("S1", "NE", d1, 1.0)], "sku string, region string, date date, `q0.1_lgb` double")
    deepar = spark.createDataFrame([("S1", "NE", d1, 1.0, 1.0, 1.0)], DEEPAR)
    with pytest.raises(ValueError, match="missing required columns"):
        ensemble(lgb, deepar)


def test_clip_keeps_null_and_nan(spark):
    df = spark.createDataFrame(
        [(-1.0, None, float("nan"))], "`q0.1` double, `q0.5` double, `q0.9` double"
    )
    row = clip_nonnegative(df).first()
    assert row["q0.1"] == 0.0 and row["q0.5"] is None and row["q0.9"] != row["q0.9"]


def test_normalize_columns(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3.0)], "`q0.1_lgb` double, `q0.5_lgb` double, `q0.9_lgb` double")
    assert normalize_quantile_columns(df).first()["q0.1"] == 1.0
    mixed = spark.createDataFrame([(1.0, 2.0)], "`q0.1_deepar` double, `q0.5_lgb` double")
    assert normalize_quantile_columns(mixed).columns == ["q0.1", "q0.5"]
    canonical = spark.createDataFrame([(1.0, 9.0)], "`q0.1` double, `q0.5_lgb` double")
    assert normalize_quantile_columns(canonical).columns == ["q0.1", "q0.5_lgb"]
