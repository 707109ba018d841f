import datetime as dt
import math

import pytest

from demandcast.operators.forecast import backtest_pairs, naive_quantile_forecast

D = dt.datetime
SCHEMA = "sku string, region string, week timestamp_ntz, units_sold bigint, rolling_4w_mean double"


def weekly(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def long_series(sku, region, units, start=D(2024, 1, 1)):
    return [(sku, region, start + dt.timedelta(weeks=i), u, float(u)) for i, u in enumerate(units)]


def test_levels_dates_and_spread(spark):
    units = [10, 12, 9, 15, 11, 13, 10, 14, 12, 16]
    df = weekly(spark, long_series("S", "A", units))
    out = {r["date"]: r for r in naive_quantile_forecast(df, horizon=4).collect()}
    last = D(2024, 1, 1) + dt.timedelta(weeks=9)
    assert sorted(out) == [(last + dt.timedelta(weeks=k)).date() for k in range(1, 5)]
    changes = sorted(b - a for a, b in zip(units, units[1:]))
    median = changes[len(changes) // 2]
    first = out[(last + dt.timedelta(weeks=1)).date()]
    assert first["q0.5"] == pytest.approx(units[-1] + median)
    fourth = out[(last + dt.timedelta(weeks=4)).date()]
    assert fourth["q0.9"] - units[-1] == pytest.approx(2 * (first["q0.9"] - units[-1]), abs=1e-5)
    assert all(r["q0.1"] <= r["q0.5"] <= r["q0.9"] for r in out.values())


def test_thin_series_borrow_the_sku_spread(spark):
    rows = long_series("S", "A", [10, 20, 10, 20, 10, 20, 10, 20, 10, 20]) + long_series("S", "B", [5, 5])
    df = weekly(spark, rows)
    got = {(r["region"], r["date"]): r for r in naive_quantile_forecast(df, horizon=1).collect()}
    (b,) = [v for (reg, _), v in got.items() if reg == "B"]
    # pooled changes of S: nine of +-10 and one 0 -> q0.9 = +10
    assert b["q0.9"] == pytest.approx(15.0)
    alone = naive_quantile_forecast(weekly(spark, long_series("S", "B", [5, 5])), horizon=1).first()
    assert alone["q0.9"] == 5.0


def test_horizon_zero_and_negative(spark):
    df = weekly(spark, long_series("S", "A", [1, 2, 3]))
    assert naive_quantile_forecast(df, horizon=0).count() == 0
    with pytest.raises(ValueError):
        naive_quantile_forecast(df, horizon=-1)


def test_clamp_and_suffix(spark):
    df = weekly(spark, long_series("S", "A", [50, 1, 50, 1, 50, 1, 50, 1, 50, 1]))
    raw = naive_quantile_forecast(df, horizon=2, clamp=False, suffix="_x").collect()
    assert any(r["q0.1_x"] < 0 for r in raw)
    clamped = naive_quantile_forecast(df, horizon=2).collect()
    assert all(r["q0.1"] >= 0 for r in clamped)


def test_backtest_pairs_only_observed_weeks(spark):
    units = list(range(1, 31))
    rows = [r for i, r in enumerate(long_series("S", "A", units)) if i not in (25, 27)]
    pairs = backtest_pairs(weekly(spark, rows), holdout_weeks=6).collect()
    assert len(pairs) == 4
    assert all(not math.isnan(r["actual"]) for r in pairs)


def test_regression_producer_contract(spark):
    from demandcast.operators.regression import regression_quantile_forecast

    rows = []
    for s, base in (("S1", 20), ("S2", 40)):
        for r, bump in (("A", 0), ("B", 5)):
            units = [base + bump + (i % 4) * 3 - (i % 7) for i in range(60)]
            rows += long_series(s, r, units)
    res = regression_quantile_forecast(weekly(spark, rows), horizon=3, max_iter=5, max_depth=3,
                                       calibration_weeks=10)
    out = res.forecast.collect()
    assert res.forecast.columns == ["sku", "region", "date", "q0.1_lgb", "q0.5_lgb", "q0.9_lgb"]
    assert len(out) == 4 * 3
    last = (D(2024, 1, 1) + dt.timedelta(weeks=59)).date()
    assert {r["date"] for r in out} == {last + dt.timedelta(weeks=k) for k in (1, 2, 3)}
    assert all(0 <= r["q0.1_lgb"] <= r["q0.5_lgb"] <= r["q0.9_lgb"] for r in out)
    assert res.residual_quantiles.count() == 3
