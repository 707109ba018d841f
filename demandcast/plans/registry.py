"""Registered queries: one per operator, each ``(spark, sf_dir) -> DataFrame``.

Forecast quantiles are published rounded to 6 decimals by the producer;
scores and means are summed in fixed point (order independent). Raking
weights are reported rounded to 6 decimals.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandcast.functions.calendar import iso_week, month_of, week_start
from demandcast.functions.hashing import hmac_sha256_hex
from demandcast.operators import reports
from demandcast.operators.checks import totals_report
from demandcast.operators.ensemble import clip_nonnegative, ensemble, normalize_quantile_columns
from demandcast.operators.features import add_lag, add_rolling_mean, build_features, weekly_rollup
from demandcast.operators.forecast import backtest_pairs, cutoff_before, naive_quantile_forecast, rolling_pairs
from demandcast.operators.linking import canonical_region
from demandcast.operators.lookup import (
    feature_slice,
    forecast_slice,
    forecast_table,
    lookup_forecasts,
    missing_forecasts,
    missing_with_suggestions,
    unknown_skus,
    valid_skus,
)
from demandcast.operators.metrics import pinball_loss, score_by_cutoff, score_by_series, wape
from demandcast.operators.regression import conformal_offsets, regression_quantile_forecast, training_examples
from demandcast.operators.weighting import rake, rake_totals
from demandcast.plans import inputs as I
from demandcast.plans.pipeline import forecast_from_features
from demandcast.sources.tpch import scan

Query = Callable[[SparkSession, str], DataFrame]
DEC = 6


def q_hash_customer_id(spark, d):
    return I.panel(spark, d).select("customer_id", hmac_sha256_hex("customer_id").alias("cust_hash"))


def q_link_panel_credit(spark, d):
    return I.linked(spark, d)


def q_canonical_region(spark, d):
    out = canonical_region(I.linked(spark, d).drop("region"))
    return out.select("panel_id", "txn_id", "sku", "region_panel", "region_credit", "region")


def q_calendar_features(spark, d):
    days = I.credit(spark, d).select("txn_date").distinct()
    week = week_start(F.col("txn_date"))
    return days.select("txn_date", week.alias("week"), iso_week(week).alias("weekofyear"), month_of(week).alias("month"))


def q_weekly_rollup(spark, d):
    return weekly_rollup(I.linked(spark, d), tasks=I.rollup_tasks(spark, d))


def q_lag_feature(spark, d):
    return add_lag(weekly_rollup(I.linked(spark, d), tasks=I.rollup_tasks(spark, d))).select("sku", "region", "week", "units_sold", "lag_1_units")


def q_rolling_mean_feature(spark, d):
    return add_rolling_mean(weekly_rollup(I.linked(spark, d), tasks=I.rollup_tasks(spark, d))).select(
        "sku", "region", "week", "units_sold", "rolling_4w_mean"
    )


def q_weekly_features(spark, d):
    return build_features(I.linked(spark, d), tasks=I.rollup_tasks(spark, d))


def q_totals_close(spark, d):
    return totals_report(I.linked(spark, d), I.credit(spark, d))


def q_credit_overview(spark, d):
    return reports.credit_overview(I.credit(spark, d))


def q_daily_volume(spark, d):
    return reports.daily_volume(I.credit(spark, d))


def q_panel_overview(spark, d):
    return reports.panel_overview(I.panel(spark, d))


def q_age_distribution(spark, d):
    return reports.distribution(I.panel(spark, d), "age_group")


def q_region_distribution(spark, d):
    return reports.distribution(I.panel(spark, d), "region")


def q_linkage_metrics(spark, d):
    return reports.linkage_metrics(I.linked(spark, d), I.credit(spark, d))


def q_linked_by_sku(spark, d):
    return reports.linked_by_sku(I.linked(spark, d))


def q_linked_sample(spark, d):
    return reports.linked_sample(I.linked(spark, d))


def q_credit_preview(spark, d):
    return reports.preview(I.credit(spark, d), 5, ["txn_id"])


def q_panel_preview(spark, d):
    return reports.preview(I.panel(spark, d), 5, ["panel_id"])


def q_feature_summary(spark, d):
    return reports.feature_summary(I.features(spark, d))


def q_feature_slice(spark, d):
    feats = I.features(spark, d)
    return feature_slice(feats, I.top_sku(feats))


def q_naive_forecast(spark, d):
    return naive_quantile_forecast(I.features(spark, d))


def q_clip_nonnegative(spark, d):
    return clip_nonnegative(naive_quantile_forecast(I.features(spark, d), clamp=False))


def q_normalize_quantiles(spark, d):
    return normalize_quantile_columns(I.lgb_slot(I.features(spark, d)))


def q_ensemble_both(spark, d):
    feats = I.features(spark, d)
    return ensemble(I.lgb_slot(feats), I.deepar_slot(feats))


def q_ensemble_lgb_only(spark, d):
    return ensemble(lgb=I.lgb_slot(I.features(spark, d)))


def q_ensemble_deepar_only(spark, d):
    return ensemble(deepar=I.deepar_slot(I.features(spark, d)))


def q_forecast_summary(spark, d):
    return reports.forecast_summary(I.ensembled(spark, d))


def q_series_index(spark, d):
    feats = I.features(spark, d)
    candidates = [I.ensembled(spark, d), I.lgb_slot(feats), I.deepar_slot(feats)]
    return reports.first_series_index(candidates)


def q_regions_by_sku(spark, d):
    return reports.regions_by_sku(reports.series_index(I.ensembled(spark, d)))


def q_forecast_slice(spark, d):
    feats = I.features(spark, d)
    sku = I.top_sku(feats)
    return forecast_slice(I.ensembled(spark, d), sku, I.top_region_of(feats, sku))


def q_forecast_table(spark, d):
    return forecast_table(q_forecast_slice(spark, d))


def q_forecast_lookup(spark, d):
    return lookup_forecasts(I.ensembled(spark, d), I.requests(spark, d))


def q_forecast_missing(spark, d):
    return missing_forecasts(I.ensembled(spark, d), I.requests(spark, d))


def q_unknown_skus(spark, d):
    """Requests for a SKU that no region is forecast for."""
    return unknown_skus(I.ensembled(spark, d), I.requests(spark, d))


def q_valid_skus(spark, d):
    return valid_skus(I.ensembled(spark, d))


def q_forecast_missing_suggestions(spark, d):
    return missing_with_suggestions(I.ensembled(spark, d), I.requests(spark, d))


def _pairs(spark, d):
    feats = I.features(spark, d)
    return backtest_pairs(feats, tasks=I.series_tasks(feats))


def q_wape(spark, d):
    return wape(_pairs(spark, d))


def q_wape_by_series(spark, d):
    return wape(_pairs(spark, d), by=["sku", "region"])


def q_pinball_loss(spark, d):
    return pinball_loss(_pairs(spark, d))


def q_backtest_naive(spark, d):
    return score_by_series(_pairs(spark, d))


def q_rolling_origin_naive(spark, d):
    """Four cutoffs scored in one plan, with the coverage of the interval."""
    feats = I.features(spark, d)
    return score_by_cutoff(rolling_pairs(feats, n_cutoffs=I.ROLLING_CUTOFFS, tasks=I.series_tasks(feats, I.ROLLING_CUTOFFS)))


def q_pipeline_naive(spark, d):
    """The pipeline's forecast where the regression slot is switched off."""
    feats = I.features(spark, d)
    return forecast_from_features(feats, use_regression=False, tasks=I.series_tasks(feats), stored=True)


def _raked(spark, d):
    return rake(
        I.panel(spark, d), I.marginals(spark, d), margins=I.RAKE_MARGINS,
        max_iter=I.RAKE_CHECK_ITERATIONS, tol=0.0,
    )


def q_rake_weights(spark, d):
    return _raked(spark, d).weighted.select("panel_id", F.round("weight", DEC).alias("weight"))


def q_rake_totals(spark, d):
    result = _raked(spark, d)
    out = rake_totals(result, None, I.RAKE_MARGINS)
    return out.withColumn("weighted_total", F.round("weighted_total", DEC))


def q_rake_inconsistent(spark, d):
    """Margins whose totals differ, with a null category and a zero target."""
    result = rake(I.panel_with_gaps(spark, d), I.inconsistent_marginals(spark, d), margins=I.GAP_MARGINS, max_iter=I.RAKE_CHECK_ITERATIONS, tol=0.0)
    return result.weighted.select("panel_id", F.round("weight", DEC).alias("weight"))


def q_rake_until_met(spark, d):
    """Stops by tolerance: the margins' targets do not differ in total."""
    result = rake(I.panel(spark, d), I.marginals(spark, d), margins=I.RAKE_MARGINS, max_iter=50, tol=I.RAKE_TOLERANCE)
    out = rake_totals(result, None, I.RAKE_MARGINS).withColumn("weighted_total", F.round("weighted_total", 3))
    return out.withColumns({"converged": F.lit(result.converged), "met": F.abs(F.col("weighted_total") - F.col("target")) < F.col("target") * I.RAKE_TOLERANCE * 10})


def q_regression_examples(spark, d):
    return training_examples(I.features(spark, d))


def q_conformal_offsets(spark, d):
    """Offsets around a fixed prediction, the mean of the last four weeks."""
    examples = training_examples(I.features(spark, d))
    return conformal_offsets(examples.select("step", (F.col("label") - F.col("mean4")).alias("r")))


def q_pipeline_status(spark, d):
    """Over stored tables: transactions, panel and their link are there, no
    features or forecasts are; a probe reads one row of a table."""
    stored = {"credit": "lineitem", "panel": "customer", "linked": "orders"}
    return reports.pipeline_status(spark, {k: scan(spark, d, t) for k, t in stored.items()})


def q_regression_forecast(spark, d):
    feats = I.features(spark, d)
    return regression_quantile_forecast(feats, tasks=I.series_tasks(feats), stored=True).forecast


def q_backtest_models(spark, d):
    """Both producers on the same holdout: pinball loss per quantile and
    model (the regression producer has no reference answer; this is how it
    is judged)."""
    feats = I.features(spark, d)
    tasks = I.series_tasks(feats)

    def regression(train, horizon):
        return regression_quantile_forecast(train, horizon=horizon, suffix="", tasks=tasks, stored=True, after=cutoff_before(feats, horizon)).forecast

    naive = pinball_loss(backtest_pairs(feats, tasks=tasks)).withColumn("model", F.lit("naive"))
    fitted = pinball_loss(backtest_pairs(feats, regression)).withColumn("model", F.lit("regression"))
    return naive.unionByName(fitted)


def q_pipeline_forecast(spark, d):
    feats = I.features(spark, d)
    return forecast_from_features(feats, tasks=I.series_tasks(feats), stored=True)


QUERIES: dict[str, Query] = {
    name[2:]: fn for name, fn in sorted(globals().items()) if name.startswith("q_") and callable(fn)
}
