"""Combine quantile forecasts from the two producer slots."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandcast.functions.quantiles import clip_lower, half_blend
from demandcast.operators.checks import check_required_columns
from demandcast.operators.features import series_key
from demandcast.schemas import FORECAST_KEYS, FORECAST_OUTPUT, QUANTILE_COLUMNS, qcol

SLOT_SUFFIXES = ("_lgb", "_deepar")


class NoForecastError(FileNotFoundError):
    """Neither producer slot has a forecast."""


def normalize_quantile_columns(df: DataFrame) -> DataFrame:
    """A slot's forecast under the canonical names ``q0.1, q0.5, q0.9``.

    A forecast that already has the first canonical column is left alone.
    Otherwise the columns are selected by a table from slot column to
    canonical name, filled from the second slot first so that the first slot
    wins; other columns, and the losing slot's, keep their names.
    """
    if QUANTILE_COLUMNS[0] in df.columns:
        return df
    source = {
        name: name + suffix
        for suffix in reversed(SLOT_SUFFIXES)
        for name in QUANTILE_COLUMNS
        if name + suffix in df.columns
    }
    canonical = {column: name for name, column in source.items()}
    return df.select(*[qcol(c).alias(canonical.get(c, c)) for c in df.columns])


def clip_nonnegative(df: DataFrame, columns=QUANTILE_COLUMNS) -> DataFrame:
    """Clamp the quantile columns at 0 (null / NaN kept)."""
    return df.withColumns({c: clip_lower(qcol(c)) for c in columns})


def passthrough_slot(df: DataFrame, suffix: str) -> DataFrame:
    """Single available slot: ``q*`` := ``q*<suffix>``, a missing one := 0.0
    (overwriting any canonical column of that name), clamped at 0."""
    check_required_columns(df, FORECAST_KEYS, "forecast" + suffix)
    quantiles = {
        c: qcol(c + suffix) if c + suffix in df.columns else F.lit(0.0)
        for c in QUANTILE_COLUMNS
    }
    return clip_nonnegative(df.withColumns(quantiles)).select(*[qcol(c) for c in FORECAST_OUTPUT])


def blend_slots(lgb: DataFrame, deepar: DataFrame, by_series: bool = False) -> DataFrame:
    """Both slots: full outer join on (sku, region, date), null keys matching
    null keys, then per quantile 0.5*coalesce(lgb, 0) + 0.5*coalesce(deepar, 0).

    A series present in one slot only is therefore halved, not passed
    through. Plan: one sort-merge full outer join, both sides hash
    partitioned on the three keys (forecasts are series x horizon rows).

    ``by_series`` is for slots whose producers left them dealt by series, with a
    row per step: they are joined by series as they lie, and the dates of a series
    are compared, so that no forecast is shuffled.
    """
    for df, suffix in ((lgb, "_lgb"), (deepar, "_deepar")):
        check_required_columns(df, FORECAST_KEYS, "forecast" + suffix)
        check_required_columns(df, [c + suffix for c in QUANTILE_COLUMNS], "forecast" + suffix)

    left = lgb.select(
        *[F.col(k).alias(f"_l_{k}") for k in FORECAST_KEYS], *[qcol(c + "_lgb") for c in QUANTILE_COLUMNS]
    )
    right = deepar.select(
        *[F.col(k).alias(f"_r_{k}") for k in FORECAST_KEYS], *[qcol(c + "_deepar") for c in QUANTILE_COLUMNS]
    )
    if by_series:
        day, other = F.col("_l_date"), F.col("_r_date")
        # not an equality, which would join the key that rows must be dealt by
        condition = (series_key("_l_") == series_key("_r_")) & F.coalesce((day >= other) & (day <= other), day.isNull() & other.isNull())
    else:
        condition = reduce(
            lambda a, b: a & b, [F.col(f"_l_{k}").eqNullSafe(F.col(f"_r_{k}")) for k in FORECAST_KEYS]
        )
    joined = left.join(right, condition, "full_outer")
    return joined.select(
        *[F.coalesce(F.col(f"_l_{k}"), F.col(f"_r_{k}")).alias(k) for k in FORECAST_KEYS],
        *[
            clip_lower(half_blend(qcol(c + "_lgb"), qcol(c + "_deepar"))).alias(c)
            for c in QUANTILE_COLUMNS
        ],
    )


def ensemble(lgb: DataFrame | None = None, deepar: DataFrame | None = None, by_series: bool = False) -> DataFrame:
    """Blend whichever slots are available into ``sku, region, date, q0.1,
    q0.5, q0.9`` (all >= 0). Availability is decided on the driver, at plan
    build time; the rest is one lazy plan. ``by_series`` is as in :func:`blend_slots`."""
    if lgb is None and deepar is None:
        raise NoForecastError("No forecast files: at least one slot is needed to combine")
    if lgb is not None and deepar is not None:
        return blend_slots(lgb, deepar, by_series)
    if lgb is not None:
        return passthrough_slot(lgb, "_lgb")
    return passthrough_slot(deepar, "_deepar")
