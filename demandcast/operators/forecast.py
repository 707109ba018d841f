"""Quantile forecast producers and backtesting.

The two producer slots of the pipeline ("lgb" and "deepar") only fix an
output contract: ``sku, region, date`` plus one column per quantile with the
slot suffix. The producers here are Spark jobs over the feature table:

* ``naive_quantile_forecast``: level = value of a feature at the series'
  last observed week (last units, or the 4-week mean); spread = exact
  empirical quantiles of the series' one-step changes (pooled over the SKU
  for a series with little history), widened by sqrt(k) for step k. Pure
  DataFrame; quantiles are read off ranks, no group is collected.
* ``regression_quantile_forecast`` (in ``demandcast.operators.regression``):
  one gradient-boosted model shared by all series.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandcast.functions.quantiles import clip_lower
from demandcast.functions.ranks import counted_quantiles, interpolated, join_null_safe, whole_quantiles
from demandcast.operators.features import dealt_by_series, left_by_series
from demandcast.schemas import DEFAULT_HORIZON_WEEKS, QUANTILES, SERIES_KEYS, qcol, qname

# A series needs this many observed one-step changes for its own spread.
MIN_SERIES_CHANGES = 8
# A SKU with more observed weeks than this has its pooled changes ranked in buckets.
POOL_ROWS = 100_000


def _steps(horizon: int):
    if horizon < 0:
        raise ValueError(f"horizon must be >= 0, got {horizon}")
    if horizon == 0:
        return F.array().cast("array<int>")
    return F.sequence(F.lit(1), F.lit(int(horizon)))


def naive_quantile_forecast(
    features: DataFrame,
    horizon: int = DEFAULT_HORIZON_WEEKS,
    quantiles: Sequence[float] = QUANTILES,
    level_col: str = "units_sold",
    suffix: str = "",
    clamp: bool = True,
    decimals: int | None = 6,
    min_changes: int = MIN_SERIES_CHANGES,
    pooled: bool = True,
    by: Sequence[str] = (),
    after: Column | str | None = None,
    tasks: int | None = None,
    by_series: bool = False,
) -> DataFrame:
    """Forecast ``horizon`` weeks after each series' last observed week.

    q_p(k) = level + Q_p(one-step change) * sqrt(k), k = 1..horizon, dated
    last week + 7k days (a date). A series with fewer than ``min_changes``
    observed changes borrows the quantiles of its SKU pooled over all
    regions, or is left out if ``pooled`` is False; with no change at all the
    spread is 0. Values are rounded to
    ``decimals`` and clamped at 0 unless ``clamp`` is False.

    Columns ``by`` name independent histories in one table, as the cutoffs of a
    rolling evaluation do; they lead the result's columns. Only forecasts dated
    after the date ``after`` (one of them, or a scalar) are asked for, if given.

    The weekly rows are dealt by series once (with ``by``, the caller has dealt
    them before making the histories); the changes are ranked within the series,
    whose rows are its observed weeks, and counted there. Counted changes are
    dealt once more, by SKU, for the pools. A SKU of more than ``POOL_ROWS``
    observed weeks is ranked in buckets instead (``demandcast.functions.ranks``),
    so a SKU sold in any number of regions never meets in one task. ``tasks`` is
    the number of tasks to deal the weekly rows to (for a caller that knows them).
    With ``by_series`` the series are dealt once more before their steps are made,
    for a blend by series (``demandcast.operators.ensemble``).
    """
    keys = [*by, *SERIES_KEYS]
    series = Window.partitionBy(*keys)
    # plain columns up to the window and no filter that reaches below it: the
    # readers of the changes then read one exchange of the table, not one each
    columns = dict.fromkeys([*keys, "week", "units_sold", level_col])
    rows = features.select(*columns) if by else dealt_by_series(features, *columns, tasks=tasks)
    lagged = rows.withColumn("_before", F.lag("units_sold", 1).over(series.orderBy("week")))
    changes = lagged.select(
        *keys,
        "week",
        F.col(level_col).cast("double").alias("_level"),
        (F.col("units_sold") - F.col("_before")).cast("double").alias("_change"),
    )
    after = F.col(after) if isinstance(after, str) else after
    asked = changes
    if after is not None:  # a series that ended too early has no such forecast, only a part in its SKU's pool
        asked = changes.withColumn("_end", F.max("week").over(series)).filter(F.date_add(F.to_date("_end"), 7 * int(horizon)) > after)
    by_size = series.orderBy(F.col("_change").asc_nulls_last())
    ranked = asked.select(*changes.columns, (F.row_number().over(by_size) - 1).alias("_rank"), F.count("_change").over(series).alias("_n"))
    own = [interpolated(F.col("_change"), F.col("_rank"), F.col("_rank"), F.col("_n"), q).alias(f"_own{i}") for i, q in enumerate(quantiles)]
    stats = ranked.groupBy(*keys).agg(
        F.max("week").alias("_last_week"), F.max_by("_level", "week").alias("_level"), F.count("_change").alias("_n_changes"), *own)
    thin = F.col("_n_changes") < F.lit(int(min_changes))
    if not pooled:
        stats = stats.filter(~thin)
    else:
        names = [f"_pool{i}" for i in range(len(quantiles))]
        stats = join_null_safe(stats, _pools(rows, changes, by, quantiles, names), [*by, "sku"], "left")
        thin = reduce(Column.__and__, [F.col(k).isNotNull() for k in [*by, "sku"]], thin)  # an unknown SKU has no pool
    spread = [F.when(thin, F.coalesce(F.col(f"_pool{i}"), F.col(f"_own{i}"))).otherwise(F.col(f"_own{i}")) if pooled else F.col(f"_own{i}")
              for i in range(len(quantiles))]
    stats = stats.select(*keys, "_last_week", "_level", *[x.alias(f"_spread{i}") for i, x in enumerate(spread)])
    if by_series:
        stats = left_by_series(stats, tasks)
    stepped = stats.select("*", F.explode(_steps(horizon)).alias("_k"))
    out = {}
    for i, q in enumerate(quantiles):
        value = F.col("_level") + F.coalesce(F.col(f"_spread{i}"), F.lit(0.0)) * F.sqrt(F.col("_k"))
        if decimals is not None:
            value = F.round(value, decimals)
        out[qname(q, suffix)] = clip_lower(value) if clamp else value
    forecast = stepped.select(
        *keys,
        F.date_add(F.to_date("_last_week"), F.col("_k") * 7).alias("date"),
        *[v.alias(k) for k, v in out.items()],
    )
    return forecast if after is None else forecast.filter(F.col("date") > after)


def _pools(rows: DataFrame, changes: DataFrame, by: Sequence[str], quantiles: Sequence[float], names: Sequence[str]) -> DataFrame:
    """Quantiles of the changes of every known SKU, over all its series."""
    pool = [*by, "sku"]
    known = reduce(Column.__and__, [F.col(k).isNotNull() for k in pool])
    # counted where they are, series by series
    counts = (changes.withColumn("_change", F.when(known, F.col("_change"))).dropna(subset=["_change"])
              .groupBy(*by, *SERIES_KEYS, "_change").agg(F.count(F.lit(1)).alias("_copies")))
    weeks = F.count(F.when(F.col("week").isNotNull(), F.col("units_sold")))  # the columns of the changes, so that their exchange is read
    large = F.broadcast(rows.groupBy("sku").agg(weeks.alias("_weeks")).select(F.when(F.col("_weeks") > POOL_ROWS, F.col("sku")).alias("sku")).dropna())
    # marked by an outer join: an anti-join would be moved below the exchange
    small = join_null_safe(counts, large.withColumn("_large", F.lit(True)), ["sku"], "left").filter(F.col("_large").isNull())
    whole = whole_quantiles(small.select(*pool, "_change", "_copies"), pool, "_change", "_copies", quantiles, names)
    spread = join_null_safe(counts, large, ["sku"], "left_semi").groupBy(*pool, "_change").agg(F.sum("_copies").alias("_copies"))
    return whole.unionByName(counted_quantiles(spread, pool, "_change", "_copies", quantiles, names))


def holdout_split(features: DataFrame, holdout_weeks: int) -> tuple[DataFrame, DataFrame]:
    """Split at the last ``holdout_weeks`` weeks of the whole table.

    The cutoff is a scalar subquery (one tiny job), not a driver collect.
    """
    cutoff = cutoff_before(features, holdout_weeks)
    day = F.to_date("week")
    return features.filter(day <= cutoff), features.filter(day > cutoff)


def cutoff_before(features: DataFrame, weeks: int) -> Column:
    """The day ``weeks`` before the table's last week."""
    return F.date_sub(features.select(F.max(F.to_date("week"))).scalar(), 7 * weeks)


def pair_with_actuals(forecast: DataFrame, actual_features: DataFrame) -> DataFrame:
    """Align forecasts with observed weeks: inner join on (sku, region, date
    = week). Weeks without sales have no actual and are not scored.

    The keys are compared as a struct, without nulls on the side of the actuals:
    plain keys would be filtered below the exchange of the forecast's weekly
    rows, which other readers of the same plan then could not share."""
    keys = [*SERIES_KEYS, "date"]
    actual = actual_features.select(
        *SERIES_KEYS, F.to_date("week").alias("date"), F.col("units_sold").cast("double").alias("actual")
    ).dropna(subset=keys).withColumnsRenamed({k: f"_a_{k}" for k in keys})
    same = F.struct(*keys) == F.struct(*[F.col(f"_a_{k}").alias(k) for k in keys])
    paired = forecast.join(actual, same, "inner")
    return paired.select(*keys, *[qcol(c) for c in forecast.columns if c not in keys], "actual")


def backtest_pairs(
    features: DataFrame,
    forecaster: Callable[..., DataFrame] | None = None,
    holdout_weeks: int = DEFAULT_HORIZON_WEEKS,
    tasks: int | None = None,
) -> DataFrame:
    """Forecast from the history before the holdout and pair with actuals; the
    forecaster is by default the naive one, with ``tasks``."""
    train, test = holdout_split(features, holdout_weeks)
    cutoff = cutoff_before(features, holdout_weeks)
    forecaster = forecaster or partial(naive_quantile_forecast, after=cutoff, tasks=tasks)
    return pair_with_actuals(forecaster(train, horizon=holdout_weeks).filter(F.col("date") > cutoff), test)


def rolling_histories(features: DataFrame, n_cutoffs: int, holdout_weeks: int = DEFAULT_HORIZON_WEEKS, tasks: int | None = None) -> DataFrame:
    """``features`` once per cutoff, with the rows up to it: the column
    ``cutoff`` is a key of the plan, and the table is read once. It is dealt by
    series first (to ``tasks`` tasks, if given), so that the copies are not
    shuffled.

    The cutoffs lie ``holdout_weeks`` apart, the last one that long before the
    end of the table."""
    if n_cutoffs < 1:
        raise ValueError("n_cutoffs must be >= 1")
    last = features.select(F.max(F.to_date("week"))).scalar()
    cutoff = F.date_sub("_last", F.col("_k") * 7 * holdout_weeks)
    copies = dealt_by_series(features, *features.columns, tasks=tasks).withColumn("_last", last).select("*", F.explode(F.sequence(F.lit(1), F.lit(int(n_cutoffs)))).alias("_k")).withColumn("cutoff", cutoff)
    return copies.filter(F.to_date("week") <= F.col("cutoff")).drop("_last", "_k")


def rolling_pairs(
    features: DataFrame,
    forecaster: Callable[..., DataFrame] = partial(naive_quantile_forecast, after="cutoff"),
    n_cutoffs: int = 4,
    holdout_weeks: int = DEFAULT_HORIZON_WEEKS,
    tasks: int | None = None,
) -> DataFrame:
    """Rolling-origin evaluation: forecasts from every cutoff's history, paired
    with the weeks of its holdout. ``forecaster`` keeps the histories of its
    ``by`` columns apart; nothing is fitted or derived in a loop over cutoffs."""
    forecast = forecaster(rolling_histories(features, n_cutoffs, holdout_weeks, tasks), horizon=holdout_weeks, by=["cutoff"])
    day = F.col("date")
    held_out = forecast.filter((day > F.col("cutoff")) & (day <= F.date_add("cutoff", 7 * holdout_weeks)))
    # no holdout begins before the first cutoff
    return pair_with_actuals(held_out, features.filter(F.to_date("week") > cutoff_before(features, holdout_weeks * n_cutoffs)))
