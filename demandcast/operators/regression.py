"""Regression quantile forecaster (the "lgb" producer slot), on pyspark.ml.

One gradient-boosted tree model is shared by all series (the weekly table
is the training set, so training is distributed like any Spark ML fit):

* an example pairs an origin week o of a series with a target week
  o + 7h (h = 1..horizon) that was observed; its features only use the
  series up to o (the units of o and the 3 previous observed weeks, their
  mean), the step h, and the calendar of the target week, so nothing
  leaks from the future;
* the model is fitted on examples whose target is before the calibration
  cut, and the quantiles are split-conformal: prediction + the empirical
  p-quantile of the calibration residuals of the same step h
  (exact, by rank over counted residuals); a step without residuals takes
  those of the nearest step that has some;
* forecasts start at each series' last observed week.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandcast.functions.calendar import iso_week, month_of
from demandcast.functions.quantiles import clip_lower
from demandcast.operators.features import dealt_by_series, left_by_series, series_window
from demandcast.schemas import DEFAULT_HORIZON_WEEKS, QUANTILES, SERIES_KEYS, qname

WEEKLY = [*SERIES_KEYS, "week", "units_sold"]  # what is read of the weekly table
# Examples a task of the fit passes over, and tasks a core at least.
EXAMPLES_A_TASK, FIT_TASKS_A_CORE = 250_000, 4
FEATURES = ["u0", "u1", "u2", "u3", "mean4", "step", "target_woy", "target_month"]


class InsufficientHistoryError(ValueError):
    """No training example lies before the calibration cut."""


@dataclass
class RegressionForecast:
    """The lazy forecast, its model and offsets. :meth:`release` frees the
    tables the forecast keeps, once it has been read."""

    forecast: DataFrame
    model: PipelineModel
    residual_quantiles: DataFrame
    held: list[DataFrame] = field(default_factory=list)

    def release(self) -> None:
        while self.held:
            self.held.pop().unpersist()


def _origins(features: DataFrame, tasks: int | None, *more, ending=None) -> DataFrame:
    """Per observed week: the units of it and of the 3 observed weeks before,
    and ``more`` columns over the series. The weekly rows are dealt by series
    before any column is derived from them. ``ending`` is a condition on the day
    of a series' last week, ``_end``."""
    w = series_window()
    u = F.col("units_sold").cast("double")
    rows = dealt_by_series(features, *WEEKLY, tasks=tasks)
    if ending is not None:
        end = F.to_date(F.max("week").over(Window.partitionBy(*SERIES_KEYS)))
        rows = rows.withColumn("_end", end).filter(ending).drop("_end")
    return rows.select(
        *SERIES_KEYS,
        F.to_date("week").alias("origin"),
        u.alias("u0"),
        F.coalesce(F.lag(u, 1).over(w), u).alias("u1"),
        F.coalesce(F.lag(u, 2).over(w), F.lag(u, 1).over(w), u).alias("u2"),
        F.coalesce(F.lag(u, 3).over(w), F.lag(u, 2).over(w), F.lag(u, 1).over(w), u).alias("u3"),
        F.avg(u).over(w.rowsBetween(-3, Window.currentRow)).alias("mean4"),
        *more,
    )


def _target(step):
    """Columns of a step's target week."""
    target = F.date_add(F.col("origin"), step * 7)
    return {"target_date": target, "target_woy": iso_week(target).cast("double"), "target_month": month_of(target).cast("double"), "step": step.cast("double")}


def _with_steps(origins: DataFrame, horizon: int) -> DataFrame:
    stepped = origins.select("*", F.explode(F.sequence(F.lit(1), F.lit(int(horizon)))).alias("step"))
    return stepped.withColumns(_target(F.col("step")))


def training_examples(features: DataFrame, horizon: int = DEFAULT_HORIZON_WEEKS, tasks: int | None = None) -> DataFrame:
    """Origins x steps with the features and the observed label.

    The weeks observed in the days o + 7 .. o + 7 * horizon are gathered by a
    window over the series, in the partitioning its lags have already; those
    whole weeks ahead are the steps with a label. So only examples are made,
    not origins x steps to be joined with the weeks that were observed."""
    day = F.unix_date(F.to_date("week"))
    near = Window.partitionBy(*SERIES_KEYS).orderBy(day).rangeBetween(7, 7 * int(horizon))
    ahead = F.collect_list(F.struct(day.alias("day"), F.col("units_sold").cast("double").alias("label"))).over(near).alias("_ahead")
    origins = _origins(features.dropna(subset=SERIES_KEYS), tasks, ahead)
    days = F.col("_a.day") - F.unix_date("origin")
    pairs = origins.withColumn("_a", F.explode("_ahead")).filter(days % 7 == 0)
    made = pairs.withColumns({"label": F.col("_a.label"), "step": (days / 7).cast("int")}).drop("_a", "_ahead")
    return made.withColumns(_target(F.col("step"))).select(
        *SERIES_KEYS, "target_date", "origin", "u0", "u1", "u2", "u3", "mean4", "step", "target_woy", "target_month", "label")


def placed_residuals(residuals: DataFrame) -> DataFrame:
    """(step, r, n, part): residuals counted and placed in order over range
    partitions, kept so that all readers see the same parts."""
    counted = residuals.groupBy("step", "r").agg(F.count(F.lit(1)).alias("n"))
    placed = counted.repartitionByRange("step", "r").sortWithinPartitions("step", "r").withColumn("part", F.spark_partition_id())
    return placed.persist(StorageLevel.MEMORY_AND_DISK)


def offsets_of(placed: DataFrame, quantiles: Sequence[float] = QUANTILES) -> DataFrame:
    """(step, _off0, _off1, ...): the smallest residual ``r`` of a step whose
    rank reaches the share q of the step's residuals.

    Exact with bounded state: equal residuals are counted first (partial sums
    per task); the running count of a step is then taken over the range
    partitions of (step, residual) by a total per partition, so a step's
    residuals never meet in one task.
    """
    parts = placed.groupBy("step", "part").agg(F.sum("n").alias("m"))  # a row per partition and step
    order = Window.partitionBy("step").orderBy("part")
    ahead = parts.select("step", "part", (F.sum("m").over(order) - F.col("m")).alias("ahead"), F.sum("m").over(Window.partitionBy("step")).alias("total"))
    within = Window.partitionBy("step", "part").orderBy("r")
    ranked = placed.join(F.broadcast(ahead), ["step", "part"]).select("step", "r", "total", (F.col("ahead") + F.sum("n").over(within)).alias("rank"))
    reached = [F.min(F.when(F.col("rank") >= F.lit(float(q)) * F.col("total"), F.col("r"))).alias(f"_off{i}") for i, q in enumerate(quantiles)]
    return ranked.groupBy("step").agg(*reached)


def conformal_offsets(residuals: DataFrame, quantiles: Sequence[float] = QUANTILES) -> DataFrame:
    """:func:`offsets_of` residuals (step, r)."""
    return offsets_of(placed_residuals(residuals), quantiles)


def nearest_offsets(offsets: DataFrame, horizon: int, n: int) -> DataFrame:
    """Offsets of every step 1..horizon: those of the nearest step that has
    some, the smaller one of two (a few rows)."""
    steps = offsets.sparkSession.range(1, horizon + 1).select(F.col("id").cast("double").alias("step"))
    known = offsets.select(F.col("step").alias("_from"), *[F.col(f"_off{i}") for i in range(n)])
    closest = F.min(F.struct(F.abs(F.col("step") - F.col("_from")).alias("d"), "_from", *[f"_off{i}" for i in range(n)])).alias("o")
    pairs = steps.join(F.broadcast(known), F.abs(F.col("step") - F.col("_from")) <= horizon)
    return pairs.groupBy("step").agg(closest).select("step", *[F.col(f"o._off{i}").alias(f"_off{i}") for i in range(n)])


def fit_tasks(train: DataFrame, n: int) -> int:
    """Tasks of a fit on ``n`` examples: enough for every core, and no more than
    the examples need."""
    return max(FIT_TASKS_A_CORE * train.sparkSession.sparkContext.defaultParallelism, -(-n // EXAMPLES_A_TASK))


def regression_quantile_forecast(
    features: DataFrame,
    horizon: int = DEFAULT_HORIZON_WEEKS,
    quantiles: Sequence[float] = QUANTILES,
    suffix: str = "_lgb",
    calibration_weeks: int = 26,
    max_iter: int = 20,
    max_depth: int = 5,
    seed: int = 7,
    decimals: int | None = 6,
    tasks: int | None = None,
    stored: bool = False,
    by_series: bool = False,
    after: Column | None = None,
) -> RegressionForecast:
    """Fit on ``features`` and forecast ``horizon`` weeks per series.

    ``features`` are kept for their four readers unless they are ``stored``
    already, as a table that can be read again. ``tasks`` is the number of tasks
    to deal them to (for a caller that knows the rows). ``by_series`` and
    ``after`` (a scalar) are as in ``naive_quantile_forecast``.

    Output columns: sku, region, date, one ``q<p><suffix>`` per quantile
    (clamped at 0, rounded to ``decimals``). The fit is eager (Spark ML
    jobs); the returned forecast is a lazy DataFrame.
    """
    if horizon < 1:
        raise ValueError("horizon must be >= 1")
    # read by the training set, the calibration set, the last day and the forecast
    kept = [] if stored else [features.persist(StorageLevel.MEMORY_AND_DISK)]
    # split candidates are drawn by partition: as many as any shuffle of the session has
    parts = max(tasks or 0, int(features.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    # boosting and calibration know no series
    examples = training_examples(features, horizon, parts).select("target_date", *FEATURES, "label")

    last_day = features.select(F.max(F.to_date("week"))).scalar()
    cut = F.date_sub(last_day, 7 * calibration_weeks)
    # boosting passes over the examples many times, calibration reads them once
    # more: keep them (spillable) instead of recomputing the feature chain
    examples = examples.persist(StorageLevel.MEMORY_AND_DISK)
    train = examples.filter(F.col("target_date") <= cut)
    calibration = examples.filter(F.col("target_date") > cut)

    pipeline = Pipeline(stages=[
        VectorAssembler(inputCols=FEATURES, outputCol="x"),
        GBTRegressor(featuresCol="x", labelCol="label", predictionCol="pred",
                     maxIter=max_iter, maxDepth=max_depth, seed=seed),
    ])
    n = train.count()
    if not n:
        RegressionForecast(train, None, train, [*kept, examples]).release()
        raise InsufficientHistoryError(
            f"no training example before the last {calibration_weeks} weeks; history too short"
        )
    try:
        # a boosting step makes two jobs a level: its tasks follow the examples
        # and not the tasks that made them
        model = pipeline.fit(train.coalesce(fit_tasks(train, n)))
    except Exception:
        examples.unpersist()
        raise

    residuals = model.transform(calibration).select("step", (F.col("label") - F.col("pred")).alias("r"))
    placed = placed_residuals(residuals)
    offsets = offsets_of(placed, quantiles).persist(StorageLevel.MEMORY_AND_DISK)
    empty = offsets.isEmpty()
    examples.unpersist()  # the residuals are placed now
    if empty:
        RegressionForecast(residuals, model, offsets, [*kept, placed, offsets]).release()
        raise InsufficientHistoryError(f"no example within the last {calibration_weeks} weeks to calibrate on")

    later = F.lead(F.lit(1)).over(series_window())
    ending = None if after is None else F.date_add("_end", 7 * int(horizon)) > after
    last = _origins(features, tasks, later.alias("_later"), ending=ending).filter(F.col("_later").isNull()).drop("_later")
    if by_series:
        last = left_by_series(last, tasks)
    # one row per step (bounded by the horizon): broadcast is safe
    by_step = nearest_offsets(offsets, horizon, len(quantiles))
    stepped = _with_steps(last, horizon)
    if after is not None:
        stepped = stepped.filter(F.col("target_date") > after)
    scored = model.transform(stepped).join(F.broadcast(by_step), on="step", how="left")
    out = []
    for i, q in enumerate(quantiles):
        value = F.col("pred") + F.col(f"_off{i}")
        if decimals is not None:
            value = F.round(value, decimals)
        out.append(clip_lower(value).alias(qname(q, suffix)))
    forecast = scored.select(*SERIES_KEYS, F.col("target_date").alias("date"), *out)
    return RegressionForecast(forecast, model, offsets, [*kept, placed, offsets])
