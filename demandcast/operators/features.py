"""SKU x region x week features: roll-up, lag, rolling mean, calendar."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandcast.functions.calendar import (
    as_timestamp_ntz,
    iso_week,
    month_of,
    require_not_null,
    week_start,
)
from demandcast.functions.numeric import fixed_sums, skip_nan
from demandcast.operators.checks import check_required_columns
from demandcast.schemas import FEATURE_COLUMNS, FEATURE_REQUIRED, SERIES_KEYS


def series_window():
    return Window.partitionBy(*SERIES_KEYS).orderBy("week")


def dealt_by_series(features: DataFrame, *columns: str, tasks: int | None = None) -> DataFrame:
    """``columns`` of a weekly table, dealt by series: windows and groups over a
    series follow without an exchange, and readers of the same columns in one
    plan share this one. ``tasks`` is as in :func:`weekly_rollup`."""
    rows = features.select(*columns)
    return rows.repartition(tasks, *SERIES_KEYS) if tasks else rows.repartition(*SERIES_KEYS)


def series_key(prefix: str = "") -> Column:
    """A series as one value: it is never null, and unknown parts are alike."""
    return F.struct(*[F.col(prefix + k).alias(k) for k in SERIES_KEYS])


def left_by_series(df: DataFrame, tasks: int | None) -> DataFrame:
    """Rows of series dealt by :func:`series_key`. What is made of them without
    another exchange can be joined by series as it lies."""
    return df.repartition(tasks, series_key()) if tasks else df.repartition(series_key())


def with_week(linked: DataFrame, date_format: str | None = None) -> DataFrame:
    """Append ``week`` (Monday 00:00, timestamp_ntz). A null transaction date
    fails the job; malformed text fails under ANSI parsing."""
    dtype = linked.schema["txn_date"].dataType
    ts = as_timestamp_ntz(F.col("txn_date"), dtype, date_format)
    return linked.withColumn("week", week_start(require_not_null(ts, "txn_date has null values")))


WEEK_KEYS = [*SERIES_KEYS, "week"]


def weekly_rollup(linked: DataFrame, date_format: str | None = None, tasks: int | None = None, cluster: Sequence[str] = WEEK_KEYS) -> DataFrame:
    """Aggregate transactions to (sku, region, week).

    units_sold = sum(quantity) (0 when all null), sales_dollars = sum(amount),
    n_transactions = distinct txn_id, avg_price = plain mean of price.
    NaN is skipped as null is; infinite and very large numbers count. Money
    is summed in fixed point where it fits, so the result does not depend on
    partitioning even for double inputs.
    Rows with a null sku or region are dropped (they form no series).

    Plan: one exchange of the narrowed rows on ``cluster``, by default the group
    key, so that a hot series is spread over its weeks; both steps of the
    distinct count run behind it. ``tasks`` is the number of tasks to deal to
    (for a caller that knows the rows), so that a task's memory does not grow
    with the input; without it AQE chooses by shuffled bytes. A caller that has
    found no hot series may cluster by series: the windows of
    :func:`features_of_weekly` then need no further exchange.
    """
    check_required_columns(linked, FEATURE_REQUIRED, "linked_panel_credit")
    rows = (
        with_week(linked, date_format)
        .select("sku", "region", "week", "quantity", "amount", "txn_id", "price")
        .dropna(subset=SERIES_KEYS)
    )
    rows = rows.repartition(tasks, *cluster) if tasks else rows.repartition(*cluster)
    quantity = F.col("quantity")
    if isinstance(linked.schema["quantity"].dataType, (T.DoubleType, T.FloatType)):
        quantity = skip_nan(quantity)
    money = {"amount": skip_nan(F.col("amount")), "price": skip_nan(F.col("price"))}
    counts = [F.coalesce(F.sum(quantity), F.lit(0)).alias("units_sold"), F.countDistinct("txn_id").alias("n_transactions")]
    summed = fixed_sums(rows, [*SERIES_KEYS, "week"], money, counts, keep=["quantity", "txn_id"])
    return summed.select(
        *SERIES_KEYS, "week", "units_sold", F.coalesce("amount_sum", F.lit(0.0)).alias("sales_dollars"),
        "n_transactions", F.try_divide("price_sum", F.col("price_n").cast("double")).alias("avg_price"))


def add_lag(weekly: DataFrame) -> DataFrame:
    """``lag_1_units``: units of the previous *observed* week of the series
    (gaps are not filled), as double."""
    return weekly.withColumn("lag_1_units", F.lag("units_sold", 1).over(series_window()).cast("double"))


def add_rolling_mean(weekly: DataFrame, rows: int = 4) -> DataFrame:
    """``rolling_4w_mean``: mean of the current and the previous ``rows-1``
    observed weeks (at least one row). It includes the current week."""
    frame = series_window().rowsBetween(-(rows - 1), Window.currentRow)
    return weekly.withColumn("rolling_4w_mean", F.avg("units_sold").over(frame).cast("double"))


def add_calendar(weekly: DataFrame) -> DataFrame:
    """ISO week number and month of the week's Monday."""
    return weekly.withColumns({"weekofyear": iso_week(F.col("week")), "month": month_of(F.col("week"))})


def build_features(linked: DataFrame, date_format: str | None = None, tasks: int | None = None, cluster: Sequence[str] = WEEK_KEYS) -> DataFrame:
    """Full feature table (flagship): roll-up -> lag -> rolling mean -> calendar.

    The two window columns share one window spec, so Spark evaluates them in
    a single Window operator over the (small) weekly table: rows per partition
    bounded by the number of weeks of a series, one exchange on (sku, region) of
    already aggregated rows unless the roll-up is clustered that way.
    """
    return features_of_weekly(weekly_rollup(linked, date_format, tasks, cluster))


def features_of_weekly(weekly: DataFrame) -> DataFrame:
    """The window and calendar columns over a weekly roll-up."""
    return add_calendar(add_rolling_mean(add_lag(weekly))).select(*FEATURE_COLUMNS)
