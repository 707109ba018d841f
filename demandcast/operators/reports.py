"""Summary tables behind the dashboard: overviews, distributions, linkage,
feature and forecast summaries, series index, previews, pipeline status.

Each report is one aggregation (partial aggregation per task, a small final
merge). Where a report needs a second global number (a total, a distinct
pair count) it enters as a scalar subquery: Spark runs it as its own small
job and inlines the value, so no join against a one-row frame is needed.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandcast.functions.calendar import as_timestamp_ntz
from demandcast.functions.numeric import fixed_sums, skip_nan
from demandcast.schemas import LINKED_SAMPLE_COLUMNS, SERIES_KEYS, qcol

# Pipeline steps and the artefacts each one needs.
PIPELINE_STEPS = [
    ("Data Ingestion", ("credit", "panel"), "all"),
    ("Data Linking", ("linked",), "all"),
    ("Feature Engineering", ("features",), "all"),
    ("Forecasting", ("forecast_ensemble", "forecast_deepar"), "any"),
]


def _count():
    return F.count(F.lit(1))


def credit_overview(credit: DataFrame) -> DataFrame:
    """Rows, first and last transaction date, distinct SKUs and customers."""
    return credit.agg(
        _count().alias("n_records"),
        F.min("txn_date").alias("first_txn_date"),
        F.max("txn_date").alias("last_txn_date"),
        F.countDistinct("sku").alias("n_skus"),
        F.countDistinct("customer_id").alias("n_customers"),
    )


def daily_volume(credit: DataFrame) -> DataFrame:
    """Units per transaction date."""
    ts = as_timestamp_ntz(F.col("txn_date"), credit.schema["txn_date"].dataType)
    return (
        credit.select(ts.alias("txn_date"), "quantity")
        .dropna(subset=["txn_date"])
        .groupBy("txn_date")
        .agg(F.coalesce(F.sum("quantity"), F.lit(0)).alias("quantity"))
    )


def panel_overview(panel: DataFrame) -> DataFrame:
    return panel.agg(_count().alias("n_members"), F.countDistinct("customer_id").alias("n_customers"))


def distribution(df: DataFrame, column: str) -> DataFrame:
    """Rows per category of ``column`` and their share of all categorised rows."""
    rows = df.select(column).dropna()
    total = rows.select(_count()).scalar()
    return rows.groupBy(column).agg(_count().alias("n")).withColumn(
        "share", F.try_divide(F.col("n").cast("double"), total)
    )


def linkage_metrics(linked: DataFrame, credit: DataFrame) -> DataFrame:
    """Linked rows, linked / credit rows in percent (may exceed 100 with
    duplicate panel members; null for an empty credit table), distinct
    linked customers."""
    credit_rows = credit.select(_count()).scalar()
    return linked.agg(
        _count().alias("linked_records"), F.countDistinct("cust_hash").alias("unique_customers")
    ).withColumn(
        "linkage_rate", F.try_divide(F.col("linked_records").cast("double"), credit_rows) * F.lit(100.0)
    )


def linked_by_sku(linked: DataFrame) -> DataFrame:
    return linked.select("sku").dropna().groupBy("sku").agg(_count().alias("linked_records"))


def linked_sample(linked: DataFrame, n: int = 10) -> DataFrame:
    """First ``n`` rows of the display columns that exist, in a total order
    (top-k per task, one small merge)."""
    cols = [c for c in LINKED_SAMPLE_COLUMNS if c in linked.columns]
    return linked.select(*cols).orderBy(*cols).limit(n)


def preview(df: DataFrame, n: int = 5, order_by: list[str] | None = None) -> DataFrame:
    """First ``n`` rows in a deterministic order (given keys, then all columns)."""
    keys = list(order_by or []) + [c for c in df.columns if c not in (order_by or [])]
    return df.orderBy(*[F.col(f"`{c}`") for c in keys]).limit(n)


def feature_summary(features: DataFrame) -> DataFrame:
    """Weekly rows, distinct (sku, region) pairs (null counts as a value),
    days between the first and last week."""
    n_series = features.select(*SERIES_KEYS).distinct().select(_count()).scalar()
    return features.agg(
        _count().alias("n_rows"),
        F.datediff(F.max("week"), F.min("week")).cast("bigint").alias("date_range_days"),
    ).withColumn("n_series", n_series)


def forecast_summary(forecast: DataFrame) -> DataFrame:
    """Horizon = rows floor-divided by series, series count, mean median
    (exact fixed-point sum)."""
    n_series = forecast.select(*SERIES_KEYS).distinct().select(_count()).scalar()
    return fixed_sums(forecast, [], {"median": skip_nan(qcol("q0.5"))}, [_count().alias("_rows")]).select(
        F.floor(F.try_divide(F.col("_rows"), n_series)).cast("bigint").alias("horizon_weeks"),
        n_series.alias("n_series"),
        F.try_divide("median_sum", F.col("median_n").cast("double")).alias("mean_q50"),
    )


def series_index(forecast: DataFrame) -> DataFrame | None:
    """Distinct (sku, region) of a forecast; None when a column is missing."""
    if not all(c in forecast.columns for c in SERIES_KEYS):
        return None
    return forecast.select(*SERIES_KEYS).distinct()


def first_series_index(candidates: list[DataFrame | None]) -> DataFrame | None:
    """Index of the first available forecast that has both key columns."""
    for df in candidates:
        if df is not None:
            index = series_index(df)
            if index is not None:
                return index
    return None


def regions_by_sku(index: DataFrame) -> DataFrame:
    """Sorted distinct regions per SKU, joined with ','."""
    return region_sets(index).select("sku", F.array_join("regions", ",").alias("regions"))


def region_sets(index: DataFrame) -> DataFrame:
    """(sku, regions): the sorted array of a SKU's distinct regions, which their
    number bounds.

    The pairs are made distinct first, by a hash aggregation; the lists are
    gathered from them. (A ``collect_set`` would make Spark drop the distinct
    and gather, and sort, the index's rows instead of its pairs.)"""
    pairs = index.dropna(subset=["sku"]).select(*SERIES_KEYS).distinct()
    return pairs.groupBy("sku").agg(F.sort_array(F.collect_list("region")).alias("regions"))


def pipeline_status(spark: SparkSession, artefacts: Mapping[str, DataFrame | None]) -> DataFrame:
    """``(step, ready)``: a step is ready when its artefacts are present (not
    None) and hold a row. Pass stored tables: a probe then reads one row,
    while a derived plan would be computed to answer it."""
    schema = T.StructType([T.StructField("step", T.StringType()), T.StructField("ready", T.BooleanType())])
    frames = []
    for step, names, mode in PIPELINE_STEPS:
        probes = []
        for name in names:
            df = artefacts.get(name)
            if df is not None:
                probes.append(df.limit(1).select(F.lit(1).alias("_one")))
        if not probes:
            frames.append(spark.createDataFrame([(step, False)], schema))
            continue
        present = probes[0]
        for other in probes[1:]:
            present = present.unionByName(other)
        need = len(names) if mode == "all" else 1
        frames.append(present.agg((F.count(F.lit(1)) >= need).alias("ready")).select(F.lit(step).alias("step"), "ready"))
    out = frames[0]
    for other in frames[1:]:
        out = out.unionByName(other)
    return out
