"""Derived inputs shared by the registered queries (Spark side).

Everything is derived from the test tables, so each query's work grows with the
data. Operators up to the weekly table are lazy plans over the sources; what
comes after reads the stored weekly table, as the pipeline's stages do. ``demandcast.plans.oracle`` holds the
same derivations in SQL.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandcast.operators.ensemble import ensemble
from demandcast.operators.features import WEEK_KEYS, build_features
from demandcast.operators.forecast import naive_quantile_forecast
from demandcast.operators.linking import hot_customers, link_panel_credit
from demandcast.plans.stages import session_store
from demandcast.schemas import FORECAST_KEYS, SERIES_KEYS
from demandcast.session import broadcast_max_rows
from demandcast.sources.tpch import (
    credit_from_tpch,
    order_marginals_from_tpch,
    panel_from_tpch,
    requests_from_linked,
    ROWS_A_TASK,
    row_count,
    tasks_for,
)

# Producer settings of the two slots used by the checked queries. The first
# reaches further but leaves out series with little history, the second has
# every series, so the blend sees rows of either slot alone.
LGB_SLOT = {"horizon": 12, "level_col": "rolling_4w_mean", "suffix": "_lgb", "pooled": False}
DEEPAR_SLOT = {"horizon": 8, "level_col": "units_sold", "suffix": "_deepar"}
RAKE_MARGINS = ["region", "age_group"]
RAKE_CHECK_ITERATIONS = 10
RAKE_TOLERANCE = 1e-9
ROLLING_CUTOFFS = 4
GAP_MARGINS = ["region", "income_bin"]


def credit(spark: SparkSession, d: str) -> DataFrame:
    return credit_from_tpch(spark, d)


def panel(spark: SparkSession, d: str) -> DataFrame:
    return panel_from_tpch(spark, d)


def linked(spark: SparkSession, d: str) -> DataFrame:
    small_panel = row_count(spark, d, "customer") <= broadcast_max_rows(spark)
    return link_panel_credit(panel(spark, d), credit(spark, d), broadcast_panel=small_panel)


# Columns of the link that features and lookup requests read.
LINK_COLUMNS = ["panel_id", "region_panel", "household_size", "txn_id", "txn_date", "sku", "region", "amount", "price", "quantity"]
SOURCE_TABLES = ["lineitem", "orders", "part", "supplier", "customer", "nation", "region"]


def _stage(spark: SparkSession, d: str, name: str, parameters: dict, build: Callable[[], DataFrame]) -> DataFrame:
    """A table that several queries share: written once a session into the
    checkpoint folder, made anew if a source file or a parameter has changed."""
    store = session_store(spark, "shared-" + hashlib.sha256(d.encode()).hexdigest()[:12])
    return store.run(name, [f"{d}/{t}.parquet" for t in SOURCE_TABLES], parameters, build)


def stored_linked(spark: SparkSession, d: str) -> DataFrame:
    return _stage(spark, d, "linked", {"columns": LINK_COLUMNS}, lambda: linked(spark, d).select(*LINK_COLUMNS))


def features(spark: SparkSession, d: str) -> DataFrame:
    """The weekly table, stored: whatever forecasts, looks up or scores reads it
    and not the transactions."""
    def build():
        rows = stored_linked(spark, d)
        n = rows.count()  # from Parquet footers
        return build_features(rows, tasks=tasks_for(spark, n), cluster=rollup_cluster(rows))

    return _stage(spark, d, "features", {}, build)


def rollup_cluster(linked: DataFrame) -> list[str]:
    """What the roll-up deals its rows by: the series, unless one of them holds
    a hundredth of the rows and several tasks' worth; then its weeks part it."""
    series = linked.select(F.concat_ws("|", *SERIES_KEYS).alias("series"))
    return WEEK_KEYS if hot_customers(series, 0.01, "series", min_rows=4 * ROWS_A_TASK) else SERIES_KEYS


def rollup_tasks(spark: SparkSession, d: str) -> int:
    """Tasks of a roll-up over the link that is not stored."""
    return tasks_for(spark, row_count(spark, d, "lineitem"))


def series_tasks(feats: DataFrame, copies: int = 1) -> int:
    """Tasks for the stored weekly table, each row of it ``copies`` times."""
    return tasks_for(feats.sparkSession, feats.count() * copies)  # from Parquet footers


def lgb_slot(feats: DataFrame) -> DataFrame:
    return naive_quantile_forecast(feats, **LGB_SLOT)


def deepar_slot(feats: DataFrame) -> DataFrame:
    return naive_quantile_forecast(feats, **DEEPAR_SLOT)


def ensembled(spark: SparkSession, d: str) -> DataFrame:
    """The blended forecast, stored as the pipeline stores it."""
    def build():
        feats = features(spark, d)
        return ensemble(lgb_slot(feats), deepar_slot(feats)).sortWithinPartitions(*FORECAST_KEYS)

    return _stage(spark, d, "forecast_ensemble", {"lgb": LGB_SLOT, "deepar": DEEPAR_SLOT}, build)


def requests(spark: SparkSession, d: str) -> DataFrame:
    return requests_from_linked(stored_linked(spark, d))


def marginals(spark: SparkSession, d: str) -> DataFrame:
    return order_marginals_from_tpch(spark, d)


def panel_with_gaps(spark: SparkSession, d: str) -> DataFrame:
    """The panel with an unknown income where it is negative."""
    return panel(spark, d).withColumn("income_bin", F.when(F.col("income_bin") != "negative", F.col("income_bin")))


def inconsistent_marginals(spark: SparkSession, d: str) -> DataFrame:
    """Orders per region, but twice the members per income bin and none for
    the lowest."""
    regions = marginals(spark, d).filter("margin = 'region'")
    bins = panel_with_gaps(spark, d).dropna(subset=["income_bin"]).groupBy("income_bin").agg(F.count(F.lit(1)).alias("n"))
    target = F.when(F.col("income_bin") == "0-2.5k", 0.0).otherwise(F.col("n") * 2.0)
    return regions.unionByName(bins.select(F.lit("income_bin").alias("margin"), F.col("income_bin").alias("category"), target.alias("target")))


def top_sku(feats: DataFrame):
    """Scalar subquery: the SKU with the most units (ties: smallest name)."""
    return (
        feats.groupBy("sku").agg(F.sum("units_sold").alias("_u"))
        .orderBy(F.desc("_u"), "sku").limit(1).select("sku").scalar()
    )


def top_region_of(feats: DataFrame, sku) -> object:
    """Scalar subquery: the region selling most units of ``sku``."""
    return (
        feats.filter(F.col("sku") == sku).groupBy("region").agg(F.sum("units_sold").alias("_u"))
        .orderBy(F.desc("_u"), "region").limit(1).select("region").scalar()
    )
