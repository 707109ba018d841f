"""Table contracts, column names and the dotted-quantile-name helper."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# These must equal the original pipeline's contracts so that
# existing files and callers keep working.
# ---------------------------------------------------------------------------
CREDIT_COLUMNS = ["txn_id", "customer_id", "txn_date", "sku", "region", "amount", "price", "quantity"]
PANEL_COLUMNS = ["panel_id", "customer_id", "age_group", "region", "income_bin", "household_size"]
LINK_REQUIRED = ["customer_id"]
FEATURE_REQUIRED = ["txn_date", "sku", "region", "quantity", "amount", "txn_id", "price"]
QUANTILES = (0.1, 0.5, 0.9)
QUANTILE_COLUMNS = ["q0.1", "q0.5", "q0.9"]
SERIES_KEYS = ["sku", "region"]
FORECAST_KEYS = ["sku", "region", "date"]
FORECAST_OUTPUT = ["sku", "region", "date", "q0.1", "q0.5", "q0.9"]
PANEL_SUFFIX = "_panel"
CREDIT_SUFFIX = "_credit"
DEFAULT_HORIZON_WEEKS = 12
LINKED_SAMPLE_COLUMNS = ["sku", "region", "txn_date", "quantity", "amount", "age_group", "income_bin"]
FORECAST_DISPLAY_NAMES = {"q0.1": "10th Percentile", "q0.5": "Median", "q0.9": "90th Percentile"}
FEATURE_COLUMNS = [
    "sku", "region", "week", "units_sold", "sales_dollars", "n_transactions",
    "avg_price", "lag_1_units", "rolling_4w_mean", "weekofyear", "month",
]
# ---------------------------------------------------------------------------

CREDIT_SCHEMA = T.StructType([
    T.StructField("txn_id", T.LongType()),
    T.StructField("customer_id", T.StringType()),
    T.StructField("txn_date", T.StringType()),
    T.StructField("sku", T.StringType()),
    T.StructField("region", T.StringType()),
    T.StructField("amount", T.DoubleType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("quantity", T.LongType()),
])

PANEL_SCHEMA = T.StructType([
    T.StructField("panel_id", T.StringType()),
    T.StructField("customer_id", T.StringType()),
    T.StructField("age_group", T.StringType()),
    T.StructField("region", T.StringType()),
    T.StructField("income_bin", T.StringType()),
    T.StructField("household_size", T.LongType()),
])

REQUEST_SCHEMA = T.StructType([
    T.StructField("request_id", T.StringType()),
    T.StructField("sku", T.StringType()),
    T.StructField("region", T.StringType()),
    T.StructField("horizon_weeks", T.IntegerType()),
])

MARGINALS_SCHEMA = T.StructType([
    T.StructField("margin", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("target", T.DoubleType()),
])


def qname(q: float, suffix: str = "") -> str:
    """Column name of quantile ``q``: 0.1 -> 'q0.1' (+ optional suffix)."""
    return f"q{q}{suffix}"


def qcol(name: str) -> Column:
    """Reference a column whose name contains dots (``q0.1``) literally."""
    return F.col(f"`{name}`")
