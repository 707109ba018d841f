import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql.utils import CapturedException

from demandcast.operators.features import build_features, weekly_rollup
from demandcast.operators.linking import link_panel_credit
from demandcast.schemas import FEATURE_COLUMNS

D = dt.datetime

EXPECTED = [
    ("oat", "north", D(2023, 12, 25), 6, 9.0, 2, 1.5, None, 6.0, 52, 12),
    ("oat", "north", D(2024, 1, 1), 6, 9.0, 1, 1.5, 6.0, 6.0, 1, 1),
    ("oat", "north", D(2024, 1, 22), 1, 1.5, 1, 1.5, 6.0, 13 / 3, 4, 1),
    ("oat", "south", D(2024, 1, 15), 3, 4.5, 1, 1.5, None, 3.0, 3, 1),
    ("rye", "north", D(2024, 1, 22), 1, 4.0, 1, 4.0, None, 1.0, 4, 1),
    ("rye", "south", D(2024, 1, 15), 2, 8.0, 1, 4.0, None, 2.0, 3, 1),
]


def test_sample_features_exact(panel, credit):
    feats = build_features(link_panel_credit(panel, credit))
    assert feats.columns == FEATURE_COLUMNS
    assert [f.dataType.simpleString() for f in feats.schema.fields] == [
        "string", "string", "timestamp_ntz", "bigint", "double", "bigint", "double",
        "double", "double", "bigint", "bigint",
    ]
    rows = sorted(tuple(r) for r in feats.collect())
    assert rows == EXPECTED


@pytest.mark.parametrize("column", ["price", "txn_id", "region"])
def test_a_missing_column_is_named(panel, credit, column):
    linked = link_panel_credit(panel, credit).drop(column)
    with pytest.raises(ValueError, match=rf"^linked_panel_credit missing required columns: \['{column}'\]$"):
        build_features(linked)


def test_lag_and_mean_go_by_observed_weeks(spark):
    """Five observed weeks with a gap of months: the mean reaches back four."""
    days, units = ["2023-05-03", "2023-05-12", "2023-05-15", "2023-09-24", "2023-09-25"], [8, 2, 5, 9, 0]
    df = spark.createDataFrame([(d, "spelt", "east", u, 2.0 * u, 40 + i, 2.0) for i, (d, u) in enumerate(zip(days, units))], SCHEMA)
    rows = build_features(df).orderBy("week").collect()
    assert [str(r["week"].date()) for r in rows] == ["2023-05-01", "2023-05-08", "2023-05-15", "2023-09-18", "2023-09-25"]
    assert [r["lag_1_units"] for r in rows] == [None, 8.0, 2.0, 5.0, 9.0]
    assert [r["rolling_4w_mean"] for r in rows] == [8.0, 5.0, 5.0, 6.0, 4.0]


SCHEMA = "txn_date string, sku string, region string, quantity long, amount double, txn_id long, price double"


def test_null_keys_dropped_sums_and_means(spark):
    df = spark.createDataFrame(
        [
            ("2025-01-06", None, "NE", 5, 1.0, 1, 2.0),
            ("2025-01-06", "S1", None, 5, 1.0, 1, 2.0),
            ("2025-01-06", "S1", "NE", None, 1.0, 7, None),
            ("2025-01-07", "S1", "NE", 4, 2.0, 7, 4.0),
            ("2025-01-08", "S1", "NE", 1, 3.0, 8, None),
        ],
        SCHEMA,
    )
    rows = weekly_rollup(df).collect()
    assert len(rows) == 1
    r = rows[0]
    assert (r["units_sold"], r["sales_dollars"], r["n_transactions"], r["avg_price"]) == (5, 6.0, 2, 4.0)


def test_all_null_quantity_sums_to_zero(spark):
    df = spark.createDataFrame([("2025-01-06", "S1", "NE", None, None, 1, None)], SCHEMA)
    r = weekly_rollup(df).first()
    assert (r["units_sold"], r["sales_dollars"], r["avg_price"]) == (0, 0.0, None)


def test_lag_skips_missing_weeks(spark):
    df = spark.createDataFrame(
        [("2025-01-06", "S1", "NE", 1, 1.0, 1, 1.0), ("2025-02-03", "S1", "NE", 9, 1.0, 2, 1.0)], SCHEMA
    )
    rows = build_features(df).orderBy("week").collect()
    assert rows[1]["lag_1_units"] == 1.0


def test_year_boundary_sunday(spark):
    df = spark.createDataFrame([("2021-01-03", "S1", "NE", 1, 1.0, 1, 1.0)], SCHEMA)
    r = build_features(df).first()
    assert r["week"] == D(2020, 12, 28)
    assert (r["weekofyear"], r["month"]) == (53, 12)


def test_null_date_fails(spark):
    df = spark.createDataFrame([(None, "S1", "NE", 1, 1.0, 1, 1.0)], SCHEMA)
    with pytest.raises((PySparkException, CapturedException, Exception), match="txn_date has null values"):
        build_features(df).collect()


def test_result_independent_of_partitioning(spark, panel, credit):
    linked = link_panel_credit(panel, credit)
    a = sorted(tuple(r) for r in build_features(linked).collect())
    b = sorted(tuple(r) for r in build_features(linked.repartition(7)).collect())
    assert a == b


def test_odd_numbers_are_not_dropped(spark):
    nan, inf = float("nan"), float("inf")
    rows = [("2025-01-06", "S", "A", 1, a, i, p) for i, (a, p) in enumerate([(2.0, 2.0), (nan, nan), (4.0, 4.0)])]
    rows += [("2025-01-06", "S", "B", 1, a, i, p) for i, (a, p) in enumerate([(1.0, 2.0), (inf, inf)])]
    rows += [("2025-01-06", "S", "C", 1, a, i, p) for i, (a, p) in enumerate([(1e25, 1e25), (1e25, 3e25)])]
    rows += [("2025-01-06", "S", "D", 1, a, i, p) for i, (a, p) in enumerate([(1e-8, 1e-8), (3e-8, None), (1.0, 3e-8)])]
    for parts in (1, 3):
        got = {r["region"]: (r["sales_dollars"], r["avg_price"]) for r in weekly_rollup(spark.createDataFrame(rows, SCHEMA).repartition(parts)).collect()}
        assert got["A"] == (6.0, 3.0)
        assert got["B"] == (inf, inf)
        assert got["C"] == pytest.approx((2e25, 2e25))
        assert got["D"] == pytest.approx((1.00000004, 2e-8))
