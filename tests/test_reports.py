import datetime as dt

from demandcast.operators import reports
from demandcast.operators.features import build_features
from demandcast.operators.linking import link_panel_credit


def test_overviews(spark, panel, credit):
    ov = reports.credit_overview(credit).first()
    assert (ov["n_records"], ov["n_skus"], ov["n_customers"]) == (8, 2, 4)
    assert (ov["first_txn_date"], ov["last_txn_date"]) == ("2023-12-27", "2024-01-30")
    po = reports.panel_overview(panel).first()
    assert (po["n_members"], po["n_customers"]) == (4, 4)
    daily = {r["txn_date"]: r["quantity"] for r in reports.daily_volume(credit).collect()}
    assert daily[dt.datetime(2024, 1, 24)] == 2 and len(daily) == 7


def test_distribution_and_linkage(spark, panel, credit):
    ages = {r["age_group"]: (r["n"], r["share"]) for r in reports.distribution(panel, "age_group").collect()}
    assert ages == {"18-29": (1, 0.25), "30-49": (2, 0.5), "50+": (1, 0.25)}
    linked = link_panel_credit(panel, credit)
    lm = reports.linkage_metrics(linked, credit).first()
    assert (lm["linked_records"], lm["linkage_rate"], lm["unique_customers"]) == (7, 87.5, 3)
    by_sku = {r["sku"]: r["linked_records"] for r in reports.linked_by_sku(linked).collect()}
    assert by_sku == {"oat": 5, "rye": 2}
    sample = reports.linked_sample(linked).collect()
    assert len(sample) == 7 and list(sample[0].asDict()) == [
        "sku", "region", "txn_date", "quantity", "amount", "age_group", "income_bin"
    ]


def test_feature_and_forecast_summaries(spark, panel, credit):
    feats = build_features(link_panel_credit(panel, credit))
    fs = reports.feature_summary(feats).first()
    assert (fs["n_rows"], fs["n_series"], fs["date_range_days"]) == (6, 4, 28)
    fc = spark.createDataFrame(
        [("S1", "NE", 1.0), ("S1", "NE", 3.0), ("S1", "SE", 2.0), ("S2", "NE", 2.0), ("S2", "NE", 2.0)],
        "sku string, region string, `q0.5` double",
    )
    s = reports.forecast_summary(fc).first()
    assert (s["horizon_weeks"], s["n_series"], s["mean_q50"]) == (1, 3, 2.0)
    idx = reports.first_series_index([None, fc.drop("region"), fc])
    assert idx.count() == 3
    regions = {r["sku"]: r["regions"] for r in reports.regions_by_sku(idx).collect()}
    assert regions == {"S1": "NE,SE", "S2": "NE"}


def test_pipeline_status(spark, panel, credit):
    empty = spark.createDataFrame([], "x long")
    status = {
        r["step"]: r["ready"]
        for r in reports.pipeline_status(spark, {"credit": credit, "panel": panel, "linked": empty}).collect()
    }
    assert status == {
        "Data Ingestion": True, "Data Linking": False, "Feature Engineering": False, "Forecasting": False
    }


def test_forecasting_ready_with_either_slot(spark, panel, credit):
    one = spark.createDataFrame([(1,)], "x long")
    empty = spark.createDataFrame([], "x long")
    status = {
        r["step"]: r["ready"]
        for r in reports.pipeline_status(
            spark, {"credit": credit, "panel": panel, "linked": one, "features": one,
                    "forecast_ensemble": empty, "forecast_deepar": one}
        ).collect()
    }
    assert all(status.values())


def test_preview_is_deterministic(spark):
    df = spark.createDataFrame([(2, "b"), (1, "z"), (1, "a"), (3, "c")], "id long, v string")
    got = [tuple(r) for r in reports.preview(df.repartition(3), 3, ["id"]).collect()]
    assert got == [(1, "a"), (1, "z"), (2, "b")]
