import os

import pytest

from demandcast.operators.lookup import forecast_records
from demandcast.operators.regression import InsufficientHistoryError, regression_quantile_forecast
from demandcast.plans.pipeline import run_pipeline
from demandcast.sources import files as io
from demandcast.streaming.landing import land_new_files

from sample_rows import CREDIT_ROWS, PANEL_ROWS

CREDIT_HEADER = "txn_id,customer_id,txn_date,sku,region,amount,price,quantity"
PANEL_HEADER = "panel_id,customer_id,age_group,region,income_bin,household_size"


def write_csv(path, header, rows):
    with open(path, "w") as fh:
        fh.write(header + "\n")
        for r in rows:
            fh.write(",".join(str(x) for x in r) + "\n")
    return path


def test_pipeline_end_to_end(spark, tmp_dir):
    credit = write_csv(os.path.join(tmp_dir, "credit.csv"), CREDIT_HEADER, CREDIT_ROWS)
    panel = write_csv(os.path.join(tmp_dir, "panel.csv"), PANEL_HEADER, PANEL_ROWS)
    landing, feats = os.path.join(tmp_dir, "landing"), os.path.join(tmp_dir, "features")
    marginals = {"region": {"north": 2.0, "south": 2.0}, "age_group": {"18-29": 1.0, "30-49": 2.0, "50+": 1.0}}
    with pytest.raises(InsufficientHistoryError):
        run_pipeline(spark, credit, panel, landing, feats, horizon=4)
    run = run_pipeline(spark, credit, panel, landing, feats, marginals=marginals, horizon=4, without_history="naive")
    assert io.FORECAST_LGB_TABLE in run.skipped  # 6 weeks of history are too few for the model
    assert run.rake.converged
    assert spark.read.parquet(run.paths[io.LINKED_TABLE]).count() == 7
    assert spark.read.parquet(run.paths[io.FEATURES_TABLE]).count() == 6
    ens = spark.read.parquet(run.paths[io.FORECAST_ENSEMBLE_TABLE])
    assert ens.columns == ["sku", "region", "date", "q0.1", "q0.5", "q0.9"]
    assert ens.count() == 4 * 4
    served = io.load_forecast_for_serving(spark, feats)
    recs = forecast_records(served, "oat", "north", 2)
    assert [r["date"] for r in recs] == ["2024-01-29", "2024-02-05"]
    tables = io.load_tables(spark, landing, feats)
    assert set(tables) >= {"credit", "panel", "linked", "features", "forecast_ensemble", "forecast_deepar"}


def test_regression_needs_history(spark, credit, panel):
    from demandcast.operators.features import build_features
    from demandcast.operators.linking import link_panel_credit

    with pytest.raises(InsufficientHistoryError):
        regression_quantile_forecast(build_features(link_panel_credit(panel, credit)), horizon=2)


def test_streaming_lands_each_file_once(spark, tmp_dir):
    src = os.path.join(tmp_dir, "drops")
    os.makedirs(src)
    table = os.path.join(tmp_dir, "credit_txn")
    ckpt = os.path.join(tmp_dir, "ckpt")
    write_csv(os.path.join(src, "w1.csv"), CREDIT_HEADER, CREDIT_ROWS[:5])
    assert land_new_files(spark, src, table, ckpt) == 1
    assert land_new_files(spark, src, table, ckpt) == 0
    assert spark.read.parquet(table).count() == 5
    write_csv(os.path.join(src, "w2.csv"), CREDIT_HEADER, CREDIT_ROWS[5:])
    land_new_files(spark, src, table, ckpt)
    df = spark.read.parquet(table)
    assert df.count() == 8
    assert sorted(r["txn_id"] for r in df.collect()) == [11, 12, 13, 14, 15, 16, 16, 17]


def test_streaming_rejects_misplaced_columns(spark, tmp_dir):
    src = os.path.join(tmp_dir, "drops")
    os.makedirs(src)
    bad_header = "customer_id,txn_id,txn_date,sku,region,amount,price,quantity"
    write_csv(os.path.join(src, "w1.csv"), bad_header, [("C1", 1, "2025-01-01", "S", "NE", 1.0, 1.0, 1)])
    with pytest.raises(Exception):
        land_new_files(spark, src, os.path.join(tmp_dir, "t"), os.path.join(tmp_dir, "c"))


def test_cli_run_and_lookup(spark, tmp_dir, capsys, monkeypatch):
    import json

    from demandcast.__main__ import main

    credit = write_csv(os.path.join(tmp_dir, "credit.csv"), CREDIT_HEADER, CREDIT_ROWS)
    panel = write_csv(os.path.join(tmp_dir, "panel.csv"), PANEL_HEADER, PANEL_ROWS)
    feats = os.path.join(tmp_dir, "features")
    monkeypatch.delenv("HASH_SALT", raising=False)
    with pytest.raises(SystemExit):
        main(["run", "--credit_csv", credit, "--panel_csv", panel, "--landing_dir", tmp_dir, "--feature_dir", feats])
    monkeypatch.setenv("HASH_SALT", "own salt")
    assert main(["run", "--credit_csv", credit, "--panel_csv", panel, "--landing_dir",
                 os.path.join(tmp_dir, "landing"), "--feature_dir", feats, "--no_regression"]) == 0
    capsys.readouterr()
    assert main(["lookup", "--feature_dir", feats, "--sku", "rye", "--region", "south", "--horizon", "3"]) == 0
    rows = json.loads(capsys.readouterr().out)
    assert [r["date"] for r in rows] == ["2024-01-22", "2024-01-29", "2024-02-05"]
    assert main(["lookup", "--feature_dir", feats, "--sku", "nope", "--region", "south"]) == 1


def test_unreadable_optional_table_is_skipped(spark, tmp_dir, caplog):
    row = spark.createDataFrame([(1,)], "x long")
    for name in (io.CREDIT_TABLE, io.PANEL_TABLE, io.LINKED_TABLE):
        io.write_parquet(row, tmp_dir, name)
    with open(io.artefact_path(tmp_dir, io.FEATURES_TABLE), "w") as fh:
        fh.write("this is not Parquet")
    assert set(io.load_tables(spark, tmp_dir, tmp_dir)) == {"credit", "panel", "linked"}
    assert "skipped" in caplog.text


STAGES = [io.CREDIT_TABLE, io.PANEL_TABLE, io.LINKED_TABLE, io.PANEL_WEIGHTED_TABLE, io.FEATURES_TABLE, io.FORECAST_DEEPAR_TABLE, io.FORECAST_ENSEMBLE_TABLE]


def test_a_failed_run_resumes_after_any_stage(spark, tmp_dir, monkeypatch):
    credit = write_csv(os.path.join(tmp_dir, "credit.csv"), CREDIT_HEADER, CREDIT_ROWS)
    panel = write_csv(os.path.join(tmp_dir, "panel.csv"), PANEL_HEADER, PANEL_ROWS)
    marginals = {"region": {"north": 2.0, "south": 2.0}}
    options = {"marginals": marginals, "horizon": 3, "use_regression": False}
    landing, feats = os.path.join(tmp_dir, "landing"), os.path.join(tmp_dir, "features")

    write = io.write_parquet
    for i, failing in enumerate(STAGES):
        def half(df, directory, name, mode="overwrite", failing=failing):
            out = write(df, directory, name, mode)
            if name == failing:  # the table is there, the commit is not
                raise io.IngestError("lost")
            return out

        monkeypatch.setattr(io, "write_parquet", half)
        with pytest.raises(io.IngestError):
            run_pipeline(spark, credit, panel, landing, feats, **options)
        monkeypatch.setattr(io, "write_parquet", write)
        if i == 3:  # a file of a committed stage goes missing: that stage is done anew
            part = next(f for f in os.listdir(os.path.join(landing, "linked_panel_credit.parquet")) if f.endswith(".parquet"))
            with open(os.path.join(landing, "linked_panel_credit.parquet", part), "ab") as fh:
                fh.write(b"x")
    run = run_pipeline(spark, credit, panel, landing, feats, **options)
    assert run.reused[:3] == STAGES[:3] and run.done == STAGES[-1:] and run.rake is None
    assert run.notes[io.PANEL_WEIGHTED_TABLE]["converged"] and run.rows[io.LINKED_TABLE] == 7
    whole = run_pipeline(spark, credit, panel, os.path.join(tmp_dir, "l2"), os.path.join(tmp_dir, "f2"), **options)
    assert whole.done == STAGES
    for name in STAGES:
        assert sorted(map(repr, spark.read.parquet(run.paths[name]).collect())) == sorted(map(repr, spark.read.parquet(whole.paths[name]).collect()))

    assert run_pipeline(spark, credit, panel, landing, feats, **options).done == []
    assert run_pipeline(spark, credit, panel, landing, feats, **options | {"horizon": 4}).done == STAGES[-2:]
    assert run_pipeline(spark, credit, panel, landing, feats, **options | {"salt": "other"}).done[0] == io.LINKED_TABLE
    write_csv(credit, CREDIT_HEADER, CREDIT_ROWS[:5])
    changed = run_pipeline(spark, credit, panel, landing, feats, **options)
    assert changed.done[0] == io.CREDIT_TABLE and io.PANEL_TABLE in changed.reused and changed.rows[io.CREDIT_TABLE] == 5
    assert len(run_pipeline(spark, credit, panel, landing, feats, resume=False, **options).done) == 7
