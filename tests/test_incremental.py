"""CSV drops through the pipeline: the same as one batch, touched weeks alone."""

import os

import pytest

from demandcast.plans import incremental as N
from demandcast.plans.pipeline import run_pipeline
from demandcast.sources import files as io
from demandcast.streaming.landing import land_new_files, read_landed

from sample_rows import CREDIT_ROWS, PANEL_ROWS
from test_pipeline_and_streaming import CREDIT_HEADER, PANEL_HEADER, write_csv

OPTIONS = {"horizon": 3, "use_regression": False}


@pytest.fixture()
def folders(tmp_dir):
    names = {n: os.path.join(tmp_dir, n) for n in ("drops", "landing", "features", "l2", "f2")}
    os.makedirs(names["drops"])
    names["panel"] = write_csv(os.path.join(tmp_dir, "panel.csv"), PANEL_HEADER, PANEL_ROWS)
    names["all"] = os.path.join(tmp_dir, "credit.csv")
    return names


def table(spark, path):
    df = spark.read.parquet(path)
    return df.columns, sorted(map(repr, df.collect()))


def drop(f, name, rows):
    write_csv(os.path.join(f["drops"], name), CREDIT_HEADER, rows)


def go(spark, f):
    return N.run_incremental(spark, f["drops"], f["panel"], f["landing"], f["features"], **OPTIONS)


def equal_to_one_batch(spark, f, run, rows):
    write_csv(f["all"], CREDIT_HEADER, rows)
    whole = run_pipeline(spark, f["all"], f["panel"], f["l2"], f["f2"], **OPTIONS)
    for name in (io.FEATURES_TABLE, io.FORECAST_ENSEMBLE_TABLE):
        assert table(spark, run.paths[name]) == table(spark, whole.paths[name])


def test_two_drops_equal_one_batch_and_rebuild_touched_weeks(spark, folders, monkeypatch):
    f = folders
    drop(f, "a.csv", CREDIT_ROWS[:5])
    first = go(spark, f)
    assert first.notes["weekly"]["weeks"] is None
    weekly = first.paths["weekly"]
    old = {w: sorted(os.listdir(os.path.join(weekly, w))) for w in os.listdir(weekly) if w.startswith("week_start")}

    # the second drop adds to a week of the first (a transaction it has already, too) and brings a new one
    late = [(14, "K9", "2024-01-16", "oat", "south", 3.0, 1.5, 2), *CREDIT_ROWS[5:]]
    drop(f, "b.csv", late)
    roll, lost = N._roll_up, []

    def dies(*args):
        lost.append(1)
        raise RuntimeError("lost")

    monkeypatch.setattr(N, "_roll_up", dies)  # dies after the batch is linked
    with pytest.raises(RuntimeError):
        go(spark, f)
    monkeypatch.setattr(N, "_roll_up", roll)
    second = go(spark, f)
    assert lost and second.notes["weekly"]["weeks"] == ["2024-01-15", "2024-01-22"]
    new = {w: sorted(os.listdir(os.path.join(weekly, w))) for w in old}
    assert {w for w in old if old[w] != new[w]} == {"week_start=2024-01-15"}
    equal_to_one_batch(spark, f, second, CREDIT_ROWS[:5] + late)
    assert go(spark, f).done == [] and go(spark, f).notes["weekly"]["weeks"] == []

    # another panel: every batch is linked again, every week rolled up anew
    write_csv(f["panel"], PANEL_HEADER, PANEL_ROWS[:2])
    third = go(spark, f)
    assert third.notes["weekly"]["weeks"] is None and {"batch=0", "batch=1"} <= set(third.done)
    equal_to_one_batch(spark, f, third, CREDIT_ROWS[:5] + late)


def test_landing_and_ingest_read_alike(spark, folders):
    f = folders
    lines = [CREDIT_HEADER, '1,"K\n7",2024-01-01,"o""at","nor,th",1.5,1.5,1', "2,NA,2024-01-02,,south,,2.5,2"]
    for path in (os.path.join(f["drops"], "a.csv"), f["all"]):
        with open(path, "w") as fh:
            fh.write("\n".join(lines) + "\n")
    assert land_new_files(spark, f["drops"], f["landing"], f["l2"]) == 1
    written = io.ingest(spark, f["all"], f["panel"], f["f2"])
    landed = sorted(map(repr, read_landed(spark, f["landing"], f["l2"]).collect()))
    assert landed == table(spark, written[io.CREDIT_TABLE])[1] and "K\\n7" in landed[0]


def test_an_uncommitted_batch_is_written_again(spark, folders):
    f = folders
    drop(f, "a.csv", CREDIT_ROWS[:3])
    half = os.path.join(f["landing"], "landing_batch=0")
    spark.createDataFrame([(1,)], "txn_id long").write.parquet(half)  # a run died before its commit
    assert land_new_files(spark, f["drops"], f["landing"], f["l2"]) == 1
    assert read_landed(spark, f["landing"], f["l2"]).count() == 3
    os.makedirs(f["f2"])
    with pytest.raises(io.IngestError):  # nothing has been dropped yet
        N.run_incremental(spark, f["f2"], f["panel"], os.path.join(f["l2"], "x"), f["features"], **OPTIONS)
