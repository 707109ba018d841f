import os

import pytest

from demandcast.operators.checks import (
    TotalsMismatchError,
    check_required_columns,
    check_totals_close,
    totals_report,
)
from demandcast.sources.files import (
    IngestError,
    artefact_path,
    first_available,
    ingest,
    load_optional,
    load_tables,
    read_csv,
    write_parquet,
)
from demandcast.schemas import CREDIT_SCHEMA


def write(path, text):
    with open(path, "w") as fh:
        fh.write(text)
    return path


def test_required_columns(spark):
    """All missing names are told, in the contract's order, under the table's name."""
    shelf = spark.createDataFrame([], "tray string, loaves long, baked date")
    assert check_required_columns(shelf, ["baked", "tray"], "shelf") is None
    with pytest.raises(ValueError, match=r"^shelf missing required columns: \['oven', 'baker'\]$"):
        check_required_columns(shelf, ["oven", "tray", "baker"], "shelf")


def sold(spark, *quantities):
    return spark.createDataFrame([(q,) for q in quantities], "quantity long")


@pytest.mark.parametrize("panel, credit, tolerance, close", [
    ((7, 1), (8,), 0.0, True),
    ((9,), (6, 6), 0.25, True),  # exactly a quarter off
    ((89,), (12, 108), 0.25, False),
    ((5,), (-4,), 0.25, True),  # a negative total gives a negative ratio
    ((None, 3), (3, None), 0.0, True),
    ((40,), (0,), 0.25, True),  # nothing to compare with
])
def test_totals(spark, panel, credit, tolerance, close):
    p, c = sold(spark, *panel), sold(spark, *credit)
    if close:
        check_totals_close(p, c, tol=tolerance)
    else:
        with pytest.raises(TotalsMismatchError, match="deviate"):
            check_totals_close(p, c, tol=tolerance)


def test_totals_report(spark):
    assert tuple(totals_report(sold(spark, 2, 4), sold(spark, 8)).first()) == (6.0, 8.0, 0.25)
    assert totals_report(sold(spark, 2), sold(spark)).first()["ratio"] is None
    assert totals_report(spark.createDataFrame([("r",)], "tray string"), sold(spark, 8)).first()["panel_total"] == 0.0


CREDIT_HEADER = "txn_id,customer_id,txn_date,sku,region,amount,price,quantity\n"
PANEL_HEADER = "panel_id,customer_id,age_group,region,income_bin,household_size\n"


def test_missing_file(spark, tmp_dir):
    with pytest.raises(IngestError, match="File not found"):
        read_csv(spark, os.path.join(tmp_dir, "nope.csv"))


def test_csv_by_name_keeps_text_ids_and_na(spark, tmp_dir):
    path = write(os.path.join(tmp_dir, "c.csv"),
                 "quantity,customer_id,txn_id,txn_date,sku,region,amount,price\n12,0077,31,2023-03-09,spelt,NA,42.0,3.5\n")
    row = read_csv(spark, path, CREDIT_SCHEMA).first()
    assert row["customer_id"] == "0077" and row["region"] == "NA" and row["quantity"] == 12 and row["txn_id"] == 31


def test_ingest_validates_before_writing(spark, tmp_dir):
    sale, member = "58,K4,2023-11-20,rye,east,12.0,4.0,3\n", "m7,K4,50+,east,mid,2\n"
    credit = write(os.path.join(tmp_dir, "credit.csv"), CREDIT_HEADER + sale)
    bad_credit = write(os.path.join(tmp_dir, "bad_credit.csv"), CREDIT_HEADER.replace("quantity", "pieces") + sale)
    panel = write(os.path.join(tmp_dir, "panel.csv"), PANEL_HEADER + member)
    bad_panel = write(os.path.join(tmp_dir, "bad_panel.csv"), PANEL_HEADER.replace("household_size", "heads") + member)
    landing = os.path.join(tmp_dir, "landing")
    with pytest.raises(ValueError, match="credit_csv missing required columns"):
        ingest(spark, bad_credit, panel, landing)
    with pytest.raises(ValueError, match="panel_csv missing required columns"):
        ingest(spark, credit, bad_panel, landing)
    assert load_optional(spark, artefact_path(landing, "credit_txn")) is None
    written = ingest(spark, credit, panel, landing)
    assert set(written) == {"credit_txn", "panel"}
    assert spark.read.parquet(written["panel"]).first()["household_size"] == 2


def test_parquet_roundtrip_and_optional_loads(spark, tmp_dir):
    df = spark.createDataFrame([(1, 3), (2, 4)], "a long, b long")
    path = write_parquet(df, tmp_dir, "t")
    assert sorted(tuple(r) for r in spark.read.parquet(path).collect()) == [(1, 3), (2, 4)]
    assert load_optional(spark, os.path.join(tmp_dir, "missing.parquet")) is None
    got_path, _ = first_available(spark, [os.path.join(tmp_dir, "missing.parquet"), path])
    assert got_path == path
    with pytest.raises(FileNotFoundError):
        first_available(spark, [os.path.join(tmp_dir, "missing.parquet")])
    assert load_tables(spark, tmp_dir, tmp_dir) is None


def test_empty_csv(spark, tmp_dir):
    path = write(os.path.join(tmp_dir, "empty.csv"), "")
    with pytest.raises(IngestError, match="no header"):
        read_csv(spark, path)


def test_nan_totals_do_not_hide_a_difference(spark):
    panel = spark.createDataFrame([(float("nan"),), (30.0,)], "quantity double")
    credit = spark.createDataFrame([(100.0,)], "quantity double")
    with pytest.raises(TotalsMismatchError, match="deviate"):
        check_totals_close(panel, credit)


def test_csv_dialect(spark, tmp_dir):
    path = write(os.path.join(tmp_dir, "q.csv"), 'id,note\n1,"a ""x"", b"\n2,"two\nlines"\n3,\n')
    assert sorted(tuple(r) for r in read_csv(spark, path).collect()) == [("1", 'a "x", b'), ("2", "two\nlines"), ("3", None)]
    header_only = write(os.path.join(tmp_dir, "h.csv"), "id,note\n")
    assert read_csv(spark, header_only).columns == ["id", "note"] and read_csv(spark, header_only).count() == 0


def test_folder_of_csv_with_swapped_headers_is_rejected(spark, tmp_dir):
    folder = os.path.join(tmp_dir, "drops")
    os.makedirs(folder)
    write(os.path.join(folder, "a.csv"), "id,note\n1,x\n")
    write(os.path.join(folder, "b.csv"), "id,note\n2,y\n")
    assert read_csv(spark, folder).count() == 2
    write(os.path.join(folder, "c.csv"), "note,id\nz,3\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_csv(spark, folder).collect()
