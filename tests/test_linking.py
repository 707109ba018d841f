import pytest

from demandcast.operators.linking import canonical_region, link_panel_credit

LINKED_COLUMNS = [
    "panel_id", "customer_id_panel", "age_group", "region_panel", "income_bin", "household_size",
    "cust_hash", "txn_id", "customer_id_credit", "txn_date", "sku", "region_credit", "amount",
    "price", "quantity", "region",
]


def test_sample_link_layout(panel, credit):
    linked = link_panel_credit(panel, credit)
    assert linked.columns == LINKED_COLUMNS
    assert linked.count() == 7
    assert linked.select("cust_hash").distinct().count() == 3


def test_requires_customer_id(spark):
    panel = spark.createDataFrame([("p1", "35-54")], "panel_id string, age_group string")
    credit = spark.createDataFrame([("c1", 1)], "customer_id string, txn_id long")
    with pytest.raises(ValueError, match="panel missing required columns"):
        link_panel_credit(panel, credit)


def test_minimal_link(spark):
    panel = spark.createDataFrame([("c1", "NE"), ("c2", "SE")], "customer_id string, region string")
    credit = spark.createDataFrame([("c1", 1, "NE"), ("c2", 2, "SE")], "customer_id string, txn_id long, region string")
    linked = link_panel_credit(panel, credit)
    assert "cust_hash" in linked.columns
    assert sorted(r["txn_id"] for r in linked.collect()) == [1, 2]


def test_null_ids_never_link_and_duplicates_fan_out(spark):
    panel = spark.createDataFrame(
        [("p1", "c1"), ("p1b", "c1"), ("p2", None)], "panel_id string, customer_id string"
    )
    credit = spark.createDataFrame([(1, "c1"), (2, None), (3, "c1")], "txn_id long, customer_id string")
    rows = link_panel_credit(panel, credit).collect()
    assert sorted((r["panel_id"], r["txn_id"]) for r in rows) == [("p1", 1), ("p1", 3), ("p1b", 1), ("p1b", 3)]


def test_ids_keep_their_text(spark):
    panel = spark.createDataFrame([("p1", "00123")], "panel_id string, customer_id string")
    credit = spark.createDataFrame([(1, "123")], "txn_id long, customer_id string")
    assert link_panel_credit(panel, credit).count() == 0


def test_canonical_region(spark):
    df = spark.createDataFrame([("NE", "SE"), (None, "SE")], "region_credit string, region_panel string")
    assert [r["region"] for r in canonical_region(df).collect()] == ["NE", "SE"]
    only_panel = spark.createDataFrame([("SE",)], "region_panel string")
    assert canonical_region(only_panel).first()["region"] == "SE"
    neither = spark.createDataFrame([("x",)], "other string")
    assert canonical_region(neither).columns == ["other"]
    has = spark.createDataFrame([("A", "B")], "region string, region_credit string")
    assert canonical_region(has).first()["region"] == "A"


def test_drop_raw_ids(panel, credit):
    linked = link_panel_credit(panel, credit, drop_raw_ids=True)
    assert not [c for c in linked.columns if c.startswith("customer_id")]


def test_salted_join_equals_plain_join_under_skew(spark):
    credit = spark.createDataFrame(
        [(i, "hot" if i % 3 else f"c{i % 7}") for i in range(300)], "txn_id long, customer_id string"
    )
    panel = spark.createDataFrame(
        [("p1", "hot"), ("p2", "hot"), ("p3", "c1"), ("p4", "c3"), ("p5", None)],
        "panel_id string, customer_id string",
    )
    plain = sorted(tuple(r) for r in link_panel_credit(panel, credit).collect())
    salted_df = link_panel_credit(panel, credit, hot_key_support=0.2, salt_buckets=8)
    assert sorted(tuple(r) for r in salted_df.collect()) == plain
    assert salted_df.columns == link_panel_credit(panel, credit).columns
