"""A customer holding a third of all transactions: the shuffle-path link is
split by AQE's skew join (thresholds lowered to fixture size) and the
explicit salted path gives the same rows."""

from contextlib import contextmanager

from pyspark.sql import functions as F

from demandcast.operators.linking import link_panel_credit

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "16",
}


@contextmanager
def conf(spark, values):
    old = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def skewed_inputs(spark, n=30_000):
    credit = spark.range(n).select(
        F.col("id").alias("txn_id"),
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.concat(F.lit("C"), (F.col("id") % 997).cast("string")))
        .alias("customer_id"),
        (F.col("id") % 5).alias("quantity"),
    ).repartition(8)
    panel = spark.range(997).select(
        F.concat(F.lit("P"), F.col("id").cast("string")).alias("panel_id"),
        F.concat(F.lit("C"), F.col("id").cast("string")).alias("customer_id"),
    ).unionByName(spark.createDataFrame([("PH", "HOT")], "panel_id string, customer_id string"))
    return panel, credit


def test_aqe_splits_the_hot_customer(spark):
    panel, credit = skewed_inputs(spark)
    with conf(spark, SKEW_CONF):
        linked = link_panel_credit(panel, credit).select("panel_id", "txn_id")
        rows = linked.collect()
        plan = linked._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan
    assert "isSkewJoin=true" in plan or "skew=true" in plan, plan
    assert len(rows) == 30_000


def test_salted_link_matches(spark):
    panel, credit = skewed_inputs(spark, 9_000)
    with conf(spark, SKEW_CONF):
        plain = link_panel_credit(panel, credit).select("panel_id", "txn_id").collect()
        salted = link_panel_credit(panel, credit, hot_key_support=0.2, salt_buckets=16)
        rows = salted.select("panel_id", "txn_id").collect()
    assert sorted(rows) == sorted(plain)
    assert len(rows) == 9_000


def test_pipeline_spreads_a_hot_customer_by_itself(spark, tmp_dir, monkeypatch):
    """No caller names the hot key, and adaptive execution is off."""
    import os

    from demandcast.operators.linking import hot_customers
    from demandcast.plans import pipeline
    from sample_rows import PANEL_ROWS
    from test_pipeline_and_streaming import CREDIT_HEADER, PANEL_HEADER, write_csv

    rows = [(i, "K7" if i % 3 == 0 else f"X{i % 500}", "2024-01-%02d" % (1 + i % 28), "oat", "north", 1.0, 1.0, 1) for i in range(6000)]
    credit = write_csv(os.path.join(tmp_dir, "credit.csv"), CREDIT_HEADER, rows)
    panel = write_csv(os.path.join(tmp_dir, "panel.csv"), PANEL_HEADER, PANEL_ROWS)
    monkeypatch.setattr(pipeline, "HOT_KEY_ROWS", 500)
    off = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "8"}
    with conf(spark, off):
        run = pipeline.run_pipeline(spark, credit, panel, os.path.join(tmp_dir, "l"), os.path.join(tmp_dir, "f"), use_regression=False)
        linked = spark.read.parquet(run.paths["linked_panel_credit"])
        files = [r["count"] for r in linked.groupBy(F.input_file_name()).count().collect()]
    assert linked.count() == 2000 and len(files) >= 6 and max(files) < 700
    landed = spark.read.parquet(run.paths["credit_txn"])
    assert hot_customers(landed, 0.01) == ["K7"] and hot_customers(landed, 0.01, min_rows=5000) == []
