from pyspark.sql import functions as F

from demandcast.operators.weighting import rake
from demandcast.session import BROADCAST_MAX_ROWS_KEY, broadcast_max_rows, resolve_checkpoint_dir
from demandcast.sources.tpch import broadcast_if_small


def test_checkpoint_folder_is_kept(spark):
    before = spark.sparkContext.getCheckpointDir()
    assert resolve_checkpoint_dir(spark) == before and before


def test_broadcast_bound_follows_the_session(spark):
    df = spark.range(3)
    assert broadcast_max_rows(spark) == 1_000_000
    hinted = broadcast_if_small(df, 3).join(spark.range(10), "id")
    assert "BroadcastHashJoin" in hinted._jdf.queryExecution().executedPlan().toString()
    spark.conf.set(BROADCAST_MAX_ROWS_KEY, "-1")
    try:
        assert broadcast_if_small(df, 3) is df
    finally:
        spark.conf.unset(BROADCAST_MAX_ROWS_KEY)


def test_raking_restores_session_settings(spark):
    key = "spark.sql.constraintPropagation.enabled"
    spark.conf.set(key, "true")
    df = spark.createDataFrame([("a",), ("b",)], "g string")
    rake(df, {"g": {"a": 1.0, "b": 3.0}})
    assert spark.conf.get(key) == "true"
    assert df.select(F.lit(1)).count() == 2
