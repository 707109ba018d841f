"""The weekly pipeline over CSV drops: only touched weeks are rebuilt.

Each run lands the new files as a batch, links that batch against the panel
into week partitions, rolls up again the weeks the batch touches, from the
linked rows of all batches, and overwrites those partitions of the weekly
roll-up alone. The window features and forecasts follow from the roll-up, which
holds a row per series and week; no transaction of another week is read.

A batch's link is a stage of its own, valid for one panel and salt: if either
changes, the batches are linked again and every week is rolled up anew. The
roll-up's manifest names the links it holds, so a run that died between two
steps is caught up by the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandcast.functions.hashing import DEFAULT_SALT
from demandcast.operators.features import features_of_weekly, weekly_rollup, with_week
from demandcast.plans.pipeline import PipelineRun, _digest, _Stages, forecast_stages, link_stored
from demandcast.plans.stages import StageStore
from demandcast.schemas import CREDIT_COLUMNS, DEFAULT_HORIZON_WEEKS, PANEL_COLUMNS, PANEL_SCHEMA
from demandcast.sources import files as io
from demandcast.streaming.landing import land_new_files, landed_batches, read_landed

WEEK = "week_start"  # partition column: the Monday as text
LINKS, WEEKLY = "linked_batches", "weekly"


def _link_batches(spark: SparkSession, run: PipelineRun, credit_path: str, checkpoint: str, landing_dir: str, panel: DataFrame, salt) -> dict[str, str]:
    """Link every landed batch that is not linked; {batch: digest of its files}."""
    store = StageStore(spark, f"{landing_dir.rstrip('/')}/{LINKS}")
    digests = {}
    for batch in landed_batches(spark, checkpoint):
        def build(batch=batch):
            credit = read_landed(spark, credit_path, checkpoint, batch)
            return with_week(link_stored(panel, credit, salt)).withColumn(WEEK, F.date_format("week", "yyyy-MM-dd")).drop("week")

        name = f"batch={batch}"
        inputs = [run.paths[io.PANEL_TABLE], f"{credit_path.rstrip('/')}/landing_batch={batch}"]
        store.run(name, inputs, {"salt": _digest(salt)}, build, lambda df, path: df.write.mode("overwrite").partitionBy(WEEK).parquet(path))
        digests[name] = store.manifest(name)["output"]
    run.done += store.done
    run.reused += store.reused
    return digests


def _roll_up(spark: SparkSession, run: PipelineRun, landing_dir: str, feature_dir: str, digests: dict[str, str]) -> list[str] | None:
    """Bring the weekly roll-up up to ``digests``; the weeks done, None for all."""
    store = StageStore(spark, feature_dir)
    known = store.manifest(WEEKLY)
    held = known["links"] if known else {}
    fresh = [name for name in digests if name not in held]
    run.paths[WEEKLY] = store.path(WEEKLY)
    if known and not fresh and all(digests.get(name) == digest for name, digest in held.items()):
        return []
    links = spark.read.parquet(f"{landing_dir.rstrip('/')}/{LINKS}").withColumn(WEEK, F.date_format(WEEK, "yyyy-MM-dd"))
    weeks = None
    if known and all(digests.get(name) == digest for name, digest in held.items()):
        in_fresh = F.col("batch").isin([f"{name.partition('=')[2]}.parquet" for name in fresh])
        weeks = sorted(r[WEEK] for r in links.filter(in_fresh).select(WEEK).distinct().collect())  # weeks of a calendar
        links = links.filter(F.col(WEEK).isin(weeks))
    else:
        store.forget(WEEKLY)  # another panel or salt: whatever is there no longer holds
    weekly = weekly_rollup(links).withColumn(WEEK, F.date_format("week", "yyyy-MM-dd"))
    mode = "static" if weeks is None else "dynamic"
    weekly.write.mode("overwrite").option("partitionOverwriteMode", mode).partitionBy(WEEK).parquet(store.path(WEEKLY))
    store.commit(WEEKLY, {"links": digests})
    return weeks


def run_incremental(
    spark: SparkSession,
    credit_drops: str,
    panel_csv: str,
    landing_dir: str,
    feature_dir: str,
    horizon: int = DEFAULT_HORIZON_WEEKS,
    salt: str | bytes = DEFAULT_SALT,
    use_regression: bool = True,
    without_history: str = "fail",
) -> PipelineRun:
    """Land the new files of ``credit_drops`` and bring features and forecasts
    up to date. ``notes["weekly"]["weeks"]`` tells the weeks rolled up."""
    run = PipelineRun()
    stage = _Stages(spark, run, True)
    credit_path, checkpoint = f"{landing_dir.rstrip('/')}/credit_batches", f"{landing_dir.rstrip('/')}/_landing"
    io.check_header(spark, panel_csv, PANEL_COLUMNS, "panel_csv")
    land_new_files(spark, credit_drops, credit_path, checkpoint)
    if not landed_batches(spark, checkpoint):
        raise io.IngestError(f"no drop of credit transactions {CREDIT_COLUMNS} in {credit_drops}")
    panel = stage(landing_dir, io.PANEL_TABLE, [panel_csv], {}, lambda: io.read_csv(spark, panel_csv, PANEL_SCHEMA))
    digests = _link_batches(spark, run, credit_path, checkpoint, landing_dir, panel, salt)
    run.notes[WEEKLY] = {"weeks": _roll_up(spark, run, landing_dir, feature_dir, digests)}
    features = stage(feature_dir, io.FEATURES_TABLE, [run.paths[WEEKLY]], {},
                     lambda: features_of_weekly(spark.read.parquet(run.paths[WEEKLY]).drop(WEEK)).sortWithinPartitions("sku", "region", "week"))
    forecast_stages(stage, features, feature_dir, horizon, use_regression, without_history)
    return run
