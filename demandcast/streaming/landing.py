"""Incremental landing of CSV drops with Structured Streaming.

A file-source stream with the ``availableNow`` trigger notes exactly the new
files of a folder in a log and stops: Spark's checkpoint records which were
seen. The noted files that no batch has landed yet are read with the one CSV
reader (same dialect as :func:`demandcast.sources.files.ingest`, quoted line
breaks included) and written as the next batch of the table, a folder
``landing_batch=N``; the batch is committed by appending its files to a second
log. A run that dies in between leaves an uncommitted batch, which the next run
overwrites, so every file lands once.

A drop must have the declared columns in the declared order: files whose
columns are missing or out of place fail the run before anything is landed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandcast.schemas import CREDIT_SCHEMA, PANEL_SCHEMA
from demandcast.sources.files import IngestError, load_optional, read_csv

SCHEMAS = {"credit_txn": CREDIT_SCHEMA, "panel": PANEL_SCHEMA}
BATCH = "landing_batch"
LANDED = f"path string, {BATCH} int"
ARRIVAL = "path string, modificationTime timestamp, length long, content binary"


def _note_arrivals(spark: SparkSession, source_dir: str, log: str, checkpoint: str, max_files: int | None) -> None:
    """Append the names of files not seen before; their contents are not read."""
    reader = spark.readStream.format("binaryFile").schema(ARRIVAL)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    query = (
        reader.load(source_dir).select("path")
        .writeStream.format("parquet").option("checkpointLocation", checkpoint)
        .outputMode("append").trigger(availableNow=True).start(log)
    )
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()


def landed_batches(spark: SparkSession, checkpoint_path: str) -> list[int]:
    """Numbers of the committed batches."""
    log = load_optional(spark, f"{checkpoint_path.rstrip('/')}/landed", LANDED)
    return [] if log is None else sorted(r[BATCH] for r in log.select(BATCH).distinct().collect())


def read_landed(spark: SparkSession, table_path: str, checkpoint_path: str, batch: int | None = None) -> DataFrame:
    """Rows of the committed batches, or of one."""
    known = landed_batches(spark, checkpoint_path)
    rows = spark.read.parquet(table_path).filter(F.col(BATCH).isin(known if batch is None else [batch]))
    return rows.drop(BATCH)


def land_new_files(
    spark: SparkSession,
    source_dir: str,
    table_path: str,
    checkpoint_path: str,
    schema: T.StructType | str = "credit_txn",
    max_files_per_trigger: int | None = None,
) -> int:
    """Land the CSV files not landed yet as one batch; return the number of
    batches landed, 1 or 0. ``checkpoint_path`` must be on shared storage."""
    if isinstance(schema, str):
        schema = SCHEMAS[schema]
    base = checkpoint_path.rstrip("/")
    _note_arrivals(spark, source_dir, f"{base}/arrivals", f"{base}/stream", max_files_per_trigger)
    seen, done = load_optional(spark, f"{base}/arrivals", "path string"), load_optional(spark, f"{base}/landed", LANDED)
    if seen is None:
        return 0
    pending = seen.select("path") if done is None else seen.select("path").join(done, "path", "left_anti")
    paths = sorted(r["path"] for r in pending.distinct().collect())  # file names of the drops since the last run
    if not paths:
        return 0
    rows = read_csv(spark, paths, schema)
    if rows.columns != schema.names:
        raise IngestError(f"columns of {paths[0]} are {rows.columns}, declared are {schema.names}")
    batch = max(landed_batches(spark, base), default=-1) + 1
    rows.write.mode("overwrite").parquet(f"{table_path.rstrip('/')}/{BATCH}={batch}")
    # the commit: from here on the batch counts
    spark.createDataFrame([(p, batch) for p in paths], LANDED).coalesce(1).write.mode("append").parquet(f"{base}/landed")
    return 1
