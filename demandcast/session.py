"""Session helper and checkpoint-directory resolution."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings the operators rely on. They are applied only when a session is
# created here; an existing cluster session keeps its own values.
SESSION_DEFAULTS = {
    # Calendar logic is written TZ-free (timestamp_ntz / date), but report
    # formatting of instants is pinned to UTC.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # HMAC key pads are 64-byte literals (128 hex chars): keep them out of
    # explain output.
    "spark.sql.redaction.string.regex": "(?i)[0-9a-f]{128}",
}


def get_session(
    app_name: str = "demandcast",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in SESSION_DEFAULTS.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def resolve_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory of the session.

    The cluster names a shared folder in ``spark.checkpoint.dir``; that wins.
    Only a local-mode session (tests, laptop runs) without one gets a fresh
    temporary folder. On a cluster without the setting this raises rather
    than checkpoint to an executor-local disk.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="demandcast-ckpt-"))
        return sc.getCheckpointDir()
    raise RuntimeError(
        "spark.checkpoint.dir is not set; iterative operators need a shared "
        "checkpoint folder on a cluster"
    )


BROADCAST_MAX_ROWS_KEY = "spark.demandcast.broadcastMaxRows"
DEFAULT_BROADCAST_MAX_ROWS = 1_000_000


def broadcast_max_rows(spark: SparkSession) -> int:
    """Largest counted row count of a table this package broadcasts
    (``spark.demandcast.broadcastMaxRows``; ~100 bytes/row -> ~100 MB).
    Beyond it joins stay shuffle joins; -1 never broadcasts."""
    return int(spark.conf.get(BROADCAST_MAX_ROWS_KEY, str(DEFAULT_BROADCAST_MAX_ROWS)))
