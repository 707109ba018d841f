"""CSV landing, Parquet artefacts and optional loads.

CSV columns are matched by *name*: the header is read as text first, the
column contract is checked, then each declared column is cast to its type
(ANSI casts fail the job on malformed values). Only empty fields are null,
so codes such as ``NA`` survive. Artefacts are Parquet directories.
"""

from __future__ import annotations

import logging
from collections.abc import Sequence

from py4j.protocol import Py4JError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandcast.operators.checks import check_required_columns
from demandcast.schemas import CREDIT_COLUMNS, CREDIT_SCHEMA, PANEL_COLUMNS, PANEL_SCHEMA
from demandcast.sources import quoted_csv

logger = logging.getLogger(__name__)

# Artefact names of the pipeline.
CREDIT_TABLE = "credit_txn"
PANEL_TABLE = "panel"
DEMOGRAPHICS_TABLE = "demographics"
LINKED_TABLE = "linked_panel_credit"
PANEL_WEIGHTED_TABLE = "panel_weighted"
FEATURES_TABLE = "features"
FORECAST_LGB_TABLE = "forecast_lgb"
FORECAST_DEEPAR_TABLE = "forecast_deepar"
FORECAST_ENSEMBLE_TABLE = "forecast_ensemble"


# One CSV dialect for every reader: a quote inside a quoted field is doubled.
DIALECT = {"quote": '"', "escape": '"'}


class IngestError(Exception):
    """Reading, validating or writing a landing file failed."""


def _condition(err: Exception) -> str | None:
    getter = getattr(err, "getCondition", None) or getattr(err, "getErrorClass", None)
    try:
        return getter() if getter else None
    except Exception:  # pragma: no cover - defensive
        return None


def artefact_path(directory: str, name: str) -> str:
    return f"{directory.rstrip('/')}/{name}.parquet"


def header_of(spark: SparkSession, path: str) -> list[str]:
    """Column names of a CSV file, or of the first one of a folder: its first
    record alone is read."""
    try:
        names = spark.read.options(**DIALECT).option("header", True).option("inferSchema", False).option("multiLine", True).csv(path).columns
    except AnalysisException as err:
        if _condition(err) == "PATH_NOT_FOUND" or "PATH_NOT_FOUND" in str(err):
            # Fixed value: callers match "File not found".
            raise IngestError(f"File not found, so nothing was read: {path}") from None
        if "Permission denied" in str(err):
            raise IngestError(f"no permission to read {path}") from None
        raise
    if not names:
        raise IngestError(f"no header in {path}")
    return names


def check_header(spark: SparkSession, path: str, columns: Sequence[str], name: str) -> None:
    """The column contract of a CSV, without reading its rows."""
    layout = T.StructType([T.StructField(c, T.StringType()) for c in header_of(spark, path)])
    check_required_columns(spark.createDataFrame([], layout), columns, name)


def read_csv(spark: SparkSession, path: str | Sequence[str], schema: T.StructType | None = None, line_breaks: bool = True) -> DataFrame:
    """Read a headered CSV; declared columns are cast by name, others stay text.

    Quoted fields may hold doubled quotes and line breaks. Files are read in
    splits in either case: a first pass counts quotes per split, and only if
    some record goes over a line break are the lines joined again (see
    ``demandcast.sources.quoted_csv``). ``line_breaks=False`` saves the pass
    for files known to have none. Every file of a folder must have the same
    header: one with other columns, or in another order, fails the job.
    """
    paths = path if isinstance(path, str) else list(path)
    names = header_of(spark, paths if isinstance(paths, str) else paths[0])
    raw = quoted_csv.read_quoted(spark, paths, names, DIALECT) if line_breaks else None
    if raw is None:
        as_text = T.StructType([T.StructField(c, T.StringType()) for c in names])
        reader = spark.read.options(**DIALECT).option("header", True).option("mode", "FAILFAST").option("enforceSchema", False)
        raw = reader.schema(as_text).csv(paths)
    if schema is None:
        return raw
    types = {f.name: f.dataType for f in schema.fields}
    return raw.select(*[
        (F.col(f"`{c}`").cast(types[c]) if c in types else F.col(f"`{c}`")).alias(c) for c in raw.columns
    ])


def write_parquet(df: DataFrame, directory: str, name: str, mode: str = "overwrite") -> str:
    out = artefact_path(directory, name)
    try:
        df.write.mode(mode).parquet(out)
    except Exception as err:
        if "Permission denied" in str(err):
            raise IngestError(f"no permission to write {out}") from None
        raise IngestError(f"writing {out} did not succeed: {err}") from err
    return out


def load_optional(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame | None:
    """Parquet at ``path`` (an empty folder has rows only of a given
    ``schema``), or None when it does not exist (or is not
    readable: logged). Any other error propagates."""
    try:
        return (spark.read.schema(schema) if schema else spark.read).parquet(path)
    except AnalysisException as err:
        if _condition(err) == "PATH_NOT_FOUND" or "PATH_NOT_FOUND" in str(err):
            return None
        if "Permission denied" in str(err):
            logger.warning("skipped, no permission: %s", path)
            return None
        raise


def first_available(spark: SparkSession, paths: Sequence[str]) -> tuple[str, DataFrame]:
    """First path that loads; ``FileNotFoundError`` when none does."""
    for path in paths:
        df = load_optional(spark, path)
        if df is not None:
            return path, df
    raise FileNotFoundError(f"none of these forecasts exists: {', '.join(paths)}")


def load_forecast_for_serving(spark: SparkSession, feature_dir: str) -> DataFrame:
    """Ensemble forecast, else the LGB slot."""
    _, df = first_available(
        spark, [artefact_path(feature_dir, FORECAST_ENSEMBLE_TABLE), artefact_path(feature_dir, FORECAST_LGB_TABLE)]
    )
    return df


def _tolerant(spark: SparkSession, path: str) -> DataFrame | None:
    """Parquet at ``path``; None, with a warning, when it cannot be read.

    A footer that cannot be read shows when the schema is inferred, which
    ``spark.read.parquet`` does at once."""
    try:
        return load_optional(spark, path)
    except (PySparkException, Py4JError) as err:
        logger.warning("skipped, unreadable: %s (%s)", path, str(err).partition("\n")[0])
        return None


def load_tables(spark: SparkSession, landing_dir: str, feature_dir: str) -> dict[str, DataFrame] | None:
    """Dashboard bundle: the three landing tables are required (None if any
    is missing or unreadable); features and forecasts are added if readable."""
    required = {"credit": CREDIT_TABLE, "panel": PANEL_TABLE, "linked": LINKED_TABLE}
    optional = {"features": FEATURES_TABLE, "forecast_ensemble": FORECAST_ENSEMBLE_TABLE, "forecast_deepar": FORECAST_DEEPAR_TABLE}
    data = {key: _tolerant(spark, artefact_path(landing_dir, name)) for key, name in required.items()}
    if any(df is None for df in data.values()):
        return None
    found = {key: _tolerant(spark, artefact_path(feature_dir, name)) for key, name in optional.items()}
    return data | {key: df for key, df in found.items() if df is not None}


def ingest(
    spark: SparkSession,
    credit_csv: str,
    panel_csv: str,
    landing_dir: str,
    demo_csv: str | None = None,
) -> dict[str, str]:
    """Land credit and panel CSVs (and optional demographics) as Parquet.

    Both contracts are checked before anything is written, so a bad panel
    file leaves no half-landed credit table behind.
    """
    credit = read_csv(spark, credit_csv, CREDIT_SCHEMA)
    check_required_columns(credit, CREDIT_COLUMNS, "credit_csv")
    panel = read_csv(spark, panel_csv, PANEL_SCHEMA)
    check_required_columns(panel, PANEL_COLUMNS, "panel_csv")
    demo = read_csv(spark, demo_csv) if demo_csv else None

    written = {
        CREDIT_TABLE: write_parquet(credit, landing_dir, CREDIT_TABLE),
        PANEL_TABLE: write_parquet(panel, landing_dir, PANEL_TABLE),
    }
    if demo is not None:
        written[DEMOGRAPHICS_TABLE] = write_parquet(demo, landing_dir, DEMOGRAPHICS_TABLE)
    return written
