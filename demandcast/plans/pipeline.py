"""The weekly pipeline: ingest -> link -> rake -> features -> producers -> ensemble.

One driver function runs the stages in order inside a single session. Each
stage reads the previous stage's Parquet artefact and writes its own, with a
manifest as commit mark, so a stage boundary is also a lineage cut (a lost
executor costs at most the current stage) and a failed run resumes. Raking does not feed the
features (the weights are an artefact of their own), so it is optional.
"""

from __future__ import annotations

import hashlib
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from demandcast.functions.hashing import DEFAULT_SALT
from demandcast.operators.ensemble import ensemble
from demandcast.operators.features import build_features
from demandcast.operators.forecast import naive_quantile_forecast
from demandcast.operators.linking import link_panel_credit
from demandcast.operators.regression import InsufficientHistoryError, regression_quantile_forecast
from demandcast.operators.weighting import RakeResult, rake
from demandcast.plans.stages import StageStore
from demandcast.schemas import CREDIT_COLUMNS, CREDIT_SCHEMA, DEFAULT_HORIZON_WEEKS, FORECAST_KEYS, PANEL_COLUMNS, PANEL_SCHEMA
from demandcast.sources import files as io


@dataclass
class PipelineRun:
    """Where the artefacts are, which stages this run did and which it found
    done, and what the stages noted."""

    paths: dict[str, str] = field(default_factory=dict)
    rake: RakeResult | None = None  # None where the weights were found done
    skipped: dict[str, str] = field(default_factory=dict)
    done: list[str] = field(default_factory=list)
    reused: list[str] = field(default_factory=list)
    rows: dict[str, int] = field(default_factory=dict)
    notes: dict[str, dict] = field(default_factory=dict)


class _Stages:
    """The artefact stages of a run, in the landing and the feature folder."""

    def __init__(self, spark: SparkSession, run: PipelineRun, resume: bool):
        self.spark, self.run, self.resume = spark, run, resume

    def __call__(self, folder: str, name: str, inputs: Sequence[str], parameters: Mapping, build) -> DataFrame:
        store = StageStore(self.spark, folder)
        if not self.resume:
            store.forget(name)
        table = store.run(name, inputs, parameters, build, lambda df, _: io.write_parquet(df, folder, name))
        known = store.manifest(name)
        self.run.paths[name] = store.path(name)
        self.run.done += store.done
        self.run.reused += store.reused
        self.run.rows[name] = known["rows"]
        self.run.notes[name] = known["notes"]
        return table


# A customer with this share of the transactions, and this many, is spread over
# tasks when the pipeline links, with or without adaptive execution.
HOT_KEY_SUPPORT, HOT_KEY_ROWS = 0.01, 100_000


def link_stored(panel: DataFrame, credit: DataFrame, salt: str | bytes) -> DataFrame:
    """The link of stored tables: the transactions' ids are sketched first."""
    return link_panel_credit(panel, credit, salt, hot_key_support=HOT_KEY_SUPPORT, hot_key_rows=HOT_KEY_ROWS)


def _digest(value) -> str:
    """A parameter that is long, or must not be written down, as a digest."""
    return hashlib.sha256(repr(value).encode()).hexdigest()


def forecast_slots(
    features: DataFrame, horizon: int = DEFAULT_HORIZON_WEEKS, use_regression: bool = True, tasks: int | None = None, stored: bool = False
) -> tuple[DataFrame | None, DataFrame]:
    """The two producer slots over one feature table: the regression model
    in the "lgb" slot (optional), the naive forecaster in the "deepar" slot.
    ``tasks`` and ``stored`` are as in ``regression_quantile_forecast``. Two slots
    are left dealt by series, for a blend by series."""
    deepar = naive_quantile_forecast(features, horizon=horizon, suffix="_deepar", tasks=tasks, by_series=use_regression)
    lgb = regression_quantile_forecast(features, horizon=horizon, tasks=tasks, stored=stored, by_series=True).forecast if use_regression else None
    return lgb, deepar


def forecast_from_features(
    features: DataFrame, horizon: int = DEFAULT_HORIZON_WEEKS, use_regression: bool = True, tasks: int | None = None, stored: bool = False
) -> DataFrame:
    lgb, deepar = forecast_slots(features, horizon, use_regression, tasks, stored)
    return ensemble(lgb, deepar, by_series=True)


def run_pipeline(
    spark: SparkSession,
    credit_csv: str,
    panel_csv: str,
    landing_dir: str,
    feature_dir: str,
    marginals: Mapping[str, Mapping[object, float]] | DataFrame | None = None,
    margins: list[str] | None = None,
    horizon: int = DEFAULT_HORIZON_WEEKS,
    salt: str | bytes = DEFAULT_SALT,
    demo_csv: str | None = None,
    use_regression: bool = True,
    without_history: str = "fail",
    resume: bool = True,
) -> PipelineRun:
    """Run all stages. With too little history for the regression slot,
    ``without_history`` decides: "fail" raises, "naive" serves the naive slot
    alone, which then passes through with full weight, and records it.

    Every stage commits a manifest (``demandcast.plans.stages``), so a run
    after a failure goes on where the failed one stopped: finished stages whose
    inputs and parameters are the same are reused, half-written ones are done
    anew. ``resume=False`` does every stage anew."""
    if without_history not in ("fail", "naive"):
        raise ValueError("without_history must be 'fail' or 'naive'")
    run = PipelineRun()
    stage = _Stages(spark, run, resume)

    # both contracts hold before anything is written
    sources = {io.CREDIT_TABLE: (credit_csv, CREDIT_SCHEMA, CREDIT_COLUMNS, "credit_csv"), io.PANEL_TABLE: (panel_csv, PANEL_SCHEMA, PANEL_COLUMNS, "panel_csv")}
    for path, _, columns, label in sources.values():
        io.check_header(spark, path, columns, label)
    landed = {name: stage(landing_dir, name, [path], {}, lambda p=path, s=schema: io.read_csv(spark, p, s)) for name, (path, schema, _, _) in sources.items()}
    if demo_csv:
        stage(landing_dir, io.DEMOGRAPHICS_TABLE, [demo_csv], {}, lambda: io.read_csv(spark, demo_csv))
    credit, panel = landed[io.CREDIT_TABLE], landed[io.PANEL_TABLE]

    linked = stage(landing_dir, io.LINKED_TABLE, [run.paths[io.PANEL_TABLE], run.paths[io.CREDIT_TABLE]], {"salt": _digest(salt)},
                   lambda: link_stored(panel, credit, salt))

    if marginals is not None:
        def weights():
            run.rake = rake(panel, marginals, margins=margins)
            return run.rake.weighted, {"iterations": run.rake.iterations, "max_change": run.rake.max_change, "converged": run.rake.converged}

        wanted = _digest(sorted(map(repr, marginals.collect())) if isinstance(marginals, DataFrame) else marginals)
        stage(landing_dir, io.PANEL_WEIGHTED_TABLE, [run.paths[io.PANEL_TABLE]], {"marginals": wanted, "margins": margins}, weights)

    # sorted by series, as forecasts are, so that a (sku, region) filter skips row groups
    features = stage(feature_dir, io.FEATURES_TABLE, [run.paths[io.LINKED_TABLE]], {},
                     lambda: build_features(linked).sortWithinPartitions("sku", "region", "week"))
    forecast_stages(stage, features, feature_dir, horizon, use_regression, without_history)
    return run


def forecast_stages(stage: _Stages, features: DataFrame, feature_dir: str, horizon: int, use_regression: bool, without_history: str) -> DataFrame:
    """The producer slots over the stored features, and their blend."""
    run = stage.run
    source, parameters = [run.paths[io.FEATURES_TABLE]], {"horizon": horizon}
    lgb = None
    if use_regression:
        fitted: list = []  # released once the slot is written
        try:
            def fit():
                fitted.append(regression_quantile_forecast(features, horizon=horizon, stored=True))
                return fitted[0].forecast

            lgb = stage(feature_dir, io.FORECAST_LGB_TABLE, source, parameters, fit)
        except InsufficientHistoryError as err:
            if without_history == "fail":
                raise
            run.skipped[io.FORECAST_LGB_TABLE] = str(err)
        finally:
            for f in fitted:
                f.release()
    deepar = stage(feature_dir, io.FORECAST_DEEPAR_TABLE, source, parameters, lambda: naive_quantile_forecast(features, horizon=horizon, suffix="_deepar"))
    slots = [run.paths[n] for n in (io.FORECAST_LGB_TABLE, io.FORECAST_DEEPAR_TABLE) if n in run.paths]
    return stage(feature_dir, io.FORECAST_ENSEMBLE_TABLE, slots, {"slots": len(slots)},
                 lambda: ensemble(lgb, deepar).sortWithinPartitions(*FORECAST_KEYS))
