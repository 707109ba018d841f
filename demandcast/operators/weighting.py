"""Raking (iterative proportional fitting) of panel weights to margins.

Semantics:
* weights start at 1.0; in each iteration the margins are applied one after
  another (in the given order), each on the weights updated by the previous;
* for an observed category the factor is target / current weighted total;
  a category with no target gets target 0 (weight 0); a null category keeps
  its weight (factor 1); a target nobody has is ignored;
* a zeroed group with target 0 keeps factor 1; a zeroed group with a
  positive target cannot be met and raises ``InfeasibleMarginsError``;
* iteration stops when the largest |1 - factor| of an iteration is below
  ``tol``, else after ``max_iter`` iterations (the last weights are returned,
  with ``converged=False``).

Spark design: a row's weight only depends on its tuple of margin
categories, so the panel is grouped once into *cells* (one row per observed
tuple, with its row count). A cell's weight is the product of one factor per
margin, that of its category: the state of the loop is a vector of factors
per margin, and the cells, with their categories as numbers, never change.
A margin step is one aggregation of the cells, summed partially per task and
then per category, so a margin of four values is spread over all tasks; it
gives the margin's totals, and these the new factors.

Up to ``LITERAL_CATEGORIES`` categories over all margins (counted) the vectors
are held by the driver and are literals of the step's plan: a step is one job.
Beyond, they are small tables, written each step and joined to the cells, and
only the largest change and the infeasible category reach the driver.

The weights are joined back to the panel once at the end: with a broadcast
of the cells when their counted size allows it, a shuffle join otherwise.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from demandcast.schemas import MARGINALS_SCHEMA
from demandcast.session import broadcast_max_rows, resolve_checkpoint_dir

# Categories over all margins whose factors are literals of a plan.
LITERAL_CATEGORIES = 2000
CELLS_A_TASK = 100_000
EMPTY_PANEL = "a panel to rake must be non-empty"


class InfeasibleMarginsError(ValueError):
    """A positive target falls on a group whose weight was already zeroed."""


@dataclass
class RakeResult:
    weighted: DataFrame
    cells: DataFrame
    iterations: int
    max_change: float
    converged: bool
    categories: DataFrame | None = None  # (margin, category, target) of the observed categories


def marginals_frame(spark: SparkSession, marginals: Mapping[str, Mapping[object, float]]) -> DataFrame:
    """Nested ``{margin: {category: target}}`` -> long ``(margin, category, target)``."""
    rows = [
        (str(margin), None if cat is None else str(cat), None if t is None else float(t))
        for margin, targets in marginals.items()
        for cat, t in targets.items()
    ]
    return spark.createDataFrame(rows, MARGINALS_SCHEMA)


@contextmanager
def _scoped_conf(spark: SparkSession, key: str, value: str):
    """Set a SQL conf for the duration of the block, then restore it."""
    previous = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if previous is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, previous)


def _materialize(df: DataFrame, folder: str, name: str) -> DataFrame:
    """Write ``df`` to the checkpoint folder and read it back (cuts lineage)."""
    path = f"{folder}/{name}"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def _file_system(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def _remove(spark: SparkSession, folder: str) -> None:
    path, fs = _file_system(spark, folder)
    fs.delete(path, True)


def _drop_at_end(spark: SparkSession, folder: str) -> None:
    """Have the file system drop ``folder`` when the application ends."""
    path, fs = _file_system(spark, folder)
    fs.mkdirs(path)
    fs.deleteOnExit(path)


def _cell_key(i: int) -> str:
    return f"_m{i}"


def _change(target: float, current: float) -> float:
    """Factor of a category: 1 where nothing is left to scale."""
    return 1.0 if current == 0 else target / current


class _HeldFactors:
    """The factors as lists on the driver, by margin and category number."""

    def __init__(self, categories: list[list[tuple[str, float]]]):
        self.categories = categories
        self.factors = [[1.0] * len(c) for c in categories]

    def weight(self, coded: DataFrame) -> tuple[DataFrame, Column]:
        product = F.lit(1.0)
        for i, factors in enumerate(self.factors):
            # a null category keeps its weight
            product = product * (F.coalesce(F.get(F.lit(factors), F.col(_cell_key(i))), F.lit(1.0)) if factors else F.lit(1.0))
        return coded, product

    def step(self, coded: DataFrame, i: int) -> tuple[float, str | None]:
        """Apply margin ``i``; the largest change and a category that can't be met."""
        rows, weight = self.weight(coded)
        sums = rows.dropna(subset=[_cell_key(i)]).groupBy(_cell_key(i)).agg(F.sum(weight * F.col("_n")).alias("s")).collect()
        change, bad = 0.0, []
        for number, current in sums:
            category, target = self.categories[i][number]
            if current == 0 and target > 0:
                bad.append(category)
            factor = _change(target, current)
            self.factors[i][number] *= factor
            change = max(change, abs(1.0 - factor))
        return change, min(bad, default=None)


class _StoredFactors:
    """The factors as tables (number, target, category, f), a table a margin."""

    def __init__(self, tables: list[DataFrame], small: list[bool], folder: str):
        self.tables, self.small, self.folder, self.steps = tables, small, folder, [0] * len(tables)

    def weight(self, coded: DataFrame) -> tuple[DataFrame, Column]:
        rows, product = coded, F.lit(1.0)
        for i, table in enumerate(self.tables):
            f = table.select(F.col("number").alias(f"_k{i}"), F.col("f").alias(f"_f{i}"))
            rows = rows.join(F.broadcast(f) if self.small[i] else f, F.col(_cell_key(i)) == F.col(f"_k{i}"), "left").drop(f"_k{i}")
            product = product * F.coalesce(F.col(f"_f{i}"), F.lit(1.0))
        return rows, product

    def step(self, coded: DataFrame, i: int) -> tuple[float, str | None]:
        rows, weight = self.weight(coded)
        sums = rows.dropna(subset=[_cell_key(i)]).groupBy(F.col(_cell_key(i)).alias("number")).agg(F.sum(weight * F.col("_n")).alias("s"))
        factor = F.when(F.col("s") == 0, 1.0).otherwise(F.col("target") / F.col("s"))
        joined = self.tables[i].join(sums, "number")
        new = joined.select("number", "category", "target", (F.col("f") * factor).alias("f"), F.abs(1.0 - factor).alias("change"),
                            F.when((F.col("s") == 0) & (F.col("target") > 0), F.col("category")).alias("bad"))
        self.steps[i] += 1
        # two folders a margin in turn: a step reads one and overwrites the other
        new = _materialize(new, self.folder, f"factors-{i}-{'ab'[self.steps[i] % 2]}")
        row = new.agg(F.max("change"), F.min("bad")).first()
        self.tables[i] = new.drop("change", "bad")
        return float(row[0] or 0.0), row[1]


def _numbered(cells: DataFrame, keys: list[str], margins: list[str], targets: DataFrame, base: str, folder: str, limit: int):
    """(coded cells, factors, categories): the observed categories of every margin get a
    number and their target, and the cells hold the numbers."""
    named = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(m).alias("margin"), F.col(k).cast("string").alias("category")) for i, (m, k) in enumerate(zip(margins, keys))])
    seen = cells.select(F.inline(named)).dropna(subset=["category"]).distinct()
    found = _materialize(seen.join(targets, ["margin", "category"], "left"), base, "categories")
    seen = found.select("i", "category", F.coalesce("target", F.lit(0.0)).alias("target"))
    rows = seen.limit(LITERAL_CATEGORIES + 1).collect()
    coded = cells
    if len(rows) <= LITERAL_CATEGORIES:
        categories: list[list[tuple[str, float]]] = [[] for _ in keys]
        for r in sorted(rows):
            categories[r["i"]].append((r["category"], r["target"]))
        factors = _HeldFactors(categories)
        for i, (key, known) in enumerate(zip(keys, categories)):
            number = F.array_position(F.lit([c for c, _ in known]), F.col(key).cast("string")) - 1 if known else F.lit(None)
            coded = coded.withColumn(f"{key}_number", number.cast("int"))
    else:
        sizes = {r["i"]: r["count"] for r in seen.groupBy("i").count().collect()}
        tables = [seen.filter(F.col("i") == i).select(F.xxhash64("category").alias("number"), "category", "target", F.lit(1.0).alias("f")) for i in range(len(keys))]
        if any(t.select("number").distinct().count() < sizes.get(i, 0) for i, t in enumerate(tables)):
            raise ValueError("two categories of a margin have the same hash; rename one")
        factors = _StoredFactors([_materialize(t, folder, f"factors-{i}-0") for i, t in enumerate(tables)], [sizes.get(i, 0) <= limit for i in range(len(keys))], folder)
        for key in keys:
            coded = coded.withColumn(f"{key}_number", F.when(F.col(key).isNotNull(), F.xxhash64(F.col(key).cast("string"))))
    named_cells = [F.col(k).alias(f"_c{i}") for i, k in enumerate(keys)]
    return coded.select(*named_cells, *[F.col(f"{k}_number").alias(k) for k in keys], "_n"), factors, found.drop("i")


def rake(
    df: DataFrame,
    marginals: Mapping[str, Mapping[object, float]] | DataFrame,
    margins: Sequence[str] | None = None,
    max_iter: int = 50,
    tol: float = 1e-6,
    weight_col: str = "weight",
) -> RakeResult:
    """Rake ``df`` to ``marginals`` and return it with a ``weight`` column.

    ``marginals`` is a nested dict (its key order is the margin order) or a
    long frame ``(margin, category, target)`` with ``margins`` giving the
    order. Categories are matched on their text.
    """
    spark = df.sparkSession
    if isinstance(marginals, DataFrame):
        if margins is None:
            raise ValueError("margins (the application order) is required with a marginals DataFrame")
        targets = marginals
    else:
        margins = list(marginals.keys()) if margins is None else list(margins)
        targets = marginals_frame(spark, marginals)
    margins = list(margins)

    unknown = sorted(set(margins) - set(df.columns), key=margins.index)
    if (unknown or not margins) and df.isEmpty():
        raise ValueError(EMPTY_PANEL)
    if unknown:
        raise ValueError(f"cannot rake on {unknown[0]!r}: not a column of the panel")
    if not margins:  # nothing to meet: the starting weights hold
        weighted = df.withColumn(weight_col, F.lit(1.0))
        cells = df.agg(F.count(F.lit(1)).cast("double").alias("_n")).withColumn(weight_col, F.lit(1.0))
        return RakeResult(weighted, cells, 1, 0.0, True)

    base = f"{resolve_checkpoint_dir(spark).rstrip('/')}/demandcast-rake-{uuid.uuid4().hex}"
    _drop_at_end(spark, base)  # the weights are read as long as the result is
    folder = f"{base}/steps"
    keys = [_cell_key(i) for i in range(len(margins))]
    try:
        cells = _materialize(
            df.groupBy(*[F.col(f"`{m}`").alias(k) for m, k in zip(margins, keys)])
            .agg(F.count(F.lit(1)).cast("double").alias("_n")), folder, "cells")
        with _scoped_conf(spark, "spark.sql.adaptive.enabled", "false"):
            n_cells = cells.count()
        if n_cells == 0:
            raise ValueError(EMPTY_PANEL)

        # one target per (margin, category); repeated entries add up
        targets = (
            targets.select(F.col("margin").cast("string"), F.col("category").cast("string"), F.col("target").cast("double"))
            .groupBy("margin", "category").agg(F.sum("target").alias("target"))
        )
        limit = broadcast_max_rows(spark)
        iterations, max_change, converged = 0, float("nan"), False
        # the cells' size is known: no need to find the number of tasks at run time
        tasks = str(max(1, min(n_cells // CELLS_A_TASK, int(spark.conf.get("spark.sql.shuffle.partitions")))))
        with _scoped_conf(spark, "spark.sql.adaptive.enabled", "false"), _scoped_conf(spark, "spark.sql.shuffle.partitions", tasks):
            coded, factors, categories = _numbered(cells, keys, margins, targets, base, folder, limit)
            coded = _materialize(coded, folder, "coded")
            while iterations < max_iter and not converged:
                changes = []
                for i, margin in enumerate(margins):
                    change, bad = factors.step(coded, i)
                    if bad is not None:
                        raise InfeasibleMarginsError(f"{margin} = {bad}: no weight is left to meet its target")
                    changes.append(change)
                iterations, max_change = iterations + 1, max(changes)
                converged = max_change < tol
            rows, weight = factors.weight(coded)
            done = rows.select(*[F.col(f"_c{i}").alias(k) for i, k in enumerate(keys)], "_n", weight.alias("_w"))
            cells = _materialize(done, base, "weights")
    finally:
        _remove(spark, folder)

    weights = cells.select(*keys, F.col("_w").alias("_weight"))
    if n_cells <= limit:
        weights = F.broadcast(weights)
    condition = None
    for m, k in zip(margins, keys):
        term = F.col(f"`{m}`").eqNullSafe(F.col(k))
        condition = term if condition is None else condition & term
    weighted = (
        df.join(weights, condition, "inner")
        .drop(*keys)
        .withColumnRenamed("_weight", weight_col)
    )
    cell_view = cells.select(*[F.col(k).alias(m) for m, k in zip(margins, keys)], "_n", F.col("_w").alias(weight_col))
    return RakeResult(weighted, cell_view, iterations, max_change, converged, categories)


def rake_totals(result: RakeResult, marginals: DataFrame | None, margins: Sequence[str], weight_col: str = "weight") -> DataFrame:
    """Per margin category: raked total next to its target
    ``(margin, category, weighted_total, target)``. Observed categories only
    (null categories excluded), summed over the cells: the panel, which the
    cells count, is not read again. Without ``marginals`` the targets are those
    the result was raked to, as it keeps them."""
    named = F.array(*[F.struct(F.lit(m).alias("margin"), F.col(f"`{m}`").cast("string").alias("category")) for m in margins])
    totals = (
        result.cells.select(F.inline(named), (F.col(weight_col) * F.col("_n")).alias("_part"))
        .dropna(subset=["category"]).groupBy("margin", "category").agg(F.sum("_part").alias("weighted_total"))
    )
    targets = result.categories if marginals is None else marginals.groupBy("margin", "category").agg(F.sum("target").alias("target"))
    return totals.join(targets, ["margin", "category"], "left")
