"""Forecast accuracy: WAPE and pinball (quantile) loss, global or grouped.

Errors are summed in fixed point where they fit (see
``demandcast.functions.numeric``), so a score does not depend on how the
pairs are partitioned or in which order partial sums are merged; other
numbers are summed as doubles. A missing number (null or NaN) on either side
makes the score NaN, an infinite error makes it infinite.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandcast.functions.numeric import SCALE, TOLERANCE, banded, banded_total, decimal_places, fraction_literal, to_fixed
from demandcast.schemas import QUANTILES, qcol, qname

WAPE_FLOOR = 1e-9
_NAN = float("nan")


def _error(actual: Column, forecast: Column) -> tuple[Column, Column]:
    """actual - forecast as a double, and as a decimal where the difference of
    the two decimals is that double but for its last bits: two numbers that
    agree to twelve places are not taken for equal."""
    fixed = to_fixed(actual) - to_fixed(forecast)
    plain = actual.cast("double") - forecast.cast("double")
    # the difference of doubles is exact to the last bits of the operands
    slack = F.greatest(F.abs(actual.cast("double")), F.abs(forecast.cast("double"))) * TOLERANCE
    exact = fixed.cast("double") == plain
    return F.when(exact | (F.abs(fixed.cast("double") - plain) <= slack) & (F.abs(plain) > slack * 1024), fixed), plain


class _Scores:
    """Sums over pairs of numbers: the errors are prepared row by row in a
    selection, so that the aggregation only adds up."""

    def __init__(self, actual: str):
        self.actual = F.col(actual)
        self.columns: list[Column] = []

    def _add(self, name: str, fixed: Column, plain: Column) -> str:
        self.columns += banded(name, fixed, plain)
        return name

    def _lacks(self, name: str, forecast: Column) -> Column:
        """Aggregate: whether some row lacks a number (null or NaN)."""
        lack = (self.actual.isNull() | F.isnan(self.actual.cast("double")) | forecast.isNull() | F.isnan(forecast.cast("double"))).cast("int")
        self.columns.append(lack.alias(f"{name}_lack"))
        return F.max(f"{name}_lack") == 1

    def wape(self, name: str, forecast: str) -> Column:
        """sum|y - yhat| / max(sum|y|, 1e-9); empty input -> 0."""
        fixed, plain = _error(self.actual, qcol(forecast))
        num = banded_total(self._add(f"_{name}_e", F.abs(fixed), F.abs(plain)))
        den = banded_total(self._add(f"_{name}_y", F.abs(to_fixed(self.actual)), F.abs(self.actual.cast("double"))))
        return F.when(self._lacks(f"_{name}", qcol(forecast)), F.lit(_NAN)).otherwise(num / F.greatest(den, F.lit(WAPE_FLOOR))).alias(name)

    def pinball(self, name: str, forecast: str, q: float) -> Column:
        """mean(max(q*e, (q-1)*e)), e = y - yhat; empty input -> null."""
        fixed, plain = _error(self.actual, qcol(forecast))
        rest = float(q) - 1.0
        above, _ = fraction_literal(q)
        below, _ = fraction_literal(round(rest, decimal_places(q)))
        label = f"_{name.replace('.', '_')}"
        total = banded_total(self._add(label, F.greatest(above * fixed, below * fixed), F.greatest(F.lit(float(q)) * plain, F.lit(rest) * plain)))
        self.columns.append(plain.isNotNull().cast("long").alias(f"{label}_n"))
        mean = F.try_divide(total, F.sum(f"{label}_n").cast("double"))
        return F.when(self._lacks(label, qcol(forecast)), F.lit(_NAN)).otherwise(mean).alias(name)

    def share(self, name: str, held: Column) -> Column:
        """Share of rows where ``held``."""
        self.columns.append(held.cast("int").cast("double").alias(f"_{name.replace('.', '_')}_held"))
        return F.avg(f"_{name.replace('.', '_')}_held").alias(name)

    def over(self, pairs: DataFrame, by: Sequence[str], scores: Sequence[Column]) -> DataFrame:
        ready = pairs.select(*by, *self.columns)
        return (ready.groupBy(*by) if by else ready).agg(*scores)


def wape(
    pairs: DataFrame,
    actual: str = "actual",
    forecast: str = "q0.5",
    by: Sequence[str] = (),
) -> DataFrame:
    """WAPE over all rows, or per group of ``by`` (partial sums per task)."""
    scores = _Scores(actual)
    return scores.over(pairs, by, [scores.wape("wape", forecast)])


def pinball_loss(
    pairs: DataFrame,
    quantiles: Sequence[float] = QUANTILES,
    actual: str = "actual",
    by: Sequence[str] = (),
) -> DataFrame:
    """Long table ``(*by, quantile, pinball_loss)``: the forecast of quantile
    q is read from column ``q<q>``. One aggregation pass for all quantiles."""
    scores = _Scores(actual)
    agg = scores.over(pairs, by, [scores.pinball(f"_loss{i}", qname(q), q) for i, q in enumerate(quantiles)])
    rows = F.array(*[
        F.struct(F.lit(float(q)).alias("quantile"), F.col(f"_loss{i}").alias("pinball_loss"))
        for i, q in enumerate(quantiles)
    ])
    return agg.select(*by, F.inline(rows))


def score_by_series(
    pairs: DataFrame,
    quantiles: Sequence[float] = QUANTILES,
    actual: str = "actual",
    keys: Sequence[str] = ("sku", "region"),
) -> DataFrame:
    """Per series: scored weeks, WAPE of the median and one pinball column
    per quantile (``pinball_q0.1`` ...)."""
    scores = _Scores(actual)
    exprs = [F.count(F.lit(1)).alias("n_weeks"), scores.wape("wape", "q0.5")]
    exprs += [scores.pinball(f"pinball_{qname(q)}", qname(q), q) for q in quantiles]
    return scores.over(pairs, keys, exprs)


def score_by_cutoff(pairs: DataFrame, quantiles: Sequence[float] = QUANTILES, actual: str = "actual", by: Sequence[str] = ("cutoff",)) -> DataFrame:
    """Per cutoff: scored weeks, WAPE of the median, a pinball column per
    quantile, the share of actuals at or below each quantile, and the share
    inside the widest interval."""
    y, low, high = F.col(actual), qcol(qname(min(quantiles))), qcol(qname(max(quantiles)))
    scores = _Scores(actual)
    exprs = [F.count(F.lit(1)).alias("n_weeks"), scores.wape("wape", "q0.5")]
    exprs += [scores.pinball(f"pinball_{qname(q)}", qname(q), q) for q in quantiles]
    exprs += [scores.share(f"below_{qname(q)}", y <= qcol(qname(q))) for q in quantiles]
    return scores.over(pairs, by, [*exprs, scores.share("coverage", (low <= y) & (y <= high))])


__all__ = ["SCALE", "pinball_loss", "score_by_cutoff", "score_by_series", "wape"]
