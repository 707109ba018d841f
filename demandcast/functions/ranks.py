"""Exact quantiles by rank, without a group's values meeting in one task.

Values are counted per group first, so copies weigh nothing. The distinct values
of a group then fall into buckets that follow the values' order (sixteen an
octave, the same for all data, so nothing is sampled or kept between jobs): the
counts of the buckets before give a bucket its first rank, and within a bucket
counts are summed up in order. A quantile is read off the two values whose ranks
enclose its position, with linear interpolation.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKETS_AN_OCTAVE = 16


def order_bucket(value: Column) -> Column:
    """A whole number that never falls as ``value`` (a double) grows; at most
    some 70,000 different ones."""
    size = F.floor(F.log2(F.abs(value)) * BUCKETS_AN_OCTAVE).cast("long") + 20_000
    far = F.lit(60_000).cast("long")
    size = F.when(F.isnan(value) | (F.abs(value) == F.lit(float("inf"))), far).otherwise(size)
    return F.when(value == 0, F.lit(0).cast("long")).when(value < 0, -size).otherwise(size)


def place(low: Column, high: Column, position: Column) -> Column:
    """Value at a fractional position between the values at its two ranks."""
    part = position - F.floor(position)
    return F.when(low == high, low).otherwise((F.lit(1.0) - part) * low + part * high)


def interpolated(value: Column, first: Column, last: Column, total: Column, q: float) -> Column:
    """Aggregate: the q-quantile of a group whose rows hold ``value`` at the
    ranks ``first``..``last`` (from 0) of ``total``."""
    position = F.lit(float(q)) * (total - 1)
    at = [F.max(F.when((first <= p) & (p <= last), value)) for p in (F.floor(position), F.ceil(position))]
    return place(at[0], at[1], F.max(position))


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join on ``keys``, null matching null; the left side's keys stay. Unlike an
    equi-join it adds no not-null filter to either side, so that two readers of
    a table still share its exchange."""
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    condition = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys])
    return left.join(renamed, condition, how).drop(*[f"_r_{k}" for k in keys])


def whole_quantiles(counts: DataFrame, keys: Sequence[str], value: str, n: str, quantiles: Sequence[float], names: Sequence[str]) -> DataFrame:
    """As :func:`counted_quantiles`, for groups that each fit in a task: one
    exchange by group, and no join. A value may come in several rows."""
    group = Window.partitionBy(*keys)
    so_far = group.orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = counts.select(*keys, value, n, (F.sum(n).over(so_far) - 1).alias("_last"), F.sum(n).over(group).alias("_total"))
    first = F.col("_last") - F.col(n) + 1
    return ranked.groupBy(*keys).agg(*[
        interpolated(F.col(value), first, F.col("_last"), F.col("_total"), q).alias(name) for q, name in zip(quantiles, names)])


def counted_quantiles(counts: DataFrame, keys: Sequence[str], value: str, n: str, quantiles: Sequence[float], names: Sequence[str]) -> DataFrame:
    """(keys, names): exact quantiles of ``value`` (double, not null) weighted by
    ``n``; ``counts`` holds a row per group and distinct value."""
    # dealt by bucket once: its total and its ranks are made from the same exchange
    rows = counts.withColumn("_bucket", order_bucket(F.col(value))).repartition(*keys, "_bucket")
    buckets = rows.groupBy(*keys, "_bucket").agg(F.sum(n).alias("_in"))
    so_far, whole = Window.partitionBy(*keys).orderBy("_bucket"), Window.partitionBy(*keys)
    ahead = buckets.select(*keys, "_bucket", (F.sum("_in").over(so_far) - F.col("_in")).alias("_ahead"), F.sum("_in").over(whole).alias("_total"))
    within = Window.partitionBy(*keys, "_bucket").orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = join_null_safe(rows, ahead, [*keys, "_bucket"], "inner").select(
        *keys, value, "_total", (F.col("_ahead") + F.sum(n).over(within) - 1).alias("_last"), F.col(n).alias("_n"))
    first = F.col("_last") - F.col("_n") + 1
    return ranked.groupBy(*keys).agg(*[
        interpolated(F.col(value), first, F.col("_last"), F.col("_total"), q).alias(name) for q, name in zip(quantiles, names)])
