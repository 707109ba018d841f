"""Order-independent sums and means of any magnitude.

Floating-point sums depend on the order in which partial aggregates are
merged, so the same query can differ in the last bits between runs or
partitionings. A value that a decimal of ``SCALE`` places holds to within the
last bits of a double is therefore summed as that decimal, exactly, and
converted to double once.

Every other value is scaled by a power of two into [1, 2^40), exactly, and
summed as a decimal there: one sum for each band of forty binary orders. Decimal
sums have no order, and the few bands are added up smallest first, so these
sums do not depend on the partitioning either, nor is a small value rounded
away beside a large one. The bands reach from 2^-80 to 2^120 (about 1e-24 to
1e36); values beyond, infinite ones and NaN are summed as doubles beside them.
"""

from __future__ import annotations

from decimal import Decimal

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SCALE = 12
PRECISION = 28  # leaves ten digits for the sum
TOLERANCE = 2.0**-50  # a few last bits of a double
BAND_BITS = 40
BANDS = range(-2, 3)
BAND_TYPE = "decimal(31,16)"  # 2^40 and the 17 digits of a double


def fits(fixed: Column, plain: Column) -> Column:
    """Whether ``fixed`` is ``plain`` but for its last bits."""
    return F.abs(fixed.cast("double") - plain) <= F.abs(plain) * TOLERANCE


def to_fixed(c: Column, scale: int = SCALE, precision: int = PRECISION) -> Column:
    """``c`` as a decimal, null where it does not fit (see the module)."""
    fixed = c.try_cast(f"decimal({precision},{scale})")
    return F.when(fits(fixed, c.cast("double")), fixed)


def banded(name: str, fixed: Column, plain: Column) -> list[Column]:
    """Columns of a measure for :func:`banded_total`, to be selected before the
    aggregation: the decimal, and for a value without one its band and its
    scaled decimal, or the value itself beyond the bands."""
    rest = F.when(fixed.isNull(), plain.cast("double"))
    size = F.abs(rest)
    band = F.when((size > 0) & (size < F.lit(float("inf"))), F.floor(F.log2(size) / BAND_BITS)).cast("int")
    inside = F.coalesce(band.between(BANDS[0], BANDS[-1]), F.lit(False))
    scaled = F.when(inside, (rest * F.pow(F.lit(2.0), -BAND_BITS * band)).cast(BAND_TYPE))
    return [fixed.alias(f"{name}_fixed"), band.alias(f"{name}_band"), scaled.alias(f"{name}_scaled"), F.when(~inside, rest).alias(f"{name}_far")]


def banded_total(name: str) -> Column:
    """Aggregate: the sum of a measure prepared by :func:`banded` (0 if none)."""
    total = F.coalesce(F.sum(f"{name}_far"), F.lit(0.0))
    for i in BANDS:
        total = total + F.coalesce(F.sum(F.when(F.col(f"{name}_band") == i, F.col(f"{name}_scaled"))).cast("double"), F.lit(0.0)) * F.lit(2.0 ** (BAND_BITS * i))
    return F.coalesce(F.sum(f"{name}_fixed").cast("double"), F.lit(0.0)) + total


def skip_nan(c: Column) -> Column:
    """``c`` with NaN as null, for operators that skip missing numbers."""
    return F.when(~F.isnan(c.cast("double")), c)


def _is_exact(dtype: T.DataType | None) -> bool:
    """Whether every value of the type is a decimal of ``SCALE`` places."""
    if isinstance(dtype, T.DecimalType):
        return dtype.scale <= SCALE and dtype.precision - dtype.scale <= PRECISION - SCALE
    return isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType))


def fixed_sums(df: DataFrame, by: Sequence[str], values: dict[str, Column], aggregates: Sequence[Column] = (), keep: Sequence[str] = ()) -> DataFrame:
    """Group by ``by`` (all rows if none): per entry of ``values`` its sum and
    count of non-null values as ``<name>_sum`` (null when there are none) and
    ``<name>_n``, beside other ``aggregates`` over the columns ``keep``."""
    types = df.select(*[c.alias(n) for n, c in values.items()]).schema
    columns, sums = [], []
    for name, c in values.items():
        n = F.count(f"_v_{name}")
        if _is_exact(types[name].dataType):
            columns.append(c.cast(f"decimal({PRECISION},{SCALE})").alias(f"_v_{name}"))
            sums += [F.sum(f"_v_{name}").cast("double").alias(f"{name}_sum"), n.alias(f"{name}_n")]
        else:
            columns += [c.alias(f"_v_{name}"), *banded(f"_v_{name}", to_fixed(c), c)]
            sums += [F.when(n > 0, banded_total(f"_v_{name}")).alias(f"{name}_sum"), n.alias(f"{name}_n")]
    ready = df.select(*by, *keep, *columns)
    return (ready.groupBy(*by) if by else ready).agg(*sums, *aggregates)


def decimal_places(x: float) -> int:
    """Number of decimals of the shortest text of ``x`` (0.025 -> 3)."""
    return max(0, -Decimal(repr(float(x))).as_tuple().exponent)


def fraction_literal(x: float) -> tuple[Column, str]:
    """Exact decimal literal of a fraction |x| < 10, as Column and its type."""
    places = decimal_places(x)
    dtype = f"decimal({places + 2},{places})"
    return F.lit(repr(float(x))).cast(dtype), dtype
