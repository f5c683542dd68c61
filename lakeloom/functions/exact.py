"""Exact money arithmetic.

Amounts arrive as doubles. A sum of doubles depends on the order of addition, hence
on partitioning, so amounts are turned into whole units of their last digit before
they are summed. The caller names the scale, the number of digits after the point.
A value with more digits than that is not rounded away but raises an error. Units fit
a 64-bit decimal, which Spark adds several times faster than the result of a cast from
double to decimal.

There is one rounding rule, half away from zero in the arithmetic of doubles; it takes
away what the last bits of a double add to its digits.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A double's digits beyond the scale may differ from zero by so much, in units.
_NOISE = 1e-3


def _col(column: str | Column) -> Column:
    return F.col(column) if isinstance(column, str) else column


def _whole(value: Column, scale: int) -> Column:
    """The nearest whole number of units, as a long. What is no number of that size gives
    the largest one, which is not near the value."""
    size = F.floor(F.abs(value) * float(10**scale) + 0.5)
    return F.when(value < 0, -size).otherwise(size)


def amount(column: str | Column, scale: int = 2) -> Column:
    """A double rounded to ``decimal(18, scale)``: for keys and output."""
    value = _col(column).cast("double")
    return (_whole(value, scale).cast("double") / float(10**scale)).cast(f"decimal(18,{scale})")


def _exact(value: Column, whole: Column, scale: int) -> Column:
    # Doubles near 1e15 units have no digits to spare, so the bound grows with the value.
    return F.abs(value * float(10**scale) - whole) <= _NOISE + F.abs(whole.cast("double")) * 1e-12


def units(column: str | Column, scale: int) -> Column:
    """A double as a whole number of ``10 ** -scale``, for exact sums of any length. A
    value with more than ``scale`` digits after the point raises an error."""
    value = _col(column)
    whole = _whole(value, scale)
    refused = F.raise_error(F.concat(F.lit(f"more than {scale} digits after the point: "), value.cast("string")))
    return F.when(value.isNull() | _exact(value, whole, scale), whole.cast("decimal(18,0)")).otherwise(refused.cast("decimal(18,0)"))


def from_units(summed: Column, scale: int) -> Column:
    """A sum of units as double."""
    return summed.cast("double") / float(10**scale)


def total(column: str | Column, scale: int) -> Column:
    """Exact sum of a double column with at most ``scale`` digits after the point, returned
    as double. NaN and infinities count as they do in a plain sum.

    Whether all values fit is one more aggregate and looked at once for each group, not a
    branch for each row: 0 all do, 1 one is no number, 2 one has more digits."""
    value = _col(column).cast("double")
    whole = _whole(value, scale)
    special = F.isnan(value) | (F.abs(value) == float("inf"))
    worst = F.max(F.when(value.isNull() | _exact(value, whole, scale), 0).when(special, 1).otherwise(2))
    fitting = F.when(F.abs(whole.cast("double")) < 1e18, whole).otherwise(0)
    exact = from_units(F.sum(fitting.cast("decimal(18,0)")), scale)
    refused = F.raise_error(F.concat(F.lit(f"more than {scale} digits after the point among values up to "), F.max(F.abs(value)).cast("string"))).cast("double")
    return F.when(worst == 0, exact).when(worst == 1, F.sum(value)).when(worst == 2, refused)


def mean(column: str | Column, scale: int) -> Column:
    """Mean from the exact sum, so it does not depend on partitioning."""
    return total(column, scale) / F.count(_col(column))


def net_revenue() -> Column:
    """Line price after discount."""
    return F.col("l_extendedprice") * (1 - F.col("l_discount"))
