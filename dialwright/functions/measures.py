"""Column formulas shared by facts, marts and reports."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from dialwright import fixed_values as fv
from dialwright.functions.keys import _col


def safe_div(a: Column | str, b: Column | str, default: float | None = None) -> Column:
    """``a / b``; ``default`` (NULL unless given) when ``b`` is zero or missing."""
    ratio = F.try_divide(_col(a), _col(b))
    return ratio if default is None else F.coalesce(ratio, F.lit(default))


def sum0(c: Column | str) -> Column:
    """Sum that is 0 rather than NULL over nothing."""
    return F.coalesce(F.sum(_col(c)), F.lit(0))


def sum_if(c: Column | str, condition: Column) -> Column:
    """Sum of the rows that meet the condition."""
    return F.sum(F.when(condition, _col(c)))


def wape(predicted: Column | str, actual: Column | str, type_: str = "decimal(28,6)") -> Column:
    """Weighted absolute percentage error: sum of misses over sum of actuals."""
    miss = F.sum(F.abs(_col(predicted) - _col(actual)))
    return F.try_divide(miss, F.sum(_col(actual))).cast(type_)


def any_flag(c: Column | str) -> Column:
    """Aggregate: 1 when the flag is set on any row, else 0."""
    return F.max(_col(c).cast("int"))


def band(percent: Column | str, green: float = fv.GREEN_FROM, orange: float | None = fv.ORANGE_FROM) -> Column:
    """Traffic light of a percentage.  Without ``orange`` there are two bands."""
    percent = _col(percent)
    light = F.when(percent.isNull(), None).when(percent >= green, "green")
    if orange is not None:
        light = light.when(percent >= orange, "orange")
    return light.otherwise("red")


def priced(quantity: Column | str, price: Column | str | Decimal = fv.DEFAULT_PRICE_PER_KWH) -> Column:
    """Quantity times unit price as DECIMAL(18,4)."""
    unit = price if isinstance(price, Column) else F.lit(str(price)).cast("double")
    return (_col(quantity) * unit.cast("double")).cast("decimal(18,4)")


def clamp_min(c: Column | str, lowest: float = 0.0) -> Column:
    """Raise values below ``lowest``; NULL stays NULL."""
    c = _col(c)
    return F.when(c < lowest, F.lit(lowest)).otherwise(c)


def zero_as_null(c: Column | str) -> Column:
    """Natural number where 0 means "none"."""
    return F.nullif(_col(c).try_cast("int"), F.lit(0))


def null_sentinel(c: Column | str, sentinels: list[float]) -> Column:
    """NULL in place of any "no data" marker."""
    c = _col(c)
    return F.when(~c.isin(sentinels), c)


def flag_equals(c: Column | str, code: object) -> Column:
    """Boolean that is false, not NULL, for a missing code."""
    return F.coalesce(_col(c) == F.lit(code), F.lit(False))


def recurring(first: Column | str, last: Column | str) -> Column:
    """A booking with either recurrence bound is recurring."""
    return _col(first).isNotNull() | _col(last).isNotNull()
