"""Exact sums of money and of other measures, and guarded ratios.

Amounts arrive as doubles holding whole cents. They are summed as ``bigint``
cents, which is exact, independent of the order of partial sums and stays in
whole-stage code generation; a wide decimal sum would not.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def cents(amount: Column | str) -> Column:
    """Whole cents of a currency amount as bigint."""
    return F.rint(_col(amount) * 100).cast("bigint")


def usd(cent_amount: Column | str) -> Column:
    """Currency amount as double, the nearest one to the exact cent value."""
    return _col(cent_amount) / F.lit(100.0)


def sum_cents(amount: Column | str) -> Column:
    return F.sum(cents(amount))


def sum_usd(amount: Column | str) -> Column:
    """SUM of an amount, exact to the cent."""
    return usd(sum_cents(amount))


def ratio(num: Column | str, den: Column | str, digits: int | None = None) -> Column:
    """``num / den`` as double, NULL when the denominator is 0 or NULL."""
    q = F.try_divide(_col(num).cast("double"), _col(den).cast("double"))
    return q if digits is None else F.round(q, digits)


def avg_usd(amount: Column | str, digits: int = 2) -> Column:
    """AVG of an amount, rounded half up from the exact cent total."""
    return ratio(sum_cents(amount), F.count(_col(amount)) * 100, digits)


#: Steps in one unit of a measure that is not money.
MEASURE_STEPS = 10**9


def steps(measure: Column | str) -> Column:
    """A measure in whole billionths, whose sums are exact and independent of their order."""
    return F.rint(_col(measure).cast("double") * MEASURE_STEPS).cast("decimal(28,0)")


def measure(whole_steps: Column | str, digits: int) -> Column:
    """Measure as double, rounded once from its exact sum of steps."""
    return ratio(whole_steps, F.lit(MEASURE_STEPS), digits)


def sum_measure(value: Column | str, digits: int = 2) -> Column:
    return measure(F.sum(steps(value)), digits)


def avg_measure(value: Column | str, digits: int) -> Column:
    return ratio(F.sum(steps(value)), F.count(_col(value)) * F.lit(MEASURE_STEPS), digits)


def div0(num: Column | str, den: Column | str) -> Column:
    """Ratio that is 0 when the denominator is 0 (NULL operands stay NULL)."""
    d = _col(den).cast("double")
    return F.when(d == 0, F.lit(0.0)).otherwise(_col(num).cast("double") / d)
