"""Numeric column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def number(c: Column | str) -> Column:
    """Lenient numeric read: anything unparsable, and NaN, becomes null."""
    return F.nanvl(_col(c).try_cast("double"), F.lit(None).cast("double"))


def number_or(c: Column | str, default: float) -> Column:
    return F.coalesce(number(c), F.lit(float(default)))


def even_round(c: Column | str, digits: int) -> Column:
    """Round half to even on the scaled double, the rule of numpy and pandas.

    ``bround`` works on the decimal text of the double and differs from numpy where the scaled
    product is not a tie, so it is not used here.
    """
    scale = float(10**digits)
    return F.rint(_col(c).cast("double") * F.lit(scale)) / F.lit(scale)


def clip(c: Column | str, low: float | None = None, high: float | None = None) -> Column:
    """Clamp that keeps null as null (``least``/``greatest`` alone would skip it)."""
    value = _col(c)
    out = value
    if low is not None:
        out = F.greatest(out, F.lit(low))
    if high is not None:
        out = F.least(out, F.lit(high))
    return F.when(value.isNotNull(), out)


def ratio_or_zero(numerator: Column | str, denominator: Column | str) -> Column:
    """Division where a missing side or a zero denominator gives 0.0."""
    return F.coalesce(F.try_divide(number(numerator), number(denominator)), F.lit(0.0))


def sigmoid(c: Column | str) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-_col(c)))


def band(c: Column | str, cuts: Sequence[tuple[float, str]], otherwise: str) -> Column:
    """First label whose cut the value reaches; cuts in falling order; null stays null."""
    value = _col(c)
    chain = F.when(value.isNull(), F.lit(None).cast("string"))
    for cut, label in cuts:
        chain = chain.when(value >= F.lit(cut), F.lit(label))
    return chain.otherwise(F.lit(otherwise))


def fixed_text(c: Column | str, digits: int) -> Column:
    """Text with a fixed number of digits, rounded half to even; a decimal cast, not a formatter call."""
    return even_round(c, digits).cast(f"decimal(20,{digits})").cast("string")
