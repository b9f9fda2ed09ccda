"""Exact half-up rounding on integers, so that no rate depends on float error."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def half_up_div(numerator: Column, denominator: Column, wide: bool = False) -> Column:
    """numerator / denominator to the nearest integer, halves up.

    For numerator >= 0 and denominator > 0; null when the denominator is 0 or null. With `wide`
    the numerator may have up to 30 digits, as money totals do; the result is a BIGINT.
    """
    n = numerator.cast("decimal(30,0)" if wide else "bigint")
    d = denominator.cast("decimal(20,0)" if wide else "bigint")
    return F.when(d > 0, F.call_function("div", F.lit(2) * n + d, F.lit(2) * d))


def ratio(numerator: Column, denominator: Column, scale: int) -> Column:
    """numerator / denominator as a decimal with `scale` digits, halves up."""
    units = half_up_div(numerator * F.lit(10**scale), denominator)
    return from_units(units, scale)


def percent(part: Column, whole: Column, scale: int = 2) -> Column:
    """100 * part / whole as a decimal with `scale` digits, halves up."""
    return ratio(part * F.lit(100), whole, scale)


def from_units(units: Column, scale: int) -> Column:
    """An integer count of 10**-scale units as DECIMAL(18, scale)."""
    step = F.lit(Decimal(1).scaleb(-scale))
    return (units.cast("decimal(18,0)") * step).cast(f"decimal(18,{scale})")


def to_units(amount: Column, scale: int) -> Column:
    """A decimal amount as an integer count of 10**-scale units."""
    return (amount * F.lit(10**scale)).cast("decimal(30,0)")


def seconds_between(later: Column, earlier: Column) -> Column:
    """Whole seconds from `earlier` to `later` (later >= earlier), halves up."""
    micros = F.unix_micros(later) - F.unix_micros(earlier)
    return half_up_div(micros, F.lit(1_000_000)).cast("int")
