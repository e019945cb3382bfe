from __future__ import annotations

from pyspark.sql import Column, functions as F


def _exact(c: Column) -> Column:
    return c.cast("decimal(20,0)")


def rate(part: Column, whole: Column) -> Column:
    """``part / whole`` of two counts as DECIMAL(5,4), rounded half away from zero.

    The quotient is taken on decimals, so a tie is a real tie and not a double's nearest value.
    """
    return F.round(_exact(part) / _exact(whole), 4).cast("decimal(5,4)")


def percent(part: Column, whole: Column) -> Column:
    """``100 * part / whole`` of two counts as DECIMAL(5,2), rounded half away from zero."""
    return F.round(_exact(part) * 100 / _exact(whole), 2).cast("decimal(5,2)")


def safe_ratio(part: Column, whole: Column) -> Column:
    """``part / whole`` as a double, 0 where the denominator is 0."""
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def round_half_even(c: Column, digits: int) -> Column:
    return F.bround(c, digits)


def percent_text(c: Column, digits: int = 1) -> Column:
    """A share as text such as ``31.9%``."""
    return F.format_string(f"%.{digits}f%%", c * 100)


def thousands(c: Column) -> Column:
    """A count as text such as ``12,345``."""
    return F.format_number(c, 0)
