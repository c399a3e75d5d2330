"""Row-wise feature expressions. All are plain columns, none is a UDF.

Missing is NULL everywhere. None of these raises on a zero denominator, also
with ANSI mode on.
"""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

INF = float("inf")


def number(c: Column | str) -> Column:
    """The column as a double."""
    return (F.col(c) if isinstance(c, str) else c).cast("double")


def ratio_null(a: Column, b: Column) -> Column:
    """``a / b``, missing where ``b`` is zero or either side is missing."""
    return F.try_divide(number(a), number(b))


def ratio_ieee(a: Column, b: Column) -> Column:
    """``a / b`` with plus or minus infinity on zero; ``0 / 0`` is missing."""
    a, b = number(a), number(b)
    quotient = F.try_divide(a, b)
    return F.when(b == 0, F.when(a > 0, F.lit(INF)).when(a < 0, F.lit(-INF))).when(~F.isnan(quotient), quotient)


def ratio_clamped(a: Column, b: Column) -> Column:
    """``a / max(1, b)``; a missing ``b`` counts as 1."""
    return F.try_divide(number(a), F.greatest(F.lit(1.0), number(b)))


def ratio_guarded(a: Column, b: Column) -> Column:
    """``a / b``, or ``a`` itself where ``b`` is zero; a missing ``b`` gives missing."""
    a, b = number(a), number(b)
    return F.when(b == 0, a).otherwise(F.try_divide(a, b))


def pair_sum(a: Column, b: Column) -> Column:
    return number(a) + number(b)


def pair_diff(a: Column, b: Column) -> Column:
    return number(a) - number(b)


def pair_product(a: Column, b: Column) -> Column:
    return number(a) * number(b)


def pair_norm(a: Column, b: Column) -> Column:
    """Length of the vector ``(a, b)``."""
    return F.hypot(number(a), number(b))


def pair_angle(a: Column, b: Column) -> Column:
    """Angle of the vector with height ``a`` and width ``b``."""
    return F.atan2(number(a), number(b))


def flag_equal(c: Column, value: Any) -> Column:
    """1 where the column equals the value, else 0; missing counts as different."""
    return F.when(c.eqNullSafe(F.lit(value)), F.lit(1)).otherwise(F.lit(0))


def flag_not_equal(c: Column, value: Any) -> Column:
    """1 where the column differs from the value, else 0; missing counts as different."""
    return F.when(c.eqNullSafe(F.lit(value)), F.lit(0)).otherwise(F.lit(1))


def as_text(c: Column, missing: str = "nan") -> Column:
    """Text of the value, with a fixed word for missing."""
    return F.coalesce(c.cast("string"), F.lit(missing))


def as_number(c: Column) -> Column:
    """Number read from text; text that holds none gives missing."""
    return c.try_cast("double")
