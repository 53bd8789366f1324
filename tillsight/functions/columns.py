"""Column expressions used by several operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


WHITESPACE = " \t\n\r\x0b\x0c"


def strip(col: Column | str) -> Column:
    """Remove blanks, tabs and line ends on both sides."""
    return F.trim(col, F.lit(WHITESPACE))


def dbl(col: Column | str) -> Column:
    return (F.col(col) if isinstance(col, str) else col).cast("double")


def month_start(col: Column | str) -> Column:
    return F.trunc(F.to_date(col), "month")


def ratio(numerator: Column, denominator: Column) -> Column:
    """Double division that gives NULL instead of an ANSI error on zero."""
    return F.try_divide(dbl(numerator), dbl(denominator))


def total(col: Column | str) -> Column:
    """Sum that is 0, not NULL, when no value is present."""
    return F.coalesce(F.sum(col), F.lit(0))


def mean_of(col: Column | str) -> Column:
    """Mean as exact decimal sum over count: the result does not depend on row order."""
    return ratio(F.sum(col), F.count(col))


def _spread(s1: Column, s2: Column, n: Column) -> Column:
    """n * sum(x^2) - sum(x)^2, exact in DECIMAL, in double only if that overflows."""
    exact = F.try_subtract(F.try_multiply(s2, n), F.try_multiply(s1, s1))
    return F.greatest(
        F.coalesce(dbl(exact), dbl(s2) * dbl(n) - dbl(s1) * dbl(s1)), F.lit(0.0)
    )


def variance(s1: Column, s2: Column, n: Column) -> Column:
    """Sample variance from exact moments; NULL for fewer than two values."""
    return F.when(n > 1, _spread(s1, s2, n) / (dbl(n) * (dbl(n) - 1)))


def variance_pop(s1: Column, s2: Column, n: Column) -> Column:
    return F.when(n > 0, _spread(s1, s2, n) / (dbl(n) * dbl(n)))


def seeded_hash(seed: int, *columns: str) -> Column:
    """Hash of a seed and the text of some columns, the same in every engine that has MD5."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in columns]))
