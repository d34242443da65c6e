"""Numeric column helpers: rounding and guarded ratios.

All are built-in Column expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_half_away(c, digits: int) -> Column:
    """Round a double to ``digits`` decimals, half away from zero, applied to
    the binary value: ``round(x * 10^d) / 10^d``.

    Spark's ``round(double, d)`` rounds the *decimal text* of the double
    (1.005 -> 1.01), while the target semantics round the binary value
    (1.005 is 1.00499.. -> 1.0).  Scaling first, then rounding to an integer,
    gives the binary behaviour: at the .5 boundary the scaled value is exact.
    A negative value that rounds to zero gives +0.0 here (the binary
    rounding gives -0.0); the two compare equal.  Keeping the sign would
    repeat the argument expression three times, which measurably slowed
    planning and code generation of the business models.
    """
    scale = float(10 ** digits)
    return F.round(_col(c) * F.lit(scale), 0) / F.lit(scale)


def r2(c) -> Column:
    return round_half_away(c, 2)


def r4(c) -> Column:
    return round_half_away(c, 4)


def ratio(numerator, denominator) -> Column:
    """numerator / denominator as double when denominator > 0, else NULL.

    Zero, negative and NULL denominators all give NULL.  The division sits in
    the THEN branch, so it is never evaluated for a zero denominator (ANSI
    mode would raise on it).
    """
    den = _col(denominator)
    return F.when(den > 0, _col(numerator).cast("double") / den)
