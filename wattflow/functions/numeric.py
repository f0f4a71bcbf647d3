"""Exact arithmetic helpers for sums, rounded means and guarded ratios."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


EXACT = "decimal(26,12)"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def exact(c) -> Column:
    """Double amount -> ``decimal(26,12)`` of its shortest decimal form, so
    sums do not depend on the order of the rows. Amounts of 10^14 and more
    raise, and so do infinite ones and NaN (a cast alone would make them null,
    and a sum would pass over them)."""
    x = _col(c)
    finite = ~F.isnan(x) & (F.abs(x) != float("inf"))
    return F.when(x.isNull() | finite, x.cast(EXACT)).otherwise(
        F.raise_error(F.lit("an amount is not a finite number")).cast(EXACT))


def rounded_mean(total, n) -> Column:
    """``total / n`` of an exact total, rounded half away from zero to 2 decimals."""
    return F.round(_col(total) / _col(n), 2).cast("double")


def round_numeric(c, scale: int) -> Column:
    """Round a double the way ``round(x::numeric, scale)`` does.

    The double is first fixed to 12 decimal places, which removes binary
    noise (``51/160*100`` is ``31.874999999999996`` as a double but 31.875 as
    a number), then rounded half away from zero; the result is a double.
    Plain ``round(double)`` would give 31.87 here.
    """
    return F.round(_col(c).cast("decimal(38,12)"), scale).cast("double")


def ratio_pct(num, den, scale: int | None = 2) -> Column:
    """``num / nullif(den, 0) * 100`` (division before x100), rounded like numeric."""
    d = _col(den)
    pct = _col(num) / F.when(d != 0, d) * F.lit(100)
    return round_numeric(pct, scale) if scale is not None else pct
