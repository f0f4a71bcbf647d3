"""Three-valued flags and ordered pattern classification."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def flag_in(c, values: Sequence) -> Column:
    """Membership in a literal list. Null input gives null (not false)."""
    return _col(c).isin(list(values))


def flag_not_equal(c, value) -> Column:
    """False when ``c == value``; true otherwise, *including* when c is null."""
    return F.when(_col(c) == F.lit(value), F.lit(False)).otherwise(F.lit(True))


def any_match(c, patterns: Sequence[str]) -> Column:
    """Case-insensitive LIKE against any of ``patterns``."""
    col = _col(c)
    cond = None
    for p in patterns:
        term = col.ilike(p)
        cond = term if cond is None else (cond | term)
    return cond


def classify(c, rules: Sequence[tuple[str, Sequence[str]]], default: str) -> Column:
    """Ordered keyword classification: the first rule whose pattern matches wins.

    ``rules`` is a list of ``(label, [ilike patterns])``; no match (or null
    input) gives ``default``.
    """
    expr = None
    for label, patterns in rules:
        cond = any_match(c, patterns)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(default)) if expr is not None else F.lit(default)
