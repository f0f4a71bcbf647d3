"""Tolerant parsing of dirty text (Spark 4 ANSI safe: bad input -> null)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wattflow.schemas import REGISTRY_DATE_FORMAT


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def br_number(c, thousands: bool = False) -> Column:
    """Brazilian-format number text -> double.

    Default: every ``,`` becomes ``.`` and the text is cast; thousands dots
    are *not* stripped, so ``"1.234,56"`` is null (the source behaviour).
    ``thousands=True`` removes ``.`` first, so it parses as 1234.56.
    Malformed text gives null under ANSI mode too (``try_cast``).
    """
    text = _col(c)
    if thousands:
        text = F.translate(text, ".", "")  # an empty replacement deletes the character
    # translate is a per-character map (no regex engine per row)
    return F.translate(text, ",", ".").try_cast("double")


def parse_date(c, fmt: str = REGISTRY_DATE_FORMAT) -> Column:
    """Strict text -> date; anything not matching ``fmt`` is null."""
    return F.try_to_date(_col(c), fmt)
