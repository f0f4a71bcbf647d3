"""Row-level cleaning steps shared by the silver builders."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattflow.schemas import LINEAGE_COLUMN


def noise_filter(df: DataFrame, mode_col: str, mode: str, value_col: str,
                 noise_value=0) -> DataFrame:
    """Drop readings where ``mode_col = mode AND value_col = noise_value``.

    SQL three-valued logic is kept on purpose: a row survives only when the
    negated conjunction is *true*, so (mode, null), (null, 0) and
    (null, null) are dropped as well.
    """
    return df.filter(~((F.col(mode_col) == F.lit(mode)) & (F.col(value_col) == F.lit(noise_value))))


def add_period(df: DataFrame, ts_col: str, year_col: str, month_col: str) -> DataFrame:
    """Calendar year and month of a timestamp/date (session time zone)."""
    return df.withColumns({year_col: F.year(ts_col), month_col: F.month(ts_col)})


def drop_pii(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Drop personal-data columns; unknown names are ignored."""
    return df.drop(*cols)


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Bulk rename in one projection; missing source names are no-ops."""
    present = {k: v for k, v in mapping.items() if k in df.columns}
    return df.withColumnsRenamed(present)


def add_lineage(df: DataFrame, col: str = LINEAGE_COLUMN) -> DataFrame:
    """Processing timestamp (one value per query)."""
    return df.withColumn(col, F.current_timestamp())


def project(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """``select src AS dst`` for every pair. Only the lineage column may be
    absent from the source; any other missing column raises."""
    missing = [s for s, _ in pairs if s not in df.columns and s != LINEAGE_COLUMN]
    if missing:
        raise ValueError(f"source columns missing: {missing}")
    return df.select(*[F.col(s).alias(d) for s, d in pairs if s in df.columns])
