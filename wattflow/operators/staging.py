"""Staging views: renamed projections plus the always-on quality filters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattflow.operators.clean import project
from wattflow.schemas import GENERATION_STAGING, LINEAGE_COLUMN, REGISTRY_STAGING


def stg_generation(silver: DataFrame) -> DataFrame:
    """Generation staging: measured value present and non-negative."""
    kept = silver.filter(F.col("val_geracao").isNotNull() & (F.col("val_geracao") >= 0))
    return project(kept, GENERATION_STAGING)


def stg_registry(silver: DataFrame) -> DataFrame:
    """Registry staging: positive power, connection date and state present."""
    kept = silver.filter(
        F.col("potencia_kw").isNotNull()
        & (F.col("potencia_kw") > 0)
        & F.col("data_conexao").isNotNull()
        & F.col("sigla_uf").isNotNull()
    )
    return project(kept, REGISTRY_STAGING)


def generation_view_sql(source: str) -> str:
    """Generation staging as the text of a view over the silver table ``source``."""
    columns = ", ".join(f"`{a}` AS `{b}`" for a, b in GENERATION_STAGING if a != LINEAGE_COLUMN)
    return f"SELECT {columns} FROM {source} WHERE val_geracao IS NOT NULL AND val_geracao >= 0"
