"""Fact tables: monthly generation and distributed capacity."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattflow.functions import exact, ratio_pct, rounded_mean
from wattflow.functions.numeric import EXACT

GENERATION_KEYS = ["sigla_uf", "ano_geracao", "mes_geracao", "fonte_combustivel"]
# Grain of the shared generation pre-aggregate: every column the monthly fact
# and both dimensions read. One plant reports many hours a month, so this
# grain is far smaller than the hourly rows.
GENERATION_PRE_GRAIN = GENERATION_KEYS + [
    "eh_renovavel", "eh_brasil", "id_usina", "nome_estado", "nome_subsistema", "cod_subsistema"]
CAPACITY_KEYS = ["sigla_uf", "ano_conexao", "mes_conexao", "fonte_geracao", "classe_consumo", "porte"]


def join_dim(fact: DataFrame, dim: DataFrame, key: str, cols) -> DataFrame:
    """Left equi-join to a dimension (plain equality: null keys never match).

    No broadcast hint: a dimension built from data has no proven size bound.
    Spark broadcasts it when its measured size is under
    ``spark.sql.autoBroadcastJoinThreshold`` (statically for stored tables,
    at runtime through AQE for computed ones) and sort-merges otherwise.
    """
    return fact.join(dim.select(key, *cols), key, "left")


def pre_aggregate_generation(stg: DataFrame) -> DataFrame:
    """One pass over generation staging at ``GENERATION_PRE_GRAIN``:
    ``mwh`` (exact sum of the measure) and ``n`` (rows). Hash aggregation with a
    map-side partial step, so a hot state or month is combined before the
    shuffle. The monthly fact and both dimensions can all be derived from it.
    """
    return stg.groupBy(*GENERATION_PRE_GRAIN).agg(
        F.sum(exact("geracao_mwh")).alias("mwh"), F.count(F.lit(1)).alias("n"))


def monthly_fact(stg: DataFrame, dim_uf: DataFrame, dim_fonte: DataFrame,
                 pre_aggregated: bool = False) -> DataFrame:
    """Generation by state x year x month x fuel for domestic plants.

    ``num_usinas_ativas`` is an exact distinct count of plant ids (nulls
    ignored); ``num_horas_medidas`` counts plant-hour rows; ``pct_renovavel``
    = renewable / nullif(total, 0) * 100 rounded half-up to 2 places.
    ``stg`` is the staging table, or its ``pre_aggregate_generation`` when
    ``pre_aggregated`` (same result, computed from the smaller grain).
    """
    if pre_aggregated:
        mwh, rows = F.col("mwh"), F.sum("n")
    else:
        mwh, rows = exact("geracao_mwh"), F.count(F.lit(1))
    g = (
        stg.filter(F.col("eh_brasil") == F.lit(True))
        .groupBy(*GENERATION_KEYS)
        .agg(
            F.sum(mwh).cast("double").alias("geracao_total_mwh"),
            F.sum(F.when(F.col("eh_renovavel"), mwh).otherwise(F.lit(0).cast(EXACT)))
            .cast("double").alias("geracao_renovavel_mwh"),
            F.count_distinct("id_usina").alias("num_usinas_ativas"),
            rows.cast("bigint").alias("num_horas_medidas"),
        )
    )
    g = join_dim(g, dim_uf, "sigla_uf", ["sk_uf"])
    g = join_dim(g, dim_fonte, "fonte_combustivel", ["sk_fonte"])
    return g.select(
        *GENERATION_KEYS,
        "geracao_total_mwh", "geracao_renovavel_mwh", "num_usinas_ativas", "num_horas_medidas",
        "sk_uf", "sk_fonte",
        ratio_pct("geracao_renovavel_mwh", "geracao_total_mwh", 2).alias("pct_renovavel"),
    )


def capacity_fact(stg: DataFrame, dim_uf: DataFrame | None = None) -> DataFrame:
    """New distributed capacity by state x month x source x class x size.

    Without ``dim_uf`` the fact has no surrogate key: reports that never read
    it need no dimension, and so no scan of the table it is built from.

    Power is summed exactly, without rounding single plants, and converted
    once; the mean is rounded half-up to 2 places.
    """
    c = (
        stg.groupBy(*CAPACITY_KEYS)
        .agg(
            F.count(F.lit(1)).alias("num_empreendimentos_novos"),
            F.sum(exact("potencia_kw")).alias("__kw"),
        )
    )
    if dim_uf is not None:
        c = join_dim(c, dim_uf, "sigla_uf", ["sk_uf"])
    return c.select(
        *CAPACITY_KEYS,
        "num_empreendimentos_novos",
        F.col("__kw").cast("double").alias("potencia_kw_novos"),
        rounded_mean("__kw", "num_empreendimentos_novos").alias("potencia_media_kw"),
        *(["sk_uf"] if dim_uf is not None else []),
    )


def plant_sketches(pre: DataFrame, lg_k: int = 12) -> DataFrame:
    """Active plants by state x year x month x fuel, as a mergeable sketch
    beside the exact count. Exact distinct counts cannot be added up; sketches
    can, so coarser totals need no plant grain (``rolled_up_plants``)."""
    return (pre.filter(F.col("eh_brasil")).groupBy(*GENERATION_KEYS)
            .agg(F.count_distinct("id_usina").alias("num_usinas_ativas"),
                 F.hll_sketch_agg("id_usina", F.lit(lg_k)).alias("usinas")))


def rolled_up_plants(sketches: DataFrame, *keys: str) -> DataFrame:
    """Estimated distinct plants per coarser ``keys``, merged from the sketches."""
    return sketches.groupBy(*keys).agg(
        F.hll_sketch_estimate(F.hll_union_agg("usinas")).alias("num_usinas_estimado"))
