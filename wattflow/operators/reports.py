"""Report queries over the facts: KPIs, top-k, share, growth, slices, drill-across.

Ratios are ratio-of-sums (never an average of the fuel-grain percentage).
Power and energy are re-summed exactly, so totals do not depend on the
summation order. Windows without a partition only run over already
aggregated rows (one per category or year), never over raw rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wattflow.functions import exact, ratio_pct, round_numeric
from wattflow.schemas import SOLAR_SOURCE


def _kw():
    return F.sum(exact("potencia_kw_novos"))


def _mwh(col: str):
    return F.sum(exact(col)).cast("double")


def kpi_total(fact: DataFrame) -> DataFrame:
    """Total generation in MWh and TWh."""
    return fact.agg(_mwh("geracao_total_mwh").alias("total_mwh")).select(
        "total_mwh", (F.col("total_mwh") / F.lit(1e6)).alias("total_twh"))


def kpi_renewable_pct(fact: DataFrame, scale: int = 2) -> DataFrame:
    """Renewable share of all generation (ratio of sums, percent)."""
    return fact.agg(
        _mwh("geracao_renovavel_mwh").alias("renovavel_mwh"),
        _mwh("geracao_total_mwh").alias("total_mwh"),
    ).select("renovavel_mwh", "total_mwh",
             ratio_pct("renovavel_mwh", "total_mwh", scale).alias("pct_renovavel"))


def kpi_capacity(cap: DataFrame, source: str = SOLAR_SOURCE) -> DataFrame:
    """Distributed capacity (GW) and installation count of one source."""
    return cap.filter(F.col("fonte_geracao") == source).agg(
        _kw().alias("kw"),
        F.sum("num_empreendimentos_novos").alias("num_empreendimentos"),
    ).select(
        (F.col("kw").cast("double") / F.lit(1e6)).alias("potencia_gw"),
        F.coalesce(F.col("num_empreendimentos"), F.lit(0)).cast("bigint").alias("num_empreendimentos"),
    )


def by_state_renewable(fact: DataFrame) -> DataFrame:
    """Per state: total MWh (rounded to units) and renewable % (1 decimal)."""
    return fact.groupBy("sigla_uf").agg(
        _mwh("geracao_total_mwh").alias("__tot"),
        _mwh("geracao_renovavel_mwh").alias("__ren"),
    ).select(
        "sigla_uf",
        round_numeric("__tot", 0).alias("total_mwh"),
        ratio_pct("__ren", "__tot", 1).alias("pct_renovavel"),
    )


def top_states_renewable(fact: DataFrame, k: int = 10) -> DataFrame:
    """Top-k states by renewable % (nulls first as in the warehouse), state tie-break."""
    return by_state_renewable(fact).orderBy(
        F.col("pct_renovavel").desc_nulls_first(), F.col("sigla_uf").asc_nulls_last()).limit(k)


def top_states_capacity(cap: DataFrame, k: int = 10, source: str = SOLAR_SOURCE) -> DataFrame:
    """Top-k states by installed capacity of one source, in GW."""
    per = cap.filter(F.col("fonte_geracao") == source).groupBy("sigla_uf").agg(
        _kw().alias("__c"),
        F.sum("num_empreendimentos_novos").cast("bigint").alias("num_empreendimentos"),
    ).select("sigla_uf", (F.col("__c").cast("double") / F.lit(1e6)).alias("potencia_gw"),
             "num_empreendimentos")
    return per.orderBy(F.col("potencia_gw").desc_nulls_first(),
                       F.col("sigla_uf").asc_nulls_last()).limit(k)


def states_fully_renewable(fact: DataFrame) -> DataFrame:
    """States whose renewable generation equals their (positive) total exactly."""
    return (fact.groupBy("sigla_uf").agg(
        _mwh("geracao_total_mwh").alias("geracao_total_mwh"),
        _mwh("geracao_renovavel_mwh").alias("geracao_renovavel_mwh"))
        .filter((F.col("geracao_total_mwh") > 0)
                & (F.col("geracao_renovavel_mwh") == F.col("geracao_total_mwh")))
        .select("sigla_uf", "geracao_total_mwh"))


def share_by_source(fact: DataFrame, dim_fonte: DataFrame, scale: int = 2) -> DataFrame:
    """Generation share by simplified category (donut)."""
    per = (fact.join(dim_fonte.select("fonte_combustivel", "categoria_simplificada"),
                     "fonte_combustivel", "left")
           .groupBy("categoria_simplificada")
           .agg(_mwh("geracao_total_mwh").alias("geracao_mwh")))
    total = F.sum(exact("geracao_mwh")).over(Window.partitionBy()).cast("double")
    return per.withColumn("share_pct", ratio_pct(F.col("geracao_mwh"), total, scale))


def capacity_growth(cap: DataFrame, source: str = SOLAR_SOURCE) -> DataFrame:
    """Yearly new capacity of one source, running total and growth factors.

    ``fator_vs_primeiro_ano`` = year's new kW / first year's new kW;
    ``fator_anual`` = year's new kW / previous year's new kW (2 decimals).
    """
    per = cap.filter(F.col("fonte_geracao") == source).groupBy("ano_conexao").agg(
        _kw().alias("__c"),
        F.sum("num_empreendimentos_novos").cast("bigint").alias("num_empreendimentos"),
    )
    w = Window.orderBy("ano_conexao")
    first = F.first("__c").over(
        w.rowsBetween(Window.unboundedPreceding, Window.currentRow)).cast("double")
    prev = F.lag("__c").over(w).cast("double")
    return per.select(
        "ano_conexao",
        F.col("__c").cast("double").alias("potencia_kw"),
        "num_empreendimentos",
        F.sum("__c").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
        .cast("double").alias("potencia_acumulada_kw"),
        round_numeric(F.col("__c").cast("double") / F.when(first != 0, first), 2).alias("fator_vs_primeiro_ano"),
        round_numeric(F.col("__c").cast("double") / F.when(prev != 0, prev), 2).alias("fator_anual"),
    )


def slice_generation(fact: DataFrame, years: Sequence[int] | None = None,
                     fuels: Sequence[str] | None = None,
                     states: Sequence[str] | None = None) -> DataFrame:
    """Apply report slicers (any combination; ``None`` = no filter)."""
    out = fact
    if years is not None:
        out = out.filter(F.col("ano_geracao").isin(list(years)))
    if fuels is not None:
        out = out.filter(F.col("fonte_combustivel").isin(list(fuels)))
    if states is not None:
        out = out.filter(F.col("sigla_uf").isin(list(states)))
    return out


def slice_capacity(cap: DataFrame, years: Sequence[int] | None = None,
                   sources: Sequence[str] | None = None,
                   states: Sequence[str] | None = None) -> DataFrame:
    """The same slicers on the capacity fact (connection year, source, state)."""
    out = cap
    for name, values in (("ano_conexao", years), ("fonte_geracao", sources), ("sigla_uf", states)):
        if values is not None:
            out = out.filter(F.col(name).isin(list(values)))
    return out


def state_year_capacity(cap: DataFrame, source: str = SOLAR_SOURCE) -> DataFrame:
    """Capacity of one source installed per state and connection year."""
    return cap.filter(F.col("fonte_geracao") == source).groupBy("sigla_uf", "ano_conexao").agg(
        _kw().alias("__c"),
        F.sum("num_empreendimentos_novos").cast("bigint").alias("num_empreendimentos"),
    ).select("sigla_uf", "ano_conexao",
             F.col("__c").cast("double").alias("potencia_kw"),
             "num_empreendimentos")


def drill_across(fact: DataFrame, cap: DataFrame, source: str = SOLAR_SOURCE) -> DataFrame:
    """Both facts at (state, year, month), full outer join on the shared keys.

    Each side is aggregated to the shared grain first, so the join moves one
    row per key and side. Null keys never match (plain equality).
    """
    g = fact.groupBy(
        F.col("sigla_uf").alias("__uf"), F.col("ano_geracao").alias("__ano"),
        F.col("mes_geracao").alias("__mes"),
    ).agg(
        _mwh("geracao_total_mwh").alias("geracao_total_mwh"),
        _mwh("geracao_renovavel_mwh").alias("geracao_renovavel_mwh"),
    )
    c = cap.filter(F.col("fonte_geracao") == source).groupBy(
        F.col("sigla_uf").alias("__uf2"), F.col("ano_conexao").alias("__ano2"),
        F.col("mes_conexao").alias("__mes2"),
    ).agg(
        _kw().alias("__c"),
        F.sum("num_empreendimentos_novos").cast("bigint").alias("num_empreendimentos_solar"),
    )
    j = g.join(c, (g.__uf == c.__uf2) & (g.__ano == c.__ano2) & (g.__mes == c.__mes2), "full_outer")
    return j.select(
        F.coalesce("__uf", "__uf2").alias("sigla_uf"),
        F.coalesce("__ano", "__ano2").alias("ano"),
        F.coalesce("__mes", "__mes2").alias("mes"),
        "geracao_total_mwh", "geracao_renovavel_mwh",
        ratio_pct("geracao_renovavel_mwh", "geracao_total_mwh", 2).alias("pct_renovavel"),
        F.col("__c").cast("double").alias("potencia_solar_kw"),
        "num_empreendimentos_solar",
    )
