"""Bronze -> silver table builders (composition of the cleaning operators)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattflow.functions import br_number, flag_in, flag_not_equal, parse_date
from wattflow.operators.clean import add_lineage, add_period, drop_pii, noise_filter, rename_columns
from wattflow.schemas import (
    BINATIONAL_SUBSYSTEM,
    REGISTRY_DATE_FORMAT,
    REGISTRY_PII,
    REGISTRY_RENAMES,
    REGISTRY_SUPERSEDED,
    RENEWABLE_FUELS,
    SMALL_PLANTS_MODE,
)


def silver_generation(raw: DataFrame, lineage: bool = True) -> DataFrame:
    """Hourly generation: noise filter, domestic and renewable flags, period.

    ``eh_brasil`` is false only for the binational subsystem (null subsystem
    counts as domestic); ``eh_renovavel`` is null when the fuel is null.
    """
    df = noise_filter(raw, "cod_modalidadeoperacao", SMALL_PLANTS_MODE, "val_geracao")
    df = df.withColumns({
        "eh_brasil": flag_not_equal("nom_subsistema", BINATIONAL_SUBSYSTEM),
        "eh_renovavel": flag_in("nom_tipocombustivel", RENEWABLE_FUELS),
    })
    df = add_period(df, "din_instante", "ano", "mes")
    return add_lineage(df) if lineage else df


def silver_registry(raw: DataFrame, lineage: bool = True, thousands: bool = False,
                    date_format: str = REGISTRY_DATE_FORMAT) -> DataFrame:
    """Distributed-generation registry: PII drop, renames, typed numbers/dates.

    Rows without a parsable connection date are removed (they have no
    partition). ``thousands=True`` also accepts ``1.234,56``.
    """
    df = drop_pii(raw, REGISTRY_PII)
    df = rename_columns(df, REGISTRY_RENAMES)
    df = df.withColumns({
        "potencia_kw": br_number("potencia_kw_str", thousands),
        "latitude": br_number("lat_str", thousands),
        "longitude": br_number("lon_str", thousands),
        "data_conexao": parse_date("data_conexao_str", date_format),
    })
    df = add_period(df, "data_conexao", "ano_conexao", "mes_conexao")
    df = df.drop(*REGISTRY_SUPERSEDED)
    if lineage:
        df = add_lineage(df)
    return df.filter(F.col("ano_conexao").isNotNull())
