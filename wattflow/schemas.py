"""Schemas, column maps and domain constants.

Everything in the block below is a FIXED VALUE: the column names, types,
labels and patterns must be exactly these for the tables to have the same
shape and the same results as the source pipeline. They are data, not logic.
"""

from __future__ import annotations

from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# ---------------------------------------------------------------------------
# FIXED VALUES — begin
# ---------------------------------------------------------------------------

# Hourly generation, raw CSV (';', header, UTF-8); binding is positional.
GENERATION_RAW = StructType([
    StructField("din_instante", TimestampType(), True),
    StructField("id_subsistema", StringType(), True),
    StructField("nom_subsistema", StringType(), True),
    StructField("id_estado", StringType(), True),
    StructField("nom_estado", StringType(), True),
    StructField("cod_modalidadeoperacao", StringType(), True),
    StructField("nom_tipousina", StringType(), True),
    StructField("nom_tipocombustivel", StringType(), True),
    StructField("nom_usina", StringType(), True),
    StructField("id_ons", StringType(), True),
    StructField("ceg", StringType(), True),
    StructField("val_geracao", DoubleType(), True),
])

# Distributed-generation registry, raw CSV (';', header, ISO-8859-1, quote '"').
# Read (nearly) all as text and converted later; binding is positional, so the
# personal-data columns must stay in the schema even though they are dropped.
REGISTRY_RAW = StructType([
    StructField("DatGeracaoConjuntoDados", StringType(), True),
    StructField("AnmPeriodoReferencia", StringType(), True),
    StructField("NumCNPJDistribuidora", StringType(), True),
    StructField("SigAgente", StringType(), True),
    StructField("NomAgente", StringType(), True),
    StructField("CodClasseConsumo", StringType(), True),
    StructField("DscClasseConsumo", StringType(), True),
    StructField("CodSubGrupoTarifario", StringType(), True),
    StructField("DscSubGrupoTarifario", StringType(), True),
    StructField("CodUFibge", IntegerType(), True),
    StructField("SigUF", StringType(), True),
    StructField("CodRegiao", IntegerType(), True),
    StructField("NomRegiao", StringType(), True),
    StructField("CodMunicipioIbge", LongType(), True),
    StructField("NomMunicipio", StringType(), True),
    StructField("CodCEP", StringType(), True),
    StructField("SigTipoConsumidor", StringType(), True),
    StructField("NumCPFCNPJ", StringType(), True),
    StructField("NomTitularEmpreendimento", StringType(), True),
    StructField("CodEmpreendimento", StringType(), True),
    StructField("DthAtualizaCadastralEmpreend", StringType(), True),
    StructField("SigModalidadeEmpreendimento", StringType(), True),
    StructField("DscModalidadeHabilitado", StringType(), True),
    StructField("QtdUCRecebeCredito", IntegerType(), True),
    StructField("SigTipoGeracao", StringType(), True),
    StructField("DscFonteGeracao", StringType(), True),
    StructField("DscPorte", StringType(), True),
    StructField("NumCoordNEmpreendimento", StringType(), True),
    StructField("NumCoordEEmpreendimento", StringType(), True),
    StructField("MdaPotenciaInstaladaKW", StringType(), True),
    StructField("NomSubEstacao", StringType(), True),
    StructField("NumCoordESub", StringType(), True),
    StructField("NumCoordNSub", StringType(), True),
])

# Personal data removed from the registry before anything else.
REGISTRY_PII = ["CodCEP", "SigTipoConsumidor", "NumCPFCNPJ", "NomTitularEmpreendimento"]

# Registry raw name -> silver name.
REGISTRY_RENAMES = {
    "DatGeracaoConjuntoDados": "data_geracao_conjunto",
    "AnmPeriodoReferencia": "periodo_referencia",
    "NumCNPJDistribuidora": "cnpj_distribuidora",
    "SigAgente": "sigla_agente",
    "NomAgente": "nome_agente",
    "CodClasseConsumo": "cod_classe_consumo",
    "DscClasseConsumo": "classe_consumo",
    "CodSubGrupoTarifario": "cod_subgrupo_tarifario",
    "DscSubGrupoTarifario": "subgrupo_tarifario",
    "CodUFibge": "cod_uf_ibge",
    "SigUF": "sigla_uf",
    "CodRegiao": "cod_regiao",
    "NomRegiao": "regiao",
    "CodMunicipioIbge": "cod_municipio_ibge",
    "NomMunicipio": "municipio",
    "CodEmpreendimento": "cod_empreendimento",
    "DthAtualizaCadastralEmpreend": "data_conexao_str",
    "SigModalidadeEmpreendimento": "sigla_modalidade",
    "DscModalidadeHabilitado": "modalidade",
    "QtdUCRecebeCredito": "qtd_uc_recebe_credito",
    "SigTipoGeracao": "sigla_tipo_geracao",
    "DscFonteGeracao": "fonte_geracao",
    "DscPorte": "porte",
    "NumCoordNEmpreendimento": "lat_str",
    "NumCoordEEmpreendimento": "lon_str",
    "MdaPotenciaInstaladaKW": "potencia_kw_str",
    "NomSubEstacao": "subestacao",
    "NumCoordESub": "lon_sub_str",
    "NumCoordNSub": "lat_sub_str",
}

# Text columns superseded by their converted versions (substation coordinates
# are dropped without conversion).
REGISTRY_SUPERSEDED = [
    "potencia_kw_str", "lat_str", "lon_str", "lon_sub_str", "lat_sub_str", "data_conexao_str",
]

# Operation mode of small distributed plants whose zero readings are noise.
SMALL_PLANTS_MODE = "Pequenas Usinas (MMGD)"
# Subsystem of the binational plant (not domestic generation).
BINATIONAL_SUBSYSTEM = "PARAGUAI"
# Fuels counted as renewable.
RENEWABLE_FUELS = ["Hidráulica", "Eólica", "Fotovoltaica", "Biomassa"]
# Date pattern of the registry connection date.
REGISTRY_DATE_FORMAT = "yyyy-MM-dd"
# Source label of solar installations in the registry.
SOLAR_SOURCE = "Radiação solar"

# Simplified fuel category: ordered case-insensitive LIKE rules, first hit wins.
SOURCE_CATEGORY_RULES = [
    ("Hídrica", ["%hidr%"]),
    ("Eólica", ["%eól%", "%eol%"]),
    ("Solar", ["%solar%", "%fotovolt%"]),
    ("Nuclear", ["%nuclear%"]),
    ("Biomassa", ["%biomass%"]),
]
SOURCE_CATEGORY_DEFAULT = "Térmica/Outras"
SOURCE_CATEGORIES = ["Hídrica", "Eólica", "Solar", "Nuclear", "Biomassa", "Térmica/Outras"]
# "Clean" = renewable, or matching this pattern (nuclear).
CLEAN_EXTRA_PATTERN = "%nuclear%"

# Staging projections (silver name -> staging name), in output order.
GENERATION_STAGING = [
    ("din_instante", "ts_geracao"),
    ("id_subsistema", "cod_subsistema"),
    ("nom_subsistema", "nome_subsistema"),
    ("id_estado", "sigla_uf"),
    ("nom_estado", "nome_estado"),
    ("cod_modalidadeoperacao", "modalidade_operacao"),
    ("nom_tipousina", "tipo_usina"),
    ("nom_tipocombustivel", "fonte_combustivel"),
    ("nom_usina", "nome_usina"),
    ("id_ons", "id_usina"),
    ("ceg", "ceg"),
    ("val_geracao", "geracao_mwh"),
    ("eh_renovavel", "eh_renovavel"),
    ("eh_brasil", "eh_brasil"),
    ("ano", "ano_geracao"),
    ("mes", "mes_geracao"),
    ("processed_at", "bronze_processed_at"),
]

REGISTRY_STAGING = [
    ("cod_empreendimento", "id_empreendimento"),
    ("sigla_uf", "sigla_uf"),
    ("cod_uf_ibge", "cod_uf_ibge"),
    ("regiao", "nome_regiao"),
    ("municipio", "nome_municipio"),
    ("cod_municipio_ibge", "cod_municipio_ibge"),
    ("sigla_agente", "sigla_distribuidora"),
    ("nome_agente", "nome_distribuidora"),
    ("classe_consumo", "classe_consumo"),
    ("subgrupo_tarifario", "subgrupo_tarifario"),
    ("sigla_tipo_geracao", "sigla_tipo_geracao"),
    ("fonte_geracao", "fonte_geracao"),
    ("porte", "porte"),
    ("sigla_modalidade", "sigla_modalidade"),
    ("modalidade", "modalidade"),
    ("qtd_uc_recebe_credito", "qtd_uc_recebe_credito"),
    ("potencia_kw", "potencia_kw"),
    ("latitude", "latitude"),
    ("longitude", "longitude"),
    ("data_conexao", "data_conexao"),
    ("ano_conexao", "ano_conexao"),
    ("mes_conexao", "mes_conexao"),
    ("processed_at", "bronze_processed_at"),
]

# Hive partition columns of each layer.
GENERATION_BRONZE_PARTITIONS = ["year", "month"]
REGISTRY_BRONZE_PARTITIONS = ["snapshot_date"]
GENERATION_SILVER_PARTITIONS = ["ano", "mes"]
REGISTRY_SILVER_PARTITIONS = ["ano_conexao"]

# HTML marker and window of the landing-file sanity check.
HTML_MARKER = "<html"
HTML_SNIFF_BYTES = 100

# ---------------------------------------------------------------------------
# FIXED VALUES — end
# ---------------------------------------------------------------------------

LINEAGE_COLUMN = "processed_at"
