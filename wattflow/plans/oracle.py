"""Independent DuckDB SQL for every registered query (the correctness oracle).

Written directly in SQL over the driver tables (views ``lineitem``,
``orders``, ...), not generated from the Spark code, so a bug on one side
shows up as a difference. Integer outputs are cast explicitly (DuckDB
``year()`` and ``row_number()`` are BIGINT, Spark ``year()`` is INT);
numeric-style rounding of doubles is ``round(CAST(x AS DECIMAL(38,12)), n)``.
"""

from __future__ import annotations

# -- adapters (same mapping as wattflow.sources.fixtures) --------------------

GEN_RAW = """
gen_raw AS (
  SELECT
    CAST(l.l_shipdate AS TIMESTAMP) AS din_instante,
    CAST(r.r_regionkey AS VARCHAR) AS id_subsistema,
    CASE WHEN l.l_orderkey % 89 = 0 THEN NULL
         WHEN r.r_name = 'MIDDLE EAST' THEN 'PARAGUAI' ELSE r.r_name END AS nom_subsistema,
    CASE WHEN l.l_orderkey % 101 = 0 THEN NULL ELSE n.n_name END AS id_estado,
    'Estado ' || n.n_name AS nom_estado,
    CASE WHEN l.l_orderkey % 97 = 0 THEN NULL
         WHEN l.l_returnflag = 'N' THEN 'Pequenas Usinas (MMGD)'
         ELSE 'TIPO ' || l.l_returnflag END AS cod_modalidadeoperacao,
    p.p_brand AS nom_tipousina,
    CASE WHEN n.n_name = 'NATION_18' THEN 'Hidráulica'
         WHEN l.l_partkey % 103 = 0 THEN NULL
         WHEN p.p_type LIKE 'ECONOMY%' THEN 'Hidráulica'
         WHEN p.p_type LIKE 'LARGE%' THEN 'Eólica'
         WHEN p.p_type LIKE 'MEDIUM%' THEN 'Gás'
         WHEN p.p_type LIKE 'PROMO%' THEN 'Fotovoltaica'
         WHEN p.p_type LIKE 'SMALL%' THEN 'Biomassa'
         ELSE 'Nuclear' END AS nom_tipocombustivel,
    s.s_name AS nom_usina,
    CASE WHEN l.l_orderkey % 107 = 0 THEN NULL ELSE CAST(l.l_suppkey AS VARCHAR) END AS id_ons,
    p.p_name AS ceg,
    CAST((nullif(l.l_quantity - 2, 7) * 1000 + l.l_orderkey % 13) / 1000 AS DOUBLE) AS val_geracao
  FROM lineitem l
  JOIN part p ON l.l_partkey = p.p_partkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN nation n ON s.s_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
)"""

SILVER_GEN = GEN_RAW + """,
silver_gen AS (
  SELECT *,
    CASE WHEN nom_subsistema = 'PARAGUAI' THEN false ELSE true END AS eh_brasil,
    nom_tipocombustivel IN ('Hidráulica', 'Eólica', 'Fotovoltaica', 'Biomassa') AS eh_renovavel,
    CAST(year(din_instante) AS INTEGER) AS ano,
    CAST(month(din_instante) AS INTEGER) AS mes
  FROM gen_raw
  WHERE NOT (cod_modalidadeoperacao = 'Pequenas Usinas (MMGD)' AND val_geracao = 0)
)"""

STG_GEN = SILVER_GEN + """,
stg_gen AS (
  SELECT din_instante AS ts_geracao, id_subsistema AS cod_subsistema,
    nom_subsistema AS nome_subsistema, id_estado AS sigla_uf, nom_estado AS nome_estado,
    cod_modalidadeoperacao AS modalidade_operacao, nom_tipousina AS tipo_usina,
    nom_tipocombustivel AS fonte_combustivel, nom_usina AS nome_usina, id_ons AS id_usina,
    ceg, val_geracao AS geracao_mwh, eh_renovavel, eh_brasil,
    ano AS ano_geracao, mes AS mes_geracao
  FROM silver_gen
  WHERE val_geracao IS NOT NULL AND val_geracao >= 0
)"""

DIMS = STG_GEN + """,
dim_uf AS (
  SELECT sigla_uf, nome_estado, nome_subsistema, cod_subsistema, eh_brasil,
    CAST(row_number() OVER (ORDER BY sigla_uf) AS BIGINT) AS sk_uf
  FROM (
    SELECT sigla_uf, max(nome_estado) AS nome_estado, max(nome_subsistema) AS nome_subsistema,
      max(cod_subsistema) AS cod_subsistema, bool_or(eh_brasil) AS eh_brasil
    FROM stg_gen WHERE sigla_uf IS NOT NULL GROUP BY sigla_uf
  ) u
),
dim_fonte AS (
  SELECT fonte_combustivel, eh_renovavel,
    CASE WHEN fonte_combustivel ILIKE '%hidr%' THEN 'Hídrica'
         WHEN fonte_combustivel ILIKE '%eól%' OR fonte_combustivel ILIKE '%eol%' THEN 'Eólica'
         WHEN fonte_combustivel ILIKE '%solar%' OR fonte_combustivel ILIKE '%fotovolt%' THEN 'Solar'
         WHEN fonte_combustivel ILIKE '%nuclear%' THEN 'Nuclear'
         WHEN fonte_combustivel ILIKE '%biomass%' THEN 'Biomassa'
         ELSE 'Térmica/Outras' END AS categoria_simplificada,
    CASE WHEN eh_renovavel THEN true
         WHEN fonte_combustivel ILIKE '%nuclear%' THEN true
         ELSE false END AS eh_limpa,
    CAST(row_number() OVER (ORDER BY fonte_combustivel) AS BIGINT) AS sk_fonte
  FROM (SELECT DISTINCT fonte_combustivel, eh_renovavel FROM stg_gen
        WHERE fonte_combustivel IS NOT NULL) f
)"""

FACT_GEN = DIMS + """,
fact_gen AS (
  SELECT g.sigla_uf, g.ano_geracao, g.mes_geracao, g.fonte_combustivel,
    g.geracao_total_mwh, g.geracao_renovavel_mwh, g.num_usinas_ativas, g.num_horas_medidas,
    u.sk_uf, f.sk_fonte,
    CAST(round(CAST(g.geracao_renovavel_mwh / nullif(g.geracao_total_mwh, 0) * 100
                    AS DECIMAL(38,12)), 2) AS DOUBLE) AS pct_renovavel
  FROM (
    SELECT sigla_uf, ano_geracao, mes_geracao, fonte_combustivel,
      CAST(sum(CAST(geracao_mwh AS DECIMAL(28,6))) AS DOUBLE) AS geracao_total_mwh,
      CAST(sum(CASE WHEN eh_renovavel THEN CAST(geracao_mwh AS DECIMAL(28,6)) ELSE 0 END)
           AS DOUBLE) AS geracao_renovavel_mwh,
      CAST(count(DISTINCT id_usina) AS BIGINT) AS num_usinas_ativas,
      CAST(count(*) AS BIGINT) AS num_horas_medidas
    FROM stg_gen WHERE eh_brasil = true
    GROUP BY sigla_uf, ano_geracao, mes_geracao, fonte_combustivel
  ) g
  LEFT JOIN dim_uf u ON g.sigla_uf = u.sigla_uf
  LEFT JOIN dim_fonte f ON g.fonte_combustivel = f.fonte_combustivel
)"""


REG_BASE = """
reg_base AS (
  SELECT o.*, c.*, n.*, r.*
  FROM orders o
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
)"""

_POWER = """CASE WHEN o_orderkey % 83 = 0 THEN '0,00'
         WHEN o_orderkey % 79 = 0 THEN '1.234,56'
         WHEN o_orderkey % 73 = 0 THEN '0,004'
         ELSE replace(CAST(CAST(CAST(o_totalprice AS DECIMAL(18,2)) + (o_orderkey % 97) * 0.0001
                                AS DECIMAL(18,4)) AS VARCHAR), '.', ',') END"""


def _exact(c: str) -> str:
    """Sum of a column that has at most six decimals, without binary noise."""
    return f"CAST(sum(CAST({c} AS DECIMAL(28,6))) AS DOUBLE)"


def reg_columns(power: str = _POWER, prefix: str = 'GD.') -> str:
    """The 33 registry raw columns over ``reg_base``."""
    return f"""
    CAST(NULL AS VARCHAR) AS DatGeracaoConjuntoDados,
    CAST(NULL AS VARCHAR) AS AnmPeriodoReferencia,
    CAST(NULL AS VARCHAR) AS NumCNPJDistribuidora,
    CAST(NULL AS VARCHAR) AS SigAgente,
    CAST(NULL AS VARCHAR) AS NomAgente,
    CAST(NULL AS VARCHAR) AS CodClasseConsumo,
    c_mktsegment AS DscClasseConsumo,
    CAST(NULL AS VARCHAR) AS CodSubGrupoTarifario,
    CAST(NULL AS VARCHAR) AS DscSubGrupoTarifario,
    CAST(n_nationkey AS INTEGER) AS CodUFibge,
    CASE WHEN o_orderkey % 101 = 0 THEN NULL ELSE n_name END AS SigUF,
    CAST(n_regionkey AS INTEGER) AS CodRegiao,
    r_name AS NomRegiao,
    CAST(NULL AS BIGINT) AS CodMunicipioIbge,
    CAST(NULL AS VARCHAR) AS NomMunicipio,
    CAST(NULL AS VARCHAR) AS CodCEP,
    CAST(NULL AS VARCHAR) AS SigTipoConsumidor,
    CAST(c_custkey AS VARCHAR) AS NumCPFCNPJ,
    c_name AS NomTitularEmpreendimento,
    '{prefix}' || CAST(o_orderkey AS VARCHAR) AS CodEmpreendimento,
    CASE WHEN o_orderkey % 89 = 0 THEN NULL
         WHEN o_orderkey % 97 = 0 THEN '05/2024'
         ELSE strftime(o_orderdate, '%Y-%m-%d') END AS DthAtualizaCadastralEmpreend,
    CAST(NULL AS VARCHAR) AS SigModalidadeEmpreendimento,
    CAST(NULL AS VARCHAR) AS DscModalidadeHabilitado,
    CAST(NULL AS INTEGER) AS QtdUCRecebeCredito,
    CAST(NULL AS VARCHAR) AS SigTipoGeracao,
    CASE o_orderstatus WHEN 'O' THEN 'Radiação solar' WHEN 'F' THEN 'Eólica'
         ELSE 'Biomassa' END AS DscFonteGeracao,
    o_orderpriority AS DscPorte,
    replace(CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR), '.', ',') AS NumCoordNEmpreendimento,
    replace(CAST(CAST(c_acctbal - 5000 AS DECIMAL(18,2)) AS VARCHAR), '.', ',') AS NumCoordEEmpreendimento,
    {power} AS MdaPotenciaInstaladaKW,
    CAST(NULL AS VARCHAR) AS NomSubEstacao,
    CAST(NULL AS VARCHAR) AS NumCoordESub,
    CAST(NULL AS VARCHAR) AS NumCoordNSub"""


REG_RAW = REG_BASE + f""",
reg_raw AS (SELECT {reg_columns()} FROM reg_base)"""

# snapshot 2: the whole registry, power '10,00' when key % 7 = 0; snapshot 1: without the rows with
# key % 10 = 0, with one installation of its own for each key % 11 = 0
REG_SNAPSHOTS = REG_BASE + f""",
snap1 AS (SELECT DATE '2024-01-01' AS snapshot_date, {reg_columns()}
          FROM reg_base WHERE o_orderkey % 10 <> 0
          UNION ALL
          SELECT DATE '2024-01-01' AS snapshot_date, {reg_columns(prefix='OLD.')}
          FROM reg_base WHERE o_orderkey % 11 = 0),
snap2 AS (SELECT DATE '2024-02-01' AS snapshot_date,
          {reg_columns("CASE WHEN o_orderkey % 7 = 0 THEN '10,00' ELSE " + _POWER + " END")}
          FROM reg_base)"""


def silver_reg_select(src: str, extra: str = "") -> str:
    """Silver registry projection over a raw-shaped relation ``src``."""
    return f"""
  SELECT DatGeracaoConjuntoDados AS data_geracao_conjunto,
    AnmPeriodoReferencia AS periodo_referencia,
    NumCNPJDistribuidora AS cnpj_distribuidora,
    SigAgente AS sigla_agente, NomAgente AS nome_agente,
    CodClasseConsumo AS cod_classe_consumo, DscClasseConsumo AS classe_consumo,
    CodSubGrupoTarifario AS cod_subgrupo_tarifario, DscSubGrupoTarifario AS subgrupo_tarifario,
    CodUFibge AS cod_uf_ibge, SigUF AS sigla_uf, CodRegiao AS cod_regiao, NomRegiao AS regiao,
    CodMunicipioIbge AS cod_municipio_ibge, NomMunicipio AS municipio,
    CodEmpreendimento AS cod_empreendimento,
    SigModalidadeEmpreendimento AS sigla_modalidade, DscModalidadeHabilitado AS modalidade,
    QtdUCRecebeCredito AS qtd_uc_recebe_credito, SigTipoGeracao AS sigla_tipo_geracao,
    DscFonteGeracao AS fonte_geracao, DscPorte AS porte, NomSubEstacao AS subestacao,{extra}
    TRY_CAST(replace(MdaPotenciaInstaladaKW, ',', '.') AS DOUBLE) AS potencia_kw,
    TRY_CAST(replace(NumCoordNEmpreendimento, ',', '.') AS DOUBLE) AS latitude,
    TRY_CAST(replace(NumCoordEEmpreendimento, ',', '.') AS DOUBLE) AS longitude,
    CAST(try_strptime(DthAtualizaCadastralEmpreend, '%Y-%m-%d') AS DATE) AS data_conexao,
    CAST(year(CAST(try_strptime(DthAtualizaCadastralEmpreend, '%Y-%m-%d') AS DATE)) AS INTEGER) AS ano_conexao,
    CAST(month(CAST(try_strptime(DthAtualizaCadastralEmpreend, '%Y-%m-%d') AS DATE)) AS INTEGER) AS mes_conexao
  FROM {src}
  WHERE try_strptime(DthAtualizaCadastralEmpreend, '%Y-%m-%d') IS NOT NULL"""


SILVER_REG = REG_RAW + f""",
silver_reg AS ({silver_reg_select('reg_raw')})"""

STG_REG_SELECT = """
  SELECT cod_empreendimento AS id_empreendimento, sigla_uf, cod_uf_ibge,
    regiao AS nome_regiao, municipio AS nome_municipio, cod_municipio_ibge,
    sigla_agente AS sigla_distribuidora, nome_agente AS nome_distribuidora,
    classe_consumo, subgrupo_tarifario, sigla_tipo_geracao, fonte_geracao, porte,
    sigla_modalidade, modalidade, qtd_uc_recebe_credito, potencia_kw, latitude, longitude,
    data_conexao, ano_conexao, mes_conexao
  FROM silver_reg
  WHERE potencia_kw IS NOT NULL AND potencia_kw > 0 AND data_conexao IS NOT NULL
    AND sigla_uf IS NOT NULL"""

STG_REG = SILVER_REG + f""",
stg_reg AS ({STG_REG_SELECT})"""

FACT_CAP_BODY = """,
fact_cap AS (
  SELECT c.sigla_uf, c.ano_conexao, c.mes_conexao, c.fonte_geracao, c.classe_consumo, c.porte,
    c.num_empreendimentos_novos,
    CAST(c.kw AS DOUBLE) AS potencia_kw_novos,
    -- kw has six decimals: whole millionths over 10^4 per hundredth, rounded half up
    CAST((2 * CAST(c.kw * 1000000 AS HUGEINT) + 10000 * c.num_empreendimentos_novos)
         // (20000 * c.num_empreendimentos_novos) AS DOUBLE) / 100 AS potencia_media_kw,
    u.sk_uf
  FROM (
    SELECT sigla_uf, ano_conexao, mes_conexao, fonte_geracao, classe_consumo, porte,
      CAST(count(*) AS BIGINT) AS num_empreendimentos_novos,
      CAST(sum(CAST(potencia_kw AS DECIMAL(28,6))) AS DECIMAL(30,6)) AS kw
    FROM stg_reg GROUP BY ALL
  ) c
  LEFT JOIN dim_uf u ON c.sigla_uf = u.sigla_uf
)"""

# generation and registry marts together
MARTS = FACT_GEN + "," + SILVER_REG + f""",
stg_reg AS ({STG_REG_SELECT})""" + FACT_CAP_BODY


def with_(ctes: str, select: str) -> str:
    return f"WITH {ctes}\n{select}"


ORACLE: dict[str, str] = {}


def _reg(name: str, sql: str) -> None:
    ORACLE[name] = sql


_reg("silver_generation", with_(SILVER_GEN, "SELECT * FROM silver_gen"))
_reg("stg_generation", with_(STG_GEN, "SELECT * FROM stg_gen"))
_reg("dim_state", with_(DIMS, "SELECT * FROM dim_uf"))
_reg("dim_source", with_(DIMS, "SELECT * FROM dim_fonte"))
_reg("fact_generation_monthly", with_(FACT_GEN, "SELECT * FROM fact_gen"))
_reg("generation_marts", with_(FACT_GEN, "SELECT * FROM fact_gen"))
_reg("silver_registry", with_(SILVER_REG, "SELECT * FROM silver_reg"))
_reg("stg_registry", with_(STG_REG, "SELECT * FROM stg_reg"))
_reg("fact_capacity", with_(MARTS, "SELECT * FROM fact_cap"))


# -- functions -----------------------------------------------------------------

_reg("noise_filter", with_(GEN_RAW, """
SELECT cod_modalidadeoperacao, val_geracao IS NULL AS valor_nulo, val_geracao = 0 AS valor_zero,
  CAST(count(*) AS BIGINT) AS n_linhas,
  CAST(sum(CASE WHEN NOT (cod_modalidadeoperacao = 'Pequenas Usinas (MMGD)' AND val_geracao = 0)
           THEN 1 ELSE 0 END) AS BIGINT) AS n_mantidas,
  CAST(sum(CASE WHEN NOT (cod_modalidadeoperacao = 'Pequenas Usinas (MMGD)' AND val_geracao = 0)
           THEN 1 ELSE 0 END) AS BIGINT) AS n_filtradas
FROM gen_raw GROUP BY ALL"""))

_reg("br_number", with_(REG_RAW, """
SELECT CodEmpreendimento AS id, MdaPotenciaInstaladaKW AS texto,
  TRY_CAST(replace(MdaPotenciaInstaladaKW, ',', '.') AS DOUBLE) AS potencia_kw,
  TRY_CAST(replace(replace(MdaPotenciaInstaladaKW, '.', ''), ',', '.') AS DOUBLE) AS potencia_kw_milhar,
  TRY_CAST(replace(NumCoordNEmpreendimento, ',', '.') AS DOUBLE) AS latitude,
  TRY_CAST(replace(NumCoordEEmpreendimento, ',', '.') AS DOUBLE) AS longitude
FROM reg_raw"""))

_reg("parse_date", with_(REG_RAW, """
SELECT CodEmpreendimento AS id, DthAtualizaCadastralEmpreend AS texto,
  CAST(try_strptime(DthAtualizaCadastralEmpreend, '%Y-%m-%d') AS DATE) AS data_conexao,
  CAST(year(try_strptime(DthAtualizaCadastralEmpreend, '%Y-%m-%d')) AS INTEGER) AS ano,
  CAST(month(try_strptime(DthAtualizaCadastralEmpreend, '%Y-%m-%d')) AS INTEGER) AS mes
FROM reg_raw"""))

# -- data-quality checks --------------------------------------------------------

MODEL_CTE = {
    "stg_generation": "stg_gen", "stg_registry": "stg_reg", "dim_state": "dim_uf",
    "dim_source": "dim_fonte", "fact_generation_monthly": "fact_gen", "fact_capacity": "fact_cap",
    "silver_registry": "silver_reg", "dim_state_distinct": "dim_uf_distinct",
}


def _head(model: str, col: str, test: str) -> str:
    return (f"SELECT '{test}_{model}_{col}' AS check_id, '{model}' AS model, "
            f"'{col}' AS column_name, '{test}' AS test, ")


def sql_not_null(model: str, col: str) -> str:
    return _head(model, col, "not_null") + \
        f"CAST(count_if({col} IS NULL) AS BIGINT) AS failures FROM {MODEL_CTE[model]}"


def sql_unique(model: str, col: str) -> str:
    return _head(model, col, "unique") + f"""CAST(count(*) AS BIGINT) AS failures FROM (
  SELECT {col} FROM {MODEL_CTE[model]} WHERE {col} IS NOT NULL GROUP BY {col} HAVING count(*) > 1) d"""


def sql_accepted(model: str, col: str, values) -> str:
    vals = ", ".join("'" + v.replace("'", "''") + "'" for v in values)
    return _head(model, col, "accepted_values") + f"""CAST(count(*) AS BIGINT) AS failures FROM (
  SELECT {col} FROM {MODEL_CTE[model]} WHERE {col} NOT IN ({vals}) GROUP BY {col}) d"""


def sql_relationship(model: str, col: str, parent: str, pcol: str) -> str:
    return _head(model, col, "relationships") + f"""CAST(count(*) AS BIGINT) AS failures
  FROM {MODEL_CTE[model]} ch LEFT JOIN {MODEL_CTE[parent]} pa ON ch.{col} = pa.{pcol}
  WHERE ch.{col} IS NOT NULL AND pa.{pcol} IS NULL"""


def sql_checks(parts) -> str:
    body = "\nUNION ALL\n".join(parts)
    return f"""SELECT *, failures <> 0 AS should_warn, failures <> 0 AS should_error FROM (
{body}) checks"""


CATEGORIES = ['Hídrica', 'Eólica', 'Solar', 'Nuclear', 'Biomassa', 'Térmica/Outras']
RENEWABLE = ['Hidráulica', 'Eólica', 'Fotovoltaica', 'Biomassa']
NOT_NULL_SQL = [sql_not_null(m, c) for m, cols in [
    ("stg_generation", ["ts_geracao", "sigla_uf", "geracao_mwh", "eh_renovavel"]),
    ("stg_registry", ["id_empreendimento", "sigla_uf", "potencia_kw", "data_conexao", "ano_conexao"]),
    ("dim_state", ["sigla_uf", "sk_uf"]),
    ("dim_source", ["fonte_combustivel", "categoria_simplificada"]),
    ("fact_generation_monthly", ["sigla_uf", "geracao_total_mwh"]),
    ("fact_capacity", ["sigla_uf", "potencia_kw_novos"]),
] for c in cols]
UNIQUE_SQL = [sql_unique("dim_state", "sigla_uf"), sql_unique("dim_state", "sk_uf"),
              sql_unique("dim_source", "fonte_combustivel")]
ACCEPTED_SQL = [sql_accepted("dim_source", "categoria_simplificada", CATEGORIES)]
REL_SQL = [sql_relationship("fact_generation_monthly", "sigla_uf", "dim_state", "sigla_uf"),
           sql_relationship("fact_capacity", "sigla_uf", "dim_state", "sigla_uf")]

_DIM_DISTINCT = """,
dim_uf_distinct AS (SELECT DISTINCT sigla_uf, nome_estado, nome_subsistema, cod_subsistema, eh_brasil
                    FROM stg_gen WHERE sigla_uf IS NOT NULL)"""

_reg("dq_not_null", with_(MARTS, sql_checks(NOT_NULL_SQL)))
_reg("dq_unique", with_(MARTS + _DIM_DISTINCT,
                        sql_checks(UNIQUE_SQL + [sql_unique("dim_state_distinct", "sigla_uf")])))
_reg("dq_accepted_values", with_(MARTS, sql_checks(
    ACCEPTED_SQL + [sql_accepted("stg_generation", "fonte_combustivel", RENEWABLE)])))
_reg("dq_relationships", with_(MARTS, sql_checks(
    REL_SQL + [sql_relationship("silver_registry", "sigla_uf", "dim_state", "sigla_uf")])))
_reg("dq_summary", with_(MARTS, sql_checks(NOT_NULL_SQL + UNIQUE_SQL + ACCEPTED_SQL + REL_SQL)))

GATE_EDGES = [
    ("dim_state", "stg_generation"), ("dim_source", "stg_generation"),
    ("fact_generation_monthly", "stg_generation"), ("fact_generation_monthly", "dim_state"),
    ("fact_generation_monthly", "dim_source"), ("fact_capacity", "stg_generation"),
    ("fact_capacity", "stg_registry"), ("fact_capacity", "dim_state"),
]
_edges = ", ".join(f"('{a}', '{b}')" for a, b in GATE_EDGES)
_reg("dq_gate", with_(MARTS + f""",
results AS ({sql_checks(NOT_NULL_SQL + UNIQUE_SQL + ACCEPTED_SQL + REL_SQL)}),
edges(model, upstream) AS (VALUES {_edges})""", """
SELECT e.model, CAST(count(r.check_id) AS BIGINT) AS n_checks,
  CAST(count_if(r.failures > 0) AS BIGINT) AS n_failed,
  CASE WHEN count_if(r.failures > 0) > 0 THEN 'blocked' ELSE 'ready' END AS status
FROM edges e LEFT JOIN results r ON r.model = e.upstream GROUP BY e.model"""))

# -- reports ------------------------------------------------------------------


def _pct(num: str, den: str, n: int) -> str:
    return (f"CAST(round(CAST({num} / nullif({den}, 0) * 100 AS DECIMAL(38,12)), {n}) "
            f"AS DOUBLE)")


_KW = _exact("potencia_kw_novos")
_MWH, _REN = _exact("geracao_total_mwh"), _exact("geracao_renovavel_mwh")
_SOLAR = "fonte_geracao = 'Radiação solar'"

_reg("kpi_total", with_(MARTS, f"""
SELECT {_MWH} AS total_mwh, {_MWH} / 1e6 AS total_twh
FROM fact_gen"""))

_reg("kpi_renewable_pct", with_(MARTS, f"""
SELECT {_REN} AS renovavel_mwh, {_MWH} AS total_mwh,
  {_pct(_REN, _MWH, 2)} AS pct_renovavel
FROM fact_gen"""))

_reg("kpi_capacity", with_(MARTS, f"""
SELECT {_KW} / 1e6 AS potencia_gw,
  CAST(coalesce(sum(num_empreendimentos_novos), 0) AS BIGINT) AS num_empreendimentos
FROM fact_cap WHERE {_SOLAR}"""))

_BY_STATE = f"""
SELECT sigla_uf, CAST(round(CAST({_MWH} AS DECIMAL(38,12)), 0) AS DOUBLE) AS total_mwh,
  {_pct(_REN, _MWH, 1)} AS pct_renovavel
FROM fact_gen {{where}} GROUP BY sigla_uf"""

_reg("top_states_renewable", with_(MARTS, _BY_STATE.format(where="") + """
ORDER BY pct_renovavel DESC NULLS FIRST, sigla_uf ASC NULLS LAST LIMIT 10"""))

_reg("top_states_capacity", with_(MARTS, f"""
SELECT sigla_uf, {_KW} / 1e6 AS potencia_gw,
  CAST(sum(num_empreendimentos_novos) AS BIGINT) AS num_empreendimentos
FROM fact_cap WHERE {_SOLAR} GROUP BY sigla_uf
ORDER BY potencia_gw DESC NULLS FIRST, sigla_uf ASC NULLS LAST LIMIT 10"""))

_reg("states_fully_renewable", with_(MARTS, f"""
SELECT sigla_uf, {_MWH} AS geracao_total_mwh FROM fact_gen GROUP BY sigla_uf
HAVING {_MWH} > 0 AND {_REN} = {_MWH}"""))

_reg("share_by_source", with_(MARTS, f"""
SELECT categoria_simplificada, geracao_mwh,
  {_pct('geracao_mwh', 'CAST(sum(CAST(geracao_mwh AS DECIMAL(28,6))) OVER () AS DOUBLE)', 2)} AS share_pct
FROM (SELECT d.categoria_simplificada, {_exact('f.geracao_total_mwh')} AS geracao_mwh
      FROM fact_gen f LEFT JOIN dim_fonte d ON f.fonte_combustivel = d.fonte_combustivel
      GROUP BY d.categoria_simplificada) s"""))

_reg("capacity_growth", with_(MARTS + f""",
per AS (SELECT ano_conexao, CAST(sum(CAST(potencia_kw_novos AS DECIMAL(28,6))) AS DECIMAL(30,6)) AS c,
          CAST(sum(num_empreendimentos_novos) AS BIGINT) AS num_empreendimentos
        FROM fact_cap WHERE {_SOLAR} GROUP BY ano_conexao),
w AS (SELECT *, first_value(c) OVER (ORDER BY ano_conexao) AS c_first,
        lag(c) OVER (ORDER BY ano_conexao) AS c_prev,
        sum(c) OVER (ORDER BY ano_conexao ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS c_acc
      FROM per)""", f"""
SELECT ano_conexao, CAST(c AS DOUBLE) AS potencia_kw, num_empreendimentos,
  CAST(c_acc AS DOUBLE) AS potencia_acumulada_kw,
  CAST(round(CAST(CAST(c AS DOUBLE) / nullif(c_first, 0) AS DECIMAL(38,12)), 2) AS DOUBLE) AS fator_vs_primeiro_ano,
  CAST(round(CAST(CAST(c AS DOUBLE) / nullif(c_prev, 0) AS DECIMAL(38,12)), 2) AS DOUBLE) AS fator_anual
FROM w"""))

_reg("sliced_report", with_(MARTS, _BY_STATE.format(
    where="WHERE ano_geracao IN (1997, 1998) AND fonte_combustivel IN "
          "('Hidráulica', 'Eólica', 'Fotovoltaica')")))

_reg("sliced_report_state", with_(MARTS, _BY_STATE.format(
    where="WHERE ano_geracao IN (1995, 1996) AND fonte_combustivel IN ('Hidráulica', 'Nuclear') "
          "AND sigla_uf IN ('NATION_1', 'NATION_18', 'NATION_7')")))

_reg("sliced_capacity", with_(MARTS, f"""
SELECT sigla_uf, ano_conexao, {_KW} AS potencia_kw,
  CAST(sum(num_empreendimentos_novos) AS BIGINT) AS num_empreendimentos
FROM fact_cap WHERE {_SOLAR} AND ano_conexao IN (1995, 1996)
  AND sigla_uf IN ('NATION_1', 'NATION_18', 'NATION_7')
GROUP BY sigla_uf, ano_conexao"""))

_reg("surrogate_key_orders", """
SELECT 'GD.' || CAST(o_orderkey AS VARCHAR) AS id, o_totalprice, o_orderpriority,
  CAST(row_number() OVER (ORDER BY 'GD.' || CAST(o_orderkey AS VARCHAR)) AS BIGINT) AS sk
FROM orders""")

_reg("state_year_capacity", with_(MARTS, f"""
SELECT sigla_uf, ano_conexao, {_KW} AS potencia_kw,
  CAST(sum(num_empreendimentos_novos) AS BIGINT) AS num_empreendimentos
FROM fact_cap WHERE {_SOLAR} GROUP BY sigla_uf, ano_conexao"""))

_reg("drill_across", with_(MARTS + f""",
g AS (SELECT sigla_uf, ano_geracao AS ano, mes_geracao AS mes,
        {_MWH} AS geracao_total_mwh, {_REN} AS geracao_renovavel_mwh
      FROM fact_gen GROUP BY ALL),
c AS (SELECT sigla_uf, ano_conexao AS ano, mes_conexao AS mes, {_KW} AS cc,
        CAST(sum(num_empreendimentos_novos) AS BIGINT) AS num_empreendimentos_solar
      FROM fact_cap WHERE {_SOLAR} GROUP BY ALL)""", f"""
SELECT coalesce(g.sigla_uf, c.sigla_uf) AS sigla_uf, coalesce(g.ano, c.ano) AS ano,
  coalesce(g.mes, c.mes) AS mes, g.geracao_total_mwh, g.geracao_renovavel_mwh,
  {_pct('g.geracao_renovavel_mwh', 'g.geracao_total_mwh', 2)} AS pct_renovavel,
  c.cc AS potencia_solar_kw, c.num_empreendimentos_solar
FROM g FULL OUTER JOIN c ON g.sigla_uf = c.sigla_uf AND g.ano = c.ano AND g.mes = c.mes"""))


# -- physical layer --------------------------------------------------------------

_SILVER_GEN_LEAK = with_(SILVER_GEN, """
SELECT *, CAST(year(din_instante) AS INTEGER) AS year, CAST(month(din_instante) AS INTEGER) AS month
FROM silver_gen""")
_reg("silver_generation_csv", _SILVER_GEN_LEAK)
_reg("silver_generation_stream", _SILVER_GEN_LEAK)
_reg("incremental_period", with_(SILVER_GEN, "SELECT * FROM silver_gen"))
_reg("incremental_marts", with_(FACT_GEN, "SELECT * FROM fact_gen"))

_reg("silver_registry_csv", with_(REG_RAW + f""",
silver_reg AS ({silver_reg_select('reg_raw', " DATE '2024-01-01' AS snapshot_date,")})""",
                                  "SELECT * FROM silver_reg"))

_reg("full_refresh_table", with_(FACT_GEN, "SELECT * FROM fact_gen"))

_reg("raw_landing", with_(REG_SNAPSHOTS, """
SELECT snapshot_date, CodEmpreendimento, SigUF, MdaPotenciaInstaladaKW, DscFonteGeracao FROM snap1
UNION ALL
SELECT snapshot_date, CodEmpreendimento, SigUF, MdaPotenciaInstaladaKW, DscFonteGeracao FROM snap2"""))

_reg("latest_snapshot", with_(REG_SNAPSHOTS + f""",
silver_reg AS ({silver_reg_select('snap2', ' snapshot_date,')})""", "SELECT * FROM silver_reg"))

_RAW_COLS = [
    "DatGeracaoConjuntoDados", "AnmPeriodoReferencia", "NumCNPJDistribuidora", "SigAgente",
    "NomAgente", "CodClasseConsumo", "DscClasseConsumo", "CodSubGrupoTarifario",
    "DscSubGrupoTarifario", "CodUFibge", "SigUF", "CodRegiao", "NomRegiao", "CodMunicipioIbge",
    "NomMunicipio", "CodCEP", "SigTipoConsumidor", "NumCPFCNPJ", "NomTitularEmpreendimento",
    "DthAtualizaCadastralEmpreend", "SigModalidadeEmpreendimento",
    "DscModalidadeHabilitado", "QtdUCRecebeCredito", "SigTipoGeracao", "DscFonteGeracao",
    "DscPorte", "NumCoordNEmpreendimento", "NumCoordEEmpreendimento", "MdaPotenciaInstaladaKW",
    "NomSubEstacao", "NumCoordESub", "NumCoordNSub"]
_DIFF = " OR ".join(f"a.{c} IS DISTINCT FROM b.{c}" for c in _RAW_COLS)
_reg("snapshot_delta", with_(REG_SNAPSHOTS, f"""
SELECT coalesce(b.CodEmpreendimento, a.CodEmpreendimento) AS id_empreendimento,
  CASE WHEN a.CodEmpreendimento IS NULL THEN 'added'
       WHEN b.CodEmpreendimento IS NULL THEN 'removed'
       WHEN {_DIFF} THEN 'changed' ELSE 'unchanged' END AS status
FROM snap1 a FULL OUTER JOIN snap2 b ON a.CodEmpreendimento = b.CodEmpreendimento"""))

_reg("select_resource", """
WITH p AS (SELECT page_id, url, printf('%d_%02d', 2020 + page_id % 5, 1 + page_id % 12) AS period
           FROM pages),
cat AS (
  SELECT page_id AS pos,
    CASE WHEN page_id % 7 = 0 THEN NULL ELSE 'GEN_' || period END AS name,
    CASE WHEN page_id % 3 = 0 THEN 'pdf' WHEN page_id % 3 = 1 THEN 'csv' ELSE 'CSV' END AS format,
    CASE WHEN page_id % 7 = 0 THEN url || '/GEN_' || period || '.csv' ELSE url END AS url
  FROM p)
SELECT pos, name, url FROM cat
WHERE upper(coalesce(format, '')) = 'CSV'
  AND (contains(upper(coalesce(name, '')), '2024_03') OR contains(upper(coalesce(url, '')), '2024_03'))
ORDER BY pos LIMIT 1""")


def _landing_sql(table: str, id_col: str, text_col: str) -> str:
    # '<html' (5 ASCII bytes) inside the first 100 bytes <=> its first
    # occurrence in the lower-cased text ends at byte offset <= 100
    return f"""
SELECT {id_col} AS item_id, CAST(octet_length(encode({text_col})) AS BIGINT) AS n_bytes,
  coalesce(strpos(lower({text_col}), '<html') > 0
    AND octet_length(encode(substr({text_col}, 1, strpos(lower({text_col}), '<html') + 4))) <= 100,
    false) AS is_html,
  '{table}' AS source
FROM {table}"""


_reg("landing_check", f"""
SELECT item_id, n_bytes, is_html, n_bytes > 0 AND NOT is_html AS ok, source FROM (
{_landing_sql('pages', 'page_id', 'html')}
UNION ALL
{_landing_sql('documents', 'doc_id', 'text')}) t""")

_reg("named_sources", with_(STG_GEN, "SELECT * FROM stg_gen"))
_reg("medallion_build", with_(FACT_GEN, "SELECT * FROM fact_gen"))


# -- publishing, views, audit, versions, gated builds ------------------------------

_reg("published_table", with_(FACT_GEN, "SELECT * FROM fact_gen"))
_reg("persistent_view", with_(STG_GEN, "SELECT * FROM stg_gen"))

_reg("write_audit", with_(SILVER_GEN + "," + SILVER_REG, """
SELECT 'silver_generation' AS table_name, count(*) AS rows, count(*) AS rows_stored,
  CAST(1 AS BIGINT) AS lineage_values, CAST(0 AS BIGINT) AS lineage_nulls, true AS one_instant FROM silver_gen
UNION ALL
SELECT 'silver_registry', count(*), count(*), 1, 0, true FROM silver_reg"""))

_reg("plants_rollup", with_(STG_GEN, """
SELECT sigla_uf, ano_geracao, count(DISTINCT id_usina) AS num_usinas, true AS dentro_de_5pct
FROM stg_gen WHERE eh_brasil GROUP BY sigla_uf, ano_geracao"""))

_reg("newest_records", with_(REG_SNAPSHOTS + """,
landed AS (
  SELECT snapshot_date, CodEmpreendimento, SigUF, MdaPotenciaInstaladaKW, DscFonteGeracao FROM snap1
  UNION ALL
  SELECT snapshot_date, CodEmpreendimento, SigUF, MdaPotenciaInstaladaKW, DscFonteGeracao FROM snap2),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY CodEmpreendimento ORDER BY snapshot_date DESC NULLS LAST,
    SigUF DESC NULLS LAST, MdaPotenciaInstaladaKW DESC NULLS LAST, DscFonteGeracao DESC NULLS LAST) AS r
  FROM landed)""", """
SELECT snapshot_date, CodEmpreendimento, SigUF, MdaPotenciaInstaladaKW, DscFonteGeracao
FROM numbered WHERE r = 1 OR CodEmpreendimento IS NULL"""))

_reg("catalogue_document", """
WITH p AS (SELECT page_id, url, printf('%d_%02d', 2020 + page_id % 5, 1 + page_id % 12) AS period,
             page_id // 1000 AS catalogue FROM pages),
cat AS (
  SELECT catalogue, CAST(row_number() OVER (PARTITION BY catalogue ORDER BY page_id) - 1 AS INTEGER) AS pos,
    CASE WHEN page_id % 7 = 0 THEN NULL ELSE 'GEN_' || period END AS name,
    CASE WHEN page_id % 3 = 0 THEN 'pdf' WHEN page_id % 3 = 1 THEN 'csv' ELSE 'CSV' END AS format,
    CASE WHEN page_id % 7 = 0 THEN url || '/GEN_' || period || '.csv' ELSE url END AS url
  FROM p)
SELECT catalogue, pos, name, url FROM cat
WHERE upper(coalesce(format, '')) = 'CSV'
  AND (contains(upper(coalesce(name, '')), '2024_03') OR contains(upper(coalesce(url, '')), '2024_03'))
QUALIFY row_number() OVER (PARTITION BY catalogue ORDER BY pos) = 1""")

# rows with a state and a fuel only; the gate's verdicts follow from the check rules
_SOUND_MARTS = MARTS.replace("WHERE val_geracao IS NOT NULL AND val_geracao >= 0",
                             "WHERE val_geracao IS NOT NULL AND val_geracao >= 0 AND id_estado IS NOT NULL "
                             "AND nom_tipocombustivel IS NOT NULL")
_reg("gated_build", with_(_SOUND_MARTS, """
SELECT build, model, CASE WHEN reasons = '' THEN 'ready' ELSE 'blocked' END AS status,
  CASE WHEN reasons = '' THEN n END AS rows, reasons
FROM (
  SELECT b.build, m.model, m.n, CASE WHEN m.model <> 'fact_capacity' THEN ''
      WHEN b.build = 'unchecked' THEN 'not_run_stg_registry'
      WHEN b.build = 'lost_ids' AND (SELECT count(*) FROM stg_reg WHERE sigla_uf = 'NATION_3') > 0
        THEN 'not_null_stg_registry_id_empreendimento'
      ELSE '' END AS reasons
  FROM (SELECT unnest(['sound', 'lost_ids', 'unchecked']) AS build) b,
    (SELECT 'dim_state' AS model, count(*) AS n FROM dim_uf
     UNION ALL SELECT 'dim_source', count(*) FROM dim_fonte
     UNION ALL SELECT 'fact_generation_monthly', count(*) FROM fact_gen
     UNION ALL SELECT 'fact_capacity', count(*) FROM fact_cap) m)"""))
