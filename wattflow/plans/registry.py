"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per key.

Each callable builds its input from the driver tables through the fixture
adapters and runs the library operators; ``oracle.ORACLE`` holds the
independent SQL for the same key. Non-deterministic lineage columns
(``processed_at``) are left out of registered outputs.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

from wattflow.operators import dims, facts, reports, silver, staging
from wattflow.schemas import SOLAR_SOURCE
from wattflow.sources import fixtures as fx

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}


def register(name: str):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        return fn
    return deco


# -- shared building blocks --------------------------------------------------

def silver_gen(spark: SparkSession, sf_dir: str, lineage: bool = False) -> DataFrame:
    return silver.silver_generation(fx.gen_raw(spark, sf_dir), lineage=lineage)


def stg_gen(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.stg_generation(silver_gen(spark, sf_dir))


def silver_reg(spark: SparkSession, sf_dir: str, lineage: bool = False) -> DataFrame:
    return silver.silver_registry(fx.reg_raw(spark, sf_dir), lineage=lineage)


def stg_reg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.stg_registry(silver_reg(spark, sf_dir))


def marts_gen(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Both dimensions and the monthly fact from one staged pre-aggregate."""
    from wattflow.plans.marts import generation_marts
    return generation_marts(stg_gen(spark, sf_dir))


def fact_gen(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts_gen(spark, sf_dir)["fact_generation_monthly"]


def fact_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.capacity_fact(stg_reg(spark, sf_dir), dims.dim_state(stg_gen(spark, sf_dir)))


def stored_gen(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The generation marts as the reports find them: written once a session."""
    from wattflow.plans.marts import stored_marts
    return stored_marts(spark, sf_dir, "generation", lambda: marts_gen(spark, sf_dir))


def stored_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored_gen(spark, sf_dir)["fact_generation_monthly"]


def measured_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The capacity fact without its key, written once a session: the reports
    on it read none, so the generation table behind the state dimension is
    never scanned."""
    from wattflow.plans.marts import stored_marts
    return stored_marts(spark, sf_dir, "capacity", lambda: {
        "fact_capacity": facts.capacity_fact(stg_reg(spark, sf_dir))})["fact_capacity"]


# -- silver / staging / marts -----------------------------------------------

@register("silver_generation")
def q_silver_generation(spark, sf_dir):
    return silver_gen(spark, sf_dir)


@register("stg_generation")
def q_stg_generation(spark, sf_dir):
    return stg_gen(spark, sf_dir)


@register("dim_state")
def q_dim_state(spark, sf_dir):
    return dims.dim_state(stg_gen(spark, sf_dir))


@register("dim_source")
def q_dim_source(spark, sf_dir):
    return dims.dim_source(stg_gen(spark, sf_dir))


@register("generation_marts")
def q_generation_marts(spark, sf_dir):
    """Monthly fact built together with both dimensions from one staged pass."""
    return marts_gen(spark, sf_dir)["fact_generation_monthly"]


@register("fact_generation_monthly")
def q_fact_generation_monthly(spark, sf_dir):
    """Monthly fact of the one-pass build."""
    return fact_gen(spark, sf_dir)


@register("silver_registry")
def q_silver_registry(spark, sf_dir):
    return silver_reg(spark, sf_dir)


@register("stg_registry")
def q_stg_registry(spark, sf_dir):
    return stg_reg(spark, sf_dir)


@register("fact_capacity")
def q_fact_capacity(spark, sf_dir):
    return fact_cap(spark, sf_dir)


# -- functions / filters on their own ------------------------------------------

@register("noise_filter")
def q_noise_filter(spark, sf_dir):
    """Rows before/after the noise filter per (mode, value null, value zero)."""
    from pyspark.sql import functions as F
    from wattflow.operators.clean import noise_filter
    from wattflow.schemas import SMALL_PLANTS_MODE
    raw = fx.gen_raw(spark, sf_dir)
    kept = ~((F.col("cod_modalidadeoperacao") == SMALL_PLANTS_MODE) & (F.col("val_geracao") == 0))
    groups = ["cod_modalidadeoperacao", F.col("val_geracao").isNull().alias("valor_nulo"),
              (F.col("val_geracao") == 0).alias("valor_zero")]
    before = raw.groupBy(*groups).agg(F.count(F.lit(1)).alias("n_linhas"),
                                      F.count_if(kept).alias("n_mantidas"))
    after = noise_filter(raw, "cod_modalidadeoperacao", SMALL_PLANTS_MODE, "val_geracao")
    check = after.groupBy(*groups).agg(F.count(F.lit(1)).alias("n_filtradas"))
    keys = ["cod_modalidadeoperacao", "valor_nulo", "valor_zero"]
    check = check.select(*[F.col(k).alias("_" + k) for k in keys], "n_filtradas")
    cond = None
    for k in keys:  # group keys may be null: null-safe equality
        term = before[k].eqNullSafe(check["_" + k])
        cond = term if cond is None else cond & term
    return before.join(check, cond, "left").select(
        *keys, "n_linhas", "n_mantidas",
        F.coalesce("n_filtradas", F.lit(0)).cast("bigint").alias("n_filtradas"))


@register("br_number")
def q_br_number(spark, sf_dir):
    """Brazilian number text -> double, default and thousands-aware."""
    from pyspark.sql import functions as F
    from wattflow.functions import br_number
    raw = fx.reg_raw(spark, sf_dir)
    return raw.select(
        F.col("CodEmpreendimento").alias("id"),
        F.col("MdaPotenciaInstaladaKW").alias("texto"),
        br_number("MdaPotenciaInstaladaKW").alias("potencia_kw"),
        br_number("MdaPotenciaInstaladaKW", thousands=True).alias("potencia_kw_milhar"),
        br_number("NumCoordNEmpreendimento").alias("latitude"),
        br_number("NumCoordEEmpreendimento").alias("longitude"),
    )


@register("parse_date")
def q_parse_date(spark, sf_dir):
    """Strict yyyy-MM-dd text -> date, year and month."""
    from pyspark.sql import functions as F
    from wattflow.functions import parse_date
    raw = fx.reg_raw(spark, sf_dir)
    d = parse_date("DthAtualizaCadastralEmpreend")
    return raw.select(F.col("CodEmpreendimento").alias("id"),
                      F.col("DthAtualizaCadastralEmpreend").alias("texto"),
                      d.alias("data_conexao"), F.year(d).alias("ano"), F.month(d).alias("mes"))


# -- data-quality checks --------------------------------------------------------

class _OnDemand(Mapping):
    """Models by name, each built on first access and then kept: a check run
    that never reads a model never builds (or stages) it."""

    def __init__(self, builders: dict[str, Callable[[], DataFrame]]):
        self._builders = builders
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._builders[name]()
        return self._built[name]

    def __iter__(self):
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)


def models(spark: SparkSession, sf_dir: str) -> Mapping[str, DataFrame]:
    """The six checked models: staging lazily (each check scan is fused); the
    generation marts derived from the staged pre-aggregate and written once;
    the capacity fact staged once, since re-deriving it would
    rescan the registry for every check that reads it. Models are built on
    first access, so e.g. the key checks never stage the capacity fact."""
    from wattflow.plans.marts import generation_marts
    from wattflow.session import stage
    cache: dict[str, object] = {}

    def stg_g():
        if "stg_g" not in cache:
            cache["stg_g"] = stg_gen(spark, sf_dir)
        return cache["stg_g"]

    def stg_r():
        if "stg_r" not in cache:
            cache["stg_r"] = stg_reg(spark, sf_dir)
        return cache["stg_r"]

    def marts():
        if "marts" not in cache:
            cache["marts"] = generation_marts(stg_g(), stage_fact=True)
        return cache["marts"]

    return _OnDemand({
        "stg_generation": stg_g,
        "stg_registry": stg_r,
        "dim_state": lambda: marts()["dim_state"],
        "dim_source": lambda: marts()["dim_source"],
        "fact_generation_monthly": lambda: marts()["fact_generation_monthly"],
        "fact_capacity": lambda: stage(facts.capacity_fact(stg_r(), marts()["dim_state"])),
    })


@register("dq_not_null")
def q_dq_not_null(spark, sf_dir):
    from wattflow.operators.quality import REFERENCE_SUITE
    return REFERENCE_SUITE.run(models(spark, sf_dir), only=["not_null"])


@register("dq_unique")
def q_dq_unique(spark, sf_dir):
    """The three key checks, plus the pre-fix DISTINCT state dimension
    (regression: several rows per state when descriptors vary)."""
    from wattflow.operators import quality
    m = models(spark, sf_dir)
    prefix = m["stg_generation"].filter("sigla_uf IS NOT NULL").select(
        "sigla_uf", "nome_estado", "nome_subsistema", "cod_subsistema", "eh_brasil").distinct()
    res = quality.REFERENCE_SUITE.run(m, only=["unique"])
    return res.unionByName(quality.unique(prefix, "dim_state_distinct", "sigla_uf"))


@register("dq_accepted_values")
def q_dq_accepted_values(spark, sf_dir):
    """Category domain check, plus a failing one (fuel names vs renewable list)."""
    from wattflow.operators import quality
    from wattflow.schemas import RENEWABLE_FUELS
    m = models(spark, sf_dir)
    res = quality.REFERENCE_SUITE.run(m, only=["accepted_values"])
    return res.unionByName(quality.accepted_values(
        m["stg_generation"], "stg_generation", "fonte_combustivel", RENEWABLE_FUELS))


@register("dq_relationships")
def q_dq_relationships(spark, sf_dir):
    from wattflow.operators import quality
    m = models(spark, sf_dir)
    res = quality.REFERENCE_SUITE.run(m, only=["relationships"])
    # registry states checked against the generation-built dimension: states
    # present only in the registry would be orphans (null states are skipped)
    return res.unionByName(quality.relationships(
        silver_reg(spark, sf_dir), "silver_registry", "sigla_uf", m["dim_state"], "sigla_uf"))


@register("dq_summary")
def q_dq_summary(spark, sf_dir):
    """All 23 checks, each model read once."""
    from wattflow.operators.quality import REFERENCE_SUITE
    return REFERENCE_SUITE.run_once(models(spark, sf_dir))


@register("dq_gate")
def q_dq_gate(spark, sf_dir):
    from wattflow.operators.quality import REFERENCE_SUITE, gate
    return gate(REFERENCE_SUITE.run_once(models(spark, sf_dir)))


# -- reports ------------------------------------------------------------------

@register("kpi_total")
def q_kpi_total(spark, sf_dir):
    return reports.kpi_total(stored_fact(spark, sf_dir))


@register("kpi_renewable_pct")
def q_kpi_renewable_pct(spark, sf_dir):
    return reports.kpi_renewable_pct(stored_fact(spark, sf_dir))


@register("kpi_capacity")
def q_kpi_capacity(spark, sf_dir):
    return reports.kpi_capacity(measured_cap(spark, sf_dir))


@register("top_states_renewable")
def q_top_states_renewable(spark, sf_dir):
    return reports.top_states_renewable(stored_fact(spark, sf_dir), 10)


@register("top_states_capacity")
def q_top_states_capacity(spark, sf_dir):
    return reports.top_states_capacity(measured_cap(spark, sf_dir), 10)


@register("states_fully_renewable")
def q_states_fully_renewable(spark, sf_dir):
    return reports.states_fully_renewable(stored_fact(spark, sf_dir))


@register("share_by_source")
def q_share_by_source(spark, sf_dir):
    m = stored_gen(spark, sf_dir)
    return reports.share_by_source(m["fact_generation_monthly"], m["dim_source"])


@register("capacity_growth")
def q_capacity_growth(spark, sf_dir):
    return reports.capacity_growth(measured_cap(spark, sf_dir))


# FIXED VALUES of the sliced report used as a registered example.
SLICE_YEARS = [1997, 1998]
SLICE_FUELS = ["Hidráulica", "Eólica", "Fotovoltaica"]


@register("sliced_report")
def q_sliced_report(spark, sf_dir):
    sliced = reports.slice_generation(stored_fact(spark, sf_dir), years=SLICE_YEARS,
                                      fuels=SLICE_FUELS)
    return reports.by_state_renewable(sliced)


@register("state_year_capacity")
def q_state_year_capacity(spark, sf_dir):
    return reports.state_year_capacity(measured_cap(spark, sf_dir))


@register("drill_across")
def q_drill_across(spark, sf_dir):
    return reports.drill_across(stored_fact(spark, sf_dir), measured_cap(spark, sf_dir))


@register("sliced_report_state")
def q_sliced_report_state(spark, sf_dir):
    """State table under year, fuel and state slicers together."""
    return reports.by_state_renewable(reports.slice_generation(
        stored_fact(spark, sf_dir), years=[1995, 1996], fuels=["Hidráulica", "Nuclear"],
        states=["NATION_1", "NATION_18", "NATION_7"]))


@register("sliced_capacity")
def q_sliced_capacity(spark, sf_dir):
    """Capacity per state and year under year, source and state slicers."""
    cap = reports.slice_capacity(measured_cap(spark, sf_dir), years=[1995, 1996], sources=[SOLAR_SOURCE],
                                 states=["NATION_1", "NATION_18", "NATION_7"])
    return reports.state_year_capacity(cap)


@register("surrogate_key_orders")
def q_surrogate_key_orders(spark, sf_dir):
    """Every order numbered by its text key."""
    from pyspark.sql import functions as F
    orders = fx.table(spark, sf_dir, "orders", "o_orderkey", "o_totalprice", "o_orderpriority")
    keyed = orders.select(F.concat(F.lit("GD."), F.col("o_orderkey").cast("string")).alias("id"),
                          "o_totalprice", "o_orderpriority")
    return dims.surrogate_key(keyed, ["id"], "sk")


# -- physical layer: files, tables, landings, snapshots, streams --------------

def _land_generation(spark: SparkSession, sf_dir: str) -> str:
    """Land the hourly raw rows as CSV under year=YYYY/month=MM; return the root."""
    from pyspark.sql import functions as F
    from wattflow.session import scratch_path
    from wattflow.sinks import land_raw
    root = scratch_path(spark, "bronze-generation")
    raw = fx.gen_raw(spark, sf_dir).withColumns({
        "year": F.date_format("din_instante", "yyyy"),
        "month": F.date_format("din_instante", "MM"),
    })
    land_raw(raw, root, partition_cols=["year", "month"], encoding="UTF-8", compression="gzip")
    return root


def _land_snapshots(spark: SparkSession, sf_dir: str, restate: bool = True) -> str:
    """Land both registry snapshots (ISO-8859-1). With ``restate`` the second
    one is first landed from the unfiltered registry and then replaced."""
    from wattflow.session import scratch_path
    from wattflow.sinks import land_raw
    root = scratch_path(spark, "bronze-registry")
    (d1, _, _), (d2, _, _) = fx.SNAPSHOTS
    packed = {"encoding": "ISO-8859-1", "compression": "gzip"}
    land_raw(fx.reg_snapshot(spark, sf_dir, 0), root, {"snapshot_date": d1}, **packed)
    if restate:
        land_raw(fx.reg_raw(spark, sf_dir), root, {"snapshot_date": d2}, **packed)
    land_raw(fx.reg_snapshot(spark, sf_dir, 1), root, {"snapshot_date": d2}, **packed)
    return root


def _drop_lineage(df: DataFrame) -> DataFrame:
    return df.drop("processed_at")


@register("silver_generation_csv")
def q_silver_generation_csv(spark, sf_dir):
    """CSV bronze round trip: land, typed scan with partition discovery
    (``year``/``month`` leak into silver), transform, partitioned Parquet
    write, read back."""
    from wattflow.session import scratch_path
    from wattflow.sinks import write_partitioned
    from wattflow.sources.delimited import read_generation_bronze, read_silver
    bronze = _land_generation(spark, sf_dir)
    out = scratch_path(spark, "silver-generation")
    write_partitioned(silver.silver_generation(read_generation_bronze(spark, bronze)), out,
                      ["ano", "mes"], rebalance=False)  # landed by month: few files a task without a shuffle
    return _drop_lineage(read_silver(spark, out))


@register("silver_registry_csv")
def q_silver_registry_csv(spark, sf_dir):
    """ISO-8859-1 quoted CSV round trip of one registry snapshot."""
    from wattflow.session import scratch_path
    from wattflow.sinks import land_raw, write_partitioned
    from wattflow.sources.delimited import read_registry_bronze, read_silver
    bronze = scratch_path(spark, "bronze-registry")
    land_raw(fx.reg_raw(spark, sf_dir), bronze, {"snapshot_date": fx.SNAPSHOTS[0][0]},
             encoding="ISO-8859-1")
    out = scratch_path(spark, "silver-registry")
    write_partitioned(silver.silver_registry(read_registry_bronze(spark, bronze, "all")), out,
                      ["ano_conexao"])
    return _drop_lineage(read_silver(spark, out))


@register("full_refresh_table")
def q_full_refresh_table(spark, sf_dir):
    """Monthly fact published as a catalog table in its own namespace, read back."""
    from wattflow.session import scratch_path
    from wattflow.sinks import ensure_namespace, materialize
    ensure_namespace(spark, "wattflow_marts", scratch_path(spark, "ns-marts"))
    table_df, _ = materialize(fact_gen(spark, sf_dir), "fact_generation_monthly", "table",
                              "wattflow_marts", path=scratch_path(spark, "fact-generation"))
    return table_df


@register("published_table")
def q_published_table(spark, sf_dir):
    """Monthly fact published three times: some years; a rebuild that its
    check refuses, so the first rows stay; all years. Read back by name."""
    from pyspark.sql import functions as F
    from wattflow.operators.quality import not_null
    from wattflow.session import scratch_path, stage
    from wattflow.sinks import PublishRefused, ensure_namespace, publish
    ensure_namespace(spark, "wattflow_published", scratch_path(spark, "ns-published"))
    root = scratch_path(spark, "published")
    fact = stage(fact_gen(spark, sf_dir), "fact")

    def complete(t):
        return not_null(t, "fact_generation_monthly", ["ano_geracao", "geracao_total_mwh"])

    def put(df):
        return publish(df, "wattflow_published", "fact_generation_monthly", root, complete)[0]

    put(fact.filter("ano_geracao < 1996"))
    try:
        put(fact.withColumn("geracao_total_mwh", F.when(F.col("ano_geracao") < 1996, F.col("geracao_total_mwh"))))
    except PublishRefused:
        return put(fact)
    raise AssertionError("a table with missing totals was published")


@register("persistent_view")
def q_persistent_view(spark, sf_dir):
    """Generation staging as a persistent view over a registered source."""
    from wattflow.session import scratch_path
    from wattflow.sinks import create_view, ensure_namespace, write_partitioned
    from wattflow.sources.named import register_sources
    path = scratch_path(spark, "silver-viewed")
    write_partitioned(silver_gen(spark, sf_dir), path, ["ano", "mes"])
    register_sources(spark, "wattflow_raw", {"generation_viewed": path}, location=scratch_path(spark, "ns-raw"))
    ensure_namespace(spark, "wattflow_staging", scratch_path(spark, "ns-staging"))
    return create_view(spark, "wattflow_staging", "stg_generation",
                       staging.generation_view_sql("`wattflow_raw`.`generation_viewed`"))


@register("write_audit")
def q_write_audit(spark, sf_dir):
    """Audit rows of both silver writes beside what is stored: rows, lineage
    instants (one a write) and rows without one."""
    from pyspark.sql import functions as F
    from wattflow.session import scratch_path
    from wattflow.sinks import read_audit, write_audited
    from wattflow.sources.delimited import read_silver
    root = scratch_path(spark, "audited")
    stored = None
    for name, df, keys in (("silver_generation", silver_gen(spark, sf_dir, lineage=True), ["ano", "mes"]),
                           ("silver_registry", silver_reg(spark, sf_dir, lineage=True), ["ano_conexao"])):
        write_audited(df, f"{root}/{name}", name, f"{root}/audit", keys)
        found = read_silver(spark, f"{root}/{name}").agg(
            F.count(F.lit(1)).alias("rows_stored"), F.count_distinct("processed_at").alias("lineage_values"),
            F.min("processed_at").alias("first")).withColumn("table_name", F.lit(name))
        stored = found if stored is None else stored.unionByName(found)
    return read_audit(spark, f"{root}/audit").join(stored, "table_name").select(
        "table_name", "rows", "rows_stored", "lineage_values", "lineage_nulls",
        ((F.col("lineage_first") == F.col("first")) & (F.col("lineage_last") == F.col("first"))).alias("one_instant"))


@register("plants_rollup")
def q_plants_rollup(spark, sf_dir):
    """Distinct plants per state and year: exact, and whether the estimate
    merged from the monthly sketches is within 5 % (or one plant)."""
    from pyspark.sql import functions as F
    from wattflow.session import stage
    pre = stage(facts.pre_aggregate_generation(stg_gen(spark, sf_dir)), "generation-pre")
    keys = ["sigla_uf", "ano_geracao"]
    exact = pre.filter("eh_brasil").groupBy(*keys).agg(F.count_distinct("id_usina").alias("num_usinas"))
    rolled = facts.rolled_up_plants(facts.plant_sketches(pre), *keys).withColumnsRenamed({k: "_" + k for k in keys})
    same = [F.col(k).eqNullSafe(F.col("_" + k)) for k in keys]
    error = F.abs(F.col("num_usinas_estimado") - F.col("num_usinas"))
    return exact.join(rolled, same[0] & same[1], "left").select(
        *keys, "num_usinas", (error <= F.greatest(F.lit(1.0), 0.05 * F.col("num_usinas"))).alias("dentro_de_5pct"))


@register("newest_records")
def q_newest_records(spark, sf_dir):
    """Each installation's newest record over all landed snapshots."""
    from wattflow.operators.snapshots import newest_records
    from wattflow.schemas import REGISTRY_RAW
    from wattflow.sources.delimited import read_delimited
    landed = read_delimited(spark, _land_snapshots(spark, sf_dir, restate=False), REGISTRY_RAW, encoding="ISO-8859-1")
    return newest_records(landed.select("snapshot_date", "CodEmpreendimento", "SigUF", "MdaPotenciaInstaladaKW",
                                        "DscFonteGeracao"), "CodEmpreendimento", "snapshot_date")


@register("raw_landing")
def q_raw_landing(spark, sf_dir):
    """Two snapshots landed, the second replaced by a re-landing; read back."""
    from pyspark.sql import functions as F
    from wattflow.schemas import REGISTRY_RAW
    from wattflow.sources.delimited import read_delimited
    root = _land_snapshots(spark, sf_dir, restate=True)
    df = read_delimited(spark, root, REGISTRY_RAW, encoding="ISO-8859-1")
    return df.select(F.col("snapshot_date"), "CodEmpreendimento", "SigUF",
                     "MdaPotenciaInstaladaKW", "DscFonteGeracao")


@register("latest_snapshot")
def q_latest_snapshot(spark, sf_dir):
    """Silver registry of the newest landed snapshot only."""
    from wattflow.sources.delimited import read_registry_bronze
    root = _land_snapshots(spark, sf_dir, restate=False)
    return silver.silver_registry(read_registry_bronze(spark, root, "latest"), lineage=False)


@register("snapshot_delta")
def q_snapshot_delta(spark, sf_dir):
    """Installations added / removed / changed / unchanged between snapshots."""
    from pyspark.sql import functions as F
    from wattflow.operators.snapshots import snapshot_delta
    prev = fx.reg_snapshot(spark, sf_dir, 0)
    curr = fx.reg_snapshot(spark, sf_dir, 1)
    return snapshot_delta(prev, curr, "CodEmpreendimento").withColumnRenamed(
        "CodEmpreendimento", "id_empreendimento").select("id_empreendimento", F.col("status"))


# FIXED VALUES: the period re-loaded by the incremental example.
INCREMENTAL_PERIOD = (1997, 3)


@register("incremental_period")
def q_incremental_period(spark, sf_dir):
    """Silver written with a stale period, then that period alone re-loaded
    with dynamic partition overwrite; every other period is untouched."""
    from pyspark.sql import functions as F
    from wattflow.session import scratch_path
    from wattflow.sinks import write_partitioned
    from wattflow.sources.delimited import read_silver
    y, m = INCREMENTAL_PERIOD
    full = silver_gen(spark, sf_dir)
    in_period = (F.col("ano") == y) & (F.col("mes") == m)
    stale = full.withColumn("val_geracao", F.when(in_period, -F.col("val_geracao"))
                            .otherwise(F.col("val_geracao")))
    out = scratch_path(spark, "silver-incremental")
    write_partitioned(stale, out, ["ano", "mes"])
    write_partitioned(full.filter(in_period), out, ["ano", "mes"], dynamic=True)
    return read_silver(spark, out)


@register("incremental_marts")
def q_incremental_marts(spark, sf_dir):
    """Marts built while one month is stale and the next is not there yet,
    then refreshed for these two months alone; the fact as stored."""
    from pyspark.sql import functions as F
    from wattflow.plans.incremental import in_months, refresh_generation
    from wattflow.session import scratch_path
    from wattflow.sinks import write_partitioned
    from wattflow.sources.delimited import read_silver
    y, m = INCREMENTAL_PERIOD
    months = [(y, m), (y, m + 1)]
    silver_path, root = scratch_path(spark, "silver-marts"), scratch_path(spark, "marts")
    full = silver_gen(spark, sf_dir)
    stale = full.filter(~in_months(months[1:], "ano", "mes")).withColumn("val_geracao", F.when(
        in_months(months[:1], "ano", "mes"), 2 * F.col("val_geracao")).otherwise(F.col("val_geracao")))
    write_partitioned(stale, silver_path, ["ano", "mes"])
    refresh_generation(spark, silver_path, root)
    write_partitioned(full.filter(in_months(months, "ano", "mes")), silver_path, ["ano", "mes"], dynamic=True)
    done = refresh_generation(spark, silver_path, root, months)
    return read_silver(spark, done.paths["fact_generation_monthly"])


@register("silver_generation_stream")
def q_silver_generation_stream(spark, sf_dir):
    """Structured Streaming (availableNow) from the landed CSVs to silver."""
    from wattflow.session import scratch_path
    from wattflow.sources.delimited import read_silver
    from wattflow.streaming import run_silver_generation
    bronze = _land_generation(spark, sf_dir)
    out = scratch_path(spark, "silver-stream")
    run_silver_generation(spark, bronze, out, scratch_path(spark, "ckpt-stream"), lineage=False)
    return read_silver(spark, out)


@register("select_resource")
def q_select_resource(spark, sf_dir):
    """CSV resource of 2024-03 in the catalogue derived from ``pages``."""
    from wattflow.sources.catalogue import select_resource
    return select_resource(fx.catalogue_rows(spark, sf_dir), 2024, 3)


@register("catalogue_document")
def q_catalogue_document(spark, sf_dir):
    """CSV resource of 2024-03 in each catalogue: JSON documents of up to a
    thousand resources, written from ``pages`` and read by position."""
    from pyspark.sql import functions as F
    from wattflow.session import scratch_path
    from wattflow.sources.catalogue import read_catalogues, select_resources, write_catalogues
    path = scratch_path(spark, "catalogues")
    write_catalogues(fx.catalogue_rows(spark, sf_dir).withColumn("catalogue", F.expr("pos div 1000")), path)
    return select_resources(read_catalogues(spark, path), 2024, 3)


@register("landing_check")
def q_landing_check(spark, sf_dir):
    """Landing rule (non-empty, no HTML in the first 100 bytes) on page HTML
    and document texts."""
    from pyspark.sql import functions as F
    from wattflow.sources.landing import text_check
    pages = text_check(fx.table(spark, sf_dir, "pages", "page_id", "html"), "page_id", "html").withColumn(
        "source", F.lit("pages"))
    docs = text_check(fx.table(spark, sf_dir, "documents", "doc_id", "text"), "doc_id", "text").withColumn(
        "source", F.lit("documents"))
    return pages.unionByName(docs)


@register("named_sources")
def q_named_sources(spark, sf_dir):
    """Silver written once, declared as ``raw.generation`` (no copy) and read
    back by name into the staging view."""
    from wattflow.session import scratch_path
    from wattflow.sinks import write_partitioned
    from wattflow.sources.named import register_sources, source
    path = scratch_path(spark, "silver-named")
    write_partitioned(silver_gen(spark, sf_dir), path, ["ano", "mes"])
    register_sources(spark, "wattflow_raw", {"generation": path},
                     location=scratch_path(spark, "ns-raw"))
    return staging.stg_generation(source(spark, "wattflow_raw", "generation"))


@register("medallion_build")
def q_medallion_build(spark, sf_dir):
    """The whole build from landed bronze CSVs (latest registry snapshot),
    checks reported rather than enforced; returns the written monthly fact."""
    from wattflow.plans.build import build_all
    from wattflow.session import scratch_path
    res = build_all(spark, _land_generation(spark, sf_dir), _land_snapshots(spark, sf_dir),
                    scratch_path(spark, "build"), snapshot="latest", enforce=False)
    return spark.read.parquet(res.paths["fact_generation_monthly"])


@register("gated_build")
def q_gated_build(spark, sf_dir):
    """Enforced builds on rows with state and fuel: with a sound registry; with
    one whose installations of a state lost their ids; with a registry that
    no check has seen. One row a build and mart: written or why not."""
    from dataclasses import replace
    from pyspark.sql import functions as F
    from wattflow.operators.quality import REFERENCE_SUITE
    from wattflow.plans.build import build_marts
    from wattflow.session import scratch_path
    from wattflow.sinks import write_partitioned
    root = scratch_path(spark, "gated")
    gen = silver_gen(spark, sf_dir).filter("id_estado is not null and nom_tipocombustivel is not null")
    write_partitioned(gen, f"{root}/generation", ["ano", "mes"])
    reg = silver_reg(spark, sf_dir)
    write_partitioned(reg, f"{root}/sound", ["ano_conexao"])
    lost = F.when(F.col("sigla_uf") != "NATION_3", F.col("cod_empreendimento"))
    write_partitioned(reg.withColumn("cod_empreendimento", lost), f"{root}/lost", ["ano_conexao"])
    unseen = replace(REFERENCE_SUITE, not_null={
        m: c for m, c in REFERENCE_SUITE.not_null.items() if m != "stg_registry"})
    out = []
    for case, registry, suite in (("sound", "sound", REFERENCE_SUITE), ("lost_ids", "lost", REFERENCE_SUITE),
                                  ("unchecked", "sound", unseen)):
        res = build_marts(spark, f"{root}/generation", f"{root}/{registry}", f"{root}/build-{case}", suite=suite)
        out += [(case, m, "blocked" if m in res.blocked else "ready", res.rows.get(m), ",".join(res.blocked.get(m, [])))
                for m in ("dim_state", "dim_source", "fact_generation_monthly", "fact_capacity")]
    return spark.createDataFrame(out, "build string, model string, status string, rows bigint, reasons string")
