"""End-to-end medallion build: bronze CSV -> silver Parquet -> staging views ->
gated dimensions and facts -> data checks.

Every layer edge is a written table in ``out_root`` (a shared folder on a
cluster), so each stage reads the previous one from storage: lineage is cut,
a lost executor only re-runs tasks of the current stage, and a failed build
can be resumed from the last written layer. Staging stays a view, so its
filters fuse into the scans of the silver tables.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from wattflow.operators import dims, facts, quality, silver, staging
from wattflow.schemas import GENERATION_SILVER_PARTITIONS, REGISTRY_SILVER_PARTITIONS
from wattflow.session import bounded_pieces
from wattflow.sinks import write_partitioned
from wattflow.sources.delimited import read_generation_bronze, read_registry_bronze, read_silver


@dataclass
class BuildResult:
    rows: dict[str, int] = field(default_factory=dict)      # rows written per table
    checks: DataFrame | None = None                         # all check results
    blocked: dict[str, list[str]] = field(default_factory=dict)  # model -> failing checks
    paths: dict[str, str] = field(default_factory=dict)


def build_silver(spark: SparkSession, gen_bronze: str, reg_bronze: str, out_root: str,
                 snapshot: str = "latest") -> BuildResult:
    """Bronze -> silver for both datasets (full refresh, partitioned Parquet)."""
    res = BuildResult()
    # a landed file holds one month, so a task that reads it writes few files as it is: no shuffle
    gen_path, reg_path = f"{out_root}/silver/generation", f"{out_root}/silver/registry"
    res.rows["silver_generation"] = write_partitioned(
        silver.silver_generation(read_generation_bronze(spark, gen_bronze)), gen_path,
        GENERATION_SILVER_PARTITIONS, rebalance=False)
    res.rows["silver_registry"] = write_partitioned(
        silver.silver_registry(read_registry_bronze(spark, reg_bronze, snapshot)), reg_path,
        REGISTRY_SILVER_PARTITIONS)
    res.paths.update(silver_generation=gen_path, silver_registry=reg_path)
    return res


def build_marts(spark: SparkSession, silver_gen_path: str, silver_reg_path: str, out_root: str,
                enforce: bool = True, suite: quality.CheckSuite = quality.REFERENCE_SUITE,
                gates=quality.GATES) -> BuildResult:
    """Silver -> staging -> dimensions -> facts, each mart behind its gate.

    With ``enforce`` a mart whose gating checks fail, or were not run, is not
    written (its dependants neither) and is reported in ``blocked``; without it every
    mart is written and the failures are only reported.
    """
    res = BuildResult()
    models: dict[str, DataFrame] = {
        "stg_generation": staging.stg_generation(read_silver(spark, silver_gen_path)),
        "stg_registry": staging.stg_registry(read_silver(spark, silver_reg_path)),
    }
    for name in ("stg_generation", "stg_registry"):
        models[name].createOrReplaceTempView(name)
    results: list[DataFrame] = []

    def keep(found: DataFrame) -> None:
        """Each check runs once: its rows are written, gates and callers read them."""
        path = f"{out_root}/work/checks/{len(results)}"
        write_partitioned(found, path)
        results.append(read_silver(spark, path))

    keep(suite.run({k: models[k] for k in models}, only=["not_null"]))

    def written(name: str, df: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame | None:
        failing = quality.blocking(quality.union_results(results), name, gates)
        if failing and enforce:
            res.blocked[name] = failing
            return None
        if failing:
            res.blocked[name] = failing
        path = f"{out_root}/marts/{name}"
        with bounded_pieces(spark):
            res.rows[name] = write_partitioned(df, path, keys)
        res.paths[name] = path
        return read_silver(spark, path)

    # one pass over generation staging feeds both dimensions and the fact
    pre_path = f"{out_root}/work/generation_pre"
    with bounded_pieces(spark):
        write_partitioned(facts.pre_aggregate_generation(models["stg_generation"]), pre_path)
    pre = read_silver(spark, pre_path)

    def table_checks(name: str, df: DataFrame) -> DataFrame:
        parts = [quality.not_null(df, name, suite.not_null[name])] if name in suite.not_null else []
        parts += [quality.unique(df, name, c) for c in suite.unique.get(name, [])]
        parts += [quality.accepted_values(df, name, c, v)
                  for c, v in suite.accepted_values.get(name, [])]
        return quality.union_results(parts)

    d_uf = written("dim_state", dims.dim_state(pre))
    d_fonte = written("dim_source", dims.dim_source(pre))
    for name, df in (("dim_state", d_uf), ("dim_source", d_fonte)):
        if df is not None:
            models[name] = df
            keep(table_checks(name, df))

    if d_uf is not None and d_fonte is not None:
        # facts are partitioned by year: year slicers of the reports prune files
        fg = written("fact_generation_monthly",
                     facts.monthly_fact(pre, d_uf, d_fonte, pre_aggregated=True),
                     ("ano_geracao",))
        if fg is not None:
            models["fact_generation_monthly"] = fg
    else:
        res.blocked["fact_generation_monthly"] = ["upstream blocked"]
    if d_uf is not None:
        fc = written("fact_capacity", facts.capacity_fact(models["stg_registry"], d_uf),
                     ("ano_conexao",))
        if fc is not None:
            models["fact_capacity"] = fc
    else:
        res.blocked["fact_capacity"] = ["upstream blocked"]

    for name in ("fact_generation_monthly", "fact_capacity"):
        if name in models:
            keep(quality.union_results([table_checks(name, models[name])] + [
                quality.relationships(models[name], name, c, models[p], pc)
                for c, p, pc in suite.relationships.get(name, []) if p in models]))
    res.checks = quality.union_results(results)
    return res


def build_all(spark: SparkSession, gen_bronze: str, reg_bronze: str, out_root: str,
              snapshot: str = "latest", enforce: bool = True) -> BuildResult:
    """Whole pipeline: silver then marts (the order of the source runbook)."""
    s = build_silver(spark, gen_bronze, reg_bronze, out_root, snapshot)
    m = build_marts(spark, s.paths["silver_generation"], s.paths["silver_registry"], out_root,
                    enforce=enforce)
    m.rows = {**s.rows, **m.rows}
    m.paths = {**s.paths, **m.paths}
    return m
