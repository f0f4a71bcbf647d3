"""Incremental marts: a load of some months recomputes those months alone.

The pre-aggregate and the monthly fact are stored by (year, month). A load
reads the silver partitions of its months, replaces the same partitions of the
pre-aggregate and then those of the fact. The dimensions come from the whole
pre-aggregate (one row a plant and month, no hours). Only if a state or fuel
gets another key does the whole fact follow, from the pre-aggregate still.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattflow.operators import dims, facts, staging
from wattflow.session import stage
from wattflow.sinks import write_partitioned
from wattflow.sources.delimited import read_silver

Month = tuple[int | None, int | None]
FACT_PARTITIONS = ["ano_geracao", "mes_geracao"]
DIMENSIONS = {"dim_state": ("sigla_uf", "sk_uf"), "dim_source": ("fonte_combustivel", "sk_fonte")}


@dataclass
class Refresh:
    months: list[Month]     # months that were recomputed in the pre-aggregate
    whole_fact: bool        # a surrogate key changed: every month of the fact was rewritten
    paths: dict[str, str]


def in_months(months: Sequence[Month], year: str, month: str) -> Column:
    """Literal test of (year, month), null safe: prunes partitions while planning."""
    tests = [F.col(year).eqNullSafe(F.lit(y).cast("int")) & F.col(month).eqNullSafe(F.lit(m).cast("int"))
             for y, m in months]
    return reduce(lambda a, b: a | b, tests, F.lit(False))


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def _exists(spark: SparkSession, path: str) -> bool:
    p, fs = _path(spark, path)
    return fs.exists(p)


def _drop_months(spark: SparkSession, root: str, months: Sequence[Month]) -> None:
    """Delete the partitions of months that have no rows any more (a dynamic
    overwrite leaves them)."""
    def value(v):
        return "__HIVE_DEFAULT_PARTITION__" if v is None else v

    for y, m in months:
        p, fs = _path(spark, f"{root}/{FACT_PARTITIONS[0]}={value(y)}/{FACT_PARTITIONS[1]}={value(m)}")
        fs.delete(p, True)


def _replace_months(df: DataFrame, path: str, months: Sequence[Month]) -> None:
    """Write ``df``, which holds rows of ``months`` alone, over those months of
    the table at ``path``; the new rows are staged first, as they may be read
    from files of the same load."""
    new = stage(df, "months")
    write_partitioned(new, path, FACT_PARTITIONS, dynamic=True)
    # at most one row a month of the load
    left = {tuple(r) for r in new.select(*FACT_PARTITIONS).distinct().collect()}
    _drop_months(df.sparkSession, path, [x for x in months if tuple(x) not in left])


def _read(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """A stored table under its own schema, so that one without files reads as empty."""
    return spark.read.schema(like.schema).parquet(path).select(*like.columns)


def _keys_changed(old: DataFrame, new: DataFrame, cols: Sequence[str]) -> bool:
    """Whether a value of the old dimension is gone or has another key. Values
    that are only new change no stored row."""
    return not old.select(*cols).join(new.select(*cols), list(cols), "left_anti").isEmpty()


def refresh_generation(spark: SparkSession, silver_path: str, root: str,
                       months: Sequence[Month] | None = None) -> Refresh:
    """Bring the generation marts under ``root`` up to the silver table.

    ``months``: the (year, month) pairs that a load replaced in silver; null
    months are ``(None, None)``. Without them, or where ``root`` has no marts
    yet, everything is built. A month without rows leaves the marts. The
    result equals a full rebuild: when a state or fuel appears between others
    (dense keys move up) or goes, the whole fact is rewritten from the stored
    pre-aggregate, never from silver. Files that readers have open may go; run
    one refresh of a ``root`` at a time, and repeat one that failed with the
    same months.
    """
    paths = {"generation_pre": f"{root}/generation_pre", "fact_generation_monthly": f"{root}/fact_generation_monthly",
             **{d: f"{root}/{d}" for d in DIMENSIONS}}
    stg = staging.stg_generation(read_silver(spark, silver_path))
    pre = facts.pre_aggregate_generation(stg)
    first = months is None or not all(_exists(spark, f"{p}/_SUCCESS") for p in paths.values())
    if first:
        months = []
        write_partitioned(pre, paths["generation_pre"], FACT_PARTITIONS)
    else:
        months = list(dict.fromkeys(tuple(x) for x in months))
        touched = facts.pre_aggregate_generation(stg.filter(in_months(months, *FACT_PARTITIONS)))
        _replace_months(touched, paths["generation_pre"], months)

    stored = _read(spark, paths["generation_pre"], pre)
    whole, tables = first, {}
    for name, build in (("dim_state", dims.dim_state), ("dim_source", dims.dim_source)):
        new = stage(build(stored), name)
        if not whole:
            whole = _keys_changed(_read(spark, paths[name], new), new, DIMENSIONS[name])
        tables[name] = new
    source = stored if whole else stored.filter(in_months(months, *FACT_PARTITIONS))
    fact = facts.monthly_fact(source, tables["dim_state"], tables["dim_source"], pre_aggregated=True)
    if whole:
        write_partitioned(fact, paths["fact_generation_monthly"], FACT_PARTITIONS)
    else:
        _replace_months(fact, paths["fact_generation_monthly"], months)
    # the dimensions last: a refresh that failed before is found again by its keys
    for name, df in tables.items():
        write_partitioned(df, paths[name])
    return Refresh(months, whole, paths)
