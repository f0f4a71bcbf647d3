"""Build the generation marts from one shared pass over staging."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from wattflow.operators import dims, facts
from wattflow.session import bounded_pieces, scratch_path, stage

#: Folder and schemas of the marts written in this process, by application,
#: input folder and group, with the state of the inputs they were built from.
_STORED: dict[tuple[str, str, str], tuple[tuple, str, dict]] = {}


def generation_marts(stg: DataFrame, stage_fact: bool = False) -> dict[str, DataFrame]:
    """State dimension, fuel dimension and monthly fact from one pre-aggregate.

    Each mart reads the staged pre-aggregate (small), not the hourly rows;
    the three results equal the ones built from staging directly. Dimensions
    rest on written tables (their numbered rows); with ``stage_fact`` the fact
    does too, for callers that read it several times (the data checks).
    """
    spark = stg.sparkSession
    with bounded_pieces(spark):
        pre = stage(facts.pre_aggregate_generation(stg), "generation-pre")
    d_uf, d_fonte = dims.dim_state(pre), dims.dim_source(pre)
    fact = facts.monthly_fact(pre, d_uf, d_fonte, pre_aggregated=True)
    if stage_fact:
        with bounded_pieces(spark):
            fact = stage(fact, "fact-generation")
    return {"dim_state": d_uf, "dim_source": d_fonte, "fact_generation_monthly": fact}


def input_state(spark: SparkSession, root: str) -> tuple:
    """Name, time of change, bytes and files of every table under ``root``."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    state = []
    for table in fs.listStatus(path):
        held = fs.getContentSummary(table.getPath())
        state.append((table.getPath().getName(), table.getModificationTime(), held.getLength(), held.getFileCount()))
    return tuple(sorted(state))


def stored_marts(spark: SparkSession, root: str, group: str,
                 build: Callable[[], dict[str, DataFrame]]) -> dict[str, DataFrame]:
    """The marts that ``build`` derives from the tables under ``root``, written
    once under the shared folder and read by every report of the session.

    They are built anew when a table under ``root`` changed since, or when the
    written marts are gone (``session.drop_scratch``).
    """
    key, state = (spark.sparkContext.applicationId, root, group), input_state(spark, root)
    seen, path, schemas = _STORED.get(key, (None, "", {}))
    if seen != state or not all(_written(spark, f"{path}/{name}") for name in schemas):
        path, schemas = scratch_path(spark, f"marts-{group}"), {}
        for name, df in build().items():
            with bounded_pieces(spark):
                df.write.parquet(f"{path}/{name}")
            schemas[name] = df.schema
        _STORED[key] = (state, path, schemas)
    return {name: spark.read.schema(schema).parquet(f"{path}/{name}") for name, schema in schemas.items()}


def _written(spark: SparkSession, path: str) -> bool:
    done = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return done.getFileSystem(spark._jsc.hadoopConfiguration()).exists(done)
