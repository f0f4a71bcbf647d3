"""Catalog materialisation: namespaces, full-refresh tables and views."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from wattflow.sinks.files import observed, write_partitioned


def ensure_namespace(spark, name: str, location: str | None = None) -> None:
    """``CREATE SCHEMA IF NOT EXISTS`` (optionally at a shared location)."""
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{name}`{loc}")


def materialize(df: DataFrame, name: str, kind: str = "table", namespace: str | None = None,
                path: str | None = None, fmt: str = "parquet") -> tuple[DataFrame, int | None]:
    """Publish ``df`` as a view or a full-refresh table.

    ``view``: a session view, no storage (filters of readers fuse into its
    plan). ``table``: overwrite (replace on rebuild) as a catalog table,
    external at ``path`` when given; returns the table and the observed
    number of rows written.
    """
    spark = df.sparkSession
    if kind == "view":
        df.createOrReplaceTempView(name)
        return spark.table(name), None
    if kind != "table":
        raise ValueError(f"unknown kind {kind!r}")
    full = f"`{namespace}`.`{name}`" if namespace else f"`{name}`"
    obs = Observation(f"materialize_{name}")
    writer = df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").format(fmt)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(full)
    return spark.table(full), int(observed(obs, {"rows": 0})["rows"])


class PublishRefused(RuntimeError):
    """A rebuilt table failed its checks; the published one is as before."""


def publish(df: DataFrame, namespace: str, name: str, root: str,
            checks: Callable[[DataFrame], DataFrame] | None = None) -> tuple[DataFrame, int]:
    """Replace ``namespace.name`` without a gap: build aside, check, swap.

    The rows are written to a new folder under ``root`` (shared by the
    cluster). ``checks`` gets the written table and returns check results
    (``operators.quality``); if any fails, or the write does, the table keeps
    its old location and rows. Else the catalog entry is pointed to the new
    folder in one step; queries that already run go on reading the old folder,
    which is left for the caller to delete. The table is not partitioned, and
    its columns may not change. Returns the table and the rows written.
    """
    spark = df.sparkSession
    full, path = f"`{namespace}`.`{name}`", f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
    exists = spark.catalog.tableExists(f"{namespace}.{name}")
    columns = [(f.name, f.dataType.simpleString()) for f in df.schema]
    if exists and columns != [(f.name, f.dataType.simpleString()) for f in spark.table(full).schema]:
        raise ValueError(f"{full}: the columns of a published table do not change")
    rows = write_partitioned(df, path)
    if checks is not None:
        failed = checks(spark.read.schema(df.schema).parquet(path)).filter("failures > 0").select("check_id").collect()
        if failed:  # one row a check
            raise PublishRefused(f"{full} not replaced: {sorted(r.check_id for r in failed)}")
    if exists:
        spark.sql(f"ALTER TABLE {full} SET LOCATION '{path}'")
        spark.catalog.refreshTable(f"{namespace}.{name}")
    else:
        spark.catalog.createTable(f"{namespace}.{name}", path=path, source="parquet")
    return spark.table(full), rows


def create_view(spark, namespace: str, name: str, query: str) -> DataFrame:
    """A persistent view ``namespace.name``, seen by every session of the
    catalog; replaced in one step if it exists. Readers' filters and columns
    reach the files under it."""
    spark.sql(f"CREATE OR REPLACE VIEW `{namespace}`.`{name}` AS {query}")
    return spark.table(f"`{namespace}`.`{name}`")
