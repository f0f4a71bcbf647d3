"""Partitioned file writes with an observed row count, and raw landing."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from wattflow.schemas import LINEAGE_COLUMN
from wattflow.session import bounded_pieces


def observed(obs: Observation, empty: Mapping) -> Mapping:
    """Metrics of a finished write. A plan found to be without rows loses its
    observing node and so has none: then ``empty`` is what it would have seen."""
    try:
        return obs.get
    except Py4JJavaError as e:
        if e.java_exception.getClass().getName() != "java.lang.AssertionError":
            raise
        return empty


def write_partitioned(df: DataFrame, path: str, keys: Sequence[str] = (), mode: str = "overwrite",
                      dynamic: bool = False, fmt: str = "parquet",
                      options: Mapping[str, str] | None = None, rebalance: bool = True) -> int:
    """Write ``df`` partitioned by ``keys``; return the rows written.

    The count is an ``Observation`` collected by the write itself (no second
    scan). ``rebalance`` adds a REBALANCE hint on the partition keys: AQE
    groups rows of one partition value into few files and splits a hot value
    over several tasks instead of one. ``dynamic=True`` replaces only the
    partitions present in ``df`` (incremental load of one period).
    """
    obs = Observation("written")
    out = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    if rebalance and keys:
        out = out.hint("rebalance", *keys)
    writer = out.write.mode(mode).format(fmt)
    if dynamic:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    for k, v in (options or {}).items():
        writer = writer.option(k, v)
    if keys:
        writer = writer.partitionBy(*keys)
    writer.save(path)
    return int(observed(obs, {"rows": 0})["rows"])


AUDIT_SCHEMA = ("table_name string, path string, rows bigint, lineage_first timestamp, lineage_last timestamp, "
                "lineage_nulls bigint, written_at timestamp")


def write_audited(df: DataFrame, path: str, table_name: str, audit_path: str, keys: Sequence[str] = (),
                  lineage: str = LINEAGE_COLUMN, dynamic: bool = False) -> int:
    """``write_partitioned`` that also appends one row to the audit table.

    Rows, least and greatest lineage instant and rows without one are observed
    by the write itself, so they tell of what was written, not of a later scan.
    """
    obs = Observation("audit")
    instant = F.col(lineage)
    seen = df.observe(obs, F.min(instant).alias("first"), F.max(instant).alias("last"),
                      F.count_if(instant.isNull()).alias("nulls"))
    rows = write_partitioned(seen, path, keys, dynamic=dynamic)
    got = observed(obs, {"first": None, "last": None, "nulls": 0})
    spark = df.sparkSession
    entry = spark.createDataFrame(
        [(table_name, path, rows, got["first"], got["last"], got["nulls"])],
        AUDIT_SCHEMA.replace(", written_at timestamp", "")).withColumn("written_at", F.current_timestamp())
    entry.coalesce(1).write.mode("append").parquet(audit_path)
    return rows


def read_audit(spark, audit_path: str) -> DataFrame:
    return spark.read.schema(AUDIT_SCHEMA).parquet(audit_path)


def land_raw(df: DataFrame, root: str, partition: Mapping[str, str] | None = None,
             partition_cols: Sequence[str] = (), encoding: str = "UTF-8", sep: str = ";",
             quote: str = '"', compression: str | None = None) -> int:
    """Land raw rows as delimited text under hive directories.

    ``partition`` fixes literal values (one period or snapshot:
    ``{"snapshot_date": "2024-02-01"}``); ``partition_cols`` names columns of
    ``df`` to partition by. Existing partitions other than the ones written
    are kept (dynamic overwrite), so re-landing a period replaces it only.
    ``compression`` (``"gzip"``) packs each file; a packed file is read by one
    task, so rows are landed by small tasks, which bounds the files.
    """
    lit_cols = dict(partition or {})
    if lit_cols:
        df = df.withColumns({k: F.lit(v) for k, v in lit_cols.items()})
    keys = list(lit_cols) + list(partition_cols)
    options = {"sep": sep, "header": "true", "encoding": encoding, "quote": quote}
    if compression:
        options["compression"] = compression
    with bounded_pieces(df.sparkSession):
        return write_partitioned(
            df, root, keys, mode="overwrite", dynamic=True, fmt="csv",
            rebalance=bool(partition_cols),  # literal partitions need no shuffle
            options=options)
