"""Named sources: logical ``(namespace, name)`` -> a catalog table over stored files.

The source pipeline copies silver into a warehouse schema ``raw`` and models
read ``source('raw', name)``. Here the catalog entry is an external table
over the silver files themselves: no copy, no load window, and readers get
partition pruning from the table's partition columns.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from wattflow.sinks.tables import ensure_namespace


def _declared(spark: SparkSession, full: str) -> dict[str, str]:
    """Provider and location of a catalog table."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {full}").collect()
    return {r.col_name: r.data_type for r in rows if r.col_name in ("Provider", "Location")}


def register_sources(spark: SparkSession, namespace: str, tables: Mapping[str, str],
                     fmt: str = "parquet", location: str | None = None) -> list[str]:
    """Declare each ``name -> path`` as ``namespace.name`` (external table).
    Returns the qualified names.

    A table that is declared over the same columns stays: its location (if it
    has no partitions) or its list of partitions is brought up to date, so
    readers see no gap. It is declared anew only if its columns or format
    change, or a partitioned one moves to another folder.
    """
    ensure_namespace(spark, namespace, location)
    out = []
    for name, path in tables.items():
        full = f"`{namespace}`.`{name}`"
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        where = p.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(p).toString()
        stays = False
        if spark.catalog.tableExists(f"{namespace}.{name}"):
            old = _declared(spark, full)
            columns = [(f.name, f.dataType) for f in spark.read.format(fmt).load(path).schema]
            partitioned = any(c.isPartition for c in spark.catalog.listColumns(f"{namespace}.{name}"))
            moved = old.get("Location") != where
            stays = (old.get("Provider", "").lower() == fmt.lower() and not (partitioned and moved)
                     and [(f.name, f.dataType) for f in spark.table(full).schema] == columns)
            if stays and moved:
                spark.sql(f"ALTER TABLE {full} SET LOCATION '{path}'")
            if not stays:
                spark.sql(f"DROP TABLE IF EXISTS {full}")
        if not stays:
            spark.catalog.createTable(f"{namespace}.{name}", path=path, source=fmt)
            partitioned = any(c.isPartition for c in spark.catalog.listColumns(f"{namespace}.{name}"))
        if partitioned:  # add the partitions found on disk, drop those that are gone
            spark.sql(f"MSCK REPAIR TABLE {full} SYNC PARTITIONS")
        spark.catalog.refreshTable(f"{namespace}.{name}")
        out.append(f"{namespace}.{name}")
    return out


def source(spark: SparkSession, namespace: str, name: str) -> DataFrame:
    """``source(namespace, name)``: the declared table as a DataFrame."""
    return spark.table(f"`{namespace}`.`{name}`")
