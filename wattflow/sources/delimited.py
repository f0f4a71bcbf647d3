"""Delimited (CSV) and Parquet scans of the bronze and silver layers."""

from __future__ import annotations

import datetime as dt
import re
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (ByteType, DataType, DateType, IntegerType, LongType, ShortType,
                               StringType, StructField, StructType)

from wattflow.schemas import GENERATION_RAW, REGISTRY_RAW


def read_delimited(spark: SparkSession, path, schema: StructType, encoding: str = "UTF-8",
                   sep: str = ";", quote: str = '"', header: bool = True,
                   base_path: str | None = None,
                   corrupt_column: str | None = None) -> DataFrame:
    """Typed scan of delimited text with an explicit schema (no inference pass).

    Binding is by position; a short row gets nulls, a long row is cut, a bad
    field becomes null and the row is kept. ``k=v`` directories under the
    root become columns (partition discovery). ``corrupt_column`` adds a
    text column holding the raw line of malformed records.
    """
    if corrupt_column:
        schema = StructType(schema.fields + [StructField(corrupt_column, StringType(), True)])
    reader = (spark.read.schema(schema)
              .option("sep", sep).option("header", str(header).lower())
              .option("encoding", encoding).option("quote", quote)
              .option("mode", "PERMISSIVE"))
    if corrupt_column:
        reader = reader.option("columnNameOfCorruptRecord", corrupt_column)
    if base_path:
        reader = reader.option("basePath", base_path)
    return reader.csv(path)


def select_snapshot(df: DataFrame, col: str = "snapshot_date", mode: str = "latest",
                    root: str | None = None) -> DataFrame:
    """Registry snapshot selector.

    ``all`` keeps every landed snapshot (counts multiply with the number of
    runs); ``latest`` keeps the newest one only, found from the ``col=value``
    folders under ``root`` (without a root, from the frame's file list), so
    only that snapshot is read.
    """
    if mode == "all":
        return df
    if mode != "latest":
        raise ValueError(f"unknown snapshot mode {mode!r}")
    if root is None:
        value = latest_partition_value(df, col)
    else:
        value = latest_folder(df.sparkSession, root, col, df.schema[col].dataType)
    if value is not None:
        # a literal filter on the partition column: pruned while planning
        return df.filter(F.col(col) == F.lit(value).cast(df.schema[col].dataType))
    # not a path-partitioned file source: scalar subquery (pruned at run time)
    latest = df.select(F.max(col)).scalar()
    return df.filter(F.col(col) == latest)


def _newest_first(raw, dtype: DataType) -> list[str]:
    """Partition values as text, newest first by their type; null values go."""
    values = {unquote(v) for v in raw} - {"__HIVE_DEFAULT_PARTITION__"}
    if isinstance(dtype, (IntegerType, LongType, ShortType, ByteType)):
        return sorted(values, key=int, reverse=True)
    if isinstance(dtype, DateType):
        return [d.isoformat() for d in sorted(map(dt.date.fromisoformat, values), reverse=True)]
    return sorted(values, reverse=True)


def latest_partition_value(df: DataFrame, col: str):
    """Newest ``col=value`` directory among the files of a file-source scan.

    The values come from the file listing Spark already holds on the driver
    (``inputFiles``), so no data is read; a CSV scan could not skip to them.
    Returns ``None`` when the files are not partitioned by ``col``.
    """
    pat = re.compile(rf"/{re.escape(col)}=([^/]+)/")
    found = _newest_first({m.group(1) for f in df.inputFiles() for m in [pat.search(f)] if m},
                          df.schema[col].dataType)
    return found[0] if found else None


def latest_folder(spark: SparkSession, root: str, col: str, dtype: DataType):
    """Newest ``col=value`` folder right under ``root`` that holds a file with
    bytes, or ``None``. One listing of the first level and a look into the
    newest folders through the session's file system, however many files lie
    deeper; a file system that cannot be read raises."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/{col}=*")
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    folders: dict[str, list] = {}
    for status in fs.globStatus(path) or []:
        if status.isDirectory():
            raw = status.getPath().getName().removeprefix(f"{col}=")
            for value in _newest_first([raw], dtype):
                folders.setdefault(value, []).append(status.getPath())
    for value in _newest_first(folders, dtype):
        for folder in folders[value]:
            files = fs.listFiles(folder, True)
            while files.hasNext():
                f = files.next()
                if f.getLen() > 0 and f.getPath().getName()[0] not in "_.":
                    return value
    return None


def read_generation_bronze(spark: SparkSession, root: str) -> DataFrame:
    """Hourly generation bronze (``year=/month=`` partitions), UTF-8."""
    return read_delimited(spark, root, GENERATION_RAW, encoding="UTF-8")


def read_registry_bronze(spark: SparkSession, root: str, snapshot: str = "latest") -> DataFrame:
    """Registry bronze (``snapshot_date=`` partitions), ISO-8859-1, quoted."""
    df = read_delimited(spark, root, REGISTRY_RAW, encoding="ISO-8859-1", quote='"')
    return select_snapshot(df, "snapshot_date", snapshot, root=root)


def read_silver(spark: SparkSession, root: str) -> DataFrame:
    """Partitioned Parquet table (hive partition columns discovered from paths)."""
    return spark.read.parquet(root)
