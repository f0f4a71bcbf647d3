"""Incremental bronze -> silver: each landed period is refreshed when it changes.

The monthly landing of the hourly generation (one new ``year=/month=``
directory per run) maps onto a Structured Streaming file source: the
checkpoint records which files were seen, ``availableNow`` handles everything
landed since the last run and stops, and the periods those files belong to
are overwritten in silver.
"""

from __future__ import annotations

import functools
import operator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from wattflow.operators.silver import silver_generation
from wattflow.schemas import GENERATION_RAW
from wattflow.sinks import write_partitioned
from wattflow.sources.delimited import read_generation_bronze

#: The landing period: partitions of the landing and of the streamed silver.
PERIOD = ["year", "month"]


def generation_stream(spark: SparkSession, bronze_root: str,
                      max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming scan of the hourly bronze CSVs (partition columns filled from paths)."""
    schema = StructType(GENERATION_RAW.fields + [
        StructField("year", IntegerType(), True), StructField("month", IntegerType(), True)])
    reader = (spark.readStream.schema(schema)
              .option("sep", ";").option("header", "true").option("encoding", "UTF-8"))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.csv(bronze_root)


def _in_periods(periods: list[tuple[int | None, int | None]]) -> Column:
    """Rows of these landing periods; a literal filter, so only they are read."""
    return functools.reduce(operator.or_, [
        F.col("year").eqNullSafe(y) & F.col("month").eqNullSafe(m) for y, m in periods])


def run_silver_generation(spark: SparkSession, bronze_root: str, silver_root: str,
                          checkpoint: str, lineage: bool = True) -> None:
    """Refresh the silver periods that files landed in since the last run.

    A landing folder holds one period (the null one holds rows without an
    instant), and silver is partitioned by that same period, not by ``ano`` and
    ``mes`` of the rows: a folder may hold rows without a readable instant or
    of other months. Each touched folder is read again as a whole and replaces
    its silver partition and no other, so a period that is landed anew (the
    landing replaces it) is there once, and a batch that runs again after a
    failure changes nothing.
    """
    def refresh(batch: DataFrame, _: int) -> None:
        touched = [tuple(r) for r in batch.select(*PERIOD).distinct().collect()]  # one row a month
        if not touched:
            return
        landed = read_generation_bronze(spark, bronze_root).withColumns(
            {c: F.col(c).cast("int") for c in PERIOD}).where(_in_periods(touched))
        silver = silver_generation(landed, lineage=lineage)
        left = {tuple(r) for r in silver.select(*PERIOD).distinct().collect()}  # noise may be all of one
        if left:
            # a landed file is of one period: few files a task without a shuffle
            write_partitioned(silver, silver_root, PERIOD, dynamic=True, rebalance=False)
        # a dynamic overwrite leaves partitions without new rows as they were
        for period in set(touched) - left:
            folder = "/".join(f"{c}={'__HIVE_DEFAULT_PARTITION__' if v is None else v}"
                              for c, v in zip(PERIOD, period))
            spark.createDataFrame([], silver.drop(*PERIOD).schema).write.mode("overwrite").parquet(
                f"{silver_root}/{folder}")

    query = (generation_stream(spark, bronze_root).writeStream.foreachBatch(refresh)
             .option("checkpointLocation", checkpoint)
             .trigger(availableNow=True)
             .start())
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
