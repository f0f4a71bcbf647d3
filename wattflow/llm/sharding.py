"""Contiguous shards of near-equal bytes by global prefix sums."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattflow.session import stage


def _running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bytes and rows before each row inside its partition, batch by batch."""
    pid = TaskContext.get().partitionId()
    n_bytes = n_rows = 0
    for b in batches:
        size = b.column("size").to_numpy()
        ends = np.cumsum(size)
        rows = b.num_rows
        yield pa.RecordBatch.from_arrays(
            [*b.columns, pa.array(np.full(rows, pid, np.int64)),
             pa.array(n_bytes + ends - size), pa.array(n_rows + np.arange(rows, dtype=np.int64))],
            names=[*b.schema.names, "pid", "bytes_before", "rows_before"])
        n_bytes += int(ends[-1]) if rows else 0
        n_rows += rows


def assign_shards(df: DataFrame, n_shards: int, id_col: str = "doc_id", text_col: str = "text",
                  overhead: int = 16, keep: bool = False) -> DataFrame:
    """Cut the table, ordered by id, into ``n_shards`` contiguous shards.

    A row's size is its text's UTF-8 bytes plus ``overhead``. Rows are range
    partitioned by (id, text checksum); each partition adds up its own sizes,
    and only the totals, one row a partition, are summed globally. With those
    offsets every row knows the bytes before it in the whole table, and the
    shard is that of the row's middle byte among ``n_shards`` equal targets:
    sizes differ from the target by less than the largest row.

    Only ids, sizes and checksums are shuffled and staged; with ``keep`` the
    input row travels along as the struct ``row`` (its column names cannot
    clash with the result's). The staged copy is read twice, so both passes see
    the same partitions even if an executor is lost between them.

    Null text: ``overhead`` bytes, checksum 0. Null ids come first. Rows with
    equal id and text are interchangeable; a third sort key spreads them over
    partitions. Fewer rows than shards leave shards empty; an empty table
    gives an empty result.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    cols = [F.col(id_col).alias("doc_id"),
            (F.octet_length(text).cast("long") + F.lit(overhead)).alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32")]
    if keep:
        cols.append(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"))
    narrow = df.select(*cols, F.monotonically_increasing_id().alias("tie"))
    ordered = (narrow.repartitionByRange(F.col("doc_id"), F.col("text_crc32"), F.col("tie"))
               .sortWithinPartitions("doc_id", "text_crc32", "tie").drop("tie"))
    schema = T.StructType([*ordered.schema.fields, T.StructField("pid", T.LongType()),
                           T.StructField("bytes_before", T.LongType()),
                           T.StructField("rows_before", T.LongType())])
    rows = stage(ordered.mapInArrow(_running, schema), "shard-rows")

    totals = rows.groupBy("pid").agg(F.sum("size").alias("b"), F.count(F.lit(1)).alias("r"))
    before = Window.orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = totals.select(
        "pid", F.coalesce(F.sum("b").over(before), F.lit(0)).alias("b0"),
        F.coalesce(F.sum("r").over(before), F.lit(0)).alias("r0"),
        F.sum("b").over(whole).alias("total"))
    # one row a partition of the shuffle above: a bound of the session, not of the data
    placed = rows.join(F.broadcast(offsets), "pid").select(
        *[c for c in rows.columns if c not in ("pid", "bytes_before", "rows_before")],
        (F.col("r0") + F.col("rows_before")).alias("at"),
        F.least(F.lit(n_shards - 1).cast("long"), F.expr(
            f"((b0 + bytes_before) * 2 + size) * {int(n_shards)} div (total * 2)"))
        .cast("int").alias("shard"))
    firsts = placed.groupBy("shard").agg(F.min("at").alias("first"))  # n_shards rows
    return (placed.join(F.broadcast(firsts), "shard")
            .withColumn("slot", F.col("at") - F.col("first")).drop("at", "first"))


def shard_query(docs: DataFrame, n_shards: int = 40) -> DataFrame:
    return assign_shards(docs, n_shards).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))
