"""Dimensions: key collapse, ordered surrogate keys, fuel classification."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from wattflow.functions import any_match, classify
from wattflow.schemas import (
    CLEAN_EXTRA_PATTERN,
    SOURCE_CATEGORY_DEFAULT,
    SOURCE_CATEGORY_RULES,
)
from wattflow.session import stage


def collapse_dim(df: DataFrame, key: str, max_cols: Sequence[str] = (),
                 any_cols: Sequence[str] = ()) -> DataFrame:
    """One row per non-null ``key``: ``max`` of each descriptor, ``bool_or`` of flags.

    Each ``max`` is independent, so descriptors may come from different rows.
    Partial (map-side) aggregation absorbs hot keys.
    """
    aggs = [F.max(c).alias(c) for c in max_cols] + [F.bool_or(c).alias(c) for c in any_cols]
    # max() over strings cannot use a hash-aggregation buffer (Spark falls
    # back to a sort-based aggregate over every input row), so distinct
    # (key, descriptor) combinations are taken first with a hash aggregate;
    # the max then runs over a handful of rows per key. Same result. They are
    # counted and the count is read: a plain distinct() below max and bool_or
    # is dropped by the optimizer, and every input row is sorted after all.
    combos = df.filter(F.col(key).isNotNull()).groupBy(key, *max_cols, *any_cols).agg(
        F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > 0)
    return combos.groupBy(key).agg(*aggs)


def surrogate_key(df: DataFrame, order_cols: Sequence[str], out: str,
                  method: str = "range", num_partitions: int | None = None,
                  collation: str | None = None) -> DataFrame:
    """Dense 1-based ``row_number() over (order by order_cols)`` as bigint.

    ``method="range"`` (default) never moves the table into one task:
    range-partition on the order columns, sort inside each partition, take
    the position inside the partition from ``monotonically_increasing_id``
    (its upper bits are the partition index, its lower bits the row index),
    then add the row count of all earlier partitions. The positioned rows are
    written once under the shared folder and both uses read that table: two
    evaluations of a range partitioning may cut at different bounds. The
    per-partition counts table has one row per partition, so its broadcast is bounded by
    the partition count. ``method="global"`` is the plain single-partition
    window, for tables known to be tiny.
    Order is binary (UTF-8 byte) order, nulls first, as ``ORDER BY`` gives;
    ``collation`` (e.g. ``"UNICODE"``) orders string columns by that
    collation instead, so accented names sort next to their base letter.
    """
    def key(c: str):
        if collation and isinstance(df.schema[c].dataType, StringType):
            return F.collate(F.col(c), collation)
        return F.col(c)

    order = [key(c).asc_nulls_first() for c in order_cols]
    if method == "global":
        w = Window.orderBy(*order)
        return df.withColumn(out, F.row_number().over(w).cast("bigint"))
    if method != "range":
        raise ValueError(f"unknown surrogate_key method {method!r}")
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pid, pos, cnt, off = "__sk_pid", "__sk_pos", "__sk_cnt", "__sk_off"
    mid = F.monotonically_increasing_id()
    ranked = (
        df.repartitionByRange(n, *order)
        .sortWithinPartitions(*order)
        .withColumn("__sk_mid", mid)
        .withColumn(pid, F.shiftrightunsigned("__sk_mid", 33))
        .withColumn(pos, F.col("__sk_mid") - F.shiftleft(F.col(pid), 33) + F.lit(1))
        .drop("__sk_mid")
    )
    ranked = stage(ranked, "ranked")
    counts = ranked.groupBy(pid).agg(F.count(F.lit(1)).alias(cnt))
    offsets = counts.select(
        pid,
        F.coalesce(
            F.sum(cnt).over(Window.orderBy(pid).rowsBetween(Window.unboundedPreceding, -1)),
            F.lit(0),
        ).alias(off),
    )
    return (
        ranked.join(F.broadcast(offsets), pid, "inner")
        .withColumn(out, (F.col(off) + F.col(pos)).cast("bigint"))
        .drop(pid, pos, off)
    )


def dim_state(stg: DataFrame, method: str = "global", collation: str | None = None) -> DataFrame:
    """State dimension from generation staging (one row per state).

    States are a closed list of codes, so the collapsed rows are numbered in
    one task, in the plan itself; ``method="range"`` is for open key domains.
    """
    collapsed = collapse_dim(
        stg, "sigla_uf",
        max_cols=["nome_estado", "nome_subsistema", "cod_subsistema"],
        any_cols=["eh_brasil"],
    )
    keyed = surrogate_key(collapsed, ["sigla_uf"], "sk_uf", method=method, collation=collation)
    return keyed.select("sigla_uf", "nome_estado", "nome_subsistema", "cod_subsistema",
                        "eh_brasil", "sk_uf")


def dim_source(stg: DataFrame, method: str = "global",
               rules=SOURCE_CATEGORY_RULES, default: str = SOURCE_CATEGORY_DEFAULT,
               collation: str | None = None) -> DataFrame:
    """Fuel dimension: distinct (fuel, renewable) pairs, category, clean flag.

    Fuels are a short list of names: numbered like states, in one task.

    ``eh_limpa`` is true for renewable fuels or the nuclear pattern, else
    false (a null renewable flag falls through to the pattern test).
    """
    pairs = (
        stg.filter(F.col("fonte_combustivel").isNotNull())
        .select("fonte_combustivel", "eh_renovavel")
        .distinct()
    )
    described = pairs.withColumns({
        "categoria_simplificada": classify("fonte_combustivel", rules, default),
        "eh_limpa": F.when(F.col("eh_renovavel"), F.lit(True))
        .when(any_match("fonte_combustivel", [CLEAN_EXTRA_PATTERN]), F.lit(True))
        .otherwise(F.lit(False)),
    })
    keyed = surrogate_key(described, ["fonte_combustivel"], "sk_fonte", method=method,
                          collation=collation)
    return keyed.select("fonte_combustivel", "eh_renovavel", "categoria_simplificada",
                        "eh_limpa", "sk_fonte")
