"""Registry snapshots: change detection between two landings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _fingerprint(df: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """Per key: row count and order-independent sums of two row hashes.

    The null pattern is hashed too (hash functions skip null inputs), so
    ``(null, 'a')`` and ``('a', null)`` differ. Grouping first means a key
    repeated many times is one row in the later join (no pair explosion).
    """
    mask = F.lit(0).cast("bigint")
    for i, c in enumerate(cols):
        mask = mask + F.when(F.col(c).isNull(), F.lit(1 << (i % 62))).otherwise(F.lit(0))
    vals = [F.col(c) for c in cols] + [mask]
    return df.groupBy(key).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.xxhash64(*vals).cast("decimal(38,0)")).alias("h1"),
        F.sum(F.hash(*vals).cast("decimal(38,0)")).alias("h2"),
    )


def snapshot_delta(prev: DataFrame, curr: DataFrame, key: str,
                   cols: Sequence[str] | None = None) -> DataFrame:
    """``(key, status)`` with status added / removed / changed / unchanged.

    Full outer join of per-key fingerprints (96 hash bits plus the row
    count); plain key equality, so null keys never match.
    """
    cols = list(cols or [c for c in curr.columns if c != key])
    if len(cols) > 62:
        raise ValueError("the null mask of a fingerprint holds 62 columns")
    a = _fingerprint(prev, key, cols).select(F.col(key).alias("__k1"), *[
        F.col(c).alias(c + "_1") for c in ("n", "h1", "h2")])
    b = _fingerprint(curr, key, cols).select(F.col(key).alias("__k2"), *[
        F.col(c).alias(c + "_2") for c in ("n", "h1", "h2")])
    j = a.join(b, a.__k1 == b.__k2, "full_outer")
    same = (F.col("n_1") == F.col("n_2")) & (F.col("h1_1") == F.col("h1_2")) & (
        F.col("h2_1") == F.col("h2_2"))
    return j.select(
        F.coalesce("__k2", "__k1").alias(key),
        F.when(F.col("n_1").isNull(), F.lit("added"))
        .when(F.col("n_2").isNull(), F.lit("removed"))
        .when(same, F.lit("unchanged"))
        .otherwise(F.lit("changed")).alias("status"),
    )


def newest_records(df: DataFrame, key: str, version: str) -> DataFrame:
    """Of each ``key``, the row of the greatest ``version`` over all snapshots.

    The newest version of a key is found first, by a hash aggregation with a
    map-side step on the two columns alone; only rows of that version go on.
    Several rows of one key in its newest version are a tie: of their distinct
    rows the greatest stays, compared column by column in the table's order
    (null is least, columns that cannot be compared are not allowed). Rows
    without a version are older than any; rows without a key are no versions
    of each other and all stay.
    """
    cols = df.columns
    keyed = df.filter(F.col(key).isNotNull())
    newest = keyed.groupBy(key).agg(F.max(version).alias("__newest"))
    last = keyed.join(newest, key).filter(F.col(version).eqNullSafe(F.col("__newest"))).select(*cols).distinct()
    whole = F.struct(*[F.col(f"`{c}`") for c in cols])
    one = last.groupBy(key).agg(F.max(whole).alias("__row")).select("__row.*")
    return one.select(*cols).unionByName(df.filter(F.col(key).isNull()))
