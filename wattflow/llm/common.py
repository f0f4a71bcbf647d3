"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattflow.session import ship_package

#: FIXED VALUE: the white space that separates words, as a regex class body.
SPACE = r"\x20\x09-\x0D"


def prepare(spark: SparkSession) -> None:
    """Workers get this package, and, unless the session sets its own, Arrow
    batches of fewer rows: rows are whole texts here, not numbers."""
    ship_package(spark)
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(rows, "10000") == "10000":
        spark.conf.set(rows, "1000")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def held_out(id_col: str) -> Column:
    """True for the fold that is never learned from: crc32(id as text) mod 4
    is 2. A null id belongs to no fold and counts as not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


def whole_row(df: DataFrame, wanted: bool) -> list[Column]:
    """The input row as one struct, ``row_in``, for results that carry it: its
    column names cannot clash with the result's."""
    return [F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row_in")] if wanted else []


def row_type(src: DataFrame, wanted: bool) -> str:
    return f", row_in {src.schema['row_in'].dataType.simpleString()}" if wanted else ""


def text_groups(texts: list[str | None], max_chars: int = 400_000) -> Iterator[tuple[int, int]]:
    """Cut a batch into runs [i, j) of about ``max_chars`` characters, so the
    memory of a vectorised step does not depend on the batch size (a longer
    single text is a run of its own)."""
    start, total = 0, 0
    for i, t in enumerate(texts):
        n = len(t) if t else 0
        if i > start and total + n > max_chars:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(texts):
        yield start, len(texts)


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices start, start+1, ... of every run, one run after another."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(total)
