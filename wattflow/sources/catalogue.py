"""Resource catalogue: pick the CSV resource of one period."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_catalogue(spark: SparkSession, path: str) -> DataFrame:
    """``{"result": {"resources": [{name, format, url}, ...]}}`` -> one row per
    resource with its array position."""
    doc = spark.read.option("multiLine", "true").json(path)
    return doc.select(F.posexplode("result.resources").alias("pos", "r")).select(
        "pos", F.col("r.name").alias("name"), F.col("r.format").alias("format"),
        F.col("r.url").alias("url"))


def write_catalogues(resources: DataFrame, path: str) -> None:
    """Resources (catalogue, pos, name, format, url) -> one JSON document per
    ``catalogue`` in the form that ``read_catalogue`` reads, under
    ``catalogue=<id>/``; a document is one row, as large as its list."""
    entry = F.struct("pos", "name", "format", "url")
    listed = resources.groupBy("catalogue").agg(F.sort_array(F.collect_list(entry)).alias("r"))
    plain = F.transform("r", lambda x: F.struct(x["name"].alias("name"), x["format"].alias("format"), x["url"].alias("url")))
    listed.select("catalogue", F.struct(plain.alias("resources")).alias("result")).write.partitionBy(
        "catalogue").option("ignoreNullFields", "false").mode("overwrite").json(path)


def read_catalogues(spark: SparkSession, path: str) -> DataFrame:
    """``read_catalogue`` over many documents, one per ``catalogue=<id>/`` folder."""
    schema = "result struct<resources: array<struct<name: string, format: string, url: string>>>, catalogue bigint"
    doc = spark.read.schema(schema).option("multiLine", "true").json(path)
    return doc.select("catalogue", F.posexplode("result.resources").alias("pos", "r")).select(
        "catalogue", "pos", "r.name", "r.format", "r.url")


def select_resources(resources: DataFrame, year: int, month: int) -> DataFrame:
    """``select_resource`` for each ``catalogue``: its first hit, if it has one."""
    hits = resources.filter(_matches(year, month))
    return hits.groupBy("catalogue").agg(F.min(F.struct("pos", "name", "url")).alias("r")).select("catalogue", "r.*")


def _matches(year: int, month: int) -> Column:
    target = f"{year}_{month:02d}"
    up = lambda c: F.upper(F.coalesce(F.col(c), F.lit("")))
    return (up("format") == "CSV") & (up("name").contains(target) | up("url").contains(target))


def select_resource(resources: DataFrame, year: int, month: int) -> DataFrame:
    """First resource (by position) whose format is CSV (any case) and whose
    upper-cased name or url contains ``YYYY_MM``; nulls count as empty text.
    At most one row (a distributed top-1)."""
    return resources.filter(_matches(year, month)).orderBy("pos").limit(1).select("pos", "name", "url")


def resolve_resource(resources: DataFrame, year: int, month: int) -> dict:
    """Driver-side form: ``{"url", "name"}``, or ``ValueError`` when none matches."""
    row = select_resource(resources, year, month).first()
    if row is None:
        raise ValueError(f"no CSV resource for {year}-{month:02d}")
    return {"url": row["url"], "name": row["name"]}
