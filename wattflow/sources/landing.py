"""Sanity checks on landed raw files: empty files and HTML error pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattflow.schemas import HTML_MARKER, HTML_SNIFF_BYTES


def html_head(content: Column, nbytes: int = HTML_SNIFF_BYTES) -> Column:
    """True when the first ``nbytes`` bytes, lower-cased, contain ``<html``.

    Works on binary directly (a cast, not a strict decode), so a multi-byte
    character cut at the window edge cannot fail the check.
    """
    return F.lower(F.substring(content, 1, nbytes).cast("string")).contains(HTML_MARKER)


def text_check(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Landing rule applied to text already in a table: bytes of the whole
    text, HTML marker in its first bytes, ok = non-empty and not HTML."""
    # the window holds no more characters than bytes
    data = F.encode(F.substring(F.col(text_col), 1, HTML_SNIFF_BYTES), "UTF-8")
    return df.select(
        F.col(id_col).alias("item_id"),
        F.octet_length(text_col).cast("bigint").alias("n_bytes"),
        html_head(data).alias("is_html"),
    ).withColumn("ok", (F.col("n_bytes") > 0) & ~F.col("is_html"))


def _head_reader(nbytes: int):
    """mapInPandas body: the first bytes of each listed file. It is a closure,
    so it travels with the plan and workers need not have this package."""
    def read(batches):
        import pyarrow.fs as pafs

        for pdf in batches:
            heads = []
            for p in pdf["path"]:
                uri = p.replace("s3a://", "s3://", 1)
                if uri.startswith("file:") and not uri.startswith("file://"):
                    uri = "file://" + uri[len("file:"):]
                fs, rel = pafs.FileSystem.from_uri(uri)
                with fs.open_input_stream(rel) as f:
                    heads.append(f.read(nbytes))
            yield pdf.assign(head=heads)

    return read


def landing_check(spark: SparkSession, root: str, expected: DataFrame | None = None,
                  glob: str | None = None) -> DataFrame:
    """Check landed files: ``(path, n_bytes, is_html, ok, reason)``.

    The listing (``binaryFile`` with only ``path``/``length`` selected) reads
    no content; the HTML test reads only the first bytes of each file, in the
    tasks that own the files. Zero-byte files are absent from the listing,
    so an ``expected`` manifest (column ``path``) reports them as missing.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    listing = reader.load(root).select("path", F.col("length").alias("n_bytes"))
    heads = listing.mapInPandas(_head_reader(HTML_SNIFF_BYTES), "path string, n_bytes bigint, head binary")
    found = heads.select(
        "path", "n_bytes", F.coalesce(html_head(F.col("head")), F.lit(False)).alias("is_html"))
    found = found.withColumns({
        "ok": (F.col("n_bytes") > 0) & ~F.col("is_html"),
        "reason": F.when(F.col("n_bytes") == 0, F.lit("empty"))
        .when(F.col("is_html"), F.lit("html")).otherwise(F.lit(None).cast("string")),
    })
    if expected is None:
        return found
    missing = expected.select("path").join(found.select("path"), "path", "left_anti").select(
        "path", F.lit(0).cast("bigint").alias("n_bytes"), F.lit(False).alias("is_html"),
        F.lit(False).alias("ok"), F.lit("missing_or_empty").alias("reason"))
    return found.unionByName(missing)
