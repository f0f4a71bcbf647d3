"""Session factory and shared-folder helpers."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings every build relies on. ANSI stays on (Spark 4 default); parsing of
# dirty text goes through try_* functions instead.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "static",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(app: str = "wattflow", conf: dict | None = None,
                master: str | None = None) -> SparkSession:
    """Build (or reuse) a session with UTC time, AQE and ANSI on.

    Object-store credentials and endpoints are not set here: they belong to
    the submit configuration of the cluster.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in {**DEFAULT_CONF, **(conf or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder of the session.

    ``spark.checkpoint.dir`` names the folder that driver and executors share
    and is used as is. Where it is unset, a local master (tests, one machine)
    gets a fresh temporary folder; any other master raises, because a folder
    of one machine would silently split the written tables over the disks of
    the executors.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not conf_dir:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise ValueError("spark.checkpoint.dir must name a folder shared by the driver and "
                             f"the executors when the master is {sc.master!r}")
        conf_dir = tempfile.mkdtemp(prefix="wattflow-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique folder under the shared checkpoint folder.

    Used for intermediate tables (CSV/Parquet round trips, landings) so that
    every executor can reach them and lineage can be cut by re-reading.
    """
    return f"{_scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def _scratch_root(spark: SparkSession) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/wattflow"


def stage(df: DataFrame, name: str = "stage", options: dict[str, str] | None = None) -> DataFrame:
    """Write an intermediate table once under the shared folder and read it
    back: its consumers share one computation, lineage is cut, and the rows
    survive the loss of an executor. ``options`` are those of the writer."""
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").options(**(options or {})).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Sizes that bound the rows of one task: bytes of files a task reads, and
#: partitions of a shuffle before adaptive execution joins small ones (it
#: cannot split large ones below an aggregation).
PIECES = {"spark.sql.files.maxPartitionBytes": "8m",
          "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "600"}


@contextmanager
def bounded_pieces(spark: SparkSession) -> Iterator[None]:
    """Jobs started inside run as many small tasks instead of few large ones.

    The hash table of an aggregation holds all groups of its task, so its
    memory follows the piece the task reads. Values that the session sets
    itself are kept; the others are unset again afterwards.
    """
    ours = {k: v for k, v in PIECES.items() if spark.conf.get(k, None) is None}
    for k, v in ours.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k in ours:
            spark.conf.unset(k)


def ship_package(spark: SparkSession) -> None:
    """Give this package to the Python workers, once a context: functions that
    run inside tasks are found there even if the machines have no copy of it."""
    sc = spark.sparkContext
    if getattr(sc, "_wattflow_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="wattflow-py-"), "wattflow.zip")
    with zipfile.ZipFile(target, "w") as z:
        for folder, _, names in os.walk(root):
            for n in names:
                if n.endswith(".py"):
                    path = os.path.join(folder, n)
                    z.write(path, os.path.join("wattflow", os.path.relpath(path, root)))
    sc.addPyFile(target)
    sc._wattflow_shipped = True


def drop_scratch(spark: SparkSession) -> None:
    """Delete every intermediate table of this session (frames that still
    read one of them can no longer be evaluated)."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_scratch_root(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
