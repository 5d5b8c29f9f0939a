"""Session helpers: a tuned builder, and reliable lineage cuts."""

from __future__ import annotations

import atexit
import contextlib
import os
import tempfile
import uuid
from collections.abc import Mapping
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def build_session(
    app: str = "textloom",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    options: Mapping[str, str] | None = None,
) -> SparkSession:
    """A session with adaptive execution on and UTC timestamps; settings given to spark-submit win."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    if master:
        builder = builder.master(master).config("spark.ui.enabled", "false")
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (options or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The folder for checkpoints: ``spark.checkpoint.dir`` of the session when set.

    Only a local master gets a fresh folder of its own. On a cluster a machine-local
    folder would be lost with its executor, so an unset folder is an error there.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        # local-cluster[...] runs executors as processes of their own: it is a cluster.
        if sc.master != "local" and not sc.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a shared folder before running an iterative job")
        configured = tempfile.mkdtemp(prefix="textloom-checkpoint-")
    sc.setCheckpointDir(configured)
    return configured


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the checkpoint folder and go on from there; survives the loss of executors."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


# Makes Spark drop a query's shuffle files when the query ends, not when the driver happens to collect its garbage.
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_FOLDERS: list[tuple[SparkSession, str]] = []


def stored_table(df: DataFrame, tag: str) -> DataFrame:
    """As ``cut_lineage`` for large tables: Parquet files, a fraction of a checkpoint, and the shuffle files that made them go at once.

    The folder, below the checkpoint folder, is removed when the process ends.
    """
    spark = df.sparkSession
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{tag}-{uuid.uuid4().hex}"
    _FOLDERS.append((spark, folder))
    before = spark.conf.get(DROP_SHUFFLES)
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        df.write.parquet(folder)
    finally:
        spark.conf.set(DROP_SHUFFLES, before)
    return spark.read.schema(df.schema).parquet(folder)


def _remove_folders() -> None:
    while _FOLDERS:
        spark, folder = _FOLDERS.pop()
        with contextlib.suppress(Exception):
            path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


atexit.register(_remove_folders)


def ship_library(spark: SparkSession) -> None:
    """Let Python workers find this library where the driver has it, unless it is installed there."""
    root, paths = str(Path(__file__).resolve().parents[1]), spark.sparkContext.environment
    if root not in paths.get("PYTHONPATH", "").split(os.pathsep):
        paths["PYTHONPATH"] = os.pathsep.join(filter(None, [paths.get("PYTHONPATH"), root]))
