"""Shared helpers: working folders in the shared store, stored intermediate tables, connected groups."""

from __future__ import annotations

import atexit
import contextlib
import os
import uuid
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.session import ensure_checkpoint_dir

_FOLDERS: list[tuple[SparkSession, str]] = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A stored table. Python workers find this library where the driver has it, unless it is installed there."""
    root, paths = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    if root not in paths.get("PYTHONPATH", "").split(os.pathsep):
        paths["PYTHONPATH"] = os.pathsep.join(filter(None, [paths.get("PYTHONPATH"), root]))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, tag: str) -> str:
    """A new folder name below the session's shared checkpoint folder; removed by ``clean_scratch`` or at exit."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    folder = f"{base}/{tag}-{uuid.uuid4().hex}"
    _FOLDERS.append((spark, folder))
    return folder


def clean_scratch() -> None:
    """Remove the working folders; results that are still lazy read them, so call it when those are written."""
    while _FOLDERS:
        spark, folder = _FOLDERS.pop()
        with contextlib.suppress(Exception):
            jvm = spark.sparkContext._jvm
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


atexit.register(clean_scratch)


def stored(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and go on from the files: lineage ends there."""
    folder = scratch(df.sparkSession, tag)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


# Rows of a few short columns that are broadcast at most; a larger side is shuffled.
MOST_BROADCAST = 1_000_000


def sized_join(rows: DataFrame, side: DataFrame, on: list[str], how: str = "inner", most: int = MOST_BROADCAST) -> DataFrame:
    """Join long rows, such as whole texts, to a side that is stored and counted first.

    Up to ``most`` rows the side is broadcast and the long rows stay where they are; beyond it both are shuffled. Lists in the side
    count with their entries.
    """
    side = stored(side, "side")
    lists = [F.sum(F.size(f.name)) for f in side.schema if f.dataType.typeName() == "array"]
    total = sum((F.coalesce(c, F.lit(0)) for c in lists), F.count(F.lit(1)))
    return rows.join(F.broadcast(side) if side.agg(total).first()[0] <= most else side, on, how)


NULL_ID = -(1 << 63)


def row_key(id_column: str, text_column: str) -> dict[str, Column]:
    """What a row of documents is known by: its id (the smallest integer for NULL) and a hash of its text."""
    return {"_row_id": F.coalesce(F.col(id_column).cast("long"), F.lit(NULL_ID)), "_row_hash": F.xxhash64(F.col(text_column).cast("binary"))}


def without_rows(docs: DataFrame, gone: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``docs`` without the rows named in ``gone`` (``doc_id``, ``text_hash``)."""
    side = gone.select(F.coalesce("doc_id", F.lit(NULL_ID)).alias("_row_id"), F.col("text_hash").alias("_row_hash")).distinct()
    marked = docs.withColumns(row_key(id_column, text_column))
    return sized_join(marked, side, ["_row_id", "_row_hash"], "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step over edges ``a`` > ``b``: every node of a neighbourhood points to its smallest node."""
    sides = edges
    if large:
        sides = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    # groupBy + min combines on the map side, so a hub sends one row per task.
    least = sides.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    joined = sides.join(least, "a")
    if large:
        return joined.filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    moved = joined.filter(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b")))


def connected_groups(links: DataFrame) -> DataFrame:
    """(``node``, ``root``) for every node of ``links`` (``a``, ``b``): ``root`` is the smallest node that it reaches.

    Alternates large-star and small-star steps, each a join and an aggregation that leave no
    more edges than there were, until the edges repeat. Each round is stored, so that
    a lost executor costs one round. Self links and NULLs are ignored.
    """
    ordered = links.filter(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges, state = stored(ordered.distinct(), "links"), None
    while True:
        row = edges.agg(F.count(F.lit(1)).alias("n"), F.expr("bit_xor(xxhash64(a, b))").alias("h")).first()
        if row["n"] == 0 or (row["n"], row["h"]) == state:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            )
        state = (row["n"], row["h"])
        edges = stored(_star(_star(edges, True).distinct(), False).distinct(), "links")


def listed_links(
    postings: DataFrame, verified: Callable[[DataFrame], DataFrame], least: float, enough: Callable[[Column, Column, Column], Column] | None = None
) -> DataFrame:
    """Similar pairs (``a``, ``b``) that connect what all similar pairs of ``at`` with a common ``key`` connect.

    ``verified`` takes pairs and returns the similar ones; members whose ``chars``, a size, differ by more than ``1 - least`` of the larger are not.
    With ``enough``, a condition on the number of common keys and the two sizes that similar pairs meet, only pairs that do are verified.
    """
    lists = postings.groupBy("key").agg(F.min(F.struct("at", "chars")).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    postings = stored(postings.join(lists.select("key", "first"), "key"), "postings")

    def fits(left: str, right: str) -> Column:
        longest = F.greatest(F.col(left), F.col(right))
        return F.abs(F.col(left) - F.col(right)) <= F.floor((1 - F.lit(least)) * longest + 1e-9)

    def pairs(rows: DataFrame, a: str, b: str) -> DataFrame:
        """The different pairs of rows with a pair of members, ``a`` and ``b``, for each common key."""
        if enough is None:
            return rows.select(F.col(f"{a}.at").alias("a"), F.col(f"{b}.at").alias("b")).distinct()
        sizes = [F.first(f"{m}.chars").alias(name) for m, name in ((a, "_left"), (b, "_right"))]
        met = rows.groupBy(F.col(f"{a}.at").alias("a"), F.col(f"{b}.at").alias("b")).agg(F.count(F.lit(1)).alias("_n"), *sizes)
        return met.filter(enough(F.col("_n"), F.col("_left"), F.col("_right"))).select("a", "b")

    # First each member with the smallest of its lists, then every pair that is still apart.
    stars = postings.alias("own").filter((F.col("first.at") != F.col("own.at")) & fits("first.chars", "own.chars"))
    links = stored(verified(pairs(stars, "first", "own")), "links")
    groups = connected_groups(links).withColumnRenamed("node", "at")
    grouped = stored(postings.drop("first").join(groups, "at", "left").withColumn("root", F.coalesce("root", "at")), "grouped")
    # Lists whose members are linked already have no pair.
    mixed = grouped.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo != hi").select("key")
    grouped = grouped.join(mixed, "key")
    a, b = grouped.alias("a"), grouped.alias("b")
    apart = (F.col("a.key") == F.col("b.key")) & (F.col("a.at") < F.col("b.at")) & (F.col("a.root") != F.col("b.root")) & fits("a.chars", "b.chars")
    return links.unionByName(verified(pairs(a.join(b, apart), "a", "b")))
