"""Ranking yearly charts by page position."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.operators.ordering import top_per_group


def rank_chart(entries: DataFrame, order: Sequence, size: int = 100, best: int = 10) -> DataFrame:
    """Rank entries (``year``, ``title``, ``artist`` and the columns of ``order``) within their year.

    Repeated entries keep their first place only. The first ``size`` ranks stay, and
    ``top_10`` flags ranks up to ``best``.
    """
    once = entries.groupBy("year", "title", "artist").agg(F.min(F.struct(*order)).alias("_place"))
    ranked = top_per_group(once, ["year"], ["_place", "title", "artist"], size, "rank").drop("_place")
    return ranked.withColumn("top_10", (F.col("rank") <= best).cast("bigint"))


def union_all(tables: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, tables)
