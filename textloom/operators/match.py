"""Matching two tables on normalised title and artist keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.functions.keys import artist_key, title_key
from textloom.operators.skew import small_join

KEYS = ["title_clean", "artist_clean"]


def with_keys(df: DataFrame, title: str = "title", artist: str = "artist", mode: str = "reference") -> DataFrame:
    return df.withColumn("title_clean", title_key(title)).withColumn("artist_clean", artist_key(artist, mode))


def weighted_join(
    df: DataFrame, other: DataFrame, spread_by: Sequence[str], keys: Sequence[str] = tuple(KEYS), repeats: str = "repeats"
) -> DataFrame:
    """Rows of ``df`` that have a match in ``other``, once each, with the number of matching rows; missing keys match nothing.

    ``other`` contributes its keys only, so it shrinks to one row per key with a repeat
    count first, and is broadcast when that is small; ``df`` is not shuffled then. The pairs of a
    key are as many as its rows on both sides multiplied; here they stay a number.
    """
    counted = other.groupBy(*keys).agg(F.count(F.lit(1)).alias(repeats))
    return small_join(df, counted, list(keys), spread_by)


def key_join(df: DataFrame, other: DataFrame, spread_by: Sequence[str], keys: Sequence[str] = tuple(KEYS)) -> DataFrame:
    """Rows of ``df`` once for every row of ``other`` with the same keys: ``weighted_join`` with the repeats made up within the row."""
    matched = weighted_join(df, other, spread_by, keys, "_repeats")
    every = F.sequence(F.lit(1), F.col("_repeats").cast("int"))
    return matched.withColumn("_copy", F.explode(every)).drop("_copy", "_repeats")


def match_summary(
    df: DataFrame, other: DataFrame, matched: DataFrame, keys: Sequence[str] = tuple(KEYS), repeats: str | None = None
) -> DataFrame:
    """Row and distinct-key counts before and after a match, and the share of ``other`` that was found.

    ``matched`` holds a row per match, or one per row of ``df`` with the number of its matches in ``repeats``.
    """
    different = other.select(*keys).distinct().agg(F.count(F.lit(1)).alias("n_other_distinct"))
    matches = F.count(F.lit(1)) if repeats is None else F.sum(repeats)
    by_key = matched.groupBy(*keys).agg(matches.alias("_n"))
    found = by_key.agg(F.struct(F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"), F.count(F.lit(1)).alias("keys")))
    summary = different.withColumn("_found", found.scalar()).select(
        df.agg(F.count(F.lit(1))).scalar().alias("n_rows"),
        "n_other_distinct",
        F.col("_found.rows").alias("n_matched"),
        F.col("_found.keys").alias("n_matched_distinct"),
    )
    return summary.withColumn("match_rate", F.round(100.0 * F.col("n_matched_distinct") / F.col("n_other_distinct"), 1))
