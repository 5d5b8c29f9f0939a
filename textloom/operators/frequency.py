"""Counting values, and selecting rows or tokens by how frequent they are."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.operators.ordering import global_row_number, top_k
from textloom.operators.skew import lookup_join


def value_counts(df: DataFrame, column: str, name: str = "n") -> DataFrame:
    """How often each value occurs; missing values are not counted."""
    return df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias(name))


def ordered_counts(df: DataFrame, column: str, name: str = "n") -> DataFrame:
    """Value counts from the most frequent down, ties by value."""
    return value_counts(df, column, name).orderBy(F.desc(name), column)


def top_values(df: DataFrame, column: str, k: int, name: str = "n") -> DataFrame:
    return top_k(value_counts(df, column, name), name, column, k)


def distinct_count(df: DataFrame, columns: Sequence[str], name: str = "n_distinct", approximate: bool = False) -> DataFrame:
    """Number of different rows in ``columns``, a missing value being a value like any other."""
    if approximate:
        return df.agg(F.approx_count_distinct(F.struct(*columns)).alias(name))
    return df.select(*columns).distinct().agg(F.count(F.lit(1)).alias(name))


def distinct_values(df: DataFrame, column: str, k: int) -> DataFrame:
    """The first ``k`` different values in value order."""
    return df.filter(F.col(column).isNotNull()).select(column).distinct().orderBy(column).limit(k)


def label_counts(df: DataFrame, labels: Column, name: str = "label") -> DataFrame:
    """Frequency of each label of a multi-label column; blank labels do not count."""
    exploded = df.select(F.explode(labels).alias(name)).select(F.trim(name).alias(name))
    return value_counts(exploded.filter(F.col(name) != ""), name)


def top_labels(df: DataFrame, labels: Column, k: int, name: str = "label") -> DataFrame:
    return top_k(label_counts(df, labels, name), "n", name, k)


def rows_of_top_groups(df: DataFrame, column: str, k: int) -> DataFrame:
    """Rows whose ``column`` is among its ``k`` most frequent values (``k`` values are broadcast)."""
    return df.join(F.broadcast(top_values(df, column, k).select(column)), column, "left_semi")


def word_counts(df: DataFrame, tokens: Column, name: str = "token") -> DataFrame:
    return df.select(F.explode(tokens).alias(name)).groupBy(name).agg(F.count(F.lit(1)).alias("n"))


def frequent_terms(df: DataFrame, tokens: Column, at_least: int = 2) -> DataFrame:
    """Vocabulary of the terms seen ``at_least`` times, with their counts."""
    return word_counts(df, tokens, "term").filter(F.col("n") >= at_least)


def vocabulary_index(vocabulary: DataFrame, term: str = "term") -> DataFrame:
    """Number the terms from 0 in sorted order."""
    return global_row_number(vocabulary, term, "term_index")


def keep_vocabulary(df: DataFrame, id_column: str, tokens: Column, vocabulary: DataFrame) -> DataFrame:
    """Cut token arrays down to a vocabulary ``(term, n)``, order kept; every row stays.

    Vocabularies may be large, so tokens meet them in a join that spreads frequent terms.
    """
    tokens_long = df.select(id_column, F.posexplode(tokens).alias("pos", "term"))
    kept = lookup_join(tokens_long, vocabulary.select("term"), ["term"], None, [id_column, "pos"])
    ordered = F.array_sort(F.collect_list(F.struct("pos", "term")))
    arrays = kept.groupBy(id_column).agg(F.transform(ordered, lambda t: t["term"]).alias("tokens"))
    empty = F.array().cast("array<string>")
    return df.join(arrays, id_column, "left").withColumn("tokens", F.coalesce("tokens", empty))
