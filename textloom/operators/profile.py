"""Table profiling and data-quality reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from textloom.functions.text import is_numeric
from textloom.operators.ordering import percentiles, top_per_group


def null_counts(df: DataFrame) -> DataFrame:
    """Rows (``column``, ``n_null``): one pass over the table."""
    counts = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns])
    return counts.unpivot([], [F.col(f"`{c}`") for c in df.columns], "column", "n_null")


def table_report(df: DataFrame) -> DataFrame:
    """Rows (``position``, ``column``, ``type``, ``non_null``) of a table."""
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    counts = df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in df.columns])
    entries = [
        F.struct(
            F.lit(i).cast("bigint").alias("position"),
            F.lit(c).alias("column"),
            F.lit(types[c]).alias("type"),
            F.col(f"`{c}`").alias("non_null"),
        )
        for i, c in enumerate(df.columns)
    ]
    return counts.select(F.inline(F.array(*entries)))


def shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_columns", F.lit(len(df.columns)).cast("bigint"))


def deduplicate(df: DataFrame, subset: Sequence[str], keep_first_by: str) -> DataFrame:
    """One row per value of ``subset``: the one with the smallest ``keep_first_by``.

    Missing values count as equal. Every task drops its own repeats before the shuffle.
    """
    return top_per_group(df, subset, [keep_first_by], 1, "_copy").drop("_copy")


def duplicate_report(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    """Rows, surplus copies of whole rows, and rows left without repeats of ``subset``.

    The nested form of the two counts needs one pass: whole rows are counted first, and
    their groups are counted by ``subset``.
    """
    whole = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_copies"))
    by_subset = whole.groupBy(*subset).agg(F.sum("_copies").alias("_rows"), F.count(F.lit(1)).alias("_different"))
    return by_subset.agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("n_rows"),
        F.coalesce(F.sum(F.col("_rows") - F.col("_different")), F.lit(0)).alias("n_duplicate_rows"),
        F.count(F.lit(1)).alias("n_left"),
    )


def describe(df: DataFrame, column: str) -> DataFrame:
    """Eight-number summary as rows (``statistic``, ``value``); percentiles are exact."""
    value = F.col(column).cast("double")
    moments = df.agg(
        F.count(value).cast("double").alias("count"),
        F.avg(value).alias("mean"),
        F.stddev_samp(value).alias("std"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
    ).unpivot([], ["count", "mean", "std", "min", "max"], "statistic", "value")
    quarters = percentiles(df, column, [0.25, 0.5, 0.75])
    named = quarters.select(F.concat((F.col("share") * 100).cast("int"), F.lit("%")).alias("statistic"), "value")
    return moments.unionByName(named)


def length_stats(df: DataFrame, column: str) -> DataFrame:
    n = F.length(column)
    return df.agg(
        F.avg(n).alias("mean_length"),
        F.max(n).cast("bigint").alias("max_length"),
        F.min(n).cast("bigint").alias("min_length"),
    )


def list_length_counts(df: DataFrame, items: Column, name: str = "n_items") -> DataFrame:
    sizes = df.select(F.size(items).cast("bigint").alias(name), items.alias("_items")).filter("_items IS NOT NULL")
    return sizes.groupBy(name).agg(F.count(F.lit(1)).alias("n"))


def shares(df: DataFrame, column: str) -> DataFrame:
    """Share of the rows per value of a column with few values."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    return counts.withColumn("share", F.col("n") / total)


def funnel(df: DataFrame, steps: Mapping[str, Column]) -> DataFrame:
    """Rows left after each filter step, in one pass: rows (``step``, ``name``, ``n``)."""
    passed: Column = F.lit(True)
    counts = [F.count(F.lit(1)).alias("_0")]
    for i, condition in enumerate(steps.values(), 1):
        passed = passed & F.coalesce(condition, F.lit(False))
        counts.append(F.count_if(passed).alias(f"_{i}"))
    names = ["all", *steps]
    rows = [
        F.struct(F.lit(i).cast("bigint").alias("step"), F.lit(name).alias("name"), F.col(f"_{i}").alias("n"))
        for i, name in enumerate(names)
    ]
    return df.agg(*counts).select(F.inline(F.array(*rows)))


def rounded_means(df: DataFrame, digits: int = 3) -> DataFrame:
    """Mean of every numeric column, rounded."""
    numeric = [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]
    return df.agg(*[F.round(F.avg(F.col(f"`{c}`")), digits).alias(c) for c in numeric])


def quality_report(
    df: DataFrame, name_column: str, year_column: str, rank_column: str, row_key: str, head: int = 5, best: int = 10, sample: int = 20
) -> DataFrame:
    """All checks of a chart-like table as one long table (``check``, ``key``, ``value``).

    Types, non-missing and missing counts, purely numeric names, the first years, the rank
    summary, the first best-ranked rows and the first names.
    """

    def rows(table: DataFrame, check: str, key: Column, value: Column) -> DataFrame:
        return table.select(F.lit(check).alias("check"), key.cast("string").alias("key"), value.cast("string").alias("value"))

    # Everything that is one number per table or column comes from one pass.
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    rank = F.col(rank_column).cast("double")
    moments = {"count": F.count(rank).cast("double"), "mean": F.avg(rank), "std": F.stddev_samp(rank), "min": F.min(rank), "max": F.max(rank)}
    summary = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        F.count_if(is_numeric(F.col(name_column))).alias("_numeric"),
        *[F.count(F.col(f"`{c}`")).alias(f"_has_{i}") for i, c in enumerate(df.columns)],
        *[value.alias(f"_rank_{name}") for name, value in moments.items()],
    )

    def entry(check: str, key: str, value: Column) -> Column:
        return F.struct(F.lit(check).alias("check"), F.lit(key).alias("key"), value.cast("string").alias("value"))

    entries = [entry("numeric_names", "count", F.col("_numeric"))]
    for i, c in enumerate(df.columns):
        entries.append(entry("type", c, F.lit(types[c])))
        entries.append(entry("non_null", c, F.col(f"_has_{i}")))
        entries.append(entry("n_null", c, F.col("_rows") - F.col(f"_has_{i}")))
    entries += [entry("rank", name, F.round(f"_rank_{name}", 6)) for name in moments]
    quarters = percentiles(df, rank_column, [0.25, 0.5, 0.75])
    quarter_name = F.concat((F.col("share") * 100).cast("int"), F.lit("%"))
    numeric_names = df.filter(is_numeric(F.col(name_column)))
    years = df.filter(F.col(year_column).isNotNull()).groupBy(year_column).agg(F.count(F.lit(1)).alias("n"))
    firsts = df.orderBy(row_key).limit(head)
    best_rows = df.filter(F.col(rank_column) <= best).orderBy(row_key).limit(head)
    names = df.filter(F.col(name_column).isNotNull()).groupBy(name_column).agg(F.min(row_key).alias("_first"))
    names = names.orderBy("_first").limit(sample)
    record = F.to_json(F.struct(*df.columns))
    parts = [
        summary.select(F.inline(F.array(*entries))),
        rows(firsts, "head", F.col(row_key), record),
        rows(numeric_names.orderBy(row_key).limit(10), "numeric_name", F.col(row_key), F.col(name_column)),
        rows(years.orderBy(year_column).limit(head), "year", F.col(year_column), F.col("n")),
        rows(quarters, "rank", quarter_name, F.round("value", 6)),
        rows(best_rows, "best", F.col(row_key), record),
        rows(names, "name", F.col("_first"), F.col(name_column)),
    ]
    report = parts[0]
    for part in parts[1:]:
        report = report.unionByName(part)
    return report
