"""Global order without a single task: row numbers, neighbours, ranks and quantiles.

The order is cut into ranges. Work within a range runs in parallel, and only a table with
one row per range is ever brought together.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.operators.skew import small_join

RANGES = 256


def _with_range(df: DataFrame, key: str, ranges: int) -> DataFrame:
    """Add ``_range``, the number of the range that ``key`` falls in.

    The cut points are a hash sample of the keys. They only steer the balance: any cut
    points give the same result, as long as every use of the table sees the same ones,
    which a hash guarantees and an approximate sketch would not. A key is compared with
    every ``width``-th cut first and then within one block of cuts.
    """
    width = math.isqrt(ranges)
    sample = df.select(key).orderBy(F.xxhash64(key), key).limit(ranges - 1)
    cuts = sample.agg(F.array_sort(F.collect_set(key)).alias("cuts"))
    starts = F.sequence(F.lit(0), F.size("cuts"), F.lit(width))
    blocks = F.transform(starts, lambda i: F.slice("cuts", i + 1, F.lit(width - 1)))
    heads = F.filter("cuts", lambda cut, i: i % width == width - 1)
    packed = cuts.select(F.struct(heads.alias("heads"), blocks.alias("blocks")))
    placed = df.withColumn("_cuts", packed.scalar())
    placed = placed.withColumn("_block", F.size(F.filter("_cuts.heads", lambda cut: cut <= F.col(key))))
    within = F.size(F.filter(F.get("_cuts.blocks", F.col("_block")), lambda cut: cut <= F.col(key)))
    return placed.withColumn("_range", F.col("_block") * width + within).drop("_cuts", "_block")


def _offsets(df: DataFrame, group: str, size: Column) -> DataFrame:
    """Rows before each group, for a few groups."""
    sizes = df.groupBy(group).agg(size.alias("_size"))
    before = Window.orderBy(group).rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select(group, F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"))


def global_row_number(df: DataFrame, key: str, name: str, ranges: int = RANGES) -> DataFrame:
    """Number the rows from 0 in the order of the unique column ``key``."""
    ranged = _with_range(df, key, ranges)
    within = F.row_number().over(Window.partitionBy("_range").orderBy(key)).cast("bigint") - 1
    numbered = ranged.withColumn("_within", within)
    offsets = _offsets(ranged, "_range", F.count(F.lit(1)))
    return (
        numbered.join(F.broadcast(offsets), "_range")
        .withColumn(name, F.col("_before") + F.col("_within"))
        .drop("_range", "_within", "_before")
    )


def with_next(df: DataFrame, key: str, value: str, name: str, ranges: int = RANGES) -> DataFrame:
    """Add ``value`` of the following row in the order of the unique column ``key``; NULL at the end."""
    ranged = _with_range(df, key, ranges)
    within = ranged.withColumn("_next", F.lead(F.struct(value)).over(Window.partitionBy("_range").orderBy(key)))
    heads = ranged.groupBy("_range").agg(F.min_by(value, key).alias("_head"))
    after = heads.select("_range", F.lead("_head").over(Window.orderBy("_range")).alias("_after"))
    following = F.when(F.col("_next").isNotNull(), F.col(f"_next.{value}")).otherwise(F.col("_after"))
    return within.join(F.broadcast(after), "_range").withColumn(name, following).drop("_range", "_next", "_after")


def top_k(df: DataFrame, score: str, tie: str | Sequence[str], k: int) -> DataFrame:
    """The ``k`` rows with the highest ``score``, ties by ``tie`` ascending; NULL scores come last.

    Most rows are first ruled out by a histogram over the scores' magnitudes, because the final step brings
    ``k`` rows of every task together. Every score has a level, and a higher score never a lower one.
    """
    ties = [tie] if isinstance(tie, str) else list(tie)
    level = _score_level(F.col(score).cast("double"))
    levels = df.groupBy(level.alias("_level")).agg(F.count(F.lit(1)).alias("_size"))
    above = F.sum("_size").over(Window.orderBy(F.desc("_level")).rowsBetween(Window.unboundedPreceding, -1))
    needed = levels.select("_level", F.coalesce(above, F.lit(0)).alias("_above")).filter(F.col("_above") < k)
    df = df.filter(level >= needed.agg(F.min("_level")).scalar())
    return df.orderBy(F.desc_nulls_last(score), *ties).limit(k)


def _score_level(value: Column) -> Column:
    """Powers of 2^(1/8) on both sides of zero: at most some 35 000 levels, in the order of the values; NaN is highest, NULL lowest."""
    size = F.floor(F.log2(F.abs(value)) * 8).cast("int")
    edge = 20_000
    return (
        F.when(value.isNull(), F.lit(-2 * edge))
        .when(F.isnan(value), F.lit(2 * edge))
        .when(value == 0, F.lit(0))
        .when(F.abs(value) == F.lit(float("inf")), F.when(value > 0, edge).otherwise(-edge))
        .when(value > 0, size + edge // 2)
        .otherwise(-size - edge // 2)
    )


def top_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column | str], k: int, name: str) -> DataFrame:
    """The first ``k`` rows per group, numbered from 1.

    Spark applies the bound in every task before the shuffle, so a hot group sends at most
    ``k`` rows per task.
    """
    ranked = df.withColumn(name, F.row_number().over(Window.partitionBy(*group).orderBy(*order)).cast("bigint"))
    return ranked.filter(F.col(name) <= k)


def percentiles(df: DataFrame, column: str, shares: Sequence[float], ranges: int = 1024, accuracy: int = 10_000) -> DataFrame:
    """Exact interpolated percentiles as rows (``share``, ``value``).

    A sketch of the values brackets the wanted positions first. Values outside of the brackets only count as so many rows below
    or above, so what is grouped by value, cut into ranges and sorted are the brackets alone, some 6/``accuracy`` of the rows each.
    """
    values = df.filter(F.col(column).isNotNull()).select(F.col(column).cast("double").alias("_v"))
    counts = values.select(_outside_brackets(values, shares, accuracy).alias("_v")).groupBy("_v").agg(F.count(F.lit(1)).alias("_n"))
    ranged = _with_range(counts, "_v", ranges)
    sizes = ranged.groupBy("_range").agg(F.sum("_n").alias("_size"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    spans = sizes.select(
        "_range",
        "_size",
        F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"),
        F.sum("_size").over(Window.partitionBy()).alias("_total"),
    ).withColumn("share", F.explode(F.array(*[F.lit(float(s)) for s in shares])))
    position = F.col("share") * (F.col("_total") - 1)
    places = spans.select(
        "_range",
        "_size",
        "_before",
        "share",
        (position - F.floor(position)).alias("_part"),
        F.explode(F.array(F.floor(position), F.ceil(position))).alias("_position"),
    ).filter(F.col("_position").between(F.col("_before"), F.col("_before") + F.col("_size") - 1))
    needed = ranged.join(F.broadcast(places.select("_range", "_before").distinct()), "_range")
    so_far = F.sum("_n").over(Window.partitionBy("_range").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0))
    upto = needed.withColumn("_upto", F.col("_before") + so_far).drop("_before")
    inside = (F.col("_position") < F.col("_upto")) & (F.col("_position") >= F.col("_upto") - F.col("_n"))
    found = upto.join(F.broadcast(places.drop("_before", "_size")), "_range").filter(inside)
    low, high = F.min("_v"), F.max("_v")
    # Infinite values have no difference.
    return found.groupBy("share").agg(F.when(low == high, low).otherwise(low + (high - low) * F.min("_part")).alias("value"))


def _outside_brackets(values: DataFrame, shares: Sequence[float], accuracy: int) -> Column:
    """``_v`` inside of the brackets, one value per gap between them outside.

    The sketch errs by one in ``accuracy`` of the rows, a bracket reaches three in ``accuracy`` to both sides; in tables too small for
    that to be many rows every value stays. The brackets are fixed numbers in the plan, so that all its parts see the same ones.
    """
    # NaN is above all numbers, as in sorting.
    value = F.nanvl("_v", F.lit(float("inf")))
    margin = 3 / accuracy
    ends = sorted((max(0.0, s - margin), min(1.0, s + margin)) for s in shares)
    n, found = values.agg(F.count(F.lit(1)), F.percentile_approx(value, [x for pair in ends for x in pair], accuracy)).first()
    if n <= 10 * accuracy:
        return F.col("_v")
    brackets = list(zip(found[::2], found[1::2]))
    inside = [value.between(low, high) for low, high in brackets]
    place = F.when(reduce(or_, inside), F.col("_v"))
    # A gap counts under the number halfway between its brackets.
    for i, (low, _) in enumerate(brackets):
        between = brackets[i - 1][1] / 2 + low / 2 if i else float("-inf")
        place = place.when(value < low, F.lit(0.0 if math.isnan(between) else between))
    return place.otherwise(F.lit(float("nan")))


def smallest_share(
    df: DataFrame, id_column: str, group: str, share: float, seed: int, name: str, buckets: int = 4096
) -> DataFrame:
    """Flag ``share`` of the rows of each group, chosen by a seeded hash of the id.

    The flagged rows number ``ceil(share * rows)`` in all, shared out over the groups in
    proportion: each gets the whole part of its quota, and the largest remainders (ties: the
    smaller group) get one more. Within a group the rows with the smallest
    ``md5('seed:id')`` are taken. No group is sorted: counts per hash prefix show the one
    prefix in which the limit falls, and only rows with that prefix are ranked.
    """
    digits = len(f"{buckets - 1:x}")
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_column).cast("string")).cast("binary"))
    bucket = F.conv(F.substring(digest, 1, digits), 16, 10).cast("int")
    keyed = df.select(F.col(group).alias("_group"), F.col(id_column).alias("_id"), digest.alias("_digest"), bucket.alias("_bucket"))
    histogram = keyed.groupBy("_group", "_bucket").agg(F.count(F.lit(1)).alias("_size"))
    sizes = histogram.groupBy("_group").agg(F.sum("_size").alias("_rows"))
    everything = Window.partitionBy()
    quota = F.ceil(F.lit(share) * F.sum("_rows").over(everything)) * F.col("_rows") / F.sum("_rows").over(everything)
    quotas = sizes.select("_group", quota.alias("_quota"), F.floor(quota).alias("_whole"))
    missing = F.round(F.sum("_quota").over(everything)) - F.sum("_whole").over(everything)
    place = F.row_number().over(Window.orderBy(F.desc(F.round(F.col("_quota") - F.col("_whole"), 9)), "_group"))
    takes = quotas.select("_group", (F.col("_whole") + (place <= missing).cast("bigint")).alias("_take"))
    so_far = F.sum("_size").over(Window.partitionBy("_group").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0))
    edges = (
        histogram.withColumn("_upto", so_far)
        .join(takes, "_group")
        .filter((F.col("_upto") >= F.col("_take")) & (F.col("_upto") - F.col("_size") < F.col("_take")))
        .select("_group", "_bucket", (F.col("_take") - F.col("_upto") + F.col("_size")).alias("_nth"))
    )
    edge_rows = small_join(keyed, edges, ["_group", "_bucket"], ["_id"])
    ranked = edge_rows.withColumn(
        "_place", F.row_number().over(Window.partitionBy("_group", "_bucket").orderBy("_digest", "_id"))
    )
    limits = ranked.filter(F.col("_place") == F.col("_nth")).select(
        F.col("_group").alias(group), F.struct("_digest", "_id").alias("_limit")
    )
    marked = small_join(df, limits, [group], [id_column], "left")
    flag = F.coalesce(F.struct(digest.alias("_digest"), F.col(id_column).alias("_id")) <= F.col("_limit"), F.lit(False))
    return marked.withColumn(name, flag).drop("_limit")
