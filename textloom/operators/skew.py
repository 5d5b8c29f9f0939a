"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.session import cut_lineage

HOT_KEYS = 1000
SALTS = 32
# Tables up to this size, as text, are broadcast after measuring them, whatever the number of their rows up to the second limit.
MOST_BYTES = 64 << 20
MOST_BROADCAST = 1_000_000


def _spread(by: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*by), F.lit(buckets)).cast("int")


def lookup_join(
    fact: DataFrame,
    dim: DataFrame,
    on: Sequence[str],
    weight: str | None,
    spread_by: Sequence[str],
    how: str = "inner",
    hot_keys: int = HOT_KEYS,
) -> DataFrame:
    """Join ``fact`` to ``dim``, which has one row per key.

    ``weight`` is a column of ``dim``: how many fact rows the key has. Without one the keys of
    ``fact`` are counted, which is needed when frequent keys may be missing from ``dim``. The
    ``hot_keys`` heaviest keys are broadcast, a fixed number; every other key has less than
    1/``hot_keys`` of the rows. Fact rows with a hot key are spread by the hash of
    ``spread_by`` and pass the shuffle join without a partner. ``weight`` is not part of the result.
    """
    on = list(on)
    extra = [c for c in dim.columns if c not in on and c != weight]
    entry = F.struct(F.lit(True).alias("_"), *extra).alias("_dim")
    if weight is None:
        packed = dim.select(*on, entry)
        counts = fact.groupBy(*on).agg(F.count(F.lit(1)).alias("_weight"))
        heaviest = counts.orderBy(F.desc("_weight"), *on).limit(hot_keys)
        found = packed.join(F.broadcast(heaviest.select(*on)), on)
        hot = heaviest.join(F.broadcast(found), on, "left").select(*on, F.struct("_dim").alias("_hot"))
    else:
        packed = dim.select(*on, F.col(weight).alias("_weight"), entry)
        heaviest = packed.orderBy(F.desc("_weight"), *on).limit(hot_keys)
        hot = heaviest.select(*on, F.struct("_dim").alias("_hot"))
    cold = packed.select(*on, F.lit(0).alias("_salt"), F.col("_dim").alias("_cold"))
    # A missing key has no partner either, so such rows are spread too.
    keyed = reduce(and_, [F.col(c).isNotNull() for c in on])
    probed = fact.join(F.broadcast(hot), on, "left").withColumn(
        "_salt", F.when(F.col("_hot").isNull() & keyed, 0).otherwise(_spread(spread_by, 1 << 20) + 1)
    )
    joined = probed.join(cold, [*on, "_salt"], "left").withColumn("_dim", F.coalesce("_hot._dim", "_cold"))
    if how == "inner":
        joined = joined.filter(F.col("_dim").isNotNull())
    elif how != "left":
        raise ValueError("how is 'inner' or 'left'")
    return joined.select(*fact.columns, *[F.col("_dim")[c].alias(c) for c in extra])


def salted_join(
    fact: DataFrame,
    dim: DataFrame,
    on: Sequence[str],
    spread_by: Sequence[str],
    how: str = "inner",
    salts: int = SALTS,
) -> DataFrame:
    """Join ``fact`` to a ``dim`` that is far smaller but of unknown size.

    Every key of ``dim`` is repeated once per salt, and each fact row looks under one salt
    only, so a hot key is shared by ``salts`` tasks. When ``dim`` turns out small, adaptive
    execution sees its real size and broadcasts it instead.
    """
    fact = fact.withColumn("_salt", _spread(spread_by, salts))
    dim = dim.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return fact.join(dim, [*on, "_salt"], how).drop("_salt")


def small_join(
    fact: DataFrame,
    dim: DataFrame,
    on: Sequence[str],
    spread_by: Sequence[str],
    how: str = "inner",
    most: int = MOST_BROADCAST,
    most_bytes: int = MOST_BYTES,
    stored: bool = False,
    weight: str | None = None,
) -> DataFrame:
    """Join a large ``fact`` to a ``dim`` that should be small.

    ``dim`` is worked out once (``stored`` says that it has been written already) and measured in one pass. Up to ``most`` rows and ``most_bytes`` bytes
    as text it is broadcast and ``fact`` stays where it is; beyond that both are shuffled with salted keys. ``fact`` is
    neither counted nor sampled. ``weight`` is a column of a ``dim`` with one row per key that says how frequent the key is, about; it is not
    part of the result. With it only the heaviest keys are spread, and ``dim`` is not repeated per salt.
    """
    dim = dim if stored else cut_lineage(dim)
    sent = dim if weight is None else dim.drop(weight)
    if fits(sent, most, most_bytes):
        return fact.join(F.broadcast(sent), list(on), how)
    if weight is not None:
        return lookup_join(fact, dim, on, weight, spread_by, how)
    return salted_join(fact, dim, on, spread_by, how)


def fits(table: DataFrame, most: int, most_bytes: int) -> bool:
    """Whether a table has at most so many rows and bytes, written as text; long strings, arrays and maps count with what they hold."""
    size = F.octet_length(F.to_json(F.struct(*[F.col(f"`{c}`") for c in table.columns])))
    rows, held = table.agg(F.count(F.lit(1)), F.coalesce(F.sum(size), F.lit(0))).first()
    return rows <= most and held <= most_bytes


def packed_rows(df: DataFrame, columns: Sequence[str], limit: int = 10_000) -> Column:
    """A small table as one array column, sorted by ``columns``; fails above ``limit`` rows.

    Two stages keep the failing case cheap: every task passes on ``limit`` + 1 rows at most.
    """
    return packed_table(df, columns, limit).scalar()


def packed_table(df: DataFrame, columns: Sequence[str], limit: int = 10_000, name: str = "rows") -> DataFrame:
    """A small table as one row with one array column, sorted by ``columns``; fails above ``limit`` rows."""
    few = df.select(*columns).limit(limit + 1)
    rows = F.sort_array(F.collect_list(F.struct(*columns)))
    message = F.lit(f"more than {limit} rows where a small table is needed")
    return few.agg(F.when(F.count(F.lit(1)) > limit, F.raise_error(message)).otherwise(rows).alias(name))


class Lookup(NamedTuple):
    """A one-row table with buckets of entries (``key`` and values): a key is looked for in one short bucket, inside the row.

    Subqueries may not stand in array functions, so the table is attached as a column; the optimizer moves it into the
    projection that uses it once, where it is one shared object, not a part of every row.
    """

    table: Column
    buckets: int
    name: str

    def attach(self, df: DataFrame) -> DataFrame:
        return df.withColumn(self.name, self.table)

    def get(self, key: Column) -> Column:
        """The entry of a key as a struct, NULL if there is none."""
        bucket = F.get(F.col(self.name), F.pmod(F.xxhash64(key), F.lit(self.buckets)).cast("int"))
        return F.get(F.filter(bucket, lambda e: e["key"] == key), F.lit(0))


def lookup_table(table: DataFrame, key: str, values: Sequence[str], most: int, name: str = "_lookup") -> Lookup:
    """A table of one row per key as a hash table inside expressions; fails above ``most`` rows."""
    buckets = 1 << max(0, most // 2).bit_length()
    place = F.pmod(F.xxhash64(key), F.lit(buckets)).alias("_bucket")
    entry = F.struct(F.col(key).alias("key"), *values)
    entries = table.limit(most + 1).select(place, entry.alias("_entry")).groupBy("_bucket").agg(F.collect_list("_entry").alias("_entries"))
    every = table.sparkSession.range(buckets).select(F.col("id").alias("_bucket")).join(entries, "_bucket", "left")
    ordered = F.transform(F.sort_array(F.collect_list(F.struct("_bucket", "_entries"))), lambda b: b["_entries"])
    message = F.lit(f"more than {most} rows where a small table is needed")
    packed = every.agg(F.when(F.sum(F.size("_entries")) > most, F.raise_error(message)).otherwise(ordered))
    return Lookup(packed.scalar(), buckets, name)
