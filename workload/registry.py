"""Register of the checked queries: each has a Spark job and, where SQL can say it, a DuckDB text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(job: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} exists")
        QUERIES[name] = job
        if sql is not None:
            ORACLES[name] = sql
        return job

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A stored table, read as it is stored."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
