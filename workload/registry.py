"""Name, Spark query and SQL counterpart, kept next to each other."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query; ``sql`` is omitted where SQL cannot say it."""

    def wrap(fn):
        if name in QUERIES:
            raise ValueError(f"{name} registered twice")
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn

    return wrap


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def columns_query(name: str, source: str, key: str, columns: dict, base: str | None = None, prepare=None):
    """Register a projection: ``columns`` maps an alias to ``(column function, SQL expression)``.

    ``base`` is a SQL subquery matching ``prepare``, which derives the input from the table.
    """

    def run(spark, sf_dir):
        df = table(spark, sf_dir, source)
        df = prepare(df) if prepare else df
        return df.select(key, *[make().alias(alias) for alias, (make, _) in columns.items()])

    parts = ", ".join(f"{expr} AS {alias}" for alias, (_, expr) in columns.items())
    query(name, f"SELECT {key}, {parts} FROM {base or source}")(run)
