"""Choosing partitions: touched by a batch, or the most recent ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def touched_partitions(df: DataFrame, day: Column, where: Column | None = None) -> DataFrame:
    """Distinct days present in the batch."""
    return (df if where is None else df.where(where)).select(day.alias("dt")).distinct()


def touched_target(target: DataFrame, touched: DataFrame) -> DataFrame:
    """Rows of the target in the touched partitions.

    The days become a literal partition filter, so other folders are not even listed for reading.
    What the driver holds is one text for each distinct day of the batch.
    """
    days = [r[0] for r in touched.select("dt").distinct().collect()]
    return target.where(F.col("dt").isin(days))


def last_partitions(df: DataFrame, dt: str, n: int = 7) -> DataFrame:
    """The n newest partitions up to a date.

    ``df`` may be the rows, whose days are then scanned, or just the days (``catalog_days``, ``folder_days``).
    """
    return df.where(F.col("dt") <= dt).select("dt").distinct().orderBy(F.desc("dt")).limit(n)


def recent_partitions(df: DataFrame, dt: str, n: int = 7, days: DataFrame | None = None) -> DataFrame:
    """Rows of the n newest partitions up to a date.

    With ``days``, the days known from metadata, their n newest become a literal partition filter, so
    no older file is opened even to learn its day. Without it the days are those of the rows.
    """
    newest = last_partitions(df if days is None else days, dt, n)
    return df.where(F.col("dt").isin([r.dt for r in newest.collect()]))


def _single(df: DataFrame) -> DataFrame:
    """The only row of a frame; the job fails if there is none or another."""
    one = df.agg(F.count("*").alias("n"), F.first(F.struct(*[F.col(c) for c in df.columns])).alias("row"))
    broken = F.raise_error(F.concat(F.lit("one row expected, got "), F.col("n").cast("string")))
    return one.select(F.when(F.col("n") == 1, F.col("row")).otherwise(broken).alias("row")).select("row.*")


def combine_one_row(a: DataFrame, b: DataFrame) -> DataFrame:
    """Put two one-row aggregates side by side; other frames are refused when the plan runs."""
    return _single(a).crossJoin(F.broadcast(_single(b)))
