"""Catalog tables, partition registration and the bounded legacy read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landfall.sources.partitions import catalog_days


def _quote(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")


def ensure_table(
    spark: SparkSession, name: str, fields, location: str, partition: str | None = "dt", comment: str = ""
) -> None:
    """Create a columnar detail table with column comments if it does not exist."""
    columns = [f"`{f.name}` {f.type} COMMENT '{_quote(f.comment)}'" for f in fields]
    if partition:
        columns.append(f"`{partition}` STRING COMMENT 'partition'")
    by = f" PARTITIONED BY (`{partition}`)" if partition else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({', '.join(columns)}) USING parquet{by}"
        f" COMMENT '{_quote(comment)}' LOCATION '{_quote(location)}'"
    )


def register_partition(spark: SparkSession, table: str, dt: str, location: str) -> None:
    """Point one partition at an exact folder; repeating it changes nothing."""
    spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS PARTITION (dt='{_quote(dt)}') LOCATION '{_quote(location)}'")


def register_partitions(spark: SparkSession, table: str, locations: dict[str, str]) -> None:
    """Point several partitions at their folders in one statement; known ones stay as they are."""
    if locations:
        parts = " ".join(f"PARTITION (dt='{_quote(d)}') LOCATION '{_quote(p)}'" for d, p in sorted(locations.items()))
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {parts}")


def move_partitions(spark: SparkSession, table: str, locations: dict[str, str]) -> None:
    """Point partitions at new folders, adding those the table does not have yet.

    Files are not touched: a query that has begun reads the old folders to its end.
    """
    known = {r.dt for r in catalog_days(spark, table).collect()}
    register_partitions(spark, table, {d: p for d, p in locations.items() if d not in known})
    for d in sorted(known & set(locations)):
        spark.sql(f"ALTER TABLE {table} PARTITION (dt='{_quote(d)}') SET LOCATION '{_quote(locations[d])}'")


def read_legacy(
    spark: SparkSession, source, table: str | None, predicates: list[str], columns: list[str], properties=None
) -> DataFrame:
    """Bounded read of an older copy. ``source`` is a JDBC URL or a DataFrame standing in for it.

    With JDBC each predicate is one partition of the read, so they must be disjoint and should
    follow an index. An unbounded read is refused.
    """
    if not predicates:
        raise ValueError("give at least one predicate; unbounded legacy reads are refused")
    if isinstance(source, DataFrame):
        return source.where(" OR ".join(f"({p})" for p in predicates)).select(*columns)
    reader = spark.read.jdbc(source, table, predicates=predicates, properties=properties or {})
    return reader.select(*[F.col(c) for c in columns])
