"""Measures and their reshaping."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landfall.functions import as_col, is_blank, rate_pct


def count_where(condition: Column) -> Column:
    """Rows satisfying the condition; 0 over no rows."""
    return F.count_if(F.coalesce(condition, F.lit(False)))


def sum0(c) -> Column:
    """Sum with null and no rows as 0."""
    return F.coalesce(F.sum(as_col(c)), F.lit(0)).cast("bigint")


def size0(c) -> Column:
    """Total array length, null arrays counting 0."""
    return sum0(F.array_size(as_col(c)))


def time_bounds(c: str, name: str | None = None) -> list[Column]:
    name = name or c
    return [F.min(c).alias(f"earliest_{name}"), F.max(c).alias(f"latest_{name}")]


def duplicate_rows(key) -> Column:
    """Rows beyond the first of each key."""
    return F.count("*") - F.countDistinct(as_col(key))


def duplicate_groups(df: DataFrame, keys: dict[str, Column]) -> DataFrame:
    """Groups holding more than one row."""
    return (
        df.groupBy(*[c.alias(n) for n, c in keys.items()])
        .agg(F.count("*").alias("group_count"))
        .where(F.col("group_count") > 1)
    )


def duplicate_excess(groups: DataFrame) -> DataFrame:
    """Number of duplicate groups and of rows beyond the first of each."""
    return groups.agg(
        F.count("*").alias("duplicate_group_count"),
        F.coalesce(F.sum(F.col("group_count") - 1), F.lit(0)).alias("duplicate_excess_row_count"),
    )


def grain_duplicates(df: DataFrame, keys: dict[str, Column]) -> DataFrame:
    return duplicate_excess(duplicate_groups(df, keys))


def distribution(df: DataFrame, cols: list[str], parent: str, parent_name: str = "parent_count") -> DataFrame:
    """Rows and distinct parents per combination.

    Grouped first by the parent as well, so a dominant combination is counted in parallel.
    """
    return df.groupBy(*cols).agg(F.count("*").alias("row_count"), F.countDistinct(parent).alias(parent_name))


def coverage(df: DataFrame, cols: list[str], rate_of: list[str] | None = None) -> DataFrame:
    """Unfilled count per enrichment column, with its rate for the columns in ``rate_of``."""
    counts = df.agg(F.count("*").alias("row_count"), *[count_where(is_blank(c)).alias(f"empty_{c}_count") for c in cols])
    return counts.select(
        "*", *[rate_pct(f"empty_{c}_count", "row_count").alias(f"empty_{c}_rate_pct") for c in (rate_of or [])]
    )


def partition_trend(df: DataFrame, measures: dict[str, Column]) -> DataFrame:
    """The same measures per partition."""
    return df.groupBy("dt").agg(*[c.alias(n) for n, c in measures.items()])


def metrics_long(row: DataFrame, names: dict[str, str]) -> DataFrame:
    """One wide row to ``(metric_name, metric_value)`` text rows, in one pass.

    ``names`` maps the metric name to the column.
    """
    pairs = [x for n, c in names.items() for x in (F.lit(n), F.col(c).cast("string"))]
    return row.select(F.stack(F.lit(len(names)), *pairs).alias("metric_name", "metric_value"))


def metrics_wide(long: DataFrame, names: list[str]) -> DataFrame:
    """Long metrics back to one row."""
    return long.agg(*[F.max(F.when(F.col("metric_name") == n, F.col("metric_value"))).alias(n) for n in names])
