"""Publishing. Every write is staged by Spark's committer, so readers never see half a job."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landfall.session import Scratch
from landfall.operators.guards import GuardError


def _write_partitions(df: DataFrame, path: str, partition: str) -> None:
    (
        df.write.option("partitionOverwriteMode", "dynamic")
        .mode("overwrite")
        .partitionBy(partition)
        .parquet(path)
    )


def publish_partition(df: DataFrame, path: str, dt: str, empty_policy: str = "FAIL", rows: int | None = None) -> None:
    """Replace exactly one partition.

    Dynamic mode replaces only partitions that receive rows, so a valid empty day is written
    explicitly as an empty partition; otherwise an old one would survive.
    ``rows`` is the already known row count of ``df``, if a guard has produced it; otherwise the
    batch is written to a scratch table first, so it is evaluated once.
    """
    if rows is None:
        with Scratch(df.sparkSession) as scratch:
            staged = scratch.materialize(df, "publish")
            return publish_partition(staged, path, dt, empty_policy, staged.count())
    if rows == 0:
        check_empty(0, empty_policy)
        df.sparkSession.createDataFrame([], df.schema).write.mode("overwrite").parquet(f"{path}/dt={dt}")
        return
    _write_partitions(df.withColumn("dt", F.lit(dt)), path, "dt")


def publish_touched(df: DataFrame, path: str, partition: str = "dt") -> None:
    """Replace exactly the partitions present in the batch; days that vanished keep their old rows.

    The rebalance hint groups rows by day to avoid one small file per task and day, and lets
    AQE split a day that holds most of the batch.
    """
    _write_partitions(df.hint("rebalance", F.col(partition)), path, partition)


def untouched_days(df: DataFrame, window: DataFrame, partition: str = "dt") -> DataFrame:
    """Days of the pull window for which the batch holds no row."""
    return window.select(partition).join(df.select(partition).distinct(), partition, "left_anti")


def publish_latest(df: DataFrame, path: str) -> None:
    """Replace the whole table. The batch is materialized first, so it may be derived from the target."""
    with Scratch(df.sparkSession) as scratch:
        scratch.materialize(df, "latest").write.mode("overwrite").parquet(path)


def check_empty(rows: int, empty_policy: str) -> None:
    """Zero rows fail unless the dataset declares that an empty day is valid."""
    if rows == 0 and empty_policy != "ALLOW":
        raise GuardError("EMPTY_BATCH", {"rows": 0})


def publish_batch(
    df: DataFrame, path: str, dt: str, checks=(), manifest: str | None = None, dataset: str = "", batch_id: str = "",
    empty_policy: str = "FAIL", expected_rows: int | None = None,
) -> int:
    """All or nothing: stage, read the staged copy back and check it, promote, then record it.

    ``checks`` are conditions that must hold on every staged row. The manifest row is appended
    last, so a batch without one was never published.
    """
    with Scratch(df.sparkSession) as scratch:
        staged = scratch.materialize(df, "publish")
        facts = staged.agg(
            F.count("*").alias("rows"),
            *[F.count_if(~F.coalesce(c, F.lit(False))).alias(f"violations_{i}") for i, c in enumerate(checks)],
        ).first()
        rows = facts["rows"]
        broken = {k: v for k, v in facts.asDict().items() if k != "rows" and v}
        if broken:
            raise GuardError("CHECK_FAILED", broken)
        if expected_rows is not None and rows != expected_rows:
            raise GuardError("ROW_COUNT_MISMATCH", {"rows": rows, "expected": expected_rows})
        check_empty(rows, empty_policy)
        publish_partition(staged, path, dt, empty_policy, rows)
    if manifest:
        row = [(dataset, dt, batch_id, rows)]
        df.sparkSession.createDataFrame(row, "dataset string, dt string, batch_id string, row_count bigint").coalesce(
            1
        ).write.mode("append").parquet(manifest)
    return rows
