"""Publishing by versions: a reader sees all of a publish or nothing of it.

``<target>/v=<batch>/dt=<day>/`` holds what one publish wrote and is never changed afterwards.
``<target>/_manifest/seq=<n>/`` holds one file for each publish, with a row for each day it replaced;
the appearance of that file is the publish. Readers take the newest row of each day, so days
that one publish replaces change together, a reader that has begun goes on with the files it
knows, and a publish that fails before its last step has changed nothing.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landfall.operators.guards import GuardError
from landfall.operators.latest import latest_per_key
from landfall.sources.partitions import folder_days
from landfall.sources.publish import check_empty

MANIFEST = "dataset string, batch_id string, dt string, row_count bigint, folder string"


@dataclass(frozen=True)
class Published:
    """What a publish did: rows by day, and the measures taken while the rows were written."""

    batch_id: str
    seq: int
    days: dict[str, int]
    measures: dict = field(default_factory=dict)

    @property
    def rows(self) -> int:
        return sum(self.days.values())


def new_batch_id(dt: str) -> str:
    return f"{dt}-{uuid.uuid4().hex[:12]}"


def read_manifest(spark: SparkSession, target: str) -> DataFrame:
    """Every day of every publish; ``seq`` orders the publishes."""
    schema = T.StructType.fromDDL(f"{MANIFEST}, seq bigint")
    try:
        return spark.read.schema(schema).parquet(f"{target}/_manifest")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def current_days(spark: SparkSession, target: str) -> DataFrame:
    """The manifest row in force for each day."""
    return latest_per_key(read_manifest(spark, target), ["dt"], ["seq", "batch_id"])


def read_published(spark: SparkSession, target: str, schema: T.StructType, days: list[str] | None = None) -> DataFrame:
    """The rows in force, of all days or of some.

    Folders are chosen when this is called; the driver holds one text for each day.
    """
    found = current_days(spark, target)
    rows = (found if days is None else found.where(F.col("dt").isin(days))).select("folder").collect()
    return _read(spark, target, schema, [r.folder for r in rows])


def read_version(spark: SparkSession, target: str, schema: T.StructType, batch_id: str) -> DataFrame:
    """What one publish wrote, whether it is in force or not."""
    return _read(spark, target, schema, [f"v={batch_id}"])


def _read(spark, target, schema, folders) -> DataFrame:
    """The given folders; those from before the manifest lie one level higher and are read apart."""
    if not folders:
        return spark.createDataFrame([], schema)
    levels = [[f for f in folders if f.startswith("v=") is versioned] for versioned in (True, False)]
    reader = spark.read.schema(schema).option("basePath", target)
    read = [reader.parquet(*[f"{target}/{f}" for f in level]).select(*schema.names) for level in levels if level]
    return read[0] if len(read) == 1 else read[0].unionByName(read[1])


def publish_version(
    df: DataFrame, target: str, dataset: str, batch_id: str, dt: str | None = None, checks: tuple[Column, ...] = (),
    expected_rows: int | None = None, empty_policy: str = "FAIL", measures: dict[str, Column] | None = None,
) -> Published:
    """Write ``df`` (with its ``dt`` column) as a new version, read it back, and put its days in force in one step.

    ``checks`` must hold on every row. They, the row count and ``measures`` (aggregates without a
    distinct) are observed while the rows are written, so they cost no further pass. The read-back counts
    the rows of each day from the files. With ``dt`` the publish is of that one day, also if it is empty; its rows are
    written by the tasks that have them, since only rows of several days must be brought together by day. The day is then
    a constant of the write, so that no task sorts its rows by it; a row of another day is counted, and the publish refused.
    """
    spark, path = df.sparkSession, f"{target}/v={batch_id}"
    facts = Observation()
    grouped = df.hint("rebalance", F.col("dt")) if dt is None else df
    watched = grouped.observe(
        facts,
        F.count(F.lit(1)).alias("_rows"),
        *([F.count_if(~F.col("dt").eqNullSafe(dt)).alias("_strays")] if dt is not None else []),
        *[F.count_if(~F.coalesce(c, F.lit(False))).alias(f"_violations_{i}") for i, c in enumerate(checks)],
        *[c.alias(n) for n, c in (measures or {}).items()],
    )
    if dt is not None:
        watched = watched.withColumn("dt", F.lit(dt))
    watched.write.mode("errorifexists").option("compression", "zstd").partitionBy("dt").parquet(path)
    seen = facts.get
    broken = {k: v for k, v in seen.items() if k.startswith("_violations_") and v}
    if broken:
        raise GuardError("CHECK_FAILED", broken)
    check_empty(seen["_rows"], empty_policy)
    days = {r.dt: r.n for r in _read(spark, target, df.schema, [f"v={batch_id}"]).groupBy("dt").agg(F.count("*").alias("n")).collect()}
    if dt is not None and not days:
        spark.createDataFrame([], df.drop("dt").schema).write.parquet(f"{path}/dt={dt}")
        days = {dt: 0}
    stored = sum(days.values())
    strays = seen.get("_strays", 0)
    if stored != seen["_rows"] or (expected_rows is not None and stored != expected_rows) or (dt is not None and set(days) != {dt}) or strays:
        raise GuardError("ROW_COUNT_MISMATCH", {"stored": stored, "written": seen["_rows"], "expected": expected_rows, "days": len(days), "strays": strays})
    seq = commit_version(spark, target, dataset, batch_id, days)
    return Published(batch_id, seq, days, {n: seen[n] for n in (measures or {})})


def commit_version(spark: SparkSession, target: str, dataset: str, batch_id: str, days: dict[str, int]) -> int:
    """Append the manifest file that puts the days of a written version in force; returns its number.

    A number taken by another publish meanwhile is left to it. Days that lie in the target from before
    it had a manifest are taken over by the first one.
    """
    last = read_manifest(spark, target).agg(F.max("seq")).first()[0]
    rows = [(dataset, batch_id, d, n, f"v={batch_id}/dt={d}") for d, n in sorted(days.items())]
    if last is None:
        plain = [r.dt for r in folder_days(spark, target).collect() if r.dt not in days]
        rows += [(dataset, "", d, None, f"dt={d}") for d in sorted(plain)]
    entry, seq = spark.createDataFrame(rows, MANIFEST).coalesce(1), (last or 0) + 1
    while True:
        try:
            entry.write.mode("errorifexists").parquet(f"{target}/_manifest/seq={seq}")
            return seq
        except AnalysisException as taken:
            if taken.getCondition() != "PATH_ALREADY_EXISTS":
                raise
            seq += 1
