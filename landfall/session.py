"""Where intermediate tables live.

Everything that has to outlive a task is written to the folder the cluster names in
``spark.checkpoint.dir``; a local folder is used only when no such folder is configured.
"""

from __future__ import annotations

import contextlib
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DROP_SHUFFLES = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}  # a step's shuffle files go when it ends
IN_PLACE = {"spark.sql.requireAllClusterKeysForCoPartition": "false"}  # rows bucketed by one of the join keys are not shuffled by all
OPEN_FILES = 32  # files of a bucketed table that a task keeps open; it sorts the rows of further buckets


def shared_dir(spark: SparkSession) -> str:
    """Root of the shared scratch folder of this session."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    return tempfile.gettempdir()


def new_dir(spark: SparkSession, name: str) -> str:
    """A fresh, never reused path under the shared folder."""
    return f"{shared_dir(spark)}/landfall/{name}-{uuid.uuid4().hex}"


@contextlib.contextmanager
def settings(spark: SparkSession, values: dict[str, str]):
    """Session settings for what runs inside; put back afterwards."""
    before = {name: spark.conf.get(name, None) for name in values}
    try:
        for name, value in values.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def byte_setting(spark: SparkSession, name: str) -> int:
    """A size setting in bytes; Spark keeps it as the text it was given, such as ``10485760b`` or ``256k``."""
    number, unit = re.fullmatch(r"(-?[0-9]+)([kmgtp]?)b?", spark.conf.get(name).strip().lower()).groups()
    return int(number) << 10 * " kmgtp".index(unit or " ")


class Scratch:
    """Intermediate tables of one job in a folder of its own, emptied when the job ends, also after a refusal.

    The folder is emptied by writing nothing over it, which any session can do; an empty marker of it stays.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.root, self.used = spark, new_dir(spark, "job"), 0
        self.tables: list[str] = []
        self.parts = 0  # buckets of the staged batch; 0 if it was not staged in parts

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_) -> None:
        for name in self.tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        if self.used:
            self.spark.createDataFrame([], "nothing string").coalesce(1).write.mode("overwrite").text(self.root)

    def path(self, name: str) -> str:
        """A fresh folder that goes with the job."""
        self.used += 1
        return f"{self.root}/{name}-{self.used}"

    def materialize(self, df: DataFrame, name: str) -> DataFrame:
        """Write once as Parquet and read back: cuts lineage and survives executor loss."""
        path = self.path(name)
        df.write.mode("errorifexists").option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def materialize_in_parts(self, df: DataFrame, name: str, key: str, parts: int) -> DataFrame:
        """Write once as a Parquet table bucketed by ``key``, so that a join by it need not shuffle these rows.

        A task keeps a file open for each bucket it meets, up to ``OPEN_FILES``, and does not sort its rows for them, so ``key``
        should have few values in one task. The table goes with the job.
        """
        path, table = self.path(name), f"landfall_{name}_{uuid.uuid4().hex}"
        writer = df.write.format("parquet").mode("errorifexists").option("path", path).option("compression", "zstd")
        self.tables.append(table)
        with settings(self.spark, {"spark.sql.maxConcurrentOutputFileWriters": str(OPEN_FILES)}):
            writer.bucketBy(parts, key).saveAsTable(table)
        return self.spark.table(table)

    def stored_bytes(self, name: str) -> int:
        """Size of the Parquet files written under this name."""
        files = self.spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(f"{self.root}/{name}-*")
        return files.agg(F.sum("length")).first()[0] or 0


def pin(report: DataFrame) -> DataFrame:
    """A report of a few rows as a frame that no longer depends on scratch tables."""
    return report.sparkSession.createDataFrame(report.collect(), report.schema)
