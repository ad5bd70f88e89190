"""Dated JSON envelopes: scan, select, write, and one-time staging as Parquet."""

from __future__ import annotations

import pyarrow as pa
from pyspark import TaskContext
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landfall.functions import all_equal, differs
from landfall.session import Scratch
from landfall.spec import DatasetSpec

CORRUPT = "_corrupt"
JSON_FILES = "{*.json,*.json.gz}"  # what counts as an envelope file
ENVELOPE_BYTES = 8 << 20  # of records as Arrow holds them
ENVELOPES_PER_FILE = 16  # a compressed file is read by one task, so it holds about what one task should read
PART_RECORDS = 1 << 18  # of one envelope in a part
MOST_PARTS = 4096
ENVELOPE_COLUMNS = ("source", "dataset", "biz_date", "record_count", "sync_time", "shard_no", "batch_count")


def envelope_schema(record_schema: T.StructType) -> T.StructType:
    """Envelope fields, the declared record array, the corrupt-text column and the partition.

    ``dt`` is declared as text; left to inference it would become a DATE.
    """
    head = T.StructType.fromDDL(
        "source STRING, dataset STRING, biz_date STRING, record_count BIGINT, sync_time STRING, shard_no BIGINT,"
        " batch_count BIGINT"
    )
    return (
        head.add("data", T.ArrayType(record_schema)).add(CORRUPT, T.StringType()).add("dt", T.StringType())
    )


def read_envelopes(spark: SparkSession, root: str, record_schema: T.StructType, dt: str | None = None) -> DataFrame:
    """Scan ``root/dt=…/*.json`` and ``*.json.gz`` with a declared schema; other files are not read.

    One date is read from its own folder, so no other is listed; a date without a folder is empty.
    """
    reader = (
        spark.read.schema(envelope_schema(record_schema))
        .option("pathGlobFilter", JSON_FILES)
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("basePath", root)
    )
    if dt is None:
        return reader.json(root)
    try:
        return batch(reader.json(f"{root}/dt={dt}"), dt)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], envelope_schema(record_schema))


def batch(df: DataFrame, dt: str) -> DataFrame:
    """One batch; the predicate becomes a partition filter."""
    return df.where(F.col("dt") == dt)


def metadata_ok(spec: DatasetSpec, dt: str) -> Column:
    """Source, dataset and date all match the batch."""
    return ~(differs("source", spec.source) | differs("dataset", spec.name) | differs("biz_date", dt))


def matching_envelopes(df: DataFrame, spec: DatasetSpec, dt: str) -> DataFrame:
    """Only the envelopes (or staged records) that belong to this source, dataset and date."""
    return batch(df, dt).where(all_equal({"source": spec.source, "dataset": spec.name, "biz_date": dt}))


def write_envelopes(
    df: DataFrame, root: str, spec: DatasetSpec, dt: str, sync_time: str, records_per_envelope: int = 5000,
    rows: int | None = None, bytes_per_envelope: int = ENVELOPE_BYTES,
) -> None:
    """Wrap records in envelopes of bounded size (``wrap_records``) and write them under ``dt=``."""
    write_json(wrap_records(df, spec, dt, sync_time, records_per_envelope, rows, bytes_per_envelope), root, dt)


def wrap_records(
    df: DataFrame, spec: DatasetSpec, dt: str, sync_time: str, records_per_envelope: int = 5000, rows: int | None = None,
    bytes_per_envelope: int = ENVELOPE_BYTES,
) -> DataFrame:
    """Envelopes of at most ``records_per_envelope`` records and about ``bytes_per_envelope`` bytes of them in memory.

    Every task cuts its own rows, so no key can make a group large and no row holds a whole batch. Arrow batches are
    halved until they fit and small ones put together, so a task holds one envelope and one Arrow batch; a
    record larger than the bound is an envelope of its own. A known row count is stated in every envelope as the size of the
    whole batch, by which a reader notices a lost one; a batch that fits one envelope becomes exactly one,
    for which its few rows are brought together.
    """
    if rows is not None and rows <= records_per_envelope:
        df = df.repartition(1)
    head = [spec.source, spec.name, dt, sync_time]

    def pieces(records):
        """Consecutive parts of a record batch that each fit one envelope."""
        todo = [records]
        while todo:
            part = todo.pop()
            n = part.num_rows
            if n > 1 and (n > records_per_envelope or part.nbytes > bytes_per_envelope):
                half = records_per_envelope if n > records_per_envelope else n // 2
                todo += [part.slice(half), part.slice(0, half)]
            elif n:
                yield part

    def wrap(batches):
        task, chunk = TaskContext.get().partitionId(), 0
        held, held_rows, held_bytes = [], 0, 0

        def envelope():
            nonlocal chunk, held, held_rows, held_bytes
            records = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            lists = pa.ListArray.from_arrays(pa.array([0, held_rows], pa.int32()), records.to_struct_array())
            numbers = [pa.array([v], pa.int64()) for v in ((task << 33) | chunk, rows, held_rows)]
            chunk, held, held_rows, held_bytes = chunk + 1, [], 0, 0
            return pa.RecordBatch.from_arrays(
                [*(pa.array([value]) for value in head), *numbers, lists],
                ["source", "dataset", "biz_date", "sync_time", "shard_no", "batch_count", "record_count", "data"],
            )

        for records in batches:
            for part in pieces(records):
                full = held_rows + part.num_rows > records_per_envelope or held_bytes + part.nbytes > bytes_per_envelope
                if held and full:
                    yield envelope()
                held.append(part)
                held_rows, held_bytes = held_rows + part.num_rows, held_bytes + part.nbytes
        if held:
            yield envelope()

    schema = T.StructType.fromDDL(
        "source STRING, dataset STRING, biz_date STRING, sync_time STRING, shard_no BIGINT, batch_count BIGINT,"
        " record_count BIGINT"
    ).add("data", T.ArrayType(df.schema))
    return df.mapInArrow(wrap, schema)


def write_empty_envelope(spark: SparkSession, root: str, spec: DatasetSpec, dt: str, sync_time: str) -> None:
    """Land a valid empty day: one envelope declaring zero records."""
    row = [(spec.source, spec.name, dt, sync_time, 0, 0, 0)]
    head = "source STRING, dataset STRING, biz_date STRING, sync_time STRING, shard_no BIGINT, batch_count BIGINT, record_count BIGINT"
    empty = F.array().cast(T.ArrayType(spec.record_schema))
    write_json(spark.createDataFrame(row, head).coalesce(1).withColumn("data", empty), root, dt)


def write_json(df: DataFrame, root: str, dt: str) -> None:
    """Compressed files of a bounded number of envelopes; dynamic overwrite keeps the old batch until the new one is committed.

    Field names recur in every record, so a file takes about a seventh of its text even at the fastest level.
    """
    writer = df.withColumn("dt", F.lit(dt)).write.option("partitionOverwriteMode", "dynamic").mode("overwrite")
    writer = writer.option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED")
    writer = writer.option("maxRecordsPerFile", ENVELOPES_PER_FILE)
    writer.partitionBy("dt").json(root)


def batch_parts(envelopes: DataFrame) -> int:
    """Buckets of a batch staged in parts: about one for each file, so what a bucket holds does not grow with the batch."""
    spark = envelopes.sparkSession
    return min(max(int(spark.conf.get("spark.sql.shuffle.partitions")), len(envelopes.inputFiles())), MOST_PARTS)


def stage_batch(envelopes: DataFrame, scratch: Scratch, parts: int = 0) -> DataFrame:
    """Parse a batch once: one Parquet row per record, plus one row for an envelope without records.

    Guards, the detail job and the quality report all read this table with column pruning
    instead of parsing JSON again. ``pos`` is null exactly on the row of an empty envelope, so
    ``coalesce(pos, 0) = 0`` marks one row per envelope.

    With ``parts`` the table is bucketed into as many by ``part``, the file of a record (and the block of ``PART_RECORDS`` in it,
    should an envelope be larger), which costs no shuffle: what is found for a record can be sent to where it lies.
    """
    numbered = envelopes.select(
        *[F.col(c) for c in ENVELOPE_COLUMNS if c != "shard_no" and c in envelopes.columns],
        F.coalesce("shard_no", F.monotonically_increasing_id()).alias("shard_no"),
        F.col(CORRUPT).isNotNull().alias("corrupt"),
        "dt",
        *([F.xxhash64(F.input_file_name()).alias("file")] if parts else []),
        "data",
    )
    exploded = numbered.select(
        *[c for c in numbered.columns if c != "data"], F.posexplode_outer("data").alias("pos", "rec")
    )
    if not parts:
        return scratch.materialize(exploded, "batch")
    part = F.xxhash64("file", F.call_function("div", F.col("pos"), F.lit(PART_RECORDS)))
    return scratch.materialize_in_parts(exploded.withColumn("part", part).drop("file"), "batch", "part", parts)


def envelope_summary(df: DataFrame, dt: str) -> DataFrame:
    """One row about the envelopes of a date, matching or not."""
    return batch(df, dt).agg(
        F.count("*").alias("envelope_row_count"),
        F.min("source").alias("source"),
        F.min("dataset").alias("dataset"),
        F.min("biz_date").alias("envelope_biz_date"),
        F.coalesce(F.sum("record_count"), F.lit(0)).alias("declared_record_count"),
        F.coalesce(F.sum(F.array_size("data")), F.lit(0)).cast("bigint").alias("data_array_count"),
        F.min("sync_time").alias("earliest_sync_time"),
        F.max("sync_time").alias("latest_sync_time"),
    )
