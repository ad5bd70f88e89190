"""Flat Parquet batches: exact declared types plus ``biz_date`` and ``sync_time``."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landfall.sources.envelopes import write_envelopes
from landfall.sources.footers import distinct_schemas, footer_census
from landfall.sources.partitions import files
from landfall.sources.schemas import SchemaError, StorageConflict, choose_storage, is_nested, schema_diff
from landfall.spec import DatasetSpec


def flat_schema(field_types: dict[str, str]) -> T.StructType:
    """The declared schema. It must name the two added columns and hold scalars only."""
    missing = {"biz_date", "sync_time"} - set(field_types)
    if missing:
        raise ValueError(f"field_types must also declare {sorted(missing)}")
    schema = T.StructType.fromDDL(", ".join(f"`{k}` {v}" for k, v in field_types.items()))
    if is_nested(schema):
        raise ValueError("a flat batch cannot hold nested columns")
    return schema


def write_flat(df: DataFrame, root: str, field_types: dict[str, str], dt: str, sync_time: str) -> None:
    """Snappy Parquet under ``dt=``. A nested input column is refused, never turned into text."""
    schema = flat_schema(field_types)
    stamped = df.withColumns({"biz_date": F.lit(dt), "sync_time": F.lit(sync_time)})
    if is_nested(stamped.select(*schema.names).schema):
        raise ValueError("nested input: write it as envelopes")
    out = stamped.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
    writer = out.withColumn("dt", F.lit(dt)).write.option("partitionOverwriteMode", "dynamic").mode("overwrite")
    writer.option("compression", "snappy").partitionBy("dt").parquet(root)


def read_flat(spark: SparkSession, root: str, field_types: dict[str, str], dt: str | None = None) -> DataFrame:
    """Scan flat batches; the schema of every file of the requested days must equal the declared one.

    Each footer is read by itself, in tasks: a merged schema would show a column that only some files have,
    and the others would return it as null. The driver sees distinct schemas, not files.
    """
    schema = flat_schema(field_types)
    path = f"{root}/dt={dt}" if dt else root
    census = footer_census(spark, path)
    for found, file, problem in distinct_schemas(census) if census is not None else ():
        if problems := [problem] if found is None else schema_diff(found, schema):
            raise SchemaError(f"{file}: {'; '.join(problems)}")
    reader = spark.read.schema(T.StructType([*schema.fields, T.StructField("dt", T.StringType())]))
    return reader.option("basePath", root).parquet(path)


# ---- one storage for each dataset -------------------------------------------------------

_FAMILY = {"parquet": "parquet", "nested-json": "json", "flat-json": "json"}


def recorded_storage(spark: SparkSession, root: str) -> str | None:
    """The storage that the first landing recorded beside the data."""
    try:
        row = spark.read.text(f"{root}/_storage").first()
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return row.value if row else None


def record_storage(spark: SparkSession, root: str, choice: str) -> None:
    """Note the storage of a dataset once; another one is refused, also if two first landings race."""
    if (known := recorded_storage(spark, root)) is None:
        try:
            spark.createDataFrame([(choice,)], "value string").coalesce(1).write.mode("errorifexists").text(f"{root}/_storage")
            return
        except AnalysisException as taken:
            if taken.getCondition() != "PATH_ALREADY_EXISTS":
                raise
            known = recorded_storage(spark, root)
    if known and _FAMILY[known] != _FAMILY[choice]:
        raise StorageConflict(f"{root} is {known}, the batch is to be {choice}")


def stored_formats(spark: SparkSession, root: str) -> set[str]:
    """Which of JSON and Parquet files lie anywhere under a root; only names are listed."""
    found = set()
    for name, suffix in (("json", "{json,json.gz}"), ("parquet", "parquet")):
        listing = files(spark, root, suffix)
        if listing is not None and not listing.isEmpty():
            found.add(name)
    return found


def decide_storage(
    spark: SparkSession, root: str, spec: DatasetSpec, schema: T.StructType, est_rows: int | None, small_rows: int = 100_000
) -> str:
    """The storage of a batch.

    A dataset has one, that of its ``spec``. Without one, its first landing decides from the schema and the
    estimated volume, and later ones follow what it recorded. Only a root without a record is listed, once; a batch
    that does not fit what the root holds is refused, since a reader of one format does not see days of the other.
    """
    known = recorded_storage(spark, root)
    present = {_FAMILY[known]} if known else stored_formats(spark, root)
    if spec.storage or known:
        choice = spec.storage or known
    elif len(present) == 1:
        choice = "parquet" if present == {"parquet"} else choose_storage(schema, 0)
    else:
        choice = choose_storage(schema, est_rows, small_rows)
    if choice == "flat-json" and is_nested(schema):
        choice = "nested-json"
    if present - {_FAMILY[choice]} or (choice == "parquet" and is_nested(schema)):
        raise StorageConflict(f"{root} holds {sorted(present)}, the batch is to be {choice}")
    return choice


def write_routed(
    df: DataFrame, root: str, spec: DatasetSpec, dt: str, sync_time: str, est_rows: int | None,
    small_rows: int = 100_000, rows: int | None = None,
) -> str:
    """Write in the dataset's storage, record it with the first batch, and return it."""
    choice = decide_storage(df.sparkSession, root, spec, df.schema, est_rows, small_rows)
    if choice == "parquet":
        types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
        write_flat(df, root, {**types, "biz_date": "string", "sync_time": "string"}, dt, sync_time)
    else:
        write_envelopes(df, root, spec, dt, sync_time, rows=rows)
    record_storage(df.sparkSession, root, choice)
    return choice
