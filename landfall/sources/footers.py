"""What schemas the Parquet files of a dataset really have: footers read in tasks, reduced to the distinct ones."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landfall.sources.partitions import files

_DIRECT = ("file", "hdfs", "s3", "s3a", "s3n", "gs", "gcs", "abfs", "abfss")  # stores of which a task can read a part of a file


def footer_census(spark: SparkSession, path: str) -> DataFrame | None:
    """``schema`` (JSON of a Spark struct, null if unreadable), ``problem``, ``files`` and an ``example`` file for each distinct schema.

    File names are dealt to tasks, which read footers only. In a store that tasks cannot open themselves the
    files come through Spark's reader, whole. None if the path does not exist.
    """
    names = files(spark, path)
    if names is None:
        return None
    direct = path.split(":", 1)[0] in _DIRECT or ":" not in path.split("/", 1)[0]
    rows = names if direct else files(spark, path, columns=("path", "content"))
    found = rows.mapInArrow(_footer_reader(), "path string, schema string, problem string")
    return found.groupBy("schema", "problem").agg(F.count("*").alias("files"), F.min("path").alias("example"))


def _footer_reader():
    """The function tasks run; it holds all it needs, so workers need no package of ours."""

    def open_file(path: str):
        
        from pyarrow import fs

        scheme, _, rest = path.partition(":")
        if scheme == "file" or not rest:
            return fs.LocalFileSystem().open_input_file(rest or path)
        uri = f"{'s3' if scheme in ('s3a', 's3n') else scheme}:{quote(rest, safe='/:@=')}"
        store, inner = fs.FileSystem.from_uri(uri)
        return store.open_input_file(inner)

    def schema_of(path: str, content) -> tuple[str | None, str | None]:
        import pyarrow as pa
        import pyarrow.parquet as pq
        from pyspark.sql.pandas.types import from_arrow_schema

        try:
            with open_file(path) if content is None else pa.BufferReader(content.as_buffer()) as source:
                stored = pq.read_schema(source)
            own = (stored.metadata or {}).get(b"org.apache.spark.sql.parquet.row.metadata")
            return (own.decode() if own else from_arrow_schema(stored.remove_metadata()).json()), None
        except (OSError, pa.ArrowException) as broken:
            return None, f"{type(broken).__name__}: {broken}"[:300]

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            paths = batch.column(0).to_pylist()
            contents = batch.column(1) if batch.num_columns > 1 else [None] * len(paths)
            read = [schema_of(p, c) for p, c in zip(paths, contents, strict=True)]
            columns = [batch.column(0), *(pa.array([r[k] for r in read], pa.string()) for k in (0, 1))]
            yield pa.RecordBatch.from_arrays(columns, names=["path", "schema", "problem"])

    return run


def distinct_schemas(census: DataFrame, most: int = 100) -> list[tuple[T.StructType | None, str, str | None]]:
    """(schema, example file, problem) of each distinct schema, at most ``most``: one more than one is already too many."""
    rows = census.orderBy("example").limit(most).collect()
    return [(T.StructType.fromJson(json.loads(r.schema)) if r.schema else None, r.example, r.problem) for r in rows]
