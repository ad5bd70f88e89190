"""Schema contracts and storage routing."""

from __future__ import annotations

from pyspark.sql import types as T


class SchemaError(ValueError):
    """Actual and declared schema differ."""


class StorageUndecided(ValueError):
    """Not enough is known to choose a storage format."""


class StorageConflict(ValueError):
    """A dataset's root already holds another storage format."""


def schema_diff(actual: T.StructType, expected: T.StructType) -> list[str]:
    """Differences in names, order and types; nullability is not part of the contract."""
    out = []
    if actual.names != expected.names:
        out.append(f"columns {actual.names} expected {expected.names}")
    types = {f.name: f.dataType.simpleString() for f in actual.fields}
    out += [
        f"{f.name}: {types[f.name]} expected {f.dataType.simpleString()}"
        for f in expected.fields
        if f.name in types and types[f.name] != f.dataType.simpleString()
    ]
    return out


def assert_schema(df, expected: T.StructType):
    """Return ``df`` unchanged, or raise when its schema is not the declared one."""
    problems = schema_diff(df.schema, expected)
    if problems:
        raise SchemaError("; ".join(problems))
    return df


def is_nested(schema: T.StructType) -> bool:
    return any(isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType)) for f in schema.fields)


def choose_storage(schema: T.StructType | None, est_rows: int | None = None, small_rows: int = 100_000) -> str:
    """``nested-json``, ``flat-json`` or ``parquet``; raises when the answer is not known."""
    if schema is None or not schema.fields:
        raise StorageUndecided("unknown schema")
    if is_nested(schema):
        return "nested-json"
    if est_rows is None:
        raise StorageUndecided("flat schema of unknown volume")
    return "flat-json" if est_rows <= small_rows else "parquet"
