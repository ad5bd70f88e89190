"""Plain configuration objects: what a dataset is called, how it is shaped, how it is keyed."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import Column
from pyspark.sql import types as T


@dataclass(frozen=True)
class Field:
    """One output column: name, type, and a function building it from the expanded row."""

    name: str
    type: str
    build: Callable[[], Column]
    late: bool = False  # built after the dimension join
    comment: str = ""


def described(fields: tuple[Field, ...], comments: dict[str, str]) -> tuple[Field, ...]:
    """Fields with their comments; a field without one, or a comment without a field, is refused."""
    names = [f.name for f in fields]
    if set(names) != set(comments):
        raise ValueError(f"comments and fields differ in {sorted(set(names) ^ set(comments))}")
    return tuple(replace(f, comment=comments[f.name]) for f in fields)


@dataclass(frozen=True)
class DatasetSpec:
    """One dataset. ``max_envelopes=1`` is the single-file contract; ``None`` allows shards.

    Envelopes that state the size of their whole batch prove their completeness themselves and are
    accepted in any number.
    """

    name: str
    source: str
    record_ddl: str
    root: str = ""
    target: str = ""
    table: str = ""  # catalog table over ``target``; the jobs keep it and its partitions up to date
    mode: str = "strict"
    max_envelopes: int | None = 1
    empty_code: str = "EMPTY_DATA"
    keys: tuple[str, ...] = ()
    digit_keys: tuple[str, ...] = ()
    time_columns: tuple[str, ...] = ()
    time_shape: str = "datetime"
    unique: str | None = None
    child: str | None = None
    child_key: str = "id"
    bad_key_code: str = "INVALID_KEY_OR_TIME"
    duplicate_code: str = "DUPLICATE_KEY"
    fields: tuple[Field, ...] = ()
    window_days: int = 0
    position_width: int = 7
    empty_policy: str = "FAIL"
    on_duplicate: str = "fail"
    casts: tuple[tuple[str, str], ...] = ()
    strict_times: bool = False  # required times must also be real calendar dates
    storage: str | None = None  # decided once per dataset; None lets the first landing decide

    @property
    def record_schema(self) -> T.StructType:
        """Parsed on use, because the parser needs a running session."""
        return T.StructType.fromDDL(self.record_ddl)


def contract_schema(fields, partition: str | None = "dt") -> T.StructType:
    """The declared detail schema, partition column last."""
    schema = T.StructType.fromDDL(", ".join(f"`{f.name}` {f.type}" for f in fields))
    return schema.add(partition, T.StringType()) if partition else schema
