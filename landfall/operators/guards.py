"""Guards: aggregates that must be clean before any write begins.

A guard is a one-row frame ``(code, checked_count, …measures)``; ``code`` is the first broken
rule in order of precedence, or null. Guards run as actions on the driver, never inside the
write job, so a failing batch cannot touch the target.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landfall.functions import cast_fault, has_date_prefix, is_blank, is_datetime_text, is_digits, technical_id
from landfall.operators.aggregates import count_where, sum0
from landfall.operators.expand import expand_children
from landfall.sources.envelopes import metadata_ok
from landfall.spec import DatasetSpec


class GuardError(RuntimeError):
    """A batch was refused. ``code`` is the broken rule, ``counts`` the measures behind it."""

    def __init__(self, code: str, counts: dict):
        super().__init__(f"{code} {counts}")
        self.code, self.counts = code, counts


@dataclass(frozen=True)
class Guard:
    """A named one-row check frame."""

    name: str
    frame: DataFrame


def verdict(measures: DataFrame, rules: list[tuple[str, Column]], checked: str) -> DataFrame:
    """First broken rule wins; a rule whose condition is null is skipped."""
    code = F.lit(None).cast("string")
    for name, broken in reversed(rules):
        code = F.when(broken, F.lit(name)).otherwise(code)
    return measures.select(
        code.alias("code"), F.col(checked).cast("bigint").alias("checked_count"), *measures.columns
    )


def measure_guards(guards: list[Guard]) -> dict[str, dict]:
    """Run guards in order; raise on the first broken one, return all their measures otherwise.

    What a guard has counted need not be counted again: reports take it from here.
    """
    measured = {}
    for guard in guards:
        row = guard.frame.first().asDict()
        if row["code"] is not None:
            counts = {k: v for k, v in row.items() if k not in ("code", "checked_count")}
            raise GuardError(row["code"], counts)
        measured[guard.name] = row
    return measured


def run_guards(guards: list[Guard]) -> dict[str, int]:
    """Run guards in order; raise on the first broken one, return the checked counts otherwise."""
    return {name: row["checked_count"] for name, row in measure_guards(guards).items()}


def metadata_broken(spec: DatasetSpec, dt: str) -> Column:
    return ~metadata_ok(spec, dt)


def _envelope_rules(spec: DatasetSpec) -> list[tuple[str, Column]]:
    """Rules in order of precedence. A dataset that allows empty days still needs an envelope."""
    declared, actual = F.col("declared_count"), F.col("actual_count")
    absent, empty = F.col("envelope_count") == 0, (declared == 0) | (actual == 0)
    if spec.empty_policy == "ALLOW":
        empty = F.lit(False)
    mismatch = ("RECORD_COUNT_MISMATCH", declared != actual)
    lost = ("MISSING_SHARD", (actual != F.col("batch_count")) | (F.col("low_batch_count") != F.col("batch_count")))
    rules = [("CORRUPT_ENVELOPE", F.col("corrupt_count") > 0)]
    if spec.max_envelopes is None and spec.mode == "filtered":
        nothing = absent if spec.empty_policy == "ALLOW" else absent | (actual == 0)
        return [*rules, ("EMPTY_OSS_SOURCE", nothing), mismatch, lost]
    rules.append(("EMPTY_OSS_SOURCE", absent))
    if spec.max_envelopes is not None:
        stated = F.col("batch_count").isNotNull()
        rules.append(("UNEXPECTED_ENVELOPE_COUNT", ~stated & (F.col("envelope_count") > spec.max_envelopes)))
    if spec.mode == "strict":
        rules.append(("INVALID_ENVELOPE_METADATA", F.col("invalid_metadata_count") > 0))
    return [*rules, (spec.empty_code, empty), mismatch, lost]


def _batch_counts(counted: Column, columns: list[str]) -> list[Column]:
    """Sizes of the whole batch as its envelopes state them; null where none does."""
    stated = F.when(counted, F.col("batch_count")) if "batch_count" in columns else F.lit(None).cast("bigint")
    return [F.max(stated).alias("batch_count"), F.min(stated).alias("low_batch_count")]


def envelope_verdict(envelopes: DataFrame, spec: DatasetSpec, dt: str) -> DataFrame:
    """Envelope check over unexpanded envelopes.

    ``strict`` looks at every envelope of the partition; ``filtered`` only at matching ones. A
    damaged envelope has no readable metadata and would vanish from a filtered read, so damage
    is counted over the whole partition in both modes.
    """
    mine = F.lit(True) if spec.mode == "strict" else ~metadata_broken(spec, dt)
    corrupt = F.col("_corrupt").isNotNull() if "_corrupt" in envelopes.columns else F.lit(False)
    measures = envelopes.where(F.col("dt") == dt).agg(
        count_where(corrupt).alias("corrupt_count"),
        count_where(mine).alias("envelope_count"),
        count_where(mine & metadata_broken(spec, dt)).alias("invalid_metadata_count"),
        sum0(F.when(mine, F.col("record_count"))).alias("declared_count"),
        sum0(F.when(mine, F.array_size("data"))).alias("actual_count"),
        *_batch_counts(mine, envelopes.columns),
    )
    return verdict(measures, _envelope_rules(spec), "actual_count")


def staged_envelope_verdict(staged: DataFrame, spec: DatasetSpec, dt: str) -> DataFrame:
    """The same check over a staged batch, where one row per envelope has ``coalesce(pos, 0) = 0``.

    Positions are counted per shard, so two envelopes must not carry one shard number.
    """
    first = F.coalesce("pos", F.lit(0)) == 0
    mine = F.lit(True) if spec.mode == "strict" else ~metadata_broken(spec, dt)
    measures = staged.where(F.col("dt") == dt).agg(
        count_where(F.col("corrupt") & first).alias("corrupt_count"),
        count_where(mine & first).alias("envelope_count"),
        count_where(mine & first & metadata_broken(spec, dt)).alias("invalid_metadata_count"),
        sum0(F.when(mine & first, F.col("record_count"))).alias("declared_count"),
        count_where(mine & F.col("pos").isNotNull()).alias("actual_count"),
        F.countDistinct(F.when(mine & first, F.col("shard_no"))).alias("shard_count"),
        *_batch_counts(mine & first, staged.columns),
    )
    repeated = ("DUPLICATE_SHARD", F.col("shard_count") != F.col("envelope_count"))
    return verdict(measures, [*_envelope_rules(spec), repeated], "actual_count")


def envelope_guard(envelopes: DataFrame, spec: DatasetSpec, dt: str) -> int:
    """Raise on a broken envelope rule; return the record count."""
    return run_guards([Guard("envelope", envelope_verdict(envelopes, spec, dt))])["envelope"]


def bad_key(
    keys, digit_keys=(), time_columns=(), time_shape: str = "datetime", parent: str = "rec", strict: bool = False
) -> Column:
    """True where a required key is missing, malformed, or a required time has the wrong shape.

    ``strict`` also refuses a time that no calendar has.
    """
    shape = is_datetime_text if time_shape == "datetime" else has_date_prefix
    tests = [is_blank(F.col(f"{parent}.{k}").cast("string")) for k in keys]
    tests += [~is_digits(f"{parent}.{k}") for k in digit_keys]
    tests += [~shape(f"{parent}.{t}", strict) for t in time_columns]
    broken = F.lit(False)
    for t in tests:
        broken = broken | t
    return broken


def any_cast_fault(casts) -> Column:
    """True where one of ``(path, type)`` would silently become null."""
    broken = F.lit(False)
    for path, type_ in casts:
        broken = broken | cast_fault(path, type_)
    return broken


def record_verdict(records: DataFrame, spec: DatasetSpec, parent: str = "rec") -> DataFrame:
    """Required keys and times, lossy casts, then uniqueness of the record key."""
    broken = bad_key(spec.keys, spec.digit_keys, spec.time_columns, spec.time_shape, parent, spec.strict_times)
    unique = F.countDistinct(f"{parent}.{spec.unique}") if spec.unique else F.count("*")
    measures = records.agg(
        F.count("*").alias("record_count"),
        unique.alias("distinct_count"),
        count_where(broken).alias("invalid_count"),
        count_where(any_cast_fault(spec.casts)).alias("lossy_cast_count"),
    )
    rules = [
        (spec.bad_key_code, F.col("invalid_count") > 0),
        ("LOSSY_CAST", F.col("lossy_cast_count") > 0),
    ]
    if spec.on_duplicate == "fail":
        rules.append((spec.duplicate_code, F.col("record_count") != F.col("distinct_count")))
    return verdict(measures, rules, "record_count")


def record_guard(records: DataFrame, spec: DatasetSpec) -> int:
    return run_guards([Guard("record", record_verdict(records, spec))])["record"]


def child_verdict(
    expanded: DataFrame, parent_id: str, child_id: str, pos: str = "item_pos", on_duplicate: str = "fail"
) -> DataFrame:
    """Parents and children must have ids, and the technical id must be unique over the expansion."""
    parent, child = F.col(parent_id), F.col(child_id)
    measures = expanded.select(
        (parent.isNull() | (F.col(pos).isNotNull() & child.isNull())).alias("broken"),
        F.col(pos).isNull().alias("childless"),
        technical_id(pos, parent, child).alias("technical_id"),
    ).agg(
        F.count("*").alias("expanded_count"),
        F.countDistinct("technical_id").alias("distinct_count"),
        count_where(F.col("broken")).alias("invalid_count"),
        count_where(F.col("childless")).alias("childless_count"),
    )
    rules = [("INVALID_PARENT_OR_ITEM_ID", F.col("invalid_count") > 0)]
    if on_duplicate == "fail":
        rules.append(("DUPLICATE_TECHNICAL_ID", F.col("expanded_count") != F.col("distinct_count")))
    return verdict(measures, rules, "expanded_count")


def child_guard(records: DataFrame, spec: DatasetSpec) -> int:
    expanded = expand_children(records, spec.child)
    frame = child_verdict(expanded, f"rec.{spec.unique}", f"item.{spec.child_key}", on_duplicate=spec.on_duplicate)
    return run_guards([Guard("child", frame)])["child"]
