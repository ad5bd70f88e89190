"""Comparison with another copy of the data.

Both copies are stacked and grouped once by the business key. Compared with a full outer join
this needs one shuffle, combines on the map side, and a key repeated on both sides costs one
group instead of all its pairs.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landfall.functions import as_col, diff_text
from landfall.operators.partitions import combine_one_row

NULL_MARK = "\\N"
UNREADABLE_MARK = "\\?"
SEPARATOR = "|"

# Cell results and conclusions of the report.
SAME, DIFFERENT, NOT_AVAILABLE = "一致", "异常", "N/A"
PASS, CONDITIONAL, FAIL, INCOMPLETE = "通过", "条件通过", "不通过", "未完成"


def canonical(c, type_: str = "string", zone: str | None = None) -> Column:
    """One value as comparable text.

    ``decimal(p,s)`` fixes the scale; ``timestamp`` keeps microseconds and ``timestamp(n)`` n digits
    of a second; with ``zone`` it is read as wall-clock time of that zone and moved to UTC. Null
    gets a mark of its own, apart from blank; a value that cannot be read as the type gets another
    before its own text, so it differs from every readable one. Mark and separator characters are
    escaped in ordinary text.
    """
    c = as_col(c)
    plain = F.replace(F.replace(c.cast("string"), F.lit("\\"), F.lit("\\\\")), F.lit(SEPARATOR), F.lit("\\|"))
    if type_.startswith("timestamp"):
        digits = int(type_[10:-1]) if "(" in type_ else 6
        ts = c.try_cast("timestamp_ntz")
        ts = (F.convert_timezone(F.lit(zone), F.lit("UTC"), ts) if zone else ts).cast("string")
        text = F.substring(ts, 1, 19)
        if digits:
            text = F.concat(text, F.lit("."), F.substring(F.rpad(F.substring(ts, 21, 6), 6, "0"), 1, digits))
    elif type_ == "string":
        text = plain
    else:
        text = c.try_cast(type_).cast("string")
    return F.coalesce(text, F.concat(F.lit(UNREADABLE_MARK), plain), F.lit(NULL_MARK))


def unreadable_counts(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """One row: per column, how many values are present but cannot be read as the type."""
    kinds = {c: "timestamp_ntz" if t.startswith("timestamp") else t for c, t in types.items()}
    return df.agg(*[F.count_if(F.col(c).isNotNull() & F.col(c).try_cast(t).isNull()).alias(c) for c, t in kinds.items()])


def row_digest(types: dict[str, str], zones: dict[str, str] | None = None) -> Column:
    """md5 over the canonical texts of the columns, in the given order."""
    return F.md5(F.concat_ws(SEPARATOR, *[canonical(c, t, (zones or {}).get(c)) for c, t in types.items()]))


def _digest_sum(digest: Column) -> Column:
    """Order-independent sum of a 60-bit part of an md5 text."""
    return F.sum(F.conv(F.substring(digest, 1, 15), 16, 10).cast("decimal(20,0)"))


def _status() -> Column:
    return (
        F.when(F.col("n_old") == 0, "only_new")
        .when(F.col("n_new") == 0, "only_old")
        .when((F.col("n_new") == F.col("n_old")) & F.col("_equal"), "same")
        .otherwise("changed")
    )


def _stack(new: DataFrame, old: DataFrame, select) -> DataFrame:
    sides = [df.select(*select(df), F.lit(flag).alias("_new")) for df, flag in ((new, 1), (old, 0))]
    return sides[0].unionByName(sides[1])


def compare_rows(new: DataFrame, old: DataFrame, keys: list[str], types: dict[str, str]) -> DataFrame:
    """Per key: rows on each side, status, and the names of the columns that differ.

    A key that repeats is compared as a multiset of rows; the column names come from multisets of
    values, and stay empty if only the pairing of values differs.
    """
    def select(df):
        row = F.xxhash64(*[canonical(c, t) for c, t in types.items()]) if types else F.lit(0).cast("bigint")
        return [*[F.col(k) for k in keys], row.alias("_row"), *[F.xxhash64(canonical(c, t)).alias(f"_d_{c}") for c, t in types.items()]]

    is_new = F.col("_new") == 1
    sums = [
        x
        for c in types
        for x in (
            F.sum(F.when(is_new, F.col(f"_d_{c}")).cast("decimal(20,0)")).alias(f"_n_{c}"),
            F.sum(F.when(~is_new, F.col(f"_d_{c}")).cast("decimal(20,0)")).alias(f"_o_{c}"),
        )
    ]
    rows = [F.sum(F.when(side, F.col("_row")).cast("decimal(20,0)")) for side in (is_new, ~is_new)]
    grouped = _stack(new, old, select).groupBy(*keys).agg(
        F.count_if(is_new).alias("n_new"), F.count_if(~is_new).alias("n_old"), *sums, rows[0].eqNullSafe(rows[1]).alias("_rows_equal")
    )
    differing = F.array_compact(
        F.array(*[F.when(~F.col(f"_n_{c}").eqNullSafe(F.col(f"_o_{c}")), F.lit(c)) for c in types])
    )
    both = (F.col("n_new") > 0) & (F.col("n_old") > 0)
    out = grouped.withColumn("_diff", differing).withColumn("_equal", (F.array_size("_diff") == 0) & F.col("_rows_equal"))
    return out.select(
        *keys, "n_new", "n_old", _status().alias("status"),
        F.when(both, F.concat_ws(",", "_diff")).otherwise(F.lit("")).alias("changed_columns"),
    )


def compare_hash(
    new: DataFrame, old: DataFrame, keys: list[str], types: dict[str, str],
    new_zones: dict[str, str] | None = None, old_zones: dict[str, str] | None = None,
) -> DataFrame:
    """Per key comparison by one whole-row digest; zones name the wall clock each side is written in."""
    sides = [
        df.select(*keys, row_digest(types, zones).alias("_d"), F.lit(flag).alias("_new"))
        for df, zones, flag in ((new, new_zones, 1), (old, old_zones, 0))
    ]
    is_new = F.col("_new") == 1
    grouped = sides[0].unionByName(sides[1]).groupBy(*keys).agg(
        F.count_if(is_new).alias("n_new"),
        F.count_if(~is_new).alias("n_old"),
        _digest_sum(F.when(is_new, F.col("_d"))).alias("_a"),
        _digest_sum(F.when(~is_new, F.col("_d"))).alias("_b"),
    )
    out = grouped.withColumn("_equal", F.col("_a") == F.col("_b"))
    return out.select(*keys, "n_new", "n_old", _status().alias("status"))


def anomaly_sample(diff: DataFrame, keys: list[str], n: int = 20) -> DataFrame:
    """The first n differing keys in key order; empty when nothing differs."""
    return diff.where(F.col("status") != "same").orderBy(*keys).limit(n)


def fault_sample(diff: DataFrame, keys: list[str], n: int = 5) -> DataFrame:
    """Up to n keys of each fault: of each status, and of each column that changed.

    A key stands under every fault it shows, so a column that differs everywhere cannot crowd out another. Keys are chosen by
    the md5 of their texts, then by themselves. The n smallest of each fault are kept in the tasks before the shuffle; a fault with
    all rows sends n rows a task.
    """
    columns = F.when(F.col("changed_columns") == "", F.array(F.lit(""))).otherwise(F.split("changed_columns", ","))
    faults = diff.where(F.col("status") != "same").select("*", F.explode(columns).alias("fault_column"))
    first = W.partitionBy("status", "fault_column").orderBy(F.md5(F.concat_ws(SEPARATOR, *[F.col(k).cast("string") for k in keys])), *keys)
    ranked = faults.withColumn("place", F.row_number().over(first)).where(F.col("place") <= n)
    return ranked.select("status", "fault_column", F.col("place").cast("int").alias("place"), *keys, "n_new", "n_old", "changed_columns")


def align_snapshot(new: DataFrame, old: DataFrame, on: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Cut both copies to their common window on ``on`` and describe the boundary.

    Only the four bounds come to the driver; as literals they reach the scans as pushed filters.
    Instants come as microseconds since the epoch, so the driver's time zone has no part in it.
    """
    kind = new.schema[on].dataType
    instant = isinstance(kind, T.TimestampType)

    def span(df, side):
        return df.agg(F.min(on).alias(f"{side}_from"), F.max(on).alias(f"{side}_to"))

    window = combine_one_row(span(new, "new"), span(old, "old"))
    row = window.select(*[(F.unix_micros(c) if instant else F.col(c)).alias(c) for c in window.columns]).first()
    present = row["new_from"] is not None and row["old_from"] is not None
    low = max(row["new_from"], row["old_from"]) if present else None
    high = min(row["new_to"], row["old_to"]) if present else None
    if not present or low > high:
        name = "incomparable"
    else:
        name = "same" if (row["new_from"], row["new_to"]) == (row["old_from"], row["old_to"]) else "near"
    if instant:
        low_col, high_col = (F.timestamp_micros(F.lit(x).cast("bigint")) for x in (low, high))
    else:
        low_col, high_col = (F.lit(None if x is None else str(x)).cast(kind) for x in (low, high))
    boundary = window.select("*", low_col.alias("common_from"), high_col.alias("common_to"), F.lit(name).alias("boundary"))
    inside = F.col(on).between(low_col, high_col)
    return new.where(inside), old.where(inside), boundary


def align_batches(new: DataFrame, old: DataFrame, on: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Cut both copies to the days or batches that both hold.

    ``on`` names the batch of a row, a partition column if there is one. The boundary row lists what only one copy
    holds; ``near`` says that there is such a batch, ``incomparable`` that none is shared. The driver holds one value for each
    batch, which become a literal filter on both scans. Rows without a batch are in neither.
    """
    sides = [df.select(F.col(on).alias("batch"), F.lit(flag).alias("new")) for df, flag in ((new, True), (old, False))]
    held = sides[0].unionByName(sides[1]).where("batch is not null").groupBy("batch")
    held = held.agg(F.bool_or("new").alias("in_new"), F.bool_or(~F.col("new")).alias("in_old")).orderBy("batch").collect()
    shared = [r.batch for r in held if r.in_new and r.in_old]
    only = {"new": [r.batch for r in held if not r.in_old], "old": [r.batch for r in held if not r.in_new]}
    name = "incomparable" if not shared else "near" if only["new"] or only["old"] else "same"
    row = (name, len(shared), *[[str(b) for b in only[s]] for s in ("new", "old")])
    boundary = new.sparkSession.createDataFrame([row], "boundary string, common_batches bigint, only_new array<string>, only_old array<string>")
    inside = F.col(on).isin(shared)
    return new.where(inside), old.where(inside), boundary


def common_metrics(new: DataFrame, old: DataFrame) -> DataFrame:
    """Metrics defined on both sides, from two ``(metric_name, metric_value)`` frames."""
    return new.select("metric_name", F.col("metric_value").alias("new_value")).join(
        old.select("metric_name", F.col("metric_value").alias("old_value")), "metric_name"
    )


def two_system_report(new: DataFrame | None, old: DataFrame | None, scale: int = 6) -> DataFrame:
    """Report ``metric, new_value, old_value, diff, result``.

    Sides are ``(metric_name, metric_value)`` text frames. Values that are numbers on both sides are
    compared as decimals of ``scale`` places, others as text; a value that is not available on one
    side is shown as N/A, never as zero.
    """
    present = new if new is not None else old
    if present is None:
        raise ValueError("at least one side is needed")
    nothing = present.where(F.lit(False)).select("metric_name", "metric_value")
    a = (new if new is not None else nothing).select("metric_name", F.col("metric_value").alias("_new"))
    b = (old if old is not None else nothing).select("metric_name", F.col("metric_value").alias("_old"))
    n, o = (F.col(c).try_cast(f"decimal(38,{scale})") for c in ("_new", "_old"))
    available = F.col("_new").isNotNull() & F.col("_old").isNotNull()
    numeric = n.isNotNull() & o.isNotNull()
    return a.join(b, "metric_name", "full_outer").select(
        F.col("metric_name").alias("metric"),
        F.coalesce("_new", F.lit(NOT_AVAILABLE)).alias("new_value"),
        F.coalesce("_old", F.lit(NOT_AVAILABLE)).alias("old_value"),
        F.when(numeric, diff_text(n, o)).otherwise(NOT_AVAILABLE).alias("diff"),
        F.when(~available, NOT_AVAILABLE)
        .when(F.when(numeric, n == o).otherwise(F.col("_new") == F.col("_old")), SAME)
        .otherwise(DIFFERENT)
        .alias("result"),
    )


def report_verdict(report: DataFrame, boundary: str | DataFrame, must_be_zero: tuple[str, ...] = ()) -> DataFrame:
    """Conclusion over a report.

    Incomplete when no boundary can be compared or no metric exists on both sides; failed on any
    real fault (a must-be-zero metric, or a difference inside the same snapshot); conditional
    when collection times differ and the differences are quantified; passed otherwise. A metric
    that only one side defines is N/A and decides nothing.
    ``boundary`` is ``same``, ``near`` or ``incomparable``, or a one-row frame holding it.
    """
    facts = report.agg(
        F.count_if(F.col("result") == NOT_AVAILABLE).alias("unavailable"),
        F.count_if(F.col("result") != NOT_AVAILABLE).alias("compared"),
        F.count_if(F.col("result") == DIFFERENT).alias("different"),
        F.count_if(
            F.col("metric").isin(list(must_be_zero)) & ~F.col("new_value").isin("0", NOT_AVAILABLE)
        ).alias("faults"),
    )
    if isinstance(boundary, str):
        facts = facts.withColumn("boundary", F.lit(boundary))
    else:
        facts = combine_one_row(facts, boundary.select("boundary"))
    conclusion = (
        F.when((F.col("boundary") == "incomparable") | (F.col("compared") == 0), INCOMPLETE)
        .when(F.col("faults") > 0, FAIL)
        .when(F.col("boundary") == "near", CONDITIONAL)
        .when(F.col("different") > 0, FAIL)
        .otherwise(PASS)
    )
    return facts.select("boundary", "compared", "unavailable", "different", "faults", conclusion.alias("conclusion"))


def count_chain(stages: list[tuple[str, DataFrame, str]]) -> DataFrame:
    """Row counts along the way, with the change at each stage and its reason.

    ``stages`` are ``(name, frame, reason)``; the window runs over one row per stage. A reason that
    says which way the count must go (``filter`` and ``dedup`` down, ``expansion`` up) is checked
    against the change and reported as ``contradicted`` otherwise.
    """
    rows = [
        df.agg(F.count("*").alias("row_count")).select(
            F.lit(i).cast("bigint").alias("stage_no"), F.lit(name).alias("stage"), "row_count", F.lit(why).alias("reason")
        )
        for i, (name, df, why) in enumerate(stages, 1)
    ]
    out = rows[0]
    for row in rows[1:]:
        out = out.unionByName(row)
    before = F.lag("row_count").over(W.orderBy("stage_no"))
    delta = F.coalesce(F.col("row_count") - before, F.lit(0))
    wrong = (F.col("reason").isin("filter", "dedup") & (delta > 0)) | ((F.col("reason") == "expansion") & (delta < 0))
    return out.select(
        "stage_no", "stage", "row_count", delta.alias("delta"),
        F.when(delta == 0, "unchanged").when(wrong, F.concat(F.lit("contradicted: "), "reason")).otherwise(F.col("reason")).alias("reason"),
    )


@dataclass(frozen=True)
class Stage:
    """One stage of an explained chain: its rows, and how many were added or taken away for each reason.

    ``reasons`` maps a reason to a one-row frame with the column ``n``, positive for rows added and negative for rows
    taken away, counted where it happened and not derived from the totals.
    """

    name: str
    rows: DataFrame
    reasons: dict[str, DataFrame] = field(default_factory=dict)


def explained_chain(stages: list[Stage]) -> DataFrame:
    """Row counts along the way, each change set against the counted reasons for it.

    ``unexplained`` is what the reasons do not account for; ``result`` is ``unchanged``, ``explained`` or
    ``unexplained``. Reasons that cancel out in the total are shown, and a wrong one shows as a rest.
    """
    counts, reasons = [], []
    for i, stage in enumerate(stages, 1):
        counts.append(stage.rows.agg(F.count("*").alias("row_count")).select(F.lit(i).cast("bigint").alias("stage_no"), F.lit(stage.name).alias("stage"), "row_count"))
        reasons += [
            n.select(F.lit(i).cast("bigint").alias("stage_no"), F.lit(why).alias("reason"), F.col("n").cast("bigint").alias("n"))
            for why, n in stage.reasons.items()
        ]
    chain = reduce(DataFrame.unionByName, counts)
    if reasons:
        told = reduce(DataFrame.unionByName, reasons).groupBy("stage_no").agg(
            F.sum("n").alias("explained"),
            F.array_join(F.sort_array(F.collect_list(F.format_string("%s %+d", "reason", "n"))), ", ").alias("reasons"),
        )
        chain = chain.join(told, "stage_no", "left")
    else:
        chain = chain.withColumns({"explained": F.lit(0).cast("bigint"), "reasons": F.lit("")})
    before = F.lag("row_count").over(W.orderBy("stage_no"))
    delta = F.coalesce(F.col("row_count") - before, F.lit(0))
    rest = delta - F.coalesce("explained", F.lit(0))
    result = F.when(rest != 0, "unexplained").when(F.coalesce("reasons", F.lit("")) != "", "explained").otherwise("unchanged")
    return chain.select(
        "stage_no", "stage", "row_count", delta.alias("delta"), F.coalesce("reasons", F.lit("")).alias("reasons"),
        rest.alias("unexplained"), result.alias("result"),
    )
