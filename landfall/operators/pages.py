"""Completeness of a paginated extract, checked on landed page files.

A page is ``(key, page_no, offset, total, records ARRAY<STRUCT>)``. Every check aggregates by key
with partial aggregation first, so one key holding most pages is no bottleneck.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landfall.functions import is_blank, window_bounds
from landfall.operators.aggregates import count_where
from landfall.operators.guards import Guard, GuardError, run_guards, verdict
from landfall.sources.keys import explode_loose, parse_loose, valid_keys


def request_plan(keys: DataFrame, dt: str, days: int, closed: bool = False) -> DataFrame:
    """One request per upstream key with its window bounds."""
    start, end = window_bounds(dt, days, closed)
    return keys.select("key", F.lit(start).alias("window_start"), F.lit(end).alias("window_end"))


def collect_pages(pages: DataFrame) -> DataFrame:
    """Records of all pages with key, page number and position."""
    return pages.select("key", "page_no", F.posexplode("records").alias("pos", "rec"))


def page_totals(pages: DataFrame) -> DataFrame:
    """Received against declared count per key."""
    received = F.coalesce(F.sum(F.array_size("records")), F.lit(0)).cast("bigint")
    return (
        pages.groupBy("key")
        .agg(F.count("*").alias("page_count"), received.alias("received"), F.max("total").alias("declared"))
        .withColumn("complete", F.coalesce(F.col("received") == F.col("declared"), F.lit(False)))
    )


def page_faults(
    pages: DataFrame, max_page: int | None = None, first_page: int = 1, max_offset: int | None = None
) -> DataFrame:
    """Faults as ``(key, kind, detail)``.

    TOTAL_CHANGED, TOTAL_MISMATCH, PAGE_LIMIT, OFFSET_LIMIT, PAGE_GAP per key, and DUPLICATE_PAGE for content
    that arrived more than once (empty pages are not compared).
    """
    received = F.coalesce(F.sum(F.array_size("records")), F.lit(0)).cast("bigint")
    per_key = pages.groupBy("key").agg(
        F.min("total").alias("low_total"),
        F.max("total").alias("high_total"),
        received.alias("received"),
        F.min("page_no").alias("low_page"),
        F.max("page_no").alias("high_page"),
        F.countDistinct("page_no").alias("pages"),
        F.max("offset").alias("high_offset"),
    )
    gap = (F.col("low_page") != first_page) | (F.col("pages") != F.col("high_page") - F.col("low_page") + 1)
    kinds = [
        ("TOTAL_CHANGED", F.col("low_total") != F.col("high_total"), F.col("high_total") - F.col("low_total")),
        ("TOTAL_MISMATCH", F.col("received") != F.col("high_total"), F.col("received") - F.col("high_total")),
        ("PAGE_GAP", gap, F.col("high_page") - first_page + 1 - F.col("pages")),
    ]
    if max_page is not None:
        kinds.append(("PAGE_LIMIT", F.col("high_page") > max_page, F.col("high_page") - max_page))
    if max_offset is not None:
        kinds.append(("OFFSET_LIMIT", F.col("high_offset") > max_offset, F.col("high_offset") - max_offset))
    found = F.array(
        *[
            F.when(test, F.struct(F.lit(kind).alias("kind"), detail.cast("bigint").alias("detail")))
            for kind, test, detail in kinds
        ]
    )
    keyed = per_key.select("key", F.inline(F.array_compact(found)))
    repeated = (
        pages.where(F.array_size("records") > 0)
        .groupBy("key", F.sha2(F.to_json("records"), 256).alias("content"))
        .agg((F.count("*") - 1).alias("extra"))
        .where("extra > 0")
        .groupBy("key")
        .agg(F.lit("DUPLICATE_PAGE").alias("kind"), F.sum("extra").alias("detail"))
    )
    return keyed.unionByName(repeated)


def record_faults(records: DataFrame, id_col: str, is_object: Column | None = None) -> DataFrame:
    """One row: records that are not objects, lack an id, or repeat an id anywhere in the extract."""
    rec_ok = is_object if is_object is not None else F.col("rec").isNotNull()
    key = F.col(id_col).cast("string")
    present = rec_ok & ~is_blank(key)
    return records.agg(
        F.count("*").alias("record_count"),
        count_where(~rec_ok).alias("not_object_count"),
        count_where(rec_ok & is_blank(key)).alias("missing_id_count"),
        (F.count(F.when(present, F.lit(1))) - F.countDistinct(F.when(present, key))).alias("duplicate_id_count"),
    )


#: Faults of pages in order of precedence; the first that occurs names the refusal.
PAGE_FAULTS = ("TOTAL_CHANGED", "PAGE_LIMIT", "OFFSET_LIMIT", "PAGE_GAP", "DUPLICATE_PAGE", "TOTAL_MISMATCH")


def unplanned_keys(plan: DataFrame, results: DataFrame) -> DataFrame:
    """Keys with a result that nothing had asked for."""
    return results.select("key").distinct().join(plan.select("key"), "key", "left_anti")


def missing_keys(plan: DataFrame, results: DataFrame) -> DataFrame:
    """Planned keys without a result."""
    return plan.join(results.select("key").distinct(), "key", "left_anti")


def key_source_verdict(texts: DataFrame, key: str) -> DataFrame:
    """Check raw upstream key envelopes: top level, array, declared count, at least one valid key."""
    parsed = parse_loose(texts)
    shape = parsed.agg(
        count_where(~F.col("is_object")).alias("bad_top_count"),
        count_where(F.col("data").isNull()).alias("no_array_count"),
        count_where(F.col("count_text").isNotNull() & F.col("record_count").isNull()).alias("bad_count_count"),
        count_where(F.col("record_count") != F.array_size("data")).alias("mismatch_count"),
    )
    _, stats = valid_keys(explode_loose(parsed, key))
    rules = [
        ("INVALID_TOP_LEVEL", F.col("bad_top_count") > 0),
        ("DATA_NOT_ARRAY", F.col("no_array_count") > 0),
        ("INVALID_RECORD_COUNT", F.col("bad_count_count") > 0),
        ("RECORD_COUNT_MISMATCH", F.col("mismatch_count") > 0),
        ("NO_VALID_KEY", F.col("valid_key_count") == 0),
    ]
    return verdict(shape.crossJoin(F.broadcast(stats)), rules, "valid_key_count")


def record_fault_verdict(faults: DataFrame, empty_policy: str = "FAIL") -> DataFrame:
    """Record faults in order of precedence."""
    rules = [
        ("INVALID_RECORD", F.col("not_object_count") > 0),
        ("MISSING_RECORD_ID", F.col("missing_id_count") > 0),
        ("DUPLICATE_RECORD_ID", F.col("duplicate_id_count") > 0),
    ]
    if empty_policy != "ALLOW":
        rules.append(("EMPTY_BATCH", F.col("record_count") == 0))
    return verdict(faults, rules, "record_count")


def landing_guard(
    pages: DataFrame, plan: DataFrame, id_col: str, max_page: int | None = None, empty_policy: str = "FAIL",
    max_offset: int | None = None,
) -> int:
    """Everything that must hold before an extract is published; returns its record count."""
    absent = missing_keys(plan, pages).count()
    if absent:
        raise GuardError("MISSING_KEY", {"missing_keys": absent})
    stray = unplanned_keys(plan, pages).count()
    if stray:
        raise GuardError("UNPLANNED_KEY", {"unplanned_keys": stray})
    faults = page_faults(pages, max_page, max_offset=max_offset).groupBy("kind").agg(F.count("*").alias("n")).collect()
    if faults:
        counts = {r["kind"]: r["n"] for r in faults}
        raise GuardError(next(kind for kind in PAGE_FAULTS if kind in counts), counts)
    frame = record_fault_verdict(record_faults(collect_pages(pages), f"rec.{id_col}"), empty_policy)
    return run_guards([Guard("records", frame)])["records"]
