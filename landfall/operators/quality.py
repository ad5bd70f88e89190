"""Quality output after a write, and the target-side reconciliation queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from landfall.functions import is_blank, not_in_domain, null_safe_ne, null_to, num0, technical_id
from landfall.operators.aggregates import (
    count_where,
    coverage,
    distribution,
    duplicate_rows,
    grain_duplicates,
    metrics_long,
    partition_trend,
    time_bounds,
)
from landfall.operators.expand import expand_children
from landfall.operators.partitions import combine_one_row, recent_partitions, touched_target


def source_measures(
    records: DataFrame, child: str, parent_id: str, child_id: str = "id", parent: str = "parent"
) -> DataFrame:
    """Counts of the expanded source.

    The parent count comes from the records themselves, so only one distinct is computed over
    the expansion and neither aggregate has to replicate its input.
    """
    expanded = expand_children(records, child).select(
        "item_pos", technical_id("item_pos", f"rec.{parent_id}", f"item.{child_id}").alias("technical_id")
    )
    rows = expanded.agg(
        F.count("*").alias("source_expanded_count"),
        count_where(F.col("item_pos").isNull()).alias(f"source_empty_item_{parent}_count"),
        F.countDistinct("technical_id").alias("source_distinct_id_count"),
    )
    parents = records.agg(F.countDistinct(f"rec.{parent_id}").alias(f"source_{parent}_count"))
    return combine_one_row(rows, parents)


def written_measures(blanks: list[str], times: list[str]) -> dict[str, Column]:
    """The measures of a target that need no distinct, so they can be observed while it is written."""
    named = {
        "target_row_count": F.count("*"),
        "target_null_id_count": count_where(F.col("id").isNull()),
        **{f"empty_{c}_count": count_where(is_blank(c)) for c in blanks},
    }
    for t in times:
        named[f"earliest_{t}"], named[f"latest_{t}"] = time_bounds(t)
    return named


def target_measures(
    target: DataFrame, parent_key: str, blanks: list[str], times: list[str], parent: str = "parent"
) -> DataFrame:
    plain = [c.alias(n) for n, c in written_measures(blanks, times).items()]
    rows = target.agg(plain[0], F.countDistinct("id").alias("target_distinct_id_count"), *plain[1:])
    return combine_one_row(rows, target.agg(F.countDistinct(parent_key).alias(f"target_{parent}_count")))


def quality_from_passes(
    record: dict, child: dict, written: dict, target: DataFrame, dt: str, parent_key: str, parent: str = "parent"
) -> DataFrame:
    """The row of ``quality_parent_child`` from what guards and the write have counted already.

    Only the two distincts of the target are computed, over the files as they were read back.
    """
    ids = target.agg(F.countDistinct("id").alias("n")).first().n
    parents = target.agg(F.countDistinct(parent_key).alias("n")).first().n
    source = {
        "source_expanded_count": child["expanded_count"],
        f"source_empty_item_{parent}_count": child["childless_count"],
        "source_distinct_id_count": child["distinct_count"],
        f"source_{parent}_count": record["distinct_count"],
    }
    first, *others = written
    row = {"affected_dt": dt, **source, first: written[first], "target_distinct_id_count": ids}
    row |= {n: written[n] for n in others} | {f"target_{parent}_count": parents}
    return one_row(target.sparkSession, row)


def one_row(spark: SparkSession, values: dict) -> DataFrame:
    """Counts and texts as a frame that depends on no table."""
    kinds = ", ".join(f"`{n}` {'bigint' if isinstance(v, int) else 'string'}" for n, v in values.items())
    return spark.createDataFrame([tuple(values.values())], kinds)


def quality_parent_child(
    records: DataFrame, target: DataFrame, dt: str, child: str, parent_id: str, parent_key: str,
    blanks: list[str], times: list[str], parent: str = "parent",
) -> DataFrame:
    """Source and target of one partition side by side; ``parent`` names the parent in the measures."""
    src = source_measures(records, child, parent_id, parent=parent)
    tgt = target_measures(target, parent_key, blanks, times, parent)
    return combine_one_row(src, tgt).select(F.lit(dt).alias("affected_dt"), "*")


def touched_measures(key: str, id_col: str, time: str, updated: str) -> dict[str, Column]:
    """What ``quality_touched`` reports and needs no distinct."""
    earliest, latest = time_bounds(time)
    return {
        "row_count": F.count("*"),
        f"empty_{key}_count": count_where(is_blank(key)),
        f"null_{id_col}_count": count_where(F.col(id_col).isNull()),
        f"earliest_{time}": earliest,
        f"latest_{time}": latest,
        f"latest_{updated}": F.max(updated),
    }


def quality_touched(
    target: DataFrame, touched: DataFrame | None, key: str, id_col: str, time: str, updated: str, written: dict | None = None
) -> DataFrame:
    """Counts, keys and time bounds over the touched partitions only.

    Without ``touched`` the target is what one publish wrote; ``written`` are the measures observed then, so only the
    two distincts read it.
    """
    rows = target if touched is None else touched_target(target, touched)
    main = [F.countDistinct(key).alias(f"distinct_{key}_count")]
    if written is None:
        main += [c.alias(n) for n, c in touched_measures(key, id_col, time, updated).items()]
    both = combine_one_row(rows.agg(*main), rows.agg(F.countDistinct(id_col).alias(f"distinct_{id_col}_count")))
    if written is not None:
        plan = rows.agg(*[c.alias(n) for n, c in touched_measures(key, id_col, time, updated).items()]).schema
        both = combine_one_row(target.sparkSession.createDataFrame([tuple(written[n] for n in plan.names)], plan), both)
    names = ["row_count", f"distinct_{key}_count", f"empty_{key}_count", f"null_{id_col}_count"]
    return both.select(*names, f"earliest_{time}", f"latest_{time}", f"latest_{updated}", f"distinct_{id_col}_count")


def quality_tree(target: DataFrame, dt: str) -> DataFrame:
    """Rows, hashes, parents, children and unmatched sellers of a tree partition."""
    return target.agg(
        F.lit(dt).alias("affected_dt"),
        F.count("*").alias("row_count"),
        F.countDistinct("hash_id").alias("distinct_hash_id_count"),
        count_where(is_blank("hash_id")).alias("empty_hash_id_count"),
        count_where(F.col("parent_id") == 0).alias("parent_row_count"),
        count_where(F.col("parent_id") != 0).alias("child_row_count"),
        count_where(is_blank("name_y")).alias("unmatched_seller_count"),
    )


# ---- reconciliation of one system with its own source ----------------------------


def recon_counts(source: DataFrame, target: DataFrame, dt: str, parent: str = "parent") -> DataFrame:
    """Four equalities between source and target measures, PASS or CHECK."""
    both = combine_one_row(source, target)
    ok = (
        (F.col("source_expanded_count") == F.col("target_row_count"))
        & (F.col(f"source_{parent}_count") == F.col(f"target_{parent}_count"))
        & (F.col("source_distinct_id_count") == F.col("source_expanded_count"))
        & (F.col("target_distinct_id_count") == F.col("target_row_count"))
    )
    return both.select(
        F.lit(dt).alias("affected_dt"),
        "source_expanded_count",
        "target_row_count",
        f"source_{parent}_count",
        f"target_{parent}_count",
        "source_distinct_id_count",
        "target_distinct_id_count",
        f"source_empty_item_{parent}_count",
        F.when(ok, "PASS").otherwise("CHECK").alias("count_and_key_check"),
    )


def recon_keys(target: DataFrame, id_col: str, parent_key: str, blanks: list[str], times: list[str]) -> DataFrame:
    """Null ids, blank business fields, duplicates and time bounds of the target."""
    return target.agg(
        F.count("*").alias("target_row_count"),
        count_where(F.col(id_col).isNull()).alias(f"null_{id_col}_count"),
        count_where(F.col(parent_key).isNull()).alias(f"null_{parent_key}_count"),
        *[count_where(is_blank(c)).alias(f"empty_{c}_count") for c in blanks],
        duplicate_rows(id_col).alias(f"duplicate_{id_col}_row_count"),
        *[b for t in times for b in time_bounds(t)],
    )


def recon_formula(target: DataFrame, formulas: dict[str, tuple[str, str]]) -> DataFrame:
    """Recompute stored differences and count the rows where they do not hold."""
    return target.agg(
        F.count("*").alias("target_row_count"),
        *[
            count_where(num0(diff) != num0(a) - num0(b)).alias(f"{diff}_mismatch_count")
            for diff, (a, b) in formulas.items()
        ],
    )


def recon_coverage(target: DataFrame, cols: list[str], rate_of: list[str]) -> DataFrame:
    """Unfilled enrichment columns, counts and rates."""
    return coverage(target, cols, rate_of).withColumnRenamed("row_count", "target_row_count")


def recon_distribution(target: DataFrame, cols: list[str], key: str, parent: str = "parent") -> DataFrame:
    """Row and parent counts per combination, largest first."""
    counted = distribution(target, cols, key, f"{parent}_count")
    return counted.orderBy(F.desc(f"{parent}_count"), F.desc("row_count"))


def recon_trend(
    target: DataFrame, dt: str, key: str, id_col: str, blank: str, time: str, n: int = 7, parent: str = "parent",
    days: DataFrame | None = None,
) -> DataFrame:
    """Measures of the last n landed partitions, newest first.

    The partitions are found once, from ``days`` if given. Distinct parents and distinct ids are computed
    apart and joined on the few partitions.
    """
    rows = recent_partitions(target, dt, n, days)
    main = partition_trend(
        rows,
        {
            "row_count": F.count("*"),
            "distinct_id_count": F.countDistinct(id_col),
            f"empty_{blank}_count": count_where(is_blank(blank)),
            f"earliest_{time}": F.min(time),
            f"latest_{time}": F.max(time),
        },
    )
    parents = partition_trend(rows, {f"{parent}_count": F.countDistinct(key)})
    return main.join(parents, "dt").orderBy(F.desc("dt"))


def trend_deviation(trend: DataFrame, measures: list[str]) -> DataFrame:
    """The newest partition against the mean and median of the earlier ones. A report, never a failure."""
    newest = trend.agg(F.max("dt").alias("_newest"))
    marked = trend.crossJoin(F.broadcast(newest))
    is_new = F.col("dt") == F.col("_newest")
    aggs = [F.max("_newest").alias("dt"), count_where(~is_new).alias("prior_partitions")]
    for m in measures:
        prior = F.when(~is_new, F.col(m))
        aggs += [
            F.max(F.when(is_new, F.col(m))).alias(m),
            F.avg(prior).alias(f"prior_mean_{m}"),
            F.median(prior).alias(f"prior_median_{m}"),
        ]
    out = marked.agg(*aggs)
    return out.select(
        "*",
        *[
            F.round(F.col(m) / F.nullif(F.col(f"prior_mean_{m}"), F.lit(0.0)), 4).alias(f"{m}_ratio")
            for m in measures
        ],
    )


# ---- tree acceptance --------------------------------------------------------------

# Metric names in the order the acceptance rules refer to them.
TREE_METRICS = {
    "01_envelope_count": "envelope_count",
    "02_declared_parent_count": "declared_count",
    "03_actual_parent_count": "actual_count",
    "04_source_node_count": "source_node_count",
    "05_source_distinct_hash_id_count": "source_distinct_hash_id_count",
    "06_source_empty_hash_id_count": "source_empty_hash_id_count",
    "07_source_parent_node_count": "source_parent_node_count",
    "08_source_child_node_count": "source_child_node_count",
    "09_source_expanded_row_count": "source_expanded_row_count",
    "10_source_expanded_parent_row_count": "source_expanded_parent_row_count",
    "11_source_expanded_child_row_count": "source_expanded_child_row_count",
    "12_target_row_count": "target_row_count",
    "13_target_distinct_hash_id_count": "target_distinct_hash_id_count",
    "14_target_empty_hash_id_count": "target_empty_hash_id_count",
    "15_target_null_sid_count": "target_null_sid_count",
    "16_target_parent_row_count": "target_parent_row_count",
    "17_target_child_row_count": "target_child_row_count",
    "18_unmatched_seller_count": "unmatched_seller_count",
    "19_invalid_node_type_count": "invalid_node_type_count",
    "20_inconsistent_fba_sale_days_count": "inconsistent_sale_days_count",
    "21_duplicate_grain_group_count": "duplicate_group_count",
    "22_duplicate_grain_excess_row_count": "duplicate_excess_row_count",
    "23_earliest_sync_time": "earliest_sync_time",
    "24_latest_sync_time": "latest_sync_time",
}

# What must hold. A number is a constant, a text refers to another metric.
TREE_RULES = (
    ("01", 1), ("02", "03"), ("04", "05"), ("06", 0), ("09", "12"), ("10", "16"), ("11", "17"), ("13", "05"),
    ("14", 0), ("15", 0), ("18", 0), ("19", 0), ("20", 0), ("21", 0), ("22", 0),
)

# A batch whose envelopes state its size proves its completeness by that, in any number of envelopes.
SHARDED_METRICS = {"25_stated_batch_count": "batch_count"}
SHARDED_RULES = (("25", "03"), *TREE_RULES[1:])


def expanded_rows() -> Column:
    """Detail rows of one node, from the lengths of its lists; an empty list keeps one row."""
    length = lambda c: F.greatest(F.coalesce(F.array_size(c), F.lit(0)), F.lit(1))
    return (length("basic_info.msku_fnsku_list") * length("suggest_info.suggest_sm_list")).cast("bigint")


def node_measures(nodes: DataFrame) -> DataFrame:
    """Counts over unfolded nodes with SKU and transport lists still unexpanded.

    The expanded row counts follow from the list lengths (an empty list keeps one row), so the
    node-by-SKU-by-transport product is never produced just to be counted.
    """
    rows = expanded_rows()
    is_parent, hash_id = F.col("is_parent") == 1, F.col("basic_info.hash_id")
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    return nodes.agg(
        F.count("*").alias("source_node_count"),
        F.countDistinct(hash_id).alias("source_distinct_hash_id_count"),
        count_where(is_blank(hash_id)).alias("source_empty_hash_id_count"),
        count_where(is_parent).alias("source_parent_node_count"),
        count_where(~is_parent).alias("source_child_node_count"),
        total(rows).alias("source_expanded_row_count"),
        total(F.when(is_parent, rows)).alias("source_expanded_parent_row_count"),
        total(F.when(~is_parent, rows)).alias("source_expanded_child_row_count"),
    )


def tree_target_measures(target: DataFrame) -> DataFrame:
    rows = target.agg(
        F.count("*").alias("target_row_count"),
        F.countDistinct("hash_id").alias("target_distinct_hash_id_count"),
        count_where(is_blank("hash_id")).alias("target_empty_hash_id_count"),
        count_where(F.col("sid").isNull()).alias("target_null_sid_count"),
        count_where(F.col("parent_id") == 0).alias("target_parent_row_count"),
        count_where(F.col("parent_id") != 0).alias("target_child_row_count"),
        count_where(is_blank("name_y")).alias("unmatched_seller_count"),
        count_where(not_in_domain("node_type", ["1", "2", "3", "4"])).alias("invalid_node_type_count"),
        count_where(null_safe_ne("available_sale_days_fba", "fba_available_sale_days")).alias(
            "inconsistent_sale_days_count"
        ),
        F.min("sync_time").alias("earliest_sync_time"),
        F.max("sync_time").alias("latest_sync_time"),
    )
    grain = {
        "hash_id": F.col("hash_id"),
        "msku": null_to("msku", ""),
        "fnsku": null_to("fnsku", ""),
        "listing_create_time": null_to("listing_create_time", ""),
        "sm_id": null_to("sm_id", -1),
    }
    return combine_one_row(rows, grain_duplicates(target, grain))


def recon_metrics_long(envelope: DataFrame, nodes: DataFrame, target: DataFrame, dt: str, sharded: bool = False) -> DataFrame:
    """The 24 acceptance metrics of a tree dataset as text rows, in name order; a 25th if the batch is ``sharded``.

    ``envelope`` is the envelope verdict frame, ``nodes`` the unfolded tree. ``TREE_RULES`` judge a batch in one envelope,
    ``SHARDED_RULES`` one whose envelopes state its size.
    """
    row = combine_one_row(combine_one_row(envelope, node_measures(nodes)), tree_target_measures(target))
    long = metrics_long(row, TREE_METRICS | (SHARDED_METRICS if sharded else {}))
    return long.select(F.lit(dt).alias("affected_dt"), "metric_name", "metric_value").orderBy("metric_name")


def apply_rules(metrics: DataFrame, rules=TREE_RULES) -> DataFrame:
    """Each rule with its two values and whether it holds; a missing metric never passes."""
    number = F.substring("metric_name", 1, 2)
    ids = sorted({i for pair in rules for i in pair if isinstance(i, str)})
    wide = metrics.agg(*[F.max(F.when(number == i, F.col("metric_value"))).alias(f"m{i}") for i in ids])

    def side(x):
        return F.col(f"m{x}") if isinstance(x, str) else F.lit(str(x))

    cells = [c for left, right in rules for c in (F.lit(f"{left}={right}"), side(left), side(right))]
    out = wide.select(F.stack(F.lit(len(rules)), *cells).alias("rule", "actual", "expected"))
    return out.withColumn("passed", F.coalesce(F.col("actual") == F.col("expected"), F.lit(False)))


