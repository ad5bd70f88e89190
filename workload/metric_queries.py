"""Aggregations, quality output and single-system reconciliation."""

from __future__ import annotations

from pyspark.sql import functions as F

from landfall.functions import is_blank, null_to
from landfall.operators.aggregates import (
    count_where,
    distribution,
    duplicate_excess,
    duplicate_groups,
    duplicate_rows,
    grain_duplicates,
    metrics_long,
    metrics_wide,
    partition_trend,
    size0,
    sum0,
    time_bounds,
)
from landfall.operators.expand import explode_records, unfold_tree
from landfall.operators.guards import envelope_verdict
from landfall.operators.partitions import combine_one_row, touched_partitions
from landfall.operators.quality import (
    apply_rules,
    quality_parent_child,
    quality_touched,
    quality_tree,
    recon_counts,
    recon_coverage,
    recon_distribution,
    recon_formula,
    recon_keys,
    recon_metrics_long,
    recon_trend,
    source_measures,
    target_measures,
    trend_deviation,
)
from landfall.plans.jobs import dynamic_dates_detail, parent_child_detail, tree_detail
from landfall.plans.price_queue import partition_day
from landfall.plans.restocking import NODE_COLUMNS
from landfall.plans.shipments import FORMULAS
from landfall.session import Scratch, pin
from landfall.sources.envelopes import envelope_summary
from workload.batches import (
    DETAIL_SQL,
    DT,
    NODES_SQL,
    PRICE,
    RESTOCK,
    SELLER_SQL,
    SHIP,
    SHIP_SQL,
    SOURCE,
    SYNC,
    envelopes,
    listing,
    sellers,
    specs,
)
from workload.registry import query, table

BLANKS = ["shipment_id", "country", "parent_asin", "local_name"]
TIMES = ["gmt_create", "gmt_modified"]


def _records(spark, sf, name):
    return explode_records(envelopes(spark, sf, name), pos=True)


def _detail(spark, sf):
    return parent_child_detail(specs()[SHIP], _records(spark, sf, SHIP), listing(spark, sf))


def _both_sides(scratch, sf, kept=None):
    """Source records and their detail, each written once with the fields that are measured, because several distincts read it."""
    spark, spec = scratch.spark, specs()[SHIP]
    records = _records(spark, sf, SHIP)
    detail = parent_child_detail(spec, records, listing(spark, sf), scratch)
    detail = detail if kept is None else detail.where(kept)
    source = records.select(F.struct("rec.id", F.transform("rec.item_list", lambda i: F.struct(i["id"].alias("id"))).alias("item_list")).alias("rec"))
    target = detail.select("id", "relate_id", *BLANKS, *TIMES)
    return scratch.materialize(source, "records"), scratch.materialize(target, "detail")


def _nodes(spark, sf):
    rec = _records(spark, sf, RESTOCK)
    slim = rec.select(F.col("sync_time").alias("batch_sync_time"), F.col("pos").cast("bigint").alias("parent_pos"), "rec")
    return unfold_tree(slim, "item_list", NODE_COLUMNS)


# ---- F ------------------------------------------------------------------------------

query("f1_count", "SELECT count(*) AS n FROM lineitem")(
    lambda spark, sf: table(spark, sf, "lineitem").agg(F.count("*").alias("n"))
)
query("f2_count_distinct", "SELECT count(DISTINCT l_orderkey) AS orders, count(DISTINCT l_partkey) AS parts FROM lineitem")(
    lambda spark, sf: combine_one_row(
        table(spark, sf, "lineitem").agg(F.countDistinct("l_orderkey").alias("orders")),
        table(spark, sf, "lineitem").agg(F.countDistinct("l_partkey").alias("parts")),
    )
)
query(
    "f3_count_where",
    "SELECT l_orderkey, count(*) FILTER (l_returnflag = 'R') AS returned, count(*) FILTER (l_quantity > 40) AS large"
    " FROM lineitem GROUP BY l_orderkey",
)(
    lambda spark, sf: table(spark, sf, "lineitem")
    .groupBy("l_orderkey")
    .agg(count_where(F.col("l_returnflag") == "R").alias("returned"), count_where(F.col("l_quantity") > 40).alias("large"))
)


@query(
    "f4_sum_sizes",
    f"WITH {SHIP_SQL} SELECT (id - 1) // 500 AS shard_no, count(*) AS records, CAST(sum(n) AS BIGINT) AS items,"
    " count(*) AS declared FROM ship GROUP BY 1",
)
def f4(spark, sf):
    env = envelopes(spark, sf, SHIP)
    declared = env.groupBy("shard_no").agg(size0("data").alias("records"), sum0("record_count").alias("declared"))
    items = env.select("shard_no", F.explode("data").alias("r")).groupBy("shard_no").agg(size0("r.item_list").alias("items"))
    return declared.join(items, "shard_no")


query(
    "f5_time_bounds",
    "SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS earliest_ts, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS latest_ts"
    " FROM events GROUP BY user_id",
)(
    lambda spark, sf: table(spark, sf, "events")
    .select("user_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts"))
    .groupBy("user_id")
    .agg(*time_bounds("ts"))
)
query(
    "f6_distribution",
    "SELECT l_returnflag, l_linestatus, l_linenumber, count(*) AS row_count, count(DISTINCT l_orderkey) AS parent_count"
    " FROM lineitem GROUP BY ALL",
)(
    lambda spark, sf: distribution(
        table(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus", "l_linenumber"], "l_orderkey"
    )
)


@query(
    "f7_metrics_wide",
    "SELECT CAST(count(*) AS VARCHAR) AS n, CAST(count(DISTINCT o_custkey) AS VARCHAR) AS customers,"
    " CAST(NULL AS VARCHAR) AS absent FROM orders",
)
def f7(spark, sf):
    row = table(spark, sf, "orders").agg(F.count("*").alias("n"), F.countDistinct("o_custkey").alias("customers"))
    return metrics_wide(metrics_long(row, {"n": "n", "customers": "customers"}), ["n", "customers", "absent"])


_GRAIN = {
    "l_orderkey": lambda: F.col("l_orderkey"),
    "l_linenumber": lambda: F.col("l_linenumber"),
    "flag": lambda: null_to(F.nullif(F.col("l_returnflag"), F.lit("N")), ""),
}
_GROUPS_SQL = """SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag = 'N' THEN '' ELSE l_returnflag END AS flag,
  count(*) AS group_count FROM lineitem GROUP BY 1, 2, 3 HAVING count(*) > 1"""
_EXCESS_SQL = (
    f"SELECT count(*) AS duplicate_group_count, CAST(coalesce(sum(group_count - 1), 0) AS BIGINT) AS"
    f" duplicate_excess_row_count FROM ({_GROUPS_SQL})"
)


def _grain():
    return {n: make() for n, make in _GRAIN.items()}


query("f8_duplicate_groups", _GROUPS_SQL)(lambda spark, sf: duplicate_groups(table(spark, sf, "lineitem"), _grain()))
query("f9_duplicate_excess", _EXCESS_SQL)(
    lambda spark, sf: duplicate_excess(duplicate_groups(table(spark, sf, "lineitem"), _grain()))
)
query("f10_duplicate_rows", "SELECT count(*) - count(DISTINCT l_orderkey * 10 + l_linenumber) AS extra FROM lineitem")(
    lambda spark, sf: table(spark, sf, "lineitem").agg(
        duplicate_rows(F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("extra")
    )
)


@query(
    "f11_partition_trend",
    """SELECT strftime(ts, '%Y-%m-%d') AS dt, count(*) AS row_count, count(DISTINCT user_id) AS users,
       count(*) FILTER (event_type = 'view') AS views, min(event_id) AS first_id FROM events GROUP BY 1""",
)
def f11(spark, sf):
    days = table(spark, sf, "events").withColumn("dt", F.date_format("ts", "yyyy-MM-dd"))
    return partition_trend(
        days,
        {
            "row_count": F.count("*"),
            "users": F.countDistinct("user_id"),
            "views": count_where(F.col("event_type") == "view"),
            "first_id": F.min("event_id"),
        },
    )


# ---- K ------------------------------------------------------------------------------

_SOURCE_SQL = """src AS (SELECT count(*) AS source_expanded_count, count(DISTINCT id) AS source_shipment_count,
  count(*) FILTER (item_pos IS NULL) AS source_empty_item_shipment_count, count(DISTINCT tid) AS source_distinct_id_count FROM items)"""
_TARGET_SQL = """tgt AS (SELECT count(*) AS target_row_count, count(DISTINCT relate_id) AS target_shipment_count,
  count(DISTINCT id) AS target_distinct_id_count, count(*) FILTER (id IS NULL) AS target_null_id_count,
  count(*) FILTER (shipment_id IS NULL) AS empty_shipment_id_count, count(*) FILTER (country IS NULL) AS empty_country_count,
  count(*) FILTER (parent_asin IS NULL) AS empty_parent_asin_count,
  count(*) FILTER (local_name IS NULL) AS empty_local_name_count,
  min(gmt_create) AS earliest_gmt_create, max(gmt_create) AS latest_gmt_create,
  min(gmt_modified) AS earliest_gmt_modified, max(gmt_modified) AS latest_gmt_modified FROM detail)"""
QUALITY_SQL = f"WITH {DETAIL_SQL}, {_SOURCE_SQL}, {_TARGET_SQL} SELECT '{DT}' AS affected_dt, * FROM src, tgt"


@query("k1_quality_parent_child", QUALITY_SQL)
def k1(spark, sf):
    with Scratch(spark) as scratch:
        records, target = _both_sides(scratch, sf)
        return pin(quality_parent_child(records, target, DT, "item_list", "id", "relate_id", BLANKS, TIMES, "shipment"))


QUALITY_TOUCHED_SQL = """SELECT count(*) AS row_count, count(*) AS distinct_business_id_count, CAST(0 AS BIGINT) AS empty_business_id_count,
  count(DISTINCT event_id) AS distinct_id_count, CAST(0 AS BIGINT) AS null_id_count,
  strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS earliest_queue_create_time,
  strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS latest_queue_create_time, TIMESTAMP '{sync}' AS latest_update_time FROM events"""


@query("k2_quality_touched", QUALITY_TOUCHED_SQL.format(sync=SYNC))
def k2(spark, sf):
    records = _records(spark, sf, PRICE)
    touched = touched_partitions(records, partition_day())
    target = dynamic_dates_detail(specs()[PRICE], records)
    return quality_touched(target, touched, "business_id", "id", "queue_create_time", "update_time")


QUALITY_TREE_SQL = f"""WITH {NODES_SQL}, {SELLER_SQL} SELECT '{DT}' AS affected_dt, count(*) AS row_count,
  count(DISTINCT hash_id) AS distinct_hash_id_count, CAST(0 AS BIGINT) AS empty_hash_id_count,
  count(*) FILTER (is_parent = 1) AS parent_row_count, count(*) FILTER (is_parent = 0) AS child_row_count,
  count(*) FILTER (seller_name IS NULL) AS unmatched_seller_count FROM rows LEFT JOIN seller ON sid = c_nationkey"""


@query("k3_quality_tree", QUALITY_TREE_SQL)
def k3(spark, sf):
    target = tree_detail(specs()[RESTOCK], _nodes(spark, sf), sellers(spark, sf), DT)
    return quality_tree(target, DT)


# ---- L1-L7 --------------------------------------------------------------------------


@query(
    "l1_envelope_summary",
    f"""WITH {SHIP_SQL} SELECT count(DISTINCT (id - 1) // 500) AS envelope_row_count, '{SOURCE}' AS source,
        '{SHIP}' AS dataset, '{DT}' AS envelope_biz_date, count(*) AS declared_record_count, count(*) AS data_array_count,
        '{SYNC}' AS earliest_sync_time, '{SYNC}' AS latest_sync_time FROM ship""",
)
def l1(spark, sf):
    return envelope_summary(envelopes(spark, sf, SHIP), DT)


_COUNTS_SQL = f"""WITH {DETAIL_SQL}, {_SOURCE_SQL}, {_TARGET_SQL} SELECT '{DT}' AS affected_dt, source_expanded_count,
  target_row_count, source_shipment_count, target_shipment_count, source_distinct_id_count, target_distinct_id_count,
  source_empty_item_shipment_count, CASE WHEN source_expanded_count = target_row_count AND source_shipment_count = target_shipment_count
  AND source_distinct_id_count = source_expanded_count AND target_distinct_id_count = target_row_count
  THEN 'PASS' ELSE 'CHECK' END AS count_and_key_check FROM src, tgt"""


def _counts(spark, sf, kept=None):
    with Scratch(spark) as scratch:
        records, target = _both_sides(scratch, sf, kept)
        source = source_measures(records, "item_list", "id", parent="shipment")
        return pin(recon_counts(source, target_measures(target, "relate_id", BLANKS, TIMES, "shipment"), DT, "shipment"))


@query("l2_recon_counts", _COUNTS_SQL)
def l2(spark, sf):
    return _counts(spark, sf)


@query("l2_recon_counts_check", _COUNTS_SQL.replace("FROM detail)", "FROM detail WHERE msku IS NOT NULL)"))
def l2_check(spark, sf):
    return _counts(spark, sf, ~is_blank("msku"))


@query(
    "l3_recon_keys",
    f"""WITH {DETAIL_SQL} SELECT count(*) AS target_row_count, count(*) FILTER (id IS NULL) AS null_id_count,
        count(*) FILTER (relate_id IS NULL) AS null_relate_id_count, count(*) FILTER (shipment_id IS NULL) AS empty_shipment_id_count,
        count(*) FILTER (sid IS NULL) AS empty_sid_count, count(*) - count(DISTINCT id) AS duplicate_id_row_count,
        min(gmt_create) AS earliest_gmt_create, max(gmt_create) AS latest_gmt_create,
        min(gmt_modified) AS earliest_gmt_modified, max(gmt_modified) AS latest_gmt_modified FROM detail""",
)
def l3(spark, sf):
    return recon_keys(_detail(spark, sf), "id", "relate_id", ["shipment_id", "sid"], TIMES)


@query(
    "l4_recon_formula",
    f"""WITH {SHIP_SQL} SELECT count(*) AS target_row_count, CAST(0 AS BIGINT) AS aad_diff_mismatch_count,
        count(*) FILTER (st = 'F' AND qs IS NOT NULL) AS rad_diff_mismatch_count, CAST(0 AS BIGINT) AS aar_diff_mismatch_count FROM items""",
)
def l4(spark, sf):
    # Rows of closed shipments carry a wrong stored difference.
    wrong = (F.col("shipment_status") == "CLOSED") & F.col("quantity_shipped").isNotNull()
    shifted = (F.col("rad_diff").cast("bigint") + 1).cast("string")
    detail = _detail(spark, sf).withColumn("rad_diff", F.when(wrong, shifted).otherwise(F.col("rad_diff")))
    return recon_formula(detail, FORMULAS)


@query(
    "l5_recon_coverage",
    f"""WITH {DETAIL_SQL} SELECT count(*) AS target_row_count, count(*) FILTER (country IS NULL) AS empty_country_count,
        count(*) FILTER (asin IS NULL) AS empty_asin_count, count(*) FILTER (parent_asin IS NULL) AS empty_parent_asin_count,
        count(*) FILTER (local_name IS NULL) AS empty_local_name_count,
        CAST(round(100.0 * count(*) FILTER (country IS NULL) / count(*), 4) AS DOUBLE) AS empty_country_rate_pct FROM detail""",
)
def l5(spark, sf):
    return recon_coverage(_detail(spark, sf), ["country", "asin", "parent_asin", "local_name"], ["country"])


@query(
    "l6_recon_distribution",
    f"""WITH {DETAIL_SQL} SELECT shipment_status, shipping_mode, is_closed, count(*) AS row_count,
        count(DISTINCT relate_id) AS shipment_count FROM detail GROUP BY ALL ORDER BY shipment_count DESC, row_count DESC""",
)
def l6(spark, sf):
    return recon_distribution(_detail(spark, sf), ["shipment_status", "shipping_mode", "is_closed"], "relate_id", "shipment")


def _daily(spark, sf):
    events = table(spark, sf, "events")
    return events.select(
        F.date_format("ts", "yyyy-MM-dd").alias("dt"), "user_id", "event_id",
        F.when(F.col("event_type") != "view", F.col("event_type")).alias("kind"),
        F.date_format("ts", "yyyy-MM-dd HH:mm").alias("at"),
    )


_TREND_SQL = """d AS (SELECT strftime(ts, '%Y-%m-%d') AS dt, * FROM events),
  trend AS (SELECT dt, count(*) AS row_count, count(DISTINCT event_id) AS distinct_id_count,
    count(*) FILTER (event_type = 'view') AS empty_kind_count, strftime(min(ts), '%Y-%m-%d %H:%M') AS earliest_at,
    strftime(max(ts), '%Y-%m-%d %H:%M') AS latest_at, count(DISTINCT user_id) AS parent_count FROM d
  WHERE dt IN (SELECT DISTINCT dt FROM d WHERE dt <= '2024-01-28' ORDER BY dt DESC LIMIT 7) GROUP BY dt)"""


def _trend(spark, sf):
    return recon_trend(_daily(spark, sf), "2024-01-28", "user_id", "event_id", "kind", "at")


query("l7_recon_trend", f"WITH {_TREND_SQL} SELECT * FROM trend ORDER BY dt DESC")(_trend)


@query(
    "l17_trend_deviation",
    f"""WITH {_TREND_SQL}, p AS (SELECT count(*) AS prior_partitions, avg(row_count) AS mr, median(row_count) AS dr,
          avg(empty_kind_count) AS me, median(empty_kind_count) AS de FROM trend WHERE dt < (SELECT max(dt) FROM trend))
        SELECT dt, prior_partitions, row_count, mr AS prior_mean_row_count, CAST(dr AS DOUBLE) AS prior_median_row_count,
          empty_kind_count, me AS prior_mean_empty_kind_count, CAST(de AS DOUBLE) AS prior_median_empty_kind_count,
          round(row_count / mr, 4) AS row_count_ratio, round(empty_kind_count / me, 4) AS empty_kind_count_ratio
        FROM trend, p WHERE dt = (SELECT max(dt) FROM trend)""",
)
def l17(spark, sf):
    return trend_deviation(_trend(spark, sf), ["row_count", "empty_kind_count"])


# ---- L8-L10 -------------------------------------------------------------------------

_TREE_METRICS_SQL = f"""{NODES_SQL}, {SELLER_SQL},
  g AS (SELECT count(*) AS grp, coalesce(sum(c - 1), 0) AS excess FROM (
    SELECT count(*) AS c FROM rows GROUP BY hash_id, coalesce(msku, ''), coalesce(fnsku, ''), coalesce(opened, ''),
    coalesce(sm_id, -1) HAVING count(*) > 1)),
  n AS (SELECT count(*) AS nodes, count(DISTINCT hash_id) AS hashes, count(*) FILTER (is_parent = 1) AS parents,
    count(*) FILTER (is_parent = 0) AS children FROM nodes),
  r AS (SELECT count(*) AS total, count(*) FILTER (is_parent = 1) AS parents, count(*) FILTER (is_parent = 0) AS children,
    count(*) FILTER (seller_name IS NULL) AS unmatched FROM rows LEFT JOIN seller ON sid = c_nationkey),
  e AS (SELECT count(DISTINCT c_custkey // 500) AS envelopes, count(*) AS declared FROM customer),
  -- Fixed values: the names of the metrics, in the order of the report.
  metrics AS (SELECT unnest([
    ['01_envelope_count', CAST(e.envelopes AS VARCHAR)], ['02_declared_parent_count', CAST(e.declared AS VARCHAR)], ['03_actual_parent_count', CAST(e.declared AS VARCHAR)],
    ['04_source_node_count', CAST(n.nodes AS VARCHAR)], ['05_source_distinct_hash_id_count', CAST(n.hashes AS VARCHAR)], ['06_source_empty_hash_id_count', CAST(0 AS VARCHAR)],
    ['07_source_parent_node_count', CAST(n.parents AS VARCHAR)], ['08_source_child_node_count', CAST(n.children AS VARCHAR)],
    ['09_source_expanded_row_count', CAST(r.total AS VARCHAR)], ['10_source_expanded_parent_row_count', CAST(r.parents AS VARCHAR)],
    ['11_source_expanded_child_row_count', CAST(r.children AS VARCHAR)], ['12_target_row_count', CAST(r.total AS VARCHAR)],
    ['13_target_distinct_hash_id_count', CAST(n.hashes AS VARCHAR)], ['14_target_empty_hash_id_count', CAST(0 AS VARCHAR)], ['15_target_null_sid_count', CAST(0 AS VARCHAR)],
    ['16_target_parent_row_count', CAST(r.parents AS VARCHAR)], ['17_target_child_row_count', CAST(r.children AS VARCHAR)],
    ['18_unmatched_seller_count', CAST(r.unmatched AS VARCHAR)], ['19_invalid_node_type_count', CAST(0 AS VARCHAR)],
    ['20_inconsistent_fba_sale_days_count', CAST(0 AS VARCHAR)], ['21_duplicate_grain_group_count', CAST(g.grp AS VARCHAR)],
    ['22_duplicate_grain_excess_row_count', CAST(g.excess AS VARCHAR)], ['23_earliest_sync_time', CAST('2024-01-30 05:00:00' AS VARCHAR)],
    ['24_latest_sync_time', CAST('2024-01-30 05:00:00' AS VARCHAR)]]) AS m FROM g, n, r, e)"""


def _tree_metrics(spark, sf):
    env = envelope_verdict(envelopes(spark, sf, RESTOCK), specs()[RESTOCK], DT)
    nodes = _nodes(spark, sf)
    return recon_metrics_long(env, nodes, tree_detail(specs()[RESTOCK], nodes, sellers(spark, sf), DT), DT)


query(
    "l8_recon_metrics_long",
    f"WITH {_TREE_METRICS_SQL} SELECT '{DT}' AS affected_dt, m[1] AS metric_name, m[2] AS metric_value FROM metrics",
)(_tree_metrics)


@query(
    "l9_apply_rules",
    f"""WITH {_TREE_METRICS_SQL}, v AS (SELECT m[1][1:2] AS k, m[2] AS v FROM metrics),
      rules AS (SELECT unnest(['01=1', '02=03', '04=05', '06=0', '09=12', '10=16', '11=17', '13=05', '14=0', '15=0', '18=0',
        '19=0', '20=0', '21=0', '22=0']) AS rule)
      SELECT rule, a.v AS actual, coalesce(b.v, rule[4:]) AS expected, a.v = coalesce(b.v, rule[4:]) AS passed
      FROM rules JOIN v a ON a.k = rule[1:2] LEFT JOIN v b ON b.k = rule[4:]""",
)
def l9(spark, sf):
    return apply_rules(_tree_metrics(spark, sf))


query("l10_grain_duplicates", _EXCESS_SQL)(lambda spark, sf: grain_duplicates(table(spark, sf, "lineitem"), _grain()))

