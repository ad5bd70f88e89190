"""Expansion, newest rows, joins, ordering and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from landfall.functions import blank_to_null, day_of, in_window, technical_id
from landfall.operators.aggregates import coverage, metrics_long
from landfall.operators.expand import (
    expand_children,
    expand_records_children,
    expand_siblings,
    expand_zipped,
    explode_records,
    global_positions,
    unfold_tree,
)
from landfall.operators.latest import dedup, enrich_latest, latest_per_key
from landfall.operators.partitions import (
    combine_one_row,
    last_partitions,
    recent_partitions,
    touched_partitions,
    touched_target,
)
from landfall.plans.restocking import NODE_COLUMNS
from workload.batches import (
    LISTING_SQL,
    NODES_SQL,
    PRICE,
    RESTOCK,
    SELLER_SQL,
    SHIP,
    SHIP_SQL,
    envelopes,
    listing,
    sellers,
)
from workload.registry import query, table

# ---- D ------------------------------------------------------------------------------


@query("d1_explode_records", f"WITH {SHIP_SQL} SELECT id, sid, shipment_id FROM ship")
def d1(spark, sf):
    return explode_records(envelopes(spark, sf, SHIP)).select("rec.id", "rec.sid", "rec.shipment_id")


@query(
    "d2_explode_records_pos",
    "SELECT CAST(event_id AS VARCHAR) AS id, event_id // 500 AS shard_no,"
    " row_number() OVER (PARTITION BY event_id // 500 ORDER BY event_id) - 1 AS pos FROM events",
)
def d2(spark, sf):
    rows = explode_records(envelopes(spark, sf, PRICE), pos=True)
    return rows.select(F.col("rec.business_id").alias("id"), "shard_no", F.col("pos").cast("bigint"))


_ITEM_SQL = "SELECT id, coalesce(item_pos, -1) AS item_pos, msku, fnsku, coalesce(qs, -1) AS qs FROM items"


def _items(rows):
    return rows.select(
        "rec.id", F.coalesce("item_pos", F.lit(-1)).alias("item_pos"), blank_to_null("item.msku").alias("msku"),
        "item.fnsku", F.coalesce("item.quantity_shipped", F.lit(-1)).alias("qs"),
    )


@query("d3_expand_children", f"WITH {SHIP_SQL} {_ITEM_SQL}")
def d3(spark, sf):
    return _items(expand_children(explode_records(envelopes(spark, sf, SHIP)), "item_list"))


@query("d4_records_children", f"WITH {SHIP_SQL}, p AS ({_ITEM_SQL}) SELECT p.*, (id - 1) // 500 AS shard_no FROM p")
def d4(spark, sf):
    rows = expand_records_children(envelopes(spark, sf, SHIP), "item_list")
    return _items(rows).withColumn("shard_no", F.call_function("div", F.col("id") - 1, F.lit(500)))


@query(
    "d4_global_positions",
    "SELECT o_orderkey AS id, row_number() OVER (ORDER BY o_orderkey) - 1 AS global_pos FROM orders",
)
def d4_positions(spark, sf):
    rows = explode_records(envelopes(spark, sf, SHIP), pos=True).select("shard_no", "pos", (F.col("rec.id") - 1).alias("id"))
    return global_positions(rows).select("id", "global_pos")


def _tree(spark, sf):
    rec = explode_records(envelopes(spark, sf, RESTOCK), pos=True)
    return unfold_tree(rec.select("pos", "rec"), "item_list", NODE_COLUMNS)


@query(
    "d5_expand_siblings",
    f"WITH {NODES_SQL} SELECT hash_id, coalesce(k - 1, -1) AS sku_pos, coalesce(s - 1, -1) AS sm_pos, msku, 'Mode' || s AS mode FROM rows",
)
def d5(spark, sf):
    arrays = {"sku": "basic_info.msku_fnsku_list", "sm": "suggest_info.suggest_sm_list"}
    rows = expand_siblings(_tree(spark, sf), arrays)
    return rows.select(
        "basic_info.hash_id", *[F.coalesce(p, F.lit(-1)).cast("bigint").alias(p) for p in ("sku_pos", "sm_pos")],
        "sku.msku", F.col("sm.name").alias("mode"),
    )


@query(
    "d6_expand_zipped",
    f"WITH {NODES_SQL} SELECT DISTINCT hash_id, coalesce(k - 1, -1) AS sku_pos, msku, opened FROM rows",
)
def d6(spark, sf):
    rows = expand_zipped(
        _tree(spark, sf), "basic_info.msku_fnsku_list", "basic_info.listing_opentime_list", "sku", "opened"
    )
    position = F.coalesce("sku_pos", F.lit(-1)).cast("bigint").alias("sku_pos")
    return rows.select("basic_info.hash_id", position, "sku.msku", "opened")


_NODE_SQL = "SELECT hash_id, is_parent, coalesce(child_pos, -1) AS child_pos, CAST(nt AS BIGINT) AS node_type FROM nodes"


@query("d7_unfold_tree", f"WITH {NODES_SQL} {_NODE_SQL}")
def d7(spark, sf):
    return _tree(spark, sf).select(
        "basic_info.hash_id", "is_parent", F.coalesce("child_pos", F.lit(-1)).alias("child_pos"), "basic_info.node_type"
    )


@query("i1_union_all", f"WITH {NODES_SQL} {_NODE_SQL}")
def i1(spark, sf):
    """The same tree as two explicit levels stacked by name."""
    rec = explode_records(envelopes(spark, sf, RESTOCK)).select("rec")
    parents = rec.select(
        "rec.basic_info.hash_id", F.lit(1).cast("bigint").alias("is_parent"), F.lit(-1).cast("bigint").alias("child_pos"),
        "rec.basic_info.node_type",
    )
    children = rec.select(F.posexplode("rec.item_list").alias("child_pos", "child")).select(
        "child.basic_info.node_type", "child.basic_info.hash_id", F.col("child_pos").cast("bigint"),
        F.lit(0).cast("bigint").alias("is_parent"),
    )
    return parents.unionByName(children)


# ---- G, E ---------------------------------------------------------------------------


@query(
    "g1_latest_per_key",
    f"WITH {LISTING_SQL} SELECT sid, seller_sku, asin, create_time, id FROM newest",
)
def g1(spark, sf):
    keys = [F.col("sid"), blank_to_null("seller_sku"), blank_to_null("fnsku")]
    newest = latest_per_key(listing(spark, sf), keys, ["create_time", "id"])
    return newest.select("sid", F.trim("seller_sku").alias("seller_sku"), "asin", "create_time", "id")


@query(
    "g2_dedup_technical",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, strftime(l_shipdate, '%Y-%m-%d') AS shipped FROM (
         SELECT *, row_number() OVER (PARTITION BY l_orderkey * 10 + l_linenumber
           ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC) AS rn FROM lineitem) WHERE rn = 1""",
)
def g2(spark, sf):
    key = F.col("l_orderkey") * 10 + F.col("l_linenumber")
    newest = dedup(table(spark, sf, "lineitem"), key, ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity"])
    shipped = F.date_format("l_shipdate", "yyyy-MM-dd").alias("shipped")
    return newest.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", shipped)


@query(
    "g3_dedup_business",
    """SELECT key, event_id FROM (SELECT user_id || '-' || event_type AS key, event_id, row_number() OVER (
         PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1""",
)
def g3(spark, sf):
    events = table(spark, sf, "events").withColumn("key", F.concat_ws("-", "user_id", "event_type"))
    return dedup(events, "key", ["ts", "event_id"]).select("key", "event_id")


@query(
    "e1_enrich_latest",
    f"WITH {SHIP_SQL}, {LISTING_SQL} SELECT tid, i.msku, d.marketplace, coalesce(d.asin, i.own_asin) AS asin, d.parent_asin"
    " FROM items i LEFT JOIN newest d ON d.sid = i.sid AND d.seller_sku = i.msku AND d.fnsku = i.fnsku",
)
def e1(spark, sf):
    rows = expand_children(explode_records(envelopes(spark, sf, SHIP)), "item_list").select(
        technical_id("item_pos", "rec.id", "item.id").alias("tid"), "rec.sid", blank_to_null("item.msku").alias("msku"),
        blank_to_null("item.fnsku").alias("fnsku"), blank_to_null("item.asin").alias("own"),
    )
    joined = enrich_latest(
        rows, listing(spark, sf),
        on={"sid": F.col("sid"), "seller_sku": F.col("msku"), "fnsku": F.col("fnsku")},
        order=["create_time", "id"],
        dim_keys={"seller_sku": blank_to_null("seller_sku"), "fnsku": blank_to_null("fnsku")},
        cols={"marketplace": blank_to_null("marketplace"), "dim_asin": F.col("asin"), "parent_asin": blank_to_null("parent_asin")},
    )
    return joined.select("tid", "msku", "marketplace", F.coalesce("dim_asin", "own").alias("asin"), "parent_asin")


@query(
    "e2_enrich_cast",
    f"WITH {NODES_SQL}, {SELLER_SQL} SELECT hash_id, seller_name AS name_y, country FROM nodes LEFT JOIN seller ON sid = c_nationkey",
)
def e2(spark, sf):
    joined = enrich_latest(
        _tree(spark, sf), sellers(spark, sf),
        on={"sid": F.col("basic_info.sid").try_cast("bigint")}, order=["create_time", "id"],
        cols={"name_y": blank_to_null("name"), "country": blank_to_null("country")},
    )
    return joined.select("basic_info.hash_id", "name_y", "country")


def _days(spark, sf):
    return table(spark, sf, "events").select("event_id", "user_id", "ts", F.date_format("ts", "yyyy-MM-dd").alias("dt"))


@query("e3_touched_target", "SELECT event_id, strftime(ts, '%Y-%m-%d') AS dt FROM events WHERE ts >= DATE '2024-01-11'")
def e3(spark, sf):
    target = _days(spark, sf)
    touched = touched_partitions(target.where(in_window("ts", "2024-01-30", 20)), F.col("dt"))
    return touched_target(target, touched).select("event_id", "dt")


@query(
    "e4_combine_one_row",
    "SELECT (SELECT count(*) FROM orders) AS orders, (SELECT count(*) FROM lineitem) AS lines",
)
def e4(spark, sf):
    return combine_one_row(
        table(spark, sf, "orders").agg(F.count("*").alias("orders")),
        table(spark, sf, "lineitem").agg(F.count("*").alias("lines")),
    )


_RECENT = "(SELECT DISTINCT dt FROM d WHERE dt <= '2024-01-25' ORDER BY dt DESC LIMIT 7)"


@query(
    "e5_recent_partitions",
    f"WITH d AS (SELECT *, strftime(ts, '%Y-%m-%d') AS dt FROM events) SELECT event_id, dt FROM d WHERE dt IN {_RECENT}",
)
def e5(spark, sf):
    return recent_partitions(_days(spark, sf), "2024-01-25", 7).select("event_id", "dt")


@query(
    "e6_coverage",
    f"WITH {SHIP_SQL} SELECT count(*) AS row_count, count(*) FILTER (msku IS NULL) AS empty_msku_count,"
    " count(*) FILTER (own_asin IS NULL) AS empty_asin_count,"
    " CAST(round(100.0 * count(*) FILTER (msku IS NULL) / count(*), 4) AS DOUBLE) AS empty_msku_rate_pct FROM items",
)
def e6(spark, sf):
    rows = expand_children(explode_records(envelopes(spark, sf, SHIP)), "item_list").select("item.msku", "item.asin")
    return coverage(rows, ["msku", "asin"], ["msku"])


# ---- H, I2 --------------------------------------------------------------------------


@query(
    "h1_sort_desc",
    "SELECT o_orderstatus, o_orderpriority, count(*) AS n, count(DISTINCT o_custkey) AS customers FROM orders"
    " GROUP BY ALL ORDER BY customers DESC, n DESC",
)
def h1(spark, sf):
    grouped = table(spark, sf, "orders").groupBy("o_orderstatus", "o_orderpriority")
    counted = grouped.agg(F.count("*").alias("n"), F.countDistinct("o_custkey").alias("customers"))
    return counted.orderBy(F.desc("customers"), F.desc("n"))


@query(
    "h2_last_partitions",
    f"WITH d AS (SELECT strftime(ts, '%Y-%m-%d') AS dt FROM events) SELECT dt FROM {_RECENT}",
)
def h2(spark, sf):
    return last_partitions(_days(spark, sf), "2024-01-25", 7)


@query("h3_touched_partitions", "SELECT DISTINCT strftime(ts, '%Y-%m-%d') AS dt FROM events WHERE event_type <> 'view'")
def h3(spark, sf):
    rec = explode_records(envelopes(spark, sf, PRICE))
    return touched_partitions(rec, day_of("rec.create_time"), F.col("rec.local_name") != "view")


_METRICS_SQL = """WITH m AS (SELECT count(*) AS n, count(DISTINCT user_id) AS users, min(event_id) AS first FROM events)
  SELECT '01_rows' AS metric_name, CAST(n AS VARCHAR) AS metric_value FROM m
  UNION ALL SELECT '02_users', CAST(users AS VARCHAR) FROM m UNION ALL SELECT '03_first', CAST(first AS VARCHAR) FROM m"""


def _metrics(spark, sf):
    row = table(spark, sf, "events").agg(
        F.count("*").alias("n"), F.countDistinct("user_id").alias("users"), F.min("event_id").alias("first")
    )
    return metrics_long(row, {"03_first": "first", "01_rows": "n", "02_users": "users"})


@query("i2_metrics_long", _METRICS_SQL)
def i2(spark, sf):
    return _metrics(spark, sf)


@query("h5_metrics_sorted", _METRICS_SQL + " ORDER BY metric_name")
def h5(spark, sf):
    return _metrics(spark, sf).orderBy("metric_name")
