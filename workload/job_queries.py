"""Whole jobs (M1-M4), from landed files to published partitions."""

from __future__ import annotations

from pyspark.sql import functions as F

from landfall.functions import in_window
from landfall.plans.jobs import read_target, run_dynamic_dates, run_landing, run_parent_child, run_tree
from landfall.session import new_dir
from landfall.sources.envelopes import read_envelopes, write_envelopes
from landfall.sources.flat import read_flat
from landfall.spec import DatasetSpec
from workload.batches import (
    DETAIL_SQL,
    DT,
    EVENT_COLUMNS,
    NODES_SQL,
    PRICE,
    RESTOCK,
    SELLER_SQL,
    SHIP,
    SOURCE,
    SYNC,
    dealt,
    event_pages,
    land,
    listing,
    price_detail_sql,
    price_record,
    sellers,
    specs,
    tree_detail_sql,
)
from workload.metric_queries import QUALITY_SQL, QUALITY_TOUCHED_SQL, QUALITY_TREE_SQL
from workload.registry import query, table


def _ship(spark, sf):
    spec = land(spark, sf, SHIP)[SHIP]
    return spec, run_parent_child(spark, spec, DT, listing(spark, sf))


query("m1_parent_child", QUALITY_SQL.replace("empty_country_count", "listing_country_unmatched_count"))(lambda spark, sf: _ship(spark, sf)[1])
query("m1_parent_child_detail", f"WITH {DETAIL_SQL} SELECT *, '{DT}' AS dt FROM detail")(
    lambda spark, sf: read_target(spark, _ship(spark, sf)[0])
)


def _price(spark, sf):
    """Two pulls of 20 days; the second replaces the days it shares with the first."""
    spec = specs(new_dir(spark, "price") + "/raw", new_dir(spark, "price") + "/detail")[PRICE]
    events, report = table(spark, sf, "events"), None
    for dt in ("2024-01-20", "2024-01-30"):
        pulled = dealt(events.where(in_window("ts", dt, spec.window_days)).select(*EVENT_COLUMNS))
        write_envelopes(pulled.select(price_record(F.col).alias("rec")).select("rec.*"), spec.root, spec, dt, f"{dt} 06:00:00")
        report = run_dynamic_dates(spark, spec, dt)
    return spec, report


_BATCH_SYNC = "CASE WHEN ts >= DATE '2024-01-11' THEN TIMESTAMP '2024-01-30 06:00:00' ELSE TIMESTAMP '2024-01-20 06:00:00' END"
query("m2_dynamic_dates", QUALITY_TOUCHED_SQL.format(sync="2024-01-30 06:00:00") + " WHERE ts >= DATE '2024-01-11'")(
    lambda spark, sf: _price(spark, sf)[1]
)
query("m2_dynamic_dates_detail", price_detail_sql(_BATCH_SYNC))(lambda spark, sf: read_target(spark, _price(spark, sf)[0]))


def _restock(spark, sf):
    spec = land(spark, sf, RESTOCK)[RESTOCK]
    return spec, run_tree(spark, spec, DT, sellers(spark, sf))


def _tree_rows(spark, sf):
    target = read_target(spark, _restock(spark, sf)[0])
    whole = {c: F.col(c).cast("double") for c, t in target.dtypes if t.startswith("decimal")}
    # Positions depend on the file layout, so only the kind of parent is compared here; ids no
    # mode has are shown as text, which keeps whole numbers whole.
    kept = target.withColumns({**whole, "is_root": F.col("parent_id") == 0, "sm_id": F.col("sm_id").cast("string")})
    return kept.drop("parent_id", "dt")


query("m3_tree", QUALITY_TREE_SQL)(lambda spark, sf: _restock(spark, sf)[1])
query(
    "m3_tree_detail",
    f"WITH {NODES_SQL}, {SELLER_SQL}"
    + tree_detail_sql()
    .replace("CAST(c_acctbal AS DECIMAL(12,2))", "CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS DOUBLE)")
    .replace(" sm_id,", " CAST(sm_id AS VARCHAR) AS sm_id,"),
)(_tree_rows)


@query(
    "m3_tree_parents",
    f"""WITH {NODES_SQL} SELECT (SELECT count(*) FROM cust WHERE n > 0) AS parents, true AS consistent,
        '20240131' AS prefix, CAST(19 AS INT) AS digits""",
)
def m3_parents(spark, sf):
    """Children of one parent share one id, no two parents share it."""
    target = read_target(spark, _restock(spark, sf)[0]).where("parent_id <> 0")
    owner = F.regexp_extract("hash_id", "^h-([0-9]+)-", 1)
    pairs = target.select("parent_id", owner.alias("owner")).distinct()
    text = F.col("parent_id").cast("string")
    return pairs.agg(
        F.countDistinct("parent_id").alias("parents"),
        ((F.count("*") == F.countDistinct("parent_id")) & (F.count("*") == F.countDistinct("owner"))).alias("consistent"),
        F.max(F.substring(text, 1, 8)).alias("prefix"),
        F.max(F.length(text)).alias("digits"),
    )


# ---- landing ------------------------------------------------------------------------


@query(
    "m4_landing_shared",
    f"SELECT event_id AS id, user_id, value, '{DT}' AS biz_date, '{SYNC}' AS sync_time, '{DT}' AS dt FROM events",
)
def m4_shared(spark, sf):
    """One task for the whole dataset; flat records go to Parquet."""
    spec = DatasetSpec(
        name="events", source=SOURCE, root=new_dir(spark, "shared"), record_ddl="id BIGINT, user_id BIGINT, value DOUBLE"
    )
    run_landing(spark, spec, DT, event_pages(spark, sf, faults=False), SYNC, "id", est_rows=10**9)
    types = {"id": "bigint", "user_id": "bigint", "value": "double", "biz_date": "string", "sync_time": "string"}
    return read_flat(spark, spec.root, types, DT)


_NESTED = "id BIGINT, sid BIGINT, tags ARRAY<STRING>"


def _order_pages(spark, sf):
    """Orders as pages of one nation's key range."""
    customer = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    orders = table(spark, sf, "orders").join(customer, F.col("o_custkey") == F.col("c_custkey"))
    key, page = F.col("c_nationkey").cast("string"), F.call_function("div", F.col("o_orderkey"), F.lit(500)) + 1
    record = F.struct(
        F.col("o_orderkey").alias("id"), F.col("c_nationkey").cast("bigint").alias("sid"),
        F.array("o_orderstatus", "o_orderpriority").alias("tags"),
    )
    pages = orders.groupBy(key.alias("key"), page.alias("page_no")).agg(F.collect_list(record).alias("records"))
    totals = orders.groupBy(key.alias("key")).agg(F.count("*").alias("total"))
    return pages.join(totals, "key").select(
        "key", "page_no", ((F.col("page_no") - 1) * 500).alias("offset"), "total", "records"
    )


@query(
    "m4_landing_by_key",
    f"SELECT o_orderkey AS id, CAST(c_nationkey AS BIGINT) AS sid, o_orderstatus || ',' || o_orderpriority AS tags,"
    f" '{SYNC}' AS sync_time, 'orders_by_nation' AS dataset FROM orders JOIN customer ON c_custkey = o_custkey",
)
def m4_by_key(spark, sf):
    """One request per key of an upstream dataset of the same date."""
    base = new_dir(spark, "bykey")
    upstream = DatasetSpec(name="shop", source=SOURCE, root=f"{base}/shop", record_ddl="sid BIGINT, name STRING")
    shops = table(spark, sf, "customer").select(F.col("c_nationkey").cast("bigint").alias("sid"), F.col("c_name").alias("name"))
    write_envelopes(shops, upstream.root, upstream, DT, SYNC)
    spec = DatasetSpec(name="orders_by_nation", source=SOURCE, root=f"{base}/raw", record_ddl=_NESTED, window_days=90)
    run_landing(
        spark, spec, DT, _order_pages(spark, sf), SYNC, "id", upstream=upstream.root, manifest=f"{base}/manifest"
    )
    env = read_envelopes(spark, spec.root, spec.record_schema, DT)
    return env.select("sync_time", "dataset", F.inline("data")).withColumn("tags", F.array_join("tags", ","))


@query(
    "m4_landing_windowed",
    f"SELECT 'orders_pulled' AS dataset, '{DT}' AS dt, 'nested-json' AS storage, count(*) AS checked_count, count(*) AS landed_count FROM orders",
)
def m4_windowed(spark, sf):
    """One closed-window pull without upstream keys; the manifest row is the proof of publication."""
    base = new_dir(spark, "windowed")
    spec = DatasetSpec(name="orders_pulled", source=SOURCE, root=f"{base}/raw", record_ddl=_NESTED, window_days=15)
    run_landing(
        spark, spec, DT, _order_pages(spark, sf), SYNC, "id", closed_window=True, manifest=f"{base}/manifest"
    )
    return spark.read.parquet(f"{base}/manifest")
