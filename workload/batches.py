"""Nested batches derived row by row from the given tables.

Every record is built from one table row: its child arrays come from ``sequence`` over counts
the row itself determines. Nothing is grouped to build a record, so no key can make one large,
and the batch grows with the table. The SQL texts below describe the same batches flat.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landfall.plans.price_queue import price_queue_spec
from landfall.plans.restocking import AMAZON, DATES, DAYS, SCM, restocking_spec
from landfall.plans.shipments import shipment_spec
from landfall.session import new_dir
from landfall.sources.envelopes import write_envelopes
from workload.registry import table

DT = "2024-01-31"
SYNC = "2024-01-31 06:00:00"
SOURCE = "erp"
SHIP, PRICE, RESTOCK = "shipment", "price_change", "restocking"


def specs(root: str = "", target: str = "") -> dict:
    """Sharded specs of the three datasets."""
    return {
        SHIP: shipment_spec(SOURCE, SHIP, f"{root}/{SHIP}", f"{target}/{SHIP}", max_envelopes=None),
        PRICE: price_queue_spec(SOURCE, PRICE, f"{root}/{PRICE}", f"{target}/{PRICE}", window_days=20),
        RESTOCK: restocking_spec(
            SOURCE, RESTOCK, f"{root}/{RESTOCK}", f"{target}/{RESTOCK}", max_envelopes=None, position_width=11
        ),
    }


def upto(n, build):
    """Array of ``build(1) … build(n)``; empty for n = 0 (a bare sequence would count down)."""
    return F.when(n > 0, F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), build)).otherwise(
        F.slice(F.transform(F.array(F.lit(1)), build), 1, 0)
    )


def text(*parts):
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def choose(value, mapping: dict, default=None):
    out = F
    for k, v in mapping.items():
        out = out.when(value == k, v if hasattr(v, "cast") else F.lit(v))
    return out.otherwise(default if hasattr(default, "cast") else F.lit(default))


def dealt(df: DataFrame) -> DataFrame:
    """The few columns of a table over all cores: a small or coarsely cut file would else be built into records by a few tasks."""
    return df.repartition(3 * df.sparkSession.sparkContext.defaultParallelism)


# ---- shipments: one per order, 0 to 4 items by priority ---------------------------

SHIP_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority"]


def ship_record(c):
    """The record struct of one order; ``c`` maps a column name to a column."""
    key, cust, status = c("o_orderkey"), c("o_custkey"), c("o_orderstatus")
    shop = F.substring(c("o_orderpriority"), 1, 1).cast("int")
    day = F.date_format(c("o_orderdate"), "yyyy-MM-dd")

    def item(j):
        return F.struct(
            ((key + 1) * 1000 + j).alias("id"),
            F.when(j == 4, F.lit("  ")).otherwise(text(" SKU-", cust + j)).alias("msku"),
            text("FN-", cust + j).alias("fnsku"),
            F.when(j == 3, F.lit("")).otherwise(text("A-", cust + j)).alias("asin"),
            text("L-", j).alias("sku"),
            (cust + j).alias("quantity_shipped"),
            F.when(j != 2, (j * 10).cast("bigint")).alias("quantity_received"),
            cust.alias("quantity_shipped_local"),
            choose(status, {"O": ""}, "SELLER").alias("prep_labelowner"),
            F.when(j != 2, upto(j - 2, lambda p: F.struct(text("PL-", key, "-", j, "-", p).alias("shipment_plan_sn")))).alias(
                "shipment_plan_list"
            ),
        )

    items = F.when((shop == 1) & (status == "F"), None).otherwise(upto(shop - 1, item))
    empty = F.lit(" ")
    address = [
        text(" Name ", cust).alias("name"),
        choose(status, {"F": "US"}, "").alias("country_code"),
        empty.alias("state_or_province_code"),
        text("City ", shop).alias("city"),
        F.lit(None).cast("string").alias("address_line1"),
        text("P", cust).alias("postal_code"),
    ]
    return F.struct(
        (key + 1).alias("id"),
        shop.cast("bigint").alias("sid"),
        choose(shop, {5: "  "}, text(" Shop ", shop)).alias("seller"),
        choose(status, {"P": None}, "clerk ").alias("username"),
        text("SH", key).alias("shipment_id"),
        text("Order ", key).alias("shipment_name"),
        choose(status, {"F": 0, "O": 1}, 2).cast("bigint").alias("is_closed"),
        choose(status, {"F": "CLOSED", "O": "WORKING"}, "SHIPPED").alias("shipment_status"),
        text(day, " 09:15:00").alias("gmt_modified"),
        text(day, " 08:30").alias("gmt_create"),
        choose(status, {"F": " GROUND_SMALL_PARCEL", "O": "FREIGHT_LTL"}, "AIR").alias("shipping_mode"),
        F.lit("").alias("alpha_name"),
        text("R", key).alias("reference_id"),
        day.alias("working_time"),
        choose(status, {"P": day}, " ").alias("shipped_time"),
        F.lit(None).cast("string").alias("receiving_time"),
        choose(status, {"F": day}, "").alias("closed_time"),
        items.alias("item_list"),
        F.struct(*address, text("T", cust).alias("phone")).alias("ship_from_address"),
        F.struct(*address, F.lit("").alias("doorplate")).alias("ship_to_address"),
    )


def ship_records(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(ship_record(F.col).alias("rec")).select("rec.*")


# Flat description: ``ship`` is one row per record, ``items`` the outer expansion.
SHIP_SQL = """
ship AS (
  SELECT o_orderkey + 1 AS id, CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS sid,
         CAST(substr(o_orderpriority, 1, 1) AS INT) - 1 AS n, o_orderkey, o_custkey, o_orderstatus AS st,
         'SH' || o_orderkey AS shipment_id, strftime(o_orderdate, '%Y-%m-%d') AS day
  FROM orders),
items AS (
  SELECT s.*, CAST(r.j - 1 AS INT) AS item_pos, s.id * 1000 + r.j AS item_id,
         CASE WHEN r.j = 4 THEN NULL WHEN r.j IS NOT NULL THEN 'SKU-' || (o_custkey + r.j) END AS msku,
         'FN-' || (o_custkey + r.j) AS fnsku,
         CASE WHEN r.j = 3 THEN NULL ELSE 'A-' || (o_custkey + r.j) END AS own_asin,
         'L-' || r.j AS sku, o_custkey + r.j AS qs, CASE WHEN r.j <> 2 THEN r.j * 10 END AS qr,
         CASE WHEN r.j IS NOT NULL THEN o_custkey END AS ql,
         CASE WHEN r.j IS NOT NULL AND st <> 'O' THEN 'SELLER' END AS prep,
         CASE WHEN r.j IS NULL THEN 0 - s.id ELSE s.id * 1000 + r.j END AS tid
  FROM ship s LEFT JOIN (SELECT unnest(range(1, 5)) AS j) r ON r.j <= s.n)
"""


def listing(spark: SparkSession, sf: str) -> DataFrame:
    """Listing history: every order line is a version of its (shop, part) listing."""
    li = table(spark, sf, "lineitem")
    return li.select(
        F.col("l_linenumber").cast("bigint").alias("sid"),
        text(" SKU-", F.col("l_partkey"), " ").alias("seller_sku"),
        text("FN-", F.col("l_partkey")).alias("fnsku"),
        text("LA-", F.col("l_suppkey")).alias("asin"),
        choose(F.col("l_linestatus"), {"O": " "}, text("PA-", F.col("l_suppkey"))).alias("parent_asin"),
        text("Part ", F.col("l_returnflag")).alias("local_name"),
        choose(F.col("l_returnflag"), {"N": ""}, F.col("l_returnflag")).alias("marketplace"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("create_time"),
        (F.col("l_orderkey") * 1_000_000 + F.col("l_suppkey")).alias("id"),
    )


LISTING_SQL = """
listing AS (
  SELECT CAST(l_linenumber AS BIGINT) AS sid, 'SKU-' || l_partkey AS seller_sku, 'FN-' || l_partkey AS fnsku,
         'LA-' || l_suppkey AS asin, CASE WHEN l_linestatus <> 'O' THEN 'PA-' || l_suppkey END AS parent_asin,
         'Part ' || l_returnflag AS local_name, CASE WHEN l_returnflag <> 'N' THEN l_returnflag END AS marketplace,
         strftime(l_shipdate, '%Y-%m-%d') AS create_time, l_orderkey * 1000000 + l_suppkey AS id
  FROM lineitem),
newest AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY sid, seller_sku, fnsku
                 ORDER BY create_time DESC, id DESC) AS rn FROM listing) WHERE rn = 1)
"""

# The shipment detail rows, columns of the contract.
DETAIL_SQL = f"""
{SHIP_SQL}, {LISTING_SQL}, detail AS (
  SELECT i.tid AS id, i.id AS relate_id, '{SYNC}' AS create_time, i.shipment_id, CAST(i.sid AS VARCHAR) AS sid,
    CASE WHEN i.sid <> 5 THEN 'Shop ' || i.sid END AS seller, d.marketplace AS country,
    'Order ' || o_orderkey AS shipment_name,
    CASE st WHEN 'F' THEN '小包裹快递（SPD）' WHEN 'O' THEN '汽运零担（LTL）' ELSE 'AIR' END AS shipping_mode,
    CAST(NULL AS VARCHAR) AS alpha_name,
    CASE st WHEN 'F' THEN 'CLOSED' WHEN 'O' THEN 'WORKING' ELSE 'SHIPPED' END AS shipment_status,
    day AS working_time, CASE WHEN st = 'P' THEN day END AS shipped_time, CAST(NULL AS VARCHAR) AS receiving_time,
    CASE WHEN st = 'F' THEN day END AS closed_time,
    CASE st WHEN 'F' THEN '进行中' WHEN 'O' THEN '已完成' ELSE '2' END AS is_closed,
    'R' || o_orderkey AS reference_id, CASE WHEN st <> 'P' THEN 'clerk' END AS username,
    day || ' 08:30' AS gmt_create, day || ' 09:15:00' AS gmt_modified, i.msku, i.fnsku,
    coalesce(d.asin, i.own_asin) AS asin, d.parent_asin, d.local_name, i.sku,
    CAST(qs AS VARCHAR) AS quantity_shipped, CAST(ql AS VARCHAR) AS quantity_shipped_local,
    CAST(qr AS VARCHAR) AS quantity_received, prep AS prep_labelowner,
    CAST(coalesce(qs, 0) - coalesce(ql, 0) AS VARCHAR) AS aad_diff,
    CAST(coalesce(qr, 0) - coalesce(ql, 0) AS VARCHAR) AS rad_diff,
    CAST(coalesce(qs, 0) - coalesce(qr, 0) AS VARCHAR) AS aar_diff,
    'Name ' || o_custkey AS ship_from_name, 'T' || o_custkey AS ship_from_phone,
    'P' || o_custkey AS ship_from_postal_code, CASE WHEN st = 'F' THEN 'US' END AS ship_from_country_code,
    CAST(NULL AS VARCHAR) AS ship_from_state_or_province_code, 'City ' || i.sid AS ship_from_city,
    CAST(NULL AS VARCHAR) AS ship_from_address_line1, 'Name ' || o_custkey AS ship_to_name,
    'P' || o_custkey AS ship_to_postal_code, CASE WHEN st = 'F' THEN 'US' END AS ship_to_country_code,
    CAST(NULL AS VARCHAR) AS ship_to_state_or_province_code, 'City ' || i.sid AS ship_to_city,
    CAST(NULL AS VARCHAR) AS ship_to_address_line1, CAST(NULL AS VARCHAR) AS ship_to_doorplate
  FROM items i LEFT JOIN newest d ON d.sid = i.sid AND d.seller_sku = i.msku AND d.fnsku = i.fnsku)
"""


# ---- price changes: one per event -------------------------------------------------

EVENT_COLUMNS = ["event_id", "ts", "user_id", "event_type", "value"]


def price_record(c):
    kind, user, event = c("event_type"), c("user_id"), c("event_id")
    at = F.date_format(c("ts"), "yyyy-MM-dd HH:mm:ss")
    price = c("value").cast("decimal(12,2)").cast("string")
    null = F.lit(None).cast("string")

    def change(icon):
        return F.struct(
            price.alias("standard_price"), F.lit(" ").alias("sale_price"), null.alias("sale_time_range"),
            F.lit(icon).alias("icon"),
        )

    return F.struct(
        event.cast("string").alias("business_id"),
        at.alias("create_time"),
        choose(kind, {"error": "  "}, at).alias("finish_time"),
        user.alias("sid"),
        choose(kind, {"purchase": 1}, 2).cast("bigint").alias("adjust_type"),
        F.lit(0).cast("bigint").alias("can_audit"),
        F.length(kind).cast("bigint").alias("processing_status"),
        kind.alias("processing_status_text"),
        choose(kind, {"error": " timeout "}, "").alias("failure_reason"),
        text("user-", user).alias("create_user"),
        text(" Store ", user).alias("store_name"),
        choose(kind, {"view": None}, "US").alias("marketplace"),
        text("SKU-", event).alias("msku"),
        F.lit("").alias("fnsku"),
        null.alias("asin"),
        null.alias("asin_url"),
        null.alias("small_image_url"),
        text("L", user).alias("local_sku"),
        kind.alias("local_name"),
        F.struct(
            price.alias("standard_price_profit"), F.lit("0.1").alias("standard_price_profit_rate"),
            F.lit("").alias("sale_price_profit"), null.alias("sale_price_profit_rate"),
            F.lit("$").alias("currency_icon"),
        ).alias("profit_estimate"),
        change("$").alias("adjust_before_obj"),
        change(" ").alias("adjust_after_obj"),
        F.struct(F.lit("1").alias("standard_price"), F.lit("").alias("sale_price")).alias("adjust_range"),
        F.array(price, F.lit("x")).alias("adjust_before"),
        F.when(kind != "error", F.array(price)).alias("adjust_after"),
        F.array(F.create_map(F.lit("type"), kind, F.lit("note"), null)).alias("audit_info"),
    )


def price_records(spark: SparkSession, sf: str) -> DataFrame:
    return dealt(table(spark, sf, "events").select(*EVENT_COLUMNS)).select(price_record(F.col).alias("rec")).select("rec.*")


def price_detail_sql(sync: str) -> str:
    """The price-change detail rows of a batch synced at ``sync`` (a SQL expression)."""
    return f"""
  SELECT event_id AS id, event_id AS relate_id, CAST(0 AS BIGINT) AS delete_flag, 'SKU-' || event_id AS msku,
    'L' || user_id AS local_sku, CAST(NULL AS VARCHAR) AS fnsku, CAST(NULL AS VARCHAR) AS asin,
    event_type AS local_name, 'Store ' || user_id AS store_name,
    CASE WHEN event_type <> 'view' THEN 'US' END AS marketplace, event_type AS processing_status_text,
    CAST(CASE WHEN event_type = 'purchase' THEN 1 ELSE 2 END AS BIGINT) AS adjust_type,
    strftime(ts, '%Y-%m-%d %H:%M:%S') AS queue_create_time,
    CASE WHEN event_type <> 'error' THEN strftime(ts, '%Y-%m-%d %H:%M:%S') END AS finish_time,
    user_id AS sid, CAST(length(event_type) AS BIGINT) AS processing_status, 'user-' || user_id AS create_user,
    CAST(NULL AS VARCHAR) AS asin_url, CAST(event_id AS VARCHAR) AS business_id, CAST(0 AS BIGINT) AS can_audit,
    CAST(NULL AS VARCHAR) AS small_image_url, CASE WHEN event_type = 'error' THEN 'timeout' END AS failure_reason,
    '$' AS currency_icon, price AS profit_estimate_standard_price_profit,
    '0.1' AS profit_estimate_standard_price_profit_rate, CAST(NULL AS VARCHAR) AS profit_estimate_sale_price_profit,
    CAST(NULL AS VARCHAR) AS profit_estimate_sale_price_profit_rate,
    price AS adjust_before_obj_standard_price, CAST(NULL AS VARCHAR) AS adjust_before_obj_sale_price,
    CAST(NULL AS VARCHAR) AS adjust_before_obj_sale_time_range, '$' AS adjust_before_obj_icon,
    price AS adjust_after_obj_standard_price, CAST(NULL AS VARCHAR) AS adjust_after_obj_sale_price,
    CAST(NULL AS VARCHAR) AS adjust_after_obj_sale_time_range, CAST(NULL AS VARCHAR) AS adjust_after_obj_icon,
    '1' AS adjust_range_standard_price, CAST(NULL AS VARCHAR) AS adjust_range_sale_price,
    '["' || price || '","x"]' AS adjust_before,
    CASE WHEN event_type <> 'error' THEN '["' || price || '"]' END AS adjust_after,
    '[{{"type":"' || event_type || '","note":null}}]' AS audit_info,
    CAST({sync} AS TIMESTAMP) AS backup_time, CAST({sync} AS TIMESTAMP) AS ods_update_time,
    CAST({sync} AS TIMESTAMP) AS create_time, CAST({sync} AS TIMESTAMP) AS update_time,
    strftime(ts, '%Y-%m-%d') AS dt
  FROM (SELECT *, CAST(CAST(value AS DECIMAL(12,2)) AS VARCHAR) AS price FROM events)"""


# ---- restocking: one tree per customer --------------------------------------------

CUSTOMER_COLUMNS = ["c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment"]
CHILDREN = {"BUILDING": 1, "FURNITURE": 2, "HOUSEHOLD": 3}
MODES = {"AUTOMOBILE": 3, "BUILDING": 2, "FURNITURE": 1, "MACHINERY": 1}
NODE_TYPES = {"AUTOMOBILE": 1, "BUILDING": 2, "FURNITURE": 3, "HOUSEHOLD": 4}


def _node(c, hash_id, skus, modes, node_type):
    nation, balance = c("c_nationkey").cast("bigint"), c("c_acctbal")

    def sku(k):
        return F.struct(
            text("M-", hash_id, "-", k).alias("msku"), choose(k, {2: " "}, text("F-", k)).alias("fnsku")
        )

    def mode(k):
        return F.struct(
            choose(k, {1: text(" ", k, " "), 2: text("x", k)}).cast("string").alias("sm_id"),
            text("Mode", k).alias("name"),
            F.when(k != 1, (k * 10).cast("bigint")).alias("quantity_sug_purchase"),
            k.cast("bigint").alias("quantity_sug_local_to_fba"),
            F.lit(None).cast("bigint").alias("quantity_sug_local_to_oversea"),
        )

    basic = F.struct(
        F.lit(2).cast("bigint").alias("data_type"),
        node_type.cast("bigint").alias("node_type"),
        nation.cast("string").alias("sid"),
        text("P-", c("c_custkey")).alias("asin"),
        upto(skus, sku).alias("msku_fnsku_list"),
        upto(skus - 1, lambda k: text("2024-01-0", k)).alias("listing_opentime_list"),
        F.lit("2024-01-30 05:00:00").alias("sync_time"),
        hash_id.alias("hash_id"),
    )
    sales = [balance.alias(f"sales_avg_{d}") for d in DAYS] + [(nation + d).alias(f"sales_total_{d}") for d in DAYS]
    suggest = F.struct(
        F.lit(0).cast("bigint").alias("out_stock_flag"),
        (nation + 1).alias("estimated_sale_quantity"),
        balance.alias("estimated_sale_avg_quantity"),
        balance.alias("available_sale_days"),
        balance.alias("fba_available_sale_days"),
        (nation + 100).alias("quantity_sug_purchase"),
        (nation + 200).alias("quantity_sug_local_to_fba"),
        (nation + 300).alias("quantity_sug_local_to_oversea"),
        nation.alias("quantity_sug_oversea_to_fba"),
        *[text("2024-02-0", F.lit(i)).alias(d) for i, d in enumerate(DATES, 1)],
        F.when(modes > 0, upto(modes, mode)).alias("suggest_sm_list"),
    )
    ext = F.struct(
        F.lit(1).cast("bigint").alias("restock_status"), F.lit(" ").alias("remark"), F.lit(0).cast("bigint").alias("star"),
        F.array(F.lit(1).cast("bigint")).alias("need_flag"),
    )
    return [
        basic.alias("basic_info"),
        F.struct(*[(c("c_custkey") + i).alias(n) for i, n in enumerate(AMAZON)]).alias("amazon_quantity_info"),
        F.struct(*[(nation + i).alias(n) for i, n in enumerate(SCM)]).alias("scm_quantity_info"),
        F.struct(*sales).alias("sales_info"),
        suggest.alias("suggest_info"),
        ext.alias("ext_info"),
    ]


def tree_record(c):
    segment, key = c("c_mktsegment"), c("c_custkey")
    n, modes = choose(segment, CHILDREN, 0), choose(segment, MODES, 0)

    def child(j):
        own_modes = F.when(j == 1, 2).otherwise(0)
        return F.struct(*_node(c, text("h-", key, "-", j), F.lit(1), own_modes, F.lit(4)))

    children = F.when(segment != "AUTOMOBILE", upto(n, child))
    parent = _node(c, text("h-", key), n, modes, choose(segment, NODE_TYPES, 2))
    return F.struct(*parent, children.alias("item_list"))


def tree_records(spark: SparkSession, sf: str) -> DataFrame:
    return dealt(table(spark, sf, "customer").select(*CUSTOMER_COLUMNS)).select(tree_record(F.col).alias("rec")).select("rec.*")


# ``nodes`` is one row per node, ``rows`` the node by SKU by mode expansion.
NODES_SQL = """
cust AS (
  SELECT *, CASE c_mktsegment WHEN 'BUILDING' THEN 1 WHEN 'FURNITURE' THEN 2 WHEN 'HOUSEHOLD' THEN 3 ELSE 0 END AS n,
         CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 3 WHEN 'BUILDING' THEN 2 WHEN 'FURNITURE' THEN 1
                           WHEN 'MACHINERY' THEN 1 ELSE 0 END AS m,
         CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 1 WHEN 'FURNITURE' THEN 3 WHEN 'HOUSEHOLD' THEN 4 ELSE 2 END AS nt
  FROM customer),
nodes AS (
  SELECT c_custkey, c_nationkey, c_acctbal, CAST(1 AS BIGINT) AS is_parent, CAST(NULL AS BIGINT) AS child_pos,
         'h-' || c_custkey AS hash_id, n AS q, m, nt FROM cust
  UNION ALL
  SELECT c_custkey, c_nationkey, c_acctbal, 0, j - 1, 'h-' || c_custkey || '-' || j, 1,
         CASE WHEN j = 1 THEN 2 ELSE 0 END, 4
  FROM cust JOIN (SELECT unnest(range(1, 4)) AS j) r ON r.j <= cust.n),
rows AS (
  SELECT nodes.*, k.k, s.s,
         CASE WHEN k.k IS NOT NULL THEN 'M-' || hash_id || '-' || k.k END AS msku,
         CASE WHEN k.k <> 2 THEN 'F-' || k.k END AS fnsku,
         CASE WHEN k.k < q THEN '2024-01-0' || k.k END AS opened,
         CASE WHEN s.s = 1 THEN CAST(1 AS BIGINT) END AS sm_id
  FROM nodes LEFT JOIN (SELECT unnest(range(1, 4)) AS k) k ON k.k <= q
             LEFT JOIN (SELECT unnest(range(1, 4)) AS s) s ON s.s <= m)
"""


def sellers(spark: SparkSession, sf: str) -> DataFrame:
    """Shop history: every supplier of a nation is a version of that nation's shop."""
    s = table(spark, sf, "supplier")
    return s.select(
        F.col("s_nationkey").cast("bigint").alias("sid"),
        F.when(F.col("s_acctbal") < 1000, "  ").otherwise(F.col("s_name")).alias("name"),
        text(" C", F.col("s_nationkey")).alias("country"),
        F.col("s_acctbal").cast("decimal(12,2)").cast("string").alias("create_time"),
        F.col("s_suppkey").alias("id"),
    )


SELLER_SQL = """
seller AS (
  SELECT * FROM (
    SELECT CAST(s_nationkey AS BIGINT) AS sid, CASE WHEN s_acctbal >= 1000 THEN s_name END AS seller_name,
           'C' || s_nationkey AS country, row_number() OVER (PARTITION BY s_nationkey
           ORDER BY CAST(CAST(s_acctbal AS DECIMAL(12,2)) AS VARCHAR) DESC, s_suppkey DESC) AS rn
    FROM supplier) WHERE rn = 1)
"""


def tree_detail_sql() -> str:
    """The restocking detail rows without ``parent_id`` (positions depend on file layout)."""
    amazon = ", ".join(f"c_custkey + {i} AS {n}" for i, n in enumerate(AMAZON))
    scm = ", ".join(f"CAST(c_nationkey + {i} AS BIGINT) AS {n}" for i, n in enumerate(SCM))
    money = "CAST(c_acctbal AS DECIMAL(12,2))"
    sales = ", ".join(
        f"{money} AS sales_avg_{d}, CAST(c_nationkey + {d} AS BIGINT) AS sales_total_{d}" for d in DAYS
    )
    dates = ", ".join(f"'2024-02-0{i}' AS {d}" for i, d in enumerate(DATES, 1))
    return f"""
  SELECT is_parent = 1 AS is_root, TIMESTAMP '{SYNC}' AS create_time, CAST(nt AS VARCHAR) AS node_type, '2' AS data_type,
    'P-' || c_custkey AS asin, TIMESTAMP '2024-01-30 05:00:00' AS sync_time, hash_id,
    CAST(c_nationkey AS BIGINT) AS sid, opened AS listing_create_time, msku, fnsku, {amazon}, {scm}, {sales}, {dates},
    {money} AS fba_available_sale_days, '0' AS out_stock_flag, {money} AS available_sale_days_fba,
    {money} AS estimated_sale_avg_quantity, {money} AS available_sale_days,
    CAST(c_nationkey + 1 AS BIGINT) AS estimated_sale_quantity,
    CAST(c_nationkey AS BIGINT) AS quantity_sug_oversea_to_fba,
    CAST(c_nationkey + 300 AS BIGINT) AS quantity_sug_local_to_oversea, sm_id, 'Mode' || s AS name_x,
    CAST(CASE WHEN s <> 1 THEN s * 10 ELSE c_nationkey + 100 END AS BIGINT) AS quantity_sug_purchase,
    CAST(coalesce(s, c_nationkey + 200) AS BIGINT) AS quantity_sug_local_to_fba, '1' AS restock_status, '0' AS star,
    CAST(NULL AS VARCHAR) AS remark, seller_name AS name_y, seller.country AS country
  FROM rows LEFT JOIN seller ON seller.sid = rows.c_nationkey"""


# ---- envelopes --------------------------------------------------------------------

RECORDS = {SHIP: ship_records, PRICE: price_records, RESTOCK: tree_records}
_BUILDERS = {
    SHIP: ("orders", SHIP_COLUMNS, "o_orderkey", ship_record),
    PRICE: ("events", EVENT_COLUMNS, "event_id", price_record),
    RESTOCK: ("customer", CUSTOMER_COLUMNS, "c_custkey", tree_record),
}


def envelopes(spark: SparkSession, sf: str, name: str, per: int = 500) -> DataFrame:
    """Envelopes of at most ``per`` records, cut by ranges of the unique key and sorted by it.

    The array holds raw rows until it is sorted; records are built inside it, so positions are
    the rank of the key within its range.
    """
    source, columns, key, build = _BUILDERS[name]
    raw = table(spark, sf, source).select(F.struct(key, *[c for c in columns if c != key]).alias("row"))
    shard = F.call_function("div", F.col(f"row.{key}"), F.lit(per))
    grouped = raw.groupBy(shard.alias("shard_no")).agg(F.array_sort(F.collect_list("row")).alias("sorted"))
    return grouped.select(
        F.lit(SOURCE).alias("source"),
        F.lit(name).alias("dataset"),
        F.lit(DT).alias("biz_date"),
        F.array_size("sorted").cast("bigint").alias("record_count"),
        F.lit(SYNC).alias("sync_time"),
        "shard_no",
        F.transform("sorted", lambda e: build(lambda n: e[n])).alias("data"),
        F.lit(None).cast("string").alias("_corrupt"),
        F.lit(DT).alias("dt"),
    )


def land(spark: SparkSession, sf: str, *names: str, dt: str = DT, sync: str = SYNC) -> dict:
    """Write the named datasets as JSON envelopes into fresh folders; return their specs."""
    base = new_dir(spark, "landed")
    out = specs(f"{base}/raw", f"{base}/detail")
    for name in names:
        write_envelopes(RECORDS[name](spark, sf), out[name].root, out[name], dt, sync)
    return out


# ---- pages ------------------------------------------------------------------------


def event_pages(spark: SparkSession, sf: str, faults: bool = True) -> DataFrame:
    """Events as pages of at most 500 records per event type.

    Faults: ``click`` reports another total on page 2, ``view`` delivers page 1 again as page 0,
    ``error`` skips page number 3.
    """
    events = table(spark, sf, "events")
    totals = events.groupBy(F.col("event_type").alias("key")).agg(F.count("*").alias("total"))
    pages = (
        events.groupBy(
            F.col("event_type").alias("key"), (F.call_function("div", F.col("event_id"), F.lit(500)) + 1).alias("page_no")
        )
        .agg(F.array_sort(F.collect_list(F.struct(F.col("event_id").alias("id"), "user_id", "value"))).alias("records"))
        .join(totals, "key")
        .select("key", F.col("page_no").cast("int"), ((F.col("page_no") - 1) * 500).alias("offset"), "total", "records")
    )
    if not faults:
        return pages
    key, no = F.col("key"), F.col("page_no")
    shifted = pages.withColumn("total", F.col("total") + F.when((key == "click") & (no == 2), 1).otherwise(0))
    shifted = shifted.withColumn("page_no", F.when((key == "error") & (no >= 3), no + 1).otherwise(no))
    again = F.when((key == "view") & (no == 1), F.array(F.lit(0), no)).otherwise(F.array(no))
    return shifted.withColumn("page_no", F.explode(again))


PAGES_SQL = """
raw AS (SELECT event_type AS key, event_id // 500 + 1 AS no, event_id, user_id FROM events),
totals AS (SELECT key, count(*) AS total FROM raw GROUP BY key),
pages AS (
  SELECT key, CASE WHEN key = 'error' AND no >= 3 THEN no + 1 ELSE no END AS page_no, n,
         total + CASE WHEN key = 'click' AND no = 2 THEN 1 ELSE 0 END AS total
  FROM (SELECT key, no, count(*) AS n FROM raw GROUP BY key, no) JOIN totals USING (key)
  UNION ALL
  SELECT key, 0, count(*), any_value(total) FROM raw JOIN totals USING (key) WHERE key = 'view' AND no = 1 GROUP BY key)
"""
