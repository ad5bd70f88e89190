"""Projections, predicates and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from landfall.functions import (
    all_equal,
    at_pos,
    batch_position_id,
    blank_to_null,
    cast_fault,
    conform,
    const,
    day_of,
    diff0,
    diff_text,
    differs,
    digits_to_long,
    has_date_prefix,
    is_blank,
    is_datetime_text,
    is_digits,
    map_code,
    map_label,
    not_in_domain,
    null_safe_ne,
    null_to,
    num0,
    position_overflow,
    rate_pct,
    safe_cast,
    technical_id,
)
from landfall.operators.partitions import recent_partitions
from landfall.spec import Field
from workload.batches import NODES_SQL, PRICE, RESTOCK, SHIP, SHIP_SQL, choose, envelopes, text
from workload.registry import columns_query, query, table

# ---- texts of every quality, derived from the order's own attributes ----------------


def _texts(orders):
    """``t`` date text, ``k`` key text, ``b`` text that may be null, blank, padded or plain."""
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    return orders.select(
        "o_orderkey",
        "o_custkey",
        status.alias("s"),
        choose(
            priority,
            {"1-URGENT": text(day, " 10:20"), "2-HIGH": text(day, " 10:20:30"), "3-MEDIUM": day,
             "4-NOT SPECIFIED": text("2026-99-99 ", "10:20"), "5-LOW": None},
        ).cast("string").alias("t"),
        choose(
            priority,
            {"1-URGENT": F.col("o_custkey").cast("string"), "2-HIGH": text(" ", F.col("o_custkey"), " "),
             "3-MEDIUM": text("x", F.col("o_custkey")), "4-NOT SPECIFIED": " ", "5-LOW": None},
        ).cast("string").alias("k"),
        choose(
            status,
            {"F": text("  ", priority, " "), "O": F.when(priority == "5-LOW", None).otherwise(F.lit("   "))},
            priority,
        ).alias("b"),
    )


_TEXTS = """(SELECT o_orderkey, o_custkey, o_orderstatus AS s,
  CASE o_orderpriority WHEN '1-URGENT' THEN strftime(o_orderdate, '%Y-%m-%d') || ' 10:20'
    WHEN '2-HIGH' THEN strftime(o_orderdate, '%Y-%m-%d') || ' 10:20:30'
    WHEN '3-MEDIUM' THEN strftime(o_orderdate, '%Y-%m-%d') WHEN '4-NOT SPECIFIED' THEN '2026-99-99 10:20' END AS t,
  CASE o_orderpriority WHEN '1-URGENT' THEN CAST(o_custkey AS VARCHAR) WHEN '2-HIGH' THEN ' ' || o_custkey || ' '
    WHEN '3-MEDIUM' THEN 'x' || o_custkey WHEN '4-NOT SPECIFIED' THEN ' ' END AS k,
  CASE o_orderstatus WHEN 'F' THEN '  ' || o_orderpriority || ' '
    WHEN 'O' THEN CASE WHEN o_orderpriority <> '5-LOW' THEN '   ' END ELSE o_orderpriority END AS b
  FROM orders)"""

# Fixed value: the accepted shape of a time text.
_DT = r"^[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}(:[0-9]{2})?$"


def text_query(name, columns):
    columns_query(name, "orders", "o_orderkey", columns, base=_TEXTS, prepare=_texts)


text_query(
    "c4_regex_predicates",
    {
        "is_time": (lambda: is_datetime_text("t"), f"coalesce(regexp_matches(t, '{_DT}'), false)"),
        "is_real_time": (
            lambda: is_datetime_text("t", strict=True),
            f"coalesce(regexp_matches(t, '{_DT}') AND t NOT LIKE '2026-99%', false)",
        ),
        "has_date": (lambda: has_date_prefix("t"), "coalesce(regexp_matches(t, '^[0-9]{4}-[0-9]{2}-[0-9]{2} '), false)"),
        "digits": (lambda: is_digits("k"), "coalesce(regexp_matches(k, '^[0-9]+$'), false)"),
    },
)
text_query("c5_is_blank", {"blank": (lambda: is_blank("b"), "b IS NULL OR trim(b) = ''")})
text_query("c6_differs", {"other": (lambda: differs("b", "1-URGENT"), "coalesce(b, '') <> '1-URGENT'")})
text_query(
    "c7_not_in_domain",
    {"outside": (lambda: not_in_domain("b", ["1-URGENT", "2-HIGH"]), "b IS NULL OR b NOT IN ('1-URGENT', '2-HIGH')")},
)
text_query("c8_null_safe_ne", {"unequal": (lambda: null_safe_ne("b", "k"), "b IS DISTINCT FROM k")})
text_query(
    "c10_const",
    {
        "zero": (lambda: const(0, "bigint"), "CAST(0 AS BIGINT)"),
        "nothing": (lambda: const(None, "string"), "CAST(NULL AS VARCHAR)"),
        "label": (lambda: const("fixed", "string"), "'fixed'"),
    },
)
text_query("s1_blank_to_null", {"clean": (lambda: blank_to_null("b"), "nullif(trim(b), '')")})
text_query(
    "s2_map_label",
    {"label": (lambda: map_label(blank_to_null("b"), {"1-URGENT": "急", "2-HIGH": "高"}),
               "CASE nullif(trim(b), '') WHEN '1-URGENT' THEN '急' WHEN '2-HIGH' THEN '高' ELSE nullif(trim(b), '') END")},
)
columns_query(
    "s3_map_code",
    "orders",
    "o_orderkey",
    {"label": (lambda: map_code("o_custkey", {0: "zero", 1: "one"}),
               "CASE o_custkey WHEN 0 THEN 'zero' WHEN 1 THEN 'one' ELSE CAST(o_custkey AS VARCHAR) END")},
)
text_query("s4_prefer", {"preferred": (lambda: F.coalesce(blank_to_null("b"), "k", "t"), "coalesce(nullif(trim(b), ''), k, t)")})
text_query("s8_digits_to_long", {"number": (lambda: digits_to_long("k").cast("string"),
                                            "CASE WHEN regexp_matches(trim(k), '^[0-9]+$') THEN trim(k) END")})
text_query(
    "s9_safe_cast",
    {
        "as_number": (lambda: safe_cast("k", "bigint").cast("string"), "CAST(try_cast(trim(k) AS BIGINT) AS VARCHAR)"),
        "lost_number": (lambda: cast_fault("k", "bigint"), "coalesce(trim(k) <> '' AND try_cast(trim(k) AS BIGINT) IS NULL, false)"),
        "as_text": (lambda: safe_cast("o_custkey", "string"), "CAST(o_custkey AS VARCHAR)"),
        "as_time": (
            lambda: F.date_format(safe_cast("t", "timestamp_ntz"), "yyyy-MM-dd HH:mm:ss"),
            "CASE WHEN t LIKE '2026-99%' THEN NULL WHEN length(t) = 10 THEN t || ' 00:00:00'"
            " WHEN length(t) = 16 THEN t || ':00' ELSE t END",
        ),
        "lost_time": (lambda: cast_fault("t", "timestamp_ntz"), "coalesce(t LIKE '2026-99%', false)"),
    },
)
text_query("s10_day_of", {"day": (lambda: day_of("t"), "substr(t, 1, 10)")})
text_query("s15_num0", {"n": (lambda: num0(F.when(F.col("s") != "P", F.coalesce(digits_to_long("k").cast("string"), F.lit(" ")))),
                              "CASE WHEN s <> 'P' AND regexp_matches(trim(k), '^[0-9]+$') THEN CAST(trim(k) AS BIGINT) ELSE 0 END")})
text_query(
    "s16_null_to",
    {"b0": (lambda: null_to("b", ""), "coalesce(b, '')"),
     "k0": (lambda: null_to(safe_cast("k", "bigint"), -1), "coalesce(try_cast(trim(k) AS BIGINT), -1)")},
)


@query("c3_all_equal", "SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '2-HIGH'")
def c3(spark, sf):
    orders = table(spark, sf, "orders")
    return orders.where(all_equal({"o_orderstatus": "F", "o_orderpriority": "2-HIGH"})).select("o_orderkey")


_CONTRACT = (
    Field("id", "bigint", lambda: F.col("o_orderkey")),
    Field("relate_id", "bigint", lambda: F.col("o_orderkey")),
    Field("price", "string", lambda: F.col("o_totalprice").cast("decimal(12,2)")),
    Field("status", "string", lambda: F.col("o_orderstatus")),
)


@query(
    "c1_conform",
    "SELECT o_orderkey AS id, o_orderkey AS relate_id, CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR) AS price,"
    " o_orderstatus AS status FROM orders",
)
def c1(spark, sf):
    return conform(table(spark, sf, "orders"), _CONTRACT)


@query(
    "c2_struct_access",
    """SELECT c_custkey AS k, 'P-' || c_custkey AS asin, CAST(c_acctbal AS DOUBLE) AS sales_avg_30,
       CASE c_mktsegment WHEN 'BUILDING' THEN 'M-h-' || c_custkey || '-1' WHEN 'FURNITURE' THEN 'M-h-' || c_custkey || '-1'
         WHEN 'HOUSEHOLD' THEN 'M-h-' || c_custkey || '-1' END AS first_msku FROM customer""",
)
def c2(spark, sf):
    rec = envelopes(spark, sf, RESTOCK).select(F.explode("data").alias("rec"))
    return rec.select(
        F.substring("rec.basic_info.asin", 3, 20).cast("bigint").alias("k"),
        "rec.basic_info.asin",
        "rec.sales_info.sales_avg_30",
        F.get("rec.basic_info.msku_fnsku_list", F.lit(0))["msku"].alias("first_msku"),
    )


@query(
    "c9_partition_membership",
    "WITH d AS (SELECT *, strftime(ts, '%Y-%m-%d') AS dt FROM events) SELECT event_id, dt FROM d WHERE dt IN"
    " (SELECT DISTINCT dt FROM d WHERE dt <= '2024-01-20' ORDER BY dt DESC LIMIT 7)",
)
def c9(spark, sf):
    days = table(spark, sf, "events").select("event_id", F.date_format("ts", "yyyy-MM-dd").alias("dt"))
    return recent_partitions(days, "2024-01-20", 7).select("event_id", "dt")


@query(
    "c11_repeated_source",
    "SELECT o_orderkey AS id, o_orderkey AS relate_id, o_totalprice AS days_fba, o_totalprice AS fba_days FROM orders",
)
def c11(spark, sf):
    both = [Field(n, "double", lambda: F.col("o_totalprice")) for n in ("days_fba", "fba_days")]
    return conform(table(spark, sf, "orders"), (*_CONTRACT[:2], *both))


# ---- functions over expanded children -----------------------------------------------


@query(
    "s5_diff0",
    f"WITH {SHIP_SQL} SELECT tid, CAST(coalesce(qr, 0) - coalesce(ql, 0) AS VARCHAR) AS rad_diff,"
    " CAST(coalesce(qs, 0) - coalesce(qr, 0) AS VARCHAR) AS aar_diff FROM items",
)
def s5(spark, sf):
    rows = _shipment_items(spark, sf)
    return rows.select(
        technical_id("item_pos", "rec.id", "item.id").alias("tid"),
        diff0("item.quantity_received", "item.quantity_shipped_local").alias("rad_diff"),
        diff0("item.quantity_shipped", "item.quantity_received").alias("aar_diff"),
    )


def _shipment_items(spark, sf):
    rec = envelopes(spark, sf, SHIP).select(F.explode("data").alias("rec"))
    return rec.select("rec", F.posexplode_outer("rec.item_list").alias("item_pos", "item"))


@query("s6_technical_id", f"WITH {SHIP_SQL} SELECT id, tid, item_pos IS NULL AS childless FROM items")
def s6(spark, sf):
    return _shipment_items(spark, sf).select(
        "rec.id", technical_id("item_pos", "rec.id", "item.id").alias("tid"), F.col("item_pos").isNull().alias("childless")
    )


columns_query(
    "s7_batch_position_id",
    "orders",
    "o_orderkey",
    {
        "narrow": (lambda: batch_position_id("2024-01-31", "o_orderkey").cast("string"),
                   "CASE WHEN o_orderkey + 1 <= 9999999 THEN '20240131' || lpad(CAST(o_orderkey + 1 AS VARCHAR), 7, '0') END"),
        "wide": (lambda: batch_position_id("2024-01-31", "o_orderkey", 11).cast("string"),
                 "CASE WHEN o_orderkey + 1 <= 99999999999 THEN '20240131' || lpad(CAST(o_orderkey + 1 AS VARCHAR), 11, '0') END"),
        "overflow": (lambda: position_overflow(F.col("o_orderkey") * 1000, 7), "o_orderkey * 1000 + 1 > 9999999"),
    },
)


@query(
    "s11_to_json",
    """SELECT CAST(event_id AS VARCHAR) AS id, '["' || CAST(CAST(value AS DECIMAL(12,2)) AS VARCHAR) || '","x"]' AS before,
       CASE WHEN event_type <> 'error' THEN '["' || CAST(CAST(value AS DECIMAL(12,2)) AS VARCHAR) || '"]' END AS after,
       '[{"type":"' || event_type || '","note":null}]' AS audit FROM events""",
)
def s11(spark, sf):
    rec = envelopes(spark, sf, PRICE).select(F.inline("data"))
    return rec.select(
        F.col("business_id").alias("id"), F.to_json("adjust_before").alias("before"),
        F.to_json("adjust_after").alias("after"), F.to_json("audit_info").alias("audit"),
    )


@query(
    "s12_size",
    f"WITH {SHIP_SQL} SELECT id, CASE WHEN n > 0 OR st <> 'F' THEN CAST(n AS VARCHAR) END AS n FROM ship",
)
def s12(spark, sf):
    rec = envelopes(spark, sf, SHIP).select(F.inline("data"))
    return rec.select("id", F.array_size("item_list").cast("string").alias("n"))


@query("s13_at_pos", f"WITH {NODES_SQL} SELECT DISTINCT hash_id, CAST(k AS VARCHAR) AS k, opened FROM rows WHERE is_parent = 1")
def s13(spark, sf):
    info = envelopes(spark, sf, RESTOCK).select(F.inline("data")).select("basic_info.*")
    rows = info.select("hash_id", "listing_opentime_list", F.posexplode_outer("msku_fnsku_list").alias("pos", "pair"))
    return rows.select(
        "hash_id", (F.col("pos") + 1).cast("string").alias("k"), at_pos("listing_opentime_list", "pos").alias("opened")
    )


@query(
    "s14_rate_pct",
    "SELECT o_custkey, CASE WHEN count(*) FILTER (o_orderstatus <> 'P') > 0 THEN"
    " CAST(round(CAST(100 * count(*) FILTER (o_orderstatus = 'F') AS DOUBLE) / count(*) FILTER (o_orderstatus <> 'P'), 4) AS DOUBLE)"
    " END AS rate FROM orders GROUP BY o_custkey",
)
def s14(spark, sf):
    counts = table(spark, sf, "orders").groupBy("o_custkey").agg(
        F.count_if(F.col("o_orderstatus") == "F").alias("f"), F.count_if(F.col("o_orderstatus") != "P").alias("d")
    )
    return counts.select("o_custkey", rate_pct("f", "d").alias("rate"))


@query(
    "s17_diff_text",
    """WITH c AS (SELECT o_custkey, count(*) FILTER (o_orderstatus = 'F') AS n, count(*) FILTER (o_orderstatus = 'O') AS o
         FROM orders GROUP BY o_custkey),
       h AS (SELECT *, n - o AS d, (20000 * abs(n - o) + o) // (2 * nullif(o, 0)) AS bp FROM c)
       SELECT o_custkey, CASE WHEN d > 0 THEN '+' ELSE '' END || d ||
         CASE WHEN d <> 0 AND o <> 0 THEN '（' || (bp // 100) || '.' || lpad(CAST(bp % 100 AS VARCHAR), 2, '0') || '%）' ELSE '' END
         AS diff FROM h""",
)
def s17(spark, sf):
    counts = table(spark, sf, "orders").groupBy("o_custkey").agg(
        F.count_if(F.col("o_orderstatus") == "F").alias("n"), F.count_if(F.col("o_orderstatus") == "O").alias("o")
    )
    return counts.select("o_custkey", diff_text("n", "o").alias("diff"))


