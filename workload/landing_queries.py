"""Batch planning and extract completeness."""

from __future__ import annotations

from pyspark.sql import functions as F

from landfall.functions import in_window, normalize_biz_date
from landfall.operators.pages import (
    collect_pages,
    missing_keys,
    page_faults,
    page_totals,
    record_fault_verdict,
    record_faults,
    request_plan,
)
from landfall.sources.keys import explode_loose, parse_loose, valid_keys
from workload.batches import PAGES_SQL, event_pages, text
from workload.registry import columns_query, query, table

query(
    "b1_request_plan",
    "SELECT c_custkey AS key, strftime(DATE '2024-01-31' - INTERVAL 89 DAY, '%Y-%m-%d') AS window_start,"
    " strftime(DATE '2024-01-31' + INTERVAL 1 DAY, '%Y-%m-%d') AS window_end FROM customer",
)(lambda spark, sf: request_plan(table(spark, sf, "customer").select(F.col("c_custkey").alias("key")), "2024-01-31", 90))

columns_query(
    "b2_window_half_open",
    "orders",
    "o_orderkey",
    {
        "inside": (
            lambda: in_window("o_orderdate", "1998-06-30", 90),
            "o_orderdate >= DATE '1998-06-30' - INTERVAL 89 DAY AND o_orderdate < DATE '1998-06-30' + INTERVAL 1 DAY",
        )
    },
)

columns_query(
    "b3_window_closed",
    "events",
    "event_id",
    {
        "inside": (
            lambda: in_window("ts", "2024-01-20", 15, closed=True),
            "ts BETWEEN TIMESTAMP '2024-01-06 00:00:00' AND TIMESTAMP '2024-01-20 23:59:59'",
        )
    },
)


def _date_texts(orders):
    day = lambda f: F.date_format("o_orderdate", f)
    return orders.select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "F", day("yyyy-MM-dd"))
        .when(F.col("o_orderstatus") == "O", text("  ", day("yyyyMMdd"), " "))
        .when(F.col("o_orderpriority") == "5-LOW", F.lit("2023-02-30"))
        .when(F.col("o_orderpriority") == "2-HIGH", F.lit(" "))
        .otherwise(day("yyyy/MM/dd"))
        .alias("given"),
    )


columns_query(
    "b4_normalize_biz_date",
    "orders",
    "o_orderkey",
    {"biz_date": (lambda: normalize_biz_date("given"), "biz_date")},
    base="(SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN strftime(o_orderdate, '%Y-%m-%d') END AS biz_date FROM orders)",
    prepare=_date_texts,
)


def _loose_customers(spark, sf):
    """One raw envelope line per customer; the segment decides how good its key is."""
    key = F.col("c_custkey").cast("string")
    segment = F.col("c_mktsegment")
    record = (
        F.when(segment == "AUTOMOBILE", text('{"sid": ', key, "}"))
        .when(segment == "BUILDING", text('{"sid": " ', key, ' "}'))
        .when(segment == "FURNITURE", text('{"sid": "x', key, '"}'))
        .when(segment == "HOUSEHOLD", F.lit('{"sid": null}'))
        .otherwise(text('"', key, '"'))
    )
    # Every valid key arrives twice.
    return table(spark, sf, "customer").select(text('{"record_count": 2, "data": [', record, ",", record, "]}").alias("value"))


@query(
    "b5_valid_keys",
    "SELECT 2 * count(*) AS record_count, count(*) FILTER (c_mktsegment IN ('AUTOMOBILE', 'BUILDING')) AS valid_key_count,"
    " 2 * count(*) FILTER (c_mktsegment NOT IN ('AUTOMOBILE', 'BUILDING')) AS invalid_record_count FROM customer",
)
def b5(spark, sf):
    return valid_keys(explode_loose(parse_loose(_loose_customers(spark, sf)), "sid"))[1]


@query("h4_distinct_sorted", "SELECT c_custkey AS key FROM customer WHERE c_mktsegment IN ('AUTOMOBILE', 'BUILDING') ORDER BY key")
def h4(spark, sf):
    return valid_keys(explode_loose(parse_loose(_loose_customers(spark, sf)), "sid"))[0]


@query(
    "b6_collect_pages",
    f"WITH {PAGES_SQL} SELECT key, count(*) AS page_count, CAST(sum(n) AS BIGINT) AS received, max(total) AS declared,"
    " sum(n) = max(total) AS complete FROM pages GROUP BY key",
)
def b6(spark, sf):
    return page_totals(event_pages(spark, sf))


@query(
    "b6_page_records",
    "SELECT event_type AS key, event_id // 500 + 1 AS page_no, event_id AS id, user_id,"
    " row_number() OVER (PARTITION BY event_type, event_id // 500 ORDER BY event_id) - 1 AS pos FROM events",
)
def b6_records(spark, sf):
    rows = collect_pages(event_pages(spark, sf, faults=False))
    return rows.select("key", F.col("page_no").cast("bigint"), "rec.id", "rec.user_id", F.col("pos").cast("bigint"))


def _faults(name: str, kinds: str, sql: str):
    names = kinds.split()
    query(name, f"WITH {PAGES_SQL} {sql}")(
        lambda spark, sf: page_faults(event_pages(spark, sf), max_page=20).where(F.col("kind").isin(names))
    )


_faults(
    "b7_total_changed",
    "TOTAL_CHANGED TOTAL_MISMATCH",
    """SELECT key, 'TOTAL_CHANGED' AS kind, CAST(max(total) - min(total) AS BIGINT) AS detail FROM pages
       GROUP BY key HAVING min(total) <> max(total)
       UNION ALL SELECT key, 'TOTAL_MISMATCH', CAST(sum(n) - max(total) AS BIGINT) FROM pages
       GROUP BY key HAVING sum(n) <> max(total)""",
)
_faults(
    "b8_duplicate_page",
    "DUPLICATE_PAGE",
    "SELECT key, 'DUPLICATE_PAGE' AS kind, count(*) AS detail FROM pages WHERE page_no = 0 GROUP BY key",
)
_faults(
    "b9_page_bounds",
    "PAGE_GAP PAGE_LIMIT",
    """SELECT key, 'PAGE_GAP' AS kind, CAST(max(page_no) - count(DISTINCT page_no) AS BIGINT) AS detail FROM pages
       GROUP BY key HAVING min(page_no) <> 1 OR count(DISTINCT page_no) <> max(page_no) - min(page_no) + 1
       UNION ALL SELECT key, 'PAGE_LIMIT', CAST(max(page_no) - 20 AS BIGINT) FROM pages
       GROUP BY key HAVING max(page_no) > 20""",
)


def _spoilt(spark, sf):
    """Event records with missing, blank and repeated ids, and records that are not objects."""
    kind = F.col("event_type")
    given = (
        F.when(kind == "purchase", None)
        .when(kind == "view", F.lit(" "))
        .when(kind == "signup", text("u", F.col("user_id")))
        .otherwise(F.col("event_id").cast("string"))
    )
    rec = F.when(kind != "click", F.struct(given.alias("id")))
    return table(spark, sf, "events").select(rec.alias("rec"))


@query(
    "b10_record_faults",
    """SELECT count(*) AS record_count, count(*) FILTER (event_type = 'click') AS not_object_count,
       count(*) FILTER (event_type IN ('purchase', 'view')) AS missing_id_count,
       count(*) FILTER (event_type = 'signup') - count(DISTINCT user_id) FILTER (event_type = 'signup') AS duplicate_id_count
       FROM events""",
)
def b10(spark, sf):
    return record_faults(_spoilt(spark, sf), "rec.id")


@query(
    "b11_missing_keys",
    "SELECT c_custkey AS key FROM customer WHERE c_custkey NOT IN"
    " (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT')",
)
def b11(spark, sf):
    plan = table(spark, sf, "customer").select(F.col("c_custkey").alias("key"))
    done = table(spark, sf, "orders").where("o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'")
    return missing_keys(plan, done.select(F.col("o_custkey").alias("key")))


@query(
    "b12_empty_policy",
    """WITH days AS (SELECT strftime(d, '%Y-%m-%d') AS day, count(event_id) AS record_count FROM
         (SELECT unnest(generate_series(min(date_trunc('day', ts)), max(date_trunc('day', ts)) + INTERVAL 3 DAY, INTERVAL 1 DAY)) AS d
          FROM events) c LEFT JOIN events e ON date_trunc('day', e.ts) = c.d GROUP BY 1)
       SELECT day, policy, record_count, CASE WHEN record_count = 0 AND policy = 'FAIL' THEN 'EMPTY_BATCH' END AS code
       FROM days CROSS JOIN (SELECT unnest(['FAIL', 'ALLOW']) AS policy)""",
)
def b12(spark, sf):
    """Both policies over every day of the extract and the three empty days after it."""
    per_day = table(spark, sf, "events").groupBy(F.to_date("ts").alias("day")).agg(F.count("*").alias("record_count"))
    span = per_day.agg(F.min("day").alias("a"), F.max("day").alias("b"))
    calendar = span.select(F.explode(F.sequence("a", F.date_add("b", 3), F.expr("interval 1 day"))).alias("day"))
    counts = calendar.join(per_day, "day", "left").select(
        F.col("day").cast("string").alias("day"),
        F.coalesce("record_count", F.lit(0)).alias("record_count"),
        *[F.lit(0).alias(c) for c in ("not_object_count", "missing_id_count", "duplicate_id_count")],
    )
    frames = [
        record_fault_verdict(counts, policy).select("day", F.lit(policy).alias("policy"), "record_count", "code")
        for policy in ("FAIL", "ALLOW")
    ]
    return frames[0].unionByName(frames[1])
