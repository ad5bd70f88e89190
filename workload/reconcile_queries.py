"""Comparison with another copy."""

from __future__ import annotations

from pyspark.sql import functions as F

from landfall.operators.aggregates import metrics_long
from landfall.operators.compare import (
    align_snapshot,
    anomaly_sample,
    common_metrics,
    compare_hash,
    compare_rows,
    count_chain,
    report_verdict,
    two_system_report,
)
from landfall.operators.expand import expand_children, explode_records
from landfall.operators.latest import dedup
from landfall.session import Scratch, pin
from workload.batches import SHIP, SHIP_SQL, envelopes
from workload.registry import query, table

# The older copy of ``orders`` starts two months later (missing rows), merges two states for one
# priority (changed), holds urgent filled orders twice (repeated) and has orders of its own.
_OLD_SQL = """new AS (SELECT o_orderkey AS k, o_orderstatus AS status, o_orderpriority AS priority, o_orderdate AS placed,
    o_totalprice AS price FROM orders),
  base AS (SELECT k, CASE WHEN status = 'P' AND priority = '2-HIGH' THEN 'O' ELSE status END AS status, priority, placed, price
    FROM new WHERE placed >= DATE '1995-03-01'),
  old AS (SELECT * FROM base UNION ALL SELECT * FROM base WHERE status = 'F' AND priority = '1-URGENT'
    UNION ALL SELECT 0 - k - 1, status, priority, placed, price FROM base WHERE status = 'P' AND priority = '3-MEDIUM')"""


def _new(spark, sf):
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority"),
        F.col("o_orderdate").alias("placed"), F.col("o_totalprice").alias("price"),
    )


def _old(spark, sf):
    merged = F.when((F.col("status") == "P") & (F.col("priority") == "2-HIGH"), "O").otherwise(F.col("status"))
    base = _new(spark, sf).where("placed >= DATE '1995-03-01'").withColumn("status", merged)
    twice = base.where("status = 'F' AND priority = '1-URGENT'")
    own = base.where("status = 'P' AND priority = '3-MEDIUM'").withColumn("k", 0 - F.col("k") - 1)
    return base.unionByName(twice).unionByName(own)


_DIFF_SQL = f"""{_OLD_SQL}, o AS (SELECT k, count(*) AS n_old, any_value(status) AS status, any_value(priority) AS priority
    FROM old GROUP BY k),
  diff AS (SELECT k, CASE WHEN n.k IS NULL THEN 0 ELSE 1 END AS n_new, coalesce(n_old, 0) AS n_old,
    CASE WHEN n_old IS NULL THEN 'only_new' WHEN n.k IS NULL THEN 'only_old'
         WHEN n_old = 1 AND n.status = o.status THEN 'same' ELSE 'changed' END AS status,
    CASE WHEN n_old IS NULL OR n.k IS NULL THEN '' WHEN n_old > 1 THEN 'status,priority'
         WHEN n.status <> o.status THEN 'status' ELSE '' END AS changed_columns
    FROM new n FULL JOIN o USING (k))"""


def _diff(spark, sf):
    return compare_rows(_new(spark, sf), _old(spark, sf), ["k"], {"status": "string", "priority": "string"})


query("e7_compare_rows", f"WITH {_DIFF_SQL} SELECT k, CAST(n_new AS BIGINT) AS n_new, n_old, status, changed_columns FROM diff")(
    _diff
)


@query(
    "l13_compare_hash",
    """SELECT o_orderkey AS k, CAST(1 AS BIGINT) AS n_new, CAST(1 AS BIGINT) AS n_old,
       CASE WHEN o_orderstatus = 'P' THEN 'changed' ELSE 'same' END AS status FROM orders""",
)
def l13(spark, sf):
    """The older system keeps wider decimals and UTC+8 wall clocks, and writes a missing note as null."""
    orders = table(spark, sf, "orders")
    filled = F.col("o_orderstatus") != "P"
    new = orders.select(
        F.col("o_orderkey").alias("k"), F.col("o_totalprice").alias("price"), F.col("o_orderdate").alias("at"),
        F.when(filled, F.col("o_orderpriority")).otherwise("").alias("note"),
    )
    old = orders.select(
        F.col("o_orderkey").alias("k"), F.col("o_totalprice").cast("decimal(20,6)").alias("price"),
        (F.col("o_orderdate") + F.expr("INTERVAL 8 HOURS")).alias("at"),
        F.when(filled, F.col("o_orderpriority")).alias("note"),
    )
    types = {"price": "decimal(20,2)", "at": "timestamp", "note": "string"}
    return compare_hash(new, old, ["k"], types, new_zones={"at": "UTC"}, old_zones={"at": "Asia/Shanghai"})


def _metrics(df):
    row = df.agg(
        F.count("*").alias("rows"), F.countDistinct("k").alias("keys"), F.count_if(F.col("k").isNull()).alias("null_keys"),
        F.count_if(F.col("status") == "P").alias("open"), (F.count("*") - F.countDistinct("k")).alias("duplicates"),
    )
    return metrics_long(row, {c: c for c in row.columns})


def _metrics_sql(side):
    return f"""{side}_m AS (SELECT unnest([['rows', count(*)::VARCHAR], ['keys', count(DISTINCT k)::VARCHAR],
      ['null_keys', count(*) FILTER (k IS NULL)::VARCHAR], ['open', count(*) FILTER (status = 'P')::VARCHAR],
      ['duplicates', (count(*) - count(DISTINCT k))::VARCHAR]]) AS m FROM {side})"""


_REPORT_SQL = f"""{_OLD_SQL}, {_metrics_sql("new")}, {_metrics_sql("old")},
  p AS (SELECT n.m[1] AS metric, CAST(n.m[2] AS BIGINT) AS a, CAST(o.m[2] AS BIGINT) AS b FROM new_m n JOIN old_m o ON n.m[1] = o.m[1]),
  q AS (SELECT *, (20000 * abs(a - b) + b) // (2 * nullif(b, 0)) AS bp FROM p),
  report AS (SELECT metric, CAST(a AS VARCHAR) AS new_value, CAST(b AS VARCHAR) AS old_value,
    CASE WHEN a > b THEN '+' ELSE '' END || (a - b) || CASE WHEN a <> b AND b <> 0 THEN
      '（' || (bp // 100) || '.' || lpad(CAST(bp % 100 AS VARCHAR), 2, '0') || '%）' ELSE '' END AS diff,
    CASE WHEN a = b THEN '一致' ELSE '异常' END AS result FROM q)"""


@query(
    "l11_two_system_report",
    f"WITH {_REPORT_SQL} SELECT * FROM report UNION ALL SELECT 'only_here', CAST(count(*) AS VARCHAR), 'N/A', 'N/A', 'N/A' FROM new",
)
def l11(spark, sf):
    new, old = _new(spark, sf), _old(spark, sf)
    only = metrics_long(new.agg(F.count("*").alias("n")), {"only_here": "n"})
    return two_system_report(_metrics(new).unionByName(only), _metrics(old))


@query(
    "l11_report_verdict",
    f"""WITH {_REPORT_SQL}, f AS (SELECT count(*) AS compared, count(*) FILTER (result = '异常') AS different FROM report),
      d AS (SELECT count(*) - count(DISTINCT k) AS dup FROM old)
      SELECT 'same boundary, equal' AS scenario, '通过' AS conclusion FROM f UNION ALL
      SELECT 'same boundary, different', CASE WHEN different > 0 THEN '不通过' ELSE '通过' END FROM f UNION ALL
      SELECT 'near boundary', '条件通过' FROM f UNION ALL SELECT 'no boundary', '未完成' FROM f UNION ALL
      SELECT 'side missing', '未完成' FROM f UNION ALL
      SELECT 'near boundary, repeated', CASE WHEN dup > 0 THEN '不通过' ELSE '条件通过' END FROM d""",
)
def l11_verdict(spark, sf):
    new, old = _metrics(_new(spark, sf)), _metrics(_old(spark, sf))
    different, swapped = two_system_report(new, old), two_system_report(old, new)
    zero = ("null_keys", "duplicates")
    cases = {
        "same boundary, equal": report_verdict(two_system_report(new, new), "same", zero),
        "same boundary, different": report_verdict(different, "same", zero),
        "near boundary": report_verdict(different, "near", zero),
        "no boundary": report_verdict(different, "incomparable", zero),
        "side missing": report_verdict(two_system_report(new, None), "same", zero),
        "near boundary, repeated": report_verdict(swapped, "near", zero),
    }
    rows = [df.select(F.lit(name).alias("scenario"), "conclusion") for name, df in cases.items()]
    out = rows[0]
    for row in rows[1:]:
        out = out.unionByName(row)
    return out


@query(
    "l12_align_snapshot",
    f"""WITH {_OLD_SQL}, w AS (SELECT greatest((SELECT min(placed) FROM new), (SELECT min(placed) FROM old)) AS a,
        least((SELECT max(placed) FROM new), (SELECT max(placed) FROM old)) AS b)
      SELECT 'new' AS side, strftime(placed, '%Y-%m-%d') AS day, count(*) AS n, 'near' AS boundary FROM new, w WHERE placed BETWEEN a AND b GROUP BY 2
      UNION ALL SELECT 'old', strftime(placed, '%Y-%m-%d'), count(*), 'near' FROM old, w WHERE placed BETWEEN a AND b GROUP BY 2""",
)
def l12(spark, sf):
    new, old, boundary = align_snapshot(_new(spark, sf), _old(spark, sf), "placed")
    day = F.date_format("placed", "yyyy-MM-dd").alias("day")
    sides = [
        df.groupBy(F.lit(side).alias("side"), day).agg(F.count("*").alias("n")) for side, df in (("new", new), ("old", old))
    ]
    return sides[0].unionByName(sides[1]).crossJoin(F.broadcast(boundary.select("boundary")))


@query(
    "l14_common_metrics",
    f"""WITH {_OLD_SQL}, {_metrics_sql("new")}, {_metrics_sql("old")} SELECT n.m[1] AS metric_name, n.m[2] AS new_value,
      o.m[2] AS old_value FROM new_m n JOIN old_m o ON n.m[1] = o.m[1] WHERE n.m[1] <> 'open'""",
)
def l14(spark, sf):
    return common_metrics(_metrics(_new(spark, sf)), _metrics(_old(spark, sf)).where("metric_name <> 'open'"))


@query(
    "l15_anomaly_sample",
    f"WITH {_DIFF_SQL} SELECT k, CAST(n_new AS BIGINT) AS n_new, n_old, status, changed_columns FROM diff"
    " WHERE status <> 'same' ORDER BY k LIMIT 20",
)
def l15(spark, sf):
    return anomaly_sample(_diff(spark, sf), ["k"], 20)


@query(
    "l16_count_chain",
    f"""WITH {SHIP_SQL}, c AS (SELECT (SELECT count(*) FROM ship) AS a, (SELECT count(*) FROM items) AS b,
        (SELECT count(*) FROM items WHERE msku IS NOT NULL) AS d,
        (SELECT count(*) FROM (SELECT DISTINCT sid, msku FROM items WHERE msku IS NOT NULL)) AS e),
      s AS (SELECT CAST(unnest([1, 2, 3, 4, 5]) AS BIGINT) AS stage_no,
        unnest(['extract', 'landed', 'expanded', 'with sku', 'detail']) AS stage, unnest([a, a, b, d, e]) AS row_count,
        unnest([0, 0, b - a, d - b, e - d]) AS delta, unnest(['', '', 'expansion', 'filter', 'dedup']) AS why FROM c)
      SELECT stage_no, stage, row_count, delta, CASE WHEN delta = 0 THEN 'unchanged' ELSE why END AS reason FROM s""",
)
def l16(spark, sf):
    """The landed records are written once, since every count reads them."""
    with Scratch(spark) as scratch:
        landed = explode_records(envelopes(spark, sf, SHIP)).select(F.struct("rec.sid", "rec.item_list").alias("rec"))
        return pin(_chain(scratch.materialize(landed, "landed"), table(spark, sf, "orders")))


def _chain(landed, orders):
    expanded = expand_children(landed, "item_list").select("rec.sid", F.trim("item.msku").alias("msku"), "item.id")
    kept = expanded.where("msku <> ''")
    detail = dedup(kept.withColumn("key", F.concat_ws("/", "sid", "msku")), "key", ["id"])
    return count_chain(
        [
            ("extract", orders, ""),
            ("landed", landed, "landing"),
            ("expanded", expanded, "expansion"),
            ("with sku", kept, "filter"),
            ("detail", detail, "dedup"),
        ]
    )
