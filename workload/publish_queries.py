"""Versioned publishing, partition lists from metadata, and comparisons that explain themselves."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from landfall.functions import blank_to_null
from landfall.operators.aggregates import sum0
from landfall.operators.compare import Stage, align_batches, explained_chain, fault_sample
from landfall.operators.expand import expand_children, expand_levels, explode_records
from landfall.operators.guards import envelope_verdict
from landfall.operators.latest import dedup, merge_latest
from landfall.operators.partitions import last_partitions, recent_partitions
from landfall.operators.quality import SHARDED_RULES, apply_rules, recon_metrics_long, recon_trend
from landfall.plans.jobs import tree_detail
from landfall.session import Scratch, new_dir, pin
from landfall.sources.envelopes import read_envelopes
from landfall.sources.flat import write_flat
from landfall.sources.footers import footer_census
from landfall.sources.partitions import folder_days
from landfall.sources.versions import publish_version, read_manifest, read_published
from workload.batches import (
    DT,
    LISTING_SQL,
    NODES_SQL,
    RESTOCK,
    SELLER_SQL,
    SHIP,
    SHIP_SQL,
    SYNC,
    envelopes,
    land,
    listing,
    sellers,
    specs,
)
from workload.job_queries import _price, _restock, _ship
from workload.metric_queries import _TREE_METRICS_SQL, _TREND_SQL, _daily, _nodes
from workload.reconcile_queries import _DIFF_SQL, _OLD_SQL, _diff, _new, _old
from workload.registry import query, table

# ---- versions ----------------------------------------------------------------------


@query(
    "a16_versioned_publish",
    """SELECT event_id, strftime(ts, '%Y-%m-%d') AS dt, CASE WHEN ts >= DATE '2024-01-15' AND ts < DATE '2024-01-20' THEN 'second'
       ELSE 'first' END AS batch FROM events WHERE ts < DATE '2024-01-15' OR ts >= DATE '2024-01-20' OR event_type <> 'view'""",
)
def a16_versions(spark, sf):
    """The second publish replaces five days together; the others stay as the first one wrote them."""
    target = new_dir(spark, "versions")
    rows = table(spark, sf, "events").select("event_id", "event_type", F.date_format("ts", "yyyy-MM-dd").alias("dt"))
    publish_version(rows.drop("event_type").withColumn("batch", F.lit("first")), target, "events", "one")
    again = rows.where("event_type <> 'view' AND dt BETWEEN '2024-01-15' AND '2024-01-19'").drop("event_type")
    done = again.withColumn("batch", F.lit("second"))
    publish_version(done, target, "events", "two", checks=(F.col("event_id").isNotNull(),), expected_rows=again.count())
    return read_published(spark, target, done.select("event_id", "batch", "dt").schema)


def _manifest(spark, spec):
    return read_manifest(spark, spec.target).select("dataset", "dt", "row_count", "seq")


query("m1_manifest", f"WITH {SHIP_SQL} SELECT '{SHIP}' AS dataset, '{DT}' AS dt, count(*) AS row_count, CAST(1 AS BIGINT) AS seq FROM items")(
    lambda spark, sf: _manifest(spark, _ship(spark, sf)[0])
)
query(
    "m2_manifest",
    """SELECT 'price_change' AS dataset, strftime(ts, '%Y-%m-%d') AS dt, count(*) AS row_count, CAST(seq AS BIGINT) AS seq FROM events
       JOIN (VALUES (1, DATE '2024-01-01', DATE '2024-01-21'), (2, DATE '2024-01-11', DATE '2024-01-31')) p(seq, a, b)
         ON ts >= a AND ts < b GROUP BY ALL""",
)(lambda spark, sf: _manifest(spark, _price(spark, sf)[0]))
query(
    "m3_manifest",
    f"WITH {NODES_SQL}, {SELLER_SQL} SELECT '{RESTOCK}' AS dataset, '{DT}' AS dt, count(*) AS row_count, CAST(1 AS BIGINT) AS seq FROM rows",
)(lambda spark, sf: _manifest(spark, _restock(spark, sf)[0]))


# ---- partition lists from metadata -------------------------------------------------------


def _landed(spark, sf):
    """Events as a dataset partitioned by day, and the days its folders name."""
    root, rows = new_dir(spark, "daily"), _daily(spark, sf)
    rows.repartition("dt").write.partitionBy("dt").parquet(root)
    return spark.read.schema(rows.select("user_id", "event_id", "kind", "at", "dt").schema).parquet(root), folder_days(spark, root)


_FOLDERS_SQL = "d AS (SELECT *, strftime(ts, '%Y-%m-%d') AS dt FROM events)"


@query(
    "e5_recent_folders",
    f"WITH {_FOLDERS_SQL} SELECT event_id, dt FROM d WHERE dt IN (SELECT DISTINCT dt FROM d WHERE dt <= '2024-01-25' ORDER BY dt DESC LIMIT 7)",
)
def e5_folders(spark, sf):
    rows, days = _landed(spark, sf)
    return recent_partitions(rows, "2024-01-25", 7, days).select("event_id", "dt")


@query("h2_folder_days", f"WITH {_FOLDERS_SQL} SELECT DISTINCT dt FROM d WHERE dt <= '2024-01-25' ORDER BY dt DESC LIMIT 7")
def h2_folders(spark, sf):
    return last_partitions(_landed(spark, sf)[1], "2024-01-25", 7)


@query("l7_landed_trend", f"WITH {_TREND_SQL} SELECT * FROM trend ORDER BY dt DESC")
def l7_landed(spark, sf):
    rows, days = _landed(spark, sf)
    return recon_trend(rows, "2024-01-28", "user_id", "event_id", "kind", "at", days=days)


@query(
    "a7_footer_census",
    """SELECT 'event_id,kind,biz_date,sync_time' AS columns, count(DISTINCT CAST(ts AS DATE)) AS days FROM events WHERE ts < DATE '2024-01-05'
       UNION ALL SELECT 'event_id,biz_date,sync_time', count(DISTINCT CAST(ts AS DATE)) FROM events WHERE ts >= DATE '2024-01-05' AND ts < DATE '2024-01-08'""",
)
def a7_census(spark, sf):
    """Days written before and after a column was lost: the footers show both schemas."""
    root, rows = new_dir(spark, "census"), _daily(spark, sf)
    types = {"event_id": "bigint", "kind": "string", "biz_date": "string", "sync_time": "string"}
    for day in range(1, 8):
        of_day = rows.where(F.col("dt") == f"2024-01-0{day}")
        kept = types if day < 5 else {n: t for n, t in types.items() if n != "kind"}
        write_flat(of_day.select(*[n for n in ("event_id", "kind") if n in kept]).coalesce(1), root, kept, f"2024-01-0{day}", SYNC)
    names = F.array_join(F.from_json(F.get_json_object("schema", "$.fields[*].name"), "array<string>"), ",")
    return footer_census(spark, root).select(names.alias("columns"), F.col("files").alias("days"))


# ---- acceptance of a sharded batch ---------------------------------------------------------


@query(
    "l9_sharded_rules",
    f"""WITH {_TREE_METRICS_SQL}, v AS (SELECT m[1][1:2] AS k, m[2] AS v FROM metrics UNION ALL SELECT '25', CAST(count(*) AS VARCHAR) FROM customer),
      rules AS (SELECT unnest(['25=03', '02=03', '04=05', '06=0', '09=12', '10=16', '11=17', '13=05', '14=0', '15=0', '18=0',
        '19=0', '20=0', '21=0', '22=0']) AS rule)
      SELECT rule, a.v AS actual, coalesce(b.v, rule[4:]) AS expected, a.v = coalesce(b.v, rule[4:]) AS passed
      FROM rules JOIN v a ON a.k = rule[1:2] LEFT JOIN v b ON b.k = rule[4:]""",
)
def l9_sharded(spark, sf):
    """Many envelopes that state the size of the batch are judged by that size, not by their number."""
    spec, nodes = specs()[RESTOCK], _nodes(spark, sf)
    stated = envelopes(spark, sf, RESTOCK).withColumn("batch_count", F.lit(table(spark, sf, "customer").count()))
    detail = tree_detail(spec, nodes, sellers(spark, sf), DT)
    return apply_rules(recon_metrics_long(envelope_verdict(stated, spec, DT), nodes, detail, DT, sharded=True), SHARDED_RULES)


# ---- comparison ---------------------------------------------------------------------


@query(
    "l12_align_batches",
    f"""WITH {_OLD_SQL}, n AS (SELECT *, strftime(placed, '%Y-%m') AS month FROM new),
      o AS (SELECT *, strftime(placed, '%Y-%m') AS month FROM old WHERE strftime(placed, '%Y-%m') NOT IN ('1996-03', '1997-07')),
      lost AS (SELECT string_agg(month, ',' ORDER BY month) AS only_new FROM (SELECT DISTINCT month FROM n WHERE month NOT IN (SELECT month FROM o)))
      SELECT 'new' AS side, month, count(*) AS n, 'near' AS boundary, only_new FROM n, lost WHERE month IN (SELECT month FROM o) GROUP BY ALL
      UNION ALL SELECT 'old', month, count(*), 'near', only_new FROM o, lost WHERE month IN (SELECT month FROM n) GROUP BY ALL""",
)
def l12_batches(spark, sf):
    """The older copy lacks its first months and two in the middle; only what both hold is compared."""
    month = F.date_format("placed", "yyyy-MM")
    new, old = (df.withColumn("month", month) for df in (_new(spark, sf), _old(spark, sf)))
    new, old, boundary = align_batches(new, old.where("month NOT IN ('1996-03', '1997-07')"), "month")
    sides = [df.groupBy(F.lit(s).alias("side"), "month").agg(F.count("*").alias("n")) for s, df in (("new", new), ("old", old))]
    found = boundary.select("boundary", F.array_join("only_new", ",").alias("only_new"))
    return sides[0].unionByName(sides[1]).crossJoin(F.broadcast(found))


@query(
    "l15_fault_sample",
    f"""WITH {_DIFF_SQL}, f AS (SELECT *, unnest(string_split(changed_columns, ',')) AS fault_column FROM diff WHERE status <> 'same'),
      r AS (SELECT *, row_number() OVER (PARTITION BY status, fault_column ORDER BY md5(CAST(k AS VARCHAR)), k) AS place FROM f)
      SELECT status, fault_column, CAST(place AS INT) AS place, k, CAST(n_new AS BIGINT) AS n_new, n_old, changed_columns FROM r WHERE place <= 5""",
)
def l15_faults(spark, sf):
    return fault_sample(_diff(spark, sf), ["k"], 5)


_CHAIN_SQL = f"""{SHIP_SQL}, c AS (SELECT (SELECT count(*) FROM ship) AS landed, (SELECT count(*) FROM items) AS expanded,
        (SELECT count(*) FROM items WHERE msku IS NOT NULL) AS kept,
        (SELECT count(*) FROM (SELECT DISTINCT sid, msku FROM items WHERE msku IS NOT NULL)) AS detail),
      s AS (SELECT CAST(unnest([1, 2, 3, 4]) AS BIGINT) AS stage_no, unnest(['landed', 'expanded', 'with sku', 'detail']) AS stage,
        unnest([landed, expanded, kept, detail]) AS row_count, unnest([0, expanded - landed, kept - expanded, detail - kept]) AS delta,
        unnest(['', 'further items', 'without sku', 'older rows of a key']) AS why, unnest([false, false, false, true]) AS last FROM c)"""


@query(
    "l16_explained_chain",
    f"""WITH {_CHAIN_SQL}, t AS (SELECT *, unnest(['right', 'wrong']) AS told FROM s),
      u AS (SELECT *, delta + CASE WHEN last AND told = 'wrong' THEN 1 ELSE 0 END AS said FROM t)
      SELECT told, stage_no, stage, row_count, delta, CASE WHEN why = '' THEN '' ELSE printf('%s %+d', why, said) END AS reasons,
        delta - said AS unexplained, CASE WHEN delta <> said THEN 'unexplained' WHEN why = '' THEN 'unchanged' ELSE 'explained' END AS result FROM u""",
)
def l16_explained(spark, sf):
    """Each reason is counted where it applies; one that is off by a row leaves a rest.

    The landed records are written once, since every count of both chains reads them.
    """
    with Scratch(spark) as scratch:
        landed = explode_records(envelopes(spark, sf, SHIP)).select(F.struct("rec.sid", "rec.item_list").alias("rec"))
        landed = scratch.materialize(landed, "landed")
        return pin(_chains(landed))


def _chains(landed):
    expanded = expand_children(landed, "item_list").select("rec.sid", F.trim("item.msku").alias("msku"), "item.id")
    kept = expanded.where("msku <> ''")
    keyed = kept.withColumn("key", F.concat_ws("/", "sid", "msku"))
    further = landed.agg(sum0(F.greatest(F.coalesce(F.array_size("rec.item_list"), F.lit(0)) - 1, F.lit(0))).alias("n"))
    blank = expanded.agg((-F.count_if(F.coalesce("msku", F.lit("")) == "")).alias("n"))
    older = keyed.groupBy("key").count().agg((-sum0(F.col("count") - 1)).alias("n"))
    told = {"right": older, "wrong": older.select((F.col("n") + 1).alias("n"))}
    chains = []
    for name, reason in told.items():
        stages = [
            Stage("landed", landed),
            Stage("expanded", expanded, {"further items": further}),
            Stage("with sku", kept, {"without sku": blank}),
            Stage("detail", dedup(keyed, "key", ["id"]), {"older rows of a key": reason}),
        ]
        chains.append(explained_chain(stages).select(F.lit(name).alias("told"), "*"))
    return chains[0].unionByName(chains[1])


# ---- nested levels and maintained state ----------------------------------------------------

_PLANS_SQL = f"""WITH {SHIP_SQL} SELECT id, item_pos AS level1_pos, CAST(r.p - 1 AS INT) AS level2_pos,
    'PL-' || o_orderkey || '-' || (item_pos + 1) || '-' || r.p AS plan,
    CAST(1 + (item_pos IS NOT NULL)::INT + (r.p IS NOT NULL)::INT AS INT) AS depth
    FROM items LEFT JOIN (SELECT unnest(range(1, 5)) AS p) r ON r.p <= item_pos - 1"""


def _plans(env):
    rows = expand_levels(env, ["item_list", "shipment_plan_list"])
    return rows.select(
        "rec.id", "level1_pos", "level2_pos", F.col("level2.shipment_plan_sn").alias("plan"),
        F.size(F.array_compact("position")).alias("depth"),
    )


@query("a1_nested_plans", _PLANS_SQL)
def a1_plans(spark, sf):
    """Plans of items of landed shipments: three levels below the envelope."""
    spec = land(spark, sf, SHIP)[SHIP]
    return _plans(read_envelopes(spark, spec.root, spec.record_schema, DT))


query("d3_expand_levels", _PLANS_SQL)(lambda spark, sf: _plans(envelopes(spark, sf, SHIP)))


@query(
    "e1_maintained_state",
    f"WITH {LISTING_SQL} SELECT sid, seller_sku, fnsku, id, create_time, parent_asin FROM newest",
)
def e1_state(spark, sf):
    """The newest listing per key after three batches; the last brings the oldest rows."""
    rows = listing(spark, sf).withColumn("seller_sku", F.trim("seller_sku")).withColumn("parent_asin", blank_to_null("parent_asin"))
    name, place = f"listing_state_{uuid.uuid4().hex}", new_dir(spark, "state")
    for part in ("1994-01-01 1996-12-31", "1997-01-01 9999-12-31", "1990-01-01 1993-12-31"):
        low, high = part.split()
        state = merge_latest(rows.where(F.col("create_time").between(low, high)), name, place, ["sid", "seller_sku", "fnsku"], ["create_time", "id"], 8)
    return state.select("sid", "seller_sku", "fnsku", "id", "create_time", "parent_asin")
