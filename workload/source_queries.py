"""Sources, sinks and partitions."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from landfall.operators.guards import GuardError
from landfall.session import new_dir
from landfall.sources.envelopes import batch, matching_envelopes, read_envelopes, write_envelopes
from landfall.sources.flat import read_flat, write_flat
from landfall.sources.keys import read_keys, valid_keys
from landfall.sources.publish import publish_batch, publish_latest, publish_partition, publish_touched
from landfall.sources.schemas import assert_schema, choose_storage, schema_diff
from landfall.sources.tables import ensure_table, read_legacy, register_partition
from landfall.spec import DatasetSpec, Field
from landfall.functions import in_window
from workload.batches import DT, PRICE, SHIP, SHIP_SQL, SOURCE, SYNC, envelopes, land, ship_records, specs
from workload.registry import query, table

FLAT = {
    "event_id": "bigint", "ts": "timestamp_ntz", "user_id": "bigint", "event_type": "string",
    "value": "double", "biz_date": "string", "sync_time": "string",
}


@query(
    "a1_read_envelopes",
    f"WITH {SHIP_SQL} SELECT id, sid, shipment_id, '{SYNC}' AS sync_time, '{DT}' AS dt,"
    " CASE WHEN n = 0 AND st = 'F' THEN 'none' ELSE CAST(n AS VARCHAR) END AS n_items FROM ship",
)
def a1(spark, sf):
    spec = land(spark, sf, SHIP)[SHIP]
    env = read_envelopes(spark, spec.root, spec.record_schema)
    rec = env.select(F.col("sync_time").alias("batch_sync_time"), "dt", F.inline("data"))
    return rec.select("id", "sid", "shipment_id", F.col("batch_sync_time").alias("sync_time"), "dt", F.coalesce(F.array_size("item_list").cast("string"), F.lit("none")).alias("n_items"))


def _events_by_day(spark, sf):
    events = table(spark, sf, "events")
    return events.withColumn("dt", F.date_format("ts", "yyyy-MM-dd"))


@query(
    "a2_register_partition",
    "SELECT strftime(ts, '%Y-%m-%d') AS dt, count(*) AS n, min(event_id) AS first_id FROM events GROUP BY 1",
)
def a2(spark, sf):
    base = new_dir(spark, "register")
    days = _events_by_day(spark, sf)
    publish_touched(days, f"{base}/landed")
    name = f"landed_events_{uuid.uuid4().hex}"
    fields = [Field(f.name, f.dataType.simpleString(), None) for f in days.drop("dt").schema.fields]
    ensure_table(spark, name, fields, f"{base}/table")
    # The folder names are the partition list; each is registered twice to show that it is idempotent.
    for row in spark.read.parquet(f"{base}/landed").select(F.col("dt").cast("string")).distinct().toLocalIterator():
        for _ in range(2):
            register_partition(spark, name, row.dt, f"{base}/landed/dt={row.dt}")
    return spark.table(name).groupBy("dt").agg(F.count("*").alias("n"), F.min("event_id").alias("first_id"))


@query("a3_partition_batch", f"WITH {SHIP_SQL} SELECT id, sid, '{DT}' AS dt FROM ship")
def a3(spark, sf):
    spec = land(spark, sf, SHIP, PRICE)[SHIP]
    write_envelopes(ship_records(spark, sf), spec.root, spec, "2024-01-30", SYNC)
    env = read_envelopes(spark, spec.root, spec.record_schema)
    return batch(env, DT).select("dt", F.inline("data")).select("id", "sid", "dt")


@query("a4_matching_envelopes", f"WITH {SHIP_SQL} SELECT id, sid FROM ship")
def a4(spark, sf):
    # Every envelope lies beside three foreign ones: another source, another dataset, no date.
    env = envelopes(spark, sf, SHIP)
    other, nothing = F.lit("other"), F.lit(None).cast("string")
    landed = env
    for twin in (env.withColumn("source", other), env.withColumn("dataset", other), env.withColumn("biz_date", nothing)):
        landed = landed.unionByName(twin)
    kept = matching_envelopes(landed, specs()[SHIP], DT)
    return kept.select(F.inline("data")).select("id", "sid")


@query(
    "a5_write_envelopes",
    f"WITH {SHIP_SQL} SELECT count(*) AS declared, count(*) AS landed, count(DISTINCT id) AS ids,"
    " true AS bounded, true AS shards_unique FROM ship",
)
def a5(spark, sf):
    base = new_dir(spark, "sink")
    spec = specs(base)[SHIP]
    write_envelopes(ship_records(spark, sf), spec.root, spec, DT, SYNC, records_per_envelope=700)
    env = read_envelopes(spark, spec.root, spec.record_schema, DT)
    sizes = env.agg(
        F.sum("record_count").alias("declared"), F.sum(F.array_size("data")).cast("bigint").alias("landed"),
        (F.max(F.array_size("data")) <= 700).alias("bounded"),
        (F.count("*") == F.countDistinct("shard_no")).alias("shards_unique"),
    )
    ids = env.select(F.inline("data")).agg(F.countDistinct("id").alias("ids"))
    return sizes.crossJoin(F.broadcast(ids))


_FLAT_SQL = (
    f"SELECT event_id, ts, user_id, event_type, value, '{DT}' AS biz_date, '{SYNC}' AS sync_time, '{DT}' AS dt FROM events"
)


@query("a6_write_flat", _FLAT_SQL)
def a6(spark, sf):
    root = new_dir(spark, "flat")
    write_flat(table(spark, sf, "events"), root, FLAT, DT, SYNC)
    return spark.read.parquet(root).withColumn("dt", F.col("dt").cast("string"))


@query("a7_read_flat", _FLAT_SQL)
def a7(spark, sf):
    root = new_dir(spark, "flat")
    for dt in ("2024-01-30", DT):
        write_flat(table(spark, sf, "events"), root, FLAT, dt, SYNC)
    return read_flat(spark, root, FLAT, DT)


@query(
    "a8_choose_storage",
    """
    SELECT 'orders' AS dataset, CASE WHEN count(*) <= 20000 THEN 'flat-json' ELSE 'parquet' END AS storage FROM orders
    UNION ALL SELECT 'lineitem', CASE WHEN count(*) <= 20000 THEN 'flat-json' ELSE 'parquet' END FROM lineitem
    UNION ALL SELECT 'shipment', CASE WHEN count(*) > 0 THEN 'nested-json' END FROM orders
    """,
)
def a8(spark, sf):
    inputs = {"orders": table(spark, sf, "orders"), "lineitem": table(spark, sf, "lineitem"), SHIP: ship_records(spark, sf)}
    rows = [(name, choose_storage(df.schema, df.count(), small_rows=20_000)) for name, df in inputs.items()]
    return spark.createDataFrame(rows, "dataset string, storage string")


@query("a9_read_keys", "SELECT c_custkey AS key FROM customer WHERE c_mktsegment <> 'FURNITURE'")
def a9(spark, sf):
    root = new_dir(spark, "keys")
    spec = DatasetSpec(name="shop", source=SOURCE, record_ddl="sid STRING, label STRING", root=root)
    customers = table(spark, sf, "customer").select(
        F.when(F.col("c_mktsegment") == "FURNITURE", " ")
        .otherwise(F.concat(F.lit(" "), F.col("c_custkey").cast("string")))
        .alias("sid"),
        F.col("c_name").alias("label"),
    )
    write_envelopes(customers, root, spec, DT, SYNC)
    return valid_keys(read_keys(spark, root, DT, "sid"))[0]


_DETAIL = (
    Field("event_id", "bigint", lambda: F.col("event_id"), comment="event"),
    Field("price", "decimal(12,2)", lambda: F.col("value"), comment="it's a price"),
)


@query(
    "a10_ensure_table",
    "SELECT strftime(ts, '%Y-%m-%d') AS dt, count(*) AS n, CAST(sum(CAST(value AS DECIMAL(12,2))) AS DOUBLE) AS total,"
    " 'it''s a price' AS price_comment FROM events GROUP BY 1",
)
def a10(spark, sf):
    base, name = new_dir(spark, "table"), f"detail_events_{uuid.uuid4().hex}"
    for _ in range(2):
        ensure_table(spark, name, _DETAIL, base, comment="events by day")
    rows = _events_by_day(spark, sf).select(*[f.build().cast(f.type).alias(f.name) for f in _DETAIL], "dt")
    rows.hint("rebalance", F.col("dt")).write.mode("append").insertInto(name)
    comment = spark.table(name).schema["price"].metadata["comment"]
    return (
        spark.table(name)
        .groupBy("dt")
        .agg(F.count("*").alias("n"), F.sum("price").cast("double").alias("total"))
        .withColumn("price_comment", F.lit(comment))
    )


@query("a11_read_legacy", "SELECT o_orderkey, o_totalprice FROM orders")
def a11(spark, sf):
    bounds = ["o_orderdate < DATE '1998-01-01'", "o_orderdate >= DATE '1998-01-01'"]
    return read_legacy(spark, table(spark, sf, "orders"), None, bounds, ["o_orderkey", "o_totalprice"])


@query(
    "a12_assert_schema",
    "SELECT count(*) AS n, count(DISTINCT o_custkey) AS customers, CAST(2 AS INT) AS differences FROM orders",
)
def a12(spark, sf):
    declared = "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE"
    wrong = "o_orderkey BIGINT, o_totalprice DOUBLE, o_custkey BIGINT, o_orderstatus BIGINT"
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    checked = assert_schema(orders, T.StructType.fromDDL(declared))
    found = schema_diff(orders.schema, T.StructType.fromDDL(wrong))
    return checked.agg(
        F.count("*").alias("n"), F.countDistinct("o_custkey").alias("customers"), F.lit(len(found)).alias("differences")
    )


@query(
    "a13_publish_partition",
    f"SELECT o_orderkey, CAST(2 AS INT) AS version, '{DT}' AS dt FROM orders WHERE o_orderstatus <> 'P'"
    " UNION ALL SELECT o_orderkey, 1, '2024-01-30' FROM orders",
)
def a13(spark, sf):
    path, orders = new_dir(spark, "static"), table(spark, sf, "orders")
    one = orders.select("o_orderkey", F.lit(1).alias("version"))
    two = orders.where("o_orderstatus <> 'P'").select("o_orderkey", F.lit(2).alias("version"))
    publish_partition(one, path, DT)
    publish_partition(one, path, "2024-01-30")
    publish_partition(one, path, "2024-01-29")
    publish_partition(one.where("version = 0"), path, "2024-01-29", empty_policy="ALLOW")
    publish_partition(two, path, DT)
    return spark.read.schema("o_orderkey BIGINT, version INT, dt STRING").parquet(path)


@query(
    "a14_publish_touched",
    "SELECT event_id, CAST(CASE WHEN ts >= DATE '2024-01-11' THEN 2 ELSE 1 END AS INT) AS version,"
    " strftime(ts, '%Y-%m-%d') AS dt FROM events",
)
def a14(spark, sf):
    path, days = new_dir(spark, "dynamic"), _events_by_day(spark, sf)
    publish_touched(days.select("event_id", F.lit(1).alias("version"), "dt"), path)
    again = days.where(in_window("ts", "2024-01-30", 20))
    publish_touched(again.select("event_id", F.lit(2).alias("version"), "dt"), path)
    return spark.read.schema("event_id BIGINT, version INT, dt STRING").parquet(path)


@query("a15_publish_latest", "SELECT o_orderkey, CAST(2 AS INT) AS version FROM orders")
def a15(spark, sf):
    path = new_dir(spark, "whole")
    publish_latest(table(spark, sf, "orders").select("o_orderkey", F.lit(1).alias("version")), path)
    # The second batch is derived from the table it replaces.
    publish_latest(spark.read.parquet(path).withColumn("version", F.col("version") + 1), path)
    return spark.read.parquet(path)


@query(
    "a16_publish_batch",
    f"SELECT 'orders' AS dataset, '{DT}' AS dt, 'b1' AS batch_id, count(*) AS row_count, count(*) AS landed,"
    " 'CHECK_FAILED' AS refused FROM orders",
)
def a16(spark, sf):
    base, orders = new_dir(spark, "batch"), table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    path, manifest = f"{base}/data", f"{base}/manifest"
    publish_batch(orders, path, DT, [F.col("o_totalprice") > 0], manifest, "orders", "b1")
    try:
        publish_batch(orders, path, DT, [F.col("o_totalprice") < 100_000], manifest, "orders", "b2")
        refused = "none"
    except GuardError as error:
        refused = error.code
    landed = spark.read.parquet(path).agg(F.count("*").alias("landed"), F.lit(refused).alias("refused"))
    return spark.read.parquet(manifest).crossJoin(F.broadcast(landed))
