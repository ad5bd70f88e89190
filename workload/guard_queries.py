"""Guards (J1-J8): every code fired on a batch spoilt as a whole, next to a clean run."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from landfall.operators.expand import expand_children, explode_records
from landfall.operators.guards import (
    Guard,
    GuardError,
    child_verdict,
    envelope_verdict,
    record_verdict,
    run_guards,
    staged_envelope_verdict,
)
from landfall.operators.pages import key_source_verdict, record_fault_verdict, record_faults
from landfall.session import Scratch, new_dir, pin
from landfall.sources.envelopes import stage_batch
from landfall.sources.publish import publish_partition
from workload.batches import DT, PRICE, RESTOCK, SHIP, SHIP_SQL, envelopes, specs, text
from workload.registry import query, table


def _union(frames: dict):
    """Verdicts of several scenarios as rows."""
    out = None
    for scenario, frame in frames.items():
        row = frame.select(F.lit(scenario).alias("scenario"), "code", "checked_count")
        out = row if out is None else out.unionByName(row)
    return out


# ---- envelopes ----------------------------------------------------------------------

_COUNTS = f"{SHIP_SQL}, c AS (SELECT count(*) AS n, count(DISTINCT (id - 1) // 500) AS e FROM ship)"


@query(
    "j1_envelope_strict",
    f"""WITH {_COUNTS}, s AS (
        SELECT 'pass' AS scenario, NULL AS limit_, 0 AS corrupt, e, 0 AS bad, n AS declared, n AS actual FROM c
        UNION ALL SELECT 'other day', NULL, 0, 0, 0, 0, 0 FROM c
        UNION ALL SELECT 'single file contract', 1, 0, e, 0, n, n FROM c
        UNION ALL SELECT 'foreign source', NULL, 0, e, e, n, n FROM c
        UNION ALL SELECT 'no data', NULL, 0, e, 0, n, 0 FROM c
        UNION ALL SELECT 'count off', NULL, 0, e, 0, n + e, n FROM c
        UNION ALL SELECT 'damaged', NULL, e, e, e, 0, 0 FROM c)
      SELECT scenario, CASE WHEN corrupt > 0 THEN 'CORRUPT_ENVELOPE' WHEN e = 0 THEN 'EMPTY_OSS_SOURCE'
        WHEN e > limit_ THEN 'UNEXPECTED_ENVELOPE_COUNT' WHEN bad > 0 THEN 'INVALID_ENVELOPE_METADATA'
        WHEN declared = 0 OR actual = 0 THEN 'EMPTY_SHIPMENT_DATA' WHEN declared <> actual THEN 'RECORD_COUNT_MISMATCH' END AS code,
        actual AS checked_count FROM s""",
)
def j1(spark, sf):
    env, spec = envelopes(spark, sf, SHIP), specs()[SHIP]
    empty = F.lit(None).cast(env.schema["data"].dataType)
    damaged = env.select(
        *[F.lit(None).cast(t).alias(c) for c, t in env.dtypes if c not in ("dt", "_corrupt")], F.lit("{").alias("_corrupt"), "dt"
    )
    return _union(
        {
            "pass": envelope_verdict(env, spec, DT),
            "other day": envelope_verdict(env, spec, "2024-02-01"),
            "single file contract": envelope_verdict(env, replace(spec, max_envelopes=1), DT),
            "foreign source": envelope_verdict(env.withColumn("source", F.lit(None).cast("string")), spec, DT),
            "no data": envelope_verdict(env.withColumn("data", empty), spec, DT),
            "count off": envelope_verdict(env.withColumn("record_count", F.col("record_count") + 1), spec, DT),
            "damaged": envelope_verdict(damaged, spec, DT),
        }
    )


@query(
    "j2_envelope_filtered",
    """WITH c AS (SELECT count(*) AS n, count(DISTINCT c_custkey // 500) AS e FROM customer)
       SELECT 'foreign ignored' AS scenario, CASE WHEN e > 1 THEN 'UNEXPECTED_ENVELOPE_COUNT' END AS code, n AS checked_count FROM c
       UNION ALL SELECT 'room for all', NULL, n FROM c
       UNION ALL SELECT 'only foreign', 'EMPTY_OSS_SOURCE', 0 FROM c
       UNION ALL SELECT 'no data', 'EMPTY_RESTOCKING_DATA', 0 FROM c
       UNION ALL SELECT 'count off', 'RECORD_COUNT_MISMATCH', n FROM c""",
)
def j2(spark, sf):
    env, base = envelopes(spark, sf, RESTOCK), specs()[RESTOCK]
    one, many = replace(base, max_envelopes=1), replace(base, max_envelopes=10**9)
    foreign = env.withColumn("dataset", F.lit("other"))
    empty = F.lit(None).cast(env.schema["data"].dataType)
    return _union(
        {
            "foreign ignored": envelope_verdict(env.unionByName(foreign), one, DT),
            "room for all": envelope_verdict(env.unionByName(foreign), many, DT),
            "only foreign": envelope_verdict(foreign, many, DT),
            "no data": envelope_verdict(env.withColumn("data", empty), many, DT),
            "count off": envelope_verdict(env.withColumn("record_count", F.col("record_count") + 1), many, DT),
        }
    )


@query(
    "j3_envelope_sharded",
    """WITH c AS (SELECT count(*) AS n FROM events)
       SELECT 'pass' AS scenario, NULL AS code, n AS checked_count FROM c
       UNION ALL SELECT 'only foreign', 'EMPTY_OSS_SOURCE', 0 FROM c UNION ALL SELECT 'no data', 'EMPTY_OSS_SOURCE', 0 FROM c
       UNION ALL SELECT 'count off', 'RECORD_COUNT_MISMATCH', n FROM c UNION ALL SELECT 'staged', NULL, n FROM c""",
)
def j3(spark, sf):
    env, spec = envelopes(spark, sf, PRICE), specs()[PRICE]
    with Scratch(spark) as scratch:
        staged = pin(staged_envelope_verdict(stage_batch(env, scratch), spec, DT).select("code", "checked_count"))
    empty = F.lit(None).cast(env.schema["data"].dataType)
    return _union(
        {
            "pass": envelope_verdict(env, spec, DT),
            "only foreign": envelope_verdict(env.withColumn("biz_date", F.lit("2024-01-01")), spec, DT),
            "no data": envelope_verdict(env.withColumn("data", empty), spec, DT),
            "count off": envelope_verdict(env.withColumn("record_count", F.col("record_count") - 1), spec, DT),
            "staged": staged,
        }
    )


# ---- records and children -----------------------------------------------------------


def _spoil(rec, **fields):
    """Replace fields of the record struct."""
    out = F.col("rec")
    for name, value in fields.items():
        out = out.withField(name, value)
    return rec.withColumn("rec", out)


_RECORD_SQL = f"""WITH {SHIP_SQL}, s AS (
  SELECT 'pass' AS scenario, 0 AS bad, count(*) AS n, count(DISTINCT id) AS d FROM ship
  UNION ALL SELECT 'bad time', count(*) FILTER (st = 'P'), count(*), count(DISTINCT id) FROM ship
  UNION ALL SELECT 'no shop', count(*) FILTER (st = 'F'), count(*), count(DISTINCT id) FROM ship
  UNION ALL SELECT 'blank number', count(*) FILTER (sid = 2), count(*), count(DISTINCT id) FROM ship
  UNION ALL SELECT 'repeated', 0, count(*), count(DISTINCT sid) FROM ship)
  SELECT scenario, CASE WHEN bad > 0 THEN 'INVALID_SHIPMENT_KEY_OR_TIME' WHEN n <> d THEN 'DUPLICATE_SHIPMENT_RECORD_ID' END AS code,
    n AS checked_count FROM s"""


@query("j4_record_guard", _RECORD_SQL)
def j4(spark, sf):
    rec, spec = explode_records(envelopes(spark, sf, SHIP)).select("rec"), specs()[SHIP]
    status = F.col("rec.shipment_status")
    day = F.substring("rec.gmt_create", 1, 10)
    cases = {
        "pass": rec,
        "bad time": _spoil(rec, gmt_create=F.when(status == "SHIPPED", day).otherwise(F.col("rec.gmt_create"))),
        "no shop": _spoil(rec, sid=F.when(status != "CLOSED", F.col("rec.sid"))),
        "blank number": _spoil(rec, shipment_id=F.when(F.col("rec.sid") == 2, " ").otherwise(F.col("rec.shipment_id"))),
        "repeated": _spoil(rec, id=F.col("rec.sid")),
    }
    return _union({k: record_verdict(df, spec) for k, df in cases.items()})


@query(
    "j5_child_guard",
    f"""WITH {SHIP_SQL}, s AS (
      SELECT 'pass' AS scenario, 0 AS bad, count(*) AS n, count(DISTINCT tid) AS d FROM items
      UNION ALL SELECT 'no item id', count(*) FILTER (item_pos = 2), count(*), count(DISTINCT CASE WHEN item_pos <> 2 OR item_pos IS NULL THEN tid END) FROM items
      UNION ALL SELECT 'null item', count(*) FILTER (item_pos = 0), count(*), 0 FROM items
      UNION ALL SELECT 'no parent id', count(*), count(*), 0 FROM items
      UNION ALL SELECT 'clash', 0, count(*), count(DISTINCT CASE WHEN item_pos IS NULL THEN tid ELSE 0 - id END) FROM items)
      SELECT scenario, CASE WHEN bad > 0 THEN 'INVALID_PARENT_OR_ITEM_ID' WHEN n <> d THEN 'DUPLICATE_TECHNICAL_ID' END AS code,
        n AS checked_count FROM s""",
)
def j5(spark, sf):
    rec = explode_records(envelopes(spark, sf, SHIP)).select("rec")

    def with_items(change):
        return _spoil(rec, item_list=F.transform("rec.item_list", change))

    nothing = lambda x: F.when(~x["id"].cast("string").endswith("001"), x)
    cases = {
        "pass": rec,
        "no item id": with_items(lambda x: x.withField("id", F.when(~x["sku"].endswith("-3"), x["id"]))),
        "null item": with_items(nothing),
        "no parent id": _spoil(rec, id=F.lit(None).cast("bigint")),
        "clash": with_items(lambda x: x.withField("id", 0 - F.col("rec.id"))),
    }
    return _union(
        {k: child_verdict(expand_children(df, "item_list"), "rec.id", "item.id") for k, df in cases.items()}
    )


@query(
    "j6_record_guard_digits",
    """WITH s AS (SELECT 'pass' AS scenario, 0 AS bad, 0 AS lossy, count(*) AS n, count(DISTINCT event_id) AS d FROM events
      UNION ALL SELECT 'blank key', count(*) FILTER (event_type = 'error'), 0, count(*), 0 FROM events
      UNION ALL SELECT 'padded key', count(*), 0, count(*), 0 FROM events
      UNION ALL SELECT 'bare date', count(*) FILTER (event_type = 'view'), 0, count(*), 0 FROM events
      UNION ALL SELECT 'no time', count(*) FILTER (event_type = 'click'), 0, count(*), 0 FROM events
      UNION ALL SELECT 'no such day', 0, 0, count(*), count(DISTINCT event_id) FROM events
      UNION ALL SELECT 'too long', 0, count(*), count(*), count(DISTINCT event_id) FROM events
      UNION ALL SELECT 'repeated', 0, 0, count(*), count(DISTINCT user_id) FROM events)
      SELECT scenario, CASE WHEN bad > 0 THEN 'INVALID_BUSINESS_KEY_OR_CREATE_TIME' WHEN lossy > 0 THEN 'LOSSY_CAST'
        WHEN n <> d THEN 'DUPLICATE_BUSINESS_ID' END AS code, n AS checked_count FROM s""",
)
def j6(spark, sf):
    rec, spec = explode_records(envelopes(spark, sf, PRICE)).select("sync_time", "rec"), specs()[PRICE]
    kind, key, at = F.col("rec.local_name"), F.col("rec.business_id"), F.col("rec.create_time")
    cases = {
        "pass": rec,
        "blank key": _spoil(rec, business_id=F.when(kind == "error", "  ").otherwise(key)),
        "padded key": _spoil(rec, business_id=F.concat(F.lit(" "), key)),
        "bare date": _spoil(rec, create_time=F.when(kind == "view", F.substring(at, 1, 10)).otherwise(at)),
        "no time": _spoil(rec, create_time=F.when(kind != "click", at)),
        "no such day": _spoil(rec, create_time=F.lit("2026-99-99 00:00:00")),
        "too long": _spoil(rec, business_id=F.concat(F.lit("9" * 20), key)),
        "repeated": _spoil(rec, business_id=F.col("rec.sid").cast("string")),
    }
    return _union({k: record_verdict(df, spec) for k, df in cases.items()})


# ---- extract ------------------------------------------------------------------------


@query(
    "j7_landing_guard",
    """WITH c AS (SELECT count(*) AS n FROM customer), e AS (SELECT count(*) AS n FROM events)
      SELECT 'pass' AS scenario, NULL AS code, n AS checked_count FROM c
      UNION ALL SELECT 'not an object', 'INVALID_TOP_LEVEL', 0 FROM c UNION ALL SELECT 'no array', 'DATA_NOT_ARRAY', 0 FROM c
      UNION ALL SELECT 'count is text', 'INVALID_RECORD_COUNT', n FROM c UNION ALL SELECT 'count off', 'RECORD_COUNT_MISMATCH', n FROM c
      UNION ALL SELECT 'no count', NULL, n FROM c UNION ALL SELECT 'no key', 'NO_VALID_KEY', 0 FROM c
      UNION ALL SELECT 'records pass', NULL, n FROM e UNION ALL SELECT 'bad record', 'INVALID_RECORD', n FROM e
      UNION ALL SELECT 'no id', 'MISSING_RECORD_ID', n FROM e UNION ALL SELECT 'same id', 'DUPLICATE_RECORD_ID', n FROM e
      UNION ALL SELECT 'all empty', 'EMPTY_BATCH', 0 FROM e UNION ALL SELECT 'empty allowed', NULL, 0 FROM e""",
)
def j7(spark, sf):
    key = F.col("c_custkey").cast("string")
    good = text('{"sid": ', key, "}")
    lines = {
        "pass": text('{"record_count": 1, "data": [', good, "]}"),
        "not an object": text("[", good, "]"),
        "no array": text('{"record_count": 1, "data": ', good, "}"),
        "count is text": text('{"record_count": "many", "data": [', good, "]}"),
        "count off": text('{"record_count": 2, "data": [', good, "]}"),
        "no count": text('{"data": [', good, "]}"),
        "no key": text('{"record_count": 1, "data": [{"sid": "x', key, '"}]}'),
    }
    customers, events = table(spark, sf, "customer"), table(spark, sf, "events")
    frames = {k: key_source_verdict(customers.select(v.alias("value")), "sid") for k, v in lines.items()}
    kind = F.col("event_type")
    records = {
        "records pass": F.struct(F.col("event_id").cast("string").alias("id")),
        "bad record": F.when(kind != "click", F.struct(F.col("event_id").cast("string").alias("id"))),
        "no id": F.struct(F.when(kind != "click", F.col("event_id").cast("string")).alias("id")),
        "same id": F.struct(F.col("user_id").cast("string").alias("id")),
    }
    for name, rec in records.items():
        frames[name] = record_fault_verdict(record_faults(events.select(rec.alias("rec")), "rec.id"))
    none = events.where("value < 0").select(records["records pass"].alias("rec"))
    frames["all empty"] = record_fault_verdict(record_faults(none, "rec.id"))
    frames["empty allowed"] = record_fault_verdict(record_faults(none, "rec.id"), "ALLOW")
    return _union(frames)


@query(
    "j8_fail_before_overwrite",
    f"WITH {SHIP_SQL} SELECT 'INVALID_SHIPMENT_KEY_OR_TIME' AS code, count(*) FILTER (st = 'P') AS invalid_count,"
    " (SELECT count(*) FROM ship) AS rows_kept FROM ship",
)
def j8(spark, sf):
    """A refused batch leaves the published partition as it was."""
    spec = replace(specs()[SHIP], target=f"{new_dir(spark, 'guarded')}/{SHIP}")
    env = envelopes(spark, sf, SHIP)
    rec = explode_records(env).select("rec")
    publish_partition(rec.select("rec.id"), spec.target, DT)
    bad = _spoil(rec, gmt_modified=F.when(F.col("rec.shipment_status") != "SHIPPED", F.col("rec.gmt_modified")))
    guards = [Guard("envelope", envelope_verdict(env, spec, DT)), Guard("record", record_verdict(bad, spec))]
    try:
        run_guards(guards)
        publish_partition(bad.select("rec.id").where("id < 0"), spec.target, DT, "ALLOW")
        code, invalid = "none", 0
    except GuardError as error:
        code, invalid = error.code, error.counts["invalid_count"]
    kept = spark.read.schema("id BIGINT, dt STRING").parquet(spec.target)
    return kept.agg(
        F.lit(code).alias("code"), F.lit(invalid).cast("bigint").alias("invalid_count"), F.count("*").alias("rows_kept")
    )
