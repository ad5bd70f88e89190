import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landfall.operators.guards import GuardError, envelope_guard
from landfall.sources.envelopes import (
    batch,
    envelope_summary,
    matching_envelopes,
    read_envelopes,
    write_empty_envelope,
    write_envelopes,
)
from landfall.sources.flat import read_flat, stored_formats, write_flat, write_routed
from landfall.sources.keys import read_keys, valid_keys
from landfall.sources.publish import publish_batch, publish_latest, publish_partition, publish_touched, untouched_days
from landfall.sources.schemas import SchemaError, StorageUndecided, assert_schema, choose_storage
from landfall.sources.tables import ensure_table, read_legacy, register_partition
from landfall.spec import DatasetSpec, Field

DT, SYNC = "2024-01-31", "2024-01-31 06:00:00"
DDL = "id BIGINT, note STRING, tags ARRAY<STRING>"


def spec_for(tmp_path, **options):
    return DatasetSpec(name="demo", source="erp", record_ddl=DDL, root=str(tmp_path / "raw"), **options)


def drop_file(root, dt, name, *lines):
    folder = os.path.join(root, f"dt={dt}")
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write("\n".join(x if isinstance(x, str) else json.dumps(x) for x in lines))


def envelope(n=1, **change):
    data = [{"id": i, "note": "x", "tags": []} for i in range(n)]
    return {"source": "erp", "dataset": "demo", "biz_date": DT, "record_count": n, "sync_time": SYNC, "data": data, **change}


def test_roundtrip_keeps_every_record_and_bounds_envelopes(spark, tmp_path):
    spec = spec_for(tmp_path, max_envelopes=None)
    text = 'quote " comma , brace } 中文 \\ end'
    df = spark.range(0, 1003, 1, 3).select("id", F.lit(text).alias("note"), F.array(F.lit("a")).alias("tags"))
    write_envelopes(df, spec.root, spec, DT, SYNC, records_per_envelope=100)
    env = read_envelopes(spark, spec.root, spec.record_schema, DT).cache()
    assert env.agg(F.max(F.size("data"))).first()[0] <= 100
    assert env.where("record_count <> size(data)").count() == 0
    assert env.select("shard_no").distinct().count() == env.count()
    got = env.select(F.inline("data"))
    assert got.count() == got.select("id").distinct().count() == 1003
    assert got.select("note").distinct().first()[0] == text
    assert envelope_guard(env, spec, DT) == 1003
    # A rerun replaces the batch, and another date is left alone.
    write_envelopes(df.limit(5), spec.root, spec, "2024-01-30", SYNC)
    write_envelopes(df.limit(7), spec.root, spec, DT, SYNC)
    counts = read_envelopes(spark, spec.root, spec.record_schema).groupBy("dt").agg(F.sum("record_count")).collect()
    assert {tuple(r) for r in counts} == {(DT, 7), ("2024-01-30", 5)}


def test_only_json_files_are_read_and_dt_stays_text(spark, tmp_path):
    spec = spec_for(tmp_path)
    drop_file(spec.root, DT, "data.json", envelope(2))
    drop_file(spec.root, DT, "notes.txt", envelope(9))
    env = read_envelopes(spark, spec.root, spec.record_schema)
    assert env.count() == 1 and env.schema["dt"].dataType == T.StringType()
    assert envelope_summary(env, DT).first()["data_array_count"] == 2


def test_damaged_envelope_is_a_code_of_its_own(spark, tmp_path):
    for mode in ("strict", "filtered"):
        spec = spec_for(tmp_path / mode, mode=mode, max_envelopes=None)
        drop_file(spec.root, DT, "a.json", envelope(2))
        drop_file(spec.root, DT, "b.json", '{"source": "erp", "data": [{"id": 1')
        with pytest.raises(GuardError) as error:
            envelope_guard(read_envelopes(spark, spec.root, spec.record_schema), spec, DT)
        assert error.value.code == "CORRUPT_ENVELOPE"


def test_matching_and_batch(spark, tmp_path):
    spec = spec_for(tmp_path)
    drop_file(spec.root, DT, "a.json", envelope(1), envelope(2, dataset="other"), envelope(3, source=None))
    env = read_envelopes(spark, spec.root, spec.record_schema)
    assert batch(env, DT).count() == 3 and batch(env, "2024-01-01").count() == 0
    assert [r.record_count for r in matching_envelopes(env, spec, DT).collect()] == [1]
    plan = batch(env, DT)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan


def test_empty_day(spark, tmp_path):
    refused = spec_for(tmp_path)
    write_empty_envelope(spark, refused.root, refused, DT, SYNC)
    env = read_envelopes(spark, refused.root, refused.record_schema)
    with pytest.raises(GuardError, match="EMPTY_DATA"):
        envelope_guard(env, refused, DT)
    assert envelope_guard(env, spec_for(tmp_path, empty_policy="ALLOW"), DT) == 0


def test_flat_contract(spark, tmp_path):
    types = {"id": "bigint", "price": "decimal(12,2)", "biz_date": "string", "sync_time": "string"}
    df = spark.createDataFrame([(1, 2.5)], "id int, price double")
    root = str(tmp_path / "flat")
    write_flat(df, root, types, DT, SYNC)
    back = read_flat(spark, root, types, DT)
    assert back.columns == [*types, "dt"] and back.first()["biz_date"] == DT
    with pytest.raises(SchemaError):
        read_flat(spark, root, {**types, "id": "string"})
    with pytest.raises(SchemaError):
        read_flat(spark, root, {"price": "decimal(12,2)", "id": "bigint", "biz_date": "string", "sync_time": "string"})
    with pytest.raises(ValueError, match="biz_date"):
        write_flat(df, root, {"id": "bigint"}, DT, SYNC)
    with pytest.raises(ValueError, match="nested"):
        nested = df.withColumn("price", F.array("price"))
        write_flat(nested, root, {**types, "price": "string"}, DT, SYNC)


def test_storage_routing(spark, tmp_path):
    flat, nested = T.StructType.fromDDL("a INT"), T.StructType.fromDDL("a INT, b MAP<STRING, STRING>")
    assert choose_storage(nested) == "nested-json"
    assert choose_storage(flat, 10) == "flat-json" and choose_storage(flat, 10**6) == "parquet"
    for schema, rows in ((None, 5), (flat, None)):
        with pytest.raises(StorageUndecided):
            choose_storage(schema, rows)
    spec = DatasetSpec(name="demo", source="erp", record_ddl="a BIGINT", root=str(tmp_path / "r"))
    assert write_routed(spark.range(3).select(F.col("id").alias("a")), spec.root, spec, DT, SYNC, 3, rows=3) == "flat-json"
    assert read_envelopes(spark, spec.root, spec.record_schema, DT).first()["record_count"] == 3


def test_schema_contract(spark):
    df = spark.range(1).select("id", F.lit("x").alias("b"))
    assert assert_schema(df, T.StructType.fromDDL("id BIGINT, b STRING")) is df
    for bad in ("b STRING, id BIGINT", "id BIGINT", "id INT, b STRING"):
        with pytest.raises(SchemaError):
            assert_schema(df, T.StructType.fromDDL(bad))


def test_upstream_keys(spark, tmp_path):
    root = str(tmp_path / "keys")
    drop_file(
        root, DT, "data.json",
        {"record_count": 8, "data": [{"sid": "12"}, {"sid": " 12 "}, {"sid": 7}, {"sid": "x"}, {"sid": None}, "text", {"sid": " "}, {"sid": 1.5}]},
    )
    keys, stats = valid_keys(read_keys(spark, root, DT, "sid"))
    assert [r.key for r in keys.collect()] == [7, 12]
    assert tuple(stats.first()) == (8, 2, 5)


def test_register_partition_and_comments(spark, tmp_path):
    fields = (Field("id", "bigint", lambda: F.col("id"), comment="the id"),)
    spark.range(3).write.parquet(str(tmp_path / "elsewhere"))
    spark.sql("DROP TABLE IF EXISTS registered_demo")
    for _ in range(2):
        ensure_table(spark, "registered_demo", fields, str(tmp_path / "home"))
        register_partition(spark, "registered_demo", DT, str(tmp_path / "elsewhere"))
    table = spark.table("registered_demo")
    assert table.where(F.col("dt") == DT).count() == table.count() == 3
    assert table.schema["id"].metadata["comment"] == "the id"
    spark.sql("DROP TABLE registered_demo")


def test_legacy_reads_are_bounded(spark):
    df = spark.range(10)
    assert read_legacy(spark, df, None, ["id < 3", "id > 8"], ["id"]).count() == 4
    with pytest.raises(ValueError):
        read_legacy(spark, df, None, [], ["id"])


# ---- publishing ---------------------------------------------------------------------


def ids(spark, path):
    return sorted((r.dt, r.id) for r in spark.read.schema("id BIGINT, dt STRING").parquet(path).collect())


def test_partition_overwrite_is_idempotent_and_local(spark, tmp_path):
    path = str(tmp_path / "t")
    publish_partition(spark.range(2), path, "2024-01-01")
    publish_partition(spark.range(5), path, "2024-01-02")
    for _ in range(2):
        publish_partition(spark.range(1), path, "2024-01-02")
    assert ids(spark, path) == [("2024-01-01", 0), ("2024-01-01", 1), ("2024-01-02", 0)]
    with pytest.raises(GuardError, match="EMPTY_BATCH"):
        publish_partition(spark.range(0), path, "2024-01-01")
    assert len(ids(spark, path)) == 3
    publish_partition(spark.range(0), path, "2024-01-01", "ALLOW")
    assert ids(spark, path) == [("2024-01-02", 0)]


def test_touched_days_only(spark, tmp_path):
    path = str(tmp_path / "t")
    frame = lambda *rows: spark.createDataFrame(rows, "id bigint, dt string")
    publish_touched(frame((1, "d1"), (2, "d2"), (3, "d3")), path)
    later = frame((20, "d2"), (21, "d2"))
    publish_touched(later, path)
    assert ids(spark, path) == [("d1", 1), ("d2", 20), ("d2", 21), ("d3", 3)]
    window = spark.createDataFrame([("d1",), ("d2",)], "dt string")
    assert [r.dt for r in untouched_days(later, window).collect()] == ["d1"]


def test_latest_may_read_its_own_target(spark, tmp_path):
    path = str(tmp_path / "t")
    publish_latest(spark.range(3), path)
    publish_latest(spark.read.parquet(path).where("id > 0"), path)
    assert spark.read.parquet(path).count() == 2


def test_batch_is_all_or_nothing(spark, tmp_path):
    path, manifest = str(tmp_path / "t"), str(tmp_path / "m")
    good = spark.range(4)
    assert publish_batch(good, path, DT, [F.col("id") >= 0], manifest, "demo", "b1", expected_rows=4) == 4
    for options in ({"checks": [F.col("id") > 0]}, {"expected_rows": 5}, {"checks": [F.lit(None).cast("boolean")]}):
        with pytest.raises(GuardError):
            publish_batch(spark.range(2), path, DT, manifest=manifest, dataset="demo", batch_id="b2", **options)
    with pytest.raises(GuardError, match="EMPTY_BATCH"):
        publish_batch(spark.range(0), path, DT, manifest=manifest)
    assert len(ids(spark, path)) == 4
    assert [tuple(r) for r in spark.read.parquet(manifest).collect()] == [("demo", DT, "b1", 4)]


def test_landed_files_are_compressed_bounded_and_read_beside_plain_ones(spark, tmp_path):
    spec = spec_for(tmp_path, max_envelopes=None)
    df = spark.range(0, 4000, 1, 1).select("id", F.lit("the same words again").alias("note"), F.array(F.lit("a")).alias("tags"))
    write_envelopes(df, spec.root, spec, DT, SYNC, records_per_envelope=100)
    files = [f for f in (tmp_path / "raw" / f"dt={DT}").iterdir() if f.name.startswith("part-")]
    assert len(files) == 3 and all(f.name.endswith(".json.gz") for f in files)  # 40 envelopes, 16 to a file
    plain = read_envelopes(spark, spec.root, spec.record_schema, DT).select(F.to_json(F.struct("data")).alias("t"))
    assert sum(f.stat().st_size for f in files) < plain.agg(F.sum(F.length("t"))).first()[0] / 4
    drop_file(spec.root, DT, "late.json", envelope(2, shard_no=99))
    assert read_envelopes(spark, spec.root, spec.record_schema, DT).agg(F.sum("record_count")).first()[0] == 4002
    assert read_keys(spark, spec.root, DT, "id").count() == 4002
    assert stored_formats(spark, spec.root) == {"json"}
