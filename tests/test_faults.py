"""Inputs that once went wrong silently: drifted files, lost shards, changed storage, close times, wide numbers."""

from dataclasses import replace
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from landfall.functions import diff_text, normalize_biz_date, parse_biz_date
from landfall.operators.compare import align_snapshot, compare_hash, compare_rows, count_chain, two_system_report, unreadable_counts
from landfall.operators.expand import global_positions
from landfall.operators.guards import GuardError, child_guard, envelope_guard, record_verdict, staged_envelope_verdict
from landfall.operators.pages import landing_guard
from landfall.operators.partitions import combine_one_row
from landfall.plans import jobs
from landfall.session import Scratch
from landfall.sources.envelopes import read_envelopes, stage_batch, write_envelopes
from landfall.sources.flat import read_flat, write_flat, write_routed
from landfall.sources.schemas import SchemaError, StorageConflict
from landfall.sources.tables import ensure_table, register_partitions
from landfall.spec import DatasetSpec, Field

DT, SYNC = "2024-01-31", "2024-01-31 06:00:00"
PAGE = "key string, page_no int, `offset` bigint, total bigint, records array<struct<id:string>>"


def spec_at(path, **more):
    return DatasetSpec(name="d", source="s", record_ddl="id BIGINT", root=str(path), **more)


def ids(spark, n):
    return spark.range(n).select("id")


# --- storage ---------------------------------------------------------------------------------------


def test_a_dataset_keeps_one_storage(spark, tmp_path):
    spec = spec_at(tmp_path / "r")
    assert write_routed(ids(spark, 5), spec.root, spec, "2024-01-01", SYNC, 5, small_rows=10, rows=5) == "flat-json"
    assert write_routed(ids(spark, 50), spec.root, spec, "2024-01-02", SYNC, 50, small_rows=10, rows=50) == "flat-json"
    assert read_envelopes(spark, spec.root, spec.record_schema).agg(F.sum("record_count")).first()[0] == 55
    with pytest.raises(StorageConflict):
        write_routed(ids(spark, 5), spec.root, replace(spec, storage="parquet"), "2024-01-03", SYNC, 5)


def test_a_drifted_file_is_refused_and_a_sound_day_is_read(spark, tmp_path):
    root, types = str(tmp_path / "f"), {"id": "bigint", "biz_date": "string", "sync_time": "string"}
    write_flat(ids(spark, 3), root, types, "2024-01-01", SYNC)
    drifted = ids(spark, 3).select(F.col("id").alias("other"), F.lit("x").alias("biz_date"), F.lit("y").alias("sync_time"))
    drifted.coalesce(1).write.parquet(f"{root}/dt=2024-01-02")
    assert read_flat(spark, root, types, "2024-01-01").count() == 3
    for day in ("2024-01-02", None):
        with pytest.raises(SchemaError):
            read_flat(spark, root, types, day)
    write_flat(ids(spark, 3), root, types, "2024-01-03", SYNC)
    spark.range(2).selectExpr("'b' as biz_date", "'c' as sync_time").coalesce(1).write.mode("append").parquet(f"{root}/dt=2024-01-03")
    with pytest.raises(SchemaError):  # one file of several lacks a column
        read_flat(spark, root, types, "2024-01-03")


# --- shards ----------------------------------------------------------------------------------------


def test_the_default_contract_accepts_what_is_landed_here(spark, tmp_path):
    spec = spec_at(tmp_path / "e")
    write_envelopes(ids(spark, 6000).repartition(3), spec.root, spec, DT, SYNC, rows=6000)
    envelopes = read_envelopes(spark, spec.root, spec.record_schema, DT)
    assert envelopes.count() > 1 and envelope_guard(envelopes, spec, DT) == 6000


def test_a_lost_shard_is_noticed(spark, tmp_path):
    spec = spec_at(tmp_path / "e")
    write_envelopes(ids(spark, 4000).repartition(4), spec.root, spec, DT, SYNC, records_per_envelope=1000, rows=4000)
    envelopes = read_envelopes(spark, spec.root, spec.record_schema, DT)
    lost = envelopes.filter(F.col("shard_no") != envelopes.agg(F.max("shard_no")).first()[0])
    for one in (spec, replace(spec, max_envelopes=None), replace(spec, max_envelopes=None, mode="filtered")):
        assert envelope_guard(envelopes, one, DT) == 4000
        with pytest.raises(GuardError) as refused:
            envelope_guard(lost, one, DT)
        assert refused.value.code == "MISSING_SHARD"
    with Scratch(spark) as scratch:
        assert staged_envelope_verdict(stage_batch(lost, scratch), spec, DT).first().code == "MISSING_SHARD"


def test_one_envelope_whatever_arrow_does(spark, tmp_path):
    spec = spec_at(tmp_path / "e")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        write_envelopes(ids(spark, 1000).repartition(3), spec.root, spec, DT, SYNC, rows=1000)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert [r.record_count for r in read_envelopes(spark, spec.root, spec.record_schema, DT).collect()] == [1000]


def test_a_day_without_a_folder_is_empty(spark, tmp_path):
    spec = spec_at(tmp_path / "e")
    write_envelopes(ids(spark, 3), spec.root, spec, DT, SYNC, rows=3)
    assert read_envelopes(spark, spec.root, spec.record_schema, "2030-01-01").count() == 0


# --- landing ---------------------------------------------------------------------------------------


def pages(spark, *rows):
    return spark.createDataFrame([(k, p, o, t, [(i,) for i in records.split()]) for k, p, o, t, records in rows], PAGE)


def test_landing_checks_keys_both_ways_and_offsets(spark):
    plan = spark.createDataFrame([("a",)], "key string")
    good = pages(spark, ("a", 1, 0, 3, "1 2"), ("a", 2, 2, 3, "3"))
    assert landing_guard(good, plan, "id", max_offset=2) == 3
    cases = [
        (good.union(pages(spark, ("z", 1, 0, 1, "9"))), {}, "UNPLANNED_KEY"),
        (good, {"max_offset": 1}, "OFFSET_LIMIT"),
        (pages(spark, ("a", 1, 0, 5, "1"), ("a", 3, 2, 4, "2")), {}, "TOTAL_CHANGED"),  # gap and mismatch as well
        (pages(spark, ("a", 1, 0, 3, "1"), ("a", 3, 2, 3, "2")), {}, "PAGE_GAP"),
    ]
    for bad, more, code in cases:
        with pytest.raises(GuardError) as refused:
            landing_guard(bad, plan, "id", **more)
        assert refused.value.code == code


def test_a_failed_read_back_leaves_the_old_day(spark, tmp_path, monkeypatch):
    spec = DatasetSpec(name="d", source="s", record_ddl="id STRING", root=str(tmp_path / "r"))
    one, two = pages(spark, ("a", 1, 0, 1, "1")), pages(spark, ("a", 1, 0, 2, "2 3"))
    jobs.run_landing(spark, spec, DT, one, SYNC, "id")
    with monkeypatch.context() as m:
        m.setattr(jobs, "count_envelopes", lambda *a: -1)
        with pytest.raises(GuardError):
            jobs.run_landing(spark, spec, DT, two, SYNC, "id", manifest=str(tmp_path / "m"))
    old = read_envelopes(spark, spec.root, spec.record_schema, DT)
    assert old.select(F.inline("data")).first().id == "1" and not (tmp_path / "m").exists()
    jobs.run_landing(spark, spec, DT, two, SYNC, "id", manifest=str(tmp_path / "m"), batch_id="b1")
    new = read_envelopes(spark, spec.root, spec.record_schema, DT)
    assert envelope_guard(new, spec, DT) == 2 and spark.read.parquet(str(tmp_path / "m")).first().batch_id == "b1"


def test_times_can_be_held_to_the_calendar(spark):
    spec = DatasetSpec(name="d", source="s", record_ddl="at STRING", time_columns=("at",))
    rows = spark.createDataFrame([(("2024-02-30 10:00:00",),)], "rec struct<at:string>")
    assert record_verdict(rows, spec).first().code is None
    assert record_verdict(rows, replace(spec, strict_times=True)).first().code == "INVALID_KEY_OR_TIME"


def test_child_guard_follows_the_duplicate_policy(spark):
    spec = DatasetSpec(name="d", source="s", record_ddl="id BIGINT, c ARRAY<STRUCT<id: BIGINT>>", unique="id", child="c", on_duplicate="keep_newest")
    rows = spark.createDataFrame([((1, [(5,), (5,)]),)], "rec struct<id:bigint,c:array<struct<id:bigint>>>")
    assert child_guard(rows, spec) == 2


# --- comparison ------------------------------------------------------------------------------------


def test_rows_of_a_repeated_key_are_compared_as_rows(spark):
    new = spark.createDataFrame([(1, "x", 1), (1, "y", 2)], "k int, a string, b int")
    old = spark.createDataFrame([(1, "x", 2), (1, "y", 1)], "k int, a string, b int")
    types = {"a": "string", "b": "int"}
    assert compare_rows(new, old, ["k"], types).first().status == "changed"
    assert compare_rows(new, new.orderBy(F.desc("a")), ["k"], types).first().status == "same"


def test_times_are_compared_to_the_microsecond_unless_cut(spark):
    side = lambda t: spark.createDataFrame([(1, t)], "k int, at string")
    a, b = side("2024-01-01 00:00:00.1"), side("2024-01-01 00:00:00.9")
    for fn in (compare_rows, compare_hash):
        assert fn(a, b, ["k"], {"at": "timestamp"}).first().status == "changed"
        assert fn(a, b, ["k"], {"at": "timestamp(0)"}).first().status == "same"
        assert fn(a, side("2024-01-01 00:00:00.100"), ["k"], {"at": "timestamp"}).first().status == "same"
        assert fn(side(""), side("soon"), ["k"], {"at": "timestamp"}).first().status == "changed"
        assert fn(side(""), side(None), ["k"], {"at": "timestamp"}).first().status == "changed"
    rows = spark.createDataFrame([("2024-01-01", "1"), ("", "x"), (None, None)], "at string, n string")
    assert tuple(unreadable_counts(rows, {"at": "timestamp", "n": "int"}).first()) == (1, 1)


def test_numbers_are_compared_as_numbers(spark):
    metrics = lambda **m: spark.createDataFrame(list(m.items()), "metric_name string, metric_value string")
    new, old = metrics(a="10", b="1.50", c="x", d="7"), metrics(a="10.0", b="1.25", c="x", d="9")
    got = {r.metric: (r.diff, r.result) for r in two_system_report(new, old).collect()}
    assert got == {"a": ("0", "一致"), "b": ("+0.25（20.00%）", "异常"), "c": ("N/A", "一致"), "d": ("-2（22.22%）", "异常")}


def test_wide_differences_do_not_abort(rows):
    big = 9_000_000_000_000_000_000
    assert rows("a bigint, b bigint", [(big, 1_000_000_000_000_000_000)], diff_text("a", "b")) == [("+8000000000000000000（800.00%）",)]
    assert rows("a bigint, b bigint", [(big, 1)], diff_text("a", "b")) == [(f"+{big - 1}",)]


def test_snapshot_bounds_do_not_pass_through_the_process_zone(spark, monkeypatch):
    import time

    monkeypatch.setenv("TZ", "America/New_York")
    time.tzset()
    try:
        frame = lambda hours: spark.sql(f"SELECT timestamp_micros(1704067200000000 + id * 3600000000) AS at FROM range({hours[0]}, {hours[1]})")
        a, b, boundary = align_snapshot(frame((0, 10)), frame((0, 10)), "at")
        assert (a.count(), b.count(), boundary.first().boundary) == (10, 10, "same")
        a, b, boundary = align_snapshot(frame((0, 10)), frame((5, 15)), "at")
        assert (a.count(), b.count(), boundary.first().boundary) == (5, 5, "near")
    finally:
        monkeypatch.undo()
        time.tzset()


def test_a_reason_is_held_against_the_change(spark):
    stages = [("raw", ids(spark, 3), ""), ("kept", ids(spark, 5), "filter"), ("expanded", ids(spark, 9), "expansion"), ("unique", ids(spark, 8), "dedup")]
    assert [r.reason for r in count_chain(stages).collect()] == ["unchanged", "contradicted: filter", "expansion", "dedup"]


# --- small things ----------------------------------------------------------------------------------


def test_only_single_rows_are_put_side_by_side(spark):
    assert combine_one_row(ids(spark, 1), ids(spark, 1).toDF("b")).count() == 1
    for n in (0, 2):
        with pytest.raises(Exception, match="one row expected"):
            combine_one_row(ids(spark, 1), ids(spark, n).toDF("b")).collect()


def test_positions_do_not_depend_on_how_shards_are_numbered(spark):
    rows = [(s, p) for s in range(300) for p in range(s % 4)] + [(s, None) for s in range(300) if s % 4 == 0]
    got = global_positions(spark.createDataFrame(rows, "shard_no bigint, pos int"), ranges=16)
    assert sorted(r.global_pos for r in got.filter("pos is not null").collect()) == list(range(450))
    tree = got._jdf.queryExecution().executedPlan().toString()
    assert "windowspecdefinition(part" in tree


@pytest.mark.parametrize("text", ["20240131", "2024-01-31", " 2024-01-31 ", "2024-0131", "202401-31", "2024-02-30", "2024-1-3", "\t20240131", "", "x"])
def test_one_definition_of_a_business_date(spark, text):
    try:
        want = parse_biz_date(text)
    except ValueError:
        want = None
    assert spark.createDataFrame([(text,)], "t string").select(normalize_biz_date("t")).first()[0] == want
    assert (want is not None) == (text.strip(" ") in ("20240131", "2024-01-31"))


def test_published_days_show_in_the_catalog_table(spark, tmp_path):
    fields = (Field("id", "BIGINT", lambda: F.col("id"), comment="the id"),)
    spec = DatasetSpec(name="d", source="s", record_ddl="id BIGINT", target=str(tmp_path / "t"), table=f"faults_{datetime.now():%H%M%S%f}", fields=fields)
    for batch, days, n in (("a", ("2024-01-01", "2024-01-02"), 5), ("b", ("2024-01-02",), 3)):
        rows = spark.range(n).select("id", F.explode(F.array(*[F.lit(d) for d in days])).alias("dt"))
        jobs.publish(spec, rows, batch)
    table = spark.table(spec.table)
    assert table.count() == 8 and table.filter("dt = '2024-01-02'").count() == 3
    assert spark.sql(f"DESCRIBE {spec.table}").filter("col_name = 'id'").first().comment == "the id"
    ensure_table(spark, spec.table, fields, spec.target)
    register_partitions(spark, spec.table, {})
    spark.sql(f"DROP TABLE {spec.table}")
