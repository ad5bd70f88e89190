"""Footers of many files, envelopes bounded by bytes, nested levels, comments, maintained state and explained comparisons."""

import random
import re
import uuid

import pytest
from pyspark.sql import functions as F

from landfall.operators.compare import Stage, align_batches, compare_rows, explained_chain, fault_sample
from landfall.operators.expand import expand_levels
from landfall.operators.guards import GuardError, envelope_guard, envelope_verdict
from landfall.operators.latest import enrich_from_state, enrich_latest, latest_per_key, merge_latest
from landfall.operators.quality import SHARDED_RULES, apply_rules
from landfall.plans import price_queue, restocking, shipments
from landfall.sources import flat
from landfall.sources.envelopes import read_envelopes, write_envelopes
from landfall.sources.flat import StorageConflict, decide_storage, read_flat, record_storage, recorded_storage, write_flat
from landfall.sources.footers import distinct_schemas, footer_census
from landfall.sources.schemas import SchemaError
from landfall.sources.tables import ensure_table
from landfall.spec import DatasetSpec, described

DT, SYNC = "2024-01-31", "2024-01-31 06:00:00"
TYPES = {"id": "bigint", "biz_date": "string", "sync_time": "string"}

# ---- files and envelopes ----------------------------------------------------------------


def test_two_thousand_footers_without_a_driver_call_each(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "many")
    rows = spark.range(2000).select("id", F.lit("a").alias("biz_date"), F.lit("b").alias("sync_time"))
    rows.repartitionByRange(2000, "id").write.parquet(f"{root}/dt={DT}")
    calls, load = [], type(spark.read).parquet
    monkeypatch.setattr(type(spark.read), "parquet", lambda self, *p, **k: calls.append(p) or load(self, *p, **k))
    assert read_flat(spark, root, TYPES, DT).count() == 2000
    assert len(calls) == 1
    (census,) = footer_census(spark, f"{root}/dt={DT}").collect()
    assert census.files == 2000 and census.problem is None
    spark.range(1).select(F.col("id").alias("other")).coalesce(1).write.mode("append").parquet(f"{root}/dt={DT}")
    with pytest.raises(SchemaError, match="other"):
        read_flat(spark, root, TYPES, DT)


def test_footers_of_other_writers_and_broken_files(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    pq.write_table(pa.table({"id": pa.array([1], pa.int64()), "t": ["x"]}), tmp_path / "own.parquet")
    (tmp_path / "bad.parquet").write_text("not parquet")
    found = {example.rsplit("/", 1)[1]: (schema, problem) for schema, example, problem in distinct_schemas(footer_census(spark, str(tmp_path)))}
    assert found["own.parquet"][0].simpleString() == "struct<id:bigint,t:string>" and found["bad.parquet"][0] is None
    assert footer_census(spark, str(tmp_path / "none")) is None


def test_storage_is_recorded_once_and_the_history_not_listed_again(spark, tmp_path, monkeypatch):
    root, spec = str(tmp_path / "r"), DatasetSpec(name="d", source="s", record_ddl="id BIGINT")
    write_flat(spark.range(3), root, TYPES, DT, SYNC)
    schema = spark.range(1).schema
    assert decide_storage(spark, root, spec, schema, 1) == "parquet"  # the one listing of a root without a record
    record_storage(spark, root, "parquet")
    monkeypatch.setattr(flat, "stored_formats", lambda *_: pytest.fail("listed the history"))
    assert recorded_storage(spark, root) == "parquet" and decide_storage(spark, root, spec, schema, 1) == "parquet"
    with pytest.raises(StorageConflict):
        record_storage(spark, root, "flat-json")
    record_storage(spark, root, "parquet")


def test_envelopes_are_bounded_by_bytes(spark, tmp_path):
    spec = DatasetSpec(name="d", source="s", record_ddl="id BIGINT, note STRING", root=str(tmp_path / "r"), max_envelopes=None)
    big = spark.range(0, 9, 1, 2).select("id", F.repeat(F.lit("x"), 5_000_000).alias("note"))
    small = spark.range(100, 400, 1, 2).select("id", F.lit("y").alias("note"))
    write_envelopes(big.unionByName(small), spec.root, spec, DT, SYNC, rows=309)
    env = read_envelopes(spark, spec.root, spec.record_schema, DT)
    sizes = env.select(F.aggregate("data", F.lit(0).cast("bigint"), lambda a, r: a + F.length(r["note"])).alias("n"), F.size("data").alias("k"))
    assert all(r.n < (8 << 20) for r in sizes.collect()) and sizes.count() >= 9
    assert envelope_guard(env, spec, DT) == 309
    lost = env.where("shard_no <> 0") if env.where("shard_no = 0").count() else env.orderBy("shard_no").offset(1)
    with pytest.raises(GuardError, match="MISSING_SHARD"):
        envelope_guard(lost, spec, DT)
    write_envelopes(small, spec.root, spec, DT, SYNC, rows=300)
    assert read_envelopes(spark, spec.root, spec.record_schema, DT).count() == 1


# ---- nested levels and comments ----------------------------------------------------------


def test_three_levels_keep_childless_rows(spark):
    ddl = "data array<struct<id:int,items:array<struct<id:int,plans:array<struct<sn:string>>>>>>"
    env = spark.createDataFrame([([(1, [(10, [("a",), ("b",)]), (11, []), (12, None)]), (2, []), (3, None)],)], ddl)
    got = expand_levels(env, ["items", "plans"]).select("rec.id", "level1.id", "level2.sn", "position").collect()
    assert [tuple(r) for r in got] == [
        (1, 10, "a", [0, 0, 0]), (1, 10, "b", [0, 0, 1]), (1, 11, None, [0, 1, None]), (1, 12, None, [0, 2, None]),
        (2, None, None, [1, None, None]), (3, None, None, [2, None, None]),
    ]


@pytest.mark.parametrize(("plan", "columns"), [(shipments, 47), (price_queue, 44), (restocking, 62)])
def test_catalog_shows_every_comment(spark, tmp_path, plan, columns):
    name = f"contract_{uuid.uuid4().hex}"
    ensure_table(spark, name, plan.FIELDS, str(tmp_path / "t"))
    shown = {r.col_name: (r.data_type, r.comment) for r in spark.sql(f"DESCRIBE {name}").collect() if r.col_name in {f.name for f in plan.FIELDS}}
    assert len(plan.FIELDS) == columns
    assert shown == {f.name: (f.type, f.comment) for f in plan.FIELDS} and all(c for _, c in shown.values())
    spark.sql(f"DROP TABLE {name}")
    with pytest.raises(ValueError, match="differ"):
        described(plan.FIELDS, {"id": "only one"})


# ---- maintained state --------------------------------------------------------------------


def test_maintained_state_equals_the_full_ranking(spark, tmp_path):
    random.seed(4)
    rows = [(random.choice([*range(30), None]), random.choice("ab"), random.choice([None, *range(1000)]), i, f"v{i}") for i in range(600)]
    ddl, keys, order = "k long, side string, at int, id int, v string", ["k", "side"], ["at", "id"]
    every, name = spark.createDataFrame(rows, ddl), f"state_{uuid.uuid4().hex}"
    batches = [every.where(F.col("id") % 3 == b) for b in (2, 0, 1)]  # late rows in each
    for i, batch in enumerate(batches):
        state = merge_latest(batch, name, str(tmp_path / "s"), keys, order, 4)
        seen = batches[0]
        for b in batches[1 : i + 1]:
            seen = seen.unionByName(b)
        want = latest_per_key(seen.dropna(subset=keys), keys, order)
        assert sorted(map(tuple, state.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    assert spark.catalog.tableExists(f"{name}_v2") and not spark.catalog.tableExists(f"{name}_v1")


def test_state_side_is_not_shuffled(spark, tmp_path):
    name, keys = f"state_{uuid.uuid4().hex}", ["k"]
    dim = spark.range(5000).select((F.col("id") % 700).alias("k"), "id", F.col("id").cast("string").alias("v"))
    for part in (0, 1):
        state = merge_latest(dim.where(F.col("id") % 2 == part), name, str(tmp_path / "s"), keys, ["id"], 4)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        probe = spark.range(2000).select((F.col("id") % 900).alias("p"))
        got = enrich_from_state(probe, state, {"k": F.col("p")}, {"v": F.col("v")})
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert len(re.findall(r"Exchange hashpartitioning\(", plan)) == 1 and "_probe_k" in re.search(r"Exchange hashpartitioning\(([^,]*)", plan)[1]
        want = enrich_latest(probe, dim, {"k": F.col("p")}, ["id"], {"v": F.col("v")})
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
        fresh = dim.where("id < 100")
        merged = spark.table(f"{name}_v2").join(fresh.select(F.struct("*").alias("_fresh")), F.col("k") == F.col("_fresh.k"), "full_outer")
        assert len(re.findall(r"Exchange hashpartitioning\(", merged._jdf.queryExecution().executedPlan().toString())) == 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


# ---- acceptance and comparison -----------------------------------------------------------


def test_complete_sharded_batch_passes_every_rule(spark):
    stated = {f"{i:02d}": "7" for i in range(1, 26)} | dict.fromkeys(["06", "14", "15", "18", "19", "20", "21", "22"], "0")
    metrics = spark.createDataFrame([(f"{k}_x", v) for k, v in stated.items()], "metric_name string, metric_value string")
    assert apply_rules(metrics, SHARDED_RULES).where("not passed").count() == 0
    assert [r.rule for r in apply_rules(metrics).where("not passed").collect()] == ["01=1"]
    lost = metrics.withColumn("metric_value", F.when(F.col("metric_name") == "03_x", "6").otherwise(F.col("metric_value")))
    assert {r.rule for r in apply_rules(lost, SHARDED_RULES).where("not passed").collect()} == {"25=03", "02=03"}
    spec = DatasetSpec(name="d", source="s", record_ddl="id BIGINT", max_envelopes=None)
    env = spark.createDataFrame([("s", "d", DT, 1, 2, [(1,)], DT), ("s", "d", DT, 1, 2, [(2,)], DT)], "source string, dataset string, biz_date string, record_count long, batch_count long, data array<struct<id:long>>, dt string")
    assert envelope_verdict(env, spec, DT).first().batch_count == 2


def test_alignment_by_batches(spark):
    def days(*values):
        return spark.createDataFrame([(d, 1) for d in values], "dt string, n int")

    new, old = days("01", "02", "03", "04", "05", "05", None), days("01", "04", "05", "09")
    a, b, boundary = align_batches(new, old, "dt")
    row = boundary.first()
    assert (row.boundary, row.common_batches, row.only_new, row.only_old) == ("near", 3, ["02", "03"], ["09"])
    assert sorted(r.dt for r in a.collect()) == ["01", "04", "05", "05"] and b.count() == 3
    assert align_batches(days("1"), days("1", "1"), "dt")[2].first().boundary == "same"
    assert align_batches(days("1"), days("2"), "dt")[2].first().boundary == "incomparable"
    assert align_batches(days("1"), days(), "dt")[0].count() == 0


def test_fault_sample_shows_every_column(spark):
    rows = [(i, f"a{i}", "b", "c") for i in range(300)]
    old = [(i, f"z{i}", "other" if i == 299 else "b", "other" if i == 150 else "c") for i in range(300)] + [(1000 + i, "", "", "") for i in range(20)]
    frames = [spark.createDataFrame(r, "k int, noisy string, rare string, other string") for r in (rows, old)]
    diff = compare_rows(*frames, ["k"], {c: "string" for c in ("noisy", "rare", "other")})
    got = fault_sample(diff, ["k"], 4).collect()
    kinds = {(r.status, r.fault_column): sum(1 for x in got if (x.status, x.fault_column) == (r.status, r.fault_column)) for r in got}
    assert kinds == {("changed", "noisy"): 4, ("changed", "rare"): 1, ("changed", "other"): 1, ("only_old", ""): 4}
    assert "WindowGroupLimit" in fault_sample(diff, ["k"], 4)._jdf.queryExecution().executedPlan().toString()


def test_chain_that_does_not_add_up(spark):
    def n(value):
        return spark.range(1).select(F.lit(value).alias("n"))

    stages = [Stage("in", spark.range(10)), Stage("out", spark.range(12), {"expanded": n(5), "blank": n(-3)}), Stage("kept", spark.range(9), {"dropped": n(-2)}), Stage("end", spark.range(9))]
    got = [(r.stage, r.delta, r.reasons, r.unexplained, r.result) for r in explained_chain(stages).orderBy("stage_no").collect()]
    assert got == [
        ("in", 0, "", 0, "unchanged"), ("out", 2, "blank -3, expanded +5", 0, "explained"),
        ("kept", -3, "dropped -2", -1, "unexplained"), ("end", 0, "", 0, "unchanged"),
    ]
    assert explained_chain([Stage("in", spark.range(3)), Stage("out", spark.range(2))]).where("result = 'unexplained'").count() == 1
