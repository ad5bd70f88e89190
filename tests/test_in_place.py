"""Disk of the parent/child job: wide rows are neither shuffled nor sorted, and what a step leaves goes when it ends."""

import re

import pytest
from pyspark.sql import functions as F

from landfall.operators import latest
from landfall.operators.guards import GuardError
from landfall.operators.latest import enrich_in_place, enrich_latest, newest_dimension
from landfall.plans import jobs
from landfall.session import DROP_SHUFFLES, IN_PLACE, Scratch, byte_setting, settings
from landfall.sources.versions import publish_version, read_manifest
from workload.batches import DT, SHIP, land, listing

BROADCAST = "spark.sql.autoBroadcastJoinThreshold"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def tables(spark, tmp_path):
    """Orders of several files' worth of envelopes and their listing; one order and some listings without a key."""
    day = F.to_timestamp(F.lit("2024-01-15"))
    orders = spark.range(0, 300, 1, 3).select(
        F.col("id").alias("o_orderkey"), F.when(F.col("id") != 7, F.col("id") % 40).alias("o_custkey"),
        F.element_at(F.array(F.lit("F"), F.lit("O"), F.lit("P")), (F.col("id") % 3 + 1).cast("int")).alias("o_orderstatus"),
        day.alias("o_orderdate"), F.concat((F.col("id") % 5 + 1).cast("string"), F.lit("-X")).alias("o_orderpriority"),
    )
    lines = spark.range(400).select(
        F.col("id").alias("l_orderkey"), F.when(F.col("id") % 11 != 0, F.col("id") % 37).alias("l_partkey"),
        F.col("id").alias("l_suppkey"), (F.col("id") % 7 + 1).cast("int").alias("l_linenumber"),
        F.lit("R").alias("l_returnflag"), F.lit("F").alias("l_linestatus"), day.alias("l_shipdate"),
    )
    orders.write.parquet(f"{tmp_path}/orders.parquet")
    lines.coalesce(1).write.parquet(f"{tmp_path}/lineitem.parquet")
    return str(tmp_path)


def run(spark, tables, monkeypatch, **conf):
    """Report, published rows and plan of the detail step."""
    plans, detail = [], jobs.parent_child_detail

    def spied(*args):
        out = detail(*args)
        plans.append(plan(out))
        return out

    with monkeypatch.context() as patch, settings(spark, conf):
        patch.setattr(jobs, "parent_child_detail", spied)
        spec = land(spark, tables, SHIP)[SHIP]
        report = jobs.run_parent_child(spark, spec, DT, listing(spark, tables)).collect()
        rows = sorted(map(str, jobs.read_target(spark, spec).collect()))
    return report, rows, plans[0]


def test_wide_rows_stay_where_they_lie_beside_a_large_dimension(spark, tables, monkeypatch):
    small, large = run(spark, tables, monkeypatch), run(spark, tables, monkeypatch, **{BROADCAST: "-1"})
    assert small[:2] == large[:2]
    assert small[0][0].target_row_count == len(small[1]) > 600 and 0 < small[0][0].listing_country_unmatched_count < len(small[1])
    assert "BroadcastHashJoin" in small[2] and "SortMergeJoin" not in small[2]
    # Three shuffles: the dimension and the keys asked for, by the key; and what was found, by part.
    shuffles = re.findall(r"Exchange hashpartitioning\((\w+)#", large[2])
    assert len(shuffles) == 3 and sum(s == "_at_part" for s in shuffles) == 1
    wide = large[2][large[2].index("ShuffledHashJoin") : large[2].index("Exchange")]  # the left side, which is printed first
    assert "item_list" in wide and "Sort [" not in wide and "Bucketed: true" in wide


def test_the_job_leaves_no_table_no_setting_and_no_shuffle_files_behind(spark, tables, monkeypatch):
    names = [*DROP_SHUFFLES, *IN_PLACE, "spark.sql.maxConcurrentOutputFileWriters", latest.SCAN]
    before, inside, publish = [spark.conf.get(n, None) for n in names], {}, jobs.publish

    def spied(*args):
        inside.update({n: spark.conf.get(n, None) for n in names})
        return publish(*args)

    monkeypatch.setattr(jobs, "publish", spied)
    run(spark, tables, monkeypatch)
    assert [inside[n] for n in DROP_SHUFFLES] == ["true"] and [spark.conf.get(n, None) for n in names] == before
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("landfall_batch")]


def test_places_with_nulls_find_nothing_and_every_row_is_kept(spark):
    rows = [(1, 0, "a"), (1, 1, None), (2, None, "a"), (2, 0, "b"), (3, 5, "z")]
    df = spark.createDataFrame(rows, "part long, pos int, k string")
    dim = spark.createDataFrame([("a", 1, "old"), ("a", 2, "new"), ("b", 1, None), (None, 9, "none")], "k string, at int, v string")
    join = dict(on={"k": F.col("k")}, order=["at"], cols={"v": F.col("v")})
    with Scratch(spark) as scratch, settings(spark, IN_PLACE):
        staged = scratch.materialize_in_parts(df, "rows", "part", 4)
        out = enrich_in_place(staged, newest_dimension(dim, **join), join["on"], ["part", "pos"], 4, ["v"], ["k"])
        assert out.columns == ["part", "pos", "k", "v"]
        got = sorted(map(tuple, out.collect()), key=str)
    want = [(*r, "new" if r[2] == "a" and r[1] is not None else None) for r in rows]
    assert got == sorted(want, key=str)
    plain = enrich_latest(df.where("pos is not null"), dim, **join).collect()
    assert sorted(map(tuple, plain), key=str) == [r for r in got if r[1] is not None]


def test_the_day_of_a_publish_is_a_constant_of_the_write(spark, tmp_path, monkeypatch):
    """Then Spark has nothing to sort the rows by."""
    frames, rows = [], spark.range(50).withColumn("dt", F.lit(DT))
    real = type(rows).write
    monkeypatch.setattr(type(rows), "write", property(lambda df: (frames.append(df), real.fget(df))[1]))
    assert publish_version(rows, str(tmp_path / "t"), "d", "a", DT, expected_rows=50).days == {DT: 50}
    written = frames[0]._jdf.queryExecution().optimizedPlan().toString()
    assert f"{DT} AS dt" in written[: written.index("CollectMetrics")]


@pytest.mark.parametrize("other", ["2024-01-30", None])
def test_a_row_of_another_day_is_refused(spark, tmp_path, other):
    rows = spark.range(4).withColumn("dt", F.when(F.col("id") > 0, F.lit(DT)).otherwise(F.lit(other)))
    with pytest.raises(GuardError, match="ROW_COUNT_MISMATCH") as refused:
        publish_version(rows, str(tmp_path / "t"), "d", "a", DT)
    assert refused.value.counts["strays"] == 1 and read_manifest(spark, str(tmp_path / "t")).count() == 0


def test_a_task_that_ranks_reads_a_bounded_part_of_the_dimension(spark, tmp_path, monkeypatch):
    """Its rows are sorted, in memory if they fit."""
    seen, real = [], Scratch.materialize
    monkeypatch.setattr(Scratch, "materialize", lambda self, *a: (seen.append(byte_setting(spark, latest.SCAN)), real(self, *a))[1])
    dim = spark.createDataFrame([("a", 1)], "k string, at int")
    for given, want in (("128MB", latest.RANK_BYTES), ("16m", 16 << 20)):
        with settings(spark, {latest.SCAN: given}), Scratch(spark) as scratch:
            newest_dimension(dim, {"k": F.col("k")}, ["at"], {"v": F.col("at")}, scratch=scratch)
            assert seen.pop() == want and spark.conf.get(latest.SCAN) == given
            assert 0 < scratch.stored_bytes("dimension") < 10_000


def test_settings_come_back_and_sizes_are_read(spark):
    for text, size in (("10485760b", 10485760), ("256k", 256 << 10), ("1g", 1 << 30), ("-1", -1), ("7", 7), ("2MB", 2 << 20)):
        with settings(spark, {BROADCAST: text}):
            assert byte_setting(spark, BROADCAST) == size
    before = spark.conf.get(BROADCAST)
    with pytest.raises(ValueError), settings(spark, {BROADCAST: "1m"}):
        raise ValueError
    assert spark.conf.get(BROADCAST) == before
