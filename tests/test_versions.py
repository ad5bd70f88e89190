"""Versioned publishing, counts taken once, and partition lists from metadata."""

import os
import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from test_jobs import DT, drop, envelope, item, listing, ships, shipment  # noqa: F401  (fixtures)

from landfall.operators.guards import GuardError
from landfall.operators.partitions import last_partitions, recent_partitions
from landfall.operators.quality import quality_parent_child, recon_trend
from landfall.plans import jobs
from landfall.plans.jobs import load_batch, read_target, run_parent_child
from landfall.session import Scratch
from landfall.sources import versions
from landfall.sources.partitions import catalog_days, folder_days
from landfall.sources.versions import current_days, publish_version, read_manifest, read_published, read_version

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("dt", T.StringType())])
BOTH = ("2024-01-01", "2024-01-02")


def rows(spark, n, *days):
    return spark.range(n).select("id", F.explode(F.array(*[F.lit(d) for d in days])).alias("dt"))


def counts(df):
    return {r.dt: r["count"] for r in df.groupBy("dt").count().collect()}


def test_days_of_one_publish_change_together(spark, tmp_path):
    target = str(tmp_path / "t")
    publish_version(rows(spark, 4, *BOTH, "2024-01-03"), target, "d", "a")
    before = read_published(spark, target, SCHEMA)
    assert counts(before) == {**dict.fromkeys(BOTH, 4), "2024-01-03": 4}
    done = publish_version(rows(spark, 7, *BOTH), target, "d", "b")
    assert (done.seq, done.days, done.rows) == (2, dict.fromkeys(BOTH, 7), 14)
    assert counts(before) == {**dict.fromkeys(BOTH, 4), "2024-01-03": 4}  # opened before, finishes on the old rows
    assert counts(read_published(spark, target, SCHEMA)) == {**dict.fromkeys(BOTH, 7), "2024-01-03": 4}
    assert counts(read_published(spark, target, SCHEMA, ["2024-01-02", "1999-01-01"])) == {"2024-01-02": 7}
    assert counts(read_version(spark, target, SCHEMA, "a")) == {**dict.fromkeys(BOTH, 4), "2024-01-03": 4}
    assert {(r.dt, r.seq, r.row_count) for r in current_days(spark, target).collect()} == {(BOTH[0], 2, 7), (BOTH[1], 2, 7), ("2024-01-03", 1, 4)}
    entries = [f for _, _, files in os.walk(f"{target}/_manifest/seq=2") for f in files if f.endswith(".parquet")]
    assert len(entries) == 1  # one file puts both days in force


def test_failure_between_write_and_swap_leaves_the_old_day(spark, tmp_path, monkeypatch):
    target = str(tmp_path / "t")
    publish_version(rows(spark, 4, DT), target, "d", "a", DT)

    def fail(*_):
        raise OSError("no manifest")

    with monkeypatch.context() as m:
        m.setattr(versions, "commit_version", fail)
        with pytest.raises(OSError, match="no manifest"):
            publish_version(rows(spark, 9, DT), target, "d", "b", DT)
    assert os.path.exists(f"{target}/v=b/dt={DT}") and counts(read_published(spark, target, SCHEMA)) == {DT: 4}
    for batch, bad in (("c", {"expected_rows": 8}), ("d", {"checks": (F.col("id") < 5,)}), ("e", {"dt": "2024-02-01"})):
        with pytest.raises(GuardError):
            publish_version(rows(spark, 9, DT), target, "d", batch, **bad)
    assert counts(read_published(spark, target, SCHEMA)) == {DT: 4} and read_manifest(spark, target).count() == 1


def test_empty_day_repeated_batch_and_taken_number(spark, tmp_path, monkeypatch):
    target = str(tmp_path / "t")
    publish_version(rows(spark, 4, DT), target, "d", "a", DT)
    with pytest.raises(GuardError, match="EMPTY_BATCH"):
        publish_version(rows(spark, 0, DT), target, "d", "b", DT)
    done = publish_version(rows(spark, 0, DT), target, "d", "c", DT, empty_policy="ALLOW")
    assert done.days == {DT: 0} and read_published(spark, target, SCHEMA).count() == 0
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        publish_version(rows(spark, 1, DT), target, "d", "c", DT)
    stale = spark.createDataFrame([], f"{versions.MANIFEST}, seq bigint")
    monkeypatch.setattr(versions, "read_manifest", lambda *_: stale)  # as if two publishes had looked at the same moment
    assert versions.commit_version(spark, target, "d", "z", {DT: 1}) == 3


def test_days_from_before_the_manifest_are_taken_over(spark, tmp_path):
    target = str(tmp_path / "t")
    rows(spark, 5, *BOTH).write.partitionBy("dt").parquet(target)
    publish_version(rows(spark, 2, BOTH[1]), target, "d", "a")
    assert counts(read_published(spark, target, SCHEMA)) == {BOTH[0]: 5, BOTH[1]: 2}


def test_nothing_published(spark, tmp_path):
    assert read_published(spark, str(tmp_path / "none"), SCHEMA).count() == 0
    assert current_days(spark, str(tmp_path / "none")).count() == 0


def test_job_counts_once_and_reports_the_same(spark, ships, listing, monkeypatch):  # noqa: F811
    """Three distincts over the source and two over the target; the report equals the one counted anew."""
    drop(ships, envelope(ships, [shipment(1), shipment(2, []), shipment(3, [item(30), item(31, msku=None)])]))
    taken, distinct = [], F.countDistinct
    with monkeypatch.context() as m:
        m.setattr(F, "countDistinct", lambda *c: taken.append(c) or distinct(*c))
        report = run_parent_child(spark, ships, DT, listing, "first")
    assert len(taken) == 5
    with Scratch(spark) as scratch:
        _, records = load_batch(ships, DT, scratch)
        anew = quality_parent_child(
            records, read_target(spark, ships, DT), DT, "item_list", "id", "relate_id",
            ["shipment_id", "country", "parent_asin", "local_name"], ["gmt_create", "gmt_modified"], "shipment",
        ).withColumnRenamed("empty_country_count", "listing_country_unmatched_count")
        assert (report.columns, report.first()) == (anew.columns, anew.first())
    assert [(r.dataset, r.batch_id, r.dt, r.row_count, r.seq) for r in read_manifest(spark, ships.target).collect()] == [("shipment", "first", DT, 4, 1)]


def test_refusal_before_the_manifest_keeps_the_old_version(spark, ships, listing, monkeypatch):  # noqa: F811
    drop(ships, envelope(ships, [shipment(1)]))
    run_parent_child(spark, ships, DT, listing)
    drop(ships, envelope(ships, [shipment(2), shipment(3)]))
    lossy = jobs.parent_child_detail
    monkeypatch.setattr(jobs, "parent_child_detail", lambda *a: lossy(*a).limit(1))
    with pytest.raises(GuardError, match="ROW_COUNT_MISMATCH"):
        run_parent_child(spark, ships, DT, listing)
    assert [r.id for r in read_target(spark, ships).collect()] == [-1]


# ---- partition lists ------------------------------------------------------------------


@pytest.fixture
def daily(spark, tmp_path):
    days = [f"2024-01-{d:02d}" for d in range(1, 13)]
    frame = spark.range(240).select(
        "id", (F.col("id") % 5).alias("user"), F.lit("x").alias("kind"), F.element_at(F.array(*map(F.lit, days)), (F.col("id") % 12 + 1).cast("int")).alias("dt")
    )
    frame.repartition(4).write.partitionBy("dt").parquet(str(tmp_path / "daily"))
    schema = T.StructType.fromDDL("id BIGINT, user BIGINT, kind STRING, dt STRING")
    return spark.read.schema(schema).parquet(str(tmp_path / "daily")), str(tmp_path / "daily")


def read_files(df):
    """Number of files that the scans of a plan read."""
    plan = df._jdf.queryExecution().executedPlan()
    df.write.format("noop").mode("overwrite").save()
    return re.findall(r"PartitionFilters: \[([^\]]*)\]", plan.toString())


def test_recent_partitions_open_no_older_file(spark, daily):
    df, root = daily
    days = folder_days(spark, root)
    assert sorted(r.dt for r in days.collect()) == [f"2024-01-{d:02d}" for d in range(1, 13)]
    with open(f"{root}/dt=2024-01-03/part-broken.parquet", "w") as f:
        f.write("not a parquet file")  # opening it would fail
    recent = recent_partitions(df, "2024-01-10", 3, days)
    assert {r.dt for r in recent.select("dt").distinct().collect()} == {"2024-01-08", "2024-01-09", "2024-01-10"}
    assert all("dt" in f and " IN " in f for f in read_files(recent))
    trend = recon_trend(df, "2024-01-10", "user", "id", "kind", "id", 3, days=days)
    assert [(r.dt, r.row_count, r.parent_count) for r in trend.collect()] == [(f"2024-01-{d:02d}", 20, 5) for d in (10, 9, 8)]
    assert [r.dt for r in last_partitions(days, "2024-01-10", 2).collect()] == ["2024-01-10", "2024-01-09"]


def test_trend_finds_its_days_once(spark, daily, monkeypatch):
    from landfall.operators import partitions

    found, newest = [], partitions.last_partitions
    monkeypatch.setattr(partitions, "last_partitions", lambda *a: found.append(a) or newest(*a))
    assert recon_trend(daily[0], "2024-01-10", "user", "id", "kind", "id", 3).count() == 3
    assert len(found) == 1


def test_days_of_a_catalog_table(spark, daily):
    name = "versions_daily"
    spark.sql(f"CREATE TABLE {name} (id BIGINT, user BIGINT, kind STRING, dt STRING) USING parquet PARTITIONED BY (dt) LOCATION '{daily[1]}'")
    spark.sql(f"MSCK REPAIR TABLE {name}")
    assert catalog_days(spark, name).count() == 12
    assert recent_partitions(spark.table(name), "2024-01-10", 3, catalog_days(spark, name)).count() == 60
    spark.sql(f"DROP TABLE {name}")


def test_folder_days_of_nothing_and_of_escaped_names(spark, tmp_path):
    assert folder_days(spark, str(tmp_path / "none")).count() == 0
    spark.createDataFrame([(1, "a b+c:d%")], "id int, dt string").write.partitionBy("dt").parquet(str(tmp_path / "odd"))
    assert [r.dt for r in folder_days(spark, str(tmp_path / "odd")).collect()] == ["a b+c:d%"]
