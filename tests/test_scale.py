"""Work done once and by all cores: what grows with the tables must not be repeated or left to one task."""

import pytest
from pyspark.sql import functions as F

from landfall.operators.expand import global_positions
from landfall.session import Scratch
from landfall.sources.versions import publish_version
from workload.batches import price_records, tree_records
from workload.registry import QUERIES


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def tables(spark, tmp_path):
    """Few rows of each table, one file each."""
    day = F.to_timestamp(F.lit("2024-01-15"))
    made = {
        "orders": spark.range(40).select(
            F.col("id").alias("o_orderkey"), (F.col("id") % 7).alias("o_custkey"), F.lit("F").alias("o_orderstatus"),
            day.alias("o_orderdate"), F.concat((F.col("id") % 5 + 1).cast("string"), F.lit("-X")).alias("o_orderpriority"),
        ),
        "lineitem": spark.range(60).select(
            F.col("id").alias("l_orderkey"), (F.col("id") % 9).alias("l_partkey"), F.col("id").alias("l_suppkey"),
            (F.col("id") % 5 + 1).cast("int").alias("l_linenumber"), F.lit("N").alias("l_returnflag"),
            F.lit("O").alias("l_linestatus"), day.alias("l_shipdate"),
        ),
        "events": spark.range(50).select(
            F.col("id").alias("event_id"), day.alias("ts"), F.lit(3).cast("bigint").alias("user_id"),
            F.lit("view").alias("event_type"), F.lit(1.5).alias("value"),
        ),
        "customer": spark.range(50).select(
            F.col("id").alias("c_custkey"), F.lit(2).alias("c_nationkey"), F.lit(1.5).alias("c_acctbal"),
            F.lit("BUILDING").alias("c_mktsegment"),
        ),
    }
    for name, df in made.items():
        df.coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def test_one_day_is_written_where_its_rows_are(spark, tmp_path):
    rows = spark.range(0, 100, 1, 5).withColumn("dt", F.lit("2024-01-31"))
    done = publish_version(rows, str(tmp_path / "t"), "d", "a", "2024-01-31", expected_rows=100)
    assert done.days == {"2024-01-31": 100}
    assert len(list((tmp_path / "t" / "v=a").rglob("part-*.parquet"))) == 5  # no task got the rows of the others


def test_records_of_one_small_file_are_built_by_all_cores(spark, tables):
    for records, key in ((price_records, "business_id"), (tree_records, "basic_info.hash_id")):
        df = records(spark, tables)
        assert df.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
        assert df.select(key).distinct().count() == df.count() == 50


def test_offsets_written_first_are_broadcast_and_records_stay_where_they_are(spark):
    staged = spark.range(0, 2000, 1, 4).select((F.col("id") % 40).alias("shard_no"), F.expr("cast(id div 40 as int)").alias("pos"))
    with Scratch(spark) as scratch:
        records = scratch.materialize(staged.withColumn("rec", F.repeat(F.lit("r"), 100)), "records")
        placed = global_positions(records, scratch=scratch)
        text = plan(placed)
        assert "BuildRight" in text and "Window" not in text and "hashpartitioning" not in text
        want = {(r.shard_no, r.pos, r.global_pos) for r in global_positions(staged).collect()}
        assert {(r.shard_no, r.pos, r.global_pos) for r in placed.collect()} == want and len(want) == 2000


@pytest.mark.parametrize("name", ["l16_explained_chain", "l16_count_chain", "k1_quality_parent_child", "l2_recon_counts"])
def test_reports_read_staged_rows_instead_of_building_records_for_every_count(spark, tables, name):
    report = QUERIES[name](spark, tables)
    assert "orders.parquet" not in plan(report)
    found = report.collect()
    if name == "l16_explained_chain":
        chain = [r.row_count for r in sorted(found, key=lambda r: r.stage_no) if r.told == "right"]
        assert chain[:2] == [40, 88]  # 8 orders each of 0 to 4 items; without items one row stays
        assert all(r.unexplained == 0 for r in found if r.told == "right")
    if name == "k1_quality_parent_child":
        assert found[0].source_expanded_count == found[0].target_row_count == found[0].target_distinct_id_count
        assert found[0].source_shipment_count == 40
