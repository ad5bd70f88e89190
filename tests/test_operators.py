import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from landfall.functions import technical_id
from landfall.operators.aggregates import (
    count_where,
    coverage,
    distribution,
    duplicate_rows,
    grain_duplicates,
    metrics_long,
    metrics_wide,
    size0,
    sum0,
)
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
from landfall.operators.expand import (
    expand_children,
    expand_siblings,
    expand_zipped,
    explode_records,
    global_positions,
    unfold_tree,
)
from landfall.operators.guards import GuardError, child_verdict
from landfall.operators.latest import dedup, enrich_latest, latest_per_key
from landfall.operators.pages import (
    collect_pages,
    landing_guard,
    missing_keys,
    page_faults,
    page_totals,
    record_faults,
    request_plan,
)
from landfall.operators.partitions import last_partitions, recent_partitions, touched_target
from landfall.session import Scratch
from landfall.operators.quality import apply_rules, recon_formula, trend_deviation

ITEM = "id BIGINT, item_list ARRAY<STRUCT<id BIGINT>>"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# ---- expansion ----------------------------------------------------------------------


def test_childless_parent_and_null_child(spark):
    data = [(1, None), (2, []), (3, [(30,)]), (4, [None]), (5, [(None,)])]
    rec = spark.createDataFrame([(d,) for d in data], f"rec STRUCT<{ITEM}>")
    rows = expand_children(rec, "item_list").select(
        "rec.id", "item_pos", technical_id("item_pos", "rec.id", "item.id").alias("tid")
    )
    assert sorted(map(tuple, rows.collect())) == [(1, None, -1), (2, None, -2), (3, 0, 30), (4, 0, None), (5, 0, None)]
    check = child_verdict(expand_children(rec, "item_list"), "rec.id", "item.id").first()
    assert (check.code, check.invalid_count, check.checked_count) == ("INVALID_PARENT_OR_ITEM_ID", 2, 5)


def test_item_id_clashing_with_a_negated_parent(spark):
    rec = spark.createDataFrame([((7, None),), ((8, [(-7,)]),)], f"rec STRUCT<{ITEM}>")
    check = child_verdict(expand_children(rec, "item_list"), "rec.id", "item.id").first()
    assert check.code == "DUPLICATE_TECHNICAL_ID"


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.none(), st.integers(0, 5)), min_size=1, max_size=30))
def test_expansion_keeps_every_parent(spark, sizes):
    data = [((i, None if n is None else [(k,) for k in range(n)]),) for i, n in enumerate(sizes)]
    rec = spark.createDataFrame(data, f"rec STRUCT<{ITEM}>")
    assert expand_children(rec, "item_list").count() == sum(max(1, n or 0) for n in sizes)


def test_siblings_and_zipped(spark):
    df = spark.createDataFrame(
        [(1, ["a", "b"], ["t"], ["x", "y", "z"]), (2, [], None, None)],
        "id int, sku array<string>, opened array<string>, sm array<string>",
    )
    zipped = expand_zipped(df, "sku", "opened", "s", "at")
    assert [(r.id, r.s, r["at"]) for r in zipped.orderBy("id", "s_pos").collect()] == [(1, "a", "t"), (1, "b", None), (2, None, None)]
    assert expand_siblings(df, {"s": "sku", "m": "sm"}).groupBy("id").count().orderBy("id").collect() == [(1, 6), (2, 1)]


def test_tree(spark):
    df = spark.createDataFrame(
        [(0, ((1,), [((2,),), ((3,),)])), (1, ((4,), None)), (2, ((5,), []))],
        "pos int, rec STRUCT<info: STRUCT<h: INT>, item_list: ARRAY<STRUCT<info: STRUCT<h: INT>>>>",
    )
    got = unfold_tree(df, "item_list", ["info"]).select("pos", "is_parent", "child_pos", "info.h").collect()
    assert sorted(map(tuple, got), key=str) == sorted(
        [(0, 1, None, 1), (0, 0, 0, 2), (0, 0, 1, 3), (1, 1, None, 4), (2, 1, None, 5)], key=str
    )
    assert plan(unfold_tree(df, "item_list", ["info"])).count("Scan") == 1


def test_global_positions_are_dense_over_all_envelopes(spark):
    shards = [(0, 3), (1, 1), (1 << 33, 4), ((1 << 33) + 5, 2), (7 << 33, 1)]
    data = [(s, p) for s, n in shards for p in range(n)]
    random.Random(1).shuffle(data)
    df = spark.createDataFrame(data, "shard_no bigint, pos int")
    rows = global_positions(df).collect()
    assert sorted(map(tuple, global_positions(df, ranges=2).collect())) == sorted(map(tuple, rows))
    assert sorted(r.global_pos for r in rows) == list(range(11))
    ordered = sorted(rows, key=lambda r: r.global_pos)
    assert [(r.shard_no, r.pos) for r in ordered] == sorted(data)


# ---- newest rows and joins ----------------------------------------------------------


def test_newest_wins_and_ties_go_to_the_larger_id(spark):
    df = spark.createDataFrame(
        [("k", "2024-01-01", 9, "old"), ("k", "2024-01-02", 1, "tie"), ("k", "2024-01-02", 2, "new"), ("z", None, 3, "z")],
        "key string, at string, id int, v string",
    )
    newest = latest_per_key(df, ["key"], ["at", "id"])
    assert {r.v for r in newest.collect()} == {"new", "z"}
    assert "WindowGroupLimit" in plan(newest)
    assert dedup(df, "key", ["at", "id"]).count() == 2


def test_enrichment_keeps_rows_and_null_keys_do_not_match(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "b"), (4, "c")], "id int, k string")
    dim = spark.createDataFrame(
        [("a ", "2", 1, "A2"), ("a", "1", 2, "A1"), (None, "1", 3, "N"), (" ", "1", 4, "B"), ("b", "1", 5, " ")],
        "k string, at string, id int, v string",
    )
    key = F.nullif(F.trim("k"), F.lit(""))
    out = enrich_latest(df, dim, {"k": F.col("k")}, ["at", "id"], {"v": F.nullif(F.trim("v"), F.lit(""))}, {"k": key})
    assert sorted(map(tuple, out.select("id", "v").collect())) == [(1, "A2"), (2, None), (3, None), (4, None)]
    assert out.columns == ["id", "k", "v"]


def test_small_written_dimension_is_broadcast_without_a_probe_shuffle(spark):
    df = spark.range(0, 1000, 1, 4).select((F.col("id") % 7).alias("k"), "id")
    dim = spark.range(7).select(F.col("id").alias("k"), F.lit("1").alias("at"), "id")
    with Scratch(spark) as scratch:
        out = enrich_latest(df, dim, {"k": F.col("k")}, ["at", "id"], {"v": F.col("id")}, scratch=scratch)
        assert out.where("v = k").count() == 1000
        assert "BroadcastHashJoin" in plan(out) and "hashpartitioning" not in plan(out)


def test_skewed_probe_partition_is_split(spark):
    """A hot key is split at run time instead of going to one task."""
    options = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {k: spark.conf.get(k, None) for k in options}
    for k, v in options.items():
        spark.conf.set(k, v)
    try:
        hot = F.when(F.col("id") < 60_000, F.lit(None)).otherwise(F.col("id")).cast("string")
        df = spark.range(0, 90_000, 1, 8).select(hot.alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("payload"))
        dim = spark.range(60_000, 90_000).select(F.col("id").cast("string").alias("k"), F.lit("1").alias("at"), "id")
        out = enrich_latest(df, dim, {"k": F.col("k")}, ["at", "id"], {"v": F.col("id")})
        out.write.format("noop").mode("overwrite").save()
        counted = out.groupBy().agg(F.count("*"), F.count("v"))
        assert tuple(counted.first()) == (90_000, 30_000)
        joined = enrich_latest(df, dim, {"k": F.col("k")}, ["at", "id"], {"v": F.col("id")})
        joined.collect()
        assert "skew=true" in plan(joined)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_partition_choice(spark, tmp_path):
    path = str(tmp_path / "t")
    days = [f"2024-01-{d:02d}" for d in range(1, 11)]
    spark.createDataFrame([(i, d) for i, d in enumerate(days)], "id int, dt string").write.partitionBy("dt").parquet(path)
    df = spark.read.schema("id INT, dt STRING").parquet(path)
    assert [r.dt for r in last_partitions(df, "2024-01-08", 3).collect()] == days[5:8][::-1]
    assert recent_partitions(df, "2024-01-08", 3).count() == 3
    touched = spark.createDataFrame([("2024-01-02",), ("2024-01-09",), ("2030-01-01",)], "dt string")
    pruned = touched_target(df, touched)
    assert pruned.count() == 2 and "PartitionFilters: [dt" in plan(pruned)
    assert touched_target(df, touched).count() == 2


# ---- aggregates ---------------------------------------------------------------------


def test_measures_over_no_rows_are_zero(spark):
    none = spark.createDataFrame([], "a bigint, b array<int>")
    got = none.agg(count_where(F.col("a") > 0), sum0("a"), size0("b"), duplicate_rows("a")).first()
    assert tuple(got) == (0, 0, 0, 0)


def test_distribution_and_coverage(spark):
    df = spark.createDataFrame([("a", 1, " "), ("a", 1, None), ("a", 2, "x"), (None, 3, "y")], "s string, p int, c string")
    assert {tuple(r) for r in distribution(df, ["s"], "p").collect()} == {("a", 3, 2), (None, 1, 1)}
    assert tuple(coverage(df, ["c"], ["c"]).first()) == (4, 2, 50.0)
    grain = {"s": F.coalesce("s", F.lit("")), "p": F.col("p")}
    assert tuple(grain_duplicates(df, grain).first()) == (1, 1)


def test_metric_reshaping(spark):
    row = spark.range(5).agg(F.count("*").alias("n"), F.max("id").alias("top"))
    long = metrics_long(row, {"n": "n", "top": "top"})
    assert {tuple(r) for r in long.collect()} == {("n", "5"), ("top", "4")}
    assert tuple(metrics_wide(long, ["top", "n", "none"]).first()) == ("4", "5", None)


def test_formula(spark):
    df = spark.createDataFrame([("2", "5", "3"), ("1", "5", "3"), ("0", None, " "), (None, "1", "1")], "d string, a string, b string")
    assert tuple(recon_formula(df, {"d": ("a", "b")}).first()) == (4, 1)


def test_rules_need_their_metrics(spark):
    long = spark.createDataFrame([("01_a", "1"), ("02_b", "5"), ("03_c", "5")], "metric_name string, metric_value string")
    got = {r.rule: r.passed for r in apply_rules(long, (("01", 1), ("02", "03"), ("04", "05"))).collect()}
    assert got == {"01=1": True, "02=03": True, "04=05": False}


def test_trend_deviation(spark):
    trend = spark.createDataFrame([("d1", 10), ("d2", 20), ("d3", 30)], "dt string, n bigint")
    row = trend_deviation(trend, ["n"]).first()
    assert (row.dt, row.prior_partitions, row.n, row.prior_mean_n, row.prior_median_n, row.n_ratio) == ("d3", 2, 30, 15.0, 15.0, 2.0)
    alone = trend_deviation(trend.where("dt = 'd1'"), ["n"]).first()
    assert (alone.n, alone.n_ratio) == (10, None)


# ---- pages --------------------------------------------------------------------------

PAGE = "key string, page_no int, offset bigint, total bigint, records array<struct<id: string>>"


def pages(spark, *rows):
    return spark.createDataFrame([(k, p, (p - 1) * 2, t, [(i,) for i in ids]) for k, p, t, ids in rows], PAGE)


def kinds(df, **options):
    return {(r.key, r.kind) for r in page_faults(df, **options).collect()}


def test_page_faults(spark):
    good = pages(spark, ("a", 1, 3, "12"), ("a", 2, 3, "3"), ("b", 1, 0, ""))
    assert kinds(good, max_page=2) == set()
    assert kinds(good, max_page=1) == {("a", "PAGE_LIMIT")}
    assert kinds(good, max_offset=1) == {("a", "OFFSET_LIMIT")}
    assert kinds(pages(spark, ("a", 1, 3, "12"), ("a", 2, 4, "34"))) == {("a", "TOTAL_CHANGED")}
    assert kinds(pages(spark, ("a", 1, 4, "12"), ("a", 2, 4, "12"))) == {("a", "DUPLICATE_PAGE")}
    assert kinds(pages(spark, ("a", 1, 4, "12"), ("a", 3, 4, "34"))) == {("a", "PAGE_GAP")}
    assert kinds(pages(spark, ("a", 1, 5, "12"))) == {("a", "TOTAL_MISMATCH")}
    assert kinds(pages(spark, ("a", 2, 2, "12"))) == {("a", "PAGE_GAP")}
    assert [tuple(r) for r in page_totals(good).orderBy("key").collect()] == [("a", 2, 3, 3, True), ("b", 1, 0, 0, True)]
    assert collect_pages(good).count() == 3


def test_records_and_plan(spark):
    df = spark.createDataFrame([(("1",),), (("1",),), ((" ",),), ((None,),), (None,)], "rec struct<id: string>")
    assert tuple(record_faults(df, "rec.id").first()) == (5, 1, 2, 1)
    keys = spark.createDataFrame([("a",), ("b",)], "key string")
    todo = request_plan(keys, "2024-01-31", 15, closed=True)
    assert tuple(todo.first()) == ("a", "2024-01-17 00:00:00", "2024-01-31 23:59:59")
    assert [r.key for r in missing_keys(todo, keys.where("key = 'a'")).collect()] == ["b"]


def test_landing_guard(spark):
    todo = spark.createDataFrame([("a",), ("b",)], "key string")
    good = pages(spark, ("a", 1, 2, "12"), ("b", 1, 1, "3"))
    assert landing_guard(good, todo, "id") == 3
    for bad, code in (
        (good.where("key = 'a'"), "MISSING_KEY"),
        (pages(spark, ("a", 1, 2, "12"), ("b", 1, 1, "1")), "DUPLICATE_RECORD_ID"),
        (pages(spark, ("a", 1, 9, "12"), ("b", 1, 1, "3")), "TOTAL_MISMATCH"),
        (pages(spark, ("a", 1, 0, ""), ("b", 1, 0, "")), "EMPTY_BATCH"),
    ):
        with pytest.raises(GuardError) as error:
            landing_guard(bad, todo, "id")
        assert error.value.code == code
    assert landing_guard(pages(spark, ("a", 1, 0, ""), ("b", 1, 0, "")), todo, "id", empty_policy="ALLOW") == 0


# ---- comparison ---------------------------------------------------------------------

TYPES = {"a": "string", "b": "decimal(12,2)"}


def side(spark, *rows):
    return spark.createDataFrame(list(rows), "k int, a string, b double")


def test_row_status_and_changed_columns(spark):
    new = side(spark, (1, "x", 1.0), (2, "x", 1.0), (3, "x", 1.0), (4, None, 1.0), (5, "x", 1.0), (6, "p|q", 1.0))
    old = side(spark, (1, "x", 1.0), (2, "x", 2.0), (9, "x", 1.0), (4, "", 1.0), (5, "x", 1.0), (5, "x", 1.0), (6, "p\\|q", 1.0))
    got = {r.k: (r.status, r.changed_columns) for r in compare_rows(new, old, ["k"], TYPES).collect()}
    assert got == {
        1: ("same", ""), 2: ("changed", "b"), 3: ("only_new", ""), 9: ("only_old", ""), 4: ("changed", "a"),
        5: ("changed", "a,b"), 6: ("changed", "a"),
    }
    hashed = {r.k: r.status for r in compare_hash(new, old, ["k"], TYPES).collect()}
    assert hashed == {k: v[0] for k, v in got.items()}
    sample = anomaly_sample(compare_rows(new, old, ["k"], TYPES), ["k"], 2)
    assert [r.k for r in sample.collect()] == [2, 3]
    assert anomaly_sample(compare_rows(new, new, ["k"], TYPES), ["k"]).count() == 0


def test_repeated_keys_compare_as_multisets_without_pairs(spark):
    new = side(spark, (1, "x", 1.0), (1, "y", 2.0))
    assert compare_rows(new, side(spark, (1, "y", 2.0), (1, "x", 1.0)), ["k"], TYPES).first().status == "same"
    assert compare_hash(new, side(spark, (1, "x", 2.0), (1, "y", 1.0)), ["k"], TYPES).first().status == "changed"
    tree = plan(compare_rows(new, new, ["k"], TYPES))
    assert "Join" not in tree and "SortAggregate" not in tree


def test_zones_and_scales_are_normalized(spark):
    new = spark.sql("SELECT 1 AS k, timestamp_ntz'2024-01-01 00:00:00' AS at, 1.10D AS p")
    old = spark.sql("SELECT 1 AS k, timestamp_ntz'2024-01-01 08:00:00.4' AS at, CAST(1.1 AS DECIMAL(20,6)) AS p")
    types = {"at": "timestamp(0)", "p": "decimal(20,2)"}
    assert compare_hash(new, old, ["k"], types, {"at": "UTC"}, {"at": "Asia/Shanghai"}).first().status == "same"
    assert compare_hash(new, old, ["k"], types).first().status == "changed"


def metrics(spark, **values):
    return spark.createDataFrame([(k, None if v is None else str(v)) for k, v in values.items()], "metric_name string, metric_value string")


def conclusion(report, boundary):
    return report_verdict(report, boundary, ("duplicates",)).first().conclusion


def test_report_and_conclusions(spark):
    new, old = metrics(spark, rows=12, duplicates=0, extra=1), metrics(spark, rows=10, duplicates=0)
    report = {r.metric: tuple(r)[1:] for r in two_system_report(new, old).collect()}
    assert report["rows"] == ("12", "10", "+2（20.00%）", "异常")
    assert report["duplicates"] == ("0", "0", "0", "一致")
    assert report["extra"] == ("1", "N/A", "N/A", "N/A")
    assert conclusion(two_system_report(new, new), "same") == "通过"
    assert conclusion(two_system_report(new, old), "same") == "不通过"
    assert conclusion(two_system_report(new, old), "near") == "条件通过"
    assert conclusion(two_system_report(new, old), "incomparable") == "未完成"
    missing = two_system_report(None, old)
    assert conclusion(missing, "same") == "未完成"
    assert {r.new_value for r in missing.collect()} == {"N/A"}
    assert conclusion(two_system_report(metrics(spark, rows=10, duplicates=3), old), "near") == "不通过"
    assert {r.metric_name for r in common_metrics(new, old).collect()} == {"rows", "duplicates"}


def test_snapshot_boundary(spark):
    frame = lambda *days: spark.createDataFrame([(d,) for d in days], "dt string")
    new, old, boundary = align_snapshot(frame("d1", "d2", "d3"), frame("d2", "d3", "d4"), "dt")
    assert boundary.first().boundary == "near" and new.count() == old.count() == 2
    assert align_snapshot(frame("d1", "d2"), frame("d1", "d2"), "dt")[2].first().boundary == "same"
    for other in (frame("d8"), frame("d8").where("dt = 'x'")):
        cut, _, boundary = align_snapshot(frame("d1"), other, "dt")
        assert boundary.first().boundary == "incomparable" and cut.count() == 0


def test_count_chain(spark):
    chain = count_chain([("a", spark.range(3), ""), ("b", spark.range(3), "x"), ("c", spark.range(7), "expansion")])
    assert [tuple(r)[1:] for r in chain.orderBy("stage_no").collect()] == [
        ("a", 3, 0, "unchanged"), ("b", 3, 0, "unchanged"), ("c", 7, 4, "expansion"),
    ]


def test_inner_explode_drops_empty_envelopes(spark):
    env = spark.createDataFrame([("a", [1, 2]), ("b", []), ("c", None)], "s string, data array<int>")
    assert explode_records(env, pos=True).count() == 2
