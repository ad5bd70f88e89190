"""The jobs on small landed files: contracts, idempotence, refusal before overwrite."""

import json
import os
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from landfall.operators.guards import GuardError, child_guard, record_guard
from landfall.plans.jobs import (
    load_batch,
    parent_child_detail,
    read_target,
    run_dynamic_dates,
    run_landing,
    run_parent_child,
    run_tree,
)
from landfall.plans.price_queue import price_queue_spec
from landfall.plans.restocking import restocking_spec
from landfall.plans.shipments import shipment_spec
from landfall.session import Scratch, new_dir, shared_dir
from landfall.sources.envelopes import read_envelopes
from landfall.spec import DatasetSpec, contract_schema

DT, SYNC = "2024-01-31", "2024-01-31 06:00:00"


def drop(spec, *envelopes, dt=DT):
    folder = os.path.join(spec.root, f"dt={dt}")
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, "data.json"), "w") as f:
        f.write("\n".join(json.dumps(e, ensure_ascii=False) for e in envelopes))


def envelope(spec, records, dt=DT, sync=SYNC, **change):
    head = {"source": spec.source, "dataset": spec.name, "biz_date": dt, "record_count": len(records), "sync_time": sync}
    return {**head, "data": records, **change}


def detail(spark, spec, dt=None):
    return [r.asDict() for r in read_target(spark, spec, dt).collect()]


# ---- shipments ----------------------------------------------------------------------


def shipment(id_, items=None, **change):
    base = {
        "id": id_, "sid": 1, "shipment_id": f"S{id_}", "gmt_create": "2024-01-01 08:00", "gmt_modified": "2024-01-02 08:00:00",
        "shipping_mode": " FREIGHT_LTL ", "is_closed": 1, "seller": "  ", "item_list": items,
        "ship_from_address": {"name": " A ", "phone": "1"}, "ship_to_address": {"doorplate": "7"},
    }
    return {**base, **change}


def item(id_, **change):
    base = {"id": id_, "msku": " m1 ", "fnsku": "f1", "asin": "own", "quantity_shipped": 5, "quantity_shipped_local": 2}
    return {**base, **change}


@pytest.fixture
def ships(tmp_path):
    return shipment_spec("erp", "shipment", str(tmp_path / "raw"), str(tmp_path / "detail"))


@pytest.fixture
def listing(spark):
    ddl = "sid bigint, seller_sku string, fnsku string, asin string, parent_asin string, local_name string, marketplace string, create_time string, id bigint"
    return spark.createDataFrame(
        [(1, "m1", "f1", "old", "p", "n", "US", "2024-01-01", 9), (1, "m1 ", "f1", "new", " ", "n2", "DE", "2024-01-01", 10)], ddl
    )


def test_shipment_contract_and_values(spark, ships, listing):
    drop(ships, envelope(ships, [shipment(1), shipment(2, []), shipment(3, [item(30), item(31, msku=None)])]))
    report = run_parent_child(spark, ships, DT, listing).first().asDict()
    assert read_target(spark, ships).schema.simpleString() == contract_schema(ships.fields).simpleString()
    got = {r["id"]: r for r in detail(spark, ships)}
    assert set(got) == {-1, -2, 30, 31}
    assert (got[30]["country"], got[30]["asin"], got[30]["parent_asin"], got[30]["local_name"]) == ("DE", "new", None, "n2")
    assert (got[31]["country"], got[31]["asin"], got[31]["msku"]) == (None, "own", None)
    assert (got[30]["aad_diff"], got[30]["rad_diff"], got[30]["aar_diff"]) == ("3", "-2", "5")
    childless = got[-1]
    assert (childless["quantity_shipped"], childless["aad_diff"], childless["relate_id"]) == (None, "0", 1)
    assert (childless["seller"], childless["is_closed"], childless["shipping_mode"]) == (None, "已完成", "汽运零担（LTL）")
    assert (childless["ship_from_name"], childless["ship_to_doorplate"], childless["create_time"]) == ("A", "7", SYNC)
    assert childless["dt"] == DT
    assert report["source_expanded_count"] == report["target_row_count"] == 4
    assert report["source_empty_item_shipment_count"] == 2 and report["listing_country_unmatched_count"] == 3


def test_rerun_is_idempotent_and_other_days_stay(spark, ships, listing):
    for dt in ("2024-01-30", DT, DT):
        drop(ships, envelope(ships, [shipment(1, [item(10)])], dt), dt=dt)
        run_parent_child(spark, ships, dt, listing)
    assert sorted((r["dt"], r["id"]) for r in detail(spark, ships)) == [("2024-01-30", 10), (DT, 10)]


def test_refused_batch_leaves_the_target_alone(spark, ships, listing):
    spec, one = ships, shipment(1)
    drop(spec, envelope(spec, [shipment(99)]))
    run_parent_child(spark, spec, DT, listing)
    bad_key, no_child = "INVALID_SHIPMENT_KEY_OR_TIME", "INVALID_PARENT_OR_ITEM_ID"
    cases = [
        ("UNEXPECTED_ENVELOPE_COUNT", [envelope(spec, [one]), envelope(spec, [shipment(2)])]),
        ("INVALID_ENVELOPE_METADATA", [envelope(spec, [one], source="other")]),
        ("INVALID_ENVELOPE_METADATA", [envelope(spec, [one], biz_date="2024-01-30")]),
        ("EMPTY_SHIPMENT_DATA", [envelope(spec, [])]),
        ("EMPTY_SHIPMENT_DATA", [envelope(spec, [], data=None, record_count=3)]),
        ("RECORD_COUNT_MISMATCH", [envelope(spec, [one], record_count=2)]),
        (bad_key, [envelope(spec, [shipment(1, gmt_create=None)])]),
        (bad_key, [envelope(spec, [shipment(1, gmt_modified="2024-01-01")])]),
        (bad_key, [envelope(spec, [shipment(1, shipment_id=" ")])]),
        ("DUPLICATE_SHIPMENT_RECORD_ID", [envelope(spec, [one, one])]),
        (no_child, [envelope(spec, [shipment(1, [item(None)])])]),
        (no_child, [envelope(spec, [shipment(1, [None])])]),
        ("DUPLICATE_TECHNICAL_ID", [envelope(spec, [shipment(7), shipment(8, [item(-7)])])]),
    ]
    for code, envelopes in cases:
        drop(spec, *envelopes)
        with pytest.raises(GuardError) as error:
            run_parent_child(spark, spec, DT, listing)
        assert error.value.code == code
        assert [r["id"] for r in detail(spark, spec)] == [-99]


def test_missing_batch(spark, ships, listing):
    drop(ships, envelope(ships, [shipment(1)]))
    with pytest.raises(GuardError, match="EMPTY_OSS_SOURCE"):
        run_parent_child(spark, ships, "2024-02-01", listing)


def test_declared_empty_day_clears_its_partition(spark, ships, listing):
    spec = replace(ships, empty_policy="ALLOW")
    drop(spec, envelope(spec, [shipment(1)]))
    run_parent_child(spark, spec, DT, listing)
    drop(spec, envelope(spec, []))
    assert run_parent_child(spark, spec, DT, listing).first()["target_row_count"] == 0


def test_duplicates_can_be_ranked_instead_of_refused(spark, ships, listing):
    spec = replace(ships, on_duplicate="keep_newest")
    older, newer = shipment(1, [item(10, sku="old")]), shipment(1, [item(10, sku="new")], gmt_modified="2024-01-03 00:00")
    drop(spec, envelope(spec, [newer, older]))
    run_parent_child(spark, spec, DT, listing)
    assert [r["sku"] for r in detail(spark, spec)] == ["new"]


def test_scratch_tables_are_removed(spark, ships, listing):
    def batches():
        jobs = [os.path.join(f"{shared_dir(spark)}/landfall", p) for p in os.listdir(f"{shared_dir(spark)}/landfall") if p.startswith("job-")]
        return [f for job in jobs for _, _, files in os.walk(job) for f in files if f.endswith(".parquet")]

    drop(ships, envelope(ships, [shipment(1)]))
    run_parent_child(spark, ships, DT, listing)
    before = set(batches())
    report = run_parent_child(spark, ships, DT, listing)
    assert set(batches()) == before and report.count() == 1
    assert new_dir(spark, "x") != new_dir(spark, "x")


def test_guards_as_functions(spark, ships):
    drop(ships, envelope(ships, [shipment(1, [item(1), item(2)]), shipment(2)]))
    _, records = load_batch(ships, DT, Scratch(spark))
    assert record_guard(records, ships) == 2 and child_guard(records, ships) == 3


def test_detail_plan(spark, ships, listing):
    drop(ships, envelope(ships, [shipment(1, [item(1)])]))
    staged, records = load_batch(ships, DT, Scratch(spark))
    plan = parent_child_detail(ships, records, listing)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "PushedFilters" in plan
    assert plan.count("Generate") == 1
    schema = [line for line in plan.splitlines() if "FileScan parquet" in line][0]
    assert "EqualTo(dataset,shipment)" in schema or "dataset" in schema
    # The guard on record keys reads only the fields it checks.
    from landfall.operators.guards import record_verdict

    narrow = record_verdict(records, ships)._jdf.queryExecution().executedPlan().toString()
    assert "item_list" not in narrow.split("ReadSchema:")[-1]


# ---- price changes ------------------------------------------------------------------


def change(id_, at, **more):
    return {"business_id": str(id_), "create_time": at, "sid": 1, "adjust_before": ["1", None], "audit_info": [{"a": "x", "b": None}], **more}


@pytest.fixture
def prices(tmp_path):
    return price_queue_spec("erp", "price", str(tmp_path / "raw"), str(tmp_path / "detail"))


def test_price_batches_replace_only_their_days(spark, prices):
    one = [change(1, "2024-01-01 10:00:00"), change(2, "2024-01-02 10:00:00"), change(3, "2024-01-03 10:00:00")]
    drop(prices, envelope(prices, one[:2]), envelope(prices, one[2:]), envelope(prices, one, dataset="other"))
    assert run_dynamic_dates(spark, prices, DT).first()["row_count"] == 3
    later = "2024-02-01"
    drop(prices, envelope(prices, [change(20, "2024-01-02 11:00:00")], dt=later, sync=f"{later} 06:00:00"), dt=later)
    report = run_dynamic_dates(spark, prices, later).first()
    assert (report["row_count"], report["distinct_id_count"]) == (1, 1)
    rows = {r["id"]: r for r in detail(spark, prices)}
    assert {k: v["dt"] for k, v in rows.items()} == {1: "2024-01-01", 20: "2024-01-02", 3: "2024-01-03"}
    assert rows[1]["adjust_before"] == '["1",null]' and rows[1]["audit_info"] == '[{"a":"x","b":null}]'
    assert rows[1]["adjust_after"] is None and rows[1]["relate_id"] == 1 and str(rows[1]["update_time"]) == SYNC
    assert read_target(spark, prices).schema.simpleString() == contract_schema(prices.fields).simpleString()


@pytest.mark.parametrize(
    "code, data, change_envelope",
    [
        ("EMPTY_OSS_SOURCE", [], {}),
        ("EMPTY_OSS_SOURCE", [change(1, "2024-01-01 10:00")], {"dataset": "other"}),
        ("RECORD_COUNT_MISMATCH", [change(1, "2024-01-01 10:00")], {"record_count": 5}),
        ("INVALID_BUSINESS_KEY_OR_CREATE_TIME", [change(" 1", "2024-01-01 10:00")], {}),
        ("INVALID_BUSINESS_KEY_OR_CREATE_TIME", [change("x", "2024-01-01 10:00")], {}),
        ("INVALID_BUSINESS_KEY_OR_CREATE_TIME", [change(1, "2024-01-01")], {}),
        ("DUPLICATE_BUSINESS_ID", [change(1, "2024-01-01 10:00"), change(1, "2024-01-02 10:00")], {}),
        ("LOSSY_CAST", [change("9" * 25, "2024-01-01 10:00")], {}),
        ("LOSSY_CAST", [change(1, "2024-01-01 10:00")], {"sync_time": "yesterday"}),
    ],
)
def test_price_guards(spark, prices, code, data, change_envelope):
    drop(prices, envelope(prices, data, **change_envelope))
    with pytest.raises(GuardError) as error:
        run_dynamic_dates(spark, prices, DT)
    assert error.value.code == code and not os.path.exists(prices.target)


def test_equal_numbers_with_different_text_pass_the_guard_and_show_in_the_report(spark, prices):
    drop(prices, envelope(prices, [change("1", "2024-01-01 10:00"), change("01", "2024-01-01 10:00")]))
    report = run_dynamic_dates(spark, prices, DT).first()
    assert (report["distinct_business_id_count"], report["distinct_id_count"]) == (2, 1)


# ---- restocking ---------------------------------------------------------------------


def node(hash_id, skus=(), opened=(), modes=None, **more):
    return {
        "basic_info": {"sid": "5", "node_type": 1, "data_type": 2, "hash_id": hash_id, "sync_time": SYNC,
                       "msku_fnsku_list": [{"msku": m, "fnsku": "f"} for m in skus], "listing_opentime_list": list(opened)},
        "suggest_info": {"suggest_sm_list": modes, "quantity_sug_purchase": 9, "fba_available_sale_days": 1.5},
        "sales_info": {"sales_avg_30": 2.25}, **more,
    }


@pytest.fixture
def tree(tmp_path):
    return restocking_spec("erp", "tree", str(tmp_path / "raw"), str(tmp_path / "detail"))


@pytest.fixture
def shops(spark):
    return spark.createDataFrame([(5, " Shop ", "US", "1", 1)], "sid bigint, name string, country string, create_time string, id bigint")


def test_tree_contract_and_values(spark, tree, shops):
    parent = node("p", ["a", "b"], ["t1"], [{"sm_id": "3", "name": "Air"}, {"sm_id": "x", "quantity_sug_purchase": 1}],
                  item_list=[node("c1", ["z"]), node("c2")])
    drop(tree, envelope(tree, [node("first"), parent]))
    report = run_tree(spark, tree, DT, shops).first()
    assert (report["row_count"], report["parent_row_count"], report["child_row_count"], report["unmatched_seller_count"]) == (7, 5, 2, 0)
    assert read_target(spark, tree).schema.simpleString() == contract_schema(tree.fields).simpleString()
    rows = detail(spark, tree)
    parents = [(r["msku"], r["listing_create_time"], r["sm_id"], r["quantity_sug_purchase"]) for r in rows if r["hash_id"] == "p"]
    assert sorted(parents, key=str) == sorted(
        [("a", "t1", 3, 9), ("a", "t1", None, 1), ("b", None, 3, 9), ("b", None, None, 1)], key=str
    )
    assert {r["parent_id"] for r in rows if r["hash_id"] in ("c1", "c2")} == {202401310000002}
    assert {r["parent_id"] for r in rows if r["hash_id"] in ("p", "first")} == {0}
    assert (rows[0]["name_y"], rows[0]["country"], str(rows[0]["sales_avg_30"])) == ("Shop", "US", "2.25")


@pytest.mark.parametrize(
    "code, data, options",
    [
        ("EMPTY_RESTOCKING_DATA", [], {}),
        ("LOSSY_CAST", [node("a") | {"basic_info": {"sid": "five", "hash_id": "a"}}], {}),
        ("POSITION_OVERFLOW", [node(str(i)) for i in range(10)], {"position_width": 1}),
    ],
)
def test_tree_guards(spark, tree, shops, code, data, options):
    spec = replace(tree, **options)
    drop(spec, envelope(spec, data))
    with pytest.raises(GuardError) as error:
        run_tree(spark, spec, DT, shops)
    assert error.value.code == code and not os.path.exists(spec.target)


def test_tree_ignores_a_foreign_envelope(spark, tree, shops):
    drop(tree, envelope(tree, [node("a")]), envelope(tree, [node("b")], source="other"))
    assert run_tree(spark, tree, DT, shops).first()["row_count"] == 1


def test_tree_positions_need_distinct_shards(spark, tree, shops):
    spec = replace(tree, max_envelopes=None)
    drop(spec, envelope(spec, [node("a")], shard_no=4), envelope(spec, [node("b")], shard_no=4))
    with pytest.raises(GuardError, match="DUPLICATE_SHARD"):
        run_tree(spark, spec, DT, shops)
    drop(spec, envelope(spec, [node("a", item_list=[node("x")])], shard_no=4), envelope(spec, [node("b", item_list=[node("y")])], shard_no=2))
    run_tree(spark, spec, DT, shops)
    parents = {r["hash_id"]: r["parent_id"] for r in detail(spark, spec) if r["parent_id"]}
    assert parents == {"y": 202401310000001, "x": 202401310000002}


# ---- landing ------------------------------------------------------------------------


def test_landing_writes_one_envelope_for_a_small_batch(spark, tmp_path):
    spec = DatasetSpec(name="demo", source="erp", root=str(tmp_path / "raw"), record_ddl="id BIGINT, tags ARRAY<STRING>")
    pages = spark.createDataFrame(
        [("a", 1, 0, 3, [(1, ["x"]), (2, [])]), ("a", 2, 2, 3, [(3, None)])],
        "key string, page_no int, offset bigint, total bigint, records array<struct<id: bigint, tags: array<string>>>",
    )
    manifest = str(tmp_path / "manifest")
    result = run_landing(spark, spec, DT, pages, SYNC, "id", manifest=manifest).first()
    assert (result["storage"], result["landed_count"]) == ("nested-json", 3)
    env = read_envelopes(spark, spec.root, spec.record_schema, DT)
    assert env.count() == 1 and env.select(F.explode("data.id")).count() == 3
    with pytest.raises(GuardError, match="TOTAL_MISMATCH"):
        run_landing(spark, spec, DT, pages.where("page_no = 1"), SYNC, "id", manifest=manifest)
    assert spark.read.parquet(manifest).count() == 1
    empty = pages.select("key", F.lit(1).alias("page_no"), "offset", F.lit(0).alias("total"), F.slice("records", 1, 0).alias("records"))
    with pytest.raises(GuardError, match="EMPTY_BATCH"):
        run_landing(spark, spec, DT, empty.limit(1), SYNC, "id")
    allowed = replace(spec, empty_policy="ALLOW")
    assert run_landing(spark, allowed, DT, empty.limit(1), SYNC, "id").first()["landed_count"] == 0
