"""Shipment dataset: record schema, detail contract and listing enrichment."""

from __future__ import annotations

from pyspark.sql import functions as F

from landfall.functions import blank_to_null, diff0, map_code, map_label, technical_id
from landfall.plans.comments import SHIPMENT
from landfall.spec import DatasetSpec, Field, described

# Fields of the landed record, in its order.
_ADDRESS = (
    "name STRING, country_code STRING, state_or_province_code STRING, city STRING, region STRING,"
    " address_line1 STRING, address_line2 STRING, postal_code STRING"
)
_ITEM = (
    "id BIGINT, zid BIGINT, msku STRING, fnsku STRING, asin STRING, sku STRING, quantity_shipped BIGINT,"
    " init_quantity_shipped BIGINT, quantity_received BIGINT, quantity_shipped_local BIGINT, quantity_in_case BIGINT,"
    " prep_details STRING, prep_instruction STRING, prep_owner STRING, prep_labelowner STRING, expiration STRING,"
    " release_date STRING, ware_house_storage_id BIGINT, shipment_plan_list ARRAY<STRUCT<shipment_plan_sn STRING>>"
)
RECORD = (
    "id BIGINT, sid BIGINT, seller STRING, uid BIGINT, username STRING, shipment_id STRING, shipment_name STRING,"
    " sta_shipment_id STRING, sta_inbound_plan_id STRING, sta_plan_name STRING, is_closed BIGINT, shipment_status STRING,"
    " gmt_modified STRING, gmt_create STRING, sync_time STRING, destination_fulfillment_center_id STRING,"
    " is_synchronous BIGINT, is_uploaded_box BIGINT, is_sta BIGINT, shipping_mode STRING, shipping_solution STRING,"
    " alpha_code STRING, alpha_name STRING, sta_shipment_date STRING, sta_delivery_start_date STRING,"
    " sta_delivery_end_date STRING, tracking_number_list ARRAY<STRUCT<box_id STRING, tracking_number STRING>>,"
    f" bill_of_lading_number STRING, freight_bill_number STRING, item_list ARRAY<STRUCT<{_ITEM}>>,"
    " working_time STRING, shipped_time STRING, receiving_time STRING, closed_time STRING, reference_id STRING,"
    f" ship_from_address STRUCT<{_ADDRESS}, phone STRING>, ship_to_address STRUCT<{_ADDRESS}, doorplate STRING>"
)

# Labels the detail table stores.
SHIPPING_MODES = {"GROUND_SMALL_PARCEL": "小包裹快递（SPD）", "FREIGHT_LTL": "汽运零担（LTL）"}
CLOSED_STATES = {0: "进行中", 1: "已完成"}


def _text(name: str, path: str | None = None) -> Field:
    return Field(name, "string", lambda: blank_to_null(path or f"rec.{name}"))


def _number(name: str) -> Field:
    return Field(name, "string", lambda: F.col(f"item.{name}"))


def _diff(name: str, a: str, b: str) -> Field:
    return Field(name, "string", lambda: diff0(f"item.{a}", f"item.{b}"))


def _dim(name: str) -> Field:
    return Field(name, "string", lambda: F.col(f"dim_{name}"), late=True)


def _addresses():
    shared = ["postal_code", "country_code", "state_or_province_code", "city", "address_line1"]
    for side, parts in (("from", ["name", "phone", *shared]), ("to", ["name", *shared, "doorplate"])):
        for part in parts:
            yield _text(f"ship_{side}_{part}", f"rec.ship_{side}_address.{part}")


# The detail contract, in order.
FIELDS = (
    Field("id", "bigint", lambda: technical_id("item_pos", "rec.id", "item.id")),
    Field("relate_id", "bigint", lambda: F.col("rec.id")),
    _text("create_time", "sync_time"),
    _text("shipment_id"),
    Field("sid", "string", lambda: F.col("rec.sid")),
    _text("seller"),
    _dim("country"),
    _text("shipment_name"),
    Field("shipping_mode", "string", lambda: map_label(blank_to_null("rec.shipping_mode"), SHIPPING_MODES)),
    _text("alpha_name"),
    _text("shipment_status"),
    _text("working_time"),
    _text("shipped_time"),
    _text("receiving_time"),
    _text("closed_time"),
    Field("is_closed", "string", lambda: map_code("rec.is_closed", CLOSED_STATES)),
    _text("reference_id"),
    _text("username"),
    _text("gmt_create"),
    _text("gmt_modified"),
    _text("msku", "item.msku"),
    _text("fnsku", "item.fnsku"),
    Field("asin", "string", lambda: F.coalesce("dim_asin", "own_asin"), late=True),
    _dim("parent_asin"),
    _dim("local_name"),
    _text("sku", "item.sku"),
    _number("quantity_shipped"),
    _number("quantity_shipped_local"),
    _number("quantity_received"),
    _text("prep_labelowner", "item.prep_labelowner"),
    _diff("aad_diff", "quantity_shipped", "quantity_shipped_local"),
    _diff("rad_diff", "quantity_received", "quantity_shipped_local"),
    _diff("aar_diff", "quantity_shipped", "quantity_received"),
    *_addresses(),
)
FIELDS = described(FIELDS, SHIPMENT)

# Stored differences and the columns they must equal.
FORMULAS = {
    "aad_diff": ("quantity_shipped", "quantity_shipped_local"),
    "rad_diff": ("quantity_received", "quantity_shipped_local"),
    "aar_diff": ("quantity_shipped", "quantity_received"),
}


def shipment_spec(source: str, name: str, root: str = "", target: str = "", **options) -> DatasetSpec:
    """Shipments: one row per shipment and item, daily snapshot of a 90-day pull window."""
    settings = dict(
        record_ddl=RECORD,
        root=root,
        target=target,
        mode="strict",
        empty_code="EMPTY_SHIPMENT_DATA",
        keys=("id", "shipment_id", "sid"),
        time_columns=("gmt_create", "gmt_modified"),
        unique="id",
        child="item_list",
        bad_key_code="INVALID_SHIPMENT_KEY_OR_TIME",
        duplicate_code="DUPLICATE_SHIPMENT_RECORD_ID",
        fields=FIELDS,
        window_days=90,
    )
    return DatasetSpec(name=name, source=source, **{**settings, **options})


def listing_join() -> dict:
    """How expanded rows find their listing: shop, seller SKU and fulfilment SKU, newest listing wins."""
    return dict(
        on={"sid": F.col("sid").cast("bigint"), "seller_sku": F.col("msku"), "fnsku": F.col("fnsku")},
        order=["create_time", "id"],
        dim_keys={"seller_sku": blank_to_null("seller_sku"), "fnsku": blank_to_null("fnsku")},
        cols={
            "dim_country": blank_to_null("marketplace"),
            "dim_asin": blank_to_null("asin"),
            "dim_parent_asin": blank_to_null("parent_asin"),
            "dim_local_name": blank_to_null("local_name"),
        },
    )
