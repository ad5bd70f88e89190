"""Restocking advice: two-level node tree, SKU pairs and transport modes."""

from __future__ import annotations

from pyspark.sql import functions as F

from landfall.functions import blank_to_null, digits_to_long, safe_cast
from landfall.plans.comments import RESTOCKING
from landfall.spec import DatasetSpec, Field, described

# Names of the landed node's measures.
AMAZON = (
    "afn_fulfillable_quantity afn_reserved_quantity amazon_quantity_shipping reserved_fc_transfers"
    " amazon_quantity_valid afn_inbound_receiving_quantity reserved_fc_processing amazon_quantity_shipping_plan"
).split()
SCM = (
    "sc_quantity_purchase_shipping sc_quantity_purchase_plan sc_quantity_local_valid sc_quantity_local_qc"
    " sc_quantity_oversea_valid sc_quantity_local_shipping sc_quantity_oversea_shipping"
).split()
DAYS = (3, 7, 14, 30, 60, 90)
DATES = (
    "out_stock_date out_stock_date_purchase out_stock_date_local out_stock_date_oversea sug_date_purchase"
    " sug_date_send_local sug_date_send_oversea"
).split()


def _ddl(names, type_: str) -> str:
    return ", ".join(f"{n} {type_}" for n in names)


_SUGGESTED = "quantity_sug_purchase BIGINT, quantity_sug_local_to_fba BIGINT, quantity_sug_local_to_oversea BIGINT"
NODE = (
    "basic_info STRUCT<data_type BIGINT, node_type BIGINT, sid STRING, asin STRING,"
    " msku_fnsku_list ARRAY<STRUCT<msku STRING, fnsku STRING>>, listing_opentime_list ARRAY<STRING>,"
    " sync_time STRING, hash_id STRING>,"
    f" amazon_quantity_info STRUCT<{_ddl(AMAZON, 'BIGINT')}>, scm_quantity_info STRUCT<{_ddl(SCM, 'BIGINT')}>,"
    f" sales_info STRUCT<{_ddl([f'sales_avg_{d}' for d in DAYS], 'DOUBLE')},"
    f" {_ddl([f'sales_total_{d}' for d in DAYS], 'BIGINT')}>,"
    " suggest_info STRUCT<out_stock_flag BIGINT, estimated_sale_quantity BIGINT, estimated_sale_avg_quantity DOUBLE,"
    f" available_sale_days DOUBLE, fba_available_sale_days DOUBLE, {_SUGGESTED}, quantity_sug_oversea_to_fba BIGINT,"
    f" {_ddl(DATES, 'STRING')}, suggest_sm_list ARRAY<STRUCT<sm_id STRING, name STRING, {_SUGGESTED}>>>,"
    " ext_info STRUCT<restock_status BIGINT, remark STRING, star BIGINT, need_flag ARRAY<BIGINT>>"
)
RECORD = f"{NODE}, item_list ARRAY<STRUCT<{NODE}>>"
NODE_COLUMNS = ["basic_info", "amazon_quantity_info", "scm_quantity_info", "sales_info", "suggest_info", "ext_info"]


def _text(name: str, path: str) -> Field:
    return Field(name, "string", lambda: blank_to_null(path))


def _code(name: str, group: str) -> Field:
    return Field(name, "string", lambda: F.col(f"{group}.{name}"))


def _long(name: str, group: str) -> Field:
    return Field(name, "bigint", lambda: F.col(f"{group}.{name}"))


def _money(name: str, group: str, source: str | None = None) -> Field:
    return Field(name, "decimal(12,2)", lambda: F.col(f"{group}.{source or name}"))


def _sales(kind: str, days: int) -> Field:
    name = f"sales_{kind}_{days}"
    return _money(name, "sales_info") if kind == "avg" else _long(name, "sales_info")


def _preferred(name: str) -> Field:
    """The transport mode's own quantity, else the node's."""
    return Field(name, "bigint", lambda: F.coalesce(f"sm.{name}", f"suggest_info.{name}"))


def _dim(name: str, source: str) -> Field:
    return Field(name, "string", lambda: F.col(source), late=True)


def _advice(name: str) -> Field:
    return _text(name, f"suggest_info.{name}")


# The detail contract, in order.
FIELDS = (
    Field("parent_id", "bigint", lambda: F.col("parent_id")),
    Field("create_time", "timestamp_ntz", lambda: safe_cast("batch_sync_time", "timestamp_ntz")),
    _code("node_type", "basic_info"),
    _code("data_type", "basic_info"),
    _text("asin", "basic_info.asin"),
    Field("sync_time", "timestamp_ntz", lambda: safe_cast("basic_info.sync_time", "timestamp_ntz")),
    _text("hash_id", "basic_info.hash_id"),
    Field("sid", "bigint", lambda: safe_cast("basic_info.sid", "bigint")),
    _text("listing_create_time", "listing_opentime"),
    _text("msku", "sku.msku"),
    _text("fnsku", "sku.fnsku"),
    *[_long(n, "amazon_quantity_info") for n in AMAZON],
    *[_long(n, "scm_quantity_info") for n in SCM],
    _sales("avg", 30), _sales("total", 7), _sales("total", 60), _sales("avg", 60), _sales("total", 30),
    _sales("total", 90), _sales("avg", 7), _sales("avg", 90), _sales("total", 14), _sales("total", 3),
    _sales("avg", 3), _sales("avg", 14),
    _advice("out_stock_date_purchase"),
    _advice("sug_date_send_oversea"),
    _money("fba_available_sale_days", "suggest_info"),
    _advice("out_stock_date_local"),
    _advice("sug_date_purchase"),
    _code("out_stock_flag", "suggest_info"),
    _money("available_sale_days_fba", "suggest_info", "fba_available_sale_days"),
    _money("estimated_sale_avg_quantity", "suggest_info"),
    _advice("sug_date_send_local"),
    _money("available_sale_days", "suggest_info"),
    _advice("out_stock_date_oversea"),
    _advice("out_stock_date"),
    _long("estimated_sale_quantity", "suggest_info"),
    _long("quantity_sug_oversea_to_fba", "suggest_info"),
    _preferred("quantity_sug_local_to_oversea"),
    Field("sm_id", "bigint", lambda: digits_to_long("sm.sm_id")),
    _text("name_x", "sm.name"),
    _preferred("quantity_sug_purchase"),
    _preferred("quantity_sug_local_to_fba"),
    _code("restock_status", "ext_info"),
    _code("star", "ext_info"),
    _text("remark", "ext_info.remark"),
    _dim("name_y", "dim_seller_name"),
    _dim("country", "dim_country"),
)
FIELDS = described(FIELDS, RESTOCKING)

# Text fields of a node that are cast; checked before anything is written.
NODE_CASTS = (("basic_info.sync_time", "timestamp_ntz"), ("basic_info.sid", "bigint"))


def restocking_spec(source: str, name: str, root: str = "", target: str = "", **options) -> DatasetSpec:
    """Restocking: one row per node, SKU pair and transport mode, daily snapshot."""
    settings = dict(
        record_ddl=RECORD,
        root=root,
        target=target,
        mode="filtered",
        empty_code="EMPTY_RESTOCKING_DATA",
        child="item_list",
        fields=FIELDS,
        casts=NODE_CASTS,
    )
    return DatasetSpec(name=name, source=source, **{**settings, **options})


def seller_join() -> dict:
    """How nodes find their shop: by shop id, newest shop row wins."""
    return dict(
        on={"sid": F.col("sid")},
        order=["create_time", "id"],
        cols={"dim_seller_name": blank_to_null("name"), "dim_country": blank_to_null("country")},
    )
