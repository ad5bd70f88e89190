"""Price-change queue: record schema and detail contract, partitioned by creation date."""

from __future__ import annotations

from pyspark.sql import functions as F

from landfall.functions import blank_to_null, const, day_of, safe_cast
from landfall.plans.comments import PRICE_CHANGE
from landfall.spec import DatasetSpec, Field, described

# Fields of the landed record that the detail job reads.
_PRICES = "standard_price STRING, sale_price STRING"
_CHANGE = f"STRUCT<{_PRICES}, sale_time_range STRING, icon STRING>"
RECORD = (
    "business_id STRING, create_time STRING, finish_time STRING, sid BIGINT, adjust_type BIGINT, can_audit BIGINT,"
    " processing_status BIGINT, processing_status_text STRING, failure_reason STRING, create_user STRING,"
    " store_name STRING, marketplace STRING, msku STRING, fnsku STRING, asin STRING, asin_url STRING,"
    " small_image_url STRING, local_sku STRING, local_name STRING,"
    " profit_estimate STRUCT<standard_price_profit STRING, standard_price_profit_rate STRING,"
    " sale_price_profit STRING, sale_price_profit_rate STRING, currency_icon STRING>,"
    f" adjust_before_obj {_CHANGE}, adjust_after_obj {_CHANGE}, adjust_range STRUCT<{_PRICES}>,"
    " adjust_before ARRAY<STRING>, adjust_after ARRAY<STRING>, audit_info ARRAY<MAP<STRING, STRING>>"
)


def _text(name: str, path: str | None = None) -> Field:
    return Field(name, "string", lambda: blank_to_null(path or f"rec.{name}"))


def _plain(name: str) -> Field:
    return Field(name, "bigint", lambda: F.col(f"rec.{name}"))


def _key(name: str) -> Field:
    return Field(name, "bigint", lambda: safe_cast("rec.business_id", "bigint"))


def _json(name: str) -> Field:
    return Field(name, "string", lambda: F.to_json(f"rec.{name}"))


def _synced(name: str) -> Field:
    return Field(name, "timestamp_ntz", lambda: safe_cast("sync_time", "timestamp_ntz"))


def _nested():
    groups = {
        "profit_estimate": [
            "standard_price_profit", "standard_price_profit_rate", "sale_price_profit", "sale_price_profit_rate",
        ],
        "adjust_before_obj": ["standard_price", "sale_price", "sale_time_range", "icon"],
        "adjust_after_obj": ["standard_price", "sale_price", "sale_time_range", "icon"],
        "adjust_range": ["standard_price", "sale_price"],
    }
    for group, parts in groups.items():
        for part in parts:
            yield _text(f"{group}_{part}", f"rec.{group}.{part}")


# The detail contract, in order.
FIELDS = (
    _key("id"),
    _key("relate_id"),
    Field("delete_flag", "bigint", lambda: const(0, "bigint")),
    *[
        _text(n)
        for n in "msku local_sku fnsku asin local_name store_name marketplace processing_status_text".split()
    ],
    _plain("adjust_type"),
    _text("queue_create_time", "rec.create_time"),
    _text("finish_time"),
    _plain("sid"),
    _plain("processing_status"),
    _text("create_user"),
    _text("asin_url"),
    _text("business_id"),
    _plain("can_audit"),
    _text("small_image_url"),
    _text("failure_reason"),
    _text("currency_icon", "rec.profit_estimate.currency_icon"),
    *_nested(),
    _json("adjust_before"),
    _json("adjust_after"),
    _json("audit_info"),
    *[_synced(n) for n in "backup_time ods_update_time create_time update_time".split()],
)
FIELDS = described(FIELDS, PRICE_CHANGE)


def partition_day():
    """The day a record belongs to: its own creation date."""
    return day_of("rec.create_time")


def price_queue_spec(source: str, name: str, root: str = "", target: str = "", **options) -> DatasetSpec:
    """Price changes: one row per change, a 15-day pull replaces the creation dates it contains."""
    settings = dict(
        record_ddl=RECORD,
        root=root,
        target=target,
        mode="filtered",
        max_envelopes=None,
        keys=("business_id",),
        digit_keys=("business_id",),
        time_columns=("create_time",),
        time_shape="date_prefix",
        unique="business_id",
        bad_key_code="INVALID_BUSINESS_KEY_OR_CREATE_TIME",
        duplicate_code="DUPLICATE_BUSINESS_ID",
        fields=FIELDS,
        window_days=15,
        casts=(("sync_time", "timestamp_ntz"), ("rec.business_id", "bigint")),
    )
    return DatasetSpec(name=name, source=source, **{**settings, **options})
