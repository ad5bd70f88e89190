"""Upstream key lists, read loosely so that badly shaped records can be counted instead of lost."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landfall.functions import is_blank
from landfall.sources.envelopes import JSON_FILES


def _is_object(v):
    return F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False))


def parse_loose(texts: DataFrame, text: str = "value") -> DataFrame:
    """Each line as a variant with the shape facts the key guard needs."""
    v = F.try_parse_json(F.col(text))
    parsed = texts.select(v.alias("v"))
    count = F.try_variant_get("v", "$.record_count", "string")
    return parsed.select(
        _is_object(F.col("v")).alias("is_object"),
        F.try_variant_get("v", "$.data", "array<variant>").alias("data"),
        count.alias("count_text"),
        F.trim(count).try_cast("bigint").alias("record_count"),
    )


def explode_loose(parsed: DataFrame, key: str) -> DataFrame:
    """One row per record: whether it is an object, and the key as text."""
    rec = parsed.select(F.explode("data").alias("rec"))
    return rec.select(
        _is_object(F.col("rec")).alias("is_object"),
        F.try_variant_get("rec", f"$.{key}", "string").alias("key_text"),
    )


def read_keys(spark: SparkSession, root: str, dt: str, key: str) -> DataFrame:
    """Records of the same-date upstream envelopes as ``(is_object, key_text)``."""
    texts = spark.read.option("pathGlobFilter", JSON_FILES).text(f"{root}/dt={dt}")
    return explode_loose(parse_loose(texts), key)


def valid_keys(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Distinct integer keys in order, and one row of counts.

    A record is invalid when it is not an object, or its key is null, blank or not an integer.
    """
    ok = F.col("is_object") & ~is_blank("key_text")
    checked = records.select(F.when(ok, F.trim("key_text").try_cast("bigint")).alias("key"))
    keys = checked.where(F.col("key").isNotNull()).distinct().orderBy("key")
    stats = checked.agg(
        F.count("*").alias("record_count"),
        F.countDistinct("key").alias("valid_key_count"),
        F.count_if(F.col("key").isNull()).alias("invalid_record_count"),
    )
    return keys, stats
