"""The jobs: landed envelopes to guarded detail partitions, and landed pages to envelopes."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from landfall.functions import batch_position_id, position_overflow
from landfall.operators.aggregates import count_where, sum0
from landfall.operators.expand import expand_children, expand_siblings, expand_zipped, global_positions, unfold_tree
from landfall.operators.guards import (
    Guard,
    GuardError,
    any_cast_fault,
    child_verdict,
    envelope_verdict,
    measure_guards,
    record_verdict,
    run_guards,
    staged_envelope_verdict,
    verdict,
)
from landfall.operators.latest import broadcast_fits, dedup, enrich_in_place, enrich_latest, join_newest, newest_dimension
from landfall.operators.pages import collect_pages, key_source_verdict, landing_guard, request_plan
from landfall.operators.quality import (
    expanded_rows,
    quality_from_passes,
    quality_touched,
    quality_tree,
    touched_measures,
    written_measures,
)
from landfall.plans.price_queue import partition_day
from landfall.plans.restocking import NODE_COLUMNS, seller_join
from landfall.plans.shipments import listing_join
from landfall.session import DROP_SHUFFLES, IN_PLACE, Scratch, pin, settings
from landfall.sources.envelopes import (
    JSON_FILES,
    batch_parts,
    matching_envelopes,
    read_envelopes,
    stage_batch,
    wrap_records,
    write_empty_envelope,
    write_json,
)
from landfall.sources.flat import decide_storage, flat_schema, read_flat, record_storage, write_flat
from landfall.sources.keys import read_keys, valid_keys
from landfall.sources.tables import ensure_table, move_partitions
from landfall.sources.versions import Published, new_batch_id, publish_version, read_published, read_version
from landfall.spec import DatasetSpec, contract_schema


def load_batch(spec: DatasetSpec, dt: str, scratch: Scratch, in_parts: bool = False) -> tuple[DataFrame, DataFrame]:
    """Parse the batch once; return everything staged, and the records of matching envelopes.

    ``in_parts`` stages it in parts, whose number is left in ``scratch.parts``.
    """
    envelopes = read_envelopes(scratch.spark, spec.root, spec.record_schema, dt)
    scratch.parts = batch_parts(envelopes) if in_parts else 0
    staged = stage_batch(envelopes, scratch, scratch.parts)
    return staged, matching_envelopes(staged, spec, dt).where(F.col("pos").isNotNull())


def read_target(spark: SparkSession, spec: DatasetSpec, dt: str | None = None) -> DataFrame:
    """The published rows in force, of one day or all."""
    return read_published(spark, spec.target, contract_schema(spec.fields), [dt] if dt else None)


def publish(
    spec: DatasetSpec, rows: DataFrame, batch_id: str, dt: str | None = None, expected_rows: int | None = None,
    measures: dict[str, Column] | None = None,
) -> tuple[Published, DataFrame]:
    """Publish detail rows as a new version; returns what was done and the version as read back.

    The catalog table follows the manifest: its partitions are pointed at the new folders. Queries on it
    that have begun go on with the old files.
    """
    spark = rows.sparkSession
    done = publish_version(
        rows, spec.target, spec.name, batch_id, dt, expected_rows=expected_rows, empty_policy=spec.empty_policy, measures=measures
    )
    if spec.table:
        ensure_table(spark, spec.table, spec.fields, spec.target)
        move_partitions(spark, spec.table, {d: f"{spec.target}/v={batch_id}/dt={d}" for d in done.days})
        spark.catalog.refreshTable(spec.table)
    return done, read_version(spark, spec.target, contract_schema(spec.fields), batch_id)


def _early(spec: DatasetSpec, df: DataFrame, *extra) -> DataFrame:
    """Flatten to the contract columns known before the join, so the shuffle carries nothing else."""
    return df.select(*[f.build().cast(f.type).alias(f.name) for f in spec.fields if not f.late], *extra)


def _finish(spec: DatasetSpec, df: DataFrame) -> DataFrame:
    return df.select(*[(f.build().cast(f.type) if f.late else F.col(f.name)).alias(f.name) for f in spec.fields])


def parent_child_detail(
    spec: DatasetSpec, records: DataFrame, dim: DataFrame, scratch: Scratch | None = None
) -> DataFrame:
    """Expand, flatten, enrich. The dimension is unique per key, so the row count is the expansion's.

    Deduplication runs only when duplicates are allowed into the batch. Otherwise the guards
    have proved, on the very files read here, that technical ids are unique; ranking every row
    by its id would then be a full shuffle that changes nothing.

    Where the batch was staged in parts and the reduced dimension is too large to broadcast, the flat rows stay in their
    parts and only keys and what is found for them are shuffled.
    """
    expanded, join = expand_children(records, spec.child), listing_join()
    order = [F.col("shard_no"), F.col("pos"), F.col("item_pos")]
    own = F.nullif(F.trim("item.asin"), F.lit("")).alias("own_asin")
    if scratch is None or not scratch.parts or spec.on_duplicate == "keep_newest":
        flat = _early(spec, expanded, own, *order)
        if spec.on_duplicate == "keep_newest":
            flat = dedup(flat, "id", ["gmt_modified", "create_time", "shard_no", "pos", "item_pos"])
        return _finish(spec, enrich_latest(flat, dim, **join, scratch=scratch))
    newest = newest_dimension(dim, **join, scratch=scratch)
    if broadcast_fits(scratch):
        return _finish(spec, join_newest(_early(spec, expanded, own), newest, join["on"]))
    place = ["part", "shard_no", "pos", "item_pos"]
    flat = _early(spec, expanded, own, *place)
    return _finish(spec, enrich_in_place(flat, newest, join["on"], place, scratch.parts, list(join["cols"]), ["sid", "msku", "fnsku"]))


def run_parent_child(spark: SparkSession, spec: DatasetSpec, dt: str, dim: DataFrame, batch_id: str | None = None) -> DataFrame:
    """Shipments of one date: guards, expansion, enrichment, one day published, quality row.

    Every count is taken once. The guards' counts of the source and those observed while the target is written go into
    the report, which adds only the two distincts of the target as read back. The shuffle files of each step go when it ends.
    """
    blanks, times = ["shipment_id", "country", "parent_asin", "local_name"], ["gmt_create", "gmt_modified"]
    with Scratch(spark) as scratch, settings(spark, {**DROP_SHUFFLES, **IN_PLACE}):
        staged, records = load_batch(spec, dt, scratch, in_parts=True)
        expanded = expand_children(records, spec.child)
        child = child_verdict(expanded, f"rec.{spec.unique}", f"item.{spec.child_key}", on_duplicate=spec.on_duplicate)
        measured = measure_guards(
            [
                Guard("envelope", staged_envelope_verdict(staged, spec, dt)),
                Guard("record", record_verdict(records, spec)),
                Guard("child", child),
            ]
        )
        rows = parent_child_detail(spec, records, dim, scratch).withColumn("dt", F.lit(dt))
        expected = measured["child"]["expanded_count"] if spec.on_duplicate == "fail" else None
        done, target = publish(spec, rows, batch_id or new_batch_id(dt), dt, expected, written_measures(blanks, times))
        report = quality_from_passes(measured["record"], measured["child"], done.measures, target, dt, "relate_id", "shipment")
        return report.withColumnRenamed("empty_country_count", "listing_country_unmatched_count")


def dynamic_dates_detail(spec: DatasetSpec, records: DataFrame) -> DataFrame:
    """Flatten with the partition day; duplicates are ranked away only when allowed in."""
    flat = _early(spec, records, partition_day().alias("dt"), F.col("sync_time").alias("_sync"), "shard_no", "pos")
    if spec.on_duplicate == "keep_newest":
        flat = dedup(flat, "business_id", ["_sync", "shard_no", "pos"])
    return flat.drop("_sync", "shard_no", "pos")


def run_dynamic_dates(spark: SparkSession, spec: DatasetSpec, dt: str, batch_id: str | None = None) -> DataFrame:
    """Price changes of one pull: guards, flattening, the contained days published together, quality row.

    The days are the folders that the write made, so the records are not read again to find them.
    """
    columns = ("business_id", "id", "queue_create_time", "update_time")
    with Scratch(spark) as scratch:
        staged, records = load_batch(spec, dt, scratch)
        measured = measure_guards(
            [
                Guard("envelope", staged_envelope_verdict(staged, spec, dt)),
                Guard("record", record_verdict(records, spec)),
            ]
        )
        expected = measured["record"]["record_count"] if spec.on_duplicate == "fail" else None
        rows = dynamic_dates_detail(spec, records)
        done, target = publish(spec, rows, batch_id or new_batch_id(dt), None, expected, touched_measures(*columns))
        return pin(quality_touched(target, None, *columns, written=done.measures))


def tree_nodes(spec: DatasetSpec, records: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """Parents and children as rows, with the parent's position over the whole batch."""
    positioned = records.withColumn("global_pos", F.col("pos").cast("bigint")) if spec.max_envelopes == 1 else (
        global_positions(records, scratch=scratch)
    )
    slim = positioned.select(F.col("sync_time").alias("batch_sync_time"), F.col("global_pos").alias("parent_pos"), "rec")
    return unfold_tree(slim, spec.child, NODE_COLUMNS)


def tree_node_verdict(spec: DatasetSpec, nodes: DataFrame) -> DataFrame:
    """Lossy casts and position capacity; both would otherwise surface as silent nulls.

    ``expanded_count`` is the number of detail rows these nodes must give.
    """
    measures = nodes.agg(
        F.count("*").alias("node_count"),
        sum0(expanded_rows()).alias("expanded_count"),
        count_where(position_overflow("parent_pos", spec.position_width)).alias("overflow_count"),
        count_where(any_cast_fault((*spec.casts, ("batch_sync_time", "timestamp_ntz")))).alias("lossy_cast_count"),
    )
    rules = [("POSITION_OVERFLOW", F.col("overflow_count") > 0), ("LOSSY_CAST", F.col("lossy_cast_count") > 0)]
    return verdict(measures, rules, "node_count")


def tree_detail(
    spec: DatasetSpec, nodes: DataFrame, dim: DataFrame, dt: str, scratch: Scratch | None = None
) -> DataFrame:
    """Node by SKU pair by transport mode, flattened and enriched."""
    skus = expand_zipped(
        nodes, "basic_info.msku_fnsku_list", "basic_info.listing_opentime_list", "sku", "listing_opentime"
    )
    modes = expand_siblings(skus, {"sm": "suggest_info.suggest_sm_list"})
    parent_id = F.when(F.col("is_parent") == 1, F.lit(0).cast("bigint")).otherwise(
        batch_position_id(dt, "parent_pos", spec.position_width)
    )
    flat = _early(spec, modes.withColumn("parent_id", parent_id))
    return _finish(spec, enrich_latest(flat, dim, **seller_join(), scratch=scratch))


def run_tree(spark: SparkSession, spec: DatasetSpec, dt: str, dim: DataFrame, batch_id: str | None = None) -> DataFrame:
    """Restocking advice of one date: guards, tree and list expansion, one day published, quality row."""
    with Scratch(spark) as scratch:
        staged, records = load_batch(spec, dt, scratch)
        envelope = Guard("envelope", staged_envelope_verdict(staged, spec, dt))
        nodes = tree_nodes(spec, records, scratch)
        measured = measure_guards([envelope, Guard("nodes", tree_node_verdict(spec, nodes))])
        rows = tree_detail(spec, nodes, dim, dt, scratch).withColumn("dt", F.lit(dt))
        _, target = publish(spec, rows, batch_id or new_batch_id(dt), dt, measured["nodes"]["expanded_count"])
        return pin(quality_tree(target, dt))


def run_landing(
    spark: SparkSession, spec: DatasetSpec, dt: str, pages: DataFrame, sync_time: str, id_col: str,
    upstream: str | None = None, upstream_key: str = "sid", max_page: int | None = None, closed_window: bool = False,
    manifest: str | None = None, est_rows: int | None = None, max_offset: int | None = None, batch_id: str = "",
) -> DataFrame:
    """Landed pages to a published batch; returns one row of what was landed.

    With ``upstream`` the plan is one request per valid key of that same-date dataset; without
    it the plan is the keys of the pages themselves (one shared task or one windowed pull).
    Nothing is written until every key is present, none is unplanned, and every page and record
    check passes. The batch is then written beside the dataset, read back and counted, and only
    a complete copy replaces the day; the manifest row comes last.
    """
    with Scratch(spark) as scratch:
        # Guards and the write read the same files, so what was checked is what is landed.
        pages = scratch.materialize(pages, "pages")
        if upstream:
            texts = spark.read.option("pathGlobFilter", JSON_FILES).text(f"{upstream}/dt={dt}")
            run_guards([Guard("keys", key_source_verdict(texts, upstream_key))])
            keys, _ = valid_keys(read_keys(spark, upstream, dt, upstream_key))
            keys = keys.select(F.col("key").cast("string").alias("key"))
        else:
            keys = pages.select("key").distinct()
        plan = request_plan(keys, dt, spec.window_days or 1, closed_window)
        count = landing_guard(pages, plan, id_col, max_page, spec.empty_policy, max_offset)
        records = collect_pages(pages).select("rec.*") if count else spark.createDataFrame([], spec.record_schema)
        choice = decide_storage(spark, spec.root, spec, records.schema, count if est_rows is None else est_rows)
        if choice == "parquet":
            landed = land_flat(records, spec, dt, sync_time, count, scratch)
        else:
            landed = land_envelopes(records, spec, dt, sync_time, count, scratch)
        record_storage(spark, spec.root, choice)
    row = [(spec.name, dt, choice, count, landed)]
    result = spark.createDataFrame(
        row, "dataset string, dt string, storage string, checked_count bigint, landed_count bigint"
    )
    if manifest:
        noted = result.withColumn("batch_id", F.lit(batch_id)) if batch_id else result
        noted.coalesce(1).write.mode("append").parquet(manifest)
    return result


def land_envelopes(records: DataFrame, spec: DatasetSpec, dt: str, sync_time: str, count: int, scratch: Scratch) -> int:
    """Envelopes staged as Parquet, counted through their own guard, then written as JSON over the day.

    JSON is written once and not parsed. The old day stays until the new one is committed.
    """
    if not count:
        write_empty_envelope(scratch.spark, spec.root, spec, dt, sync_time)
        return 0
    envelopes = scratch.materialize(wrap_records(records, spec, dt, sync_time, rows=count), "landing")
    landed = count_envelopes(envelopes, spec, dt)
    check_landed(landed, count)
    write_json(envelopes, spec.root, dt)
    return landed


def land_flat(records: DataFrame, spec: DatasetSpec, dt: str, sync_time: str, count: int, scratch: Scratch) -> int:
    """Flat Parquet beside the dataset, footers and rows checked, then copied over the day."""
    types = {**{f.name: f.dataType.simpleString() for f in records.schema.fields}, "biz_date": "string", "sync_time": "string"}
    if not count:
        scratch.spark.createDataFrame([], flat_schema(types)).write.mode("overwrite").parquet(f"{spec.root}/dt={dt}")
        return 0
    beside = scratch.path("landing")
    write_flat(records, beside, types, dt, sync_time)
    copy = read_flat(scratch.spark, beside, types, dt)
    landed = copy.count()
    check_landed(landed, count)
    copy.write.option("partitionOverwriteMode", "dynamic").mode("overwrite").partitionBy("dt").parquet(spec.root)
    return landed


def check_landed(landed: int, count: int) -> None:
    if landed != count:
        raise GuardError("ROW_COUNT_MISMATCH", {"landed": landed, "expected": count})


def count_envelopes(envelopes: DataFrame, spec: DatasetSpec, dt: str) -> int:
    """Records of staged envelopes, through the envelope guard; one leaf of the records is read."""
    element = envelopes.schema["data"].dataType.elementType
    narrow = envelopes.withColumns({"dt": F.lit(dt), "data": F.col("data")[element.names[0]]})
    frame = envelope_verdict(narrow, replace(spec, mode="strict", max_envelopes=None), dt)
    return run_guards([Guard("landed", frame)])["landed"]
