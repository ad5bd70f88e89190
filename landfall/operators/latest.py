"""Newest row per key, and joins to it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from landfall.functions import as_col
from landfall.session import Scratch, byte_setting, settings

SCAN, BROADCAST = "spark.sql.files.maxPartitionBytes", "spark.sql.autoBroadcastJoinThreshold"
RANK_BYTES = 32 << 20  # of files in a task that ranks: rows take many times their size in files, and they are sorted in memory


def latest_per_key(df: DataFrame, keys: list, order: list[str]) -> DataFrame:
    """Keep the first row per key, every order column descending.

    The rank filter becomes a group limit before the shuffle, so a hot key sends at most one
    row per input partition.
    """
    w = W.partitionBy(*[as_col(k) for k in keys]).orderBy(*[F.desc(c) for c in order])
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def dedup(df: DataFrame, key, order: list[str]) -> DataFrame:
    """Keep the newest row of each technical or business key."""
    return latest_per_key(df, [key], order)


def enrich_latest(
    df: DataFrame, dim: DataFrame, on: dict[str, Column], order: list[str], cols: dict[str, Column],
    dim_keys: dict[str, Column] | None = None, scratch: Scratch | None = None,
) -> DataFrame:
    """Left join to the newest dimension row per key.

    ``on`` maps a dimension key to the probe expression; ``dim_keys`` normalizes the dimension
    side before ranking; ``cols`` names the columns to add. Null keys never match and are
    dropped from the dimension.

    The dimension is ranked under a hash of its keys, so it is not yet partitioned for the join
    and reaches it through a shuffle of its own. That small shuffle pays for itself: the size of
    the reduced dimension is measured before the join is chosen, so it is broadcast only when
    it fits, and in a shuffled join AQE can split a probe partition holding a hot key or all the
    null keys. Ranked by the keys alone, the join would reuse the ranking's partitioning and
    AQE could do neither.

    With ``scratch`` the reduced dimension is written first. Its file size is then known when the
    join is planned, so a small one is broadcast without the probe side being shuffled at all.
    """
    return join_newest(df, newest_dimension(dim, on, order, cols, dim_keys, scratch), on)


def newest_dimension(
    dim: DataFrame, on: dict[str, Column], order: list[str], cols: dict[str, Column],
    dim_keys: dict[str, Column] | None = None, scratch: Scratch | None = None,
) -> DataFrame:
    """The reduced dimension of ``enrich_latest``: ``cols`` of the newest row of each key.

    With ``scratch`` it is written here, by tasks that read at most ``RANK_BYTES``.
    """
    keys = list(on)
    normal = dim.withColumns({k: (dim_keys or {}).get(k, F.col(k)) for k in keys}).dropna(subset=keys)
    newest = latest_per_key(normal, [F.xxhash64(*keys), *keys], order)
    right = newest.select(*[F.col(k).alias(f"_dim_{k}") for k in keys], *[c.alias(n) for n, c in cols.items()])
    if not scratch:
        return right
    with settings(scratch.spark, {SCAN: str(min(RANK_BYTES, byte_setting(scratch.spark, SCAN)))}):
        return scratch.materialize(right, "dimension")


def join_newest(df: DataFrame, right: DataFrame, on: dict[str, Column], how: str = "left") -> DataFrame:
    """``df`` with the columns of a reduced dimension."""
    keys = list(on)
    probe = df.withColumns({f"_probe_{k}": c for k, c in on.items()})
    condition = [F.col(f"_probe_{k}") == F.col(f"_dim_{k}") for k in keys]
    return probe.join(right, condition, how).drop(*[f"_dim_{k}" for k in keys], *[f"_probe_{k}" for k in keys])


def enrich_in_place(
    df: DataFrame, right: DataFrame, on: dict[str, Column], place: list[str], parts: int, cols: list[str], carried: list[str]
) -> DataFrame:
    """Left join of wide rows to a reduced dimension that is too large to broadcast; the rows stay where they lie.

    ``df`` comes from a table bucketed by the first column of ``place`` into ``parts``; ``place`` as a whole is unique, a
    row with a null in it finds nothing. Only places and keys (``carried`` are the columns ``on`` is built from) are
    shuffled to the dimension, and only what was found goes back, to the bucket of its row. There it is hashed,
    so the wide rows are not sorted either. The join must run with the settings ``IN_PLACE``. The merge hint keeps Spark from
    broadcasting the keys: their size is estimated from the files, in which they take a small part of what they take in memory.
    """
    asked = df.select(*place, *carried).dropna(subset=place)
    found = join_newest(asked.hint("merge"), right, on, "inner").select(*[F.col(c).alias(f"_at_{c}") for c in place], *cols)
    found = found.repartition(parts, f"_at_{place[0]}").hint("shuffle_hash")
    same = [F.col(c) == F.col(f"_at_{c}") for c in place]
    return df.join(found, same, "left").drop(*[f"_at_{c}" for c in place])


def broadcast_fits(scratch: Scratch, name: str = "dimension") -> bool:
    """Whether Spark broadcasts what was written under this name."""
    return scratch.stored_bytes(name) <= byte_setting(scratch.spark, BROADCAST)


# ---- a maintained table of newest rows ---------------------------------------------------


def state_version(spark: SparkSession, name: str) -> int:
    """Number of the version that the view ``name`` shows; 0 if there is none yet."""
    if not spark.catalog.tableExists(name):
        return 0
    return int(spark.sql(f"SHOW TBLPROPERTIES {name} ('version')").first().value)


def merge_latest(batch: DataFrame, name: str, location: str, keys: list[str], order: list[str], buckets: int = 64) -> DataFrame:
    """Merge a batch into the table of newest rows per key and return the table.

    The table is bucketed by its keys, so a merge shuffles the batch alone and rewrites each bucket where it lies; what was
    merged before is neither ranked nor shuffled again. A row replaces the stored one only if its order
    columns are larger, so late rows change nothing; at equal order the stored row stays. Rows with a null key are left out.
    Each merge writes a version of its own; the view ``name`` moves to it in one statement, and the version before
    the last is dropped from the catalog while its files stay for readers that have begun.
    """
    spark, last = batch.sparkSession, state_version(batch.sparkSession, name)
    newest = latest_per_key(batch.dropna(subset=keys), keys, order)
    if last:
        state = spark.table(f"{name}_v{last}")
        fresh = newest.select(F.struct(*[F.col(c) for c in state.columns]).alias("_fresh"))
        same = [F.col(k) == F.col(f"_fresh.{k}") for k in keys]
        absent = F.col("_fresh").isNull() | (F.struct(*order) >= F.struct(*[F.col(f"_fresh.{c}") for c in order])) & F.col(keys[0]).isNotNull()
        joined = state.join(fresh, same, "full_outer")
        newest = joined.select(*[F.when(absent, F.col(c)).otherwise(F.col(f"_fresh.{c}")).alias(c) for c in state.columns])
    version = last + 1
    writer = newest.write.mode("overwrite").option("path", f"{location}/v{version}").bucketBy(buckets, *keys).sortBy(*keys)
    writer.saveAsTable(f"{name}_v{version}")
    spark.sql(f"CREATE OR REPLACE VIEW {name} TBLPROPERTIES ('version' = '{version}') AS SELECT * FROM {name}_v{version}")
    if version > 2:
        spark.sql(f"DROP TABLE IF EXISTS {name}_v{version - 2}")
    return spark.table(name)


def enrich_from_state(df: DataFrame, state: DataFrame, on: dict[str, Column], cols: dict[str, Column]) -> DataFrame:
    """Left join to a table of newest rows that ``merge_latest`` keeps.

    ``on`` maps each key of the table to the probe expression, of the same type. The table is unique by key and bucketed by it, so
    its side of the join is not shuffled.
    """
    right = state.select(*[F.col(k).alias(f"_dim_{k}") for k in on], *[c.alias(n) for n, c in cols.items()])
    probe = df.withColumns({f"_probe_{k}": c for k, c in on.items()})
    condition = [F.col(f"_probe_{k}") == F.col(f"_dim_{k}") for k in on]
    return probe.join(right, condition, "left").drop(*[f"_dim_{k}" for k in on], *[f"_probe_{k}" for k in on])
