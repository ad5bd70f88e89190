"""Array expansion. All of it is native generators; nothing is collected or shuffled."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from landfall.functions import at_pos
from landfall.session import Scratch


def _others(df: DataFrame, *drop: str):
    return [c for c in df.columns if c not in drop]


def explode_records(env: DataFrame, pos: bool = False, array: str = "data") -> DataFrame:
    """One row per record of each envelope, optionally with its position."""
    if pos:
        return env.select(*_others(env, array), F.posexplode(array).alias("pos", "rec"))
    return env.select(*_others(env, array), F.explode(array).alias("rec"))


def expand_children(df: DataFrame, child: str, parent: str = "rec", pos: str = "item_pos", item: str = "item") -> DataFrame:
    """One row per child; a parent with a null or empty array keeps one row with a null position."""
    return df.select("*", F.posexplode_outer(f"{parent}.{child}" if parent else child).alias(pos, item))


def expand_records_children(env: DataFrame, child: str) -> DataFrame:
    """Envelope to records to children, with both positions."""
    return expand_children(explode_records(env, pos=True), child)


def expand_levels(env: DataFrame, children: list[str]) -> DataFrame:
    """Envelope to records and from there down a chain of nested arrays, each level outer.

    Level k adds ``level<k>_pos`` and ``level<k>``, the element; ``position`` is the list of positions from the record down,
    null from the level on at which nothing follows. A record or child without children keeps one row.
    """
    df, parent, places = explode_records(env, pos=True), "rec", [F.col("pos")]
    for k, child in enumerate(children, 1):
        df = expand_children(df, child, parent, f"level{k}_pos", f"level{k}")
        parent, places = f"level{k}", [*places, F.col(f"level{k}_pos")]
    return df.withColumn("position", F.array(*places))


def expand_siblings(df: DataFrame, arrays: dict[str, str]) -> DataFrame:
    """Each array expanded in turn, outer: the per-row product of independent sibling arrays.

    ``arrays`` maps the element name to the array path; positions are ``<name>_pos``.
    """
    for name, path in arrays.items():
        df = df.select("*", F.posexplode_outer(path).alias(f"{name}_pos", name))
    return df


def expand_zipped(df: DataFrame, main: str, aligned: str, name: str, aligned_name: str) -> DataFrame:
    """Expand ``main`` and take the element of ``aligned`` at the same position, null when shorter."""
    out = df.select("*", F.posexplode_outer(main).alias(f"{name}_pos", name))
    return out.withColumn(aligned_name, at_pos(aligned, f"{name}_pos"))


def unfold_tree(df: DataFrame, child: str, cols: list[str], parent: str = "rec") -> DataFrame:
    """Parents and children as rows of one shape: ``is_parent``, ``child_pos`` and the node columns.

    Parent and children are put into one array and exploded, so the input is read once;
    a union of the two levels would scan it twice.
    """
    def node(prefix, is_parent, child_pos):
        return F.struct(
            F.lit(is_parent).cast("bigint").alias("is_parent"),
            child_pos.cast("bigint").alias("child_pos"),
            *[F.col(f"{prefix}.{c}").alias(c) if isinstance(prefix, str) else prefix[c].alias(c) for c in cols],
        )

    children = F.transform(f"{parent}.{child}", lambda x, i: node(x, 0, i))
    own = F.array(node(parent, 1, F.lit(None)))
    nodes = F.concat(own, F.coalesce(children, F.slice(own, 1, 0)))
    exploded = df.select(*_others(df, parent), F.explode(nodes).alias("node"))
    return exploded.select(*_others(df, parent), "node.*")


def global_positions(staged: DataFrame, ranges: int = 256, scratch: Scratch | None = None) -> DataFrame:
    """Add ``global_pos``: the position of a record over all envelopes of the batch.

    Counts per envelope are summed in two steps, within a range of shard numbers and over the
    ranges, so no window holds more than one range or the list of ranges, however envelopes are
    numbered. The ends of the ranges are quantiles, at most ``ranges`` of them; how the offsets
    are joined is left to the planner. With ``scratch`` they are written first, so their size is known when the join is
    planned: a list that is small is broadcast, and neither the records are shuffled nor their windows computed again.
    """
    shards = staged.groupBy("shard_no").agg(F.count("pos").alias("n"))
    asked = [k / ranges for k in range(1, ranges)]
    ends = staged.select("shard_no").agg(F.percentile_approx("shard_no", asked, 20 * ranges)).first()[0] or []
    bounds = F.array(*[F.lit(e) for e in sorted(set(ends))]).cast("array<bigint>")
    shards = shards.withColumn("part", F.array_size(F.filter(bounds, lambda e: e < F.col("shard_no"))))
    before = (W.unboundedPreceding, -1)
    parts = shards.groupBy("part").agg(F.sum("n").alias("part_n"))
    parts = parts.select(
        "part", F.coalesce(F.sum("part_n").over(W.orderBy("part").rowsBetween(*before)), F.lit(0)).alias("part_base")
    )
    inner = W.partitionBy("part").orderBy("shard_no").rowsBetween(*before)
    bases = shards.withColumn("shard_base", F.coalesce(F.sum("n").over(inner), F.lit(0))).join(parts, "part")
    bases = bases.select("shard_no", (F.col("part_base") + F.col("shard_base")).alias("base"))
    if scratch:
        bases = scratch.materialize(bases, "positions")
    return staged.join(bases, "shard_no").withColumn("global_pos", F.col("base") + F.col("pos")).drop("base")
