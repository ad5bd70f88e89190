"""Mixing sources to target weights with hash-threshold histograms.

A document has a fixed point on the hash line. A source takes every document whose point lies below the
source's threshold, so a larger budget only ever adds documents. The threshold comes from sums of sizes by
source and hash bucket: the bucket in which the budget is reached is split into finer buckets, again and
again, until it holds one point. Nothing is sorted; only bucket sums are shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from landfall.llm.common import WORD, stage

WEIGHTS = (5, 2, 1)  # of the sources in order, repeating
MOST = 3  # a source gives at most so many times its size
DIGITS = 3  # hexadecimal digits of the hash by which one level of buckets is finer than the one above
LEVELS = 5


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def point(doc_id: Column) -> Column:
    """Place of a document on the hash line: the first 15 hexadecimal digits of the md5 of its id, as text."""
    return F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit("null")).cast("binary")), 1, DIGITS * LEVELS)


def targets(sizes: DataFrame, weights=WEIGHTS, most: int = MOST) -> DataFrame:
    """source, source_size, target, from one row per source.

    All targets together are the total size. A source whose share exceeds ``most`` times its size is held
    there and the rest is shared again by weight. Sources that overflow do so in the order of
    size / weight, so one ordered pass over the sources finds them. Windows here run over sources, not rows.
    """
    order = Window.orderBy(F.col("source").isNull(), F.col("source"))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.row_number().over(order) - 1) % len(weights) + 1)
    ranked = sizes.withColumn("weight", weight)
    by_ratio = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").isNull(), F.col("source"))
    before, everything = by_ratio.rowsBetween(Window.unboundedPreceding, -1), Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    held = F.coalesce(F.sum("source_size").over(before), F.lit(0)) * F.lit(most)
    light = F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    per_weight = (F.sum("source_size").over(everything) - held) / (F.sum("weight").over(everything) - light)
    over = F.col("weight") * F.col("per_weight") > F.col("source_size") * F.lit(most)
    levelled = ranked.withColumn("per_weight", per_weight).withColumn("over", over)
    rate = F.min(F.when(~F.col("over"), F.struct(F.col("source_size") / F.col("weight"), F.col("per_weight")))).over(everything)
    target = F.when(F.col("over"), (F.col("source_size") * F.lit(most)).cast("double")).otherwise(F.col("weight") * rate["per_weight"])
    return levelled.select("source", "source_size", target.alias("target"))


def _thresholds(sized: DataFrame, budgets: DataFrame) -> DataFrame:
    """source -> prefix and copies: points below ``prefix`` are taken once more than ``copies`` whole times.

    ``need`` is what the fraction of the source above whole copies still lacks. In each level the bucket in
    which it is reached becomes the next level's input; the last bucket is taken if that comes nearer.
    """
    open_ = budgets.select("source", "copies", "need", F.lit("").alias("prefix"))
    for level in range(1, LEVELS + 1):
        length = level * DIGITS
        rows = sized.join(open_.select(F.col("source").alias("s"), "prefix"), F.col("source").eqNullSafe(F.col("s")))
        inside = rows.filter(F.substring("point", 1, length - DIGITS) == F.col("prefix")) if level > 1 else rows
        sums = inside.groupBy("source", F.substring("point", 1, length).alias("bucket")).agg(F.sum("size").alias("mass"), F.min("point").alias("low"), F.max("point").alias("high"))
        window = Window.partitionBy("source").orderBy("bucket")
        running = sums.withColumn("upto", F.sum("mass").over(window)).withColumn("before", F.col("upto") - F.col("mass"))
        hit = running.join(open_.select(F.col("source").alias("s"), "copies", "need", "prefix"), F.col("source").eqNullSafe(F.col("s")))
        reached = hit.filter((F.col("before") <= F.col("need")) & (F.col("need") < F.col("upto")) & (F.col("mass") > 0))
        lone = F.col("low") == F.col("high")
        nearer = F.col("upto") - F.col("need") < F.col("need") - F.col("before")
        # the threshold is a text: points below it are taken; "~" sorts after every hexadecimal digit
        step = reached.select(
            "source", "copies", (F.col("need") - F.col("before")).alias("need"), F.col("bucket").alias("prefix"), lone.alias("done"),
            F.when(lone & nearer, F.concat("bucket", F.lit("~"))).otherwise(F.col("bucket")).alias("threshold"),
        )
        step = stage(step, f"mix-level-{level}")
        done = step.filter("done").select("source", "threshold")
        closed = done if level == 1 else closed.unionByName(done)
        open_ = step.filter("not done").select("source", "copies", "need", "prefix")
        if open_.isEmpty():
            return closed
    return closed.unionByName(open_.select("source", F.col("prefix").alias("threshold")))


def mix_sources(docs: DataFrame, weights=WEIGHTS, most: int = MOST, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """One row per row of ``docs``: doc_id, size, source_size, target, taken.

    Size is the number of words (null text: 0). Sources are ordered by code point, null last, and have
    ``weights`` in turn. ``taken`` is the size times the number of times the mix holds the document, at
    most ``most``. The sum of a source differs from its target by at most half the document at the
    threshold. Rows that repeat a doc_id stand or fall together; so do null ids of one source. A source
    without words has target 0. Other columns are ignored. The outcome depends on ids, sizes and sources
    alone, so reruns agree on any cluster.
    """
    sized = docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), word_count(F.col(text)).alias("size"), point(F.col(doc_id)).alias("point"))
    sized = stage(sized, "mix-sizes")
    totals = stage(targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, most), "mix-targets")
    copies = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    budgets = totals.withColumn("copies", copies).withColumn("need", F.col("target") - F.col("copies") * F.col("source_size"))
    cuts = stage(_thresholds(sized, budgets.filter("need > 0").select("source", "copies", "need")), "mix-cuts")
    plan = budgets.join(cuts.select(F.col("source").alias("s"), "threshold"), F.col("source").eqNullSafe(F.col("s")), "left")
    plan = stage(plan.select(F.col("source").alias("s"), "source_size", "target", "copies", F.coalesce("threshold", F.lit("")).alias("threshold")), "mix-plan")
    once_more = (F.col("point") < F.col("threshold")).cast("long")
    joined = sized.join(plan, F.col("source").eqNullSafe(F.col("s")))
    return joined.select("doc_id", "size", "source_size", "target", ((F.col("copies") + once_more) * F.col("size")).alias("taken"), "source", (F.col("copies") + once_more).alias("times"))


def mix_documents(docs: DataFrame) -> DataFrame:
    """The documents of the mix: each row as many times as it is taken, in the columns of ``docs``."""
    times = stage(mix_sources(docs).filter("times > 0").select("doc_id", "source", "times").distinct(), "mix-times")
    t = times.select(F.col("doc_id").alias("__mix_id"), F.col("source").alias("__mix_source"), F.col("times").cast("int").alias("__mix_times"))
    joined = docs.join(t.hint("merge"), docs["doc_id"].eqNullSafe(F.col("__mix_id")) & docs["source"].eqNullSafe(F.col("__mix_source")))
    copies = F.explode(F.array_repeat(F.lit(0), F.col("__mix_times")))
    return joined.withColumn("__mix_copy", copies).drop("__mix_id", "__mix_source", "__mix_times", "__mix_copy")


ORACLE = """
WITH sized AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size,
         substr(md5(coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 15) AS point
  FROM documents),
totals AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         [5.0, 2.0, 1.0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::DOUBLE AS weight
  FROM sized GROUP BY source),
levels AS (
  SELECT *, (sum(source_size) OVER () - 3 * coalesce(sum(source_size) OVER before, 0))
            / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS per_weight
  FROM totals
  WINDOW before AS (ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
marked AS (SELECT *, weight * per_weight > 3 * source_size AS over FROM levels),
budgets AS (
  SELECT source, source_size,
         CASE WHEN over THEN CAST(3 * source_size AS DOUBLE)
              ELSE weight * (SELECT arg_min(per_weight, source_size / weight) FROM marked WHERE NOT over) END AS target
  FROM marked),
parts AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS copies FROM budgets),
points AS (SELECT source, point, sum(size) AS mass FROM sized GROUP BY source, point),
running AS (
  SELECT p.source, point, mass, sum(mass) OVER (PARTITION BY p.source ORDER BY point) AS upto,
         target - copies * source_size AS need
  FROM points p JOIN parts b ON p.source IS NOT DISTINCT FROM b.source),
chosen AS (
  SELECT source, point FROM running
  WHERE upto <= need OR (upto - mass <= need AND upto - need < need - (upto - mass)))
SELECT s.doc_id, s.size, b.source_size, b.target,
       (b.copies + CASE WHEN c.point IS NULL THEN 0 ELSE 1 END) * s.size AS taken
FROM sized s JOIN parts b ON s.source IS NOT DISTINCT FROM b.source
LEFT JOIN chosen c ON s.source IS NOT DISTINCT FROM c.source AND s.point = c.point
"""
