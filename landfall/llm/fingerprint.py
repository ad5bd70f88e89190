"""Document fingerprints by one-permutation MinHash with optimal densification.

Each shingle (five words) is hashed once. The hash's bin is its remainder modulo the number of bins, and a bin
keeps its least hash. An empty bin takes the value of the first filled bin among those that a hash of (bin,
attempt) names; after the fixed number of attempts, that of the filled bin whose hash with this bin is least.
Only the low bits of each value are stored. Equal low bits of different values are expected at a known rate,
which the likeness of two fingerprints corrects for.

Everything is array and hash functions of Spark SQL.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from landfall.llm.common import SPACE

BINS = 256
BITS = 8  # low bits stored of each bin, two hexadecimal digits
WORDS = 5
ATTEMPTS = 12
RANGE_DOCS = 4000  # documents of a range of doc_id in which neighbours are found
MOST_RANGES = 65_536
_PRIME = 65_521


def _shingle_hashes(words: str) -> Column:
    """Sorted hashes of the shingles; a text of fewer words is one shingle, one without words has none."""
    n = F.size(words)
    whole = F.when(n > 0, F.array(F.xxhash64(F.concat_ws(" ", words)))).otherwise(F.array().cast("array<long>"))
    shingle = lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(WORDS)])
    return F.sort_array(F.when(n >= WORDS, F.transform(F.sequence(F.lit(0), n - WORDS), shingle)).otherwise(whole))


def _bin(h: Column, bins: int) -> Column:
    """The highest bits of a hash, so that sorted hashes come bin by bin."""
    return (F.shiftrightunsigned(h.bitwiseXOR(F.lit(-(1 << 63))), 64 - (bins.bit_length() - 1))).cast("int")


def with_fingerprint(df: DataFrame, text: str, name: str, bins: int = BINS, bits: int = BITS) -> DataFrame:
    """Add ``name``: the low bits of each bin as an array of integers, null for a text without words.

    Steps are columns of their own, so that none is evaluated twice.
    """
    w, h, m, v = (f"__{name}_{k}" for k in "whmv")
    words = F.filter(F.split(F.col(text), SPACE), lambda x: x != "")
    df = df.withColumn(w, words)
    df = df.withColumn(h, _shingle_hashes(w)).drop(w)
    first = lambda x, i: (i == 0) | (_bin(x, bins) != _bin(F.get(h, i - 1), bins))
    df = df.withColumn(m, F.filter(h, first)).drop(h)
    gap = lambda x, i: _bin(x, bins) - F.coalesce(_bin(F.get(m, i - 1), bins), F.lit(-1)) - 1
    none = F.lit(None).cast("long")
    spread = F.flatten(F.transform(m, lambda x, i: F.concat(F.array_repeat(none, gap(x, i)), F.array(x))))
    last = F.lit(bins - 1) - F.coalesce(_bin(F.get(m, F.size(m) - 1), bins), F.lit(bins - 1))
    df = df.withColumn(v, F.when(F.size(m) > 0, F.concat(spread, F.array_repeat(none, last))))

    def donor(i):
        tried = [F.get(v, ((i + 1) * (7919 * t * t + 104_729) + 31 * t) % _PRIME % bins) for t in range(1, ATTEMPTS + 1)]
        rest = F.array_min(F.transform(m, lambda x: F.struct(F.xxhash64(i, _bin(x, bins)).alias("order"), x.alias("value"))))
        return F.coalesce(*tried, rest["value"])

    filled = F.transform(v, lambda x, i: F.coalesce(x, donor(i)).bitwiseAND(F.lit((1 << bits) - 1)).cast("int"))
    return df.withColumn(name, filled).drop(v, m)


def packed(bins: Column, bits: int = BITS) -> Column:
    """The fingerprint as text: hexadecimal digits of each bin in turn; empty for a text without words."""
    width = (bits + 3) // 4
    digits = F.from_json(F.lit(json.dumps([f"{x:0{width}x}" for x in range(1 << bits)])), "array<string>")  # a constant of the plan
    return F.coalesce(F.array_join(F.transform(bins, lambda x: F.get(digits, x)), ""), F.lit(""))


def likeness(a: Column, b: Column, n: int = BINS, bits: int = BITS) -> Column:
    """Estimated Jaccard similarity of the shingle sets: share of equal bins, less what chance makes equal.

    Two texts without words are alike (1), one with and one without are not (0).
    """
    equal = F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda x: x))
    chance = 1.0 / (1 << bits)
    estimate = F.greatest(F.lit(0.0), (equal / F.lit(float(n)) - F.lit(chance)) / F.lit(1 - chance))
    return F.when(a.isNull() & b.isNull(), F.lit(1.0)).when(a.isNull() | b.isNull(), F.lit(0.0)).otherwise(estimate)


def _places_below(value: Column, ends: list[int]) -> Column:
    """How many of the sorted ``ends`` lie below ``value``: first whole runs of them, then within one run."""
    run = max(1, math.isqrt(len(ends)))
    runs = F.from_json(F.lit(json.dumps([ends[i : i + run] for i in range(0, len(ends), run)])), "array<array<bigint>>")
    tops = F.from_json(F.lit(json.dumps([ends[min(i + run, len(ends)) - 1] for i in range(0, len(ends), run)])), "array<bigint>")
    below = lambda items: F.aggregate(items, F.lit(0), lambda n, e: n + (e < value).cast("int"))
    return below(tops) * run + F.coalesce(below(F.get(runs, below(tops))), F.lit(0))


def with_next(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, WindowSpec]:
    """Rows (doc_id, text, part, guest, key, tie) and the window that orders them by descending doc_id.

    Null ids come after all others. Documents are dealt by ranges of doc_id whose upper ends are documents.
    Each range also gets, as guests, the documents at the upper end of the range below, which follow its last
    document; the lowest range gets the highest documents. So the text moves once and no task holds more
    than a range. The ends are quantiles, at most ``MOST_RANGES`` of them.
    """
    key = F.coalesce(F.col(doc_id).cast("long"), F.lit(-(1 << 63)))
    base = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"), key.alias("key"))
    n = base.agg(F.count("*")).first()[0]
    parts = min(MOST_RANGES, max(1, -(-n // RANGE_DOCS)))
    asked = F.percentile_approx("key", [k / parts for k in range(1, parts)] + [1.0], max(10_000, 20 * parts))
    ends = sorted(set(base.agg(asked).first()[0] or [0]))
    at_end = F.array_position(F.from_json(F.lit(json.dumps(ends)), "array<bigint>"), F.col("key")) > 0
    own = F.struct(_places_below(F.col("key"), ends).alias("part"), F.lit(0).alias("guest"))
    above = F.struct(((own["part"] + 1) % len(ends)).alias("part"), F.lit(1).alias("guest"))
    seats = F.explode(F.when(at_end, F.array(own, above)).otherwise(F.array(own)))
    rows = base.withColumn("seat", seats).select("doc_id", "text", "seat.part", "seat.guest", "key", F.xxhash64("text").alias("tie"))
    return rows, Window.partitionBy("part").orderBy("guest", F.desc("key"), "tie")


def edited(text: Column, following: Column) -> Column:
    """The text with the last half of its code points (rounded down) replaced by the first as many of the following one."""
    half = F.floor(F.length(text) / 2).cast("int")
    return F.concat(F.substr(text, F.lit(1), F.length(text) - half), F.substr(following, F.lit(1), half))


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    Null text is empty. Equal texts have equal fingerprints; a text without words has the empty one. The next
    document is that with the next smaller doc_id, after the last the first; rows that repeat a doc_id follow
    each other by content, so a single row is its own next. Other columns are ignored.
    """
    rows, window = with_next(docs, doc_id, text)
    rows = rows.withColumn("following", F.lead("text").over(window))
    rows = rows.withColumn("following", F.coalesce("following", "text")).withColumn("edited", edited(F.col("text"), F.col("following"))).drop("following")
    rows = rows.withColumn("n_chars", F.length("text").cast("long")).withColumn("edited_sha256", F.sha2(F.col("edited").cast("binary"), 256))
    rows = with_fingerprint(rows, "text", "own").drop("text")
    rows = with_fingerprint(rows, "edited", "other").drop("edited")
    rows = rows.withColumn("after", F.lead(F.struct("own")).over(window)).filter("guest = 0")
    after = F.when(F.col("after").isNull(), F.col("own")).otherwise(F.col("after.own"))
    return rows.select(
        "doc_id", "n_chars", "edited_sha256", packed(F.col("own")).alias("fingerprint"), packed(F.col("other")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("other")).alias("near_edited"), likeness(F.col("own"), after).alias("near_next"),
    )
