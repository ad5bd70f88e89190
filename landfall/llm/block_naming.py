"""Exact duplicates by deterministic block naming.

Each text is cut into fixed-size blocks. Every distinct block receives a name, a pair of integers
``(digest, rank)``: blocks are sorted by their 64-bit digest and, within one digest, by content; rank
is the place within the digest. Two blocks have the same name only if they are the same text, because
blocks that share a digest are compared in full. Adjacent names are then named as pairs, level by level,
until each document has one name, its identity.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landfall.llm.common import stage

BLOCK = 4096  # characters of a block


def _named(rows: DataFrame, content: list[str], level: str) -> DataFrame | None:
    """Ranks above 0 of the distinct contents that share a digest; None if no two do.

    One exchange: equal contents meet on the map side first, so a block that a third of all documents
    hold travels once per task.
    """
    distinct = rows.select("digest", *content).distinct()
    shared = stage(distinct.groupBy("digest").count().filter("count > 1").select("digest"), f"naming-{level}-shared")
    if shared.isEmpty():
        return None
    clashing = distinct.join(shared, "digest").groupBy("digest").agg(F.sort_array(F.collect_list(F.struct(*content))).alias("c"))
    ranked = clashing.select("digest", F.posexplode("c").alias("rank", "c")).filter("rank > 0")
    return stage(ranked.select("digest", F.col("rank").cast("long").alias("rank"), "c.*"), f"naming-{level}-ranks")


def identities(texts: DataFrame, keys: list[str], text: str, block: int = BLOCK, digest=F.xxhash64) -> DataFrame:
    """``keys`` and ``identity`` (digest, rank, characters): equal exactly for rows with equal ``text``.

    ``digest`` maps columns to 64-bit integers; any function gives right results, a poor one more work.
    Null text counts as empty. The text moves once, as distinct blocks, to be named; what moves
    afterwards are integers.
    """
    n = F.length("_text")
    count = F.greatest(F.lit(1), F.ceil(n / F.lit(block))).cast("int")
    cut = lambda i: F.substr(F.col("_text"), i * F.lit(block) + F.lit(1), F.lit(block))
    base = texts.select(*keys, F.coalesce(F.col(text), F.lit("")).alias("_text"))
    blocks = base.select(F.explode(F.transform(F.sequence(F.lit(0), count - 1), cut)).alias("block"))
    ranks = _named(blocks.select(digest(F.col("block")).alias("digest"), "block"), ["block"], "0")
    if ranks is None:
        name = lambda i: F.struct(digest(cut(i)).alias("digest"), F.lit(0).cast("long").alias("rank"))
        names = base.select(*keys, n.alias("_n"), F.transform(F.sequence(F.lit(0), count - 1), name).alias("_names"))
        names = stage(names, "naming-0")
    else:
        tagged = stage(base.select(F.expr("uuid()").alias("_row"), *keys, "_text"), "naming-rows")
        single = tagged.select("_row", F.posexplode(F.transform(F.sequence(F.lit(0), count - 1), cut)).alias("i", "block"))
        joined = single.withColumn("digest", digest(F.col("block"))).join(ranks, ["digest", "block"], "left")
        item = F.struct("i", "digest", F.coalesce("rank", F.lit(0).cast("long")).alias("rank"))
        lists = joined.groupBy("_row").agg(F.sort_array(F.collect_list(item)).alias("_names"))
        plain = F.transform("_names", lambda x: F.struct(x["digest"].alias("digest"), x["rank"].alias("rank")))
        names = stage(tagged.select("_row", *keys, n.alias("_n")).join(lists, "_row").select(*keys, "_n", plain.alias("_names")), "naming-0")
    longest = names.agg(F.max(F.size("_names"))).first()[0] or 1
    level = 0
    while longest > 1:
        level += 1
        names = _pair_up(names, level, digest)
        longest = (longest + 1) // 2
    identity = F.struct(F.col("_names")[0]["digest"].alias("digest"), F.col("_names")[0]["rank"].alias("rank"), F.col("_n").alias("chars"))
    return names.select(*keys, identity.alias("identity"))


def _pair_up(names: DataFrame, level: int, digest) -> DataFrame:
    """Replace each two adjacent names by the name of the pair; a last single name is paired with nothing (-1, -1)."""
    half = F.expr("cast((size(_names) + 1) div 2 as int)")
    at = lambda i, k: F.coalesce(F.get("_names", i * 2 + k)["digest"], F.lit(-1).cast("long"))
    rank = lambda i, k: F.coalesce(F.get("_names", i * 2 + k)["rank"], F.lit(-1).cast("long"))
    pair = lambda i: F.struct(at(i, 0).alias("a"), rank(i, 0).alias("ar"), at(i, 1).alias("b"), rank(i, 1).alias("br"))
    keys = [c for c in names.columns if c not in ("_n", "_names")]
    pairs = names.filter(F.size("_names") > 1).select(F.explode(F.transform(F.sequence(F.lit(0), half - 1), pair)).alias("p")).select("p.*")
    parts = ["a", "ar", "b", "br"]
    ranks = _named(pairs.select(digest(*[F.col(c) for c in parts]).alias("digest"), *parts), parts, str(level))
    if ranks is None:
        name = lambda i: F.struct(digest(at(i, 0), rank(i, 0), at(i, 1), rank(i, 1)).alias("digest"), F.lit(0).cast("long").alias("rank"))
        named = F.transform(F.sequence(F.lit(0), half - 1), name)
        return stage(names.select(*keys, "_n", F.when(F.size("_names") > 1, named).otherwise(F.col("_names")).alias("_names")), f"naming-{level}")
    tagged = stage(names.withColumn("_row", F.expr("uuid()")), f"naming-{level}-rows")
    many = tagged.filter(F.size("_names") > 1).select("_row", F.posexplode(F.transform(F.sequence(F.lit(0), half - 1), pair)).alias("i", "p")).select("_row", "i", "p.*")
    joined = many.withColumn("digest", digest(*[F.col(c) for c in parts])).join(ranks, ["digest", *parts], "left")
    item = F.struct("i", "digest", F.coalesce("rank", F.lit(0).cast("long")).alias("rank"))
    lists = joined.groupBy("_row").agg(F.sort_array(F.collect_list(item)).alias("_more"))
    plain = F.transform("_more", lambda x: F.struct(x["digest"].alias("digest"), x["rank"].alias("rank")))
    return stage(tagged.join(lists, "_row", "left").select(*keys, "_n", F.coalesce(plain, F.col("_names")).alias("_names")), f"naming-{level}")


def without_space(text: Column) -> Column:
    """The text without space and U+0009 to U+000D; null becomes empty."""
    out = F.coalesce(text, F.lit(""))
    for code in (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D):
        out = F.replace(out, F.lit(chr(code)), F.lit(""))
    return out


def exact_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", block: int = BLOCK, digest=F.xxhash64) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they are the same without white space. The row with the most characters in its
    original text stays, then the one with the smallest doc_id; a null doc_id comes last. Null texts are
    empty, and empty texts are equal to each other. Of rows that repeat both, one stays. Other columns are
    ignored, whatever their names.
    """
    base = docs.select(F.col(doc_id).alias("doc_id"), F.length(F.coalesce(F.col(text), F.lit(""))).cast("long").alias("_chars"), without_space(F.col(text)).alias("_norm"))
    base = base.withColumn("text_sha256", F.sha2(F.col("_norm").cast("binary"), 256))
    named = identities(base, ["doc_id", "_chars", "text_sha256"], "_norm", block, digest)
    named = stage(named.withColumn("_row", F.monotonically_increasing_id()), "exact-named")
    best = F.min(F.struct((-F.col("_chars")).alias("c"), F.col("doc_id").isNull().alias("n"), F.col("doc_id").alias("d"), F.col("_row").alias("r")))
    groups = named.groupBy("identity").agg(F.count("*").alias("group_size"), best.alias("b")).filter("group_size > 1")
    groups = stage(groups.select(F.col("identity").alias("g"), "group_size", F.col("b.d").alias("keep_id"), F.col("b.r").alias("keep_row")), "exact-groups")
    joined = named.join(groups, named.identity == groups.g, "left")
    single = F.col("group_size").isNull()
    return joined.select(
        "doc_id",
        F.when(single, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        (single | (F.col("_row") == F.col("keep_row"))).alias("kept"),
        "text_sha256",
    )


def drop_exact(docs: DataFrame) -> DataFrame:
    """``docs`` without the rows that are copies of one that stays; same columns, same order of columns.

    Rows go by doc_id and text, so rows that repeat both of the one that stays are that document and stay with it.
    """
    lost = exact_groups(docs).filter(~F.col("kept") & ~F.col("doc_id").eqNullSafe(F.col("keep_id")))
    dropped = stage(lost.select("doc_id", "text_sha256").distinct(), "exact-dropped")
    sha = F.sha2(without_space(docs["text"]).cast("binary"), 256)
    return docs.join(dropped.hint("merge"), docs["doc_id"].eqNullSafe(dropped["doc_id"]) & (sha == dropped["text_sha256"]), "left_anti")
