"""How far the sources of a language differ in their words, and which words mark a source.

A *term* is a run of letters A to Z, which are lower-cased, and of characters beyond ASCII. One ``bytes.translate`` lowers the
letters and blanks everything else, ``bytes.split`` cuts the terms, and a ``Counter`` for each document gives the
occurrences and the documents of every term. Tasks add these up before anything is shuffled; what follows is
sparse: terms that a source lacks are never made rows, their part of a sum follows from how many there are.

Shares are whole numbers in billionths, smoothed by one; all arithmetic is exact in 64 bits up to 9e15 words.
"""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from landfall.llm.common import stage

LEAST_DOCS = 3  # documents of its language that hold a kept term
TOP = 200  # terms listed for a source
_HELD = 300_000  # terms that a task counts before it hands them on
_TABLE = bytes(c + 32 if 0x41 <= c <= 0x5A else c if 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256))


def terms(text: bytes) -> list[bytes]:
    """The terms of a UTF-8 text, in order."""
    return text.translate(_TABLE).split()


def _count(batches):
    """(lang, source, term, n, docs) sums of one task, handed on whenever too many are held."""
    import pyarrow as pa
    import pyarrow.compute as pc

    held: dict[tuple[str, str], tuple[Counter, Counter]] = {}

    def drain():
        for (lang, source), (counts, docs) in held.items():
            words = pc.cast(pa.array(list(counts), pa.binary()), options=pc.CastOptions(target_type=pa.string(), allow_invalid_utf8=True))
            n = pa.array(list(counts.values()), pa.int64())
            size = len(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * size, pa.string()), pa.array([source] * size, pa.string()), words, n, pa.array([docs[w] for w in counts], pa.int64())],
                names=["lang", "source", "term", "n", "docs"],
            )
        held.clear()

    size = 0
    for batch in batches:
        langs, sources = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for lang, source, text in zip(langs, sources, batch.column(2).cast(pa.binary()), strict=True):
            found = Counter(terms(text.as_py()))
            if not found:
                continue
            counts, docs = held.setdefault((lang, source), (Counter(), Counter()))
            size -= len(counts)
            counts.update(found.elements())
            docs.update(found.keys())
            size += len(counts)
            if size > _HELD:
                yield from drain()
                size = 0
    yield from drain()


def kept_terms(docs: DataFrame, least: int = LEAST_DOCS) -> DataFrame:
    """lang, term, total, counts (source, n) of the terms in at least ``least`` documents of their language.

    ``docs`` has lang, source and text without nulls. One shuffle of the sums of the tasks, by language and term.
    """
    counted = docs.select("lang", "source", "text").mapInArrow(_count, "lang string, source string, term string, n long, docs long")
    by_source = counted.repartition("lang", "term").groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    by_term = by_source.groupBy("lang", "term").agg(
        F.sum("n").alias("total"), F.sum("docs").alias("docs"), F.collect_list(F.struct("source", "n")).alias("counts")
    )
    return by_term.where(F.col("docs") >= least).drop("docs")


def group_sizes(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """For every (lang, source) that occurs: its words, and the words and number of the kept terms of its language."""
    langs = kept.groupBy("lang").agg(F.count("*").alias("vocabulary"), F.sum("total").alias("lang_words"))
    words = kept.select("lang", F.inline("counts")).groupBy("lang", "source").agg(F.sum("n").alias("words"))
    every = docs.select("lang", "source").distinct().join(words, ["lang", "source"], "left").join(langs, "lang", "left")
    return every.fillna(0, ["words", "vocabulary", "lang_words"])


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def share(n: Column, words: str, vocabulary: str = "vocabulary") -> Column:
    """1 + floor(10^9 (n + 1) / (words + vocabulary)), three digits at a time so that no product leaves 64 bits."""
    d, rest, out = F.col(words) + F.col(vocabulary), n + F.lit(1).cast("long"), F.lit(0).cast("long")
    for _ in range(3):
        out = out * 1000 + _div(rest * 1000, d)
        rest = rest * 1000 % d
    return out + 1


def excess(p: Column | str, q: Column | str) -> Column:
    """floor((p - q)^2 / q)."""
    p, q = (F.col(c) if isinstance(c, str) else c for c in (p, q))
    return _div((p - q) * (p - q), q)


def marked_terms(kept: DataFrame, sizes: DataFrame, top: int = TOP) -> DataFrame:
    """The ``top`` terms of each source by the excess of their share over that in the language.

    The limit is applied before the shuffle, so a source with a third of all words sends ``top`` rows a task.
    """
    rows = kept.select("lang", F.col("term").alias("item"), "total", F.inline("counts")).join(sizes, ["lang", "source"])
    rows = rows.select("lang", "source", "item", share(F.col("n"), "words").alias("p"), share(F.col("total"), "lang_words").alias("q"))
    rows = rows.where("p > q").select("lang", "source", "item", excess("p", "q").alias("value"))
    return _ranked(rows, "term").where(F.col("rank") <= top)


def _ranked(rows: DataFrame, part: str) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return rows.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(order).alias("rank"))


def source_pairs(kept: DataFrame, sizes: DataFrame) -> DataFrame:
    """The summed excess of each source over each other one of its language, over all kept terms.

    With pa(n) the share of n occurrences in a, the sum over all terms of excess(pa, pb) is the number of
    terms times excess(pa(0), pb(0)), plus for each term in a what it adds alone, plus the same for b, plus a
    correction for each term in both. Terms in one source are summed by their number of occurrences; terms in both are
    made rows once for a pair and added up in the task.
    """
    zero = F.lit(0).cast("long")
    known = sizes.select("lang", "source", "words", "vocabulary", share(zero, "words").alias("p0")).where("vocabulary > 0")
    side = {s: known.select("lang", *[F.col(c).alias(f"{c}_{s}") for c in known.columns if c != "lang"]) for s in ("a", "b")}
    pairs = side["a"].join(side["b"].drop("vocabulary_b"), "lang").where("source_a <> source_b")

    counts = F.transform("counts", lambda c: F.struct(c["source"].alias("source"), c["n"].alias("n")))
    left = kept.where(F.size("counts") > 1).select("lang", "counts", F.inline(counts).alias("source_a", "n_a"))
    left = left.join(side["a"], ["lang", "source_a"]).withColumn("p_a", share(F.col("n_a"), "words_a", "vocabulary_a"))
    both = left.select("lang", "source_a", "p_a", "p0_a", F.inline("counts").alias("source_b", "n_b")).where("source_a < source_b")
    both = both.join(side["b"], ["lang", "source_b"]).withColumn("p_b", share(F.col("n_b"), "words_b", "vocabulary_b"))

    def correction(x, y):
        return excess(f"p_{x}", f"p_{y}") - excess(f"p_{x}", f"p0_{y}") - excess(f"p0_{x}", f"p_{y}") + excess(f"p0_{x}", f"p0_{y}")

    both = both.groupBy("lang", "source_a", "source_b").agg(
        F.sum(correction("a", "b")).alias("ab"), F.sum(correction("b", "a")).alias("ba")
    )
    directed = F.array(
        F.struct(F.col("source_a").alias("source"), F.col("source_b").alias("item"), F.col("ab").alias("value")),
        F.struct(F.col("source_b").alias("source"), F.col("source_a").alias("item"), F.col("ba").alias("value")),
    )
    parts = [both.select("lang", F.inline(directed))]

    base = excess("p0_a", "p0_b")
    names = [F.col("source_a").alias("source"), F.col("source_b").alias("item")]
    parts.append(pairs.select("lang", *names, (F.col("vocabulary_a") * base).alias("value")))
    histogram = kept.select("lang", F.inline("counts")).groupBy("lang", "source", "n").agg(F.count("*").alias("terms"))
    for s in ("a", "b"):
        alone = histogram.withColumnRenamed("source", f"source_{s}").join(pairs, ["lang", f"source_{s}"])
        p = share(F.col("n"), f"words_{s}", "vocabulary_a")
        more = (excess(p, "p0_b") if s == "a" else excess("p0_a", p)) - base
        parts.append(alone.select("lang", *names, (F.col("terms") * more).alias("value")))

    empty = sizes.where("vocabulary = 0").select("lang", "source")
    lacking = empty.join(empty.withColumnRenamed("source", "item"), "lang").where("source <> item")
    parts.append(lacking.select("lang", "source", "item", zero.alias("value")))
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    return _ranked(rows.groupBy("lang", "source", "item").agg(F.sum("value").alias("value")), "pair")


def audit_sources(
    docs: DataFrame, least: int = LEAST_DOCS, top: int = TOP, text: str = "text", lang: str = "lang", source: str = "source"
) -> DataFrame:
    """lang, source, part, item, value, rank: every pair of sources of a language, and the terms that mark a source.

    Null texts, languages and sources are empty strings. Documents are rows: a repeated row counts again, whatever its
    id, and ids and other columns are not read. A source without terms is compared like any other; where a
    language has no kept term at all, its pairs have the value 0. An empty table gives no rows.
    """
    rows = docs.select(
        F.coalesce(F.col(lang).cast("string"), F.lit("")).alias("lang"),
        F.coalesce(F.col(source).cast("string"), F.lit("")).alias("source"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    kept = stage(kept_terms(rows, least), "terms")
    sizes = stage(group_sizes(rows, kept), "sizes")
    return source_pairs(kept, sizes).unionByName(marked_terms(kept, sizes, top))


ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
w AS (SELECT r, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
k AS (SELECT lang, term, count(*) AS total FROM w GROUP BY lang, term HAVING count(DISTINCT r) >= 3),
v AS (SELECT lang, count(*) AS v, sum(total)::HUGEINT AS lang_n FROM k GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*) AS n FROM w JOIN k USING (lang, term) GROUP BY lang, source, term),
f AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, k.total, v.v, v.lang_n,
         (sum(coalesce(c.n, 0)) OVER (PARTITION BY g.lang, g.source))::HUGEINT AS group_n
  FROM g JOIN k USING (lang) JOIN v USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
s AS (
  SELECT *, 1 + 1000000000::HUGEINT * (n + 1) // (group_n + v) AS p, 1 + 1000000000::HUGEINT * (total + 1) // (lang_n + v) AS q
  FROM f),
x AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM s a JOIN s b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY a.lang, a.source, b.source),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(x.value, 0)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source),
marked AS (
  SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q) // q)::BIGINT AS value FROM s WHERE n > 0 AND p > q),
o AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM marked))
SELECT * FROM o WHERE part = 'pair' OR rank <= 200
"""
