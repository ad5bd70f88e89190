"""Fill-in-the-middle transformation by pyarrow.compute over whole record batches.

A text is a sequence of *units*: a run of separators (space and U+0009 to U+000D) with the word behind it, and
separators at the end alone. Two of the draws of a document cut its units into prefix, middle and suffix; the two
others decide whether it is transformed, and in which order (``psm`` or ``spm``). Everything is done for a slice of
documents at once: units become one list array, are flattened with the number of their document, get their place
in it, are filtered by role, become lists again, and the lists are joined into the pieces.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landfall.llm.common import text_slices

SENTINELS = ("<P>", "<S>", "<M>")  # before the prefix, the suffix and the middle
UNIT = r"[ \t-\r]*[^ \t-\r]+|[ \t-\r]+"
_MARK = b"\xff"  # ends a unit while a text is cut; no byte of UTF-8
_DRAWS = ("h1", "h2", "h3", "h4")


def draws(doc_id: str, seed: int) -> list[Column]:
    """Four unsigned 32-bit numbers from the SHA-256 of ``seed:doc_id``; a null id counts as the text 'null'."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit("null"))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long").alias(h) for i, h in enumerate(_DRAWS)]


def split_units(texts):
    """List array of the units of each text; texts are large_binary without nulls."""
    import pyarrow as pa
    import pyarrow.compute as pc

    marked = pc.split_pattern(pc.replace_substring_regex(texts, UNIT, b"\\0" + _MARK), _MARK)
    counts = pc.subtract(pc.list_value_length(marked), 1)  # what follows the last mark is empty
    values, parents = pc.list_flatten(marked), pc.list_parent_indices(marked)
    starts = pc.take(marked.offsets[:-1], parents)
    kept = pc.less(pc.subtract(pa.array(np.arange(len(values))), starts), pc.take(counts, parents))
    return _lists(pc.filter(values, kept), counts), counts


def _lists(values, counts):
    """Consecutive values as lists of the given lengths."""
    import pyarrow as pa
    import pyarrow.compute as pc

    ends = pc.cast(pc.cumulative_sum(pc.cast(counts, pa.int64())), pa.int32())
    return pa.ListArray.from_arrays(pa.concat_arrays([pa.array([0], pa.int32()), ends]), values)


def _modulo(a, n):
    import pyarrow.compute as pc

    return pc.subtract(a, pc.multiply(pc.divide(a, n), n))


def cut(units, low, high):
    """The joined units below ``low``, from there below ``high``, and the rest, for each list."""
    import pyarrow as pa
    import pyarrow.compute as pc

    counts = pc.cast(pc.list_value_length(units), pa.int64())
    values, parents = pc.list_flatten(units), pc.list_parent_indices(units)
    ends = pc.cumulative_sum(counts)
    place = pc.subtract(pa.array(np.arange(len(values))), pc.take(pc.subtract(ends, counts), parents))
    in_prefix, in_suffix = pc.less(place, pc.take(low, parents)), pc.greater_equal(place, pc.take(high, parents))
    roles = (
        (in_prefix, low),
        (pc.invert(pc.or_(in_prefix, in_suffix)), pc.subtract(high, low)),
        (in_suffix, pc.subtract(counts, high)),
    )
    nothing = pa.scalar(b"", pa.large_binary())
    return [pc.binary_join(_lists(pc.filter(values, role), size), nothing) for role, size in roles]


def _transform(texts, h1, h2, h3, h4, rate: int, spm_rate: int, sentinels: tuple[str, str, str]):
    """Columns n, form, prefix_chars, middle_chars, output of a slice of texts."""
    import pyarrow as pa
    import pyarrow.compute as pc

    before_prefix, before_suffix, before_middle = (pa.scalar(s.encode(), pa.large_binary()) for s in sentinels)
    units, counts = split_units(texts)
    n = pc.cast(counts, pa.int64())
    plain = pc.or_(pc.equal(n, 0), pc.greater_equal(_modulo(h3, 100), rate))
    for s in sentinels:
        plain = pc.or_(plain, pc.match_substring(texts, s))
    moved = pc.invert(plain)
    spm = pc.less(_modulo(h4, 100), spm_rate)
    form = pc.if_else(plain, "plain", pc.if_else(spm, "spm", "psm"))

    places = pc.add(n, 1)
    a, b = _modulo(h1, places), _modulo(h2, places)
    low, high = pc.min_element_wise(a, b), pc.max_element_wise(a, b)
    prefix, middle, suffix = cut(units.filter(moved), low.filter(moved), high.filter(moved))
    nothing = pa.scalar(b"", pa.large_binary())
    psm_text = pc.binary_join_element_wise(before_prefix, prefix, before_suffix, suffix, before_middle, middle, nothing)
    spm_text = pc.binary_join_element_wise(before_suffix, suffix, before_prefix, prefix, before_middle, middle, nothing)
    output = pc.replace_with_mask(texts, moved, pc.if_else(spm.filter(moved), spm_text, psm_text))

    def chars(pieces):
        size = pc.cast(pc.utf8_length(_text(pieces, pa.large_string())), pa.int64())
        return pc.replace_with_mask(pa.nulls(len(texts), pa.int64()), moved, size)

    return [n, form, chars(prefix), chars(middle), _text(output, pa.string())]


def _text(data, kind):
    import pyarrow as pa
    import pyarrow.compute as pc

    return pc.cast(data, options=pc.CastOptions(target_type=kind, allow_invalid_utf8=True))


def fill_in_middle(
    docs: DataFrame, seed: int = 42, rate: int = 50, spm_rate: int = 80, sentinels: tuple[str, str, str] = SENTINELS,
    doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, output for every row and whole text.

    ``rate`` of 100 documents are transformed and ``spm_rate`` of 100 of those put the suffix first; the draws depend
    on ``seed`` and doc_id alone, so reruns and repeated rows agree. A text that is empty, or that holds a sentinel and
    could not be restored, stays ``plain``: its output is the text and its piece lengths are null. A null text is empty, a null
    id is drawn for as the text 'null'. Nothing is shuffled, and other columns make no difference. A task holds the
    units of about two megabytes of text at a time, or of one longer document.
    """

    def run(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        names = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
        for batch in batches:
            ids, texts, *numbers = batch.columns
            texts = pc.cast(pc.cast(pc.fill_null(texts, ""), pa.large_string()), pa.large_binary())
            for at, to, _, _ in text_slices(batch.column(1)):
                part = pa.concat_arrays([texts.slice(at, to - at)])
                found = _transform(part, *[h.slice(at, to - at) for h in numbers], rate, spm_rate, sentinels)
                yield pa.RecordBatch.from_arrays([ids.slice(at, to - at), *found], names=names)

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), *draws(doc_id, seed))
    return rows.mapInArrow(run, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string")


def restore(transformed: DataFrame, sentinels: tuple[str, str, str] = SENTINELS) -> DataFrame:
    """Add ``restored``: the text before the transformation, from output and form alone.

    A transformed text holds each sentinel once, since texts that hold one stay plain and no sentinel can arise where two
    pieces meet.
    """
    parts = F.split("output", "|".join(re.escape(s) for s in sentinels), -1)
    first, second, third = (F.element_at("_parts", i) for i in (2, 3, 4))
    whole = F.when(F.col("form") == "plain", F.col("output"))
    whole = whole.when(F.col("form") == "psm", F.concat(first, third, second)).otherwise(F.concat(second, third, first))
    cut_up = transformed.withColumn("_parts", F.when(F.col("form") != "plain", parts))
    return cut_up.withColumn("restored", whole).drop("_parts")


def digests(docs: DataFrame) -> DataFrame:
    """What was cut and the SHA-256 of the output and of the text restored from it."""
    done = restore(fill_in_middle(docs))
    return done.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256"),
    )


ORACLE = r"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || doc_id) AS h,
         regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u FROM documents),
d AS (
  SELECT *, len(u)::BIGINT AS n, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2,
         ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4 FROM t),
c AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 50
              THEN 'plain' WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM d),
p AS (
  SELECT *, coalesce(array_to_string(u[1:a], ''), '') AS pre, coalesce(array_to_string(u[a + 1:b], ''), '') AS mid,
         coalesce(array_to_string(u[b + 1:n], ''), '') AS suf FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
                        ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM p
"""
