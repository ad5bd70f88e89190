"""Language identification by rank-order profiles.

A profile lists the most frequent character n-grams (one to three) of a language, of words padded with a blank, by rank. A
document is ranked likewise; its distance to a language is the sum, over the document's n-grams, of how far
each is out of its place in the profile, or the profile's length where it is absent. N-grams of equal count
share the mean of their places.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from landfall.llm.common import fold

PLACES = 400  # length of a profile
SHARPNESS = 40.0  # of the score: larger makes one language stand out more at the same distances
_BITS = np.int64(21)  # of a code point; an n-gram of up to three is one integer
_BLANK = 0x20
_MERGE = 1_000_000  # n-gram counts of a language that a task holds unmerged
_LETTERS: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """Whether each code point is a letter, as Python's isalpha says."""
    if not _LETTERS:
        _LETTERS.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _LETTERS[0]


def gram_counts(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """N-grams of one to three characters of the lower-cased words, as integers, and how often each occurs.

    A word is a run of letters, with a blank before and after it; no n-gram is a blank alone or reaches
    over one.
    """
    codes = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    solid = _letters()[codes]
    keep = solid.copy()
    keep[1:] |= solid[:-1]  # one blank for each gap
    row = np.full(int(keep.sum()) + 2, _BLANK, dtype=np.int64)
    row[1:-1] = np.where(solid, codes, _BLANK)[keep]
    if len(row) > 2 and row[-2] == _BLANK:
        row = row[:-1]
    two = row[:-1] << _BITS | row[1:]
    middle = row[1:-1] != _BLANK
    three = (two[:-1] << _BITS | row[2:])[middle]
    return np.unique(np.concatenate([row[1:-1][middle], two, three]) if middle.any() else row[:0], return_counts=True)


def gram_text(gram: int) -> str:
    """The characters of an n-gram."""
    out = ""
    while gram:
        out, gram = chr(gram & (1 << 21) - 1) + out, gram >> 21
    return out


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    grams, at = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    return grams, np.bincount(at, weights=np.concatenate([p[1] for p in parts]), minlength=len(grams)).astype(np.int64)


def _count_by_language(batches) -> Iterator:
    """(lang, gram, n) sums of one task."""
    import pyarrow as pa

    parts: dict[str, list] = {}
    held: dict[str, int] = {}

    def batch(lang):
        grams, n = _merged(parts.pop(lang))
        return pa.RecordBatch.from_arrays([pa.array([lang] * len(grams), pa.string()), pa.array(grams), pa.array(n)], names=["lang", "gram", "n"])

    for rows in batches:
        for lang, text in zip(rows.column(0).to_pylist(), rows.column(1), strict=True):
            found = gram_counts(text.as_py())
            parts.setdefault(lang, []).append(found)
            held[lang] = held.get(lang, 0) + len(found[0])
            if held[lang] > _MERGE:
                parts[lang] = [_merged(parts[lang])]
                held[lang] = len(parts[lang][0][0])
                if held[lang] > _MERGE // 2:
                    yield batch(lang)
                    held[lang] = 0
    for lang in list(parts):
        yield batch(lang)


def train_profiles(docs: DataFrame, places: int = PLACES, lang: str = "lang", text: str = "text") -> dict[str, dict[int, int]]:
    """Language -> n-gram -> rank, from the rows whose text and language are not null.

    All texts are counted; what reaches the driver is ``places`` rows for each language. Equal counts are
    ordered by n-gram.
    """
    rows = docs.select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text")).filter("lang is not null and text is not null")
    counted = rows.mapInArrow(_count_by_language, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    first = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    top = counted.withColumn("place", F.row_number().over(first)).filter(F.col("place") <= places)
    profiles: dict[str, dict[int, int]] = {}
    for r in top.select("lang", "gram", "place").collect():
        profiles.setdefault(r.lang, {})[r.gram] = r.place - 1
    return dict(sorted(profiles.items()))


class Identifier:
    def __init__(self, profiles: dict[str, dict[int, int]]):
        self.langs = list(profiles)
        self.places = max((len(p) for p in profiles.values()), default=0)
        self.grams = np.array(sorted({g for p in profiles.values() for g in p}), dtype=np.int64)
        self.table = np.full((len(self.grams), len(self.langs)), np.nan)
        for j, p in enumerate(profiles.values()):
            self.table[np.searchsorted(self.grams, np.array(list(p), dtype=np.int64)), j] = list(p.values())

    def distances(self, text: str | None) -> np.ndarray | None:
        """Mean distance per language, from 0 to 1; None without letters or profiles."""
        grams, counts = gram_counts(text)
        if not len(grams) or not len(self.grams):
            return None
        order = np.sort(-counts)
        before = np.searchsorted(order, -counts, side="left")
        kept = before < self.places
        grams, counts, before = grams[kept], counts[kept], before[kept]
        after = np.searchsorted(order, -counts, side="right") - 1
        place = np.minimum((before + after) / 2, self.places - 1)
        at = np.minimum(np.searchsorted(self.grams, grams), len(self.grams) - 1)
        ranks = np.where((self.grams[at] == grams)[:, None], self.table[at], np.nan)
        return np.nan_to_num(np.abs(ranks - place[:, None]), nan=self.places).mean(axis=0) / self.places

    def best(self, text: str | None) -> tuple[str, float]:
        found = self.distances(text)
        if found is None:
            return "und", 0.0
        i = int(np.argmin(found))
        return self.langs[i], float(1 / np.exp(-SHARPNESS * (found - found[i])).sum())


def identify(docs: DataFrame, profiles: dict, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, lang_pred, score for every row and whole text.

    ``und`` with score 0 where the text is null, empty or has no letter, and for all rows if there are no
    profiles. Of languages at the same distance the first by name is taken. Null and repeated doc_ids and
    other columns make no difference.
    """

    def run(batches):
        import pyarrow as pa

        model = Identifier(profiles)
        for batch in batches:
            found = [model.best(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())], names=["doc_id", "lang_pred", "score"])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, "doc_id long, lang_pred string, score double")


def held_out(doc_id: str = "doc_id") -> Column:
    return fold(doc_id, 3) == 1


def keep_identified(docs: DataFrame) -> DataFrame:
    """``docs`` without the rows whose language cannot be told (``und``); same columns, nothing shuffled.

    Profiles are learned from the rows with a language outside the held-out third. Without any, nothing
    can be judged and all rows with a letter stay.
    """
    profiles = train_profiles(docs.filter(~held_out()))
    at = docs.columns.index("text")

    def run(batches):
        import pyarrow as pa

        model = Identifier(profiles)
        for batch in batches:
            texts = (t.as_py() for t in batch.column(at))
            keep = [model.best(t)[0] != "und" if profiles else len(gram_counts(t)[0]) > 0 for t in texts]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
