"""Passages that repeat across documents, by sparse suffix arrays.

Only suffixes that begin at minimisers are kept: of every ``WINDOW`` consecutive positions, the one whose
next ``SEED`` words hash least. The choice depends on the words alone, so a passage of
``WINDOW + SEED - 1`` words has the same suffixes wherever it stands. Suffixes whose seed occurs once are
dropped. Those whose seed has no more suffixes than ``NEIGHBOURS`` reach are sorted by the words to the right,
then those to the left, and compared with each other. Each match is extended to the right by the common prefix
and to the left by the common words before it, and counts if both together reach the length asked for. Around
suffixes with a more frequent seed nothing is compared: every window of the length asked for belongs to the
minimiser of its first run, and is hashed and looked up among all windows. So no passage is missed.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from landfall.llm.common import _powers, mix, shingles, stage, text_slices, word_hashes

LEAST = 50  # words of a passage
SEED = 8
WINDOW = 32  # one of so many positions at least is kept; SEED + WINDOW - 1 must not exceed LEAST
WIDTH = 3  # bytes of a word in a suffix
NEIGHBOURS = 3  # suffixes before each with which it is compared; a seed with more than these and itself has its windows hashed
ROWS = 500_000  # windows in a batch


def chosen(hashes: np.ndarray, window: int) -> np.ndarray:
    """For each run of ``window`` positions, by its first: the last least one. Ascending."""
    views = np.lib.stride_tricks.sliding_window_view(hashes, window)
    return np.arange(len(views)) + window - 1 - views[:, ::-1].argmin(axis=1)


def window_hashes(words: np.ndarray, starts: np.ndarray, least: int) -> np.ndarray:
    """Hashes of the ``least`` words from each start."""
    up, down = _powers(len(words))
    total = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(words * up[: len(words)], out=total[1:])
    return mix((total[starts + least] - total[starts]) * down[starts])


def minimisers(hashes: np.ndarray, window: int) -> np.ndarray:
    """Positions that are the last least one in some run of ``window`` positions; all of a shorter run's least."""
    n = len(hashes)
    if n == 0:
        return np.zeros(0, np.int64)
    if n <= window:
        return np.array([n - 1 - int(np.argmin(hashes[::-1]))])
    return np.unique(chosen(hashes, window))


def _documents(texts) -> Iterator[np.ndarray]:
    """The word hashes of each text."""
    for at, to, data, offsets in text_slices(texts):
        hashes, counts = word_hashes(data, offsets)
        ends = np.cumsum(counts)
        for k in range(to - at):
            yield hashes[ends[k] - counts[k] : ends[k]]


def _seeds(batches, seed: int, window: int, least: int):
    """(doc_id, position, seed) of every minimiser."""
    import pyarrow as pa

    for b in batches:
        docs, places, keys = [], [], []
        for i, words in enumerate(_documents(b.column(1))):
            if len(words) < least:
                continue
            grams, _ = shingles(words, np.array([len(words)]), seed)
            at = minimisers(grams, window)
            docs.append(np.full(len(at), i))
            places.append(at)
            keys.append(grams[at].view(np.int64))
        join = lambda parts: np.concatenate([np.zeros(0, np.int64), *parts])
        yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(join(docs))), pa.array(join(places).astype(np.int32)), pa.array(join(keys))], names=["doc_id", "place", "seed"])


def _suffixes(batches, seed: int, window: int, least: int):
    """(seed, right, left, doc_id, place) of the marked positions; each word is ``WIDTH`` bytes of its hash.

    A mark is twice the place, plus 1 if its seed is frequent. For these there is one row for each window of
    ``least`` words whose first run has its minimiser there: the hash as seed, the start as place, and nulls.
    """
    import pyarrow as pa

    names = ["seed", "right", "left", "doc_id", "place"]
    kinds = [pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int32()]

    def windows(docs, starts, keys):
        starts, keys = np.concatenate(starts), np.concatenate(keys)
        none = pa.nulls(len(keys), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), none, none, pa.array(np.repeat(*np.array(docs).T), pa.int64()), pa.array(starts.astype(np.int32))], names=names)

    for b in batches:
        out, held, docs, starts, keys = [], 0, [], [], []
        for doc_id, marks, words in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), _documents(b.column(1)), strict=True):
            if len(words) < least:  # a row that repeats a doc_id may be shorter or have other minimisers
                continue
            grams, _ = shingles(words, np.array([len(words)]), seed)
            first = chosen(grams, window)
            marks = np.array(marks, dtype=np.int64)
            short = words.view(np.uint8).reshape(-1, 8)[:, :WIDTH]
            cold = marks[marks % 2 == 0] // 2
            for at in cold[np.isin(cold, first)].tolist():
                key = int(grams[at : at + 1].view(np.int64)[0])
                out.append((key, short[at : at + least].tobytes(), short[max(0, at - window) : at][::-1].tobytes(), doc_id, at))
            at = np.flatnonzero(np.isin(first[: len(words) - least + 1], marks[marks % 2 == 1] // 2))
            if len(at):
                docs.append((doc_id, len(at)))
                starts.append(at)
                keys.append(window_hashes(words, at, least))
                held += len(at)
            if held > ROWS:
                yield windows(docs, starts, keys)
                held, docs, starts, keys = 0, [], [], []
        if held:
            yield windows(docs, starts, keys)
        columns = list(zip(*out, strict=True)) if out else [[]] * 5
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names)


def common_words(a: bytes, b: bytes) -> int:
    """Words that two rows of words have in common from their start."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n // WIDTH
    low, high = 0, n // WIDTH
    while high - low > 1:
        middle = (low + high) // 2
        low, high = (middle, high) if a[: WIDTH * middle] == b[: WIDTH * middle] else (low, middle)
    return low


def _matches(rows: Iterator[tuple], neighbours: int, least: int, across: bool) -> Iterator[tuple]:
    """(doc_id, start, end) for each suffix that shares a long enough passage with one of its neighbours."""
    recent: list[tuple] = []
    for row in rows:
        seed, right, left, doc_id, place = row
        if recent and recent[0][0] != seed:
            recent = []
        for other in recent:
            if across and other[3] == doc_id:
                continue
            r, l = common_words(right, other[1]), common_words(left, other[2])  # noqa: E741
            if r + l >= least:
                yield doc_id, place - l, place + r
                yield other[3], other[4] - l, other[4] + r
        recent = [row, *recent[: neighbours - 1]]


def _compare(batches, neighbours: int, least: int, across: bool):
    """Matches inside a partition of sorted suffixes that holds every suffix of its seeds."""
    import pyarrow as pa

    names, kinds = ["doc_id", "start", "end"], [pa.int64(), pa.int64(), pa.int64()]
    rows = (row for b in batches for row in zip(*(c.to_pylist() for c in b.columns), strict=True))
    found = _matches(rows, neighbours, least, across)
    while out := list(itertools.islice(found, 10_000)):
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names=names)


def repeated_passages(docs: DataFrame, least: int = LEAST, seed: int = SEED, window: int = WINDOW, neighbours: int = NEIGHBOURS, across: bool = True, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, start, end, n_words of each passage of at least ``least`` words that stands in another document too.

    Places are counted in words from 0, ends are exclusive; spans that touch or overlap are one. With
    ``across`` off, repetition inside one document counts as well. Null and short texts have no passages;
    rows with a null doc_id are left out; rows that repeat a doc_id count as one document. Other columns are
    ignored. Every such passage is found, however many documents share it or a part of it.
    """
    if seed + window - 1 > least:
        raise ValueError("seed and window are too long for such short passages")
    base = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).filter("doc_id is not null")
    seeds = stage(base.mapInArrow(lambda it: _seeds(it, seed, window, least), "doc_id long, place int, seed long"), "repeat-seeds")
    often = seeds.groupBy("seed").agg(F.count("*").alias("n"), F.min("doc_id").alias("a"), F.max("doc_id").alias("b"))
    hot = (F.col("n") > neighbours + 1).cast("long")
    often = stage(often.filter("a != b" if across else "n > 1").select(F.col("seed").alias("often"), hot.alias("hot")), "repeat-often")
    mark = F.col("place").cast("long") * 2 + F.col("hot")
    marks = seeds.join(often, F.col("seed") == F.col("often")).groupBy("doc_id").agg(F.sort_array(F.collect_set(mark)).alias("marks"))
    marks = stage(marks.withColumnRenamed("doc_id", "marked"), "repeat-marks")
    marked = base.join(marks.hint("merge"), F.col("doc_id") == F.col("marked")).select("doc_id", "text", "marks")
    made = marked.mapInArrow(lambda it: _suffixes(it, seed, window, least), "seed long, right binary, left binary, doc_id long, place int")
    suffixes = stage(made, "repeat-suffixes")
    windows = suffixes.filter("right is null").select("seed", "doc_id", F.col("place").cast("long").alias("start"))
    shared = windows.groupBy("seed").agg(F.count("*").alias("n"), F.min("doc_id").alias("a"), F.max("doc_id").alias("b"))
    shared = stage(shared.filter("a != b" if across else "n > 1").select(F.col("seed").alias("shared")), "repeat-windows")
    windows = windows.join(shared.hint("merge"), F.col("seed") == F.col("shared")).select("doc_id", "start", (F.col("start") + least).alias("end"))
    # a seed has at most neighbours + 1 rows here, so all of it can be in one partition and no pair lies across two
    order = ["seed", "right", "left", "doc_id", "place"]
    compared = suffixes.filter("right is not null").repartition("seed").sortWithinPartitions(*order).select(*order)
    found = compared.mapInArrow(lambda it: _compare(it, neighbours, least, across), "doc_id long, start long, end long")
    spans = found.union(windows)
    place = Window.partitionBy("doc_id").orderBy("start", "end")
    reach = F.max("end").over(place.rowsBetween(Window.unboundedPreceding, -1))
    begun = spans.withColumn("new", (reach.isNull() | (F.col("start") > reach)).cast("int"))
    numbered = begun.withColumn("run", F.sum("new").over(place.rowsBetween(Window.unboundedPreceding, 0)))
    out = numbered.groupBy("doc_id", "run").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    return out.select("doc_id", "start", "end", (F.col("end") - F.col("start")).alias("n_words"))
