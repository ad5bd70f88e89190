"""Toxicity by class-conditional Kneser-Ney models.

Two character models of order four, one of toxic and one of ordinary text, keep counts of their own in the two
highest orders. What a model has rarely seen it takes from below, and below both use the same Kneser-Ney
counts: the number of distinct characters that precede a shorter n-gram in either class. So a rare expression
says as much as its class evidence and no more; where neither class has seen it, only the trust each puts into
its own counts remains. The score of a text is the difference of its two log-likelihoods for each character, or
the largest for each word over short windows, since a few toxic words drown in the mean of a long text. A logistic
curve makes it a probability on labelled rows that the counts do not hold, and those rows decide which of the
two ranks better, or both.

Words and pairs of words have models of the same kind, which add their log-ratios, so that expressions longer
than four letters, digits and signs count too. All counts are exact and grow with the labelled text. Only letters
beyond U+FFFF share symbols.

Keys are dealt to parts and travel as sorted blocks: a chunk of documents asks each part for its distinct keys once and
gets what is known of them in the same order. Of words and pairs only the counts are kept and sent; a chunk makes the
log-ratios of them. Documents are scored in rounds, whose blocks go before the next begins.
"""

from __future__ import annotations

import contextlib
import functools
import itertools
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landfall.llm.common import _powers, fold, mix, stage
from landfall.llm.langid import _letters, _merged
from landfall.session import Scratch

FOLDS = 5
ORDER = 4
SHARED = 2  # orders up to this have one set of counts for both classes
DISCOUNT = 0.75
SYMBOL_BITS = 16  # a letter below 4096 is its code point, up to U+FFFF it has a symbol of its own
WORDS, AFTER, PAIRS = 0, 1, 2  # kinds of keys; 2 k and 2 k + 1 are the n-grams of order k and their contexts
WINDOWS = (1, 4)  # words; the largest mean ratio over so many in a row tells a few toxic words in a long text
FIT_ROWS = 50_000  # of labelled rows that the curve is fitted to, the first by hash
SLICE_CHARS = 1_000_000
CHUNK_CHARS = 3_000_000  # of documents that look up their n-grams together
PART_CHARS = 16_000_000  # of labelled text, and of documents in a round, for each part of the table, which one task holds
PARTS = 24  # at least
ROUNDS = 4
KINDS = (WORDS, PAIRS, *range(2 * SHARED + 2, 2 * ORDER + 2))  # of what a chunk asks for
WIDTH = {WORDS: 7, PAIRS: 2}  # numbers kept of a key; of an n-gram the ratio
BLOCK = "part int, kind int, n int, keys binary, known binary"
_MERGE = 2_000_000
_SORTED = 1 << 17  # keys that are sorted at once
_TABLES: dict[str, np.ndarray] = {}


@contextlib.contextmanager
def _passing_shuffles(spark: SparkSession):
    """What runs inside leaves no shuffle files behind."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def _staged(df: DataFrame, name: str) -> DataFrame:
    with _passing_shuffles(df.sparkSession):
        return stage(df, name)


def _kept(scratch: Scratch, df: DataFrame, name: str) -> DataFrame:
    with _passing_shuffles(df.sparkSession):
        return scratch.materialize(df, name)


# --- blocks of keys --------------------------------------------------------------------------------


def _pack(numbers: np.ndarray) -> bytes:
    """64-bit numbers, compressed byte by byte of their places: the high bytes of small ones cost nothing."""
    import pyarrow as pa

    planes = np.ascontiguousarray(numbers.view(np.uint8).reshape(-1, 8).T)
    return pa.compress(planes.tobytes(), codec="zstd", asbytes=True) if len(numbers) else b""


def _unpack(block: bytes, n: int) -> np.ndarray:
    import pyarrow as pa

    if n == 0:
        return np.zeros(0, np.uint64)
    planes = np.frombuffer(pa.decompress(block, decompressed_size=8 * n, codec="zstd"), np.uint8)
    return np.ascontiguousarray(planes.reshape(8, n).T).view(np.uint64).ravel()


def _steps(keys: np.ndarray) -> np.ndarray:
    return np.diff(keys, prepend=np.uint64(0))


def _part(kind: int, keys: np.ndarray, parts: int) -> np.ndarray:
    """Part of each key: words and pairs are hashes and keep their order, n-grams are mixed."""
    if kind > PAIRS:
        return (mix(keys) % np.uint64(parts)).astype(np.int64)
    return ((keys >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def _dealt(kind: int, keys: np.ndarray, parts: int) -> list:
    """The places of each part's keys, in their order, among sorted keys."""
    part, order = _part(kind, keys, parts), None
    if kind > PAIRS:  # numbers of 16 bits are sorted without comparing them
        order = np.argsort(part.astype(np.uint16 if parts <= 1 << 16 else np.int64), kind="stable")
        part = part[order]
    cuts = itertools.pairwise(np.searchsorted(part, np.arange(parts + 1)).tolist())
    return [slice(a, b) if order is None else order[a:b] for a, b in cuts]


def _distinct(keys: np.ndarray) -> np.ndarray:
    """The sorted distinct keys. ``np.unique`` hashes them, which takes many times as long as sorting them."""
    ordered = np.sort(keys)
    return ordered[np.concatenate([[True], ordered[1:] != ordered[:-1]])] if len(keys) else ordered


def _summed(keys: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sorted distinct keys, column sums of ``numbers`` for each, a place of each).

    Many keys are dealt by their highest bits first: what fits the cache is sorted and gathered several times as fast.
    """
    if len(keys) > _SORTED:
        top = (keys >> np.uint64(58)).astype(np.uint16)
        order = np.argsort(top, kind="stable")
        cuts = np.searchsorted(top[order], np.arange(65))
        keys, numbers = keys[order], np.stack([n[order] for n in numbers])
        done = [_sorted_sums(keys[a:b], numbers[:, a:b], order[a:b]) for a, b in itertools.pairwise(cuts.tolist())]
        return tuple(np.concatenate(x, axis=-1) for x in zip(*done, strict=True))
    return _sorted_sums(keys, numbers, np.arange(len(keys)))


def _sorted_sums(keys: np.ndarray, numbers: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sorted distinct keys, column sums of ``numbers`` for each, one of the ``places`` of each)."""
    order = np.argsort(keys)
    ordered = keys[order]
    first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])) if len(keys) else order
    sums = np.stack([np.add.reduceat(n[order], first) for n in numbers]) if len(first) else numbers
    return ordered[first], sums, places[order[first]]


def _blocks(rows: list[tuple]):
    """Rows of ``BLOCK`` from (part, kind, keys, numbers of each)."""
    import pyarrow as pa

    columns = zip(*((part, kind, len(keys), _pack(_steps(keys)), _pack(known.ravel())) for part, kind, keys, known in rows), strict=True) if rows else [[]] * 5
    return pa.table([pa.array(c, kind) for c, kind in zip(columns, (pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary()), strict=True)], names=["part", "kind", "n", "keys", "known"])


def _unblocked(rows) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """The (part, kind, keys, numbers of each) of ``BLOCK`` rows."""
    for r in rows.to_pylist():
        width = WIDTH.get(r["kind"], 1)
        yield r["part"], r["kind"], np.cumsum(_unpack(r["keys"], r["n"]), dtype=np.uint64), _unpack(r["known"], width * r["n"]).view(np.int64).reshape(width, -1)


# --- characters ------------------------------------------------------------------------------------


def _symbols() -> np.ndarray:
    """Symbol of each code point: 32 for all that is no letter."""
    if "symbols" not in _TABLES:
        code = np.arange(0x110000, dtype=np.uint64)
        own = np.flatnonzero(_letters()[4096:0x10000]) + 4096
        free = np.uint64(4096 + len(own))
        wide = np.where(code < 4096, code, free + mix(code) % (np.uint64(1 << SYMBOL_BITS) - free))
        wide[own] = 4096 + np.arange(len(own), dtype=np.uint64)
        _TABLES["symbols"] = np.where(_letters(), wide, np.uint64(32)).astype(np.uint16)
    return _TABLES["symbols"]


def _runs(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(begins, ends) of the runs of true values; the first and the last value are false."""
    flips = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    return flips[::2], flips[1::2]


def _ranked(codes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct codes, place of each code among them); codes are below ``size``."""
    if size > 8 * len(codes) + (1 << 22):
        return np.unique(codes, return_inverse=True)
    seen, codes = np.zeros(size, dtype=bool), codes.astype(np.intp)  # else each use as an index converts them
    seen[codes] = True
    own, place = np.flatnonzero(seen), np.empty(size, np.int32)
    place[own] = np.arange(len(own), dtype=np.int32)
    return own, place[codes]


def _joined(left: np.ndarray, right: np.ndarray, size: int) -> np.ndarray:
    """One code of two numbers below ``size``, in 32 bits where they hold it."""
    kind = np.int32 if size**2 < 1 << 31 else np.int64
    return left.astype(kind) * kind(size) + right.astype(kind)


def distinct_grams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct n-grams, place of the one ending at each character, index of its text).

    Runs of other signs than letters are one blank. Two n-grams of half the order make one; each half has a number.
    """
    pad = "\x00" * (ORDER - 1)
    joined = "".join(pad + " " + (t or "").lower().replace("\x00", " ") + " " for t in texts) + pad
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    row = _symbols()[codes]
    row[codes == 0] = 0
    keep, blank = np.ones(len(row), dtype=bool), row == 32
    keep[1:] = ~(blank[1:] & blank[:-1])
    row = row[keep]
    inside = row != 0
    begins, ends = _runs(inside)
    letters, one = _ranked(row, 1 << SYMBOL_BITS)
    halves, two = _ranked(_joined(one[:-1], one[1:], len(letters)), len(letters) ** 2)
    found, at = _ranked(_joined(two[:-2], two[2:], len(halves))[inside[ORDER - 1 :]], len(halves) ** 2)
    half = letters[halves // len(letters)] << np.int64(SYMBOL_BITS) | letters[halves % len(letters)]
    return half[found // len(halves)] << np.int64(2 * SYMBOL_BITS) | half[found % len(halves)], at, np.repeat(np.arange(len(begins)), ends - begins)


def grams_of(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(n-gram ending at each character, index of its text)."""
    grams, at, owner = distinct_grams(texts)
    return grams[at], owner


def _slices(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    at = 0
    while at < len(texts):
        to, chars = at, 0
        while to < len(texts) and (to == at or chars < SLICE_CHARS):
            chars += len(texts[to] or "")
            to += 1
        yield at, to
        at = to


def _count(batches) -> Iterator:
    """(gram, toxic, n) sums of one task."""
    import pyarrow as pa

    parts: dict[int, list] = {0: [], 1: []}
    held = {0: 0, 1: 0}

    def batch(label):
        grams, n = _merged(parts[label])
        parts[label], held[label] = [], 0
        return pa.RecordBatch.from_arrays([pa.array(grams), pa.array([label] * len(grams), pa.int32()), pa.array(n)], names=["gram", "toxic", "n"])

    for rows in batches:
        labels, texts = rows.column(0).to_pylist(), rows.column(1).to_pylist()
        for label in (0, 1):
            own = [t for t, x in zip(texts, labels, strict=True) if x == label]
            for at, to in _slices(own):
                grams, place, _ = distinct_grams(own[at:to])
                parts[label].append((grams, np.bincount(place, minlength=len(grams))))
                held[label] += len(grams)
                if held[label] > _MERGE:
                    yield batch(label)
    for label in (0, 1):
        if parts[label]:
            yield batch(label)


def _suffix(k: int):
    """The last k characters of the n-gram in column ``gram``."""
    return F.col("gram").bitwiseAND(F.lit((1 << SYMBOL_BITS * k) - 1))


def _context():
    return F.shiftrightunsigned("gram", SYMBOL_BITS)


def kneser_ney(labelled: DataFrame, write=_staged) -> dict[int, tuple[DataFrame, DataFrame]]:
    """Order -> (gram, llr, n) and (context, llr) of (toxic, text) rows: log-likelihood of toxic less ordinary.

    The first holds the n-grams seen in either class; the second what an unseen one after a seen context adds
    to the value of the next lower order, 0 from the shared orders on. All counts are sums, combined before
    they are shuffled.
    """
    counted = labelled.select("toxic", "text").mapInArrow(_count, "gram long, toxic int, n long")
    of = lambda label: F.sum(F.when(F.col("toxic") == label, F.col("n")).otherwise(0))
    seen = lambda c: F.sum((F.col(c) > 0).cast("long"))
    levels = {ORDER: write(counted.groupBy("gram").agg(of(1).alias("t"), of(0).alias("o")), f"kn-{ORDER}")}
    for k in range(ORDER - 1, 0, -1):  # one row above is one distinct preceding character
        counts = [seen("t").alias("t"), seen("o").alias("o")] if k > SHARED else [F.count("*").alias("n")]
        levels[k] = write(levels[k + 1].groupBy(_suffix(k).alias("gram")).agg(*counts), f"kn-{k}")

    total = levels[1].agg(F.sum("n")).first()[0] or 1
    share = (F.greatest(F.col("n") - DISCOUNT, F.lit(0.0)) + F.lit(DISCOUNT)) / F.lit(float(total))
    lower = levels[1].select("gram", share.alias("p"))  # what is discounted goes evenly to all characters
    for k in range(2, SHARED + 1):
        contexts = levels[k].groupBy(_context().alias("context")).agg(F.sum("n").alias("all"), F.count("*").alias("types"))
        below = lower.select(F.col("gram").alias("suffix"), F.col("p").alias("q"))
        joined = levels[k].join(contexts, _context() == F.col("context")).join(below, _suffix(k - 1) == F.col("suffix"))
        p = (F.greatest(F.col("n") - DISCOUNT, F.lit(0.0)) + DISCOUNT * F.col("types") * F.col("q")) / F.col("all")
        lower = write(joined.select("gram", p.alias("p")), f"kn-p-{k}")

    lower, out = lower.select("gram", F.col("p").alias("pt"), F.col("p").alias("po")), {}
    trust = lambda types, all_: F.when(F.col(all_) > 0, DISCOUNT * F.col(types) / F.col(all_)).otherwise(1.0)
    own = lambda c, all_: F.when(F.col(all_) > 0, F.greatest(F.col(c) - DISCOUNT, F.lit(0.0)) / F.col(all_)).otherwise(0.0)
    for k in range(SHARED + 1, ORDER + 1):
        sums = [F.sum("t").alias("at"), F.sum("o").alias("ao"), seen("t").alias("tt"), seen("o").alias("to")]
        contexts = write(levels[k].groupBy(_context().alias("context")).agg(*sums), f"kn-contexts-{k}")
        below = lower.select(F.col("gram").alias("suffix"), F.col("pt").alias("qt"), F.col("po").alias("qo"))
        joined = levels[k].join(contexts, _context() == F.col("context")).join(below, _suffix(k - 1) == F.col("suffix"))
        pt, po = own("t", "at") + trust("tt", "at") * F.col("qt"), own("o", "ao") + trust("to", "ao") * F.col("qo")
        lower = write(joined.select("gram", pt.alias("pt"), po.alias("po"), (F.col("t") + F.col("o")).alias("n")), f"kn-p-{k}")
        out[k] = lower.select("gram", F.log(F.col("pt") / F.col("po")).alias("llr"), "n"), contexts.select("context", F.log(trust("tt", "at") / trust("to", "ao")).alias("llr"))
    return out


# --- words -----------------------------------------------------------------------------------------


def _signs() -> np.ndarray:
    """Of each code point: 0 for a sign, 1 for a letter, digit or underscore, 2 for white space, 3 for that which parts words."""
    if "signs" not in _TABLES:
        kinds = np.fromiter((1 if (c := chr(i)).isalnum() or c == "_" else 2 * c.isspace() for i in range(0x110000)), np.int8, 0x110000)
        kinds[[9, 10, 11, 12, 13, 32]] = 3
        _TABLES["signs"] = kinds
    return _TABLES["signs"]


def word_keys(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each lower-cased word without signs at its ends, number of words of each text)."""
    lower = [(t or "").lower() for t in texts]
    codes = np.frombuffer(("\n" + "".join(t + "\n" for t in lower)).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    kinds = _signs()[codes]
    begins, ends = _runs(kinds == 0)
    loose = (kinds[begins - 1] >= 2) | (kinds[ends] >= 2)  # runs of signs beside white space
    step = np.zeros(len(codes), dtype=np.int8)
    begins, ends = begins[loose], ends[loose]
    step[begins] = 1
    step[ends] = -1
    keep = np.cumsum(step, dtype=np.int8) == 0
    starts = np.concatenate([[0], np.cumsum(np.array([len(t) + 1 for t in lower], dtype=np.int64))])
    starts = starts + 1 - np.concatenate([[0], np.cumsum(ends - begins)])[np.searchsorted(begins, starts)]
    codes, solid = codes[keep], kinds[keep] != 3
    begins, ends = _runs(solid)
    up, down = _powers(len(codes))
    total = np.zeros(len(codes) + 1, dtype=np.uint64)
    np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * up[: len(codes)], out=total[1:])
    hashes = mix((total[ends] - total[begins]) * down[begins] + (ends - begins).astype(np.uint64))
    return hashes.view(np.int64), np.diff(np.searchsorted(begins, starts))


def _before(words: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The word before each, 0 before the first of a text."""
    out = np.concatenate([[0], words])[: len(words)].astype(np.int64)
    out[(np.cumsum(counts) - counts)[counts > 0]] = 0
    return out


def _pair(prev, word):
    """One key of two words."""
    return (prev << np.int64(1)) ^ word


def _count_words(batches, parts: int) -> Iterator:
    """Blocks of (pair, word before, word, t, o) sums of one task for each part, handed on whenever too many are held."""
    import pyarrow as pa

    held, some = [], 0

    def summed():
        """prev, word, t, o of the distinct pairs."""
        every = np.concatenate(held, axis=1)
        _, n, at = _summed(_pair(every[0], every[1]).view(np.uint64), every[2:])
        return np.stack([every[0][at], every[1][at], *n])

    def blocks(rows):
        cuts = np.searchsorted(_part(PAIRS, _pair(rows[0], rows[1]).view(np.uint64), parts), np.arange(parts + 1))  # pairs are in order
        own = [(p, rows[:, cuts[p] : cuts[p + 1]]) for p in range(parts) if cuts[p] < cuts[p + 1]]
        own = [(p, r[:, np.argsort(r[0])]) for p, r in own]
        packed = [_pack(np.concatenate([np.diff(r[0], prepend=np.int64(0)), *r[1:]])) for _, r in own]
        return pa.RecordBatch.from_arrays([pa.array([p for p, _ in own], pa.int32()), pa.array([r.shape[1] for _, r in own], pa.int32()), pa.array(packed, pa.binary())], names=["part", "n", "pairs"])

    for batch in batches:
        labels, texts = batch.column(0).to_numpy(), batch.column(1).to_pylist()
        for at, to in _slices(texts):
            words, counts = word_keys(texts[at:to])
            toxic = np.repeat(labels[at:to], counts).astype(np.int64)
            held.append(np.stack([_before(words, counts), words, toxic, 1 - toxic]))
            some += len(words)
            if some > _MERGE:
                held = [summed()]
                some = held[0].shape[1]
                if some > _MERGE // 2:
                    yield blocks(held[0])
                    held, some = [], 0
    if some:
        yield blocks(summed())


def _merge_pairs(table, parts: int):
    """Of all blocks of one part: its pairs, and for each part what they say of words.

    t, o and n of a word are the distinct words before it in toxic, ordinary and any text; at, ao, tt, to are the pairs
    that it begins in toxic and ordinary text, all and distinct.
    """
    every = []
    for n, block in zip(table.column("n").to_pylist(), table.column("pairs").to_pylist(), strict=True):
        rows = _unpack(block, 4 * n).view(np.int64).reshape(4, n)
        every.append(np.concatenate([np.cumsum(rows[:1], axis=1), rows[1:]]))
    every = np.concatenate(every, axis=1)
    pairs, n, at = _summed(_pair(every[0], every[1]).view(np.uint64), every[2:])
    seen = (n > 0).astype(np.int64)
    after, of_after, _ = _summed(every[1][at].view(np.uint64), np.stack([*seen, np.ones_like(n[0])]))
    before, of_before, _ = _summed(every[0][at].view(np.uint64), np.concatenate([n, seen]))
    words = _distinct(np.concatenate([after, before]))
    said = np.zeros((WIDTH[WORDS], len(words)), dtype=np.int64)
    said[:3, np.searchsorted(words, after)] = of_after
    said[3:, np.searchsorted(words, before)] = of_before
    to = _dealt(WORDS, words, parts)
    return _blocks([(table.column("part")[0].as_py(), PAIRS, pairs, n), *((p, WORDS, words[o], said[:, o]) for p, o in enumerate(to) if o.start < o.stop)])


def _merge_words(table):
    """The sums of all blocks of one part."""
    blocks = list(_unblocked(table))
    words, said, _ = _summed(np.concatenate([b[2] for b in blocks]), np.concatenate([b[3] for b in blocks], axis=1))
    return _blocks([(blocks[0][0], WORDS, words, said)])


def _word_sums(batches) -> Iterator:
    """at, ao, tt, to, an of the words of each block: as of a word before all of them."""
    import pyarrow as pa

    for b in batches:
        sums = [[*n[:2].sum(axis=1), *(n[:2] > 0).sum(axis=1), n[2].sum()] for _, _, _, n in _unblocked(b)]
        yield pa.RecordBatch.from_arrays([pa.array([int(s[i]) for s in sums], pa.int64()) for i in range(5)], names=["at", "ao", "tt", "to", "an"])


def _own(n: np.ndarray, all_: np.ndarray) -> np.ndarray:
    return np.where(all_ > 0, np.maximum(n - DISCOUNT, 0) / np.maximum(all_, 1), 0.0)


def _trust(types: np.ndarray, all_: np.ndarray) -> np.ndarray:
    return np.where(all_ > 0, DISCOUNT * types / np.maximum(all_, 1), 1.0)


def parted_table(scratch: Scratch, labelled: DataFrame, parts: int) -> tuple[DataFrame, tuple[int, ...]]:
    """(``BLOCK`` rows, sums of words): every n-gram, context, word and pair that (toxic, text) rows hold, a block of each kind and part."""
    pairs = labelled.select("toxic", "text").mapInArrow(lambda it: _count_words(it, parts), "part int, n int, pairs binary")
    merged = _kept(scratch, pairs.groupBy("part").applyInArrow(lambda t: _merge_pairs(t, parts), BLOCK), "pairs")
    words = _kept(scratch, merged.filter(F.col("kind") == WORDS).groupBy("part").applyInArrow(_merge_words, BLOCK), "words")
    sums = words.mapInArrow(_word_sums, "at long, ao long, tt long, to long, an long").agg(*[F.sum(c).alias(c) for c in ("at", "ao", "tt", "to", "an")]).first()
    rows = []
    for k, (grams, contexts) in kneser_ney(labelled, functools.partial(_kept, scratch)).items():
        rows += [grams.select(F.lit(2 * k).alias("kind"), F.col("gram").alias("key"), "llr"), contexts.select(F.lit(2 * k + 1).alias("kind"), F.col("context").alias("key"), "llr")]

    def placed(batches):
        import pyarrow as pa

        for b in batches:
            part = _part(2 * ORDER, b.column(1).to_numpy().view(np.uint64), parts).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(part), *b.columns], names=["part", "kind", "key", "llr"])

    def blocked(t):
        kinds, keys, llr = t.column("kind").to_numpy(), t.column("key").to_numpy().view(np.uint64), t.column("llr").to_numpy()
        each = []
        for kind in np.unique(kinds):
            own = np.flatnonzero(kinds == kind)
            own = own[np.argsort(keys[own])]
            each.append((t.column("part")[0].as_py(), int(kind), keys[own], llr[own].view(np.int64)))
        return _blocks(each)

    chars = functools.reduce(DataFrame.union, rows).mapInArrow(placed, "part int, kind int, key long, llr double").groupBy("part").applyInArrow(blocked, BLOCK)
    chars = _kept(scratch, chars, "chars")
    return chars.union(words).union(merged.filter(F.col("kind") == PAIRS)), tuple(s or 0 for s in sums)


def score_table(labelled: DataFrame, parts: int = PARTS) -> DataFrame:
    """(kind, key, llr, n): every n-gram, context, word and pair that the labelled rows hold, each under its own key.

    N-grams and contexts have their log-ratio, words, what follows them and pairs their counts, as the blocks have them.
    """

    def rows(batches):
        import pyarrow as pa

        for b in batches:
            for _, kind, keys, known in _unblocked(b):
                for to, some in [(WORDS, slice(0, 3)), (AFTER, slice(3, 7))] if kind == WORDS else [(kind, slice(0, None))]:
                    own = known[some].any(axis=0) if kind in WIDTH else np.ones(len(keys), dtype=bool)
                    llr, n = (None, known[some, own].T.tolist()) if kind in WIDTH else (known[0].view(np.float64), None)
                    size = int(own.sum())
                    columns = [pa.array(np.full(size, to, np.int32)), pa.array(keys[own].view(np.int64)), pa.nulls(size, pa.float64()) if llr is None else pa.array(llr), pa.array(n if n is not None else [None] * size, pa.list_(pa.int64()))]
                    yield pa.RecordBatch.from_arrays(columns, names=["kind", "key", "llr", "n"])

    with Scratch(labelled.sparkSession) as scratch:
        return _staged(parted_table(scratch, labelled, parts)[0].mapInArrow(rows, "kind int, key long, llr double, n array<long>"), "toxic-table")


# --- scoring ---------------------------------------------------------------------------------------


def _lookups(texts: list[str | None]):
    """Kind -> keys of one slice, for each distinct n-gram or each word; n-gram of each character; text of it; words of each text."""
    grams, at, owner = distinct_grams(texts)
    keys = {}
    for k in range(SHARED + 1, ORDER + 1):
        keys[2 * k] = grams & np.int64((1 << SYMBOL_BITS * k) - 1) if k < ORDER else grams
        keys[2 * k + 1] = grams >> np.int64(SYMBOL_BITS) & np.int64((1 << SYMBOL_BITS * (k - 1)) - 1)
    words, counts = word_keys(texts)
    keys |= {WORDS: words, PAIRS: _pair(_before(words, counts), words)}
    return keys, at, owner, counts


def _keys(slices: list, kind: int) -> np.ndarray:
    """Keys of a kind of a chunk's slices; no word stands for the one before the first."""
    return np.concatenate([np.zeros(int(kind == WORDS), np.int64), *(s[0][kind] for s in slices)]).view(np.uint64)


def _wanted(slices: list) -> dict[int, np.ndarray]:
    """Kind -> sorted distinct keys of a chunk's slices."""
    return {kind: _distinct(_keys(slices, kind)) for kind in KINDS}


def _chunked(batches, names: list[str]):
    """(chunk, docs): consecutive rows of one task, of about ``CHUNK_CHARS`` characters, as one compressed Arrow stream."""
    import pyarrow as pa
    import pyarrow.compute as pc
    from pyspark import TaskContext

    chunk, chars, held = TaskContext.get().partitionId() << 32, 0, []

    def packed():
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, held[0].schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", 3))) as out:
            out.write_table(pa.Table.from_batches(held).combine_chunks())
        return pa.RecordBatch.from_arrays([pa.array([chunk], pa.int64()), pa.array([sink.getvalue().to_pybytes()], pa.binary())], names=["chunk", "docs"])

    for b in batches:
        at = 0
        for i, n in enumerate(pc.fill_null(pc.utf8_length(b.column(len(names))), 0).to_pylist()):
            if chars > CHUNK_CHARS:
                held.append(b.slice(at, i - at))
                yield packed()
                chunk, chars, held, at = chunk + 1, 0, [], i
            chars += n
        held.append(b.slice(at))
    if held:
        yield packed()


def _docs(block: bytes):
    import pyarrow as pa

    return pa.ipc.open_stream(block).read_all()


def _asked(batches, names: list[str], parts: int):
    """(part, chunk, n, keys): the distinct keys that each chunk has in a part, ``n`` of each kind."""
    import pyarrow as pa

    for b in batches:
        for chunk, block in zip(b.column(0).to_pylist(), b.column(1), strict=True):
            texts = _docs(block.as_py()).column(len(names)).to_pylist()
            wanted = _wanted([_lookups(texts[i:j]) for i, j in _slices(texts)])
            dealt = {kind: _dealt(kind, keys, parts) for kind, keys in wanted.items()}
            rows = []
            for p in range(parts):
                own = [keys[dealt[kind][p]] for kind, keys in wanted.items()]
                if any(len(k) for k in own):
                    rows.append((p, [len(k) for k in own], _pack(np.concatenate([_steps(k) for k in own]))))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int32()), pa.array([chunk] * len(rows), pa.int64()), pa.array([r[1] for r in rows], pa.list_(pa.int32())), pa.array([r[2] for r in rows], pa.binary())],
                names=["part", "chunk", "n", "keys"],
            )


def _answered(asked, table):
    """(chunk, part, n, known) for each row of ``asked``: what the part's blocks have of its keys, in their order."""
    import pyarrow as pa

    held = {kind: (keys, known) for _, kind, keys, known in _unblocked(table)}
    out = []
    for r in asked.to_pylist():
        steps, at, known = _unpack(r["keys"], sum(r["n"])), 0, []
        for kind, n in zip(KINDS, r["n"], strict=True):
            keys = np.cumsum(steps[at : at + n], dtype=np.uint64)
            at += n
            found = np.zeros((WIDTH.get(kind, 1), n), dtype=np.int64)
            if kind not in WIDTH:
                found.view(np.float64)[:] = np.nan
            if kind in held:
                own, numbers = held[kind]
                place = np.minimum(np.searchsorted(own, keys), len(own) - 1)
                hit = np.flatnonzero(own[place] == keys)
                found[:, hit] = numbers[:, place[hit]]
            known.append(found.ravel())
        out.append((r["chunk"], r["part"], r["n"], _pack(np.concatenate(known))))
    kinds = (pa.int64(), pa.int32(), pa.list_(pa.int32()), pa.binary())
    return pa.table([pa.array(c, k) for c, k in zip(zip(*out, strict=True) if out else [[]] * 4, kinds, strict=True)], names=["chunk", "part", "n", "known"])


def _gathered(wanted: dict[int, np.ndarray], answers, parts: int) -> dict[int, np.ndarray]:
    """Kind -> numbers of each wanted key, from the answers of all parts."""
    known = {kind: np.empty((WIDTH.get(kind, 1), len(keys)), dtype=np.int64) for kind, keys in wanted.items()}
    dealt = {kind: _dealt(kind, keys, parts) for kind, keys in wanted.items()}
    if answers.column("n").combine_chunks().flatten().to_numpy().sum() != sum(map(len, wanted.values())):
        raise ValueError("a chunk has one answer for each of its keys")
    for r in answers.to_pylist():
        widths = [WIDTH.get(kind, 1) for kind in KINDS]
        numbers, at = _unpack(r["known"], sum(w * n for w, n in zip(widths, r["n"], strict=True))).view(np.int64), 0
        for kind, w, n in zip(KINDS, widths, r["n"], strict=True):
            known[kind][:, dealt[kind][r["part"]]] = numbers[at : at + w * n].reshape(w, n)
            at += w * n
    return known


def _peaks(values: np.ndarray, counts: np.ndarray, width: int) -> np.ndarray:
    """Largest mean over ``width`` consecutive values of each text; a shorter text is filled up with zeros."""
    ends = np.cumsum(counts)
    begins = ends - counts
    total = np.concatenate([[0.0], np.cumsum(values)])
    out = total[ends] - total[begins]
    long = np.flatnonzero(counts > width)
    if len(long):
        sums = np.append(total[width:] - total[:-width], -np.inf)
        cuts = np.stack([begins[long], ends[long] - width + 1], axis=1)
        out[long] = np.maximum.reduceat(sums, cuts.ravel())[::2]
    return out / width


def _scored(texts: list[str | None], answers, parts: int, sums: tuple[int, ...]) -> np.ndarray:
    """Log-likelihood of toxic less ordinary text: for each character, and at most for each word in ``WINDOWS`` consecutive ones.

    One row for each text.
    """
    slices = [(i, j, _lookups(texts[i:j])) for i, j in _slices(texts)]
    placed = {kind: np.unique(_keys([found for *_, found in slices], kind), return_inverse=True) for kind in KINDS}
    known = _gathered({kind: own for kind, (own, _) in placed.items()}, answers, parts)
    place = {kind: at for kind, (_, at) in placed.items()}  # of each key of all slices
    t, o, n, at, ao, tt, to = known[WORDS]
    q = n / max(1.0, float(sums[4]))
    qt, qo = (_own(c, all_) + _trust(types, all_) * q for c, all_, types in ((t, np.int64(sums[0]), sums[2]), (o, np.int64(sums[1]), sums[3])))
    trust_t, trust_o = _trust(tt, at), _trust(to, ao)
    alone = np.log(np.where(n > 0, qt, 1.0) / np.where(n > 0, qo, 1.0))
    after = np.log(np.where(at + ao > 0, trust_t / trust_o, 1.0))
    out, first_gram, first_word = [np.zeros((0, 1 + len(WINDOWS)))], 0, 0
    for i, j, (keys, gram, owner, counts) in slices:
        llr, rest = np.zeros(len(keys[2 * ORDER])), np.arange(len(keys[2 * ORDER]))
        for k in range(ORDER, SHARED, -1):
            of = lambda kind: known[kind][0].view(np.float64)[place[kind][first_gram + rest]]  # noqa: B023, E731
            value = of(2 * k)
            missing = np.isnan(value)
            llr[rest] += np.where(missing, np.nan_to_num(of(2 * k + 1)), value)
            rest = rest[missing]
        own = slice(first_word, first_word + len(keys[WORDS]))
        first_gram, first_word = first_gram + len(llr), own.stop
        word = place[WORDS][1:][own]  # the first is of no word
        prev = np.concatenate([[0], word])[: len(word)]
        prev[(np.cumsum(counts) - counts)[counts > 0]] = 0  # of no word, the smallest key
        pt, po = (n[place[PAIRS][own]] for n in known[PAIRS])
        both = np.flatnonzero(pt + po > 0)
        value = alone[word] + after[prev]
        w, p = word[both], prev[both]
        value[both] = np.log((_own(pt[both], at[p]) + trust_t[p] * qt[w]) / (_own(po[both], ao[p]) + trust_o[p] * qo[w]))
        word_owner = np.repeat(np.arange(j - i), counts)
        total = np.bincount(owner, weights=llr[gram], minlength=j - i) + np.bincount(word_owner, weights=value, minlength=j - i)
        out.append(np.stack([total / np.maximum(1, np.bincount(owner, minlength=j - i)), *(_peaks(alone[word], counts, width) for width in WINDOWS)], axis=1))
    return np.concatenate(out)


def mean_ratios(docs: DataFrame, table: DataFrame, sums: tuple[int, ...], parts: int, keep: str = "doc_id long", rounds: int = 1) -> DataFrame:
    """``keep`` columns and ``x``, the ratios of ``_scored``: for each character, and at most for a word of each window.

    Chunks of documents ask the table for their distinct keys, so a frequent n-gram travels once for a chunk,
    and no task holds more of the table than a part of it or what its chunk's texts need. Each round does so for a share of the documents.
    """
    import pyarrow as pa

    names = [c.split()[0] for c in keep.split(",")]
    kinds = [{"long": pa.int64(), "int": pa.int32()}[c.split()[1]] for c in keep.split(",")]

    def run(rows, answers):
        docs = _docs(rows.column("docs")[0].as_py())
        x = _scored(docs.column("text").to_pylist(), answers, parts, sums)
        return pa.table({**{n: docs.column(n).cast(kind) for n, kind in zip(names, kinds, strict=True)}, "x": pa.array(list(x), pa.list_(pa.float64()))})

    out = []
    for r in range(rounds):
        with Scratch(docs.sparkSession) as scratch:
            share = docs.select(*names, "text").filter(F.pmod(F.xxhash64(*names, "text"), F.lit(rounds)) == r)
            rows = _kept(scratch, share.mapInArrow(lambda it: _chunked(it, names), "chunk long, docs binary"), "chunks")
            asked = rows.mapInArrow(lambda it: _asked(it, names, parts), "part int, chunk long, n array<int>, keys binary")
            answers = asked.groupBy("part").cogroup(table.groupBy("part")).applyInArrow(_answered, "chunk long, part int, n array<int>, known binary")
            answers = _kept(scratch, answers, "answers")
            scored = rows.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(run, f"{keep}, x array<double>")
            out.append(_staged(scored, "toxic-ratios"))
    return functools.reduce(DataFrame.union, out)


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[list[float], float]:
    """Weights and intercept of a slightly damped logistic curve over the columns of ``x``."""
    scale = np.maximum(1e-9, x.std(axis=0))
    design, beta = np.concatenate([x / scale, np.ones((len(x), 1))], axis=1), np.zeros(x.shape[1] + 1)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        gradient = design.T @ (y - p) / len(y) - 1e-3 * beta * ([1] * x.shape[1] + [0])
        hessian = (design * (p * (1 - p))[:, None]).T @ design / len(y) + np.diag([1e-3] * x.shape[1] + [1e-9])
        beta = beta + np.clip(np.linalg.solve(hessian, gradient), -2, 2)
    return [float(b) for b in beta[:-1] / scale], float(beta[-1])


def _area(score: np.ndarray, y: np.ndarray) -> float:
    """Share of pairs of a toxic and an ordinary row that the score puts in order; ties count half."""
    _, at, n = np.unique(score, return_inverse=True, return_counts=True)
    rank = (np.cumsum(n) - (n - 1) / 2)[at]
    toxic = y.sum()
    return float((rank[y == 1].sum() - toxic * (toxic + 1) / 2) / max(1.0, toxic * (len(y) - toxic)))


def _curve(x: np.ndarray, y: np.ndarray) -> tuple[list[float], float]:
    """The curve over the mean, over the peaks, or over both that ranks the rows best; a tie goes to the first."""
    best = None
    for columns in ([0], list(range(1, x.shape[1])), list(range(x.shape[1]))):
        weights, intercept = _logistic(x[:, columns], y)
        area = _area(x[:, columns] @ np.array(weights), y)
        if best is None or area > best[0]:
            best = area, dict(zip(columns, weights, strict=True)), intercept
    return [best[1].get(k, 0.0) for k in range(x.shape[1])], best[2]


def toxicity_scores(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted.

    Labels are learned from rows whose fold (crc32 of doc_id as text, modulo 5) is not 0: folds 1 to 3 give
    the counts, fold 4 the curve that makes a score of a mean ratio. A doc_id labelled more than once is
    toxic if any label says so; null labels and ids teach nothing. A text without letters, null included, has
    the score of ratio 0. If a class has no rows, every score is the share of toxic labels. Repeated rows
    have equal scores. Other columns are ignored.
    """
    base = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    part = fold("doc_id", FOLDS)
    marks = labels.filter("doc_id is not null and toxic in (0, 1)").groupBy(F.col("doc_id").cast("long").alias("id")).agg(F.max("toxic").cast("int").alias("toxic"))
    taught = base.withColumn("part", part).filter("part > 0").join(marks.hint("merge"), F.col("doc_id") == F.col("id")).select("toxic", "part", "text")
    with Scratch(docs.sparkSession) as scratch:
        taught = _kept(scratch, taught, "taught")
        last = F.col("part") == FOLDS - 1
        seen = taught.groupBy(last.alias("last"), "toxic").agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("chars")).collect()
        found, checks = ({r.toxic: r.n for r in seen if r["last"] == which} for which in (False, True))
        if len(found) < 2 or len(checks) < 2:
            toxic, all_ = sum(d.get(1, 0) for d in (found, checks)), sum(sum(d.values()) for d in (found, checks))
            score = F.lit(toxic / all_ if all_ else 0.0)
            return base.select("doc_id", (part == 0).alias("held_out"), score.alias("score"), (score >= 0.5).cast("int").alias("predicted"))
        chars = base.agg(F.sum(F.length("text"))).first()[0] or 0
        parts = max(PARTS, sum(r.chars or 0 for r in seen if not r["last"]) // PART_CHARS + 1, chars // (ROUNDS * PART_CHARS) + 1)
        table, sums = parted_table(scratch, taught.filter(~last), parts)
        graded = mean_ratios(taught.filter(last).withColumn("place", F.xxhash64("text", "toxic")), table, sums, parts, "toxic int, place long")
        fitted = graded.orderBy("place").limit(FIT_ROWS).select("x", "toxic").collect()
        weights, intercept = _curve(np.array([r.x for r in fitted]), np.array([r.toxic for r in fitted], dtype=float))
        scored = mean_ratios(base, table, sums, parts, rounds=ROUNDS)
    odds = functools.reduce(lambda a, b: a + b, [F.get("x", F.lit(k)) * w for k, w in enumerate(weights)]) + intercept
    score = 1 / (1 + F.exp(-odds))
    return scored.select("doc_id", (part == 0).alias("held_out"), score.alias("score"), (score >= 0.5).cast("int").alias("predicted"), F.get("x", F.lit(0)).alias("mean_log_ratio"), F.get("x", F.lit(1)).alias("peak_log_ratio"))
