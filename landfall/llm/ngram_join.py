"""Self-join of documents on the Jaccard similarity of their word n-grams, by MinHash banding.

1. One pass makes a MinHash signature of each n-gram set; its bands are hashed. The numbers of bands and of
   rows in a band follow from the similarity and the recall asked for.
2. Documents with equal n-gram sets form one class; from here on a class stands for its copies.
3. Band hashes are shuffled. Each bucket links its classes to its least one; components of these links are
   the candidate groups, outside of which no two classes share a bucket.
   Texts are joined to the members by a merge join at every size, so nothing that grows is broadcast.
4. Within a group all pairs are verified on full n-gram sets. A large group is cut into chunks, and each pair
   of chunks is one unit of work, so no task holds a group. A unit returns one row per class, with its
   number of links and the least class it is connected to; pairs are never written out.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landfall.llm.common import mix, shingles, stage, text_slices, word_hashes
from landfall.llm.components import components

WORDS = 5
SIMILARITY = 0.8
RECALL = 0.999
MOST_HASHES = 320
CHUNK_DOCS = 512  # documents and n-grams of a chunk of a large group, on average
CHUNK_NGRAMS = 1_000_000


def choose_bands(similarity: float = SIMILARITY, recall: float = RECALL, most: int = MOST_HASHES) -> tuple[int, int]:
    """(bands, rows): the longest rows, so the fewest false candidates, that reach the recall with ``most`` hashes."""
    best = None
    for rows in range(1, 33):
        bands = max(1, int(np.ceil(np.log(1 - recall) / np.log1p(-(similarity**rows))))) if similarity < 1 else 1
        if bands * rows <= most:
            best = (bands, rows)
    if best is None:
        raise ValueError("no band count reaches this recall with so few hashes")
    return best


def _permutations(n: int) -> tuple[np.ndarray, np.ndarray]:
    seed = mix(np.arange(1, 2 * n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return (seed[:n] >> np.uint64(32)).astype(np.uint32) | np.uint32(1), (seed[n:] >> np.uint64(32)).astype(np.uint32)


def ngram_sets(texts, width: int = WORDS):
    """Sorted distinct n-gram hashes of each text of an Arrow string array."""
    for at, to, data, offsets in text_slices(texts):
        hashes, counts = word_hashes(data, offsets)
        grams, each = shingles(hashes, counts, width)
        ends = np.cumsum(each)
        for k in range(to - at):
            yield np.unique(grams[ends[k] - each[k] : ends[k]])


def _signatures(batches, bands: int, rows: int, width: int):
    import pyarrow as pa

    a, b = _permutations(bands * rows)
    number = np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    for batch in batches:
        out = []
        for grams in ngram_sets(batch.column(1), width):
            n = len(grams)
            if not n:
                out.append((0, 0, 0, b""))
                continue
            low = np.full(bands * rows, 0xFFFFFFFF, dtype=np.uint32)
            short = (grams >> np.uint64(32)).astype(np.uint32)
            for k in range(0, n, 2048):
                low = np.minimum(low, (short[k : k + 2048][None, :] * a[:, None] + b[:, None]).min(axis=1))
            key = number.copy()
            for r in range(rows):
                key = mix(key + low[r::rows].astype(np.uint64))
            signed = lambda x: int(x) - (1 << 64) if int(x) >> 63 else int(x)
            out.append((n, signed(np.bitwise_xor.reduce(mix(grams))), signed(grams.sum(dtype=np.uint64)), key.tobytes()))
        columns = list(zip(*out, strict=True)) if out else [[], [], [], []]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        arrays = [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names=["doc_id", "n", "set_a", "set_b", "bands"])


def _band_rows(batches):
    import pyarrow as pa

    for batch in batches:
        keys = [np.frombuffer(b, dtype=np.int64) for b in batch.column(1).to_pylist()]
        reps = np.repeat(batch.column(0).to_numpy(), [len(k) for k in keys])
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([*keys, np.zeros(0, np.int64)])), pa.array(reps, pa.int64())], names=["bucket", "rep"])


def _sets(batches, width: int):
    """Keep what describes a member and turn its text into its n-gram set; rows whose text has another set go."""
    import pyarrow as pa

    for batch in batches:
        keep, out = [], []
        for i, (grams, n) in enumerate(zip(ngram_sets(batch.column("text"), width), batch.column("n").to_pylist(), strict=True)):
            if len(grams) == n:
                keep.append(i)
                out.append(grams.tobytes())
        kept = batch.take(pa.array(keep, pa.int64()))
        names = ["grp", "m", "chunk", "rep", "copies"]
        yield pa.RecordBatch.from_arrays([*(kept.column(c) for c in names), pa.array(out, pa.binary())], names=[*names, "grams"])


def linked(left: list[np.ndarray], right: list[np.ndarray] | None, similarity: float) -> np.ndarray:
    """Boolean matrix: which sets of ``left`` and ``right`` (None: ``left``) are at least so similar."""
    rows = left if right is None else left + right
    sizes = np.array([len(r) for r in rows], dtype=np.int64)
    values, inverse, counts = np.unique(np.concatenate(rows), return_inverse=True, return_counts=True)
    shared = np.flatnonzero(counts > 1)
    column = np.full(len(values), -1, dtype=np.int64)
    column[shared] = np.arange(len(shared))
    owner, column = np.repeat(np.arange(len(rows)), sizes), column[inverse]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    common = np.zeros((len(left), len(left if right is None else right)), dtype=np.float32)
    for at in range(0, len(shared), 4096):
        a, b = np.searchsorted(column, [at, at + 4096])
        x = np.zeros((len(rows), min(4096, len(shared) - at)), dtype=np.float32)
        x[owner[a:b], column[a:b] - at] = 1
        common += x[: len(left)] @ x[0 if right is None else len(left) :].T
    other = sizes if right is None else sizes[len(left) :]
    union = sizes[: len(left), None] + other[None, :] - common
    return common >= similarity * union - 1e-6


def _unit(members: list[tuple], i: int, j: int, similarity: float) -> list[tuple]:
    """Verify chunk i against chunk j of one group: (rep, links, least connected rep) of the classes with links."""
    unique = {}
    for chunk, rep, copies, grams in members:
        unique.setdefault((chunk, rep), (copies, np.frombuffer(grams, dtype=np.uint64)))
    parts = [[(rep, *v) for (chunk, rep), v in unique.items() if chunk == side] for side in ((i,) if i == j else (i, j))]
    if not all(parts) or (i == j and len(parts[0]) < 2):
        return []
    found = linked([p[2] for p in parts[0]], None if i == j else [p[2] for p in parts[1]], similarity)
    if i == j:
        found = np.triu(found, 1)
    a, b = np.nonzero(found)
    if i != j:
        b = b + len(parts[0])
    flat = [p for part in parts for p in part]
    reps, copies = np.array([p[0] for p in flat], dtype=np.int64), np.array([p[1] for p in flat], dtype=np.int64)
    links, root = np.zeros(len(flat), np.int64), reps.copy()
    np.add.at(links, a, copies[b])
    np.add.at(links, b, copies[a])
    while True:
        before = root.copy()
        np.minimum.at(root, a, before[b])
        np.minimum.at(root, b, root[a])
        if (root == before).all():
            return [(int(reps[k]), int(links[k]), int(root[k])) for k in np.flatnonzero(links)]


def _verify(batches, similarity: float):
    """Runs of rows with one (grp, i, j), in order, each verified as a unit."""
    import pyarrow as pa

    key, members, out = None, [], []
    schema = pa.schema([("rep", pa.int64()), ("links", pa.int64()), ("root", pa.int64())])
    for batch in batches:
        for grp, i, j, chunk, rep, copies, grams in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if key != (grp, i, j):
                if members:
                    out += _unit(members, key[1], key[2], similarity)
                key, members = (grp, i, j), []
            members.append((chunk, rep, copies, grams))
        if out:
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in out], schema=schema)
            out = []
    if members:
        out = _unit(members, key[1], key[2], similarity)
        yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in out], schema=schema)


def similar_classes(docs: DataFrame, similarity: float = SIMILARITY, recall: float = RECALL, width: int = WORDS, doc_id: str = "doc_id", text: str = "text", chunk_docs: int = CHUNK_DOCS, chunk_ngrams: int = CHUNK_NGRAMS) -> DataFrame:
    """One row per row of ``docs``: doc_id, rep_id, class_id, links.

    rep_id is the least doc_id with the same n-gram set, class_id the least one connected through links, and
    links the number of other rows whose n-gram set has at least the similarity; copies count each. A text
    of fewer than ``width`` words is one n-gram. A text without words, null included, has no n-grams, no
    links and itself as its class, and so has a row with a null doc_id. Rows that repeat a doc_id and its
    text are copies of each other. Other columns are ignored.
    """
    bands, rows = choose_bands(similarity, recall)
    base = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    made = base.mapInArrow(lambda it: _signatures(it, bands, rows, width), "doc_id long, n long, set_a long, set_b long, bands binary")
    signed = stage(made, "join-signatures")
    usable = (F.col("n") > 0) & F.col("doc_id").isNotNull()
    first = F.min(F.struct("doc_id", "bands"))
    classes = signed.filter(usable).groupBy("n", "set_a", "set_b").agg(first.alias("f"), F.count("*").alias("copies"))
    classes = stage(classes.select("n", "set_a", "set_b", F.col("f.doc_id").alias("rep"), F.col("f.bands").alias("bands"), "copies"), "join-classes")

    banded = classes.select("rep", "bands").mapInArrow(_band_rows, "bucket long, rep long")
    buckets = stage(banded.groupBy("bucket").agg(F.count("*").alias("size"), F.min("rep").alias("hub")).filter("size > 1").select(F.col("bucket").alias("b"), "hub"), "join-buckets")
    edges = banded.join(buckets, F.col("bucket") == F.col("b")).filter("rep != hub").select(F.col("rep").alias("u"), F.col("hub").alias("v"))
    roots = components(edges.distinct())
    member = roots.select(F.col("node").alias("rep"), F.col("root").alias("grp")).union(roots.select("root", "root").distinct())

    sized = stage(member.join(classes.select("rep", "n", "copies"), "rep"), "join-members")
    parts = F.greatest(F.ceil(F.count("*") / F.lit(chunk_docs)), F.ceil(F.sum("n") / F.lit(chunk_ngrams))).cast("int")
    groups = stage(sized.groupBy("grp").agg(parts.alias("m")).withColumnRenamed("grp", "g"), "join-groups")
    chunked = sized.join(groups, F.col("grp") == F.col("g")).select("rep", "n", "copies", "grp", "m", F.pmod(F.xxhash64("rep"), F.col("m")).cast("int").alias("chunk"))
    chunked = stage(chunked, "join-chunks")
    texts = base.join(chunked.hint("merge"), F.col("doc_id") == F.col("rep")).select("grp", "m", "chunk", "rep", "copies", "n", "text")
    sets = texts.mapInArrow(lambda it: _sets(it, width), "grp long, m int, chunk int, rep long, copies long, grams binary")
    units = sets.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("m") - 1)))
    units = units.select("grp", F.least("chunk", "other").alias("i"), F.greatest("chunk", "other").alias("j"), "chunk", "rep", "copies", "grams")
    dealt = units.repartition("grp", "i", "j").sortWithinPartitions("grp", "i", "j", "rep")
    verified = stage(dealt.mapInArrow(lambda it: _verify(it, similarity), "rep long, links long, root long"), "join-links")

    joined = components(verified.select(F.col("rep").alias("u"), F.col("root").alias("v")))
    counts = verified.groupBy("rep").agg(F.sum("links").alias("links"))
    info = classes.join(counts, "rep", "left").join(joined.withColumnRenamed("node", "rep"), "rep", "left")
    info = stage(info.select(F.col("n").alias("k"), F.col("set_a").alias("a"), F.col("set_b").alias("b"), "rep", "copies", F.coalesce("links", F.lit(0)).alias("more"), F.coalesce("root", "rep").alias("root")), "join-info")
    same = (F.col("n") == F.col("k")) & (F.col("set_a") == F.col("a")) & (F.col("set_b") == F.col("b")) & F.col("doc_id").isNotNull()
    out = signed.select("doc_id", "n", "set_a", "set_b").join(info, same, "left")
    return out.select("doc_id", F.coalesce("rep", "doc_id").alias("rep_id"), F.coalesce("root", "doc_id").alias("class_id"), F.coalesce(F.col("copies") - 1 + F.col("more"), F.lit(0)).cast("long").alias("links"))


def drop_similar(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each class of similar ones, that with the least doc_id; same columns."""
    dropped = stage(similar_classes(docs).filter("doc_id != class_id").select("doc_id").distinct(), "join-dropped")
    return docs.join(dropped.hint("merge"), docs["doc_id"] == dropped["doc_id"], "left_anti")
