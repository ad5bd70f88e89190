"""Token ids stored as wavelet matrices, one compressed file per shard.

A wavelet matrix keeps a sequence as one plane of bits per bit of the largest id, highest bit first; each
plane holds the ids in an order sorted stably by the bits above. With rank and select on the planes the file
answers access(i), rank(id, i), count(id) and select(id, k) without being decoded. A shard is one row of a
Parquet file of its own, with its planes, its rank directory and the documents it holds.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from landfall.llm import tokens
from landfall.llm.common import stage
from landfall.session import new_dir

SHARD_TOKENS = 1 << 20
RANGE_DOCS = 5_000  # documents of a range of doc_id that one task writes
BLOCK_BITS = 512  # bits between entries of the rank directory

SHARD = """part int, shard int, doc_ids array<long>, lengths array<long>, n_tokens long, n_planes int,
           zeros array<long>, planes array<binary>, ranks array<binary>"""


class WaveletMatrix:
    """Build from ids, or open from stored planes. Positions and counts are within the shard."""

    def __init__(self, n: int, zeros: list[int], planes: list[bytes], ranks: list[bytes]):
        self.n, self.zeros = n, [int(z) for z in zeros]
        self.planes = [np.frombuffer(p, dtype=np.uint8) for p in planes]
        self.ranks = [np.frombuffer(r, dtype="<u4") for r in ranks]

    @classmethod
    def build(cls, ids: np.ndarray) -> WaveletMatrix:
        values = np.asarray(ids)
        top = int(values.max()).bit_length() if len(values) else 0
        values = values.astype(np.uint16 if top <= 16 else np.uint32)
        zeros, planes, ranks = [], [], []
        for bit in range(top - 1, -1, -1):
            ones = (values & values.dtype.type(1 << bit)) != 0
            packed = np.packbits(ones)
            per_block = np.add.reduceat(np.bitwise_count(packed).astype(np.uint32), np.arange(0, len(packed), BLOCK_BITS // 8))
            planes.append(packed.tobytes())
            ranks.append(np.concatenate([[0], np.cumsum(per_block)[:-1]]).astype("<u4").tobytes())
            values = np.concatenate([values.compress(~ones), low := values.compress(ones)])
            zeros.append(len(values) - len(low))
        return cls(len(values), zeros, planes, ranks)

    def _rank1(self, level: int, i: int) -> int:
        """Ones of a plane before position i."""
        block, plane = i // BLOCK_BITS, self.planes[level]
        if i >= self.n:
            return self.n - self.zeros[level]
        first, last = block * BLOCK_BITS // 8, i // 8
        ones = int(self.ranks[level][block]) + int(np.bitwise_count(plane[first:last]).sum())
        return ones + (int(plane[last]) >> (8 - i % 8)).bit_count() if i % 8 else ones

    def _bit(self, level: int, i: int) -> int:
        return int(self.planes[level][i >> 3]) >> (7 - (i & 7)) & 1

    def access(self, i: int) -> int:
        """The id at position i."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        value = 0
        for level in range(len(self.planes)):
            bit = self._bit(level, i)
            value = value << 1 | bit
            i = self.zeros[level] + self._rank1(level, i) if bit else i - self._rank1(level, i)
        return value

    def _range(self, token: int, i: int) -> tuple[int, int]:
        """Where the occurrences of an id before position i lie in the order of the last plane."""
        if token < 0 or token >> len(self.planes):
            return 0, 0
        a, b = 0, min(i, self.n)
        for level in range(len(self.planes)):
            ones_a, ones_b = self._rank1(level, a), self._rank1(level, b)
            if token >> (len(self.planes) - 1 - level) & 1:
                a, b = self.zeros[level] + ones_a, self.zeros[level] + ones_b
            else:
                a, b = a - ones_a, b - ones_b
        return a, b

    def rank(self, token: int, i: int) -> int:
        """Occurrences of an id before position i."""
        a, b = self._range(token, i)
        return b - a

    def count(self, token: int) -> int:
        return self.rank(token, self.n)

    def _select(self, level: int, bit: int, k: int) -> int:
        """Position of the k-th (from 0) bit of that value in a plane, by bisection on the rank directory."""
        ranks = self.ranks[level].astype(np.int64)
        before = ranks if bit else np.arange(len(ranks)) * BLOCK_BITS - ranks
        block = int(np.searchsorted(before, k, side="right")) - 1
        bits = np.unpackbits(self.planes[level][block * BLOCK_BITS // 8 : (block + 1) * BLOCK_BITS // 8])[: self.n - block * BLOCK_BITS]
        return block * BLOCK_BITS + int(np.flatnonzero(bits == bit)[k - int(before[block])])

    def select(self, token: int, k: int) -> int:
        """Position of the k-th occurrence of an id, counted from 0."""
        a, b = self._range(token, self.n)
        if not 0 <= k < b - a:
            raise IndexError(k)
        i = a + k
        for level in range(len(self.planes) - 1, -1, -1):
            bit = token >> (len(self.planes) - 1 - level) & 1
            i = self._select(level, bit, i - self.zeros[level] if bit else i)
        return i

    def decode(self) -> np.ndarray:
        """All ids: the planes undone from the last to the first."""
        values = np.zeros(self.n, dtype=np.uint16 if len(self.planes) <= 16 else np.uint32)
        for level in range(len(self.planes) - 1, -1, -1):
            ones = np.unpackbits(self.planes[level], count=self.n).view(bool)
            bit = values.dtype.type(1 << (len(self.planes) - 1 - level))
            before = np.empty_like(values)
            before[np.flatnonzero(~ones)] = values[: self.zeros[level]]
            before[np.flatnonzero(ones)] = values[self.zeros[level] :] | bit
            values = before
        return values


def _shards(rows: Iterator[tuple], most: int, width: int) -> Iterator[tuple]:
    """Shards of (part, doc_id, bytes) rows in order; a shard ends before the document that would exceed ``most``."""
    part, number, ids, data, size = None, 0, [], [], 0

    def shard():
        values = np.frombuffer(b"".join(data), dtype=f"<u{width}")
        w = WaveletMatrix.build(values)
        lengths = [len(d) // width for d in data]
        return part, number, ids, lengths, w.n, len(w.planes), w.zeros, [p.tobytes() for p in w.planes], [r.tobytes() for r in w.ranks]

    for row_part, doc_id, ids_bytes in rows:
        if ids and (row_part != part or size + len(ids_bytes) // width > most):
            yield shard()
            number = number + 1 if row_part == part else 0
            ids, data, size = [], [], 0
        elif row_part != part:
            number = 0
        part = row_part
        ids.append(doc_id)
        data.append(ids_bytes)
        size += len(ids_bytes) // width
    if ids:
        yield shard()


def write_shards(docs: DataFrame, path: str, shard_tokens: int = SHARD_TOKENS, doc_id: str = "doc_id", text: str = "text", vocabulary: str | None = None) -> None:
    """Encode every document, append the end id and write all ids in ascending doc_id order.

    Null text is empty. Null doc_ids come first; rows that repeat a doc_id follow each other, by content.
    Other columns are ignored. A document longer than a shard is a shard of its own. The ranges of doc_id
    that tasks write are cut at quantiles, which are all the driver sees.
    """
    base = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    rows = base.agg(F.count("*")).first()[0]
    n = max(1, -(-rows // RANGE_DOCS))
    cuts = base.agg(F.percentile_approx("doc_id", [k / n for k in range(1, n)], max(10_000, 20 * n))).first()[0] if n > 1 else []
    bounds = np.unique(np.array(cuts or [], dtype=np.int64))

    def encode(batches):
        import pyarrow as pa

        encoder = tokens.encoder(vocabulary)
        narrow = lambda ids: np.append(np.frombuffer(ids, "<u4"), np.uint32(tokens.END)).astype(f"<u{encoder.width}").tobytes()
        for b in batches:
            parts = np.searchsorted(bounds, b.column(0).fill_null(-(1 << 63)).to_numpy(zero_copy_only=False), side="left").astype(np.int32)
            for at in range(0, b.num_rows, 1000):
                some = b.slice(at, 1000)
                data = pa.array([narrow(x) for x in encoder.encode(some.column(1))], pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(parts[at : at + 1000]), some.column(0), data], names=["part", "doc_id", "ids"])

    def build(batches):
        import pyarrow as pa

        def rows():
            for b in batches:
                yield from zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True)

        i64, i32 = pa.int64(), pa.int32()
        kinds = [i32, i32, pa.list_(i64), pa.list_(i64), i64, i32, pa.list_(i64), pa.list_(pa.binary()), pa.list_(pa.binary())]
        names = [c.split()[0] for c in SHARD.replace("\n", " ").split(",")]
        for s in _shards(rows(), shard_tokens, tokens.encoder(vocabulary).width):
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(s, kinds, strict=True)], names=names)

    encoded = base.mapInArrow(encode, "part int, doc_id long, ids binary")
    dealt = encoded.repartition(n, "part").sortWithinPartitions("part", F.col("doc_id").asc_nulls_first(), "ids")
    dealt.mapInArrow(build, SHARD).write.option("maxRecordsPerFile", 1).option("compression", "zstd").mode("errorifexists").parquet(path)


def read_documents(spark, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, decoded from the shard files."""
    files = spark.read.schema(SHARD).parquet(path)

    def decode(batches):
        import pyarrow as pa

        for b in batches:
            for s in b.to_pylist():
                ids = WaveletMatrix(s["n_tokens"], s["zeros"], s["planes"], s["ranks"]).decode().astype("<u4")
                ends = np.cumsum(s["lengths"])
                crc = [zlib.crc32(ids[e - k : e].tobytes()) for e, k in zip(ends, s["lengths"], strict=True)]
                m = len(crc)
                columns = [pa.array([s["part"]] * m, pa.int32()), pa.array([s["shard"]] * m, pa.int32()), pa.array(s["doc_ids"], pa.int64())]
                columns += [pa.array(x, pa.int64()) for x in (ends - s["lengths"], s["lengths"], crc)]
                yield pa.RecordBatch.from_arrays(columns, names=["part", "shard", "doc_id", "first", "n_tokens", "ids_crc32"])

    decoded = files.mapInArrow(decode, "part int, shard int, doc_id long, first long, n_tokens long, ids_crc32 long")
    return decoded.join(shard_starts(files), ["part", "shard"]).select("doc_id", (F.col("first") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")


def shard_starts(files: DataFrame) -> DataFrame:
    """part, shard and the number of ids in all shards before it, from sums of the parts and of the shards within."""
    totals = stage(files.select("part", "shard", "n_tokens"), "wavelet-totals")
    parts = totals.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = parts.select("part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("p"))
    inside = Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    own = totals.select("part", "shard", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)).alias("w"))
    return stage(own.join(before, "part").select("part", "shard", (F.col("p") + F.col("w")).alias("before")), "wavelet-starts")


def occurrences(spark, path: str, token: int, limit_per_shard: int | None = None) -> DataFrame:
    """part, shard, n and positions (within the shard) of an id, found by rank and select without decoding."""
    files = spark.read.schema(SHARD).parquet(path)

    def find(batches):
        import pyarrow as pa

        for b in batches:
            for s in b.to_pylist():
                w = WaveletMatrix(s["n_tokens"], s["zeros"], s["planes"], s["ranks"])
                n = w.count(token)
                some = range(n if limit_per_shard is None else min(n, limit_per_shard))
                yield pa.RecordBatch.from_pylist([{"part": s["part"], "shard": s["shard"], "n": n, "positions": [w.select(token, k) for k in some]}], schema=pa.schema([("part", pa.int32()), ("shard", pa.int32()), ("n", pa.int64()), ("positions", pa.list_(pa.int64()))]))

    return files.mapInArrow(find, "part int, shard int, n long, positions array<long>")


def round_trip(docs: DataFrame, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Write the shards of ``docs`` into the shared folder and return what is read back from them."""
    path = new_dir(docs.sparkSession, "llm-wavelet")
    write_shards(docs, path, shard_tokens)
    return read_documents(docs.sparkSession, path)
