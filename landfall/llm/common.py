"""What several operators share: documents, staged tables, words and shingles of whole record batches.

A *word* is a maximal run of characters outside space and U+0009 to U+000D. Word and shingle hashes
are 64 bits wide and computed over the UTF-8 bytes of a whole slice of documents at once.
"""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from landfall.session import new_dir

WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"
SLICE_BYTES = 2_000_000  # documents are hashed in slices of about so many bytes; a longer document is a slice of its own


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the package to the Python workers, once per application; where they have it installed nothing changes."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parent.parent
    archive = Path(tempfile.mkdtemp(prefix="landfall-")) / "landfall.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for file in sorted(package.rglob("*.py")):
            z.write(file, file.relative_to(package.parent))
    context.addPyFile(str(archive))
    _SHIPPED.add(context.applicationId)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write once into the shared folder and read back: cuts lineage, survives lost executors, gives sizes to the planner."""
    path = new_dir(df.sparkSession, f"llm-{name}")
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fold(doc_id: str, k: int) -> Column:
    """crc32 of the decimal text of an id, modulo k; null ids count as the text 'null'."""
    return F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("null")).cast("binary")), F.lit(k)).cast("int")


# --- hashing inside tasks --------------------------------------------------------------------------

_BASE = 0x9E3779B97F4A7C15 | 1
_POWERS: dict[str, np.ndarray] = {}
_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit values that spreads every input bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64, for positions below n."""
    if len(_POWERS.get("up", ())) < max(n, 1):
        n = max(n, SLICE_BYTES)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            _POWERS[name] = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n - 1, base, np.uint64)]))
    return _POWERS["up"], _POWERS["down"]


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of the documents that lie one after another in ``data``; number of words of each."""
    n = len(data)
    solid = ~_IS_SPACE[data]
    first = np.zeros(n + 1, dtype=bool)
    first[offsets] = True
    begin = solid.copy()
    begin[1:] &= ~solid[:-1] | first[1:n]
    end = solid.copy()
    end[:-1] &= ~solid[1:] | first[1:n]
    begins, ends = np.flatnonzero(begin), np.flatnonzero(end) + 1
    up, down = _powers(n)
    total = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:n], out=total[1:])
    hashes = mix((total[ends] - total[begins]) * down[begins] + (ends - begins).astype(np.uint64))
    return hashes, np.diff(np.searchsorted(begins, offsets))


def text_slices(texts, extra: int = 0) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(from, to, bytes, offsets) of consecutive documents of an Arrow string array; null texts are empty."""
    import pyarrow as pa
    import pyarrow.compute as pc

    texts = pc.fill_null(texts, "").cast(pa.large_string())
    if len(texts) == 0:
        return
    raw = texts.buffers()
    offsets = np.frombuffer(raw[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(raw[2], dtype=np.uint8) if raw[2] is not None else np.zeros(0, np.uint8)
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + SLICE_BYTES, side="right")) - 1)
        yield at, to, data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]
        at = to


def shingles(hashes: np.ndarray, counts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of ``width`` consecutive words per document; number of each. Fewer words than that are one shingle."""
    n, first = len(hashes), np.concatenate([[0], np.cumsum(counts)])
    factors = [np.uint64((2 * k + 3) * 0xD6E8FEB86659FD93 & (1 << 64) - 1 | 1) for k in range(width)]
    padded = np.concatenate([hashes, np.zeros(width, np.uint64)])
    total = np.zeros(n, np.uint64)
    for k in range(width):
        total += padded[k : n + k] * factors[k]
    total = mix(total)
    each = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    keep = np.zeros(n + 1, dtype=np.int64)
    np.add.at(keep, first[:-1][each > 0], 1)
    np.add.at(keep, (first[:-1] + each)[each > 0], -1)
    short = np.flatnonzero((counts > 0) & (counts < width))  # a short document must not see its successor's words
    part = counts[short].astype(np.uint64)
    for k in range(width - 1):
        part += np.where(k < counts[short], padded[first[short] + k], np.uint64(0)) * factors[k]
    total[first[short]] = mix(part)
    return total[np.cumsum(keep[:n]) > 0], each
