"""Vector bin packing of examples into sequences, by the dot-product heuristic.

An example uses three resources at once: tokens, segments and loss-bearing tokens. The open sequence takes,
of the waiting examples that fit, the one whose use has the largest dot product with what the sequence has
left, each resource weighted by how scarce it is among the waiting examples. Every task packs its own rows
in windows of bounded size, so nothing is shuffled and a lost task is packed again the same way.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landfall.llm import tokens

WINDOW = 1024  # waiting examples from which the heuristic chooses


@dataclass(frozen=True)
class Limits:
    tokens: int = 2048
    segments: int = 64
    loss: int = 2048


class Packer:
    """Packs the examples of one task; every sequence is a list of (key, start, length).

    With ``cut`` an example may be split where no whole one fits; all tokens of such a piece count as
    loss-bearing. An example beyond the limits by itself is split in any case. Examples without tokens
    have no piece.
    """

    def __init__(self, limits: Limits, cut: bool, window: int = WINDOW):
        self.total = np.array([limits.tokens, limits.segments, limits.loss], dtype=float)
        self.most = max(1, min(limits.tokens, limits.loss))
        self.cut, self.window = cut, window
        self.waiting: list[tuple] = []  # (key, start); their tokens and loss are in the arrays below
        self.tokens, self.loss = np.zeros(0), np.zeros(0)
        self.use = np.zeros(3)  # of all that wait
        self._fresh()

    def _fresh(self) -> None:
        self.open: list[tuple] = []
        self.left = self.total.copy()

    def add(self, examples: list[tuple]) -> Iterator[list[tuple]]:
        """Take (key, tokens, loss) and yield the sequences that are closed."""
        sizes, losses = [], []
        for key, length, loss in examples:
            whole = max(0, length - 1) // self.most
            for k in range(whole):
                yield [(key, k * self.most, self.most)]
            rest = length - whole * self.most
            if rest:
                self.waiting.append((key, whole * self.most))
                sizes.append(rest)
                losses.append(min(loss, rest))
        n = len(self.waiting) - len(sizes)
        self.tokens = np.concatenate([self.tokens[:n], np.array(sizes, dtype=float)])
        self.loss = np.concatenate([self.loss[:n], np.array(losses, dtype=float)])
        self.use += (sum(sizes), len(sizes), sum(losses))
        while len(self.waiting) > self.window:
            yield from self._step()

    def finish(self) -> Iterator[list[tuple]]:
        """Place all that wait. What has not filled a sequence is in ``open`` afterwards."""
        while self.waiting:
            yield from self._step()

    def _choose(self, tokens: np.ndarray, loss: np.ndarray) -> int:
        """The best waiting example that fits, or -1."""
        left_tokens, left_segments, left_loss = self.left
        if self.cut and left_segments == 1 and tokens.max() > left_tokens:
            return -1  # the last segment fills the sequence
        weight = self.use * self.left / self.total**3
        gain = tokens * weight[0] + loss * weight[2] + weight[1]
        gain[(tokens > left_tokens) | (loss > left_loss)] = -1.0
        i = int(gain.argmax())
        return i if gain[i] >= 0 else -1

    def _step(self) -> Iterator[list[tuple]]:
        n = len(self.waiting)
        first = max(0, n - self.window)  # the window slides over what waits, so a step costs the same at any time
        tokens, loss = self.tokens[first:n], self.loss[first:n]
        i = self._choose(tokens, loss)
        if i >= 0:
            key, start = self.waiting[first + i]
            self.open.append((key, start, int(tokens[i])))
            used = np.array((tokens[i], 1.0, loss[i]))
            self.left -= used
            self.use -= used
            self.waiting[first + i], tokens[i], loss[i] = self.waiting[-1], tokens[-1], loss[-1]
            self.waiting.pop()
        elif self.cut:  # the head of the longest example
            at = int(tokens.argmax())
            length = min(self.left[0], self.left[2])
            key, start = self.waiting[first + at]
            self.open.append((key, start, int(length)))
            self.left -= (length, 1, length)
            self.waiting[first + at] = (key, start + int(length))
            less = loss[at] - min(loss[at], tokens[at] - length)
            tokens[at] -= length
            loss[at] -= less
            self.use -= (length, 0, less)
        if (i < 0 or self.left[0] < 1 or self.left[1] < 1 or self.left[2] < self.cut) and self.open:
            yield self.open
            self._fresh()


def powers_of_two(pieces: list[tuple]) -> Iterator[list[tuple]]:
    """Deal the pieces of an unfilled sequence into sequences whose lengths are powers of two.

    The storage format pads a sequence to its full length except at a power of two. Pieces keep their
    order and are cut where a sequence ends.
    """
    left = sum(p[2] for p in pieces)
    sequence, room = [], 0
    for key, start, length in pieces:
        while length:
            room = room or 1 << (left.bit_length() - 1)
            take = min(length, room)
            sequence.append((key, start, take))
            start, length, left, room = start + take, length - take, left - take, room - take
            if not room:
                yield sequence
                sequence = []


def _sequences(packer: Packer, batches) -> Iterator[list[tuple]]:
    for examples in batches:
        yield from packer.add(examples)
    yield from packer.finish()
    if packer.open:
        yield from powers_of_two(packer.open) if packer.cut else [packer.open]


def _write(sequences, payload, names, types):
    """Arrow batches of (payload of the piece, start, length, sequence_id, offset)."""
    import pyarrow as pa
    from pyspark import TaskContext

    schema = pa.schema(list(zip(names, types, strict=True)))
    number, out = TaskContext.get().partitionId() << 33, []

    def batch():
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], schema=schema)

    for pieces in sequences:
        offset = 0
        for key, start, length in pieces:
            out.append((*payload(key, start, length), start, length, number, offset))
            offset += length
        number += 1
        if len(out) >= 10_000:
            yield batch()
            out = []
    if out:
        yield batch()


def pack_documents(docs: DataFrame, limits: Limits = Limits(), cut: bool = True, doc_id: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """One row per piece: doc_id, ids_crc32, doc_tokens, start, length, sequence_id, offset.

    Each document is its token ids and an end id; a null text is empty, so such a document is its end id
    alone. All tokens but the first of a document bear loss. Null and repeated doc_ids are packed like
    others. Other columns are ignored. With ``cut`` (the default) a sequence is filled with the head of a
    longer example, and the last sequence of a task is dealt into lengths that are powers of two;
    without it only examples beyond the limits are cut. sequence_id is unique over all tasks.
    """

    def run(batches):
        import pyarrow as pa

        encode = tokens.encoder(path).encode
        end = np.array([tokens.END], dtype="<u4").tobytes()
        held: dict[int, list] = {}  # doc_id, bytes and unplaced tokens of the documents that wait

        def examples():
            row = 0
            for b in batches:
                out = []
                for name, data in zip(b.column(0).to_pylist(), encode(b.column(1)), strict=True):
                    held[row] = [name, data + end, len(data) // 4 + 1]
                    out.append((row, len(data) // 4 + 1, len(data) // 4))
                    row += 1
                    if len(out) == 1000:
                        yield out
                        out = []
                yield out

        def payload(key, start, length):
            entry = held[key]
            entry[2] -= length
            if not entry[2]:
                del held[key]
            return entry[0], zlib.crc32(entry[1][4 * start : 4 * (start + length)]), len(entry[1]) // 4

        names = ["doc_id", "ids_crc32", "doc_tokens", "start", "length", "sequence_id", "offset"]
        yield from _write(_sequences(Packer(limits, cut), examples()), payload, names, [pa.int64()] * 7)

    schema = "doc_id long, ids_crc32 long, doc_tokens long, start long, length long, sequence_id long, offset long"
    return docs.select(F.col(doc_id).cast("long"), F.col(text)).mapInArrow(run, schema)


def pack_examples(examples: DataFrame, key: str, n_tokens: str, n_loss: str, limits: Limits = Limits(), cut: bool = False) -> DataFrame:
    """Pack examples whose use is already counted, such as conversations with loss on the answers only.

    One row per piece: key, start, length, sequence_id, offset. Null counts are 0. An example without
    tokens has no piece. Examples stay whole unless ``cut`` is set or one exceeds the limits by itself.
    """

    def run(batches):
        import pyarrow as pa

        def taken():
            for b in batches:
                yield [(k, n or 0, m or 0) for k, n, m in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True)]

        names, types = ["key", "start", "length", "sequence_id", "offset"], [pa.string()] + [pa.int64()] * 4
        yield from _write(_sequences(Packer(limits, cut), taken()), lambda k, *_: (k,), names, types)

    counted = examples.select(F.col(key).cast("string"), F.col(n_tokens).cast("long"), F.col(n_loss).cast("long"))
    return counted.mapInArrow(run, "key string, start long, length long, sequence_id long, offset long")
