"""Token ids of whole texts, exactly as the tokenizers library gives them, with the repeated work remembered.

The tokenizer used here lower-cases, drops white space and never joins characters across the boundaries of
letters, digits and other signs, so the ids of a text are those of its pieces, one after another. Pieces are
looked up first and encoded by the library only when unseen. Where this cannot be told from the characters
(rare letters, special tokens), the library encodes the whole part between two spaces. Memory is bounded: the
table is emptied when it is full.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import numpy as np

VOCABULARY = "word_bpe_49k.json"
END = 1  # id that ends a document
PIECES = 500_000  # entries remembered in a worker, some 100 MB
SLICE_BYTES = 4_000_000

# Characters for which lower() and the split below agree with the tokenizer's own rules.
_PLAIN = re.compile(r"[\x09-\x0d\x20-\x7eÀ-ÖØ-öø-įĲ-ňŊ-ž]*")
_PIECE = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ž]+|[0-9]|[^a-z0-9ß-öø-ž\x09-\x0d\x20]+")
_APART = r"('s|'t|'re|'ve|'m|'ll|'d|[0-9]|[^a-z0-9ß-öø-ž\x09-\x0d\x20]+)"  # the pieces that are no words, for Arrow
_SPECIAL = "<|"


class Encoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.pieces: dict[str, bytes] = {}
        vocabulary = self.tokenizer.get_vocab()
        self.width = 2 if max(vocabulary.values()) < 1 << 16 else 4  # bytes that hold an id
        self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)  # ids that end a piece
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, dtype="<u4") for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, pieces: list[str], words: bool) -> None:
        """Encode pieces. ``words``: none can be split further, so a hundred go into one text, and the last id
        of each shows where the next begins."""
        rest = []
        if words:
            for at, ids in zip(range(0, len(pieces), 100), self._ids([" ".join(pieces[i : i + 100]) for i in range(0, len(pieces), 100)]), strict=True):
                some, data = pieces[at : at + 100], ids.tobytes()
                cuts = (4 * np.flatnonzero(self.ends[ids]) + 4).tolist()
                if len(cuts) == len(some) and cuts[-1] == len(data):
                    self.pieces.update(zip(some, [data[i:j] for i, j in zip([0, *cuts[:-1]], cuts, strict=True)], strict=True))
                else:
                    rest += some
        else:
            rest = pieces
        self.pieces.update(zip(rest, (x.tobytes() for x in self._ids(rest)), strict=True))

    def _of(self, pieces: list[str], words: bool) -> list[bytes]:
        """Ids of distinct pieces."""
        unseen = [p for p in pieces if p not in self.pieces]
        if len(self.pieces) + len(unseen) > PIECES:
            self.pieces.clear()
            unseen = pieces
        if unseen:
            self._learn(unseen, words)
        return list(map(self.pieces.__getitem__, pieces))

    def _plain(self, texts) -> list[bytes]:
        """Ids of texts of plain characters: Arrow splits them into pieces and numbers the distinct ones."""
        import pyarrow.compute as pc

        spaced = pc.replace_substring_regex(pc.utf8_lower(texts), _APART, r" \1 ")
        pieces = pc.ascii_split_whitespace(spaced)
        coded = pieces.flatten().dictionary_encode()
        ids = self._of(coded.dictionary.to_pylist(), words=True)
        lengths = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        number = coded.indices.to_numpy()
        each = lengths[number]
        before = np.concatenate([[0], np.cumsum(each)])
        place = np.repeat((np.cumsum(lengths) - lengths)[number] - before[:-1], each)
        place += np.arange(before[-1])
        tokens = np.frombuffer(b"".join(ids), "<u4")[place]
        cuts = before[np.cumsum(pieces.value_lengths().to_numpy())].tolist()
        return [tokens[start:end].tobytes() for start, end in zip([0, *cuts[:-1]], cuts, strict=True)]

    def _other(self, text: str) -> bytes:
        """Ids of a text with other characters, part by part."""
        split = [_PIECE.findall(p.lower()) if _PLAIN.fullmatch(p) and _SPECIAL not in p else [p] for p in text.split(" ")]
        flat = [p for found in split for p in found]
        known = dict(zip(unique := list(dict.fromkeys(flat)), self._of(unique, words=False), strict=True))
        return b"".join(map(known.__getitem__, flat))

    def encode(self, texts) -> Iterator[bytes]:
        """Little-endian unsigned 32-bit ids of each text, without the end id; null is empty.

        ``texts`` is a list or an Arrow array.
        """
        import pyarrow as pa
        import pyarrow.compute as pc

        texts = pc.fill_null(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string()), "")
        ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < len(texts):
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + SLICE_BYTES)))
            some = texts.slice(at, to - at)
            strings = some.to_pylist()
            plain = np.array([bool(_PLAIN.fullmatch(t)) and _SPECIAL not in t for t in strings])
            found = iter(self._plain(some.filter(pa.array(plain))) if plain.any() else ())
            for text, is_plain in zip(strings, plain.tolist(), strict=True):
                yield next(found) if is_plain else self._other(text)
            at = to


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str | None = None) -> Encoder:
    """The encoder of this worker. ``path``: vocabulary file; by default the public one every host has."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(VOCABULARY)
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]
