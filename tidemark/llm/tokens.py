"""Token ids of whole texts, by a public tokenizer's own model, word by word."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable
from struct import pack

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

# Latin-1 as the word tokenizer classes it: letters, numbers, white space (after lower-casing).
_LETTERS = "a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff"
_NUMBERS = "0-9\xb2\xb3\xb9\xbc-\xbe"
_SPACE = "\t-\r \x85\xa0"
_PARTS = re.compile(f"[{_LETTERS}]+|\n|'s|'t|'re|'ve|'m|'ll|'d|[{_NUMBERS}]|[^{_SPACE}{_LETTERS}{_NUMBERS}]+")
# Stands after the ids of each word while a batch is encoded; no vocabulary has this id.
_END = 0xFFFFFFFF


def _byte_letters() -> dict[int, str]:
    """Latin-1 character -> its UTF-8 bytes in the letters that byte-level vocabularies use."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    letter = {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(rest)}
    return {c: "".join(letter[b] for b in chr(c).encode()) for c in range(256)}


class _Kept(dict):
    """Ids of what was asked for before, as little-endian 32-bit bytes; ``limit`` entries at most.

    Half of them are young. When these are full they grow old, and old ones not asked for since are forgotten.
    """

    def __init__(self, make, limit: int):
        super().__init__()
        self.make, self.limit, self.old = make, limit // 2, {}

    def __missing__(self, key: str) -> bytes:
        ids = self.old.pop(key, None)
        if ids is None:
            ids = self.make(key)
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        self[key] = ids
        return ids


class WordEncoder:
    """The ids of texts, as little-endian 32-bit bytes.

    The tokenizer splits at white space and its model takes every part of a word
    by itself, so a word's ids never depend on its neighbours. The distinct words
    of a batch are found in Arrow, cut into parts and looked up once; their ids
    are then dealt to all their places. Parts stay known between batches. A text
    outside Latin-1, with odd separators, or with what looks like a special
    token, goes through the whole tokenizer.
    """

    def __init__(self, path: str, limit: int = 240_000):
        self.whole = Tokenizer.from_file(path)
        self.model = self.whole.model
        self.letters = _byte_letters()
        self.words = _Kept(self._part, limit)

    def _part(self, part: str) -> bytes:
        if part == "\n":
            return pack("<I", _END)
        # Visible ASCII stands for itself.
        if not (part.isascii() and part.isprintable()):
            part = part.translate(self.letters)
        ids = [t.id for t in self.model.tokenize(part)]
        return pack(f"<{len(ids)}I", *ids)

    def _plain(self, text: str) -> bool:
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return False
        return not any(mark in text for mark in ("<|", "\x1c", "\x1d", "\x1e", "\x1f"))

    def _whole(self, text: str) -> bytes:
        text = text.encode("utf-8", "replace").decode()
        return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _by_word(self, texts: list[str]) -> list[bytes]:
        lowered = [text.lower().replace("\x85", " ").replace("\xa0", " ") for text in texts]
        split = pc.ascii_split_whitespace(pa.array(lowered, pa.large_string()))
        found = split.flatten().dictionary_encode()
        # Objects by numpy: to_pylist makes a scalar for each word first.
        parts = _PARTS.findall("\n".join([*found.dictionary.to_numpy(zero_copy_only=False), ""]))
        known = np.frombuffer(b"".join(map(self.words.__getitem__, parts)), "<u4")
        high = np.flatnonzero(known == _END)
        low = np.append(0, high + 1)[:-1]
        word = found.indices.to_numpy()
        # Where each word's ids end among those of the batch, and what to add there for its place in ``known``.
        ends = np.append(0, np.cumsum((high - low)[word]))
        ids = known[np.arange(ends[-1]) + np.repeat(low[word] - ends[:-1], (high - low)[word])]
        cuts = ends[split.offsets.to_numpy()]
        return [ids[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:])]

    def encode_all(self, texts: Iterable[str]) -> list[bytes]:
        texts = list(texts)
        plain = [self._plain(text) for text in texts]
        by_word = iter(self._by_word([text for text, is_plain in zip(texts, plain) if is_plain]))
        return [next(by_word) if is_plain else self._whole(text) for text, is_plain in zip(texts, plain)]

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """One encoder for each worker process."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def has_letter(text: str) -> bool:
    return any(unicodedata.category(c)[0] == "L" for c in text)
