"""Subword ids of whole texts with the public ``tokenizers`` files, remembered by word.

``WordIds`` returns exactly what ``Tokenizer.encode(text, add_special_tokens=False)`` returns for a tokenizer of the
``word_bpe_49k.json`` kind: its normaliser and splitter never look across ASCII white space, so a text's ids are those of its
words, one after another, and A-Z may be lowered before. A word of Latin-1 letters is split by the file's pattern here and each part goes
to the tokenizer's own BPE model; any other word, and any that may hold a special token, goes through the whole tokenizer.

``arrays`` takes a column: a few megabytes of text at a time are split and numbered as Arrow arrays, each distinct word is looked up once,
and the ids of all its places are gathered with numpy. A longer text is cut at white space, so a task never holds more than its ids.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

MEMO = 400_000      # words remembered by a task, without the marks after them: 100 MB at most
PARTS = 60_000      # parts of words that are not letters alone: 15 MB at most
SLICE = 4_000_000   # bytes of text that are split at a time

# Letters, numbers and white space below U+0100, and the contractions of the file's pattern
_L, _N, _S = "a-zªµºß-öø-ÿ", "0-9²³¹¼½¾", "\t\n\x0b\x0c\r \x85\xa0"
_PART = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_L}]+|[{_N}]|[^{_S}{_L}{_N}]+")


def _byte_letters() -> dict[int, str]:
    """The letter that byte-level BPE files write for each byte that is not printable Latin-1: one from U+0100 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    return {b: chr(256 + i) for i, b in enumerate(sorted({*range(256)} - plain))}


_LETTERS = _byte_letters()
_WIDE = re.compile(r"[^\x00-\xff]")
_MARKS = b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"       # after a letter they are one part, or the start of none
_BLANK = re.compile(rb"[\x20\x09-\x0D]")


def _letters(text: str) -> bool:
    return text.isalpha() and not _WIDE.search(text)


def _pieces(text: bytes) -> Iterator[pa.Array]:
    """A text in parts of about ``SLICE`` bytes, cut before white space."""
    a = 0
    while a < len(text):
        blank = _BLANK.search(text, a + SLICE)
        b = blank.start() if blank else len(text)
        yield pa.array([text[a:b]], pa.binary()).cast(pa.string())
        a = b


class WordIds:
    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenize = self.tokenizer.model.tokenize
        self.words: dict[bytes, bytes] = {}         # ids as native unsigned 32-bit integers
        self.parts: dict[str, bytes] = {}

    def _bpe(self, part: str) -> bytes:
        s = part if part.isascii() and part.isalnum() else part.encode().decode("latin-1").translate(_LETTERS)
        return array("I", [t.id for t in self.tokenize(s)]).tobytes()

    def _whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _part(self, part: str) -> bytes:
        ids = self.parts.get(part)
        if ids is None:
            ids = self._bpe(part)
            if len(part) <= 64:
                if len(self.parts) >= PARTS:
                    self.parts.clear()
                self.parts[part] = ids
        return ids

    def _word(self, word: bytes) -> bytes:
        """Ids of a word that is not remembered."""
        if word.isalpha():
            ids = self._bpe(word.decode().lower())
        elif b"<|" in word:
            ids = self._whole(word.decode())
        else:
            core = word.rstrip(_MARKS)
            if len(core) < len(word) and (core.isalpha() or _letters(core.decode())):       # letters and marks are never one part
                return (self.words.get(core) or self._word(core)) + self._part(word[len(core):].decode())
            text = word.decode()
            if _letters(text):
                ids = self._bpe(text.lower())
            elif _WIDE.search(text):
                ids = self._whole(text)
            else:
                ids = b"".join([self._part(p) for p in _PART.findall(text.lower())])
        if len(word) <= 64:
            if len(self.words) >= MEMO:
                self.words.clear()
            self.words[word] = ids
        return ids

    def _flat(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a slice of texts and the place where each text's begin (and, last, their number)."""
        special = pc.any(pc.match_substring(column, "<|")).as_py()      # known in one case only
        split = pc.ascii_split_whitespace(column if special else pc.ascii_lower(column))
        begin = np.asarray(split.offsets)
        coded = split.flatten().dictionary_encode()
        at, get, new = np.asarray(coded.indices), self.words.get, self._word
        found = [(get(w) or new(w)) if w else b"" for w in coded.dictionary.cast(pa.binary()).to_pylist()]
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        ids = np.frombuffer(b"".join(found), np.uint32).astype("<u4", copy=False)
        first = np.cumsum(sizes) - sizes
        size = sizes[at]
        end = np.concatenate([[0], np.cumsum(size)])
        flat = ids[np.repeat(first[at] - end[:-1], size) + np.arange(end[-1])]
        return flat, end[begin - begin[0]]

    def arrays(self, column: pa.Array | pa.ChunkedArray, last: int | None = None) -> Iterator[np.ndarray]:
        """The ids of each text of a column (null: none), with ``last`` after them if given."""
        tail = np.array([] if last is None else [last], "<u4")
        for chunk in column.chunks if isinstance(column, pa.ChunkedArray) else [column]:
            sizes = pc.fill_null(pc.binary_length(chunk), 0).to_numpy(zero_copy_only=False)
            ends = np.cumsum(sizes, dtype=np.int64)
            a = 0
            while a < len(chunk):
                if sizes[a] > SLICE:
                    yield np.concatenate([*(self._flat(p)[0] for p in _pieces(chunk[a].as_buffer().to_pybytes())), tail])
                    a += 1
                    continue
                b = int(np.searchsorted(ends, ends[a] - sizes[a] + SLICE, "right"))
                flat, at = self._flat(pc.fill_null(chunk.slice(a, b - a), ""))
                for i, j in zip(at[:-1], at[1:]):
                    yield np.concatenate([flat[i:j], tail])
                a = b

    def ids(self, text: str | None) -> list[int]:
        return next(self.arrays(pa.array([text], pa.string()))).tolist()
