"""Whole texts to token ids with a byte-level BPE file of the ``tokenizers`` library.

The library splits a text into pretokens before it merges. A space before a character
that is not white space always begins a pretoken, and a line feed between two such
characters is one of its own. So a text is cut there, each distinct piece is encoded
once by the library, and the ids of a text are the concatenation of its pieces' ids: the
same ids as one call on the whole text (tests compare both), at a fraction of the work.
White space in any other place goes to the library as part of its piece. The piece
cache belongs to a task: it is emptied when it holds ``most`` bytes, and at the task's end (workers
are used again by other stages); pieces longer than ``LONG_PIECE`` characters are encoded uncached.
"""

from __future__ import annotations

import contextlib
import functools
import re
import string
from array import array
from collections.abc import Iterator

import numpy as np

_CUT = re.compile(r" (?=\S)")
LONG_PIECE = 64
ENTRY_BYTES = 220          # of a cached piece: text, ids and their place, without the letters and ids themselves


def _byte_letters() -> dict[int, str]:
    """Characters below U+0250 as the byte-level alphabet of such a file spells them:
    printable bytes stand for themselves, the others for U+0100 onwards in order."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = [b for b in range(256) if b not in plain]
    spell = {b: chr(b) if b in plain else chr(256 + rest.index(b)) for b in range(256)}
    return {c: "".join(spell[b] for b in chr(c).encode()) for c in range(0x250)}


class _Irregular(Exception):
    """White space before white space or at an end: the plain cut does not apply."""


class _Pieces(dict):
    """ids (as bytes of unsigned 32-bit integers) of ``before`` + piece."""

    def __init__(self, tokenizer, before: str, most: int):
        super().__init__()
        self.tokenizer, self.model, self.before, self.most = tokenizer, tokenizer.model, before, most
        self.held = 0
        self.letters = _byte_letters()
        self.mapped = before.translate(self.letters)
        self.marks: dict[str, bytes] = {}

    def encode(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def __missing__(self, piece: str) -> bytes:
        if not piece or piece[0].isspace() or piece[-1].isspace():
            raise _Irregular
        word = piece.rstrip(string.punctuation)
        if not word.isalpha() or max(word) >= "ɐ":
            ids = self.encode(self.before + piece)
        elif word is piece or len(word) == len(piece):   # letters only: one pretoken, straight to the merges
            ids = array("I", [t.id for t in self.model.tokenize(self.mapped + word.translate(self.letters))]).tobytes()
        else:                                            # a run of marks after letters is a pretoken
            marks = piece[len(word):]
            tail = self.marks.get(marks)
            if tail is None:
                tail = self.encode(marks)
                if len(marks) <= LONG_PIECE:
                    self.marks[marks] = tail
                    self.held += ENTRY_BYTES + 5 * len(marks)
            ids = self[word] + tail
        if len(piece) <= LONG_PIECE:
            if self.held >= self.most:
                self.release()
            self[piece] = ids
            self.held += ENTRY_BYTES + len(piece) + len(ids)
        return ids

    def release(self) -> None:
        self.clear()
        self.marks.clear()
        self.held = 0


class TextEncoder:
    def __init__(self, path: str, most: int = 128 << 20):
        from tokenizers import Tokenizer
        tokenizer = Tokenizer.from_file(path)
        self.heads, self.pieces = _Pieces(tokenizer, "", most // 4), _Pieces(tokenizer, " ", most)
        self.feed = self.pieces.encode("\n")
        self.vocab = tokenizer.get_vocab_size()

    def encode(self, text: str) -> bytes:
        """ids of ``text`` as bytes of unsigned 32-bit little-endian integers."""
        if not text:
            return b""
        try:
            piece, out = self.pieces.__getitem__, []
            for line in text.split("\n"):
                head, *rest = line.split(" ")
                out.append(self.heads[head] + b"".join(map(piece, rest)))
            return self.feed.join(out)
        except _Irregular:
            head, *rest = _CUT.split(text)
            return b"".join([self.pieces.encode(head), *[self.pieces.encode(" " + p) for p in rest]])

    def ids(self, text: str) -> np.ndarray:
        return np.frombuffer(self.encode(text), "<u4")

    def release(self) -> None:
        """Forget all pieces."""
        self.heads.release()
        self.pieces.release()


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> TextEncoder:
    """One encoder per file and Python worker, kept between tasks without its pieces."""
    return TextEncoder(path)


@contextlib.contextmanager
def task_encoder(path: str) -> Iterator[TextEncoder]:
    """The worker's encoder for one task; what it has cached is forgotten at the end."""
    enc = encoder(path)
    try:
        yield enc
    finally:
        enc.release()


def default_vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")
