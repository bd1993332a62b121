"""Tokenizer access: whole texts to token ids, with a bounded cache of word encodings.

The word tokenizer normalizes, then splits at white space, then encodes each pre-token by itself, so a text's ids are
the ids of its white-space chunks one after the other. Chunks repeat, so their encodings are cached; a chunk of plain
ASCII or Latin-1 letters goes straight to the BPE model, anything else through the whole tokenizer.
"""

from __future__ import annotations

import os
import re

import numpy as np


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


# Pre-token rule of the tokenizer file, for the characters of _PLAIN (fixed value).
_PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ]+")
_PLAIN = re.compile(r"[\x21-\x7eÀ-ÖØ-öø-ÿ]+")


def _byte_alphabet() -> dict[int, str]:
    """Byte-level BPE alphabet: printable Latin-1 bytes stand for themselves, the rest for code points from 256."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class ChunkCache(dict):
    """bytes of a chunk -> bytes of its uint32 ids. Two generations bound it; chunks over 64 bytes aren't kept."""

    def __init__(self, path: str, limit: int = 300_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer, self.limit, self.old = Tokenizer.from_file(path), limit, {}
        self.model, self.pieces, self.old_pieces = self.tokenizer.model, {}, {}
        alphabet = _byte_alphabet()
        self.alphabet = {b: alphabet[b] for b in range(256)}
        self.word_ends = self.tokenizer.encode("a b", add_special_tokens=False).tokens == ["a</w>", "b</w>"]

    def _piece(self, piece: str) -> bytes:
        out = self.pieces.get(piece)
        if out is None:
            out = self.old_pieces.get(piece)
            if out is None:
                shown = piece if piece.isascii() else "".join(map(self.alphabet.__getitem__, piece.encode()))
                out = b"".join([t.id.to_bytes(4, "little") for t in self.model.tokenize(shown)])
            if len(self.pieces) >= self.limit:
                self.old_pieces, self.pieces = self.pieces, {}
            self.pieces[piece] = out
        return out

    def _encode(self, chunk: bytes) -> bytes:
        text = chunk.decode("utf-8", "replace")
        if self.word_ends and len(chunk) < 64 and b"<|" not in chunk and _PLAIN.fullmatch(text):
            lower = text.lower()
            if lower.isalpha():
                return self._piece(lower)
            if lower[:-1].isalpha() and lower.isascii() and not lower[-1].isdigit():  # a word and one sign
                return self._piece(lower[:-1]) + self._piece(lower[-1])
            return b"".join(map(self._piece, _PIECES.findall(lower)))
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def __missing__(self, chunk: bytes) -> bytes:
        out = self.old.get(chunk)
        if out is None:
            out = self._encode(chunk)
        if len(chunk) < 64:
            if len(self) >= self.limit:
                self.old = dict(self)
                self.clear()
            self[chunk] = out
        return out

    def encode(self, text: bytes) -> bytes:
        """Little-endian uint32 ids of a UTF-8 text."""
        return b"".join(map(self.__getitem__, text.split()))


_CACHES: dict[str, ChunkCache] = {}


def encoder(path: str, limit: int = 300_000) -> ChunkCache:
    """One cache per tokenizer and Python worker, of ``limit`` words and as many older ones."""
    if path not in _CACHES:
        _CACHES[path] = ChunkCache(path, limit)
    _CACHES[path].limit = limit
    return _CACHES[path]
