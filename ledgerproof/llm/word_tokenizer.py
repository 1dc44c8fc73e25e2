"""Token ids of the public word-BPE vocabulary, with every distinct white-space chunk encoded once per worker.

The vocabulary's normaliser lower-cases and collapses white space, and its pre-tokeniser drops white space, so
no token crosses it: a text's ids are its chunks' ids joined. About nine chunks in ten repeat, which makes the
lookup several times faster than encoding whole texts. Ids equal ``Tokenizer.encode(text,
add_special_tokens=False)``; the tests compare them on random text.
"""

from __future__ import annotations

import gc
import re
import threading

import regex

from .common import hold_cache

#: Entries kept per worker before the cache starts anew (bounds memory; results do not depend on it).
CACHE_ENTRIES = 500_000

_SPECIAL = re.compile(r"<\|(?:startoftext|endoftext)\|>")
#: str.split() also splits at these four, the vocabulary's white space does not hold them.
_SEPARATORS = re.compile(r"[\x1c-\x1f]")
_PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")


def _byte_letters() -> list[str]:
    """Byte-level BPE writes a byte as a printable character: itself where printable, else from U+0100 on."""
    out, free = [], 256
    for b in range(256):
        if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255:
            out.append(chr(b))
        else:
            out.append(chr(free))
            free += 1
    return out


class WordTokenizer:
    """``encode(text)``: the ids as little-endian unsigned 16-bit bytes (the vocabulary has 49,408 entries)."""

    _made: dict[str, WordTokenizer] = {}
    _lock = threading.Lock()

    @classmethod
    def get(cls, path: str) -> WordTokenizer:
        """One per worker process and vocabulary."""
        with cls._lock:
            if path not in cls._made:
                cls._made[path] = cls(path)
            made = cls._made[path]
        hold_cache("word tokenizer", made.forget)
        return made

    def forget(self) -> None:
        self.chunks.clear()
        self.pieces.clear()
        gc.collect()

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.bpe = self.whole.model.tokenize
        self.normal = self.whole.normalizer.normalize_str
        self.letters = _byte_letters()
        self.chunks: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}

    def _piece(self, piece: str) -> bytes:
        key = piece if piece.isascii() and piece.isprintable() else "".join(
            [self.letters[b] for b in piece.encode("utf-8")])
        return b"".join([t.id.to_bytes(2, "little") for t in self.bpe(key)])

    def _chunk(self, chunk: str) -> bytes:
        plain = chunk.isascii() or (max(chunk) < "ɐ")  # below U+0250 text is in NFC and lower() is per letter
        text = chunk.lower() if plain else self.normal(chunk)
        found = []
        for piece in (text,) if text.isalpha() else _PIECES.findall(text):
            ids = self.pieces.get(piece)
            if ids is None:
                ids = self.pieces[piece] = self._piece(piece)
            found.append(ids)
        return b"".join(found)

    def _whole(self, text: str) -> bytes:
        ids = self.whole.encode(text, add_special_tokens=False).ids
        return b"".join([i.to_bytes(2, "little") for i in ids])

    def encode(self, text: str) -> bytes:
        if _SPECIAL.search(text) or _SEPARATORS.search(text):
            return self._whole(text)
        words = text.split()
        known = self.chunks
        found = list(map(known.get, words))
        if None in found:
            if len(known) > CACHE_ENTRIES:
                self.forget()
            for i, ids in enumerate(found):
                if ids is None:
                    word = words[i]
                    ids = known.get(word)
                    if ids is None:
                        ids = self._chunk(word)
                        if len(word) <= 64:
                            known[word] = ids
                    found[i] = ids
        return b"".join(found)
