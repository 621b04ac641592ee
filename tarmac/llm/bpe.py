"""Byte-level BPE ids of whole texts, by the ``tokenizers`` library.

Byte-level BPE never merges across the pieces of its pre-tokenizer, so a text
is cut into those pieces, each distinct piece is encoded once per worker by the
library's model, and the ids are joined.  The cut covers the characters below
U+0250, whose classes all Unicode versions agree on; a text with any other
character, or with the string of a special token, goes to the library whole.
Either way the ids are the library's own for the whole text.
"""

from __future__ import annotations

import os
import re
import unicodedata
from array import array
from functools import lru_cache

import numpy as np

MAX_PIECES = 250_000  # pieces a worker remembers twice over; a forgotten one is encoded again


def default_path() -> str:
    """The 50k byte-level vocabulary of the installed ``public_tokenizers``."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _char_class(kind: str) -> str:
    return "".join(re.escape(chr(c)) for c in range(0x250) if unicodedata.category(chr(c))[0] == kind)


_L, _N, _S = _char_class("L"), _char_class("N"), "\t\n\x0b\x0c\r \x85\xa0"
# The byte-level pre-tokenizer's alternatives, for characters below U+0250.
_PIECES = re.compile(
    rf" ?[{_L}]+|'(?:[stmd]|re|ve|ll)| ?[{_N}]+| ?[^{_S}{_L}{_N}]+|[{_S}]+(?![^{_S}])|[{_S}]+"
)
_BEYOND = re.compile("[^\x00-ɏ]")


def _byte_letters() -> dict[int, int]:
    """Byte -> the character that stands for it in a byte-level vocabulary: itself if printable, else one from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [b for b in range(256) if b not in plain]
    return {**{b: b for b in plain}, **{b: 0x100 + i for i, b in enumerate(others)}}


class _PieceIds(dict):
    """Piece -> packed ids; two generations, so that the memory is bounded and frequent pieces stay."""

    def __init__(self, model, code: str, limit: int):
        super().__init__()
        self.model, self.code, self.limit, self.old = model, code, limit, {}
        self.letters = _byte_letters()

    def __missing__(self, piece: str) -> bytes:
        ids = self.old.get(piece)
        if ids is None:
            if piece.isascii():
                spelled = piece.translate(self.letters)
            else:
                spelled = piece.encode("utf-8").decode("latin-1").translate(self.letters)
            ids = array(self.code, [t.id for t in self.model.tokenize(spelled)]).tobytes()
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        self[piece] = ids
        return ids


class Encoder:
    """``encode`` gives little-endian ids of type ``dtype``: 16 bits where the vocabulary allows it, else 32.  ``plain``
    takes special tokens' strings for ordinary text."""

    def __init__(self, path: str, max_pieces: int = MAX_PIECES, plain: bool = False):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.lib = Tokenizer.from_file(path)
        self.lib.encode_special_tokens = plain
        self.dtype = np.dtype("<u2" if self.lib.get_vocab_size() <= 1 << 16 else "<u4")
        self.special = [] if plain else [t.content for t in self.lib.get_added_tokens_decoder().values()]
        self.pieces = _PieceIds(self.lib.model, "H" if self.dtype.itemsize == 2 else "I", max_pieces)

    def covers(self, text: str) -> bool:
        """Whether the cut into pieces holds for the text."""
        return not (not text.isascii() and _BEYOND.search(text) or any(s in text for s in self.special))

    def cut(self, text: str) -> list[str]:
        return _PIECES.findall(text)

    def n_pieces(self, text: str) -> int:
        """Pieces of any text; beyond the cut, the library's own and its special tokens."""
        if self.covers(text):
            return len(self.cut(text))
        parts = re.split("|".join(map(re.escape, sorted(self.special, key=len, reverse=True))), text) if self.special else [text]
        return len(parts) - 1 + sum(len(self.lib.pre_tokenizer.pre_tokenize_str(p)) for p in parts)

    def count(self, text: str) -> int:
        return len(self.encode(text)) // self.dtype.itemsize

    def counts(self, pieces: list[str]) -> list[int]:
        width = self.dtype.itemsize
        return [len(self.pieces[p]) // width for p in pieces]

    def encode(self, text: str) -> bytes:
        if not self.covers(text):
            return np.array(self.lib.encode(text, add_special_tokens=False).ids, dtype=self.dtype).tobytes()
        return b"".join(map(self.pieces.__getitem__, _PIECES.findall(text)))

    def pack(self, token: int) -> bytes:
        return np.array([token], dtype=self.dtype).tobytes()


@lru_cache(maxsize=4)
def encoder(path: str, max_pieces: int = MAX_PIECES) -> Encoder:
    """One encoder per worker process, vocabulary file and number of pieces remembered."""
    return Encoder(path, max_pieces)


@lru_cache(maxsize=4)
def plain_encoder(path: str) -> Encoder:
    return Encoder(path, plain=True)


def token_bytes(path: str) -> dict[int, bytes]:
    """The bytes that each id stands for."""
    from tokenizers import Tokenizer

    lib = Tokenizer.from_file(path)
    letters = {chr(c): b for b, c in _byte_letters().items()}
    special = {i for i, t in lib.get_added_tokens_decoder().items()}
    return {i: t.encode("utf-8") if i in special else bytes(letters[c] for c in t) for t, i in lib.get_vocab().items()}


class Decoder:
    """Ids back to text: the bytes that each id stands for, joined."""

    def __init__(self, path: str):
        self.bytes = token_bytes(path)

    def decode(self, ids) -> str:
        return b"".join(map(self.bytes.__getitem__, ids)).decode("utf-8")


@lru_cache(maxsize=4)
def decoder(path: str) -> Decoder:
    return Decoder(path)
