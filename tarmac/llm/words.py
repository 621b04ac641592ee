"""Words and their hashes, whole texts at a time, inside tasks."""

from __future__ import annotations

import numpy as np
import xxhash

LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
MAX_WORDS = 200_000  # words a worker remembers twice over
_ODD = np.uint64(0x9E3779B97F4A7C15)


class WordHashes(dict):
    """Word -> 64-bit hash, remembered in two bounded generations."""

    def __init__(self, limit: int = MAX_WORDS):
        super().__init__()
        self.limit, self.old = limit, {}

    def __missing__(self, word: bytes) -> int:
        value = self.old.get(word)
        if value is None:
            value = xxhash.xxh3_64_intdigest(word)
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        self[word] = value
        return value


_HASHES = WordHashes()


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_HASHES.__getitem__, words), dtype=np.uint64, count=len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads every bit (the splitmix64 finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BASE = 0xD1342543DE82EF95  # odd, hence invertible modulo 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    if n:
        out[0] = 1
        np.multiply.accumulate(out, out=out)
    return out


class RunHashes:
    """Hash of any run of consecutive words, from sums of ``hash * base**position`` modulo 2**64."""

    def __init__(self, hashes: np.ndarray):
        n = len(hashes)
        self.n = n
        self.sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(hashes * _powers(_BASE, n), out=self.sums[1:])
        self.back = _powers(_INVERSE, n + 1)

    def of(self, starts: np.ndarray, lengths: np.ndarray | int) -> np.ndarray:
        raw = (self.sums[starts + lengths] - self.sums[starts]) * self.back[starts]
        return mix(raw + np.asarray(lengths).astype(np.uint64) * _ODD)

    def all(self, length: int) -> np.ndarray:
        """The hashes of every run of ``length`` words."""
        return self.of(np.arange(max(0, self.n - length + 1)), length)
