"""Vectorised 64-bit hashing of bytes and words inside tasks."""

from __future__ import annotations

import numpy as np

U = np.uint64
BASE = U(0x9E3779B97F4A7C15 | 1)
BASE_INVERSE = U(pow(int(BASE), -1, 1 << 64))
BLANK = np.zeros(256, bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer that spreads every input bit over the whole word."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


#: A random-looking number per byte value.
BYTE_CODES = mix(np.arange(1, 257, dtype=np.uint64) * U(0xD1342543DE82EF95))


class Powers:
    """base**i and base**-i modulo 2**64, as far as any text needed them."""

    def __init__(self, base: np.uint64 = BASE):
        self.base, self.inverse = base, U(pow(int(base), -1, 1 << 64))
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) <= n:
            size = max(n + 1, 2 * len(self.up), 1 << 16)
            table = lambda b: np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size - 1, b, np.uint64)]))
            self.up, self.down = table(self.base), table(self.inverse)
        return self.up, self.down


POWERS = Powers()


class Prefix:
    """Content hashes of any ranges of a buffer, from one prefix sum; ``codes`` is None where it holds codes itself."""

    def __init__(self, data: np.ndarray, powers: Powers = POWERS, codes: np.ndarray | None = BYTE_CODES):
        up, self.down = powers.upto(len(data))
        values = data if codes is None else codes[data]
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * up[: len(data)])])

    def ranges(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hash of start..end-1 of each range; equal content gives equal hashes."""
        content = (self.sums[end] - self.sums[start]) * self.down[start]
        return mix(content + (end - start).astype(np.uint64) * U(0xA24BAED4963EE407))


def word_bounds(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte of every word, and the byte after it."""
    blank = np.concatenate([[True], BLANK[data], [True]])
    edges = np.flatnonzero(blank[1:] != blank[:-1])
    return edges[0::2], edges[1::2]


def words_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of the texts in turn, and the number of words of each text."""
    encoded = [t.encode("utf-8", "surrogatepass") for t in texts]
    data = np.frombuffer(b"\n".join([b"", *encoded, b""]), np.uint8)
    blank = BLANK[data]
    edges = np.flatnonzero(blank[1:] != blank[:-1]) + 1
    start, end = edges[0::2], edges[1::2]
    limits = np.cumsum([len(e) + 1 for e in encoded])
    return Prefix(data).ranges(start, end), np.bincount(np.searchsorted(limits, start), minlength=len(texts))


def shingles_of(texts: list[str], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every run of ``width`` words, and the text it belongs to, in order.

    A text with fewer words, but at least one, has the one shingle of all its words.
    """
    words, counts = words_of(texts)
    if not len(words):
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    first = np.cumsum(counts) - counts
    text = np.repeat(np.arange(len(texts)), counts)
    left = np.repeat(first + counts, counts) - np.arange(len(words))  # words from here to the text's end
    total = np.zeros(len(words), np.uint64)
    padded = np.concatenate([words, np.zeros(width, np.uint64)])
    for k in range(width):
        total += np.where(left > k, padded[k : k + len(words)], U(0)) * U(2 * (0x632BE59BD9B4E019 * (k + 1) % (1 << 62)) + 1)
    keep = (left >= width) | (np.arange(len(words)) == first[text])
    return mix(total[keep]), text[keep]
