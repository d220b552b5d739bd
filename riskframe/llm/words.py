"""Word splitting and hashing on UTF-8 bytes.

Bytes from 0x80 up belong to letters beyond ASCII, so byte classes give the
same words as the code-point classes they stand for, without decoding.
"""

from __future__ import annotations

import numpy as np
import xxhash

#: a-z, 0-9 and everything beyond ASCII stay, A-Z are lower-cased, the rest separates.
ALNUM = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
              for c in range(256))
U64 = np.uint64


def alnum_words(text: bytes | None) -> list[bytes]:
    """Lower-cased runs of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]``."""
    return text.translate(ALNUM).split() if text else []


def char_starts(text: bytes) -> np.ndarray:
    """Code points before every byte offset 0..len (inclusive)."""
    b = np.frombuffer(text, np.uint8)
    out = np.zeros(len(b) + 1, np.int64)
    np.cumsum((b & 0xC0) != 0x80, out=out[1:])
    return out


class WordHash(dict):
    """Word -> 64-bit hash, remembered for a bounded number of words."""

    LIMIT = 1_000_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


_HASHES = WordHash()


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.array(list(map(_HASHES.__getitem__, words)), dtype=U64)


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (xor-shift and multiply)."""
    x = x ^ (x >> U64(33))
    x = x * U64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> U64(33))
    x = x * U64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U64(33))


def occurrence(codes: np.ndarray) -> np.ndarray:
    """0 for the first position with a code, 1 for the second, ..."""
    n = len(codes)
    if n == 0:
        return np.zeros(0, np.int64)
    order = np.argsort(codes, kind="stable")
    s = codes[order]
    start = np.zeros(n, np.int64)
    start[1:] = np.where(s[1:] != s[:-1], np.arange(1, n), 0)
    np.maximum.accumulate(start, out=start)
    out = np.empty(n, np.int64)
    out[order] = np.arange(n) - start
    return out
