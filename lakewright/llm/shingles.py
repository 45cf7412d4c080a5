"""Words and word shingles of texts, as 64-bit hashes that are the same in every process."""

from __future__ import annotations

import numpy as np
import xxhash

WIDTH = 5

#: Hashes of words that a worker remembers before it starts anew. Workers live on in later stages, with
#: what they remember: some 200 bytes a word.
REMEMBERED = 50_000


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > REMEMBERED:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_word_hashes = _WordHashes()
_STEP = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str | None) -> list[bytes]:
    """Runs of anything but ASCII white space, A-Z lower-cased, as UTF-8."""
    return text.encode("utf-8", "replace").lower().split() if text else []


def mixed(h: np.ndarray) -> np.ndarray:
    """The finalizer of a 64-bit hash: every bit of the input changes half of the output's."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def shingle_hashes(words: list[bytes], width: int = WIDTH) -> np.ndarray:
    """One hash for each place where ``width`` words begin; fewer words give one for all of them."""
    if not words:
        return np.zeros(0, np.uint64)
    width = min(width, len(words))
    w = np.fromiter(map(_word_hashes.__getitem__, words), np.uint64, len(words))
    n = len(words) - width + 1
    h = w[:n].copy()
    for j in range(1, width):
        h = h * _STEP + w[j:j + n]
    return mixed(h)


def shingle_texts(words: list[bytes], width: int = WIDTH) -> set[bytes]:
    """The distinct shingles themselves, for exact comparison."""
    width = min(width, len(words))
    return {b" ".join(words[i:i + width]) for i in range(len(words) - width + 1)} if words else set()
