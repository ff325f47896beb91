"""Word shingles of a text as a sorted set of 64-bit hashes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

WORDS = 5
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
CACHED_WORDS = 200_000


def mix(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values so that every bit depends on all."""
    values = values ^ (values >> np.uint64(30))
    values *= np.uint64(0xBF58476D1CE4E5B9)
    values ^= values >> np.uint64(27)
    values *= np.uint64(0x94D049BB133111EB)
    values ^= values >> np.uint64(31)
    return values


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The hash of each word of all texts, one after another, and how many each text has.

    Words and hashes are those of ``Shingler``; each distinct word is hashed once.
    """
    parts = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    sizes = pc.list_value_length(parts).to_numpy(zero_copy_only=False).astype(np.int64)
    coded = parts.flatten().dictionary_encode()
    words = coded.dictionary
    numbers = coded.indices.to_numpy(zero_copy_only=False)
    ends = np.frombuffer(words.buffers()[1], np.int32)[words.offset:words.offset + len(words) + 1].tolist()
    raw, digest = memoryview(words.buffers()[2] or b""), xxhash.xxh3_64_intdigest
    hashes = np.fromiter((digest(raw[a:b]) for a, b in zip(ends, ends[1:])), np.uint64, len(words))
    blank = words.index("").as_py()  # white space at either end of a text leaves an empty part
    if blank >= 0:
        filled = numbers != blank
        sizes = np.bincount(np.repeat(np.arange(len(sizes)), sizes)[filled], minlength=len(sizes))
        numbers = numbers[filled]
    return hashes[numbers], sizes


class Shingler:
    """Shingle sets of texts: words are lower-cased (A-Z) runs without ASCII white space."""

    def __init__(self):
        self._known: dict[bytes, int] = {}

    def words(self, text: str) -> np.ndarray:
        """A hash of each word."""
        return self.words_of(text.encode().lower())

    def words_of(self, text: bytes) -> np.ndarray:
        """A hash of each word of lower-cased bytes."""
        known = self._known
        if len(known) > CACHED_WORDS:
            known.clear()
        words = text.split()
        for word in words:
            if word not in known:
                known[word] = xxhash.xxh3_64_intdigest(word)
        return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))

    def set_of(self, text: str) -> np.ndarray:
        """The distinct shingles, ascending; with fewer words the whole sequence is one."""
        words = self.words(text)
        if not len(words):
            return words
        width = min(WORDS, len(words))
        value = np.zeros(len(words) - width + 1, np.uint64)
        for shift in range(width):
            value = mix(value * _MULTIPLIER + words[shift:shift + len(value)])
        return np.unique(value + np.uint64(width))
