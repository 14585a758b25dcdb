"""Words, hashes and small helpers shared by the operators of this package."""

from __future__ import annotations

import numpy as np
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The characters that separate words, and A-Z with its lower case.
SPACES = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_ODD, _MIX1, _MIX2 = (np.uint64(v) for v in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, every other character as it is."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def word_count(text: Column) -> Column:
    """Number of words (NULL text: 0) as a long."""
    squeezed = F.split(F.coalesce(text, F.lit("")), "[\\x20\\x09-\\x0D]+", -1)
    blank = F.array_size(squeezed) - F.when(F.get(squeezed, F.lit(0)) == "", 1).otherwise(0)
    last = F.when((F.array_size(squeezed) > 1) & (F.element_at(squeezed, -1) == ""), 1).otherwise(0)
    return (blank - last).cast("long")


def as_bytes(text: Column) -> Column:
    """UTF-8 bytes of a text (NULL: empty); Arrow hands them over undecoded."""
    return F.coalesce(text, F.lit("")).cast("binary")


def words(raw: bytes) -> list[bytes]:
    """Lower-cased (A-Z) words of UTF-8 bytes; ``bytes.split`` cuts at ``SPACES``."""
    return bytes(raw).lower().split()


def crc_rest(key: Column, parts: int) -> Column:
    """crc32 of a key's text modulo ``parts``; a NULL key counts as empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % parts


class WordHashes(dict):
    """64-bit hash of each word, kept for at most ``most`` words of a task."""

    def __init__(self, most: int = 1_000_000):
        super().__init__()
        self.most = most

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, tokens: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, tokens), np.uint64, len(tokens))


def mixed(h: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values."""
    h = (h ^ (h >> np.uint64(30))) * _MIX1
    h = (h ^ (h >> np.uint64(27))) * _MIX2
    return h ^ (h >> np.uint64(31))


def joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hash of the pair of two hashed values."""
    return mixed(left * _ODD + mixed(right + _MIX1))


def packed(values: np.ndarray) -> bytes:
    """An array as compressed bytes; sorted integers shrink to their gaps."""
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(values).tobytes())


def unpacked(raw: bytes, kind) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(bytes(raw)), kind)


def row_of(docs: DataFrame) -> Column:
    """All columns as one struct, so work columns cannot clash with them."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns])
