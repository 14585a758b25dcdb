"""Rising whole numbers in few bits, and a trie level made of them.

A sequence of n numbers below u keeps the low log2(u / n) bits of each number
and the high parts as gaps in unary. Everything lies in one buffer, which may be
a memory-mapped file: reading a range decodes only that range.
"""

from __future__ import annotations

import struct

import numpy as np

_SAMPLE = 512  # ones of the upper bits between two samples


class EliasFano:
    """A rising sequence, mapped from a buffer."""

    def __init__(self, buffer, start: int = 0):
        self.n, self.low_bits, low_bytes, high_bytes = struct.unpack_from("<qqqq", buffer, start)
        samples = self.n // _SAMPLE + 1
        at = start + 32
        self.samples = np.frombuffer(buffer, "<i8", samples, at)
        at += 8 * samples
        self.low = np.frombuffer(buffer, np.uint8, low_bytes, at)
        at += low_bytes
        self.high = np.frombuffer(buffer, np.uint8, high_bytes, at)
        self.end = at + high_bytes

    @staticmethod
    def encode(values: np.ndarray) -> bytes:
        values = values.astype(np.uint64)
        n = len(values)
        top = int(values[-1]) + 1 if n else 1
        low_bits = max(0, (top // max(n, 1)).bit_length() - 1)
        low = b""
        if low_bits and n:
            width = np.arange(low_bits, dtype=np.uint64)
            low = b"".join(
                np.packbits(((values[a : a + 65_536, None] >> width) & np.uint64(1)).astype(np.uint8).ravel(), bitorder="little").tobytes()
                for a in range(0, n, 65_536)
            )
        ones = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        bits = np.zeros(int(ones[-1]) + 1 if n else 0, np.uint8)
        bits[ones] = 1
        high = np.packbits(bits, bitorder="little").tobytes()
        samples = np.zeros(n // _SAMPLE + 1, "<i8")
        samples[: len(ones[::_SAMPLE])] = ones[::_SAMPLE]
        pad = b"\0" * (-(len(low) + len(high)) % 8)
        return struct.pack("<qqqq", n, low_bits, len(low), len(high) + len(pad)) + samples.tobytes() + low + high + pad

    def slice(self, a: int, b: int) -> np.ndarray:
        """Numbers a..b-1, decoded from their own stretch of the buffer."""
        if a >= b:
            return np.empty(0, np.uint64)
        sample = a // _SAMPLE
        first = int(self.samples[sample])
        last = int(self.samples[-(-b // _SAMPLE)]) if -(-b // _SAMPLE) < len(self.samples) and -(-b // _SAMPLE) * _SAMPLE < self.n else 8 * len(self.high)
        bits = np.unpackbits(self.high[first // 8 : last // 8 + 1], bitorder="little")
        ones = np.flatnonzero(bits) + first // 8 * 8
        skip = int(np.searchsorted(ones, first)) + a - sample * _SAMPLE
        high = (ones[skip : skip + b - a] - np.arange(a, b)).astype(np.uint64)
        if not self.low_bits:
            return high
        begin, stop = a * self.low_bits, b * self.low_bits
        raw = np.unpackbits(self.low[begin // 8 : -(-stop // 8)], bitorder="little")[begin % 8 : begin % 8 + stop - begin]
        rows = raw.reshape(-1, self.low_bits)
        low = np.zeros(b - a, np.uint64)
        for k in range(self.low_bits):
            low |= rows[:, k].astype(np.uint64) << np.uint64(k)
        return (high << np.uint64(self.low_bits)) | low


class Level:
    """One level of the trie: contexts, where the children of each begin, the
    children as ranks among the words of the shard, and quantised values.

    Contexts and words are rising; pointers never fall; the children of a
    context rise, and adding the number of words for each context before makes
    the whole row of children rise. All four are ``EliasFano``.
    """

    def __init__(self, buffer):
        self.parts = []
        at = 16
        self.floor, self.step = struct.unpack_from("<dd", buffer, 0)
        for _ in range(4):
            self.parts.append(EliasFano(buffer, at))
            at = self.parts[-1].end
        self.contexts, self.words, self.pointers, self.children = self.parts
        self.codes = np.frombuffer(buffer, np.uint8, self.children.n, at)

    @staticmethod
    def encode(contexts: np.ndarray, words: np.ndarray, context_at: np.ndarray, word_at: np.ndarray, values: np.ndarray) -> bytes:
        """Children sorted by (context, word), with log10 values below 0."""
        pointers = np.searchsorted(context_at, np.arange(len(contexts) + 1))
        children = context_at.astype(np.uint64) * np.uint64(max(len(words), 1)) + word_at.astype(np.uint64)
        floor = float(values.min()) if len(values) else 0.0
        step = (float(values.max()) - floor) / 255 if len(values) else 0.0
        codes = np.rint((values - floor) / step) if step > 0 else np.zeros(len(values))
        return b"".join(
            [
                struct.pack("<dd", floor, step),
                *(EliasFano.encode(x) for x in (contexts, words, pointers, children)),
                codes.astype(np.uint8).tobytes(),
            ]
        )

    def value(self, codes: np.ndarray) -> np.ndarray:
        return self.floor + self.step * codes

    def find(self, contexts: np.ndarray, words: np.ndarray, chunk: int = 65_536) -> np.ndarray:
        """Place of each (context, word) among the children, -1 without one.

        Queries are sorted by context. Stretches of contexts are decoded one
        after the other; a child is the successor of (context, word) inside the
        range that the context's pointers give.
        """
        out = np.full(len(contexts), -1, np.int64)
        all_words = self.words.slice(0, self.words.n)
        if not len(all_words):
            return out
        w = np.searchsorted(all_words, words)
        known = (w < len(all_words)) & (all_words[np.minimum(w, len(all_words) - 1)] == words)
        for a in range(0, self.contexts.n, chunk):
            b = min(a + chunk, self.contexts.n)
            own = self.contexts.slice(a, b)
            begin, stop = np.searchsorted(contexts, own[0]), np.searchsorted(contexts, own[-1], "right")
            if begin == stop:
                continue
            pointers = self.pointers.slice(a, b + 1).astype(np.int64)
            children = self.children.slice(int(pointers[0]), int(pointers[-1]))
            c = np.searchsorted(own, contexts[begin:stop])
            asked = np.uint64(len(all_words)) * (c + a).astype(np.uint64) + w[begin:stop].astype(np.uint64)
            successor = np.searchsorted(children, asked)
            hit = known[begin:stop] & (own[np.minimum(c, len(own) - 1)] == contexts[begin:stop])
            hit &= (successor < len(children)) & (children[np.minimum(successor, len(children) - 1)] == asked)
            out[begin:stop] = np.where(hit, successor + pointers[0], -1)
        return out
