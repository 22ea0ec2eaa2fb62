"""Word and word-window hashes of many texts at once, with numpy."""

from __future__ import annotations

from functools import cached_property

import numpy as np

_STEP = 0xD6E8FEB86659FD93 | 1
_SEEDS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)   # two hashes of a word
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit scrambling."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_spans(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each run of bytes other than blank, \\t to \\r."""
    inside = np.zeros(len(raw) + 2, bool)
    inside[1:-1] = ~_SPACE[raw]
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return edges[::2], edges[1::2]


def hash_words(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit hash of each word: its bytes, eight at a time, are scrambled into
    a running state, as block hashes do. Each step is a bijection of the state
    that no polynomial describes, so words built against one (Thue-Morse words
    against any base) don't meet; seeds give independent hashes."""
    eight = np.ndarray((len(raw) + 1,), "<u8", np.append(raw, np.zeros(8, np.uint8)).tobytes(), strides=(1,))
    length = ends - starts
    out = mix(length.astype(np.uint64) * np.uint64(_STEP) + np.uint64(_SEEDS[seed]))
    at, todo = 0, np.arange(len(starts))
    while len(todo):
        left = length[todo] - at
        bits = np.uint64(8) * (np.uint64(8) - np.minimum(left, 8).astype(np.uint64))
        part = eight[starts[todo] + at] << bits          # a short rest fills the high bytes
        state = mix(out[todo] ^ part) * np.uint64(_SEEDS[1 - seed]) + np.uint64(_SEEDS[seed])
        out[todo] = state ^ (state >> np.uint64(29))
        at += 8
        todo = todo[left > 8]
    return mix(out)


class Words:
    """Words of a list of texts: byte spans (in its own text), two hashes, and
    the first word of each text."""

    STEP = 1 << 20

    def __init__(self, texts: list[bytes]):
        starts, ends, hashes, counts = [], [], [], []
        self._parts = []
        k = 0
        while k < len(texts):
            size, j = 0, k
            while j < len(texts) and (j == k or size + len(texts[j]) < self.STEP):
                size += len(texts[j]) + 1
                j += 1
            raw = np.frombuffer(b"\n".join(texts[k:j]), np.uint8)
            s, e = word_spans(raw)
            hashes.append(hash_words(raw, s, e))
            self._parts.append((raw, s, e))
            base = np.cumsum([0] + [len(t) + 1 for t in texts[k:j]])
            at = np.searchsorted(s, base)
            counts.append(np.diff(at))
            shift = np.repeat(base[:-1], np.diff(at))
            starts.append(s - shift)
            ends.append(e - shift)
            k = j
        none = np.zeros(0, np.int64)
        self.start = np.concatenate(starts) if starts else none
        self.end = np.concatenate(ends) if ends else none
        self.hash = np.concatenate(hashes) if hashes else none.astype(np.uint64)
        self.count = np.concatenate(counts) if counts else none
        self.first = np.concatenate([[0], np.cumsum(self.count)]).astype(np.int64)
        self.doc = np.repeat(np.arange(len(self.count)), self.count)

    @cached_property
    def second(self) -> np.ndarray:
        """The words' second hashes, made when first asked for."""
        return np.concatenate([np.zeros(0, np.uint64), *(hash_words(*p, 1) for p in self._parts)])

    def window_starts(self, size: int) -> np.ndarray:
        """Is there a window of ``size`` words of one text from each word on?"""
        left = self.first[self.doc + 1] - np.arange(len(self.doc))
        return left >= size

    def windows(self, size: int, seed: int = 0) -> np.ndarray:
        """Hash of the ``size`` words from each word on (meaningless where
        :meth:`window_starts` is false); seed 1 is from the second word hashes."""
        words = self.second if seed else self.hash
        out = np.zeros(len(words), np.uint64)
        factor = 1
        for j in range(size):
            n = len(out) - j
            if n <= 0:
                break
            out[:n] += words[j:] * np.uint64(factor)
            factor = factor * (_STEP + 2 * seed) % (1 << 64)
        return mix(out + np.uint64(seed))
