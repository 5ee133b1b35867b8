"""Elias-Fano sequences and an n-gram trie made of them, as numpy arrays over one flat buffer.

A monotone sequence keeps the low bits of each value as they are, packed, and the high bits as gaps in unary. A trie
level is a sequence of the ids below each node (made monotone by adding up the ranges before), one of the pointers to
where each node's range begins, and a byte per entry for its quantised probability. All arrays of a trie stand in one
buffer, so it can be read through a memory map without decoding it first.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

from stratum.llm.text import distinct

_STEPS, _FLOOR = 254, -7.0


def floor_of(largest: int) -> float:
    """A logarithm below all probabilities of a model whose most frequent word occurs so often, -7 at most.

    The least are a bigram that occurs once (half a share of its middle word) and what a context leaves to one more
    continuation (a share of twice its occurrences).
    """
    return min(_FLOOR, float(np.log10(0.25 / max(largest, 1))))


def quantised(p: np.ndarray, floor: float = _FLOOR) -> np.ndarray:
    """A byte per probability: even steps of its logarithm down to `floor`; 0 for none."""
    with np.errstate(divide="ignore"):
        at = np.rint((np.log10(p) / floor) * _STEPS)
    return np.where(p > 0, 255 - np.clip(at, 0, _STEPS), 0).astype(np.uint8)


@lru_cache(maxsize=1024)
def levels(floor: float = _FLOOR) -> np.ndarray:
    """The probability of each byte."""
    return np.concatenate([[0.0], 10 ** (floor * (255 - np.arange(1, 256)) / _STEPS)])


LEVELS = levels()


class EliasFano:
    """A sequence of values that never fall; random access and successor search, many at once."""

    _SKIP = 8

    def __init__(self, n: int, width: int, low: np.ndarray, high: np.ndarray):
        self.n, self.width, self.low, self.high = n, width, low, high
        self.ones: np.ndarray | None = None
        self.samples: np.ndarray | None = None

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        n = len(values)
        top = int(values[-1]) if n else 0
        width = min(56, max(0, int(top // n).bit_length() - 1)) if n and top else 0
        bits = (values[:, None] >> np.arange(width)) & 1
        low = np.packbits(bits.astype(np.uint8).ravel(), bitorder="little")
        gaps = np.zeros((top >> width) + n + 1, np.uint8)
        gaps[(values >> width) + np.arange(n)] = 1
        return cls(n, width, np.concatenate([low, np.zeros(8, np.uint8)]), np.packbits(gaps, bitorder="little"))

    def arrays(self) -> list[np.ndarray]:
        return [np.array([self.n, self.width], np.int64), self.low, self.high]

    def __getitem__(self, at: np.ndarray) -> np.ndarray:
        if self.ones is None:  # where the unary gaps end
            self.ones = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))
        high = self.ones[at] - at
        if not self.width:
            return high
        bit = at * self.width
        words = np.ndarray((len(self.low) - 7,), np.uint64, self.low, strides=(1,))  # eight bytes from any byte on
        low = (words[bit >> 3] >> (bit & 7).astype(np.uint64)) & np.uint64((1 << self.width) - 1)
        return (high << self.width) | low.astype(np.int64)

    def successor(self, values: np.ndarray) -> np.ndarray:
        """The first place whose value is not below each given one; n without any.

        Every eighth value is kept decoded; three more are looked at from there.
        """
        if not self.n:
            return np.zeros(len(values), np.int64)
        if self.samples is None:
            self.samples = self[np.arange(0, self.n, self._SKIP)]
        block = np.searchsorted(self.samples, values, side="left") - 1
        at = np.maximum(block, 0) * self._SKIP
        step = self._SKIP // 2
        while step:
            further = np.minimum(at + step, self.n - 1)
            at = np.where(self[further] < values, further, at)
            step //= 2
        return np.where(block < 0, 0, at + 1)

    def place(self, values: np.ndarray) -> np.ndarray:
        """Where each value stands; -1 for values that are not there."""
        at = self.successor(values)
        if not self.n:
            return at - 1
        found = self[np.minimum(at, self.n - 1)] == values
        return np.where(found & (at < self.n), at, -1)


class Level:
    """The ids below each node of the level above, in order; codes: a byte for each of them."""

    def __init__(self, pointers: EliasFano, ids: EliasFano, step: int, codes: np.ndarray):
        self.pointers, self.ids, self.step, self.codes = pointers, ids, step, codes

    @classmethod
    def of(cls, node: np.ndarray, ids: np.ndarray, n_nodes: int, codes: np.ndarray) -> Level:
        """node, ids: sorted pairs without repetition."""
        step = int(ids.max()) + 1 if len(ids) else 1
        pointers = np.searchsorted(node, np.arange(n_nodes + 1))
        return cls(EliasFano.of(pointers), EliasFano.of(node * step + ids), step, codes)

    def find(self, node: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """The place of each id below its node; -1 where there is none (also for node or id -1)."""
        known = (node >= 0) & (ids >= 0) & (ids < self.step)
        if known.all():
            return self.ids.place(node * self.step + ids)
        out = np.full(len(node), -1, np.int64)
        at = np.flatnonzero(known)
        out[at] = self.ids.place(node[at] * self.step + ids[at])
        return out

    def arrays(self) -> list[np.ndarray]:
        return [*self.pointers.arrays(), *self.ids.arrays(), np.array([self.step], np.int64), self.codes]


def _stored(arrays: list[np.ndarray]) -> bytes:
    """The arrays one after the other, each at a multiple of eight bytes behind its type and length."""
    out = []
    for a in arrays:
        out += [np.array([a.dtype.itemsize, len(a)], np.int64).tobytes(), a.tobytes(), bytes(-a.nbytes % 8)]
    return b"".join(out)


def _viewed(buffer) -> list[np.ndarray]:
    out, at, size = [], 0, len(buffer)
    while at < size:
        item, n = np.frombuffer(buffer, np.int64, 2, at).tolist()
        out.append(np.frombuffer(buffer, {1: np.uint8, 8: np.int64}[item], n, at + 16))
        at += 16 + n * item + -(n * item) % 8
    return out


class Trie:
    """Bigrams and trigrams by their middle word.

    Level 1: the middle words. Below each, the words that follow it with the probability that they do, and the words
    that stand before it with what such a context leaves to shorter ones. Below a pair of first and middle word, the
    third words by their places among the middle word's followers: small numbers, relative to the context.

    floor: the logarithm of the smallest probability that its bytes can tell, below all that it holds.
    """

    def __init__(self, middles: EliasFano, followers: Level, leaders: Level, thirds: Level, floor: float):
        self.middles, self.followers, self.leaders, self.thirds = middles, followers, leaders, thirds
        self.floor = floor

    @classmethod
    def build(
        cls, bigrams: np.ndarray, shares: np.ndarray, trigrams: np.ndarray, counts: np.ndarray, floor: float
    ) -> Trie:
        """bigrams: sorted (middle, third), shares: their probabilities; trigrams: sorted (middle, first, third), their
        counts; no logarithm of a probability is below the floor. A trigram's probability is smoothed after Witten and Bell: a context leaves as many shares as it has
        different continuations."""
        middles = distinct(np.concatenate([bigrams[:, 0], trigrams[:, 0]]))
        of_bigram, of_trigram = np.searchsorted(middles, bigrams[:, 0]), np.searchsorted(middles, trigrams[:, 0])
        step = int(max(bigrams[:, 1].max(initial=0), trigrams[:, 1:].max(initial=0))) + 1
        own, all_ = of_bigram * step + bigrams[:, 1], of_trigram * step + trigrams[:, 2]
        keys = distinct(np.concatenate([own, all_]))
        at_bigram = np.searchsorted(keys, own)
        first_of = np.searchsorted(keys // step, np.arange(len(middles)))
        rank = np.searchsorted(keys, all_) - first_of[of_trigram]

        own = of_trigram * step + trigrams[:, 1]
        new = np.flatnonzero(own[1:] != own[:-1]) + 1
        begin = np.concatenate([[0], new]) if len(own) else np.zeros(0, np.int64)
        contexts = own[begin]
        context = np.repeat(np.arange(len(begin)), np.diff(np.append(begin, len(own))))
        total = np.bincount(context, counts, len(contexts))
        kinds = np.bincount(context, minlength=len(contexts))
        left = kinds / np.maximum(total + kinds, 1)
        of_thirds = counts / (total + kinds)[context] if len(counts) else np.zeros(0)
        codes = np.zeros(len(keys), np.uint8)
        codes[at_bigram] = quantised(shares, floor)
        followers = Level.of(keys // step, keys % step, len(middles), codes)
        leaders = Level.of(contexts // step, contexts % step, len(middles), quantised(left, floor))
        thirds = Level.of(context, rank, len(contexts), quantised(of_thirds, floor))
        return cls(EliasFano.of(middles), followers, leaders, thirds, floor)

    def to_bytes(self) -> bytes:
        below = [self.followers, self.leaders, self.thirds]
        floor = np.array([self.floor]).view(np.int64)
        return _stored([*self.middles.arrays(), *(a for level in below for a in level.arrays()), floor])

    @classmethod
    def from_buffer(cls, buffer) -> Trie:
        arrays = iter(_viewed(buffer))

        def sequence() -> EliasFano:
            n, width = next(arrays).tolist()
            return EliasFano(n, width, next(arrays), next(arrays))

        def level() -> Level:
            return Level(sequence(), sequence(), int(next(arrays)[0]), next(arrays))

        return cls(sequence(), level(), level(), level(), float(next(arrays).view(np.float64)[0]))

    @staticmethod
    def _runs(*columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(where runs of equal rows begin, their lengths)"""
        n = len(columns[0])
        new = np.zeros(n, bool)
        new[:1] = True
        for column in columns:
            new[1:] |= column[1:] != column[:-1]
        begin = np.flatnonzero(new)
        return begin, np.diff(np.append(begin, n))

    def _middle(self, words: np.ndarray) -> np.ndarray:
        begin, length = self._runs(words)
        return np.repeat(self.middles.place(words[begin]), length)

    def bigram(self, middle: np.ndarray, third: np.ndarray) -> np.ndarray:
        """The code of each bigram's probability; 0 if it is not in the trie."""
        at = self.followers.find(self._middle(middle), third)
        return np.where(at >= 0, self.followers.codes[at], 0) if self.followers.ids.n else np.zeros(len(at), np.uint8)

    def trigram(self, first: np.ndarray, middle: np.ndarray, third: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(code of each trigram's probability or 0, code of what its context leaves or 0 if the context is not there)"""
        if not self.thirds.ids.n:
            return np.zeros(len(first), np.uint8), np.zeros(len(first), np.uint8)
        node = self._middle(middle)
        run, length = self._runs(node, first)
        context = np.repeat(self.leaders.find(node[run], first[run]), length)
        follower = self.followers.find(node, third)
        begin = self.followers.pointers[np.maximum(node, 0)]
        rank = np.where(follower >= 0, follower - begin, -1)
        at = self.thirds.find(context, rank)
        return (
            np.where(at >= 0, self.thirds.codes[at], 0).astype(np.uint8),
            np.where(context >= 0, self.leaders.codes[context], 0).astype(np.uint8),
        )
