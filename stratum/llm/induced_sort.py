"""Suffix arrays by induced sorting, on numpy arrays: each bucket is filled and read as a whole.

Suffixes are S-type (smaller than their successor) or L-type. The leftmost S-type suffixes (LMS) are put into their
buckets, from which one scan up induces all L-type and one scan down all S-type suffixes; that sorts the substrings
between them, whose names make a text at most half as long. Its suffix array, found recursively, is the order of the LMS
suffixes, and inducing once more from it gives the whole array. A scan takes a bucket at a time: what its members induce
is dealt to the later buckets by one stable sort, and what falls into the bucket itself is the next round of it (as
many rounds as the longest run of one symbol).

A reduced text with few occurrences a name would make a scan of tiny buckets; there the recursion ends and ranks are
doubled instead. With a `depth`, suffixes need only be told apart by so many symbols, which bounds the doublings.
"""

from __future__ import annotations

import numpy as np

from stratum.llm.text import ragged, starts

#: A text is induced while each symbol stands so often on average.
_LEAST_MEAN_BUCKET = 64


def s_types(text: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the next one; the last one is larger than the empty suffix."""
    n = len(text)
    following = np.where(text[:-1] != text[1:], np.arange(n - 1), n - 1)
    following = np.minimum.accumulate(following[::-1])[::-1]  # where the run of equal symbols ends
    smaller = np.append(text[:-1] < text[1:], False)
    return np.append(smaller[following], False)


def _deal(buckets: list[list[np.ndarray]], members: np.ndarray, symbols: np.ndarray) -> None:
    if not len(members):
        return
    order = np.argsort(symbols, kind="stable")
    members, symbols = members[order], symbols[order]
    cut = (np.flatnonzero(symbols[1:] != symbols[:-1]) + 1).tolist()
    for a, b in zip([0, *cut], [*cut, len(members)]):
        buckets[symbols[a]].append(members[a:b])


def _joined(parts: list[np.ndarray]) -> np.ndarray:
    return np.concatenate(parts) if parts else np.zeros(0, np.int32)


def _rounds(buckets: list[list[np.ndarray]], symbol: int, before: np.ndarray) -> np.ndarray:
    """All members of a bucket, those among them that others of it induce included; the rest is dealt on."""
    front, rounds = _joined(buckets[symbol]), []
    while len(front):
        rounds.append(front)
        symbols = before[front]
        own = symbols == symbol
        on = (symbols >= 0) & ~own
        _deal(buckets, front[on] - 1, symbols[on])
        front = front[own] - 1
    return _joined(rounds)


def induced(text: np.ndarray, s_type: np.ndarray, lms: np.ndarray, n_symbols: int) -> np.ndarray:
    """All suffixes in the order that the given order of the LMS suffixes implies."""
    n = len(text)
    kind = np.int16 if n_symbols < 1 << 15 else np.int32
    before_l, before_s = np.full(n, -1, kind), np.full(n, -1, kind)  # the symbol before, where it begins such a suffix
    symbols = text[:-1].astype(kind)
    before_l[1:] = np.where(s_type[:-1], kind(-1), symbols)
    before_s[1:] = np.where(s_type[:-1], symbols, kind(-1))
    up: list[list[np.ndarray]] = [[] for _ in range(n_symbols)]
    given: list[list[np.ndarray]] = [[] for _ in range(n_symbols)]
    _deal(given, lms.astype(np.int32), text[lms])
    up[text[-1]].append(np.array([n - 1], np.int32))
    l_part = []
    for symbol in range(n_symbols):
        l_part.append(_rounds(up, symbol, before_l))
        members = _joined(given[symbol])
        _deal(up, members - 1, before_l[members])  # before an LMS suffix stands a larger symbol
    down: list[list[np.ndarray]] = [[] for _ in range(n_symbols)]
    out: list[np.ndarray] = []
    for symbol in range(n_symbols - 1, -1, -1):
        out.append(_rounds(down, symbol, before_s))
        last = l_part[symbol][::-1]
        symbols = before_s[last]
        _deal(down, last[symbols >= 0] - 1, symbols[symbols >= 0])
        out.append(last)
    return np.concatenate(out)[::-1]


def _names(text: np.ndarray, lms: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, int]:
    """(name of each LMS substring in text order, how many there are), from their sorted order (places in `lms`)."""
    ends = np.append(lms[1:] + 1, len(text))
    length = (ends - lms)[order]
    begin = lms[order]
    same = length[1:] == length[:-1]
    same[(order[1:] == len(lms) - 1) | (order[:-1] == len(lms) - 1)] = False  # the last one reaches the text's end
    pairs = np.flatnonzero(same)
    if len(pairs):
        size = length[pairs]
        differs = ragged(text, begin[pairs], size) != ragged(text, begin[pairs + 1], size)
        same[pairs] = ~np.logical_or.reduceat(differs, starts(size)[:-1])
    name = np.concatenate([[0], np.cumsum(~same)])
    out = np.empty(len(lms), np.int64)
    out[order] = name
    return out, int(name[-1]) + 1


def doubled(text: np.ndarray, depth: int | None = None) -> np.ndarray:
    """The suffix array by doubling ranks; equal in the first `depth` symbols, suffixes may stand in any order."""
    rank, width = text.astype(np.int64), 1
    while True:
        key = rank * (int(rank.max()) + 2)
        key[:-width] += rank[width:] + 1
        order = np.argsort(key, kind="stable")
        key = key[order]
        new = np.concatenate([[0], np.cumsum(key[1:] != key[:-1])])
        rank = np.empty(len(text), np.int64)
        rank[order] = new
        width *= 2
        if new[-1] == len(text) - 1 or width >= len(text) or depth is not None and width >= depth:
            return order


def suffix_array(text: np.ndarray, depth: int | None = None) -> np.ndarray:
    """The places of a text of small numbers, in the order of the suffixes that begin there."""
    n = len(text)
    if n < 2:
        return np.arange(n)
    kinds, dense = np.unique(text, return_inverse=True)
    if len(kinds) * _LEAST_MEAN_BUCKET > n:
        return doubled(dense, depth)
    if len(kinds) <= 1 << 8:
        dense = dense.astype(np.uint8)
    s_type = s_types(dense)
    lms = np.flatnonzero(s_type[1:] & ~s_type[:-1]) + 1
    if len(lms) > 1:
        place = np.full(n, -1, np.int32)
        place[lms] = np.arange(len(lms))
        order = place[induced(dense, s_type, lms, len(kinds))]
        names, n_names = _names(dense, lms, order[order >= 0])
        if n_names < len(lms):
            lms = lms[suffix_array(names, None if depth is None else depth // 2 + 1)]
        else:
            lms = lms[np.argsort(names)]
    return induced(dense, s_type, lms, len(kinds))


def common_prefixes(text: np.ndarray, order: np.ndarray, most: int) -> np.ndarray:
    """For each place of a text of bytes, how far its suffix agrees with the one before it in `order`, up to `most`.

    The permuted form: found in the order of the text, eight bytes at a time.
    """
    n = len(text)
    phi = np.full(n, -1, np.int64)
    phi[order[1:]] = order[:-1]
    padded = np.concatenate([text, np.zeros(most + 16, np.uint8)])
    words = np.ndarray(n + most + 8, "<u8", padded, strides=(1,))
    found = np.zeros(n, np.int64)
    at = np.flatnonzero(phi >= 0)
    for step in range(0, most, 8):
        odd = words[at + step] ^ words[phi[at] + step]
        low = np.bitwise_count((odd & -odd) - np.uint64(1)).astype(np.int64) >> 3  # equal bytes; 8 if none differs
        found[at] += np.where(odd == 0, 8, low)
        at = at[odd == 0]
    reach = n - np.maximum(np.arange(n), phi)
    return np.minimum(np.minimum(found, most), reach)
