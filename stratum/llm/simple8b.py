"""Simple-8b: as many integers as fit, all of one width, in each 64-bit word; vectorised both ways.

The top four bits of a word select (count, width); the other 60 bits hold the integers, the first one lowest. Every
block of `BLOCK` integers begins a new word, and the places where blocks begin are kept: all blocks are packed in step
with each other, and any of them can be read alone. Values that need more than 60 bits are escapes: the word stream
holds 0 for them, and their places and values stand apart.
"""

from __future__ import annotations

import numpy as np

#: Fixed values of the format: how many integers of how many bits, by selector.
SELECTORS = [
    (240, 0), (120, 0), (60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6),
    (8, 7), (7, 8), (6, 10), (5, 12), (4, 15), (3, 20), (2, 30), (1, 60),
]
_COUNTS = np.array([n for n, _ in SELECTORS])
BLOCK = 1024
_PAD = 240


def pack(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(words, where each block's words begin, places of escapes, escaped values)"""
    values = np.asarray(values, dtype=np.uint64)
    n, n_blocks = len(values), -(-len(values) // BLOCK)
    places = np.flatnonzero(values >> np.uint64(60))
    escaped = values[places]
    padded = np.zeros((n_blocks, BLOCK + _PAD), np.uint64)  # a block ends in zeros
    full = n // BLOCK
    padded[:full, :BLOCK] = values[: full * BLOCK].reshape(full, BLOCK)
    if full < n_blocks:
        padded[full, : n - full * BLOCK] = values[full * BLOCK :]
    padded[places // BLOCK, places % BLOCK] = 0
    high = np.frexp((padded >> np.uint64(30)).astype(np.float64))[1]
    bits = np.where(high > 0, high + 30, np.frexp((padded & np.uint64((1 << 30) - 1)).astype(np.float64))[1])
    widest, held = bits.astype(np.int8), 1  # the most bits of `held` values from each place on
    selector = np.full((n_blocks, BLOCK), len(SELECTORS) - 1, np.int8)
    for number in range(len(SELECTORS) - 2, -1, -1):
        count, width = SELECTORS[number]
        while held < count:
            step = min(held, count - held)
            widest, held = np.maximum(widest[:, :-step], widest[:, step:]), held + step
        selector[widest[:, :BLOCK] <= width] = number
    sizes = np.minimum(np.full(n_blocks, BLOCK), n - np.arange(n_blocks) * BLOCK)
    block, at, steps = np.arange(n_blocks), np.zeros(n_blocks, np.int64), []
    while len(block):
        steps.append((block, at))
        at = at + _COUNTS[selector[block, at]]
        going = at < sizes[block]
        block, at = block[going], at[going]
    block = np.concatenate([b for b, _ in steps]) if steps else np.zeros(0, np.int64)
    at = np.concatenate([a for _, a in steps]) if steps else np.zeros(0, np.int64)
    order = np.argsort(block, kind="stable")
    block, at = block[order], at[order]
    chosen = selector[block, at]
    words = chosen.astype(np.uint64) << np.uint64(60)
    flat, first = padded.ravel(), block * (BLOCK + _PAD) + at
    for number in np.unique(chosen):
        count, width = SELECTORS[number]
        if width:
            of, lane = np.flatnonzero(chosen == number), np.arange(count)
            words[of] |= np.bitwise_or.reduce(flat[first[of][:, None] + lane] << (lane * width).astype(np.uint64), axis=1)
    return words, np.searchsorted(block, np.arange(n_blocks)), places, escaped


def unpack(
    words: np.ndarray, offsets: np.ndarray, n: int, places: np.ndarray, escaped: np.ndarray
) -> np.ndarray:
    """The n integers of consecutive blocks; offsets: where the words of each begin."""
    chosen = (words >> np.uint64(60)).astype(np.int64)
    counts = _COUNTS[chosen]
    block = np.repeat(np.arange(len(offsets)), np.diff(np.append(offsets, len(words))))
    begins = np.cumsum(counts) - counts
    begins += block * (BLOCK + _PAD) - begins[offsets[block]]
    out = np.zeros(len(offsets) * (BLOCK + _PAD), np.uint64)
    for number in np.unique(chosen):
        count, width = SELECTORS[number]
        if width:
            of, lane = np.flatnonzero(chosen == number), np.arange(count)
            lanes = words[of][:, None] >> (lane * width).astype(np.uint64)
            out[begins[of][:, None] + lane] = lanes & np.uint64((1 << width) - 1)
    out = out.reshape(-1, BLOCK + _PAD)[:, :BLOCK].ravel()[:n]
    out[places] = escaped
    return out
