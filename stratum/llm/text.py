"""Words of Arrow text columns, without a Python object per word occurrence.

The separators of every word definition used here are ASCII, so one byte translation of the UTF-8 buffer lower-cases
A-Z and turns each separator into a space. Splitting and dictionary encoding then run inside Arrow; only the distinct
words of a batch become Python strings.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_A_TO_Z = range(0x41, 0x5B)
#: Words `[^\x20\x09-\x0D]+`.
SPACES = frozenset([0x20, *range(0x09, 0x0E)])
#: Words `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`: ASCII letters (after lower-casing) and digits, and all that is not ASCII.
PUNCTUATION = frozenset([*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])


def table(separators: frozenset[int], lower: bool = True) -> bytes:
    return bytes(0x20 if b in separators else b + 32 if lower and b in _A_TO_Z else b for b in range(256))


def chunks(
    batches: Iterator[pa.RecordBatch],
    text: str = "text",
    most: int = 3 << 20,
    forget: Callable[[], None] | None = None,
) -> Iterator[pa.RecordBatch]:
    """The same rows in pieces of about `most` bytes of text, a single longer text alone; so memory stays bounded.

    After the last one, the worker forgets what it kept between pieces and gives freed memory back: others on its
    machine need it before its next task.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes.astype(np.int64))
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + most, side="right")))
            yield batch.slice(start, stop - start)
            start = stop
    if forget is not None:
        forget()
    give_back()


def give_back() -> None:
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
    if trim is not None:
        trim(0)


def translated(column: pa.Array, mapping: bytes) -> pa.Array:
    """The texts with every byte mapped; null becomes empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    own = bytes(memoryview(data)[offsets[0] : offsets[-1]]) if data else b""  # a slice shares its column's buffers
    moved = pa.py_buffer((offsets - offsets[0]).tobytes())
    return pa.LargeStringArray.from_buffers(len(column), moved, pa.py_buffer(own.translate(mapping)))


def encode_words(column: pa.Array, mapping: bytes | None = None) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(words per row, code of every word in order, distinct words). A null text has no words.

    Without a mapping the texts are those of `translated`: only blanks part their words.
    """
    if not len(column):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), pa.array([], pa.large_string())
    lists = pc.split_pattern(translated(column, mapping) if mapping else column, " ")
    encoded = lists.values.dictionary_encode()
    codes = encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    ends = lists.offsets.to_numpy()
    words = encoded.dictionary
    blank = pc.index(words, "").as_py()
    kept = np.ones(len(codes), bool) if blank < 0 else codes != blank
    before = np.concatenate([[0], np.cumsum(kept)])
    return np.diff(before[ends]), codes[kept], words


def starts(lengths: np.ndarray) -> np.ndarray:
    """Where each of the consecutive runs begins, and the end of the last."""
    return np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)


def ragged(pool: np.ndarray, begin: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The runs pool[begin[i] : begin[i] + length[i]], one after the other."""
    out = starts(length)
    return pool[np.repeat(begin - out[:-1], length) + np.arange(out[-1])]


def distinct(values: np.ndarray) -> np.ndarray:
    """The distinct values, sorted."""
    values = np.sort(values)
    return values[np.concatenate([[True], values[1:] != values[:-1]])] if len(values) else values
