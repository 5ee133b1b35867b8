"""Removal of repeated passages by suffix arrays of shards.

A byte goes when a string of LENGTH bytes covers it that also starts in a document of a smaller doc_id.

1. Texts are stored in compressed blocks of a bounded size. In each string of LENGTH bytes (a window) the least hash of
   its GRAM-byte pieces is its anchor, so equal windows have equal anchors wherever they stand. Each block sends the
   hashes of its anchors, once each, to the bucket of their range, which answers with those that another document has.
2. For these only, the run of windows of one anchor is cut out as a snippet (at most 2 * LENGTH - GRAM bytes). Equal
   snippets of a block are one, of the smallest doc_id: the windows of all larger ones repeat it. What is left goes to
   the shard of its anchor. An anchor with very many different surroundings sends its windows one by one to the shards
   of their contents instead, so no anchor fills a shard.
3. A shard sorts its snippets by induced sorting (`induced_sort`). Windows that follow one another in the suffix array
   with a common prefix of LENGTH bytes are equal; each class knows its smallest doc_id, and the windows of larger ones
   are hits.
4. The hits return to their blocks, where the bytes that they cover are cut out.

Hashes only choose what is compared: a removal always rests on equal bytes. Memory is bounded by the block (or the one
longer text in it), and by the bucket, whose number grows with the text.

Null and empty texts have no bytes; texts below LENGTH bytes lose nothing. Rows that share a doc_id don't repeat one
another. A row without a doc_id is returned whole, and removes nothing from others. An empty table gives no rows; other
columns are not read.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.llm.induced_sort import common_prefixes, suffix_array
from stratum.llm.text import give_back, ragged, starts
from stratum.sources.scratch import materialize, new_folder

LENGTH = 50
GRAM = 24
BLOCK_BYTES = 12 << 20
BUCKET_BYTES = 32 << 20  # of text, for each bucket of anchors
SHARD_BYTES = 1 << 20  # of snippets, for each suffix array
#: Runs of one anchor, counted by 16 a block and more, from which its windows are sent one by one.
HOT_RUNS = 1 << 14
_COUNTED = 16
_SEGMENT = 1 << 18
_ROW_BYTES = 64  # what a row counts besides its text
_RUNS = 1 << 14  # worked on at a time where each takes many bytes
_BASE = 0x9E3779B97F4A7C15
_HIGH, _LOW = np.uint64(0xFFFFFFFF00000000), np.uint64(0xFFFFFFFF)
_BLOCKS = "block long, ids binary, named binary, lengths binary, packed binary, n_bytes long"
_KINDS = "kind int, block long, bucket int, keys binary, sizes binary, ids binary, content binary, begins binary, codes binary, goes binary"


def ragged_places(begin: np.ndarray, length: np.ndarray) -> np.ndarray:
    """begin[i], begin[i] + 1, ... of `length` places each."""
    out = starts(length)
    return np.repeat(begin - out[:-1], length) + np.arange(out[-1])


def _packed(values: np.ndarray | bytes, level: int = 3) -> bytes:
    """Compressed, with the size before."""
    raw = values if isinstance(values, bytes) else values.tobytes()
    return len(raw).to_bytes(8, "little") + pa.Codec("zstd", level).compress(raw, asbytes=True)


def _raw(packed: bytes) -> bytes:
    size = int.from_bytes(packed[:8], "little")
    return pa.decompress(memoryview(packed)[8:], size, "zstd", asbytes=True) if size else b""


def _unpacked(packed: bytes, kind: type) -> np.ndarray:
    return np.frombuffer(_raw(packed), kind)


def _mixed(values: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


_BYTES = _mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE % 2**63))


def piece_hashes(data: np.ndarray, length: int) -> np.ndarray:
    """A hash of the `length` bytes that begin at each place, by doubling."""
    value, width = _BYTES[data], 1
    whole, done = None, 0  # of the first `done` bytes, as the binary digits of the length ask for
    while True:
        if length & width:
            if whole is None:
                whole = value
            else:
                n = len(value) - done
                whole = whole[:n] * np.uint64(pow(_BASE, width, 2**64)) + value[done:]
            done += width
            if done == length:
                return _mixed(whole[: len(data) - length + 1])
        value = value[:-width] * np.uint64(pow(_BASE, width, 2**64)) + value[width:]
        width *= 2


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every `width` neighbours."""
    span = 1
    while 2 * span <= width:
        values = np.minimum(values[:-span], values[span:])
        span *= 2
    return values if span == width else np.minimum(values[: len(values) - (width - span)], values[width - span :])


@dataclass
class Runs:
    """Runs of windows that share their anchor: where each begins, its bytes to the last window's end, the hash."""

    begin: np.ndarray
    size: np.ndarray
    anchor: np.ndarray


def anchor_runs(data: np.ndarray, ends: np.ndarray) -> Runs:
    """The runs of a block of texts that end at `ends`; no window reaches over an end."""
    found = []
    n_windows = len(data) - LENGTH + 1
    for at in range(0, n_windows, _SEGMENT):
        stop = min(at + _SEGMENT, n_windows)
        hashes = piece_hashes(data[at : stop + LENGTH - 1], GRAM)
        placed = (hashes & _HIGH) | np.arange(len(hashes), dtype=np.uint64)  # of equal ones the leftmost
        anchor = _least(placed, LENGTH - GRAM + 1) & _LOW
        first, last = np.searchsorted(ends, [at, stop + LENGTH])
        valid = np.ones(stop - at, bool)
        for end in ends[first:last].tolist():
            valid[max(end - LENGTH + 1 - at, 0) : max(end - at, 0)] = False
        edge = np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (valid[1:] != valid[:-1])])
        begin = np.flatnonzero(edge)
        size = np.diff(np.append(begin, stop - at)) + LENGTH - 1
        kept = valid[begin]
        begin, size = begin[kept], size[kept]
        found.append((begin + at, size, hashes[anchor[begin].astype(np.int64)]))
    if not found:
        return Runs(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64))
    return Runs(*(np.concatenate(x) for x in zip(*found)))


def _keys(hashes: np.ndarray, n_buckets: int) -> np.ndarray:
    """Bucket in the upper half, 32 more bits in the lower. Mixed anew, as anchors are those of small hashes."""
    hashes = _mixed(hashes)
    bucket = ((hashes >> np.uint64(32)) * np.uint64(n_buckets)) >> np.uint64(32)
    return (bucket << np.uint64(32)) | (hashes & _LOW)


# --- blocks -----------------------------------------------------------------------------------


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in blocks of about BLOCK_BYTES of text, numbered by task and place."""
    number = TaskContext.get().partitionId() << 32
    ids, texts, size = [], [], 0

    def packed() -> pa.RecordBatch:
        column = pa.concat_arrays(ids)
        body = b"".join(texts)
        lengths = np.array([len(t) for t in texts], np.int64)
        return pa.RecordBatch.from_pydict({
            "block": pa.array([number], pa.int64()),
            "ids": [pc.fill_null(column, 0).to_numpy(zero_copy_only=False).tobytes()],
            "named": [np.packbits(column.is_valid().to_numpy(zero_copy_only=False)).tobytes()],
            "lengths": [lengths.tobytes()],
            "packed": [_packed(body, 6)],
            "n_bytes": pa.array([len(body)], pa.int64()),
        })

    for batch in batches:
        column = batch.column("doc_id")
        for row, text in enumerate(batch.column("text").cast(pa.large_binary())):
            text = text.as_py() or b""
            if texts and size + len(text) > BLOCK_BYTES:
                yield packed()
                ids, texts, size, number = [], [], 0, number + 1
            ids.append(column.slice(row, 1))
            texts.append(text)
            size += len(text) + _ROW_BYTES
    if texts:
        yield packed()
    ids, texts = [], []
    give_back()


@dataclass
class Block:
    number: int
    ids: np.ndarray
    named: np.ndarray
    ends: np.ndarray
    data: np.ndarray
    raw: bytes

    @staticmethod
    def of(row: dict) -> Block:
        lengths = np.frombuffer(row["lengths"], np.int64)
        raw = _raw(row["packed"])
        named = np.unpackbits(np.frombuffer(row["named"], np.uint8), count=len(lengths)).astype(bool)
        return Block(
            row["block"], np.frombuffer(row["ids"], np.int64), named, np.cumsum(lengths),
            np.frombuffer(raw, np.uint8), raw,
        )

    def runs(self, n_buckets: int) -> tuple[Runs, np.ndarray, np.ndarray]:
        """(runs of rows with an id, their keys, their doc_ids)"""
        runs = anchor_runs(self.data, self.ends)
        row = np.searchsorted(self.ends, runs.begin, side="right")
        kept = self.named[row]
        runs = Runs(runs.begin[kept], runs.size[kept], runs.anchor[kept])
        return runs, _keys(runs.anchor, n_buckets), self.ids[row[kept]]


def _cut_by_bucket(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(buckets present, where each begins and the last ends) in sorted keys."""
    bucket = (keys >> np.uint64(32)).astype(np.int64)
    present, begin = np.unique(bucket, return_index=True)
    return present, np.append(begin, len(keys))


# --- which anchors are shared -----------------------------------------------------------------


def _announce(batches: Iterator[pa.RecordBatch], n_buckets: int) -> Iterator[pa.RecordBatch]:
    """A message for each block and bucket: the block's anchors, which of them several of its documents have, and how
    often those with many runs stand."""
    for batch in batches:
        for place in range(batch.num_rows):
            block = Block.of(batch.slice(place, 1).to_pylist()[0])
            _, keys, ids = block.runs(n_buckets)
            order = np.argsort(keys, kind="stable")
            keys, ids = keys[order], ids[order]
            begin = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, int)
            if not len(begin):
                continue
            counts = np.diff(np.append(begin, len(keys)))
            several = np.minimum.reduceat(ids, begin) != np.maximum.reduceat(ids, begin)
            keys = keys[begin]
            present, cut = _cut_by_bucket(keys)
            out: dict[str, list] = {name: [] for name in ("bucket", "block", "hashes", "several", "many", "counts")}
            for bucket, a, b in zip(present.tolist(), cut[:-1].tolist(), cut[1:].tolist()):
                many = np.flatnonzero(counts[a:b] >= _COUNTED).astype(np.int32)
                out["bucket"].append(bucket)
                out["block"].append(block.number)
                out["hashes"].append((keys[a:b] & _LOW).astype(np.uint32).tobytes())
                out["several"].append(np.packbits(several[a:b]).tobytes())
                out["many"].append(many.tobytes())
                out["counts"].append(counts[a:b][many].astype(np.int32).tobytes())
            yield pa.RecordBatch.from_pydict(out, schema=_ANNOUNCED)
            del block
    give_back()


_ANNOUNCED = pa.schema([("bucket", pa.int32()), ("block", pa.int64()), *[(n, pa.binary()) for n in ("hashes", "several", "many", "counts")]])
_ANSWERED = pa.schema([("block", pa.int64()), ("bucket", pa.int32()), ("shared", pa.binary()), ("hot", pa.binary())])


def _compare(key: tuple, table: pa.Table, hot_runs: int) -> pa.Table:
    """For each message the anchors that two documents have (bits), and those of very many runs (places)."""
    hashes = [np.frombuffer(x, np.uint32) for x in table["hashes"].to_pylist()]
    sizes = np.array([len(x) for x in hashes])
    several = [np.unpackbits(np.frombuffer(x, np.uint8), count=n).astype(bool) for x, n in zip(table["several"].to_pylist(), sizes)]
    runs = np.ones(sizes.sum(), np.int32)
    for at, places, counts in zip(starts(sizes).tolist(), table["many"].to_pylist(), table["counts"].to_pylist()):
        runs[at + np.frombuffer(places, np.int32)] = np.frombuffer(counts, np.int32)
    flat = np.concatenate(hashes)
    order = np.argsort(flat, kind="stable")
    begin = np.flatnonzero(np.concatenate([[True], flat[order][1:] != flat[order][:-1]]))
    copies = np.diff(np.append(begin, len(flat)))
    shared = (copies > 1) | np.logical_or.reduceat(np.concatenate(several)[order], begin)
    hot = np.add.reduceat(runs[order].astype(np.int64), begin) >= hot_runs
    of_all, hot_of_all = np.empty(len(flat), bool), np.empty(len(flat), bool)
    of_all[order], hot_of_all[order] = np.repeat(shared, copies), np.repeat(hot, copies)
    cut = starts(sizes).tolist()
    return pa.table({
        "block": table["block"], "bucket": table["bucket"],
        "shared": pa.array([np.packbits(of_all[a:b]).tobytes() for a, b in zip(cut, cut[1:])], pa.binary()),
        "hot": pa.array([np.flatnonzero(hot_of_all[a:b]).astype(np.int32).tobytes() for a, b in zip(cut, cut[1:])], pa.binary()),
    }, schema=_ANSWERED)


# --- snippets -----------------------------------------------------------------------------------


def _cut_out(data: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The stretches one after the other."""
    edge = starts(size)
    out = np.empty(edge[-1], np.uint8)
    for a in range(0, len(size), _RUNS):
        b = min(a + _RUNS, len(size))
        out[edge[a] : edge[b]] = ragged(data, begin[a:b], size[a:b])
    return out


def _distinct(text: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """(code of each of the stretches that the text consists of, the distinct stretches)"""
    offsets = pa.py_buffer(starts(size).tobytes())
    column = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(size), [None, offsets, pa.py_buffer(text)])
    encoded = column.dictionary_encode()
    return encoded.indices.to_numpy(zero_copy_only=False), encoded.dictionary


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(all bytes, bytes of each) of a column without nulls that is no slice."""
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[: len(column) + 1]
    return np.frombuffer(data, np.uint8)[: offsets[-1]] if data else np.zeros(0, np.uint8), np.diff(offsets)


def _window_hashes(data: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """The hashes of the windows at these places, which ascend."""
    found = [np.zeros(0, np.uint64)]
    for at in range(0, len(data), _SEGMENT):
        first, last = np.searchsorted(windows, [at, at + _SEGMENT])
        if last > first:
            found.append(piece_hashes(data[at : at + _SEGMENT + LENGTH - 1], LENGTH)[windows[first:last] - at])
    return np.concatenate(found)


def _send(key: tuple, blocks: pa.Table, answers: pa.Table, n_buckets: int) -> pa.Table:
    """Messages (kind 0) to the shards, and (kind 1) what the block must know to read their answers."""
    out: dict[str, list] = {name: [] for name in _SENT.names}
    if blocks.num_rows and answers.num_rows:
        block = Block.of(blocks.to_pylist()[0])
        answers = answers.sort_by("bucket")
        runs, keys, ids = block.runs(n_buckets)
        unique, inverse = np.unique(keys, return_inverse=True)
        _, cut = _cut_by_bucket(unique)
        shared, hot = np.zeros(len(unique), bool), np.zeros(len(unique), bool)
        for a, b, bits, places in zip(cut.tolist(), cut[1:].tolist(), answers["shared"].to_pylist(), answers["hot"].to_pylist()):
            shared[a:b] = np.unpackbits(np.frombuffer(bits, np.uint8), count=b - a)
            hot[a + np.frombuffer(places, np.int32)] = True
        hot &= shared
        kept = (shared & ~hot)[inverse]
        begin, size, keys_kept, ids_kept = runs.begin[kept], runs.size[kept], keys[kept], ids[kept]
        if hot.any():
            # Each window of a hot anchor by itself, keyed by its contents.
            one = hot[inverse]
            n = runs.size[one] - LENGTH + 1
            alone = ragged_places(runs.begin[one], n)
            begin = np.concatenate([begin, alone])
            size = np.concatenate([size, np.full(len(alone), LENGTH)])
            keys_kept = np.concatenate([keys_kept, _keys(_window_hashes(block.data, alone), n_buckets)])
            ids_kept = np.concatenate([ids_kept, np.repeat(ids[one], n)])
        if len(begin):
            _messages(out, block, begin, size, keys_kept, ids_kept)
    return pa.table(out, schema=_SENT)


def _messages(out: dict, block: Block, begin: np.ndarray, size: np.ndarray, keys: np.ndarray, ids: np.ndarray) -> None:
    codes, contents = _distinct(_cut_out(block.data, begin, size), size)
    # Of each snippet the first run stands for it; the order of the snippets is that of their buckets.
    _, first = np.unique(codes, return_index=True)
    order = np.argsort(keys[first], kind="stable")
    place = np.empty(len(order), np.int32)
    place[order] = np.arange(len(order))
    codes = place[codes]
    snippet_keys = keys[first][order]
    least = np.full(len(order), np.iinfo(np.int64).max)
    np.minimum.at(least, codes, ids)
    contents, sizes = _flat(contents.take(pa.array(order)))
    edge = starts(sizes)
    present, cut = _cut_by_bucket(snippet_keys)
    for bucket, a, b in zip(present.tolist(), cut[:-1].tolist(), cut[1:].tolist()):
        values = (
            0, block.number, bucket, _packed((snippet_keys[a:b] & _LOW).astype(np.uint32)), _packed(sizes[a:b].astype(np.uint8)),
            _packed(least[a:b]), _packed(contents[edge[a] : edge[b]]), None, None, None,
        )
        for name, value in zip(out, values):
            out[name].append(value)
    # Runs of the smallest doc_id wait for the answer of their snippet, all others go; those that touch are one stretch.
    goes = ids > least[codes]
    waits = ~goes
    first, last = begin[goes], (begin + size)[goes]
    order = np.argsort(first, kind="stable")
    first, last = first[order], np.maximum.accumulate(last[order]) if len(order) else last
    new = np.concatenate([[True], first[1:] > last[:-1]]) if len(first) else np.zeros(0, bool)
    ends = last[np.append(np.flatnonzero(new)[1:] - 1, len(last) - 1)] if len(first) else last
    values = (
        1, block.number, -1, None, _packed(size[waits].astype(np.uint8)), None, None,
        _packed(np.diff(begin[waits], prepend=0).astype(np.int32)), _packed(codes[waits]),
        _packed(np.stack([first[new], ends]).astype(np.int64)),
    )
    for name, value in zip(out, values):
        out[name].append(value)


_SENT = pa.schema([("kind", pa.int32()), ("block", pa.int64()), ("bucket", pa.int32()), *[(n, pa.binary()) for n in ("keys", "sizes", "ids", "content", "begins", "codes", "goes")]])


# --- shards ---------------------------------------------------------------------------------------


def window_classes(text: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """A number for each window of the text, equal where its LENGTH bytes are."""
    order = suffix_array(text, LENGTH)
    prefix = common_prefixes(text, order, LENGTH)
    class_of = np.empty(len(text), np.int64)
    class_of[order] = np.cumsum(prefix[order] < LENGTH)
    return class_of[windows]


def _search(key: tuple, table: pa.Table) -> pa.Table:
    """For each message a bit for each window of its snippets: whether a smaller doc_id has it."""
    read = lambda name, kind: [_unpacked(x, kind) for x in table[name].to_pylist()]
    sizes, keys, ids = read("sizes", np.uint8), np.concatenate(read("keys", np.uint32)), np.concatenate(read("ids", np.int64))
    counts = starts(np.array([len(x) for x in sizes]))
    size = np.concatenate(sizes).astype(np.int64)
    codes, contents = _distinct(np.concatenate(read("content", np.uint8)), size)
    known, rank = np.unique(ids, return_inverse=True)  # doc_ids as small numbers
    rank = rank.astype(np.int32)
    _, first = np.unique(codes, return_index=True)
    least = np.full(len(first), len(known), np.int32)
    np.minimum.at(least, codes, rank)
    order = np.argsort(keys[first], kind="stable")
    contents, snippet_size = _flat(contents.take(pa.array(order)))
    sorted_keys, least = keys[first][order], least[order]
    edge, n_windows = starts(snippet_size), snippet_size - LENGTH + 1
    window_edge = starts(n_windows)
    smallest = np.empty(window_edge[-1], np.int32)  # by window of the distinct snippets
    a = 0
    while a < len(order):
        b = int(np.searchsorted(edge, edge[a] + SHARD_BYTES, side="right")) - 1
        b = min(max(b, a + 1), len(order))
        while b < len(order) and sorted_keys[b] == sorted_keys[b - 1]:  # an anchor's snippets stay together
            b += 1
        windows = ragged_places(edge[a:b] - edge[a], n_windows[a:b])
        classes = window_classes(contents[edge[a] : edge[b]], windows)
        by_class = np.full(int(classes.max()) + 1, len(known), np.int32)
        np.minimum.at(by_class, classes, np.repeat(least[a:b], n_windows[a:b]))
        smallest[window_edge[a] : window_edge[b]] = by_class[classes]
        a = b
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    hits = []
    for a, b in zip(counts[:-1].tolist(), counts[1:].tolist()):
        at = place[codes[a:b]]
        hit = ragged(smallest, window_edge[at], n_windows[at]) < np.repeat(rank[a:b], n_windows[at])
        hits.append(_packed(np.packbits(hit)))
    return pa.table({
        "kind": pa.array(np.full(table.num_rows, 2), pa.int32()), "block": table["block"], "bucket": table["bucket"],
        "sizes": table["sizes"], "content": pa.array(hits, pa.binary()),
        **{name: pa.nulls(table.num_rows, pa.binary()) for name in ("keys", "ids", "begins", "codes", "goes")},
    }).select(_SENT.names)


# --- removal --------------------------------------------------------------------------------------


def _gone(n_bytes: int, told: pa.Table) -> np.ndarray:
    """Whether each byte of the block's text is to go."""
    change = np.zeros(n_bytes + 1, np.int32)
    mine = told.filter(pc.equal(told["kind"], 1)).to_pylist()
    if mine:
        first, last = _unpacked(mine[0]["goes"], np.int64).reshape(2, -1)
        np.add.at(change, first, 1)
        np.add.at(change, last, -1)
        # Answers come by bucket, as the snippets are numbered; all that were sent have one.
        answers = told.filter(pc.equal(told["kind"], 2)).sort_by("bucket")
        sizes = [_unpacked(x, np.uint8).astype(np.int64) - LENGTH + 1 for x in answers["sizes"].to_pylist()]
        bits = [
            np.unpackbits(_unpacked(x, np.uint8), count=int(n.sum())) for x, n in zip(answers["content"].to_pylist(), sizes)
        ]
        hits, edge = np.concatenate(bits).astype(bool), starts(np.concatenate(sizes))
        begin = np.cumsum(_unpacked(mine[0]["begins"], np.int32), dtype=np.int64)
        codes = _unpacked(mine[0]["codes"], np.int32)
        n_windows = _unpacked(mine[0]["sizes"], np.uint8).astype(np.int64) - LENGTH + 1
        for a in range(0, len(codes), _RUNS):
            part = slice(a, a + _RUNS)
            found = ragged(hits, edge[codes[part]], n_windows[part])
            windows = ragged_places(begin[part], n_windows[part])[found]
            np.add.at(change, windows, 1)
            np.add.at(change, windows + LENGTH, -1)
    return np.cumsum(change[:-1], dtype=np.int32) > 0


def _remove(key: tuple, blocks: pa.Table, told: pa.Table) -> pa.Table:
    """What is left of each row, and the stretches that went."""
    if not blocks.num_rows:
        return _RESULT.empty_table()
    block = Block.of(blocks.to_pylist()[0])
    gone = _gone(len(block.data), told)
    row_starts = np.concatenate([[0], block.ends[:-1]])
    spans, kept, removed = [], [], []
    for a, b in zip(row_starts.tolist(), block.ends.tolist()):
        mask = gone[a:b]
        if not mask.any():
            spans.append([])
            kept.append(block.raw[a:b])
            removed.append(0)
            continue
        edges = np.flatnonzero(np.diff(np.concatenate([[False], mask, [False]])))
        spans.append([{"begin": x, "end": y} for x, y in edges.reshape(-1, 2).tolist()])
        kept.append(block.data[a:b][~mask].tobytes())
        removed.append(int(mask.sum()))
    return pa.table({
        "doc_id": pa.array(block.ids, pa.int64(), mask=~block.named),
        "n_bytes": pa.array(block.ends - row_starts, pa.int64()), "n_removed": pa.array(removed, pa.int64()),
        "spans": pa.array(spans, _RESULT.field("spans").type), "kept": pa.array(kept, pa.binary()),
    })


_SPAN = pa.struct([("begin", pa.int64()), ("end", pa.int64())])
_RESULT = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("spans", pa.list_(_SPAN)), ("kept", pa.binary())])
_RESULT_TYPES = "doc_id long, n_bytes long, n_removed long, spans array<struct<begin: long, end: long>>, kept binary"


def _stored_by_block(blocks: DataFrame) -> DataFrame:
    """The blocks as a table bucketed by their number, so that answers come to them and the texts are never shuffled."""
    spark = blocks.sparkSession
    name = f"text_blocks_{uuid.uuid4().hex}"
    n_buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    writer = blocks.write.bucketBy(n_buckets, "block").sortBy("block").option("path", new_folder(spark, "text-blocks"))
    writer.saveAsTable(name)
    stored = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # only its entry in the catalog: the files are in the scratch folder
    return stored


def remove_repeats(docs: DataFrame, bucket_bytes: int = BUCKET_BYTES, hot_runs: int = HOT_RUNS) -> DataFrame:
    """(doc_id, n_bytes, n_removed, spans, kept) of every row: the stretches of bytes that go, and what is left."""
    blocks = _stored_by_block(docs.select("doc_id", "text").mapInArrow(_pack, _BLOCKS))
    total = blocks.agg(F.sum("n_bytes")).first()[0] or 0
    n_buckets = max(1, -(-total // bucket_bytes))
    announced = blocks.mapInArrow(
        partial(_announce, n_buckets=n_buckets),
        "bucket int, block long, hashes binary, several binary, many binary, counts binary",
    )
    compare = lambda key, table: _compare(key, table, hot_runs)
    answers = announced.groupBy("bucket").applyInArrow(compare, "block long, bucket int, shared binary, hot binary")
    answers = materialize(answers, "shared-anchors")
    send = lambda key, left, right: _send(key, left, right, n_buckets)
    sent = blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(send, _KINDS)
    sent = materialize(sent, "snippets")
    found = sent.filter("kind = 0").groupBy("bucket").applyInArrow(_search, _KINDS)
    told = sent.filter("kind = 1").unionByName(materialize(found, "repeated-windows"))
    return blocks.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(_remove, _RESULT_TYPES)
