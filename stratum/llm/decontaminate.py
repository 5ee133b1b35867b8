"""Benchmark decontamination by winnowing.

Fingerprints: of every run of `window` words, the smallest hash of its `k`-grams (the last one on ties). Texts that
share `window` words in a row choose the same k-gram there, so joining the fingerprints of documents and items misses
no such span. Every hit is extended word by word, at most to the windows that can hold it, and only extensions of a
whole window count, so hash collisions never do. An item of fewer words than a window is one window of its own length
and is looked up by the hash of all its words.

The fingerprints of the items are broadcast in slices of a bounded size (`slice_chars` of item text each; one slice
unless the benchmark is larger); documents are not shuffled when there is one slice.

Null and empty texts have no words: they have no hits, and such an item has no window. Repeated documents get equal
rows; repeated items of one id count once; an empty benchmark contaminates nothing; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial, reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.llm.labelled import with_text_key
from stratum.llm.text import PUNCTUATION, chunks, distinct, encode_words, ragged, starts, table

_WORDS = table(PUNCTUATION)
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_PAIRS = 1 << 16  # of equal grams, worked on at a time
_SCAN_SCHEMA = "doc_id long, n_words long, n_hit long, items array<string>, spans array<array<long>>, text_key long"


def _hashes(words: pa.Array) -> np.ndarray:
    return pd.util.hash_array(np.array(words.to_pylist(), dtype=object), categorize=False).astype(np.uint64)


def _gram_hashes(word_hashes: np.ndarray, k: int) -> np.ndarray:
    n = max(len(word_hashes) - k + 1, 0)
    out = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for j in range(k):
            out = out * _FACTOR + word_hashes[j : j + n]
        out ^= out >> np.uint64(31)
        return out * _FACTOR


def winnow(hashes: np.ndarray, owner: np.ndarray, k: int, window: int) -> np.ndarray:
    """Where the chosen k-grams of all windows begin; owner: whose word each word is."""
    grams = _gram_hashes(hashes, k)
    n = len(hashes) - window + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    least, chosen = grams[:n].copy(), np.arange(n)
    for j in range(1, window - k + 1):
        better = grams[j : j + n] <= least
        least[better] = grams[j : j + n][better]
        chosen[better] = np.flatnonzero(better) + j
    return distinct(chosen[owner[:n] == owner[window - 1 :]])


@dataclass
class Index:
    """Words and fingerprints of a slice of the items."""

    words: dict[str, int]
    tokens: np.ndarray  # words of all items, by number
    owner: np.ndarray  # item of each
    names: list[str]
    grams: dict[int, tuple[np.ndarray, np.ndarray]]  # length: sorted hashes, places of their first words
    k: int
    window: int


def build_index(items: list[tuple[str, str]], k: int, window: int) -> Index:
    names = [name for name, _ in items]
    counts, codes, words = encode_words(pa.array([text for _, text in items], pa.large_string()), _WORDS)
    owner = np.repeat(np.arange(len(items)), counts)
    hashes = _hashes(words)[codes] if len(words) else np.zeros(0, np.uint64)
    begin = starts(counts)
    places = {k: winnow(hashes, owner, k, window)}
    short = {}
    for item in np.flatnonzero((counts > 0) & (counts < window)).tolist():
        short.setdefault(int(counts[item]), []).append(int(begin[item]))
    grams = {}
    for length, at in {**{-n: np.array(p) for n, p in short.items()}, k: places[k]}.items():
        found = _gram_hashes(hashes, abs(length))[at]
        order = np.argsort(found, kind="stable")
        grams[length] = (found[order], at[order])
    return Index({w: i for i, w in enumerate(words.to_pylist())}, codes, owner, names, grams, k, window)


def _matches(
    index: Index, length: int, grams: np.ndarray, at: np.ndarray
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (place in the documents, place in the items) of equal hashes, a bounded number at a time."""
    known, places = index.grams[length]
    low = np.searchsorted(known, grams, "left")
    count = np.searchsorted(known, grams, "right") - low
    hit = np.flatnonzero(count)
    low, count, at = low[hit], count[hit], at[hit]
    edge = starts(count)
    for first in range(0, int(edge[-1]), _PAIRS):
        last = min(first + _PAIRS, int(edge[-1]))
        a, b = int(np.searchsorted(edge, first, "right")) - 1, int(np.searchsorted(edge, last, "left"))
        begin, end = np.maximum(edge[a:b], first), np.minimum(edge[a + 1 : b + 1], last)
        yield np.repeat(at[a:b], end - begin), ragged(places, low[a:b] + begin - edge[a:b], end - begin)


def _distinct(spans: tuple[np.ndarray, ...], n_items: int) -> tuple[np.ndarray, ...]:
    """Each (begin, end, item) once: repeated words give one span by very many pairs."""
    begin, end, item = spans
    if not len(begin):
        return spans
    longest = int((end - begin).max()) + 1
    key = distinct((begin.astype(np.int64) * longest + end - begin) * n_items + item)
    key, item = np.divmod(key, n_items)
    begin, length = np.divmod(key, longest)
    return begin, begin + length, item


def _extended(
    index: Index, tokens: np.ndarray, owner: np.ndarray, here: np.ndarray, there: np.ndarray
) -> tuple[np.ndarray, ...]:
    """(begin, end, item) of the pairs of grams that stand in a whole common window."""
    equal = np.ones(len(here), bool)
    for j in range(index.k):
        equal &= tokens[here + j] == index.tokens[there + j]
    here, there = here[equal], there[equal]
    reach = []
    for step, edge in ((-1, 0), (1, index.k - 1)):
        length, going = np.zeros(len(here), np.int64), np.ones(len(here), bool)
        for j in range(1, index.window - index.k + 1):
            a, b = here + edge + step * j, there + edge + step * j
            inside = (a >= 0) & (a < len(tokens)) & (b >= 0) & (b < len(index.tokens))
            a, b = np.where(inside, a, 0), np.where(inside, b, 0)
            going &= inside & (tokens[a] == index.tokens[b])
            going &= (owner[a] == owner[here]) & (index.owner[b] == index.owner[there])
            length += going
        reach.append(length)
    whole = reach[0] + index.k + reach[1] >= index.window
    return here[whole] - reach[0][whole], (here + index.k + reach[1])[whole], index.owner[there[whole]]


def _spans(index: Index, hashes: np.ndarray, tokens: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, ...]:
    """(begin, end, item) of every verified hit in the words of a batch, each once."""
    found, n_items = [], len(index.names)
    at = winnow(hashes, owner, index.k, index.window)
    for here, there in _matches(index, index.k, _gram_hashes(hashes, index.k)[at], at):
        found.append(_distinct(_extended(index, tokens, owner, here, there), n_items))
    for length in (n for n in index.grams if n < 0):
        n = -length
        grams = _gram_hashes(hashes, n)
        for here, there in _matches(index, length, grams, np.arange(len(grams))):
            equal = owner[here] == owner[here + n - 1]
            for j in range(n):
                equal &= tokens[here + j] == index.tokens[there + j]
            found.append(_distinct((here[equal], here[equal] + n, index.owner[there[equal]]), n_items))
    if not found:
        return (np.zeros(0, np.int64),) * 3
    return _distinct(tuple(np.concatenate(x) for x in zip(*found)), n_items)


def _scan(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    index: Index = shared.value
    for rows in chunks(batches, most=1 << 20):
        counts, codes, words = encode_words(rows.column("text"), _WORDS)
        owner, edges = np.repeat(np.arange(len(counts)), counts), starts(counts)
        hashes = _hashes(words)[codes] if len(words) else np.zeros(0, np.uint64)
        numbers = np.array([index.words.get(w, -1) for w in words.to_pylist()], np.int64)
        tokens = numbers[codes] if len(words) else np.zeros(0, np.int64)
        begin, end, item = _spans(index, hashes, tokens, owner)
        cover = np.zeros(len(tokens) + 1, np.int64)
        np.add.at(cover, begin, 1)
        np.add.at(cover, end, -1)
        hit = starts(np.cumsum(cover)[:-1] > 0)
        n_hit = hit[edges[1:]] - hit[edges[:-1]]
        items, spans = [[] for _ in counts], [[] for _ in counts]
        if len(begin):
            of = owner[begin]
            for d, i in sorted(set(zip(of.tolist(), item.tolist()))):
                items[d].append(index.names[i])
            for d, a, b in sorted(set(zip(of.tolist(), (begin - edges[of]).tolist(), (end - edges[of]).tolist()))):
                spans[d].append([a, b])
        yield pa.RecordBatch.from_pydict({
            "doc_id": rows.column("doc_id"),
            "n_words": pa.array(counts, pa.int64()),
            "n_hit": pa.array(n_hit, pa.int64()),
            "items": pa.array([sorted(set(x)) for x in items], pa.list_(pa.string())),
            "spans": pa.array(spans, pa.list_(pa.list_(pa.int64()))),
            "text_key": rows.column("text_key"),
        })


def _covered(spans):
    """Words in the union of [begin, end) spans that are sorted by begin."""
    state = F.aggregate(
        spans,
        F.struct(F.lit(0).cast("long").alias("end"), F.lit(0).cast("long").alias("n")),
        lambda s, x: F.struct(
            F.greatest(s["end"], x[1]).alias("end"),
            (s["n"] + F.greatest(x[1] - F.greatest(s["end"], x[0]), F.lit(0))).alias("n"),
        ),
    )
    return state["n"]


def find_contamination(
    docs: DataFrame, benchmark: DataFrame, window: int = 13, k: int = 8, slice_chars: int = 32 << 20
) -> DataFrame:
    """(doc_id, text_key, n_words, n_hit, items, spans) of every row of (doc_id, text), against (item_id, text)."""
    spark = docs.sparkSession
    items = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    size = items.agg(F.sum(F.length("text") + 1)).first()[0] or 0
    n_slices = max(1, -(-size // slice_chars))
    documents = with_text_key(docs)
    scans = []
    for i in range(n_slices):
        of_slice = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n_slices)) == i)
        index = build_index([tuple(r) for r in of_slice.collect()], k, window)
        scan = partial(_scan, shared=spark.sparkContext.broadcast(index))
        scans.append(documents.mapInArrow(scan, _SCAN_SCHEMA))
    if n_slices == 1:
        return scans[0]
    found = reduce(DataFrame.unionAll, scans).filter("n_hit > 0")
    merged = found.groupBy("doc_id", "text_key").agg(
        F.array_sort(F.flatten(F.collect_set("items"))).alias("items"),
        F.array_sort(F.flatten(F.collect_set("spans"))).alias("spans"),
    )
    every = scans[0].select("doc_id", "text_key", "n_words").alias("a")
    same = F.expr("a.doc_id <=> b.doc_id and a.text_key <=> b.text_key")
    spans = F.coalesce("b.spans", F.array().cast("array<array<long>>"))
    return every.join(merged.alias("b"), same, "left").select(
        "a.doc_id", "a.text_key", "n_words", _covered(spans).alias("n_hit"),
        F.array_distinct(F.coalesce("b.items", F.array().cast("array<string>"))).alias("items"), spans.alias("spans"),
    )


def contaminated(n_hit, n_words):
    """The rule: a twentieth of the words or more."""
    return (n_hit > 0) & (20 * n_hit >= n_words)
