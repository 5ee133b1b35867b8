"""Scores of whole texts under a trigram language model, held in Elias-Fano tries that are dealt over the tasks.

Texts are cut into blocks of whole documents. Three exchanges follow, each a shuffle of packed arrays in which a block
names an n-gram once, whatever its number of occurrences, so a frequent word or passage costs a row a block and not a
row an occurrence:

1. Words (by 64-bit hash) get their training count and a number, small for frequent words.
2. N-grams go to the shard of their middle word. A frequent middle word is split over shards, its bigrams by their
   third word and its trigrams by their first, so every context stays whole. The shard builds a trie of what occurs in
   training and looks up everything that was sent, answering with a byte per probability.
3. The answers meet their block again, which adds up the logarithms by document.

The model: unigrams are (c + 1) / (N + V + 1), which leaves a share for unknown words; bigrams interpolate evenly with
unigrams, p2 = c(w2 w3) / 2 c(w2) + p1 / 2; trigrams with bigrams after Witten and Bell. Probabilities of seen bigrams
and trigrams and the shares of contexts are quantised to a byte, in 254 even steps of the logarithm down to 10^-7, or to
below the smallest that counts as large as the corpus's can give, for all shards alike. Every text begins after two start marks and ends with
an end mark, which counts as a token.

Two different words of one hash would count as one (with a billion words, a chance of about 3 %). Null texts count as
empty: one end token. A null doc_id is a training row; repeated rows are scored, and count in training, each; an empty
table gives no rows; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.llm.elias_fano import Trie, floor_of, levels
from stratum.llm.text import SPACES, chunks, encode_words, starts, table
from stratum.sources import files
from stratum.sources.scratch import materialize, new_folder

_WORDS = table(SPACES)
_CHUNK = 6 << 20
UNKNOWN, START, END, FIRST_WORD = 0, 1, 2, 3
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def _packed(values: np.ndarray) -> bytes:
    """Bytes of equal weight together, compressed; most high ones are 0."""
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.itemsize).T)
    return len(values).to_bytes(8, "little") + pa.Codec("zstd", 1).compress(planes.tobytes(), asbytes=True)


def _unpacked(raw: bytes, kind: type) -> np.ndarray:
    n, size = int.from_bytes(raw[:8], "little"), np.dtype(kind).itemsize
    planes = pa.Codec("zstd").decompress(raw[8:], n * size, asbytes=True) if n else b""
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(size, n).T).view(kind).ravel()


def _spread(*columns: np.ndarray) -> np.ndarray:
    out = np.zeros(len(columns[0]), np.uint64)
    with np.errstate(over="ignore"):
        for column in columns:
            out = (out ^ column.astype(np.uint64)) * _FACTOR
            out ^= out >> np.uint64(29)
    return out


def _rows_by(shard: np.ndarray, n: int) -> Iterator[tuple[int, np.ndarray]]:
    order = np.argsort(shard, kind="stable")
    cut = np.searchsorted(shard[order], np.arange(n + 1))
    for number in range(n):
        if cut[number] < cut[number + 1]:
            yield number, order[cut[number] : cut[number + 1]]


# Blocks and the counts of words.

_BLOCK = "block long, doc_ids array<long>, held array<boolean>, lengths array<long>, codes binary, words binary, counts binary"


def _blocks(batches: Iterator[pa.RecordBatch], modulus: int, held_out: int) -> Iterator[pa.RecordBatch]:
    number = TaskContext.get().partitionId() << 32
    for rows in chunks(batches, most=_CHUNK):
        lengths, codes, words = encode_words(rows.column("text"), _WORDS)
        hashes = pd.util.hash_array(np.array(words.to_pylist(), dtype=object), categorize=False).astype(np.uint64)
        used, back = np.unique(hashes[codes] if len(codes) else np.zeros(0, np.uint64), return_inverse=True)
        ids = rows.column("doc_id").to_pylist()
        held = np.array([i is not None and zlib.crc32(str(i).encode()) % modulus == held_out for i in ids])
        learnt = ~np.repeat(held, lengths)
        counts = np.bincount(back[learnt], minlength=len(used)).astype(np.uint32)
        yield pa.RecordBatch.from_pydict({
            "block": pa.array([number], pa.int64()), "doc_ids": pa.array([ids], pa.list_(pa.int64())),
            "held": pa.array([held.tolist()], pa.list_(pa.bool_())), "lengths": pa.array([lengths], pa.list_(pa.int64())),
            "codes": pa.array([_packed(back.astype(np.uint32))], pa.binary()),
            "words": pa.array([_packed(used)], pa.binary()), "counts": pa.array([_packed(counts)], pa.binary()),
        })
        number += 1


def _word_requests(batches: Iterator[pa.RecordBatch], n_shards: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            words, counts = _unpacked(row["words"], np.uint64), _unpacked(row["counts"], np.uint32)
            for shard, at in _rows_by((words % np.uint64(n_shards)).astype(np.int64), n_shards):
                yield pa.RecordBatch.from_pydict({
                    "shard": pa.array([shard], pa.int32()), "block": pa.array([row["block"]], pa.int64()),
                    "words": pa.array([words[at].tobytes()], pa.binary()),
                    "counts": pa.array([_packed(counts[at])], pa.binary()),
                })


def _count_words(group: pa.Table, n_shards: int) -> pa.Table:
    """For each block, the counts and numbers of the words it asked for; with the shard's totals in its own row."""
    shard, blocks = group["shard"][0].as_py(), group["block"].to_pylist()
    parts = [np.frombuffer(w, np.uint64) for w in group["words"].to_pylist()]
    counts = np.concatenate([_unpacked(c, np.uint32) for c in group["counts"].to_pylist()]).astype(np.int64)
    words, back = np.unique(np.concatenate(parts), return_inverse=True)
    total = np.bincount(back, counts, len(words)).astype(np.int64)
    rank = np.empty(len(words), np.int64)
    rank[np.argsort(-total, kind="stable")] = np.arange(len(words))
    number = np.where(total > 0, FIRST_WORD + rank * n_shards + shard, UNKNOWN)
    edges = starts(np.array([len(p) for p in parts]))
    rows = [
        (block, shard, _packed(number[back[a:b]].astype(np.uint32)), _packed(total[back[a:b]].astype(np.uint64)), 0, 0, 0)
        for block, a, b in zip(blocks, edges, edges[1:])
    ]
    rows.append((-1, shard, b"", b"", int((total > 0).sum()), int(total.sum()), int(total.max(initial=0))))
    kinds = [pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
    names = ["block", "shard", "numbers", "totals", "distinct", "tokens", "largest"]
    return pa.table([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)


# Numbered blocks: their n-grams, requests for them, and scores from the answers.


@dataclass
class Plan:
    n_shards: int
    most: int  # occurrences of a middle word beyond which it is split
    tokens: int  # N
    distinct: int  # V
    training_docs: int
    floor: float  # the logarithm below all probabilities of the tries

    def unigram(self, count: np.ndarray) -> np.ndarray:
        return (count + 1.0) / (self.tokens + self.distinct + 1.0)


@dataclass
class Grams:
    """The distinct n-grams of a block: which each token is, and how often it occurs in training."""

    words: np.ndarray  # distinct numbers in order
    totals: np.ndarray  # and their training counts
    bigrams: np.ndarray  # (middle, third) as places in `words`
    bigram_of: np.ndarray
    bigram_counts: np.ndarray
    trigrams: np.ndarray  # (middle, first, third) as places in `words`
    trigram_of: np.ndarray
    trigram_counts: np.ndarray
    third: np.ndarray  # of each token
    lengths: np.ndarray  # tokens per document

    def shards(self, plan: Plan) -> tuple[np.ndarray, np.ndarray]:
        pieces = 1 + self.totals // plan.most

        def of(middle: np.ndarray, other: np.ndarray) -> np.ndarray:
            piece = np.where(pieces[middle] > 1, _spread(self.words[other]) % pieces[middle].astype(np.uint64), 0)
            return (_spread(self.words[middle], piece) % np.uint64(plan.n_shards)).astype(np.int64)

        return of(self.bigrams[:, 0], self.bigrams[:, 1]), of(self.trigrams[:, 0], self.trigrams[:, 1])


def _grams(row: dict, plan: Plan) -> Grams:
    """Unknown words stand only as third words of trigrams; n-grams that could not be in training are left out (-1)."""
    ids, lengths = _unpacked(row["ids"], np.uint32).astype(np.int64), np.array(row["lengths"], np.int64) + 1
    held = np.repeat(np.array(row["held"], bool), lengths)
    words, totals = _unpacked(row["words"], np.uint32).astype(np.int64), _unpacked(row["totals"], np.uint64).astype(np.int64)
    edges = starts(lengths)
    third = np.searchsorted(words, np.insert(ids, edges[1:] - 1 - np.arange(len(lengths)), END))
    start, unknown = np.searchsorted(words, START), np.searchsorted(words, UNKNOWN)
    middle, first = np.roll(third, 1), np.roll(third, 2)
    middle[edges[:-1]] = start
    first[edges[:-1]] = start
    second = edges[:-1][lengths > 1] + 1
    first[second] = start
    n = len(words)
    learnt = ~held

    def distinct(keys: np.ndarray, usable: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        found, back = np.unique(keys[usable], return_inverse=True)
        of = np.full(len(keys), -1, np.int64)
        of[usable] = back
        return found, of, np.bincount(back, learnt[usable], len(found)).astype(np.int64)

    pair, bigram_of, bigram_counts = distinct(middle * n + third, (middle != unknown) & (third != unknown))
    key, trigram_of, trigram_counts = distinct(
        (middle * n + first) * n + third, (middle != unknown) & (first != unknown)
    )
    return Grams(
        words, totals, np.stack([pair // n, pair % n], 1), bigram_of, bigram_counts,
        np.stack([key // n // n, key // n % n, key % n], 1), trigram_of, trigram_counts, third, lengths,
    )


_NUMBERED = (
    "block long, doc_ids array<long>, held array<boolean>, lengths array<long>, ids binary, words binary, totals binary"
)


def _number_block(block: pa.Table, answers: pa.Table, plan: Plan) -> pa.Table:
    row = block.to_pylist()[0]
    used = _unpacked(row["words"], np.uint64)
    number, total = np.zeros(len(used), np.uint32), np.zeros(len(used), np.uint64)
    found = {a["shard"]: a for a in answers.to_pylist()}
    for shard, at in _rows_by((used % np.uint64(plan.n_shards)).astype(np.int64), plan.n_shards):
        number[at] = _unpacked(found[shard]["numbers"], np.uint32)
        total[at] = _unpacked(found[shard]["totals"], np.uint64)
    ids = number[_unpacked(row["codes"], np.uint32)]
    marks = np.array([UNKNOWN, START, END], np.uint32)
    words, first = np.unique(np.concatenate([marks, number]), return_index=True)
    of_marks = np.array([0, plan.training_docs, plan.training_docs], np.uint64)
    totals = np.concatenate([of_marks, total])[first]
    columns = [
        [row["block"]], [row["doc_ids"]], [row["held"]], [row["lengths"]], [_packed(ids)], [_packed(words)],
        [_packed(totals)],
    ]
    kinds = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.list_(pa.int64()), *[pa.binary()] * 3]
    names = ["block", "doc_ids", "held", "lengths", "ids", "words", "totals"]
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


_PARTS = ["b_middle", "b_third", "b_count", "b_total", "t_middle", "t_first", "t_third", "t_count"]


def _gram_requests(batches: Iterator[pa.RecordBatch], plan: Plan) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            g = _grams(row, plan)
            of_bigram, of_trigram = g.shards(plan)
            bigrams = dict(_rows_by(of_bigram, plan.n_shards))
            trigrams = dict(_rows_by(of_trigram, plan.n_shards))
            none = np.zeros(0, np.int64)
            for shard in sorted(bigrams.keys() | trigrams.keys()):
                b, t = bigrams.get(shard, none), trigrams.get(shard, none)
                parts = [
                    g.words[g.bigrams[b, 0]], g.words[g.bigrams[b, 1]], g.bigram_counts[b], g.totals[g.bigrams[b, 0]],
                    *(g.words[g.trigrams[t, j]] for j in range(3)), g.trigram_counts[t],
                ]
                packed = [_packed(p.astype(np.uint64 if name == "b_total" else np.uint32)) for name, p in zip(_PARTS, parts)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([shard], pa.int32()), pa.array([row["block"]], pa.int64()),
                     *(pa.array([p], pa.binary()) for p in packed)],
                    names=["shard", "block", *_PARTS],
                )


def _summed(keys: list[np.ndarray], counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct rows of the keys in order, their counts)"""
    if not len(counts):
        return np.zeros((0, len(keys)), np.int64), np.zeros(0, np.int64)
    firsts = np.unique(keys[0][np.flatnonzero(np.diff(keys[0], prepend=-1))])  # the keys come in sorted runs
    step = max(int(k.max()) for k in keys[1:]) + 1
    if len(firsts) * step ** (len(keys) - 1) < 2**63:
        joint = np.searchsorted(firsts, keys[0])
        for k in keys[1:]:
            joint = joint * step + k
        order = np.argsort(joint, kind="stable")
    else:
        order = np.lexsort(keys[::-1])
    sorted_ = [k[order] for k in keys]
    new = np.ones(len(order), bool)
    new[1:] = np.any([k[1:] != k[:-1] for k in sorted_], axis=0)
    begin = np.flatnonzero(new)
    return np.stack([k[begin] for k in sorted_], axis=1), np.add.reduceat(counts[order], begin)


def build_trie(parts: dict[str, np.ndarray], floor: float) -> Trie:
    """The trie of the n-grams that occur in training among those sent to a shard; all shards share the floor."""
    b, t = parts["b_count"] > 0, parts["t_count"] > 0
    bigrams, times = _summed([parts["b_middle"][b], parts["b_third"][b]], parts["b_count"][b])
    run = np.flatnonzero(np.diff(parts["b_middle"], prepend=-1))
    middles, first = np.unique(parts["b_middle"][run], return_index=True)
    total = parts["b_total"][run[first]][np.searchsorted(middles, bigrams[:, 0])] if len(bigrams) else times
    trigrams, counts = _summed([parts[f"t_{x}"][t] for x in ("middle", "first", "third")], parts["t_count"][t])
    return Trie.build(bigrams, 0.5 * times / np.maximum(total, 1), trigrams, counts, floor)


def _answer_shard(group: pa.Table, floor: float) -> pa.Table:
    columns = {n: group[n].to_pylist() for n in _PARTS}
    pieces = {
        n: [_unpacked(x, np.uint64 if n == "b_total" else np.uint32).astype(np.int64) for x in columns[n]] for n in _PARTS
    }
    parts = {n: np.concatenate(x) for n, x in pieces.items()}
    trie = Trie.from_buffer(build_trie(parts, floor).to_bytes())
    bigram = trie.bigram(parts["b_middle"], parts["b_third"])
    share, left = trie.trigram(parts["t_first"], parts["t_middle"], parts["t_third"])
    of_b, of_t = starts(np.array([len(x) for x in pieces["b_third"]])), starts(np.array([len(x) for x in pieces["t_third"]]))
    rows = [
        (_packed(bigram[a:b].astype(np.uint8)), _packed(share[c:d]), _packed(left[c:d]))
        for a, b, c, d in zip(of_b, of_b[1:], of_t, of_t[1:])
    ]
    names = ["block", "shard", "floor", "bigram", "trigram", "left"]
    floors = pa.array([trie.floor] * len(rows), pa.float64())
    return pa.table(
        [group["block"].combine_chunks(), group["shard"].combine_chunks(), floors,
         *(pa.array(c, pa.binary()) for c in zip(*rows))],
        names=names,
    )


_SCORED = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
)


def _score_block(block: pa.Table, answers: pa.Table, plan: Plan) -> pa.Table:
    row = block.to_pylist()[0]
    g = _grams(row, plan)
    found = {a["shard"]: a for a in answers.to_pylist()}
    bigram, share, left = np.zeros(len(g.bigrams)), np.zeros(len(g.trigrams)), np.zeros(len(g.trigrams))
    of_bigram, of_trigram = g.shards(plan)
    for shard, at in _rows_by(of_bigram, plan.n_shards):
        bigram[at] = levels(found[shard]["floor"])[_unpacked(found[shard]["bigram"], np.uint8)]
    for shard, at in _rows_by(of_trigram, plan.n_shards):
        of_code = levels(found[shard]["floor"])
        share[at] = of_code[_unpacked(found[shard]["trigram"], np.uint8)]
        left[at] = of_code[_unpacked(found[shard]["left"], np.uint8)]
    one = plan.unigram(g.totals)
    count = g.totals[g.third]
    p = one[g.third]
    edges = starts(g.lengths)
    middle = np.roll(g.third, 1)
    middle[edges[:-1]] = np.searchsorted(g.words, START)
    seen = g.totals[middle] > 0
    two = np.where(g.bigram_of >= 0, bigram[g.bigram_of] if len(bigram) else 0.0, 0.0)
    p = np.where(seen, two + 0.5 * p, p)
    rest = np.where(g.trigram_of >= 0, left[g.trigram_of] if len(left) else 0.0, 0.0)
    three = np.where(g.trigram_of >= 0, share[g.trigram_of] if len(share) else 0.0, 0.0)
    p = np.where(rest > 0, three + rest * p, p)
    add = lambda x: np.add.reduceat(x, edges[:-1]) if len(g.lengths) else np.zeros(0)
    return pa.table({
        "doc_id": pa.array(row["doc_ids"], pa.int64()), "held_out": pa.array(row["held"], pa.bool_()),
        "n_tokens": pa.array(g.lengths, pa.int64()), "n_known": pa.array(add((count > 0).astype(np.int64)), pa.int64()),
        "train_tokens": pa.array(np.full(len(g.lengths), plan.tokens), pa.int64()),
        "base_score": pa.array(add(np.log10(one[g.third])), pa.float64()),
        "score": pa.array(add(np.log10(np.minimum(p, 1.0))), pa.float64()),
    })


def score_texts(docs: DataFrame, modulus: int = 7, held_out: int = 2, shard_tokens: int = 500_000) -> DataFrame:
    """The scores of every row of (doc_id, text), learning from the rows outside the fold."""
    spark = docs.sparkSession
    folder = new_folder(spark, "lm-blocks")
    cut = partial(_blocks, modulus=modulus, held_out=held_out)
    docs.select("doc_id", "text").mapInArrow(cut, _BLOCK).write.parquet(folder)
    blocks = spark.read.schema(_BLOCK).parquet(folder)
    learnt = F.aggregate("held", F.lit(0).cast("long"), lambda a, x: a + F.when(x, 0).otherwise(1))
    size = F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x)
    n_docs, n_words = blocks.agg(F.sum(learnt), F.sum(size)).first()
    n_docs, n_words = n_docs or 0, n_words or 0
    n_shards = max(128, n_words // shard_tokens + 1)

    def count_words(group: pa.Table) -> pa.Table:
        return _count_words(group, n_shards)

    asked = blocks.select("block", "words", "counts").mapInArrow(
        partial(_word_requests, n_shards=n_shards), "shard int, block long, words binary, counts binary"
    )
    counted = materialize(
        asked.groupBy("shard").applyInArrow(
            count_words, "block long, shard int, numbers binary, totals binary, distinct long, tokens long, largest long"
        ),
        "lm-words",
    )
    totals = F.sum("distinct"), F.sum("tokens"), F.max("largest")
    distinct, tokens, largest = counted.filter("block < 0").agg(*totals).first()
    plan = Plan(
        n_shards, max(1, shard_tokens // 2), (tokens or 0) + n_docs, (distinct or 0) + (n_docs > 0), n_docs,
        floor_of(max(largest or 0, n_docs)),
    )
    if n_words < shard_tokens * n_shards // 2:  # a small table: split by what a shard holds
        plan.most = max(1, n_words // n_shards // 2)

    number = partial(_number_block, plan=plan)
    answers = counted.filter("block >= 0").drop("distinct", "tokens", "largest")
    numbered = blocks.drop("counts").groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(number, _NUMBERED)
    numbered = materialize(numbered, "lm-numbered")
    files.delete(spark, folder)

    asked = numbered.mapInArrow(
        partial(_gram_requests, plan=plan), "shard int, block long, " + ", ".join(f"{p} binary" for p in _PARTS)
    )
    answer = lambda group: _answer_shard(group, plan.floor)
    found = asked.groupBy("shard").applyInArrow(
        answer, "block long, shard int, floor double, bigram binary, trigram binary, left binary"
    )
    score = partial(_score_block, plan=plan)
    return numbered.groupBy("block").cogroup(found.groupBy("block")).applyInArrow(score, _SCORED)
