"""Suffix arrays against plain sorting, and removal of repeats against a table of all 50-byte strings."""

import hashlib
import random

import numpy as np
import pytest

from stratum.llm import induced_sort, registry, suffix_dedup
from tests.conftest import SF_DIR

SCHEMA = "doc_id long, text string, block long, ids string, kept int"


@pytest.mark.parametrize("mean_bucket", [0, 1, 64])
def test_suffix_arrays_and_common_prefixes(monkeypatch, mean_bucket):
    monkeypatch.setattr(induced_sort, "_LEAST_MEAN_BUCKET", mean_bucket)
    rng = np.random.default_rng(mean_bucket)
    texts = [rng.integers(0, rng.integers(1, 6), rng.integers(0, 300)) for _ in range(150)]
    texts += [np.tile([1, 0, 2, 1], 40), np.zeros(99, int), np.arange(50), np.arange(50)[::-1]]
    for text in texts:
        values = text.tolist()
        order = induced_sort.suffix_array(text)
        assert order.tolist() == sorted(range(len(values)), key=lambda i: values[i:])
        if len(values) < 2:
            continue
        found = induced_sort.common_prefixes(text.astype(np.uint8), order, 20)
        for a, b in zip(order[:-1].tolist(), order[1:].tolist()):
            same = [x == y for x, y in zip(values[a : a + 20], values[b : b + 20])]
            assert found[b] == (same.index(False) if False in same else len(same))


def test_a_depth_orders_that_many_symbols():
    rng = np.random.default_rng(7)
    text = np.concatenate([rng.integers(0, 3, 500).astype(np.uint8)] * 3)
    order = induced_sort.suffix_array(text, 50)
    raw = text.tobytes()
    prefixes = [raw[i : i + 50] for i in order.tolist()]
    assert prefixes == sorted(prefixes) and sorted(order.tolist()) == list(range(len(raw)))


def test_piece_hashes_tell_places_not_neighbours():
    data = np.frombuffer(b"abcdefgh" * 20 + b"xabcdefgh" * 9, np.uint8)
    for length in (1, 5, 24, 50):
        found, pieces = suffix_dedup.piece_hashes(data, length), {}
        raw = data.tobytes()
        assert len(found) == len(raw) - length + 1
        for i, value in enumerate(found.tolist()):
            assert pieces.setdefault(raw[i : i + length], value) == value
        assert len(set(pieces.values())) == len(pieces)


def plain(rows):
    first, raw = {}, [(i, (t or "").encode()) for i, t in rows]
    for doc_id, text in raw:
        for at in range(len(text) - 49) if doc_id is not None else ():
            piece = text[at : at + 50]
            first[piece] = min(first.get(piece, doc_id), doc_id)
    for doc_id, text in raw:
        gone = bytearray(len(text))
        for at in range(len(text) - 49) if doc_id is not None else ():
            if first[text[at : at + 50]] < doc_id:
                gone[at : at + 50] = b"1" * 50
        kept = bytes(c for c, g in zip(text, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (not i or not gone[i - 1]))
        yield doc_id, len(text), len(text) - len(kept), spans, hashlib.sha256(kept).hexdigest()


def ordered(rows):
    return sorted(map(tuple, rows), key=lambda r: tuple((x is None, x) for x in r))


def check(spark, rows, partitions=3, **options):
    frame = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SCHEMA).repartition(partitions)
    found = []
    for r in suffix_dedup.remove_repeats(frame, **options).collect():
        assert r.n_removed == sum(s.end - s.begin for s in r.spans) and len(r.kept) == r.n_bytes - r.n_removed
        found.append((r.doc_id, r.n_bytes, r.n_removed, len(r.spans), hashlib.sha256(r.kept).hexdigest()))
    assert ordered(found) == ordered(plain(rows))


def passages(rng, n):
    words = ["lorem", "ipsum", "dolor", "é", "日本語", "x", "the", "license"]
    parts = [" ".join(rng.choice(words) for _ in range(rng.randrange(3, 40))) for _ in range(12)]
    for i in range(n):
        yield i, "".join(rng.choice(parts)[rng.randrange(4) :] for _ in range(rng.randrange(5)))


def test_given_documents(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    query = registry.queries()["op13_suffix_dedup"](spark, SF_DIR)
    assert query.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert ordered(query.collect()) == ordered(plain(rows))


def test_small_passages_blocks_and_shards(spark):
    rows = list(passages(random.Random(1), 300))
    check(spark, rows)
    check(spark, rows, bucket_bytes=2000)


def test_hot_anchors_send_their_windows_one_by_one(spark):
    # An everyday phrase in ever new surroundings, some of them shared.
    rng = random.Random(2)
    phrase = "this phrase of the day stands everywhere and is long"
    around = ["".join(rng.choice("abcdefgh ") for _ in range(40)) for _ in range(60)]
    rows = [(i, rng.choice(around) + phrase[: rng.randrange(24, 52)] + rng.choice(around)) for i in range(400)]
    check(spark, rows, hot_runs=20)


def test_nulls_repeats_and_short_texts(spark):
    long = "".join(chr(97 + i * 7 % 26) + str(i) for i in range(60))
    rows = [(1, None), (2, ""), (3, long[:49]), (4, long[:50]), (5, long[:50]), (5, long[:50]), (6, "é" * 60), (7, "é" * 40),
            (None, long), (None, None), (8, long), (8, long), (-9, long[20:90]), (10, "z" * 500), (11, "z" * 300)]
    check(spark, rows)
    check(spark, rows, partitions=1)
    check(spark, [(1, None)])


def test_long_texts_of_one_byte_and_of_one_period(spark):
    rows = [(1, "a" * 60_000), (2, "a" * 70_000 + "b"), (3, "abc" * 20_000), (4, "\n" * 50_000), (5, "xabc" + "abc" * 9000)]
    check(spark, rows)
