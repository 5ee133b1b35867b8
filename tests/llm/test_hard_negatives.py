"""Hard negatives against plain Python on integers, and their query against its SQL."""

import math
import random

import numpy as np
import pytest

from stratum.llm import hard_negatives, registry
from tests.compare import connect, differences
from tests.conftest import SF_DIR

SCHEMA = "vec_id long, embedding array<float>, label int, anchor int, window int, score double"


@pytest.mark.parametrize("size, dims", [(1, 1), (300, 64), (10**6, 70), (2**27, 100)])
def test_products_are_exact(size, dims):
    rng = np.random.default_rng(size)
    left, right = rng.integers(-size, size + 1, (20, dims)), rng.integers(-size, size + 1, (30, dims))
    left[0], right[0], right[1] = size, size, -size
    moduli = hard_negatives.primes(dims * size * size)
    found = hard_negatives.products(hard_negatives.residues(left, moduli), hard_negatives.residues(right, moduli), moduli)
    assert (found == left.astype(object) @ right.astype(object).T).all()


def test_best_takes_the_first_of_ties():
    score = np.array([[5, 7, 7, 7, 1], [1, 1, 1, 1, 1], [3, 2, 9, 4, 8]])
    allowed = np.array([[1, 0, 1, 1, 1], [1, 1, 1, 1, 1], [0, 0, 0, 1, 0]], bool)
    ids = np.array([10, 11, 12, 13, 14])
    found, at = hard_negatives._best(score, allowed, ids, 3)
    assert found[0].tolist() == [7, 7, 5] and at[0].tolist() == [12, 13, 10]
    assert at[1].tolist() == [10, 11, 12]
    assert found[2].tolist()[0] == 4 and (found[2][1:] == hard_negatives._NONE).all()


def plain(rows, positives=5, negatives=3):
    kept = []
    for vec_id, vector, label in rows:
        if vec_id is None or label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        parts = [math.floor(256 * float(np.float32(x))) for x in vector]
        kept.append((vec_id, (label + 1) % 10 if vec_id % 7 == 0 else label, tuple(parts)))
    out = []
    for anchor in {r for r in kept if r[0] % 50 == 0}:
        others = [(-sum(a * b for a, b in zip(anchor[2], r[2])), r[0], r[1]) for r in kept
                  if r[0] != anchor[0] and len(r[2]) == len(anchor[2])]
        others.sort()
        for score, positive, _ in [x for x in others if x[2] == anchor[1]][:positives]:
            fits = [x for x in others if x[2] != anchor[1] and -50 * score <= -100 * x[0] <= -95 * score]
            for rank, (s, negative, _) in enumerate(fits[:negatives], 1):
                out.append((anchor[0], positive, rank, negative, -score, -s))
    return sorted(out)


def check(spark, rows, **options):
    frame = spark.createDataFrame([(*r, 1, 2, 0.5) for r in rows], SCHEMA).repartition(4)
    assert sorted(map(tuple, hard_negatives.mine(frame, **options).collect())) == plain(rows)


def test_ties_repeats_lengths_and_rows_that_take_no_part(spark):
    rng = random.Random(3)
    vectors = [[1.0, 0.5], [1.0, 0.4], [0.9, 0.5], [-1.0, -0.5], [0.0, 0.0], [], [1.0], [2.0, 1.0, 0.5], None,
               [None, 1.0], [float("nan"), 1.0], [float("inf"), 1.0]]
    rows = [(rng.choice([*range(0, 400, 5), None]), rng.choice(vectors), rng.choice([0, 1, 2, 9, None])) for _ in range(1200)]
    check(spark, rows)
    check(spark, rows, per_slice=2)


def test_scores_beyond_single_precision(spark):
    rng = random.Random(4)
    rows = [(i, [rng.uniform(-30_000, 30_000) for _ in range(70)], i % 3) for i in range(300)]
    check(spark, rows)


def test_a_common_vector(spark):
    rng = random.Random(5)
    rows = [(i, [0.5, 0.5, 0.5] if i % 2 else [rng.random() for _ in range(3)], i % 4) for i in range(1500)]
    check(spark, rows)


def test_query_equals_its_sql(spark):
    query = registry.queries()["op12_hard_negatives"](spark, SF_DIR)
    assert differences(query, connect(SF_DIR), registry.oracle_sql()["op12_hard_negatives"]) is None
