"""Hard negatives by exact integer scores: residue-number-system products, then windowed selection.

Vectors become integer components, floor(256 * x). Scores are inner products of those, exact: components are reduced
modulo a few primes below 1024, one float32 matrix product is made for each prime (sums of 64 products of centred
residues stay below 2^24, where float32 is exact), and the signed scores come back by Chinese remaindering in balanced
mixed radix. As many primes are taken as the largest squared norm demands (by Cauchy and Schwarz no score is larger).

Anchors go out in slices of a bounded number of components, each broadcast once; the candidates stay where they are
read, so nothing is shuffled but each task's few best rows for each anchor. A slice makes two passes: the first finds
each anchor's positives; their scores open a window, and the second takes the best negatives inside each. All rows are
candidates of every anchor.

Rows with a null id, label or vector, or with any null or non-finite component take no part, nor do rows whose squared
norm reaches 2^61, as no long could hold their scores. Only vectors of one length are compared with one another. Rows
of an anchor's own id are neither its positives nor its negatives. A repeated anchor row is one anchor; a repeated
candidate row counts as often as it stands. Ties go to the smaller id. An empty table gives no rows, other columns are
not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratum.sources.scratch import materialize, new_folder

ANCHORS_PER_SLICE = 1 << 14
POSITIVES, NEGATIVES = 5, 3
#: A negative scores at least and at most these hundredths of the positive.
LOWEST, HIGHEST = 50, 95
_CHUNK = 64  # so many products of residues below 512 in size are exact in float32
_LARGEST_PRIME = 1024
_TILE = 1 << 11
_NONE = np.iinfo(np.int64).min


def primes(largest_score: int) -> list[int]:
    """The largest primes below 1024 whose product tells all scores of up to that size apart."""
    found, product = [], 1
    for n in range(_LARGEST_PRIME - 1, 2, -1):
        if product > 2 * largest_score + 1:
            break
        if all(n % d for d in range(2, int(n**0.5) + 1)):
            found.append(n)
            product *= n
    return found


def centred(values: np.ndarray, prime: int) -> np.ndarray:
    """Residues in -(prime // 2) ... prime // 2."""
    half = prime // 2
    return (values + half) % prime - half


def residues(components: np.ndarray, moduli: list[int]) -> list[np.ndarray]:
    return [centred(components, p).astype(np.float32) for p in moduli]


def products(left: list[np.ndarray], right: list[np.ndarray], moduli: list[int]) -> np.ndarray:
    """Exact inner products of all rows of one side with all of the other, from their residues."""
    score, weight, digits = None, 1, []
    for p, a, b in zip(moduli, left, right):
        total = np.zeros((a.shape[0], b.shape[0]), np.int64)
        for at in range(0, a.shape[1], _CHUNK):
            total += (a[:, at : at + _CHUNK] @ b[:, at : at + _CHUNK].T).astype(np.int64)
        # The next balanced digit: what the digits so far leave, divided by their weight, modulo this prime.
        known = np.zeros_like(total)
        for d, q in reversed(list(zip(digits, moduli))):
            known = (known * q + d) % p
        digit = centred((total - known) * pow(weight, -1, p), p)
        digits.append(digit)
        # Only the last digits of very large scores reach beyond a long on the way; sums modulo 2^64 end right.
        term = digit * np.int64(_wrapped(weight))
        score = term if score is None else score + term
        weight *= p
    return score


def _wrapped(value: int) -> int:
    return (value + 2**63) % 2**64 - 2**63


@dataclass
class Anchors:
    """A slice of anchors of one length, with the open windows of each (none in the first pass)."""

    ids: np.ndarray
    labels: np.ndarray
    residues: list[np.ndarray]
    moduli: list[int]
    dims: int
    low: np.ndarray | None = None
    high: np.ndarray | None = None


def vectors(table: DataFrame) -> DataFrame:
    """(vec_id, label, parts array<long>, norm) of the rows that take part, with the labels as they count here."""
    x = F.col("embedding")
    scaled = F.transform(x, lambda v: F.floor(v.cast("double") * 256))
    finite = F.forall(x, lambda v: v.isNotNull() & (F.abs(v.cast("double")) < F.lit(float("inf"))))
    norm = F.aggregate(x, F.lit(0.0), lambda t, v: t + F.floor(v.cast("double") * 256).cast("double") ** 2)
    label = F.col("label").cast("long")
    label = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    rows = table.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & x.isNotNull() & finite)
    rows = rows.select("vec_id", label.alias("label"), "embedding", norm.alias("norm"))
    return rows.filter(F.col("norm") < 2.0**61).select("vec_id", "label", scaled.alias("parts"), "norm")


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), dims)


def _best(score: np.ndarray, allowed: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(scores, ids) of each row's k best allowed columns, ties to the earlier column; _NONE where there is none."""
    score = np.where(allowed, score, _NONE)
    k = min(k, score.shape[1])
    least = np.partition(score, score.shape[1] - k, axis=1)[:, -k][:, None]
    # All that beat the k-th best, and of those equal to it the first ones.
    above = score > least
    equal = score == least
    room = k - above.sum(axis=1, keepdims=True)
    taken = above | (equal & (np.cumsum(equal, axis=1) <= room))
    column = np.nonzero(taken)[1].reshape(-1, k)
    found = np.take_along_axis(score, column, axis=1)
    order = np.lexsort((column, -np.maximum(found, _NONE + 1)), axis=1)
    column = np.take_along_axis(column, order, axis=1)
    return np.take_along_axis(found, order, axis=1), ids[column]


def _merged(held: tuple | None, new: tuple, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best of two such lists."""
    if held is None:
        return new
    score, ids = np.concatenate([held[0], new[0]], axis=1), np.concatenate([held[1], new[1]], axis=1)
    order = np.lexsort((ids, -np.maximum(score, _NONE + 1)), axis=1)[:, :k]
    return np.take_along_axis(score, order, axis=1), np.take_along_axis(ids, order, axis=1)


def _search(batches: Iterator[pa.RecordBatch], sent: Broadcast, k: int) -> Iterator[pa.RecordBatch]:
    """Each anchor's k best candidates of this task: of its own label, or of others in each of its windows."""
    anchors: Anchors = sent.value
    n = len(anchors.ids)
    windows = 1 if anchors.low is None else anchors.low.shape[1]
    best: dict[tuple[int, int], tuple] = {}
    for batch in batches:
        batch = batch.filter(pc.equal(pc.list_value_length(batch.column("parts")), anchors.dims))
        for at in range(0, batch.num_rows, _TILE):
            rows = batch.slice(at, _TILE)
            ids = rows.column("vec_id").to_numpy(zero_copy_only=False)
            order = np.argsort(ids, kind="stable")
            ids, labels = ids[order], rows.column("label").to_numpy(zero_copy_only=False)[order]
            right = residues(_matrix(rows.column("parts"), anchors.dims)[order], anchors.moduli)
            for start in range(0, n, _TILE):
                part = slice(start, min(start + _TILE, n))
                score = products([r[part] for r in anchors.residues], right, anchors.moduli)
                same = anchors.labels[part, None] == labels
                other = anchors.ids[part, None] != ids
                for w in range(windows):
                    if anchors.low is None:
                        allowed = same & other
                    else:
                        allowed = ~same & other & (score >= anchors.low[part, w, None]) & (score <= anchors.high[part, w, None])
                        if not allowed.any():
                            continue
                    best[start, w] = _merged(best.get((start, w)), _best(score, allowed, ids, k), k)
    for (start, w), (score, ids) in best.items():
        row, column = np.nonzero(score > _NONE)
        yield pa.RecordBatch.from_pydict({
            "anchor": pa.array(row + start, pa.int32()),
            "window": pa.array(np.full(len(row), w), pa.int32()),
            "vec_id": pa.array(ids[row, column], pa.int64()),
            "score": pa.array(score[row, column], pa.int64()),
        })


def _pass(rows: DataFrame, sent: Broadcast, k: int) -> DataFrame:
    """(anchor, window, rank, vec_id, score): the k best of each window over all tasks."""
    found = rows.select("vec_id", "label", "parts").mapInArrow(
        partial(_search, sent=sent, k=k), "anchor int, window int, vec_id long, score long"
    )
    order = Window.partitionBy("anchor", "window").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _numbered(column: np.ndarray, positives: pa.Table, rank: np.ndarray, n: int, k: int) -> np.ndarray:
    out = np.zeros((n, k), np.int64)
    out[positives["anchor"].to_numpy(), rank] = column
    return out


def mine(
    table: DataFrame,
    every: int = 50,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    per_slice: int = ANCHORS_PER_SLICE,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of all anchors.

    Anchors are the rows whose vec_id is divisible by `every`. What reaches the driver is a slice of anchors at a time,
    of about `per_slice` rows, and the few positives of each.
    """
    spark = table.sparkSession
    rows = materialize(vectors(table.select("vec_id", "label", "embedding")), "integer-vectors")
    chosen = materialize(rows.filter(F.col("vec_id") % every == 0).distinct(), "anchors")
    sizes = chosen.groupBy(F.size("parts").alias("dims")).agg(F.count("*").alias("n"))
    norms = rows.groupBy(F.size("parts").alias("dims")).agg(F.max("norm").alias("norm"))
    out = new_folder(spark, "hard-negatives")
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    spark.createDataFrame([], schema).write.parquet(out)
    lengths = materialize(sizes.join(norms, "dims"), "anchor-lengths")
    for dims, n, norm in lengths.toLocalIterator():
        moduli = primes(int(norm * (1 + 1e-9)) + 1)  # the norm is a rounded sum
        own = rows.filter(F.size("parts") == dims)
        slices = -(-n // per_slice)
        lot = F.pmod(F.xxhash64("vec_id", "label", "parts"), F.lit(slices))
        for number in range(slices):
            anchors = _slice(chosen.filter((F.size("parts") == dims) & (lot == number)), dims, moduli)
            if len(anchors.ids):
                _mine_slice(own, anchors, positives, negatives, out)
    return spark.read.schema(schema).parquet(out)


def _slice(rows: DataFrame, dims: int, moduli: list[int]) -> Anchors:
    found = rows.select("vec_id", "label", "parts").toArrow()
    parts = _matrix(found["parts"].combine_chunks(), dims)
    return Anchors(found["vec_id"].to_numpy(), found["label"].to_numpy(), residues(parts, moduli), moduli, dims)


def _mine_slice(rows: DataFrame, anchors: Anchors, positives: int, negatives: int, out: str) -> None:
    spark = rows.sparkSession
    sent = spark.sparkContext.broadcast(anchors)
    near = _pass(rows, sent, positives).toArrow()
    sent.destroy()
    number, rank = near["anchor"].to_numpy(), near["rank"].to_numpy() - 1
    # Whole scores from the least to the most that the hundredths allow; a positive that is missing opens no window.
    low, high = np.ones((len(anchors.ids), positives), np.int64), np.zeros((len(anchors.ids), positives), np.int64)
    score = near["score"].to_numpy().astype(object)
    low[number, rank] = -(-score * LOWEST // 100)
    high[number, rank] = score * HIGHEST // 100
    sent = spark.sparkContext.broadcast(replace(anchors, low=low, high=high))
    named = pa.table({
        "anchor": near["anchor"], "window": pa.array(rank, pa.int32()),
        "anchor_id": pa.array(anchors.ids[number], pa.int64()),
        "positive_id": near["vec_id"], "positive_score": near["score"],
    })
    hard = _pass(rows, sent, negatives).join(F.broadcast(spark.createDataFrame(named)), ["anchor", "window"])
    hard = hard.select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"),
    )
    hard.write.mode("append").parquet(out)
    sent.destroy()
