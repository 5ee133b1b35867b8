"""Labelled rows to learn from: the fold, and bounded samples of it."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def in_fold(doc_id: Column, modulus: int, remainder: int) -> Column:
    """crc32 of the doc_id as text, modulo; a null doc_id is in no such fold."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % modulus == remainder, F.lit(False))


def with_text_key(docs: DataFrame) -> DataFrame:
    """(doc_id, text, text_key): a row's decision is that of its doc_id and text, whatever else they share."""
    return docs.select("doc_id", "text", F.xxhash64("text").alias("text_key"))


def training_labels(labels: DataFrame, column: str, modulus: int, held_out: int) -> DataFrame:
    """(doc_id, label), a row per doc_id; of contradicting labels the larger counts."""
    rows = labels.select("doc_id", F.col(column).cast("int").alias("label"))
    rows = rows.filter(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1))
    rows = rows.filter(~in_fold(F.col("doc_id"), modulus, held_out))
    return rows.groupBy("doc_id").agg(F.max("label").alias("label"))


def sample(
    docs: DataFrame, labels: DataFrame, rows_per_label: dict[int, int], longest: int
) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(texts, labels, weights) of about so many labelled rows of each label, chosen by a hash of doc_id.

    Only texts of up to `longest` bytes are drawn, and of a doc_id that repeats one of them, so its size is bounded by
    the parameters. The weights make up for the shares drawn. Repeated texts count once.
    """
    counts = {r.label: r.n for r in labels.groupBy("label").agg(F.count("*").alias("n")).collect()}
    scale = 1_000_000  # twice, one inside the other: the least share of the largest class still draws rows
    draw, weight = F.lit(False), {}
    for label, most in rows_per_label.items():
        share = min(1.0, most / max(counts.get(label, 0), 1))
        weight[label] = 1 / share
        lot = F.pmod(F.xxhash64(F.col("doc_id"), F.lit(label)), F.lit(scale)) * scale
        lot += F.pmod(F.xxhash64(F.lit("finer"), F.col("doc_id")), F.lit(scale))
        draw |= (F.col("label") == label) & (lot < F.lit(int(share * scale**2) + 1))
    chosen = labels.filter(draw)
    found = (
        docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
        .filter(F.octet_length("text") <= longest)
        .join(F.broadcast(chosen), "doc_id")
        .groupBy("doc_id", "label")
        .agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))
        .toArrow()
    )
    best = dict(zip(found["text"].to_pylist(), found["label"].to_pylist()))
    texts = sorted(best)
    y = np.array([best[t] for t in texts], np.float64)
    return texts, y, np.array([weight[int(v)] for v in y], np.float64)


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, penalty: float = 1.0, rounds: int = 30) -> np.ndarray:
    """Coefficients of a logistic regression by Newton steps; y may be probabilities. The last column is constant."""
    coefficients = np.zeros(x.shape[1])
    ridge = np.full(x.shape[1], penalty)
    ridge[-1] = 1e-3
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ coefficients, -30, 30)))
        gradient = x.T @ (weight * (y - p)) - ridge * coefficients
        curvature = (x * (weight * p * (1 - p))[:, None]).T @ x + np.diag(ridge)
        step = np.linalg.solve(curvature, gradient)
        coefficients += step * min(1.0, 4 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-6:
            break
    return coefficients
