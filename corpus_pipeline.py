"""From raw documents to token ids: toxicity, quality, near duplicates, benchmark passages, encoding.

Every stage takes the documents that its predecessor kept, as a written table, and returns those that it keeps, with
all their columns; the last one returns their token ids. Decisions belong to rows: a rejected text is removed by its
doc_id and text together, null ids included, so rows that share an id are judged each by its own text. Null and empty
texts pass a stage unless it rejects them by its own score. An empty table runs through all stages. While they
decide, the session's Arrow batches are bounded by bytes, as texts differ much in length.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.llm import decontaminate, jaccard_join, line_crf, piece_bpe, toxicity
from stratum.sources.scratch import materialize

#: Rejected ids are broadcast up to this number, and joined by a shuffle beyond it.
MOST_BROADCAST_IDS = 1_000_000
BATCH_BYTES = "8m"
_BATCHES = "spark.sql.execution.arrow.maxBytesPerBatch"
_ID = "_id_of_stage"


@contextmanager
def _bounded_batches(spark: SparkSession) -> Iterator[None]:
    held = spark.conf.get(_BATCHES, None)
    spark.conf.set(_BATCHES, BATCH_BYTES)
    try:
        yield
    finally:
        spark.conf.set(_BATCHES, held) if held is not None else spark.conf.unset(_BATCHES)


def _same(left: str, right: str) -> Column:
    return F.expr(f"{left}.doc_id <=> {right}.doc_id and xxhash64({left}.text) <=> {right}.text_key")


def _without(docs: DataFrame, rejected: DataFrame) -> DataFrame:
    """The rows whose doc_id and text are not among the rejected (doc_id, text_key), nulls included."""
    rejected = materialize(rejected.select("doc_id", "text_key").distinct(), "rejected")
    few = rejected.count() <= MOST_BROADCAST_IDS
    gone = (F.broadcast(rejected) if few else rejected).alias("gone")
    return docs.alias("docs").join(gone, _same("docs", "gone"), "left_anti").select(docs.columns)


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weakly supervised classifier finds toxic go."""
    with _bounded_batches(spark):
        scored = toxicity.score_toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
        return _without(docs, scored.filter("predicted = 1"))


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose lines are found bad on the whole go."""
    with _bounded_batches(spark):
        scored = line_crf.score_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
        return _without(docs, scored.filter("predicted = 0"))


def _with_own_ids(docs: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """(rows with `_ID`, a number of their own, and the rows whose number isn't their doc_id).

    A doc_id that stands once is its row's number. Rows without one, or whose doc_id repeats, get numbers beyond all
    doc_ids; only they are stored for it, unless there is no room beyond, and then all rows are numbered.
    """
    ids = docs.select("doc_id").filter("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("times"))
    repeated = materialize(ids.filter("times > 1").select("doc_id"), "repeated-ids")
    if repeated.isEmpty() and docs.filter("doc_id is null").isEmpty():
        return docs.withColumn(_ID, F.col("doc_id")), None
    highest = docs.agg(F.max("doc_id")).first()[0]
    if highest is not None and highest >= 1 << 62:
        numbered = materialize(docs.withColumn(_ID, F.monotonically_increasing_id()), "numbered")
        return numbered, numbered
    odd = docs.join(repeated, "doc_id", "left_semi").unionByName(docs.filter("doc_id is null")).select(docs.columns)
    number = F.monotonically_increasing_id() + F.lit(max((highest or 0) + 1, 1))
    odd = materialize(odd.withColumn(_ID, number), "numbered")
    plain = docs.filter("doc_id is not null").join(repeated, "doc_id", "left_anti").select(docs.columns)
    return plain.withColumn(_ID, F.col("doc_id")).unionByName(odd), odd


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked by near-duplicate texts one stays, that of the smallest doc_id.

    Rows without a doc_id, and rows that share one, take part like all others; of rows of one doc_id in a group any
    one stays, and one without an id only where no other has one. Texts without words are in no group and stay.
    """
    with _bounded_batches(spark):
        rows, gone = _duplicates(docs)
    few = gone.count() <= MOST_BROADCAST_IDS
    return rows.join(F.broadcast(gone) if few else gone, _ID, "left_anti").select(docs.columns)


def _duplicates(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows with `_ID`, the `_ID` of those that go)"""
    rows, odd = _with_own_ids(docs)
    groups = jaccard_join.near_duplicates(rows.select(F.col(_ID).alias("doc_id"), "text"))
    groups = groups.select(F.col("doc_id").alias(_ID), "component_id")
    if odd is None:
        gone = materialize(groups.filter(F.col(_ID) != F.col("component_id")).select(_ID), "duplicates")
    else:
        groups = materialize(groups, "groups")
        named = groups.join(odd.select(_ID, F.col("doc_id").alias("id"), F.lit(True).alias("odd")), _ID, "left")
        real = F.when(F.col("odd"), F.col("id")).otherwise(F.col(_ID))
        ranked = F.struct(real.isNull().alias("unnamed"), real.alias("id"), F.col(_ID))
        first = named.groupBy("component_id").agg(F.min(ranked)[_ID].alias("first"))
        gone = materialize(groups.join(first, "component_id").filter(F.col(_ID) != F.col("first")).select(_ID), "duplicates")
    return rows, gone


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with too many words from benchmark passages go."""
    with _bounded_batches(spark):
        found = decontaminate.find_contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
        rule = decontaminate.contaminated(F.col("n_hit"), F.col("n_words"))
        return _without(docs, found.filter(rule))


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of every document that is left, and the text that they decode to.

    Its rows are made when they are written, so the bound on batches stays set.
    """
    spark.conf.set(_BATCHES, BATCH_BYTES)
    return piece_bpe.round_trip(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("toxicity", toxicity_stage),
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("encoding", encoding_stage),
]

#: Classifiers, components and encoding are beyond SQL; tests/llm compares the stages of the two classifiers with their
#: operators' predictions and the other stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = materialize(docs, f"pipeline-{name}")
    return docs
