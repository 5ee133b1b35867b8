"""The pipeline's stages against the operators' own results."""

import collections

import corpus_pipeline
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from stratum.llm import line_crf, registry, toxicity
from tests.conftest import SF_DIR
from tests.llm.test_operators import EDGE, WORDS, edge_dir, empty_dir, lower, plain_components  # noqa: F401


def ids(df):
    return {r.doc_id for r in df.select("doc_id").collect()}


def test_stages_keep_what_the_operators_let_pass(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, everything = docs.columns, ids(docs)
    toxic = {r.doc_id for r in registry.op5_toxicity(spark, SF_DIR).collect() if r.predicted}
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = ids(docs)
        stage(spark, docs, SF_DIR).write.parquet(f"{tmp_path}/{number}")
        docs = spark.read.parquet(f"{tmp_path}/{number}")
        assert ids(docs) <= before and docs.count() == len(ids(docs))
        if name == "toxicity":
            assert ids(docs) == everything - toxic
        if number < 4:
            assert docs.columns == columns
    assert ids(docs) == before and len(before) > 500


def plain_hits(text, items, length=13):
    """(words, words within a window that a benchmark text holds too) of a text."""
    w, hit = WORDS.findall(lower(text)), set()
    for item in items:
        v = WORDS.findall(lower(item))
        n = min(length, len(v))
        windows = {tuple(v[i : i + n]) for i in range(len(v) - n + 1)} if n else set()
        hit.update(j for i in range(len(w) - n + 1) if tuple(w[i : i + n]) in windows for j in range(i, i + n))
    return len(w), len(hit)


def plain_stages(spark, folder, docs):
    """What each stage should keep of the rows it is given: its name and a function of them."""
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    items = [r.text for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]

    def judged(score, bad):
        def kept(rows):
            frame = spark.createDataFrame(rows, "doc_id long, text string")
            keyed = frame.withColumn("text_key", F.xxhash64("text"))
            out = {(r.doc_id, r.text_key) for r in score(frame, labels).collect() if r.predicted == bad}
            return [(r.doc_id, r.text) for r in keyed.collect() if (r.doc_id, r.text_key) not in out]

        return kept

    def near_duplicates(rows):
        ranked = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
        found = plain_components(list(enumerate(t for _, t in ranked)))
        return [r for i, r in enumerate(ranked) if found[i][1] == i]

    def clean(rows):
        counts = [(r, *plain_hits(r[1], items)) for r in rows]
        return [r for r, n, hit in counts if not (hit and 20 * hit >= n)]

    return [judged(toxicity.score_toxicity, 1), judged(line_crf.score_quality, 0), near_duplicates, clean]


def check_stages(spark, folder, docs, scratch):
    """Runs the stages on (doc_id, text) rows, each against its plain version; the number of rows after each."""
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    rows, sizes = [(r.doc_id, r.text) for r in docs.collect()], []
    plain = plain_stages(spark, folder, docs)
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, folder).write.parquet(f"{scratch}/{number}")
        docs = spark.read.parquet(f"{scratch}/{number}")
        if number < len(plain):
            rows = plain[number](rows)
            found = collections.Counter((r.doc_id, r.text) for r in docs.collect())
            assert found == collections.Counter(rows), name
        sizes.append(len(rows))
    found = collections.Counter((r.doc_id, tuple(r.ids)) for r in docs.collect())
    assert found == collections.Counter((i, tuple(library.encode(t or "", add_eos=True))) for i, t in rows)
    return sizes


def test_stages_equal_plain_versions(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").filter("doc_id < 300")
    sizes = check_stages(spark, SF_DIR, docs, tmp_path)
    assert all(a > b for a, b in zip([docs.count(), *sizes], sizes[:4]))  # every stage has something to reject


def test_stages_on_edge_cases(spark, edge_dir, tmp_path):  # noqa: F811
    docs = spark.read.parquet(f"{edge_dir}/documents.parquet").select("doc_id", "text")
    check_stages(spark, edge_dir, docs, tmp_path)


def test_run_on_edge_cases_keeps_columns_and_ids(spark, edge_dir):  # noqa: F811
    out = corpus_pipeline.run(spark, edge_dir)
    found = [r.doc_id for r in out.collect()]
    assert out.columns == ["doc_id", "n_tokens", "ids", "text"]
    assert set(found) <= {i for i, _ in EDGE}


def test_rows_without_or_with_a_shared_id_are_judged_by_their_own_text(spark):
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    scored = toxicity.score_toxicity(docs, labels).filter("predicted = 1").select("doc_id").limit(1)
    toxic = docs.join(scored, "doc_id").first().text
    extra = [(None, toxic, None), (0, toxic, "x"), (None, "a quiet walk along the river", None)]
    more = docs.unionByName(spark.createDataFrame(extra, "doc_id long, text string, lang string"), allowMissingColumns=True)
    kept = corpus_pipeline.toxicity_stage(spark, more, SF_DIR)
    found = collections.Counter((r.doc_id, r.text) for r in kept.filter("doc_id is null or doc_id = 0").collect())
    clean = [r for r in docs.filter("doc_id = 0").collect()]
    assert found == collections.Counter([(0, clean[0].text), (None, extra[2][1])])
    assert kept.filter(F.col("text") == toxic).isEmpty()


@pytest.mark.parametrize("far", [False, True])
def test_near_duplicates_without_ids_leave_one(spark, far):
    text = " ".join(f"word{i}" for i in range(60))
    rows = [(None, text), (None, text + " more"), (9, text), (9, "other " * 3 + text), (4, "alone and short"), (None, None), (None, "")]
    rows += [((1 << 63) - 1, "far beyond the others")] if far else []
    docs = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "doc_id long, text string, component_id int")
    kept = corpus_pipeline.near_duplicate_stage(spark, docs, SF_DIR)
    assert kept.columns == docs.columns
    found = collections.Counter((r.doc_id, r.text) for r in kept.collect())
    nines = [r for r in found if r[0] == 9]
    others = [(4, "alone and short"), (None, None), (None, ""), *rows[7:]]
    assert len(nines) == 1 and found == collections.Counter([nines[0], *others])


def test_run_on_empty_tables(spark, empty_dir):  # noqa: F811
    assert corpus_pipeline.run(spark, empty_dir).collect() == []
