"""The operators against plain versions of their contracts, on the given tables and on small edge cases."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
import tokenizers

from stratum.llm import (
    decontaminate, elias_fano, jaccard_join, licenses, ngram_lm, piece_bpe, registry, simple8b, slots, stable_knn, toxicity,
)
from tests.conftest import SF_DIR

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
EDGE = [(1, None), (2, ""), (3, " \n "), (4, "a b"), (5, "A  b"), (6, "a b c d e f"), (7, "a b c d e f"), (7, "a b c d e f"),
        (8, "under the MIT License, cc by-nc cc by nc\nThe GNU General Public License, version 3."), (9, "é ß 日本 <|endoftext|> x's " * 40),
        (10, "w " * 30_000), (None, "a b c d e f")]


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


@pytest.fixture(scope="module")
def given(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}


@pytest.fixture(scope="module")
def edge_dir(spark, tmp_path_factory):
    """Edge cases with columns whose names the operators use themselves."""
    folder = str(tmp_path_factory.mktemp("edge"))
    clash = "doc_id long, text string, lang string, source string, n_chars long, n long, words string, label int, score double"
    rows = [(i, t, None, None, None, 1, "x", 1, 0.5) for i, t in EDGE]
    spark.createDataFrame(rows, clash).write.parquet(f"{folder}/documents.parquet")
    items = [(1, "a b c d e f"), (2, None), (3, ""), (None, "zz")]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    marks = [(4, 1, 0), (4, 1, 0), (6, 0, 1), (None, 1, 1), (8, None, None)]
    spark.createDataFrame(marks, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    nan = float("nan")
    vectors = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.5, 0.5]), (20, [0.0, 2.0]), (3, None), (4, [0.0, 0.0]), (5, [nan, 1.0]),
               (6, [None, 1.0]), (None, [1.0, 1.0])]
    spark.createDataFrame([(i, v, 1) for i, v in vectors], "vec_id long, embedding array<float>, label int").write.parquet(
        f"{folder}/embeddings.parquet"
    )
    return folder


@pytest.fixture(scope="module")
def empty_dir(spark, edge_dir, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("empty"))
    for name in ("documents", "benchmark", "labels", "embeddings"):
        spark.read.parquet(f"{edge_dir}/{name}.parquet").limit(0).write.parquet(f"{folder}/{name}.parquet")
    return folder


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_empty_tables_give_no_rows(spark, empty_dir, name):
    assert registry.queries()[name](spark, empty_dir).collect() == []


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_edge_cases_keep_every_row(spark, edge_dir, name):
    rows = registry.queries()[name](spark, edge_dir).collect()
    if name.startswith("op12_"):
        assert rows == []  # one label in all
    elif name.startswith("op3_"):
        assert [(r.query_id, r.rank, r.vec_id) for r in sorted(rows)] == [
            (0, 1, 1), (0, 2, 2), (0, 3, 20), (20, 1, 2), (20, 2, 0), (20, 3, 1)
        ]
    else:
        found = collections.Counter(r.doc_id for r in rows)
        assert found == collections.Counter(i for i, _ in EDGE)


def test_simple8b_round_trip():
    rng = np.random.default_rng(1)
    for n in (0, 1, 239, 241, 1024, 3000):
        for top in (1, 2, 17, 1 << 16, 1 << 31, 1 << 63):
            values = rng.integers(0, top, n, dtype=np.uint64)
            values[rng.random(n) < 0.5] = 0
            words, offsets, places, escaped = simple8b.pack(values)
            assert (simple8b.unpack(words, offsets, n, places, escaped) == values).all()


def test_elias_fano_searches():
    rng = np.random.default_rng(2)
    for n, top in ((1, 5), (9, 3), (500, 100_000), (500, 40)):
        values = np.sort(rng.integers(0, top, n))
        sequence = elias_fano.EliasFano.of(values)
        asked = rng.integers(0, top + 9, 300)
        assert (sequence[np.arange(n)] == values).all()
        assert (sequence.successor(asked) == np.searchsorted(values, asked)).all()


def test_op1_equals_a_plain_model(spark, given):
    rows = list(given.items())[:300]
    one, two, three = collections.Counter(), collections.Counter(), collections.Counter()
    context, kinds, n_docs, words = collections.Counter(), collections.defaultdict(set), 0, {}
    for doc, text in rows:
        w = words[doc] = ["<s>", "<s>", *SPACED.findall(lower(text)), "</s>"]
        if zlib.crc32(str(doc).encode()) % 7 != 2:
            n_docs += 1
            for a, b, c in zip(w, w[1:], w[2:]):
                one[c] += 1
                two[b, c] += 1
                three[a, b, c] += 1
                context[a, b] += 1
                kinds[a, b].add(c)
    total = sum(one.values())
    stored = lambda p: elias_fano.LEVELS[elias_fano.quantised(np.array([p]))][0]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for r in ngram_lm.score_texts(frame, shard_tokens=500).collect():
        w, base, score = words[r.doc_id], 0.0, 0.0
        for a, b, c in zip(w, w[1:], w[2:]):
            p = (one[c] + 1) / (total + len(one) + 1)
            base += np.log10(p)
            before = n_docs if b == "<s>" else one[b]
            p = stored(0.5 * two[b, c] / before) + 0.5 * p if before else p
            n, k = context[a, b], len(kinds[a, b])
            p = stored(three[a, b, c] / (n + k)) + stored(k / (n + k)) * p if n else p
            score += np.log10(min(p, 1))
        assert (r.n_tokens, r.train_tokens) == (len(w) - 2, total)
        assert r.n_known == sum(one[c] > 0 for c in w[2:])
        assert abs(r.base_score - base) < 1e-6 and abs(r.score - score) < 1e-6


def test_op1_tells_rare_followers_of_very_frequent_words():
    total, rare = 300_000_000, 1000
    third = np.arange(10, 10 + rare)
    counts = np.where(np.arange(rare) == 0, total - rare + 1, 1)
    parts = {"b_middle": np.full(rare, 5), "b_third": third, "b_count": counts, "b_total": np.full(rare, total)}
    parts |= {"t_middle": np.full(rare, 5), "t_first": np.full(rare, 6), "t_third": third, "t_count": counts}
    trie = elias_fano.Trie.from_buffer(ngram_lm.build_trie(parts, elias_fano.floor_of(total)).to_bytes())
    of_code = elias_fano.levels(trie.floor)
    share, left = trie.trigram(parts["t_first"], parts["t_middle"], third)
    step = 10 ** (-trie.floor / 254)
    for found, p in (
        (of_code[trie.bigram(parts["b_middle"], third)], 0.5 * counts / total),
        (of_code[share], counts / (total + rare)),
        (of_code[left], np.full(rare, rare / (total + rare))),
    ):
        assert (np.maximum(found / p, p / found) <= step**0.5 * (1 + 1e-9)).all()
    assert of_code[1] < 0.5 / total


def test_op2_places_and_balances(spark, given):
    bytes_, places = collections.Counter(), collections.defaultdict(list)
    for r in registry.op2_sharding(spark, SF_DIR).collect():
        raw = (given[r.doc_id] or "").encode()
        assert (r["size"], r.text_crc32) == (len(raw) + 1, zlib.crc32(raw))
        bytes_[r.shard] += r["size"]
        places[r.shard].append(r.slot)
    assert set(bytes_) == set(range(16))
    assert max(bytes_.values()) - min(bytes_.values()) <= 0.01 * max(bytes_.values())
    assert all(sorted(p) == list(range(len(p))) for p in places.values())


def test_op2_growing_moves_slots_only_to_the_new_shard():
    load = {s: 10 + s % 7 for s in range(512)}
    before = slots.rebalanced(slots.first_map(512, 8), load, 8)
    after = slots.grown(before, load, 8)
    assert all(a == b or a == 8 for a, b in zip(after, before))
    assert sum(load[s] for s, shard in enumerate(after) if shard == 8) >= 0.9 * sum(load.values()) / 9


def test_op3_recall(spark):
    rows = spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect()
    ids, x = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], np.float64)
    found = collections.defaultdict(dict)
    for r in registry.op3_nearest_vectors(spark, SF_DIR).collect():
        found[r.query_id][r.rank] = (r.vec_id, r.score)
    hits = 0
    for query, ranks in found.items():
        score = (x[ids == query][0] * x).sum(1)
        order = [i for i in np.lexsort((ids, -score)) if ids[i] != query][:20]
        hits += len({ids[i] for i in order} & {v for v, _ in ranks.values()})
        assert all(abs(s - score[ids == v][0]) < 1e-12 for v, s in ranks.values())
    assert sorted(found) == sorted(i for i in ids if i % 20 == 0)
    assert hits >= 0.95 * 20 * len(found)


def test_op3_tree_finds_the_box_of_every_point():
    rng = np.random.default_rng(4)
    for n, most in ((1, 5), (300, 7), (300, 1000)):
        fitted = rng.integers(-4, 5, (n, 3)).astype(float)
        boxes, tree = stable_knn.kd_tree(fitted, most)
        points = np.concatenate([fitted, rng.standard_normal((200, 3)) * 5])
        leaf = tree.leaf_of(points)
        for point, number in zip(points, leaf):
            inside = [i for i, (_, low, high) in enumerate(boxes) if ((point >= low) & (point < high)).all()]
            assert inside == [number]
        assert sorted(np.concatenate([at for at, _, _ in boxes])) == list(range(n))


def test_op3_blocks_of_visits_change_no_result(spark):
    rng = np.random.default_rng(9)
    rows = [(i, rng.standard_normal(8).tolist()) for i in range(600)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")

    def found(**sizes):
        return sorted(map(tuple, stable_knn.nearest(frame, **sizes).collect()))

    whole = found(cell_rows=100)
    assert len(whole) == 30 * 20 and found(cell_rows=100, query_rows=2) == whole
    cells = found(cell_rows=5, query_rows=1)
    assert len({r[:1] + r[2:3] for r in cells} & {r[:1] + r[2:3] for r in whole}) >= 0.95 * 600


def plain_nearest(rows, k=20):
    """For each query row its k best rows of the same length."""
    out = collections.Counter()
    for query, x in dict.fromkeys((i, tuple(v)) for i, v in rows if i % 20 == 0):
        near = [(-sum(a * b for a, b in zip(x, y)), i) for i, y in rows if i != query and len(y) == len(x)]
        out.update((query, rank, i) for rank, (_, i) in enumerate(sorted(near)[:k], 1))
    return out


def nearest_ranks(spark, rows):
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    return collections.Counter((r.query_id, r["rank"], r.vec_id) for r in stable_knn.nearest(frame).collect())


def test_op3_searches_every_length(spark):
    rng = np.random.default_rng(5)
    rows = [(i, rng.integers(-9, 10, 6).astype(float).tolist()) for i in range(200)]
    rows += [(1000 + i, [1.0 + i, 2.0, 3.0]) for i in range(30)] + [(2000, [1.0])]
    rows = [(i, v) for i, v in rows if any(v)]
    found = nearest_ranks(spark, rows)
    assert found == plain_nearest(rows) and len(found) == 240


def test_op3_repeated_query_rows_are_one_query(spark):
    rng = np.random.default_rng(6)
    rows = [(i, rng.integers(-9, 10, 6).astype(float).tolist()) for i in range(1, 200)]
    rows += [rows[39], rows[39], rows[59], (80, [9.0, 8.0, 7.0, 0.0, -1.0, 2.0])]
    found = nearest_ranks(spark, rows)
    assert found == plain_nearest(rows) and sum(query == 40 for query, _, _ in found) == 20


def plain_components(rows):
    def shingles(text):
        w = SPACED.findall(lower(text))
        return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()

    sets = {d: shingles(t) for d, t in rows}
    parent = {d: d for d in sets}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            if sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), root(d)) for d in ids}


def test_op4_links_the_texts_of_one_id(spark):
    rng = random.Random(8)
    a, b, c = (" ".join(rng.choices([f"w{i}" for i in range(300)], k=60)) for _ in range(3))
    rows = [(5, a), (5, b), (7, a + " x"), (9, b + " y"), (11, c), (3, c + " z"), (5, None), (13, None), (None, a), (11, c)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = collections.Counter((r.doc_id, r.n_shingles, r.component_id) for r in jaccard_join.near_duplicates(frame).collect())
    assert found == collections.Counter([
        (5, 56, 5), (5, 56, 5), (7, 57, 5), (9, 57, 5), (11, 56, 3), (11, 56, 3), (3, 57, 3), (5, 0, 5), (13, 0, 13),
        (None, 56, None),
    ])


@pytest.mark.parametrize("hot_at,most_hot", [(16, 10**6), (3, 40)])
def test_op4_equals_all_pairs(spark, hot_at, most_hot):
    rng = random.Random(hot_at)
    vocabulary = [f"w{i}" for i in range(200)]
    rows, number, passage = [(0, None), (1, ""), (2, "a b"), (3, "A b")], 10, rng.choices(vocabulary, k=40)
    for _ in range(10):
        text = rng.choices(vocabulary, k=rng.choice([8, 30, 90]))
        for _ in range(rng.choice([1, 4, 20])):
            copy = list(text)
            for _ in range(rng.choice([0, 1, 2, 4])):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            text = copy if rng.random() < 0.4 else text
            rows.append((number, " ".join(copy + (passage if rng.random() < 0.4 else []))))
            number += 1
    found = jaccard_join.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), hot_at=hot_at, most_hot=most_hot)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found.collect()} == plain_components(rows)


@pytest.mark.parametrize("name,column,least", [("op5_toxicity", "toxic", 0.9), ("op8_quality", "quality", 0.95)])
def test_classifiers_on_held_out_rows(spark, name, column, least):
    marks = {r.doc_id: r[column] for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    rows = registry.queries()[name](spark, SF_DIR).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id in marks]
    assert sum(r.predicted == marks[r.doc_id] for r in held) >= least * len(held)


def test_op5_lexicon_keeps_insults_beside_many_common_terms():
    rare = [a + b + c for a in "bcdfghjklm" for b in "aeiouyx" for c in "npqrstvwz"]
    texts = [" ".join(rare) + f" {i}" for i in range(40)] + [f"a calm text about number {i}" for i in range(80)]
    toxic = np.array([1] * 40 + [0] * 80)
    lexicon = toxicity.induce_lexicon(texts, toxic, np.ones(len(texts)))
    assert all(lexicon.of(w) >= 0 for w in [*toxicity.SEEDS, *rare])
    votes, _ = toxicity.vote_strengths(pa.array(["what an imbecile", "a calm text"], pa.large_string()), lexicon)
    assert votes.sum(1).tolist() == [1, 0]


@pytest.mark.parametrize("slice_chars", [1 << 20, 2_000])
def test_op6_equals_all_windows(spark, given, slice_chars):
    items = {r.item_id: r.text for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()}
    items |= {900: "that it", 901: None}
    windows = collections.defaultdict(set)
    for item, text in items.items():
        w = WORDS.findall(lower(text))
        for i in range(max(1, len(w) - 12) if w else 0):
            windows[tuple(w[i : i + 13])].add(str(item))
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").filter("doc_id < 400")
    bench = spark.createDataFrame(list(items.items()), "item_id long, text string")
    for r in decontaminate.find_contamination(docs, bench, slice_chars=slice_chars).collect():
        w, hit, found = WORDS.findall(lower(given[r.doc_id])), set(), set()
        for n in set(map(len, windows)):
            for i in range(len(w) - n + 1):
                if of := windows.get(tuple(w[i : i + n])):
                    found |= of
                    hit.update(range(i, i + n))
        assert (r.n_words, r.n_hit, sorted(r["items"])) == (len(w), len(hit), sorted(found))


def test_op7_equals_the_library(spark, given):
    path = public_tokenizers.path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    rng = random.Random(4)
    texts = ["", None, " ", "  a  b ", "▁▁a", "<s> 0x41 </s>", "x" * 500, *list(given.values())[:200]]
    texts += ["".join(rng.choices("ab  ▁\n\té日本​\x00<s>🙂ñ", k=rng.randrange(40))) for _ in range(500)]
    model, at = piece_bpe.vocabulary(path), 0
    lengths, ids = model.encode(pa.array(texts, pa.string()))
    for text, n, decoded in zip(texts, lengths, model.decode(lengths, ids)):
        expected = library.encode(text or "", add_eos=True)
        assert ids[at : at + n].tolist() == expected and decoded == library.decode(expected)
        at += n


def test_op7_long_words_and_small_slices_equal_the_library(monkeypatch):
    path = public_tokenizers.path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    model = piece_bpe.Vocabulary(path)
    rng = random.Random(11)
    letters = "etaoinshrdluETAOINabcdefg0123456789日本語中文のé🙂\u200b"
    texts = ["".join(rng.choices(letters, k=n)) for n in (511, 512, 513, 700, 5000, 40_000)]
    texts += ["a" * 3000, "ab" * 2000, "the" * 1500, "日" * 900, " ".join(rng.choices(["information", "a" * 600, "xyz"], k=50))]
    for longest, symbols in ((512, 1 << 17), (2, 50), (1, 1)):
        monkeypatch.setattr(piece_bpe, "_LONG", longest)
        monkeypatch.setattr(piece_bpe, "_SLICE_SYMBOLS", symbols)
        model.words.clear()
        some = texts if longest == 512 else texts[:4] + texts[-1:]
        lengths, ids = model.encode(pa.array(some, pa.string()))
        assert np.split(ids, np.cumsum(lengths)[:-1])[0].tolist() == library.encode(some[0], add_eos=True)
        at = 0
        for text, n in zip(some, lengths):
            assert ids[at : at + n].tolist() == library.encode(text, add_eos=True)
            at += n


def test_op7_encodes_a_megabyte_without_blanks():
    model = piece_bpe.vocabulary(public_tokenizers.path("piece_bpe_32k.model"))
    text = "".join(random.Random(12).choices("etaoinshrdlucmfwypvbgkjqxz", k=1 << 20))
    lengths, ids = model.encode(pa.array([text]))
    assert model.decode(lengths, ids) == [text]
    assert not any(len(w) > piece_bpe._LONG for w in model.words)


def test_op9_equals_plain_scans(spark, given):
    for r in registry.op9_license_scan(spark, SF_DIR).collect():
        text = given[r.doc_id]
        w, at, base, own, best = WORDS.findall(lower(text)), [], set(), set(), 0.0
        for label, phrase in licenses.PHRASES.items():
            phrase = phrase.split()
            found = [i for i in range(len(w)) if w[i : i + len(phrase)] == phrase]
            at += found
            base |= {label} if found else set()
        for line in (text or "").split("\n"):
            held = set(WORDS.findall(lower(line)))
            for label, template in licenses.TEMPLATES:
                template = set(template.split())
                share = len(template & held) / len(template)
                if share >= licenses.THRESHOLD - 1e-9:
                    own.add(label)
                    best = max(best, share)
        assert (r.n_words, r.n_base, r.first_word, r.last_word) == (len(w), len(at), min(at, default=None), max(at, default=None))
        assert (r.base_labels, r.labels) == (",".join(sorted(base)), ",".join(sorted(base | own)))
        assert r.score == (1.0 if at else best)


def test_op9_finds_wrapped_notices(spark):
    rows = []
    for label, notice in licenses.TEMPLATES:
        w = notice.split()
        for lines in (2, 3, len(w)):
            step = -(-len(w) // lines)
            rows.append((label, "before it\n# " + "\n# ".join(" ".join(w[i : i + step]) for i in range(0, len(w), step)) + " after it"))
    long, filling = dict(licenses.TEMPLATES)["unlicense"].split(), " x" * 30
    rows.append(("", " ".join(long[:6]) + f"\n{filling}\n" + " ".join(long[6:])))  # too far apart for one notice
    rows.append(("", " ".join(long[:8]) + "\nand more"))  # not enough of it
    frame = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(rows)], "doc_id long, text string")
    for r in licenses.scan_licenses(frame).collect():
        label, text = rows[r.doc_id]
        assert label in r.labels.split(",") and r.score == (1.0 if label else r.score), text
        assert label or (r.labels, r.score) == ("", 0.0), text


def test_op10_equals_the_library(spark, given):
    library = tokenizers.Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rows = {r.doc_id: r for r in registry.op10_token_id_output(spark, SF_DIR).collect()}
    start = 0
    for doc in sorted(given):
        ids = np.array([*library.encode(given[doc] or "", add_special_tokens=False).ids, 1], "<u4")
        assert (rows[doc].start, rows[doc].n_tokens, rows[doc].ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_digests_are_of_ids_and_texts(spark, edge_dir):
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    texts = dict(EDGE)
    for r in registry.op7_sentencepiece(spark, edge_dir).collect():
        ids = library.encode(texts[r.doc_id] or "", add_eos=True)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()
