"""The Merkle manifest against trees built in plain Python."""

import collections
import hashlib
import random
import zlib

from stratum.llm import merkle, registry
from tests.compare import connect, differences
from tests.conftest import SF_DIR

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, word int, tree string, idx int"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def leaf(doc_id, text, lang, source, n_chars):
    fields = (doc_id, source, lang, n_chars, text)
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in fields))


def levels(digests):
    found = [digests]
    while len(found[-1]) > 1:
        found.append([sha("".join(found[-1][i : i + 16])) for i in range(0, len(found[-1]), 16)])
    return found


def path(tree, i):
    for level in tree[:-1]:
        first = i - i % 16
        yield "".join(level[first:i]), "".join(level[i + 1 : first + 16])
        i //= 16


def plain(rows):
    groups = collections.defaultdict(list)
    for row in rows:
        groups[row[3]].append((row[0] is not None, row[0] or 0, leaf(*row), row))
    sources = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    for group in groups.values():
        group.sort(key=lambda x: x[:3])
    trees = {s: levels([x[2] for x in groups[s]]) for s in sources}
    top = levels([trees[s][-1][0] for s in sources])
    root = top[-1][0] if sources else None
    for g, s in enumerate(sources):
        for i, (_, _, digest, row) in enumerate(groups[s]):
            way = [*path(trees[s], i), *path(top, g)]
            now = digest
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0 and row[1] is not None:
                now = leaf(row[0], lower(row[1]), *row[2:])
            for before, after in way:
                now = sha(before + now + after)
            proof = sha("".join(a + b for a, b in way))
            yield row[0], digest, trees[s][-1][0], root, proof, now, now == root


def ordered(rows):
    return sorted(map(tuple, rows), key=lambda r: tuple((x is None, x) for x in r))


def check(frame):
    rows = [(r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in frame.collect()]
    found = ordered(merkle.manifest(frame).collect())
    assert found == ordered(plain(rows))
    return found


def test_given_documents(spark):
    found = check(spark.read.parquet(f"{SF_DIR}/documents.parquet"))
    assert any(not r[-1] for r in found) and any(r[-1] for r in found)


def test_nulls_repeats_and_far_apart_ids(spark):
    rng = random.Random(1)
    ids = lambda: rng.choice([None, None, 5, 5, rng.randrange(-2000, 2000), rng.randrange(-(2**63), 2**63)])
    texts = ["Aa", None, "", "É x", *[f"B{i}" for i in range(5)]]
    rows = [(ids(), rng.choice(texts), None, rng.choice([None, "", "a", "é", "B"]), rng.choice([1, None]), 1, "x", 2)
            for _ in range(2500)]
    check(spark.createDataFrame(rows, SCHEMA).repartition(5))


def test_many_sources_one_source_and_one_row(spark):
    row = lambda i, s: (i, f"T{i}", "x", s, 1, 1, "", 1)
    check(spark.createDataFrame([row(i, f"s{i}") for i in range(300)], SCHEMA))
    check(spark.createDataFrame([row(i, "s") for i in range(4097)], SCHEMA))
    check(spark.createDataFrame([row(1, "s")], SCHEMA))


def test_a_very_long_text(spark):
    check(spark.createDataFrame([(0, "Aé" * 1_000_000, None, "s", 1, 1, "", 1), (1, None, None, "s", 1, 1, "", 1)], SCHEMA))


def test_counts_before_at_every_width(spark):
    for spread in (3, 5000, 2**40):
        rng = random.Random(spread)
        rows = [(g, rng.randrange(-spread, spread), rng.randrange(1, 5)) for g in "ab" for _ in range(300)]
        rows = [(g, k, n) for (g, k), n in {(g, k): n for g, k, n in rows}.items()]
        found = merkle.counts_before(spark.createDataFrame(rows, "g string, k long, n long"), ["g"], "k").collect()
        assert len(found) == len(rows)
        for r in found:
            own = [(k, n) for g, k, n in rows if g == r.g]
            assert (r.before, r.total) == (sum(n for k, n in own if k < r.k), sum(n for _, n in own))


def test_query_equals_its_sql(spark):
    query = registry.queries()["op11_merkle_manifest"](spark, SF_DIR)
    assert differences(query, connect(SF_DIR), registry.oracle_sql()["op11_merkle_manifest"]) is None
