"""Exact Jaccard join of documents on word shingles, by set relations.

Sets and the links between them:

1. Equal sets (found by their size and two 64-bit sums) are one; the smallest doc_id stands for them.
2. Answer skipping. Documents that share a minimum hash meet one of them, their leader, and are compared with it alone.
   Those that link to a leader form its cluster; the distance to the leader (a metric) is kept. What is later computed
   for a leader then answers for its members: two clusters whose leaders are further apart than the threshold and both
   radii cannot hold a link. Where that bound does not decide, members are sent to blocks of the other cluster, and only
   links leave those tasks.
3. Index skipping. Every other link shares a shingle of both sets' prefixes: the first n - ceil(0.75 n) + 1 shingles in
   a global order, the frequent ones last by frequency, and else by hash. Index lists hold a cluster once, ordered by
   size, so that a set skips the blocks of lists whose sizes cannot match, and entries whose positions leave too few
   shingles for the needed overlap. Candidate clusters are screened by their prefixes and compared as above.
4. Components of the linked clusters come from alternating star contractions.

Every comparison is an exact count on whole sets of 64-bit shingle hashes. The frequent shingles are broadcast up to a
fixed number (a higher frequency counts as frequent when there are more, which changes no result). Ids to look up are
broadcast up to a fixed number and joined by a shuffle beyond it. Comparisons with one document or cluster are dealt
over as many groups as it takes for a bounded number in each. doc_id is the key of the table; where it repeats with
other texts, each such text is a document of its own inside, and the id links them.

Null and empty texts have an empty set, link with nothing and are components of their own; a text of fewer words than
a shingle is one shingle; a null doc_id links with nothing and has a null component; repeated rows are copies of one
document, and different texts of one doc_id belong to one component, with the links of each; an empty table gives no
rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.llm.text import SPACES, chunks, encode_words, give_back, ragged, starts, table
from stratum.sources.scratch import materialize

K = 5
BANDS = 6
HOT_AT = 16  # prefixes of so many documents make a shingle frequent
MOST_HOT = 1_000_000
MOST_BROADCAST_IDS = 1_000_000
GROUP_ROWS = 512
_CHUNK = 2 << 20  # bytes of text or hashes that a task works on at a time
_WORDS = table(SPACES)
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_SLACK = 1e-9


def _mixed(x: np.ndarray, number: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93 + 2 * number)
        return x ^ (x >> np.uint64(29))


def shingle_sets(column: pa.Array, k: int = K) -> tuple[np.ndarray, np.ndarray]:
    """(size of each text's set, the hashes of all sets, each in ascending order)"""
    counts, codes, words = encode_words(column, _WORDS)
    known = pd.util.hash_array(np.array(words.to_pylist(), dtype=object), categorize=False).astype(np.uint64)
    hashes = known[codes] if len(codes) else np.zeros(0, np.uint64)
    edges = starts(counts)
    runs = np.where(counts >= k, counts - k + 1, np.minimum(counts, 1))  # shingles of each text, repeats included
    places = starts(runs)
    grams = np.zeros(places[-1], np.uint64)
    for length in range(1, k + 1):
        texts = np.flatnonzero(counts >= k if length == k else counts == length)
        if not len(texts):
            continue
        begin, at = edges[texts], places[texts]
        if length == k:
            own = np.arange(runs[texts].sum()) - np.repeat(starts(runs[texts])[:-1], runs[texts])
            begin, at = np.repeat(begin, runs[texts]) + own, np.repeat(at, runs[texts]) + own
        gram = np.full(len(hashes) - k + 1 if length == k else len(begin), length, np.uint64)
        with np.errstate(over="ignore"):
            for j in range(length):
                gram ^= gram >> np.uint64(31)
                gram *= _FACTOR
                # Those of k words are made from each word on, also across texts, and then picked.
                gram += hashes[j : j + len(gram)] if length == k else hashes[begin + j]
        grams[at] = _mixed(gram[begin] if length == k else gram, 0)
    cut = places.tolist()
    for i in np.flatnonzero(runs > 1).tolist():
        grams[cut[i] : cut[i + 1]].sort()
    first = np.ones(len(grams), bool)
    first[1:] = grams[1:] != grams[:-1]
    first[places[:-1][runs > 0]] = True
    before = starts(first)
    return before[places[1:]] - before[places[:-1]], grams[first]


def prefix_length(n: np.ndarray) -> np.ndarray:
    """How many of n shingles one must look at to meet a shingle of every set with 3/4 similarity."""
    return np.where(n > 0, n - -(-3 * n // 4) + 1, 0)


def _prefixes(sizes: np.ndarray, hashes: np.ndarray, hot: np.ndarray, level: np.ndarray) -> list[np.ndarray]:
    """The prefix of each set, in the global order: by level of frequency (0: not frequent), then by hash."""
    edges, keep = starts(sizes).tolist(), prefix_length(sizes).tolist()
    if not len(hot):
        return [hashes[a : a + p] for a, p in zip(edges, keep)]
    at = np.minimum(np.searchsorted(hot, hashes), len(hot) - 1)
    of = np.where(hot[at] == hashes, level[at], 0)
    out = []
    for a, b, p in zip(edges, edges[1:], keep):
        own = of[a:b]
        out.append(hashes[a:b][np.argsort(own, kind="stable")[:p]] if own.any() else hashes[a : a + p])
    return out


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in chunks(batches, most=_CHUNK):
        sizes, hashes = shingle_sets(rows.column("text"))
        some = np.flatnonzero(sizes)
        begin = starts(sizes)[:-1][some]
        sums, least = np.zeros((len(sizes), 2), np.uint64), np.zeros((len(sizes), BANDS), np.uint64)
        for number in range(BANDS + 2 if len(some) else 0):
            mixed = _mixed(hashes, number + 1)
            if number < BANDS:
                least[some, number] = np.minimum.reduceat(mixed, begin)
            else:
                sums[some, number - BANDS] = np.add.reduceat(mixed, begin)
        bands = pa.ListArray.from_arrays(
            pa.array(np.arange(len(sizes) + 1) * BANDS, pa.int32()), pa.array(least.view(np.int64).ravel())
        )
        prefixes = [p.tobytes() for p in _prefixes(sizes, hashes, np.zeros(0, np.uint64), np.zeros(0))]
        yield pa.RecordBatch.from_pydict({
            "doc_id": rows.column("doc_id"), "n": pa.array(sizes),
            "sum_a": pa.array(sums[:, 0].copy().view(np.int64)), "sum_b": pa.array(sums[:, 1].copy().view(np.int64)),
            "bands": bands, "prefix": pa.array(prefixes, pa.binary()),
        })


def _rows_of(docs: DataFrame, roles: DataFrame) -> DataFrame:
    """The texts of the documents named in `roles`, with its columns."""
    few = roles.count() <= MOST_BROADCAST_IDS
    return docs.select("doc_id", "text").join(F.broadcast(roles) if few else roles, "doc_id")


# Comparisons of documents with a common one, their hub.


_ROLE = [
    ("hub", pa.int64()), ("salt", pa.int32()), ("is_hub", pa.bool_()), ("home", pa.int64()), ("doc", pa.int64()),
    ("shingles", pa.binary()),
]
_ROLE_SCHEMA = "hub long, salt int, is_hub boolean, home long, doc long, shingles binary"


def _role_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in chunks(batches, most=_CHUNK):
        sizes, hashes = shingle_sets(rows.column("text"))
        edges = starts(sizes).tolist()
        ids, roles = rows.column("doc_id").to_pylist(), rows.column("roles").to_pylist()
        out = [
            (*role.values(), ids[i], hashes[edges[i] : edges[i + 1]].tobytes())
            for i in range(len(ids))
            for role in roles[i]
        ]
        for a in range(0, len(out), 2048):
            columns = list(zip(*out[a : a + 2048]))
            arrays = [pa.array(c, kind) for c, (_, kind) in zip(columns, _ROLE)]
            yield pa.RecordBatch.from_arrays(arrays, names=[name for name, _ in _ROLE])


def _compare_group(group: pa.Table) -> pa.Table:
    hub, ids, sets = group["hub"][0].as_py(), group["doc"].to_pylist(), group["shingles"].to_pylist()
    is_hub = group["is_hub"].to_pylist()
    own = next((np.frombuffer(s, np.uint64) for s, h in zip(sets, is_hub) if h), np.zeros(0, np.uint64))
    out = []
    for doc, raw, hubs in zip(ids, sets, is_hub):
        if not hubs:
            other = np.frombuffer(raw, np.uint64)
            common = 0
            if len(own) and len(other):
                common = int((own[np.minimum(np.searchsorted(own, other), len(own) - 1)] == other).sum())
            out.append((doc, hub, common, len(own) + len(other) - common))
    give_back()
    columns = list(zip(*out)) or [[]] * 4
    return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(["a", "b", "common", "either"], columns)})


def _roles(pairs: DataFrame, label: str) -> DataFrame:
    """(doc_id, roles) for distinct pairs (a, b, reach): in which groups of comparisons with a hub b it is needed."""
    salts = pairs.groupBy(F.col("b").alias("hub")).agg(F.ceil(F.count("*") / GROUP_ROWS).cast("int").alias("salts"))
    salt = F.pmod(F.xxhash64("a"), F.col("salts")).cast("int")
    hub = F.col("b") == F.col("hub")
    members = pairs.join(salts, hub).select(F.col("a").alias("doc_id"), "hub", salt.alias("salt"), F.lit(False).alias("is_hub"), "reach")
    hubs = salts.select(
        F.col("hub").alias("doc_id"), "hub", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"),
        F.lit(True).alias("is_hub"), F.lit(0.0).alias("reach"),
    )
    role = F.struct("hub", "salt", "is_hub", "reach")
    roles = members.unionByName(hubs).groupBy("doc_id").agg(F.collect_list(role).alias("roles"))
    return materialize(roles, f"{label}-roles")


def compare(docs: DataFrame, pairs: DataFrame, label: str) -> DataFrame:
    """(a, b, common, either, distance, linked) of distinct pairs (a, b), a != b; a written table."""
    pairs = materialize(pairs.select("a", "b", F.lit(0.0).alias("reach")), f"{label}-pairs")
    roles = _roles(pairs, label)
    roles = roles.withColumn(
        "roles",
        F.transform("roles", lambda r: F.struct(r["hub"], r["salt"], r["is_hub"], F.lit(0).cast("long").alias("home"))),
    )
    sets = _rows_of(docs, roles).mapInArrow(_role_rows, _ROLE_SCHEMA)
    counted = sets.groupBy("hub", "salt").applyInArrow(_compare_group, "a long, b long, common long, either long")
    counted = counted.withColumn("distance", 1 - F.col("common") / F.col("either"))
    counted = counted.withColumn("linked", 100 * F.col("common") >= 75 * F.col("either"))
    return materialize(counted, f"{label}-compared")


def _screen_group(group: pa.Table) -> pa.Table:
    """Pairs that may be within reach. Both prefixes hold all hashes of their sets up to some value, so below the
    smaller of the two values it is known how many shingles are in one set only; within a distance d, sets of x and y
    shingles differ in at most (x + y) d / (2 - d) of them."""
    hub, ids, is_hub = group["hub"][0].as_py(), group["doc"].to_pylist(), group["is_hub"].to_pylist()
    sets, sizes, reach = group["prefix"].to_pylist(), group["n"].to_pylist(), group["reach"].to_pylist()
    at = next((i for i, h in enumerate(is_hub) if h), None)
    out = []
    if at is not None:
        own, own_n = np.frombuffer(sets[at], np.uint64), sizes[at]
        for doc, raw, n, far, hubs in zip(ids, sets, sizes, reach, is_hub):
            if not hubs:
                other = np.frombuffer(raw, np.uint64)
                limit = min(own[-1], other[-1])
                x, y = np.searchsorted(own, limit, "right"), np.searchsorted(other, limit, "right")
                common = int((own[np.minimum(np.searchsorted(own, other[:y]), len(own) - 1)] == other[:y]).sum())
                if x + y - 2 * common <= (own_n + n) * far / (2 - far) + _SLACK:
                    out.append((doc, hub))
    columns = list(zip(*out)) or [[]] * 2
    return pa.table({"a": pa.array(columns[0], pa.int64()), "b": pa.array(columns[1], pa.int64())})


def screened(alone: DataFrame, pairs: DataFrame, label: str) -> DataFrame:
    """(a, b): the distinct pairs (a, b, reach) that their prefixes by hash don't rule out; a written table."""
    pairs = materialize(pairs, f"{label}-pairs")
    roles = _roles(pairs, label)
    few = roles.count() <= MOST_BROADCAST_IDS
    rows = alone.select("doc_id", "n", "prefix").join(F.broadcast(roles) if few else roles, "doc_id")
    rows = rows.select(F.col("doc_id").alias("doc"), "n", "prefix", F.explode("roles").alias("role"))
    rows = rows.select("doc", "n", "prefix", "role.*")
    return materialize(rows.groupBy("hub", "salt").applyInArrow(_screen_group, "a long, b long"), f"{label}-screened")


# Index lists.


def _bucket_of(hashes: np.ndarray, n_buckets: int) -> np.ndarray:
    return (hashes >> np.uint64(40)).astype(np.int64) % n_buckets


def _hash_rows(batches: Iterator[pa.RecordBatch], n_buckets: int) -> Iterator[pa.RecordBatch]:
    """A row per bucket with the prefix shingles of a batch and in how many of its documents each is."""
    for batch in chunks(batches, "prefix", _CHUNK):
        hashes = np.sort(np.frombuffer(b"".join(batch.column("prefix").to_pylist()), np.uint64))
        begin = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]])) if len(hashes) else hashes
        values, counts = hashes[begin.astype(np.int64)], np.diff(np.append(begin, len(hashes)))
        bucket = _bucket_of(values, n_buckets)
        order = np.argsort(bucket, kind="stable")
        cut = np.searchsorted(bucket[order], np.arange(n_buckets + 1))
        for number in range(n_buckets):
            at = order[cut[number] : cut[number + 1]]
            if len(at):
                yield pa.RecordBatch.from_pydict({
                    "bucket": pa.array([number], pa.int32()),
                    "hashes": pa.array([values[at].tobytes()], pa.binary()),
                    "counts": pa.array([counts[at].astype(np.uint32).tobytes()], pa.binary()),
                })


def _frequent(group: pa.Table, least: int) -> pa.Table:
    hashes = np.frombuffer(b"".join(group["hashes"].to_pylist()), np.uint64)
    counts = np.frombuffer(b"".join(group["counts"].to_pylist()), np.uint32).astype(np.int64)
    order = np.argsort(hashes, kind="stable")
    hashes, counts = hashes[order], counts[order]
    begin = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]])) if len(hashes) else np.zeros(0, np.int64)
    total = np.add.reduceat(counts, begin) if len(begin) else counts
    kept = total >= least
    return pa.table({"shingle": hashes[begin][kept].view(np.int64), "n": total[kept]})


def _whole_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in chunks(batches, most=_CHUNK):
        sets = [shingle_sets(rows.column("text"))[1].tobytes()]
        yield pa.RecordBatch.from_pydict({"prefix": pa.array(sets, pa.binary())})


def _count_frequent(sets: DataFrame, n_buckets: int, hot_at: int, label: str) -> DataFrame:
    """(shingle, n) of the shingles in at least `hot_at` of the sets; a written table."""

    def frequent(group: pa.Table) -> pa.Table:
        return _frequent(group, hot_at)

    rows = sets.mapInArrow(partial(_hash_rows, n_buckets=n_buckets), "bucket int, hashes binary, counts binary")
    return materialize(rows.groupBy("bucket").applyInArrow(frequent, "shingle long, n long"), label)


def _late(alone: DataFrame, hot) -> DataFrame:
    return alone.mapInArrow(partial(_affected, hot=hot), ", ".join(f"{n} {t}" for n, t in alone.dtypes) + ", late boolean")


def frequent_shingles(docs: DataFrame, alone: DataFrame, n_buckets: int, hot_at: int, most: int):
    """(hashes in order, levels): the frequent shingles, as a broadcast variable; levels grow with their frequency.

    Counted are the prefixes of all sets, and the whole sets of those that have a frequent shingle there.
    """
    spark = docs.sparkSession
    counted = _count_frequent(alone.select("prefix"), n_buckets, hot_at, "jaccard-frequent")

    def collected(counted: DataFrame):
        level = F.floor(F.log2(F.col("n") / hot_at)).cast("int")
        levels = {r.level: r.n for r in counted.groupBy(level.alias("level")).agg(F.count("*").alias("n")).collect()}
        least = 0
        while sum(n for at, n in levels.items() if at >= least) > most:
            least += 1
        found = counted.filter(F.col("n") >= hot_at * 2**least).select("shingle", level.alias("level")).toArrow()
        hashes = found["shingle"].to_numpy().view(np.uint64)
        order = np.argsort(hashes)
        return hashes[order], (found["level"].to_numpy()[order] + 1).astype(np.uint8)

    first = collected(counted)
    if not len(first[0]):
        return spark.sparkContext.broadcast(first)
    late = _late(alone.select("doc_id", "prefix"), spark.sparkContext.broadcast(first)).filter("late").select("doc_id")
    late = materialize(late, "jaccard-late")
    whole = _rows_of(docs, late).mapInArrow(_whole_sets, "prefix binary")
    more = _count_frequent(whole, n_buckets, hot_at, "jaccard-frequent")
    both = counted.union(more).groupBy("shingle").agg(F.max("n").alias("n"))
    return spark.sparkContext.broadcast(collected(materialize(both, "jaccard-frequent")))


def _affected(batches: Iterator[pa.RecordBatch], hot) -> Iterator[pa.RecordBatch]:
    """Marks the sets with a frequent shingle in their prefix by hash; the others' prefixes stay as they are."""
    known = hot.value[0]
    for batch in batches:
        late = []
        for raw in batch.column("prefix").to_pylist():
            own = np.frombuffer(raw, np.uint64)
            at = np.minimum(np.searchsorted(known, own), len(known) - 1)
            late.append(bool((known[at] == own).any()))
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(late)], names=[*batch.schema.names, "late"])


def _later_prefixes(batches: Iterator[pa.RecordBatch], hot) -> Iterator[pa.RecordBatch]:
    for rows in chunks(batches, most=_CHUNK):
        sizes, hashes = shingle_sets(rows.column("text"))
        prefixes = [p.tobytes() for p in _prefixes(sizes, hashes, *hot.value)]
        yield pa.RecordBatch.from_arrays(
            [rows.column("doc_id"), rows.column("cluster"), pa.array(sizes), pa.array(prefixes, pa.binary())],
            names=["doc_id", "cluster", "n", "prefix"],
        )


def _entry_rows(batches: Iterator[pa.RecordBatch], n_buckets: int) -> Iterator[pa.RecordBatch]:
    """A row per bucket with a batch's index entries: shingle, cluster (its number in the row's list), position."""
    for batch in chunks(batches, "prefix", _CHUNK):
        raw = batch.column("prefix").to_pylist()
        hashes = np.frombuffer(b"".join(raw), np.uint64)
        lengths = np.array([len(r) // 8 for r in raw], np.int64)
        position = np.arange(len(hashes)) - np.repeat(starts(lengths)[:-1], lengths)
        clusters, number = np.unique(batch.column("cluster").to_numpy(zero_copy_only=False), return_inverse=True)
        n = batch.column("n").to_numpy(zero_copy_only=False)
        smallest, largest = np.full(len(clusters), np.iinfo(np.int64).max), np.zeros(len(clusters), np.int64)
        np.minimum.at(smallest, number, n)
        np.maximum.at(largest, number, n)
        owner = np.repeat(number, lengths)
        bucket = _bucket_of(hashes, n_buckets)
        order = np.lexsort((position, owner, hashes, bucket))
        hashes, owner, position, bucket = hashes[order], owner[order], position[order], bucket[order]
        first = np.ones(len(hashes), bool)
        first[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
        hashes, owner, position, bucket = hashes[first], owner[first], position[first], bucket[first]
        cut = np.searchsorted(bucket, np.arange(n_buckets + 1))
        for at in range(n_buckets):
            a, b = cut[at], cut[at + 1]
            if a < b:
                here, local = np.unique(owner[a:b], return_inverse=True)
                yield pa.RecordBatch.from_pydict({
                    "bucket": pa.array([at], pa.int32()),
                    "clusters": pa.array([np.stack([clusters[here], smallest[here], largest[here]]).tobytes()], pa.binary()),
                    "hashes": pa.array([hashes[a:b].tobytes()], pa.binary()),
                    "owners": pa.array([local.astype(np.uint32).tobytes()], pa.binary()),
                    "positions": pa.array([position[a:b].astype(np.uint32).tobytes()], pa.binary()),
                })


def _candidates(group: pa.Table) -> pa.Table:
    """Pairs of clusters that share a prefix shingle and may hold a link, by sizes and positions."""
    parts = []
    for row in group.to_pylist():
        known = np.frombuffer(row["clusters"], np.int64).reshape(3, -1)
        owner = np.frombuffer(row["owners"], np.uint32)
        parts.append((
            np.frombuffer(row["hashes"], np.uint64), known[0][owner], known[1][owner], known[2][owner],
            np.frombuffer(row["positions"], np.uint32).astype(np.int64),
        ))
    hashes, cluster, small, large, position = (np.concatenate(x) for x in zip(*parts))
    order = np.lexsort((cluster, hashes))
    hashes, cluster, small, large, position = (x[order] for x in (hashes, cluster, small, large, position))
    begin = np.flatnonzero(np.concatenate([[True], (hashes[1:] != hashes[:-1]) | (cluster[1:] != cluster[:-1])]))
    hashes, cluster = hashes[begin], cluster[begin]  # a cluster once in a list
    small, large = np.minimum.reduceat(small, begin), np.maximum.reduceat(large, begin)
    position = np.minimum.reduceat(position, begin)
    begin = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]]))
    size = np.diff(np.append(begin, len(hashes)))
    shared = np.repeat(size > 1, size)
    hashes, cluster, small, large, position = (x[shared] for x in (hashes, cluster, small, large, position))
    order = np.lexsort((cluster, small, hashes))  # lists ordered by size
    hashes, cluster, small, large, position = (x[order] for x in (hashes, cluster, small, large, position))
    found = [np.zeros((0, 2), np.int64)]
    if len(hashes):
        begin = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]]))
        ends = np.append(begin[1:], len(hashes))
        left = np.arange(len(hashes) - 1)
        for width in range(1, int((ends - begin).max())):  # entries `width` places apart in a list
            left = left[left + width < len(hashes)]
            right = left + width
            # In order of size, one that is too large for a set ends the list for that set.
            near = (hashes[left] == hashes[right]) & (3 * small[right] <= 4 * large[left])
            left, right = left[near], right[near]
            if not len(left):
                break
            needed = -(-3 * (small[left] + small[right]) // 7)
            ok = np.minimum(large[left] - position[left], large[right] - position[right]) >= needed
            pair = np.stack([cluster[left[ok]], cluster[right[ok]]], axis=1)
            pair.sort(axis=1)
            found.append(_distinct_pairs(pair))
    pairs = _distinct_pairs(np.concatenate(found))
    give_back()
    return pa.table({"b": pairs[:, 0], "a": pairs[:, 1]})


def _distinct_pairs(pairs: np.ndarray) -> np.ndarray:
    if not len(pairs):
        return pairs
    pairs = pairs[np.lexsort((pairs[:, 1], pairs[:, 0]))]
    return pairs[np.concatenate([[True], (pairs[1:] != pairs[:-1]).any(1)])]


# Clusters and components.


def _star(docs: DataFrame, free: DataFrame, label: str) -> DataFrame:
    """(doc, cluster, distance): documents linked to a leader that has no leader itself; the nearest such leader.

    Of documents with a common minimum hash, the one that shares most of its minimum hashes with others leads: in a
    family of copies that is the one they are all near.
    """
    bands = free.select(F.col("doc_id").alias("doc"), "n", F.posexplode("bands").alias("band", "value"))
    shared = bands.groupBy("band", "value").agg(F.count("*").alias("times")).filter("times > 1")
    bands = bands.join(shared, ["band", "value"])
    fame = bands.groupBy("doc").agg(F.sum("times").alias("fame"))
    bands = materialize(bands.drop("times").join(fame, "doc"), f"{label}-bands")
    meets = bands.groupBy("band", "value").agg(F.min(F.struct(-F.col("fame"), "doc", "n")).alias("leader"))
    meets = meets.select("band", "value", F.col("leader.doc").alias("leader"), F.col("leader.n").alias("size"))
    near = 3 * F.greatest("n", "size") <= 4 * F.least("n", "size")
    star = (
        bands.join(meets, ["band", "value"])
        .filter((F.col("doc") != F.col("leader")) & near)
        .select(F.col("doc").alias("a"), F.col("leader").alias("b"))
        .distinct()
    )
    links = compare(docs, star, label).filter("linked")
    led = links.select(F.col("a").alias("b")).distinct()
    to_roots = links.join(led, "b", "left_anti")
    nearest = to_roots.groupBy("a").agg(F.min(F.struct("distance", "b")).alias("best"))
    return materialize(
        nearest.select(F.col("a").alias("doc"), F.col("best.b").alias("cluster"), F.col("best.distance").alias("distance")),
        f"{label}-clusters",
    )


def _near_copies(docs: DataFrame, alone: DataFrame, rounds: int) -> DataFrame:
    """(doc, cluster, distance) of the documents in clusters, their leaders left out. Each round looks for leaders
    among those that are in no cluster yet."""
    members, free = None, alone.select("doc_id", "n", "bands")
    for number in range(rounds):
        found = _star(docs, free, f"jaccard-star{number}")
        members = found if members is None else members.unionByName(found)
        taken = found.select(F.col("doc").alias("doc_id")).union(found.select("cluster")).distinct()
        free = free.join(taken, "doc_id", "left_anti")
    return members


def _cluster_links(docs: DataFrame, alone: DataFrame, candidates: DataFrame, members: DataFrame) -> DataFrame:
    """(a, b): linked clusters, among the candidate pairs of clusters."""
    radius = materialize(members.groupBy("cluster").agg(F.max("distance").alias("radius")), "jaccard-radius")

    def with_radii(pairs: DataFrame) -> DataFrame:
        return (
            pairs.join(radius.select(F.col("cluster").alias("a"), F.col("radius").alias("radius_a")), "a", "left")
            .join(radius.select(F.col("cluster").alias("b"), F.col("radius").alias("radius_b")), "b", "left")
            .na.fill(0.0, ["radius_a", "radius_b"])
        )

    reach = F.least(0.25 + F.col("radius_a") + F.col("radius_b") + _SLACK, F.lit(1.0))
    asked = with_radii(candidates).select("a", "b", reach.alias("reach"))
    first = compare(docs, screened(alone, asked, "jaccard-leaders"), "jaccard-leaders")
    links = first.filter("linked").select("a", "b")
    open_ = (
        with_radii(first.filter("not linked"))
        .filter("radius_a + radius_b > 0")
        .filter(F.col("distance") <= 0.25 + F.col("radius_a") + F.col("radius_b") + _SLACK)
        .select("a", "b", "distance", "radius_a", "radius_b")
    )
    open_ = materialize(open_, "jaccard-open")
    if open_.isEmpty():
        return links
    # All members of the one against blocks of the other, in tasks; only what links leaves them.
    every = members.select("doc", "cluster").union(members.select(F.col("cluster").alias("doc"), "cluster").distinct())
    sizes = every.groupBy("cluster").agg(F.ceil(F.count("*") / GROUP_ROWS).cast("int").alias("blocks"))
    pairs = (
        open_.select("a", "b")
        .join(sizes.select(F.col("cluster").alias("a"), F.col("blocks").alias("blocks_a")), "a", "left")
        .join(sizes.select(F.col("cluster").alias("b"), F.col("blocks").alias("blocks_b")), "b", "left")
        .na.fill(1, ["blocks_a", "blocks_b"])
    )
    turned = F.col("blocks_a") > F.col("blocks_b")  # the larger one stands, the smaller one is sent to it
    pairs = materialize(
        pairs.select(
            F.when(turned, F.col("b")).otherwise(F.col("a")).alias("sent"),
            F.when(turned, F.col("a")).otherwise(F.col("b")).alias("to"),
            F.greatest("blocks_a", "blocks_b").alias("blocks"),
        ),
        "jaccard-open-pairs",
    )
    block = F.pmod(F.xxhash64("doc"), F.col("blocks")).cast("int")

    def of(pairs: DataFrame, side: str) -> DataFrame:
        found = pairs.join(every, F.col(side) == F.col("cluster"), "left")
        return found.withColumn("doc", F.coalesce("doc", F.col(side)))

    standing = of(pairs.select("to", "blocks").distinct(), "to")
    standing = standing.select("doc", F.col("to").alias("hub"), block.alias("salt"), F.lit(True).alias("is_hub"), F.col("to").alias("home"))
    sent = of(pairs, "sent").select(
        "doc", F.col("to").alias("hub"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("salt"),
        F.lit(False).alias("is_hub"), F.col("sent").alias("home"),
    )
    role = F.struct("hub", "salt", "is_hub", "home")
    roles = standing.unionByName(sent).groupBy(F.col("doc").alias("doc_id")).agg(F.collect_list(role).alias("roles"))
    sets = _rows_of(docs, materialize(roles, "jaccard-open-roles")).mapInArrow(
        _role_rows, _ROLE_SCHEMA
    )
    found = sets.groupBy("hub", "salt").applyInArrow(_linked_in_block, "a long, b long")
    return links.union(materialize(found.distinct(), "jaccard-open-links"))


def _linked_in_block(group: pa.Table) -> pa.Table:
    """(cluster, hub cluster) of the documents sent here that link to one that stands here."""
    hub, standing = group["hub"][0].as_py(), np.array(group["is_hub"].to_pylist(), bool)
    home, sets = group["home"].to_numpy(), [np.frombuffer(s, np.uint64) for s in group["shingles"].to_pylist()]
    here = np.flatnonzero(standing)
    sizes = np.array([len(sets[i]) for i in here], np.int64)
    tokens = np.concatenate([*(sets[i] for i in here), np.zeros(0, np.uint64)])
    order = np.argsort(tokens, kind="stable")
    tokens, owner = tokens[order], np.repeat(np.arange(len(here)), sizes)[order]
    linked = set()
    for i in np.flatnonzero(~standing).tolist():
        if home[i] not in linked and len(here):
            low, high = np.searchsorted(tokens, sets[i], "left"), np.searchsorted(tokens, sets[i], "right")
            common = np.bincount(ragged(owner, low, high - low), minlength=len(here))
            if (100 * common >= 75 * (sizes + len(sets[i]) - common)).any():
                linked.add(home[i])
    return pa.table({"a": pa.array(sorted(linked), pa.int64()), "b": pa.array([hub] * len(linked), pa.int64())})


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node that each node of the edges (a, b) reaches."""
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a != b").distinct()
    edges = materialize(edges, "components")

    def stamp(df: DataFrame):
        return df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    before = stamp(edges)
    while before[0]:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        large = large.filter("a != b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(low, "a").select("a", "b", "low")
        small = small.select(F.col("b").alias("a"), F.col("low").alias("b")).union(small.select("a", F.col("low").alias("b")))
        edges = materialize(small.filter("a != b").distinct(), "components")
        after = stamp(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))


def _own_ids(docs: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """(documents, aliases): where texts share an id, each gets one that no other document has, with its (alias, id).

    An alias is a hash of the id and the text, hashed again for as long as it is an id or another text's alias.
    """
    key = F.xxhash64("doc_id", "text")
    seen = docs.filter("doc_id is not null").groupBy("doc_id").agg(F.min(key).alias("low"), F.max(key).alias("high"))
    several = materialize(seen.filter("low <> high").select("doc_id"), "jaccard-several")
    if several.isEmpty():
        return docs, None
    texts = docs.select("doc_id", key.alias("key")).join(several, "doc_id").distinct()
    names = materialize(texts.withColumn("alias", F.xxhash64("doc_id", "key")), "jaccard-aliases")
    while True:
        twice = names.groupBy("alias").agg(F.count("*").alias("n")).filter("n > 1").select("alias")
        taken = docs.select(F.col("doc_id").alias("alias")).join(names, "alias", "left_semi")
        again = materialize(twice.union(taken).distinct(), "jaccard-taken")
        if again.isEmpty():
            break
        other = names.join(again, "alias", "left_semi").withColumn("alias", F.xxhash64("alias", "doc_id", "key"))
        kept = names.join(again, "alias", "left_anti")
        names = materialize(kept.unionByName(other), "jaccard-aliases")
    renamed = docs.select("doc_id", "text", key.alias("key")).join(names, ["doc_id", "key"], "left")
    renamed = materialize(renamed.select(F.coalesce("alias", "doc_id").alias("doc_id"), "text"), "jaccard-renamed")
    return renamed, names.select("alias", F.col("doc_id").alias("id"))


def near_duplicates(
    docs: DataFrame, entries_per_bucket: int = 1_000_000, hot_at: int = HOT_AT, most_hot: int = MOST_HOT,
    rounds: int = 1,
) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of (doc_id, text).

    hot_at: prefixes of so many documents make a shingle frequent, as long as there are at most `most_hot` of them.
    """
    own, aliases = _own_ids(docs.select("doc_id", "text"))
    found = _near_duplicates(own, entries_per_bucket, hot_at, most_hot, rounds)
    if aliases is None:
        return found
    # Components that hold texts of one id are merged; the smallest id stands for each again.
    found = found.join(aliases, F.col("doc_id") == F.col("alias"), "left").drop("alias")
    found = materialize(found, "jaccard-of-aliases")
    linked = found.filter("id is not null and n_shingles > 0").select("id", F.col("component_id").alias("a"))
    edges = linked.join(linked.groupBy("id").agg(F.min("a").alias("b")), "id").filter("a <> b").select("a", "b")
    merged = components(materialize(edges.distinct(), "jaccard-merged"))
    rows = found.join(merged.withColumnRenamed("node", "component_id"), "component_id", "left").select(
        F.coalesce("id", "doc_id").alias("doc_id"), "n_shingles",
        F.coalesce("component", "component_id").alias("component"),
    )
    lowest = rows.filter("n_shingles > 0").groupBy("component").agg(F.min("doc_id").alias("component_id"))
    rows = rows.join(lowest, "component", "left")
    alone = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return rows.select("doc_id", "n_shingles", alone.alias("component_id"))


def _near_duplicates(docs: DataFrame, entries_per_bucket: int, hot_at: int, most_hot: int, rounds: int) -> DataFrame:
    summary_schema = "doc_id long, n long, sum_a long, sum_b long, bands array<long>, prefix binary"
    sets = materialize(docs.select("doc_id", "text").mapInArrow(_summaries, summary_schema), "jaccard-sets")
    named = sets.filter("doc_id is not null and n > 0")
    equal = named.groupBy("n", "sum_a", "sum_b").agg(F.min("doc_id").alias("rep"), F.count("*").alias("times"))
    equal = materialize(equal.filter("times > 1"), "jaccard-equal")
    reps = named.select("doc_id", "n", "sum_a", "sum_b", "bands", "prefix").join(
        equal.drop("times"), ["n", "sum_a", "sum_b"], "left"
    )
    alone = reps.filter("rep is null or rep = doc_id").dropDuplicates(["doc_id"])  # equal rows
    alone = materialize(alone.select("doc_id", "n", "bands", "prefix"), "jaccard-alone")

    total = alone.agg(F.sum(F.octet_length("prefix") / 8)).first()[0] or 0
    n_buckets = max(256, int(total / entries_per_bucket) + 1)
    members = _near_copies(docs, alone, rounds)
    hot = frequent_shingles(docs, alone, n_buckets, hot_at, most_hot)
    placed = alone.join(members.select(F.col("doc").alias("doc_id"), "cluster"), "doc_id", "left")
    placed = placed.select("doc_id", F.coalesce("cluster", "doc_id").alias("cluster"), "n", "prefix")
    if len(hot.value[0]):
        placed = materialize(_late(placed, hot), "jaccard-placed")
        again = _rows_of(docs, placed.filter("late").select("doc_id", "cluster"))
        schema = "doc_id long, cluster long, n long, prefix binary"
        placed = placed.filter("not late").drop("late").unionByName(
            again.mapInArrow(partial(_later_prefixes, hot=hot), schema)
        )
    entries = placed.select("cluster", "n", "prefix").mapInArrow(
        partial(_entry_rows, n_buckets=n_buckets),
        "bucket int, clusters binary, hashes binary, owners binary, positions binary",
    )
    candidates = entries.groupBy("bucket").applyInArrow(_candidates, "b long, a long").distinct()
    joined = components(_cluster_links(docs, alone, candidates, members))

    rows = sets.select("doc_id", "n", "sum_a", "sum_b").join(equal.drop("times"), ["n", "sum_a", "sum_b"], "left")
    rows = rows.select("doc_id", "n", F.coalesce("rep", "doc_id").alias("rep"))
    rows = rows.join(members.select(F.col("doc").alias("rep"), "cluster"), "rep", "left")
    rows = rows.withColumn("cluster", F.coalesce("cluster", "rep"))
    rows = rows.join(joined.withColumnRenamed("node", "cluster"), "cluster", "left")
    rows = rows.select("doc_id", "n", F.coalesce("component", "cluster").alias("component"))
    lowest = rows.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    return rows.join(lowest, "component", "left").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
