"""Merkle manifest of a table: leaf places by bitmap ranks, levels by keyed slot arrays.

Every record is a leaf digest. The leaves of a group (a source) ascend by id, and runs of 16 digests become their
digest until one is left, the group's root; the groups' roots become the root of the table the same way.

Places come without sorting the leaves. The ids of a group are a bitmap of 64-bit words, kept compressed: only words
with a bit are stored, merged by an aggregated OR. The popcounts of the words are summed up a directory of fixed fan-out
(1024), whose nodes then receive the number of leaves before them. A leaf's place is what its word's entry says plus
the popcount of the bits below its own. Ids that stand more than once add to the count of their word; their rows are
told apart by digest, through a directory over digest prefixes, and by the task that read them where all is equal.

Levels are reduced by blocks of 256 places: each digest is put into its slot, and two levels of runs are folded in
place. Going back down, a block hands each member the siblings of its path. No group, however large, meets in a task.

A null source is a group of its own, before all others. A null id comes before all others of its source, and its text
is never tampered with. Equal rows are leaves of their own, side by side. Null fields are `-`. An empty table has no
leaf and gives no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratum.sources.scratch import materialize

RUN = 16
_LEVELS = 2  # folded at once
BLOCK = RUN**_LEVELS
_DIGIT = 10  # bits of a key that one level of the directory resolves
_FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: The groups' roots are leaves of one more tree; no group's key is empty.
_TOP = ""


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(**changed: Column) -> Column:
    return F.sha2(F.concat(*[_field(changed.get(name, F.col(name))) for name in _FIELDS]), 256)


def tampered(doc_id: Column, modulus: int = 5) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % modulus == 0, F.lit(False))


def leaves(docs: DataFrame) -> DataFrame:
    """(tree, doc_id, leaf, now, uid): the digest of each row, that after tampering, and a number of its own."""
    lowered = leaf_digest(text=F.translate("text", _UPPER, _LOWER))
    return docs.select(
        F.coalesce(F.concat(F.lit(":"), "source"), F.lit("-")).alias("tree"),  # sorts as sources do, null first
        F.col("doc_id").cast("long").alias("doc_id"),
        leaf_digest().alias("leaf"),
        F.when(tampered(F.col("doc_id")), lowered).alias("now"),
        F.monotonically_increasing_id().alias("uid"),
    )


# --- places ---------------------------------------------------------------------------------


def counts_before(counts: DataFrame, group: list[str], key: str) -> DataFrame:
    """`counts` (a row per group and key, with n) and, for each row, `before`: n at smaller keys, and `total`, n of all.

    The directory: sums over runs of 1024 keys, over runs of 1024 of those, and so on, until a group has
    1024 nodes at most.
    Numbers are then added up from the top down, inside each node only.
    """
    counts = materialize(counts, "directory")
    low, high = counts.agg(F.min(key), F.max(key)).first()
    levels, shift = [counts], 0
    while low is not None and (high >> shift) - (low >> shift) >= 1 << _DIGIT:
        shift += _DIGIT
        above = levels[-1].groupBy(*group, F.shiftright(key, _DIGIT).alias(key)).agg(F.sum("n").alias("n"))
        levels.append(materialize(above, "directory"))
    earlier = lambda keys: Window.partitionBy(*keys).orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    found = levels[-1].withColumns({
        "before": F.coalesce(F.sum("n").over(earlier(group)), F.lit(0)),
        "total": F.sum("n").over(Window.partitionBy(*group)),
    })
    for level in reversed(levels[:-1]):
        parents = found.select(*group, F.col(key).alias("parent"), F.col("before").alias("start"), "total")
        nodes = level.withColumn("parent", F.shiftright(key, _DIGIT)).join(parents, [*group, "parent"])
        before = F.col("start") + F.coalesce(F.sum("n").over(earlier([*group, "parent"])), F.lit(0))
        found = nodes.withColumn("before", before).drop("parent", "start")
    return found


def _bit(place: str) -> Column:
    return F.expr(f"shiftleft(1L, cast({place} as int))")


def numbered(rows: DataFrame) -> DataFrame:
    """(tree, idx, size, uid, doc_id, leaf, now): each leaf with its place in its tree, and the leaves of that tree."""
    least = rows.agg(F.min(F.shiftright("doc_id", 6))).first()[0] or 0
    word = F.coalesce(F.shiftright("doc_id", 6), F.lit(least - 1)).alias("word")  # a null id lies before all others
    place = F.coalesce(F.col("doc_id").bitwiseAND(F.lit(63)), F.lit(0)).alias("place")
    placed = rows.select("*", word, place)
    bitmap = placed.groupBy("tree", "word").agg(F.bit_or(_bit("place")).alias("bits"), F.count("*").alias("n"))
    words = materialize(counts_before(materialize(bitmap, "bitmap"), ["tree"], "word"), "directory")

    lower = F.when(F.col("place") > 0, F.expr("shiftrightunsigned(-1L, cast(64 - place as int))")).otherwise(0)
    below = F.bit_count(F.col("bits").bitwiseAND(lower))
    repeated = words.filter(F.col("n") > F.bit_count("bits")).select("tree", "word")
    found = placed.join(words.drop("n"), ["tree", "word"])
    single = found.withColumn("idx", F.col("before") + below)
    kept = ["tree", "idx", F.col("total").alias("size"), "uid", "doc_id", "leaf", "now"]
    if repeated.isEmpty():
        return single.select(*kept)

    # Words in which an id stands more than once: how often each id does, and the rows of such ids.
    again = placed.join(repeated, ["tree", "word"], "left_semi")
    often = again.groupBy("tree", "word", "place").agg(F.count("*").alias("n")).filter("n > 1")
    extras = often.groupBy("tree", "word").agg(
        F.collect_list(F.struct("place", (F.col("n") - 1).alias("more"))).alias("extras")  # 64 at most
    )
    extras = materialize(extras, "repeated-ids")
    earlier = F.filter("extras", lambda e: e.place < F.col("place"))
    more = F.coalesce(F.aggregate(earlier, F.lit(0).cast("long"), lambda t, e: t + e.more), F.lit(0))
    among = F.coalesce(F.exists("extras", lambda e: e.place == F.col("place")), F.lit(False))
    shifted = single.join(extras, ["tree", "word"], "left").withColumn("idx", F.col("idx") + more)
    shifted = materialize(shifted.select(*kept, "word", "place", among.alias("among")), "places")
    ties = _tie_places(shifted.filter("among"))
    out = ["tree", "idx", "size", "uid", "doc_id", "leaf", "now"]
    return shifted.filter("not among").select(*out).unionByName(
        ties.withColumn("idx", F.col("idx") + F.col("tie")).select(*out)
    )


def _tie_places(rows: DataFrame) -> DataFrame:
    """Rows of one id in one tree, numbered (tie) by digest, equal ones by the task and row that read them.

    Directories again, over the first 60 bits of the digest and, for equal digests, over the reading tasks, so that
    rows are numbered one by one only within one digest and task.
    """
    same = ["tree", "word", "place"]
    key = F.conv(F.substring("leaf", 1, 15), 16, 10).cast("long").alias("key")
    rows = rows.select("*", key, F.shiftright("uid", 33).alias("task"))
    by_digest = counts_before(rows.groupBy(*same, "key").agg(F.count("*").alias("n")), same, "key")
    by_task = counts_before(
        rows.groupBy(*same, "key", "leaf", "task").agg(F.count("*").alias("n")), [*same, "key", "leaf"], "task"
    )
    own = Window.partitionBy(*same, "key", "leaf", "task").orderBy("uid")
    # Two digests that agree in 60 bits come one after the other.
    leaf_order = Window.partitionBy(*same, "key").orderBy("leaf").rowsBetween(Window.unboundedPreceding, -1)
    digests = rows.groupBy(*same, "key", "leaf").agg(F.count("*").alias("n"))
    digests = digests.withColumn("lead", F.coalesce(F.sum("n").over(leaf_order), F.lit(0))).drop("n")
    return (
        rows.withColumn("tie", F.row_number().over(own) - 1)
        .join(by_digest.select(*same, "key", F.col("before").alias("start")), [*same, "key"])
        .join(digests, [*same, "key", "leaf"])
        .join(by_task.select(*same, "key", "leaf", "task", F.col("before").alias("ahead")), [*same, "key", "leaf", "task"])
        .withColumn("tie", F.col("tie") + F.col("start") + F.col("lead") + F.col("ahead"))
    )


# --- levels ---------------------------------------------------------------------------------


def _digest(parts: list[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _levels_left(size: int) -> int:
    levels = 0
    while size > 1 and levels < _LEVELS:
        size, levels = -(-size // RUN), levels + 1
    return levels


def _slots(table: pa.Table, digest: str) -> list[str]:
    """The block's digests in an array keyed by place."""
    slots = [""] * table.num_rows
    for place, value in zip(table["idx"].to_pylist(), table[digest].to_pylist()):
        slots[place % BLOCK] = value
    return slots


def _folded(slots: list[str], levels: int) -> list[list[str]]:
    """The block's digests level by level, from its members to what is left of them."""
    out = [slots]
    for _ in range(levels):
        out.append([_digest(out[-1][at : at + RUN]) for at in range(0, len(out[-1]), RUN)])
    return out


def _reduce(key: tuple, nodes: pa.Table, digest: str) -> pa.Table:
    size = nodes["size"][0].as_py()
    levels = _levels_left(size)
    for _ in range(levels):
        size = -(-size // RUN)
    return pa.table({
        "tree": pa.array([key[0].as_py()]), "idx": pa.array([key[1].as_py()], pa.int64()),
        "size": pa.array([size], pa.int64()), "node": pa.array(_folded(_slots(nodes, digest), levels)[-1]),
    })


def reduced(nodes: DataFrame, digest: str) -> DataFrame:
    """(tree, idx, size, node): blocks of 256 places folded into one node each."""
    fold = lambda key, table: _reduce(key, table, digest)
    blocks = _by_block(nodes.select("tree", "idx", "size", digest), _block_of("idx"))
    return blocks.applyInArrow(fold, "tree string, idx long, size long, node string")


def _paths(key: tuple, nodes: pa.Table, outer: pa.Table, digest: str) -> Iterator[tuple[int, list[str], list[str]]]:
    """(row, digests before, digests after) of each member of a block: its own levels, then those above the block."""
    levels = _folded(_slots(nodes, digest), _levels_left(nodes["size"][0].as_py()))
    above = outer["before"][0].as_py(), outer["after"][0].as_py()
    for row, place in enumerate(nodes["idx"].to_pylist()):
        at, before, after = place % BLOCK, [], []
        for level in levels[:-1]:
            first = at - at % RUN
            before.append("".join(level[first:at]))
            after.append("".join(level[at + 1 : first + RUN]))
            at //= RUN
        yield row, before + above[0], after + above[1]


def _descend(key: tuple, nodes: pa.Table, outer: pa.Table) -> pa.Table:
    if not nodes.num_rows:
        return _PATHS.empty_table()
    found = list(_paths(key, nodes, outer, "node"))
    return pa.table({
        "tree": nodes["tree"], "idx": nodes["idx"], "before": pa.array([b for _, b, _ in found], _STRINGS),
        "after": pa.array([a for _, _, a in found], _STRINGS),
    })


def _prove(key: tuple, nodes: pa.Table, outer: pa.Table) -> pa.Table:
    """The digest of each leaf's siblings, and the root that they give with what the leaf is now."""
    if not nodes.num_rows:
        return _PROOFS.empty_table()
    leaf, now = nodes["leaf"].to_pylist(), nodes["now"].to_pylist()
    proofs, roots = [], []
    for row, before, after in _paths(key, nodes, outer, "leaf"):
        proofs.append(_digest([part for pair in zip(before, after) for part in pair]))
        root = now[row] or leaf[row]
        for left, right in zip(before, after):
            root = _digest([left, root, right])
        roots.append(root)
    same = lambda name: pa.array([outer[name][0].as_py()] * nodes.num_rows, pa.string())
    return pa.table({
        "doc_id": nodes["doc_id"], "leaf": nodes["leaf"], "subroot": same("subroot"), "root": same("root"),
        "proof_sha256": pa.array(proofs, pa.string()), "folded_root": pa.array(roots, pa.string()),
    })


_STRINGS = pa.list_(pa.string())
_PATHS = pa.schema([("tree", pa.string()), ("idx", pa.int64()), ("before", _STRINGS), ("after", _STRINGS)])
_PROOFS = pa.schema([("doc_id", pa.int64()), *[(n, pa.string()) for n in ("leaf", "subroot", "root", "proof_sha256", "folded_root")]])


def _by_block(df: DataFrame, block: Column):
    return df.withColumn("block", block).groupBy("tree", "block")


def ascend(nodes: DataFrame, digest: str) -> tuple[list[DataFrame], DataFrame]:
    """The levels above the given ones, block by block until each tree has one node, and the (tree, node) of those."""
    levels, wide = [], nodes
    while True:
        wide = materialize(reduced(wide, digest), "merkle-level")
        digest = "node"
        levels.append(wide)
        if wide.filter("size > 1").isEmpty():
            return levels, wide.select("tree", "node")


def group_order(groups: DataFrame) -> DataFrame:
    """(tree, idx): the groups' places by key, numbered within sorted ranges that are then counted."""
    spread = groups.orderBy("tree").select("tree", F.monotonically_increasing_id().alias("uid"))
    spread = materialize(spread, "groups").withColumn("part", F.shiftright("uid", 33))
    parts = spread.groupBy("part").agg(F.count("*").alias("n"))
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each task
    parts = parts.withColumn("ahead", F.coalesce(F.sum("n").over(ahead), F.lit(0))).drop("n")
    first = F.col("uid").bitwiseAND(F.lit((1 << 33) - 1))
    return spread.join(F.broadcast(parts), "part").select("tree", (F.col("ahead") + first).alias("idx"))


def manifest(docs: DataFrame) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of every row.

    `proof_sha256` is the digest of the siblings on a leaf's way to the root; `folded_root` is the root that they give
    with the leaf as it is after tampering, and `verified` says whether it is still the same.
    """
    rows = materialize(leaves(docs.select(*_FIELDS)), "leaves")
    placed = materialize(numbered(rows), "placed-leaves")
    levels, subroots = ascend(placed, "leaf")
    ordered = subroots.join(group_order(subroots.select("tree")), "tree")
    total = subroots.agg(F.count("*").alias("size"))
    top = ordered.crossJoin(F.broadcast(total)).select(
        F.lit(_TOP).alias("tree"), "idx", "size", "node", F.col("tree").alias("group")
    )
    top = materialize(top, "subroots")
    top_levels, root = ascend(top.drop("group"), "node")

    empty = F.array().cast("array<string>")
    paths = root.select("tree", F.lit(0).cast("long").alias("idx"), empty.alias("before"), empty.alias("after"))
    for level in [*reversed(top_levels[:-1]), top.drop("group")]:
        paths = _down(level, paths)
    whole = root.select(F.col("node").alias("root"))
    of_group = paths.join(top.select("idx", "group", F.col("node").alias("subroot")), "idx").crossJoin(F.broadcast(whole))
    of_group = materialize(of_group.select(F.col("group").alias("tree"), "before", "after", "subroot", "root"), "groups")
    paths = of_group.select("tree", F.lit(0).cast("long").alias("idx"), "before", "after")
    for level in reversed(levels[:-1]):
        paths = _down(level, paths)
    outer = paths.join(of_group.select("tree", "subroot", "root"), "tree")
    proven = _by_block(placed, _block_of("idx")).cogroup(_by_block(outer, F.col("idx"))).applyInArrow(_prove, _schema(_PROOFS))
    return proven.withColumn("verified", F.col("folded_root") == F.col("root"))


def _block_of(idx: str) -> Column:
    return F.shiftright(idx, BLOCK.bit_length() - 1)


def _down(level: DataFrame, paths: DataFrame) -> DataFrame:
    """From the paths of nodes to those of the nodes below, a block for each."""
    found = _by_block(level, _block_of("idx")).cogroup(_by_block(paths, F.col("idx"))).applyInArrow(_descend, _schema(_PATHS))
    return materialize(found, "merkle-paths")


def _schema(schema: pa.Schema) -> str:
    kinds = {pa.string(): "string", pa.int64(): "long", _STRINGS: "array<string>"}
    return ", ".join(f"{f.name} {kinds[f.type]}" for f in schema)
