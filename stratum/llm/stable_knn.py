"""Nearest vectors by inner product, through low-dimensional stable projections and kd-trees.

Inner product becomes distance by one more coordinate, sqrt(M^2 - |x|^2), with M the largest norm: the nearest point is
then the one of the largest inner product. Points are projected on m Gaussian directions, which keeps distances in this
sense: projected squared distance over true squared distance is chi-square with m degrees of freedom. A kd-tree over
the projections lists points by projected distance. They are verified by their true inner products, nearest first,
until the chi-square test holds: a point beyond would be among the k best with a probability below 1 - `certainty`.

A coarse kd-tree, fitted to a bounded sample, cuts the projected space into cells for the tasks; every vector is put
into its cell, and cells of many rows are dealt over several tasks. A query first searches its own cell, which bounds
its k-th distance, then the other cells that the test does not rule out by their boxes. The visits of a cell go in blocks
of a bounded size, and its points to these blocks and no others. Vectors that are null, zero, or hold null or non-finite components take no part. Vectors of unequal
length have no inner product: each length is searched by itself, among its own vectors. A repeated row is a candidate
of its own but one query; a vec_id with several vectors is a query for each of them, and only the query's own vec_id is
left out; equal products go to the smaller vec_id; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratum.sources.scratch import materialize

SAMPLE_ROWS = 16_384
_FOUND = "query_id long, twin long, vec_id long, score double"  # twin: a hash that tells vectors of one vec_id apart


def chi_square_quantile(p: float, m: int) -> float:
    """For even m, where the distribution function is a finite sum."""

    def below(x: float) -> float:
        return 1 - math.exp(-x / 2) * sum((x / 2) ** i / math.factorial(i) for i in range(m // 2))

    low, high = 0.0, 1.0
    while below(high) < p:
        high *= 2
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if below(middle) < p else (low, middle)
    return high


@dataclass
class Projection:
    directions: np.ndarray  # of the vectors with their added coordinate
    longest: float

    def points(self, vectors: np.ndarray) -> np.ndarray:
        rest = np.sqrt(np.maximum(self.longest**2 - (vectors**2).sum(1), 0))
        return np.column_stack([vectors, rest]) @ self.directions

    def queries(self, vectors: np.ndarray) -> np.ndarray:
        return vectors @ self.directions[:-1]


@dataclass
class KdTree:
    """The planes of a kd-tree: which axis is cut where, and what lies to each side, a node or (as ~leaf) a leaf."""

    axis: np.ndarray
    cut: np.ndarray
    sides: np.ndarray

    def leaf_of(self, points: np.ndarray) -> np.ndarray:
        """The leaf in whose part of the space each point lies, a level of the tree at a time."""
        at = np.zeros(len(points), np.int64) if len(self.axis) else np.full(len(points), ~0)
        going = np.flatnonzero(at >= 0)
        while len(going):
            node = at[going]
            above = points[going, self.axis[node]] >= self.cut[node]
            at[going] = self.sides[node, above.astype(np.int64)]
            going = going[at[going] >= 0]
        return ~at


def kd_tree(points: np.ndarray, most: int) -> tuple[list[tuple[np.ndarray, np.ndarray, np.ndarray]], KdTree]:
    """The leaves, each (places of its points, lower corner, upper corner) of its part of the space, and the planes."""
    m = points.shape[1]
    open_ = [(np.arange(len(points)), np.full(m, -np.inf), np.full(m, np.inf), -1, 0)]
    leaves, axes, cuts, sides = [], [], [], []
    while open_:
        at, low, high, parent, side = open_.pop()
        own = points[at]
        spread = own.max(0) - own.min(0) if len(at) else np.zeros(m)
        axis = int(spread.argmax())
        cut = float(np.median(own[:, axis])) if len(at) > most else 0.0
        left = own[:, axis] < cut if len(at) > most else None
        small = left is None or not left.any() or left.all()  # or points that no plane parts
        if parent >= 0:
            sides[parent][side] = ~len(leaves) if small else len(axes)
        if small:
            leaves.append((at, low, high))
            continue
        number = len(axes)
        axes.append(axis)
        cuts.append(cut)
        sides.append([0, 0])
        below, above = high.copy(), low.copy()
        below[axis] = above[axis] = cut
        open_ += [(at[~left], above, high, number, 1), (at[left], low, below, number, 0)]
    return leaves, KdTree(np.array(axes, np.int64), np.array(cuts), np.array(sides, np.int64).reshape(-1, 2))


def _vectors(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def _box_distance(points: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distance of each point to each box."""
    out = np.zeros((len(points), len(low)))
    for axis in range(points.shape[1]):
        x = points[:, axis : axis + 1]
        out += np.maximum(np.maximum(low[:, axis] - x, x - high[:, axis]), 0) ** 2
    return out


def _assign(batches: Iterator[pa.RecordBatch], projection: Projection, tree: KdTree) -> Iterator[pa.RecordBatch]:
    """Adds the cell of each vector: the one box that holds its projection."""
    for batch in batches:
        for at in range(0, batch.num_rows, 4096):
            rows = batch.slice(at, 4096)
            cell = tree.leaf_of(projection.points(_vectors(rows.column("vector"))))
            yield pa.RecordBatch.from_arrays(
                [rows.column("vec_id"), rows.column("vector"), pa.array(cell)], names=["vec_id", "vector", "cell"]
            )


def search(
    ids: np.ndarray, vectors: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, kth: np.ndarray,
    projection: Projection, k: int, limit: float, leaf_rows: int = 64,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place of the query, vec_id, inner product) of up to k candidates a query that may be among its k best.

    kth: for each query the k-th best product that is known so far, or -inf. limit: the chi-square quantile.
    """
    projected = projection.points(vectors)
    asked = projection.queries(queries)
    leaves = [at for at, _, _ in kd_tree(projected, leaf_rows)[0]]
    low = np.array([projected[at].min(0) for at in leaves])
    high = np.array([projected[at].max(0) for at in leaves])
    away = _box_distance(asked, low, high)
    order = np.argsort(away, axis=1, kind="stable")
    base = (queries**2).sum(1) + projection.longest**2
    bound = kth.copy()
    row, vec, score = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    for step in range(len(leaves)):
        # The squared distance of the k-th best is base - 2 * bound; nothing beyond limit times that is worth a look.
        nearest = away[np.arange(len(asked)), order[:, step]]
        active = np.flatnonzero((bound == -np.inf) | (nearest <= limit * np.maximum(base - 2 * bound, 0)))
        if not len(active):
            break
        rows_, vecs_, scores_ = [row], [vec], [score]
        leaf_of = order[active, step]
        by_leaf = np.argsort(leaf_of, kind="stable")
        groups = np.flatnonzero(np.diff(leaf_of[by_leaf], prepend=-1))
        for a, b in zip(groups, np.append(groups[1:], len(by_leaf))):
            who, members = active[by_leaf[a:b]], leaves[leaf_of[by_leaf[a]]]
            near = queries[who] @ vectors[members].T
            i, j = np.nonzero(near >= bound[who][:, None] - 1e-9 * projection.longest**2)
            i, j = who[i], members[j]
            other = ids[j] != query_ids[i]
            i, j = i[other], j[other]
            rows_.append(i)
            vecs_.append(ids[j])
            scores_.append((queries[i] * vectors[j]).sum(1))  # the same sum for equal vectors, wherever they stand
        row, vec, score = np.concatenate(rows_), np.concatenate(vecs_), np.concatenate(scores_)
        best = np.lexsort((vec, -score, row))
        row, vec, score = row[best], vec[best], score[best]
        first = np.searchsorted(row, row, side="left")
        place = np.arange(len(row)) - first
        last = place == k - 1
        bound[row[last]] = np.maximum(bound[row[last]], score[last])
        kept = place < k
        row, vec, score = row[kept], vec[kept], score[kept]
    return row, vec, score


def _search_group(points: pa.Table, asked: pa.Table, projection: Projection, k: int, limit: float) -> pa.Table:
    if not points.num_rows or not asked.num_rows:
        kinds = {"query_id": pa.int64(), "twin": pa.int64(), "vec_id": pa.int64(), "score": pa.float64()}
        return pa.schema(kinds).empty_table()
    points, asked = points.combine_chunks(), asked.combine_chunks()
    query_ids = asked["query_id"].to_numpy()
    row, vec, score = search(
        points["vec_id"].to_numpy(), _vectors(points["vector"].chunk(0)), query_ids,
        _vectors(asked["vector"].chunk(0)), asked["kth"].to_numpy(), projection, k, limit,
    )
    return pa.table({
        "query_id": query_ids[row], "twin": asked["twin"].to_numpy()[row], "vec_id": vec, "score": score,
    })


def valid_vectors(table: DataFrame) -> DataFrame:
    """(vec_id, vector of doubles, norm) of the rows that take part."""
    rows = table.select("vec_id", F.col("embedding").cast("array<double>").alias("vector"))
    good = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.filter(F.col("vec_id").isNotNull() & (F.size("vector") > 0) & F.coalesce(good, F.lit(False)))
    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x))
    return rows.withColumn("norm", norm).filter(F.col("norm") > 0)


def nearest(
    table: DataFrame, every: int = 20, k: int = 20, m: int = 8, certainty: float = 0.97, cell_rows: int = 2048,
    query_rows: int = 4096, seed: int = 7,
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each vec_id divisible by `every`, its k best of all other rows."""
    rows = valid_vectors(table)
    asked = F.count_if(F.col("vec_id") % every == 0)
    lengths = rows.groupBy(F.size("vector").alias("dims")).agg(
        F.count("*").alias("n"), F.max("norm").alias("longest"), asked.alias("asked")
    )
    found = table.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    for dims, n, longest, _ in lengths.filter("asked > 0 and n > 1").sort("dims").collect():  # a row per length
        own = rows.filter(F.size("vector") == dims).drop("norm")
        found = found.unionByName(_nearest(own, n, longest, dims, every, k, m, certainty, cell_rows, query_rows, seed))
    return found


def _nearest(
    rows: DataFrame, n: int, longest: float, dims: int, every: int, k: int, m: int, certainty: float, cell_rows: int,
    query_rows: int, seed: int,
) -> DataFrame:
    """The result of `nearest` for vectors of one length."""
    projection = Projection(np.random.default_rng(seed).standard_normal((dims + 1, m)), longest)
    limit = chi_square_quantile(certainty, m)

    share = min(1.0, SAMPLE_ROWS / n)
    lot = F.pmod(F.xxhash64("vec_id", F.lit(seed)), F.lit(1_000_000))
    drawn = rows.filter(lot < int(share * 1_000_000) + 1).select("vector").toArrow().combine_chunks()
    fitted = projection.points(_vectors(drawn["vector"].chunk(0))) if drawn.num_rows else np.zeros((1, m))
    boxes, tree = kd_tree(fitted, max(1, int(len(fitted) * cell_rows / n)))
    low, high = np.array([b[1] for b in boxes]), np.array([b[2] for b in boxes])

    assign = partial(_assign, projection=projection, tree=tree)
    points = materialize(rows.mapInArrow(assign, "vec_id long, vector array<double>, cell long"), "knn-points")
    sizes = points.groupBy("cell").agg(F.count("*").alias("rows"), F.count_if(F.col("vec_id") % every == 0).alias("q"))
    held = {r.cell: (r.rows, r.q) for r in sizes.collect()}  # a row per cell; the sample bounds their number
    parts = [max(1, -(-held.get(c, (0, 0))[0] // cell_rows)) for c in range(len(boxes))]
    n_parts = F.get(F.split(F.lit(",".join(map(str, parts))), ","), F.col("cell").cast("int")).cast("int")
    points = points.withColumn("part", F.pmod(F.xxhash64("vec_id", F.lit(1)), n_parts).cast("int"))
    queries = points.filter(F.col("vec_id") % every == 0).select(
        F.col("vec_id").alias("query_id"), "vector", F.col("cell").alias("home"),
        F.col("part").alias("home_part"), F.xxhash64("vector").alias("twin"),
    ).dropDuplicates(["query_id", "twin"])

    def look(asked: DataFrame) -> DataFrame:
        """Searches the part of a cell that each row of `asked` names. Only visited parts are sent, each once for every
        `query_rows` of its visits."""
        asked = materialize(asked, "knn-visits")
        visits = asked.groupBy("cell", "part").agg(F.ceil(F.count("*") / query_rows).cast("int").alias("blocks"))
        visits = materialize(visits, "knn-visited")
        block = F.pmod(F.xxhash64("query_id", "twin", F.lit(2)), F.col("blocks")).cast("int")
        asked = asked.join(visits, ["cell", "part"]).withColumn("block", block).drop("blocks")
        copies = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block")
        dealt = points.join(visits, ["cell", "part"]).select("cell", "part", copies, "vec_id", "vector")
        keys = ["cell", "part", "block"]
        work = partial(_search_group, projection=projection, k=k, limit=limit)
        return dealt.groupBy(keys).cogroup(asked.groupBy(keys)).applyInArrow(work, _FOUND)

    def best(found: DataFrame) -> DataFrame:
        order = Window.partitionBy("query_id", "twin").orderBy(F.desc("score"), "vec_id")
        return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)

    at_home = queries.withColumns({"cell": F.col("home"), "part": F.col("home_part"), "kth": F.lit(float("-inf"))})
    first = materialize(look(at_home), "knn-home")
    bounds = best(first).filter(F.col("rank") == k).select("query_id", "twin", F.col("score").alias("kth"))
    spread = queries.join(bounds, ["query_id", "twin"], "left")
    spread = spread.withColumn("kth", F.coalesce("kth", F.lit(float("-inf"))))
    route = partial(_route, projection=projection, low=low, high=high, parts=parts, limit=limit)
    visits = spread.mapInArrow(
        route, "query_id long, twin long, vector array<double>, kth double, cell long, part int"
    )
    found = best(first.unionByName(look(visits)))
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _route(
    batches: Iterator[pa.RecordBatch], projection: Projection, low, high, parts: list[int], limit: float
) -> Iterator[pa.RecordBatch]:
    """A row for each part of a cell that a query has yet to visit: the test does not rule out the cell's box."""
    n_parts = np.array(parts)
    for batch in batches:
        for begin in range(0, batch.num_rows, 1024):
            rows = batch.slice(begin, 1024)
            vectors, kth = _vectors(rows.column("vector")), rows.column("kth").to_numpy(zero_copy_only=False)
            away = _box_distance(projection.queries(vectors), low, high)
            reach = np.where(kth == -np.inf, np.inf, limit * np.maximum(
                (vectors**2).sum(1) + projection.longest**2 - 2 * kth, 0))
            query, cell = np.nonzero(away <= reach[:, None])
            home = rows.column("home").to_numpy(zero_copy_only=False)[query] == cell
            seen = rows.column("home_part").to_numpy(zero_copy_only=False)[query]
            times = n_parts[cell]
            part = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            query, cell = np.repeat(query, times), np.repeat(cell, times)
            fresh = ~(np.repeat(home, times) & (part == np.repeat(seen, times)))
            query, cell, part = query[fresh], cell[fresh], part[fresh]
            for a in range(0, len(query), 8192):
                taken = rows.take(pa.array(query[a : a + 8192]))
                yield pa.RecordBatch.from_arrays(
                    [*(taken.column(c) for c in ("query_id", "twin", "vector", "kth")),
                     pa.array(cell[a : a + 8192], pa.int64()), pa.array(part[a : a + 8192], pa.int32())],
                    names=["query_id", "twin", "vector", "kth", "cell", "part"],
                )
