"""NTILE over a whole table without sorting it in one task.

A row's tile depends only on how it compares with the first row of each tile. So instead of numbering all
rows, the few rows that start a tile are found exactly, and every row is then labelled by comparing it with
those: a projection, with no shuffle and no window.

The starting rows are found by narrowing. A sample of bounded expected size, chosen by hash and numbered in
Spark, suggests for each start a lower and an upper row between which it should lie; one aggregate over the
table counts the rows below both. The counts prove whether the start lies between them; if not, that side is
opened and counted again. A pair that still encloses many rows is narrowed by a sample of the rows inside. In
the end the few enclosed rows are numbered. The sample only chooses where to look: the result is exact for any
sample, at every size. Only the suggested rows and the tile starts reach the driver, and only Spark compares.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Rows expected in a sample, and most rows numbered in one task per tile start.
SAMPLE_ROWS = 16_384
ENCLOSED_ROWS = 500_000
_SIGMAS = 5
_HASHES = 2**40
_LEAST_SAMPLE = 100  # below this a sample may fail to narrow anything


@dataclass(frozen=True)
class Ranking:
    """Tiles ``name`` of the rows ordered by ``key`` (NULL last, or first when descending)."""

    name: str
    key: str
    descending: bool = False

    def sort_columns(self, tie: str) -> list[Column]:
        """What gives the order: NULL position and tie-break ascending, the key as the ranking says."""
        key = F.col(self.key)
        return [key.isNotNull() if self.descending else key.isNull(), key, F.col(tie)]

    def order(self, null: str, key: str, tie: str) -> list[Column]:
        return [F.col(null), F.col(key).desc() if self.descending else F.col(key).asc(), F.col(tie)]


@dataclass
class _Search:
    """Looks for the row with 0-based rank ``rank``: at or after ``low`` and before ``high``."""

    ranking: Ranking
    rank: int
    low: tuple | None = None
    high: tuple | None = None
    below: int = 0
    enclosed: int = 0
    proven: bool = False
    last_enclosed: int | None = None  # when its bounds were last narrowed


def tile_starts(rows: int, tiles: int) -> list[int]:
    """0-based ranks at which tiles 2, 3, ... start; the first (rows mod tiles) tiles have one row more."""
    size, larger = divmod(rows, tiles)
    starts = [tile * size + min(tile, larger) for tile in range(1, tiles)]
    return [s for s in starts if s < rows]


def add_ntiles(
    df: DataFrame,
    tie: str,
    rankings: Sequence[Ranking],
    tiles: int,
    sample_rows: int = SAMPLE_ROWS,
    enclosed_rows: int = ENCLOSED_ROWS,
) -> DataFrame:
    """Add ``ntile(tiles) over (order by key, tie)`` for every ranking.

    ``tie`` must be unique and not NULL. ``df`` is read a few times: pass a stored table.
    """
    starts = find_tile_starts(df, tie, rankings, tiles, sample_rows, enclosed_rows)
    labels = {}
    for ranking in rankings:
        tile = F.lit(1)
        for row in starts[ranking.name]:
            tile = tile + F.when(_at_or_after(df, ranking, tie, row), 1).otherwise(0)
        labels[ranking.name] = tile.cast("int")
    return df.withColumns(labels)


def find_tile_starts(
    df: DataFrame,
    tie: str,
    rankings: Sequence[Ranking],
    tiles: int,
    sample_rows: int = SAMPLE_ROWS,
    enclosed_rows: int = ENCLOSED_ROWS,
) -> dict[str, list[tuple]]:
    """For every ranking the sort values of the first row of tiles 2, 3, ..."""
    if sample_rows < _LEAST_SAMPLE:
        raise ValueError(f"sample_rows must be at least {_LEAST_SAMPLE}")
    total = df.count()
    searches = [_Search(r, rank, enclosed=total) for r in rankings for rank in tile_starts(total, tiles)]
    if not searches:
        return {r.name: [] for r in rankings}
    for ranking in rankings:
        own = [s for s in searches if s.ranking is ranking]
        _suggest(df, tie, ranking, own, sample_rows, total)
    while True:
        _count(df, tie, total, [s for s in searches if not s.proven])
        wide = [s for s in searches if s.proven and s.enclosed > enclosed_rows]
        if not wide and all(s.proven for s in searches):
            break
        for search in wide:
            # The same rows give the same sample again, so a search that did not shrink never would.
            if search.enclosed == search.last_enclosed:
                raise ValueError(f"{tie} does not tell {search.enclosed} rows of one {search.ranking.key} apart")
            search.last_enclosed = search.enclosed
            _suggest(df.filter(_inside(df, search, tie)), tie, search.ranking, [search], sample_rows, search.enclosed)
            search.proven = False
    return _number_enclosed(df, tie, rankings, searches)


# --- sort values --------------------------------------------------------------------------


def _suggest(
    df: DataFrame, tie: str, ranking: Ranking, searches: list[_Search], rows: int, total: int
) -> None:
    """New bounds for searches in the same ``total`` rows, some standard deviations about their share of a sample.

    The sample has about ``rows`` rows, chosen by a hash of ``tie``, so one task can number it.
    """
    if total > rows:
        hashed = F.pmod(F.xxhash64(tie), F.lit(_HASHES))
        df = df.filter(hashed < F.lit(_HASHES * rows // total))
    null, key, tie_column = ranking.sort_columns(tie)
    named = df.select(null.alias("_null"), key.alias("_key"), tie_column.alias("_tie"))
    size = named.count()
    wanted = {}
    for search in searches:
        share = (search.rank - search.below) / search.enclosed
        margin = _SIGMAS * math.sqrt(size * share * (1 - share)) + 1
        wanted[id(search)] = (math.floor(share * size - margin), math.ceil(share * size + margin))
    places = sorted({p for pair in wanted.values() for p in pair if 0 <= p < size})
    if not places:
        return
    position = F.row_number().over(Window.orderBy(*ranking.order("_null", "_key", "_tie"))) - 1
    found = named.withColumn("_position", position).filter(F.col("_position").isin(places)).collect()
    rows_at = {r["_position"]: (r["_null"], r["_key"], r["_tie"]) for r in found}
    for search in searches:
        first, last = wanted[id(search)]
        search.low, search.high = rows_at.get(first, search.low), rows_at.get(last, search.high)


def _at_or_after(df: DataFrame, ranking: Ranking, tie: str, row: tuple) -> Column:
    """True for rows that sort at or after ``row``; never NULL."""
    null, key, tie_column = ranking.sort_columns(tie)
    _, row_key, row_tie = row
    if row_key is None:
        later_tie = tie_column >= F.lit(row_tie)
        return null | later_tie if ranking.descending else null & later_tie
    limit = F.lit(row_key).cast(df.schema[ranking.key].dataType)
    beyond = key < limit if ranking.descending else key > limit
    after = beyond | ((key == limit) & (tie_column >= F.lit(row_tie)))
    return F.coalesce(after, F.lit(not ranking.descending))


def _inside(df: DataFrame, search: _Search, tie: str) -> Column:
    conditions = []
    if search.low is not None:
        conditions.append(_at_or_after(df, search.ranking, tie, search.low))
    if search.high is not None:
        conditions.append(~_at_or_after(df, search.ranking, tie, search.high))
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


# --- narrowing ----------------------------------------------------------------------------


def _count(df: DataFrame, tie: str, total: int, searches: list[_Search]) -> None:
    """Count, for all searches in one pass, the rows before each bound; open a bound that missed."""
    counts = []
    for i, search in enumerate(searches):
        for side, row in (("low", search.low), ("high", search.high)):
            if row is not None:
                before = ~_at_or_after(df, search.ranking, tie, row)
                counts.append(F.count_if(before).alias(f"{side}_{i}"))
    result = df.agg(F.count(F.lit(1)), *counts).first()
    for i, search in enumerate(searches):
        below = 0 if search.low is None else result[f"low_{i}"]
        before_high = total if search.high is None else result[f"high_{i}"]
        search.proven = below <= search.rank < before_high
        if search.proven:
            search.below, search.enclosed = below, before_high - below
        elif search.rank < below:
            search.low, search.high = None, search.low
        else:
            search.low, search.high = search.high, None


def _number_enclosed(
    df: DataFrame, tie: str, rankings: Sequence[Ranking], searches: list[_Search]
) -> dict[str, list[tuple]]:
    """Number the enclosed rows of every search and pick the one at its rank."""
    found: dict[str, list[tuple]] = {}
    for ranking in rankings:
        own = [s for s in searches if s.ranking is ranking]
        null, key, _ = ranking.sort_columns(tie)
        inside = [_inside(df, s, tie) for s in own]
        searched = F.array_compact(F.array(*[F.when(c, F.lit(i)) for i, c in enumerate(inside)]))
        window = Window.partitionBy("_search").orderBy(*ranking.order("_null", "_key", "_tie"))
        position = reduce(
            lambda c, i: c.when(F.col("_search") == i, own[i].rank - own[i].below + 1),
            range(1, len(own)),
            F.when(F.col("_search") == 0, own[0].rank - own[0].below + 1),
        )
        rows = (
            df.filter(reduce(lambda a, b: a | b, inside))
            .select(
                F.explode(searched).alias("_search"),
                null.alias("_null"),
                key.alias("_key"),
                F.col(tie).alias("_tie"),
            )
            .withColumn("_position", F.row_number().over(window))
            .filter(F.col("_position") == position)
            .collect()
        )
        by_search = {r["_search"]: (r["_null"], r["_key"], r["_tie"]) for r in rows}
        found[ranking.name] = [by_search[i] for i in range(len(own))]
    return found
