"""Incremental maintenance of a keyed parquet table: high-water mark, batch, merge.

Built-in parquet tables have no MERGE, so the merge rewrites exactly the partitions that hold a key of the
batch or receive one, as a new version of the table (``stratum.sources.versions``). With a catalog whose tables
support row-level changes, ``merge_into`` does the same as one statement.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from stratum.functions import as_timestamp
from stratum.operators.dedup import first_per_key
from stratum.sources import versions
from stratum.sources.layers import cluster, replace_table
from stratum.sources.scratch import dropped_after, materialize, shuffles_dropped

#: Keys of a batch are broadcast up to this number, and joined by a shuffle beyond it.
MOST_BROADCAST_KEYS = 1_000_000

#: Up to so many keys are looked up as a list, which the bloom filters of the files are tried on.
MOST_LISTED_KEYS = 500


class DuplicateKeys(ValueError):
    """One batch holds a key more than once."""


def high_water_mark(target: DataFrame, column: str = "_loaded_at") -> dt.datetime | None:
    """Newest load time the target holds, or None when it is empty."""
    return target.agg(F.max(column)).first()[0]


def newer_than(
    source: DataFrame, mark: dt.datetime | None, column: str = "_loaded_at", lookback_days: int = 0
) -> DataFrame:
    """Source rows loaded strictly after the mark; all rows when there is none.

    The mark is a literal, so the filter reaches the file scan. Rows that arrive late with a load time at or
    below the mark, or without one, are not seen; ``lookback_days`` moves the mark back to read those again.
    """
    if mark is None:
        return source
    return source.filter(F.col(column) > as_timestamp(mark - dt.timedelta(days=lookback_days)))


def latest_per_key(batch: DataFrame, key: str, order: str = "_loaded_at") -> DataFrame:
    """One row per key, the newest; rows loaded at the same time are told apart by their values."""
    rest = [c for c in batch.columns if c not in (key, order)]
    return first_per_key(batch, [key], [F.desc_nulls_last(order), *rest])


def outdated_keys(held: DataFrame, key: str, order: str, new: str) -> DataFrame:
    """Keys of which a newer row is held than the batch's, whose ``order`` is ``new``; no load time counts as oldest."""
    newer = F.col(order).isNotNull() & F.coalesce(F.col(order) > F.col(new), F.lit(True))
    return held.filter(newer).select(key).distinct()


def merged(
    target: DataFrame, batch: DataFrame, key: str, broadcast: bool = False, keys: DataFrame | None = None
) -> DataFrame:
    """Target rows whose key is not in the batch, and all batch rows. No target row is ever just deleted.

    With ``broadcast`` the keys of the batch are sent to the target, whose rows are then not shuffled for the join.
    ``keys`` may name those of them that the target has.
    """
    keys = batch.select(key) if keys is None else keys
    kept = target.join(F.broadcast(keys) if broadcast else keys, key, "left_anti")
    return kept.select(*batch.columns).unionByName(batch)


def upsert(
    spark: SparkSession,
    batch: DataFrame,
    path: str,
    types: dict[str, str],
    key: str,
    partition_by: str,
    cluster_by: Sequence[str],
    on_duplicate: str = "raise",
    order: str = "_loaded_at",
    row_checks: Mapping[str, Column] | None = None,
) -> int:
    """Merge a batch into the versioned table at ``path``; returns the number of rows in the batch.

    A key repeated within the batch is refused (``raise``), or its newest row is taken (``latest``). A batch row
    that is older than the table's row of its key, by ``order``, does not replace it. The first batch makes the table.

    Only files that can hold a key of the batch are opened: those of partitions whose keys, as the log has them,
    lie around the batch's, and for a batch of few keys those whose bloom filter knows one. The partitions that hold
    or receive a key are written anew, as a version that counts from the moment the log points to it. A run that dies
    before leaves the table as it was, and one of two runs at once is refused.
    """
    if on_duplicate not in ("raise", "latest"):
        raise ValueError(f"unknown on_duplicate {on_duplicate!r}")
    batch = batch.select(*types)
    if on_duplicate == "latest":
        batch = latest_per_key(batch, key, order)
    with dropped_after(spark):
        # Stored once, since it is read for its keys, its partitions and its rows; measured while it is written.
        measured = Observation()
        watched = batch.observe(
            measured, F.count(F.lit(1)).alias("n"), F.min(key).cast("string").alias("low"), F.max(key).cast("string").alias("high")
        )
        batch = materialize(watched, "merge-batch")
        rows, low, high = (measured.get[x] for x in ("n", "low", "high"))
        base = versions.current(spark, path)
        if not rows and base is not None:
            return 0
        refuse_duplicates(batch, key)
        if base is None:
            full_load(batch, path, types, key, partition_by, cluster_by, None, order, row_checks)
            return rows
        few = rows <= MOST_BROADCAST_KEYS
        opened = base.may_hold(low, high)
        held = versions.read(spark, path, types, base, opened)
        if rows <= MOST_LISTED_KEYS:
            held = held.filter(_any_of(key, [r[0] for r in batch.select(key).collect()]))
        new = batch.select(key, F.col(order).alias("_new"))  # of keys that stand once, so no held row is repeated
        held = held.join(F.broadcast(new) if few else new, key)
        columns = [key, partition_by, *([order] if order != partition_by else []), "_new"]
        held = materialize(held.select(*columns), "merge-held")
        replaced = held
        outdated = materialize(outdated_keys(held, key, order, "_new"), "merge-outdated")
        if n_outdated := outdated.count():
            gone = F.broadcast(outdated) if n_outdated <= MOST_BROADCAST_KEYS else outdated
            batch, replaced = batch.join(gone, key, "left_anti"), held.join(gone, key, "left_anti")
        concerned = reduce(
            DataFrame.unionByName,
            [_parts(r, partition_by, role) for r, role in ((held, "holds"), (replaced, "replaced"), (batch, "receives"))],
        ).collect()
        changed = {r.part for r in concerned}
        if not any(r.role == "receives" for r in concerned):
            return rows  # everything in it is older than what the table has
        # Partitions of which every row is replaced need not be read.
        goes = {r.part: r.n for r in concerned if r.role == "replaced"}
        kept = [p for p in base.parts if p.part in changed and goes.get(p.part, 0) < p.n_rows]
        target = versions.read(spark, path, types, base, kept)
        rewritten = merged(target, batch, key, few, replaced.select(key))
        result = cluster(rewritten, leading(partition_by, cluster_by), [key])
        layout = versions.Layout(partition_by, key, order, row_checks)
        versions.commit(spark, result, path, layout, types, base, replaces=changed)
    return rows


def _parts(rows: DataFrame, partition_by: str, role: str) -> DataFrame:
    part = F.col(partition_by).cast("string").alias("part")
    return rows.groupBy(part).agg(F.count(F.lit(1)).alias("n")).withColumn("role", F.lit(role))


def _any_of(key: str, values: Sequence) -> Column:
    """In pieces short enough for the file reader to try each value on the bloom filters."""
    pieces = [F.col(key).isin(*values[at : at + 10]) for at in range(0, len(values), 10)]
    return reduce(lambda a, b: a | b, pieces)


def refuse_duplicates(batch: DataFrame, key: str) -> None:
    with shuffles_dropped(batch.sparkSession):
        repeated = batch.groupBy(key).agg(F.count("*").alias("times")).filter("times > 1").limit(5).collect()
    if repeated:
        raise DuplicateKeys(f"{key} repeated in one batch, for example {[r[0] for r in repeated]}")


def full_load(
    df: DataFrame,
    path: str,
    types: dict[str, str],
    key: str,
    partition_by: str,
    cluster_by: Sequence[str],
    on_duplicate: str | None = None,
    order: str = "_loaded_at",
    row_checks: Mapping[str, Column] | None = None,
    ranged: bool = False,
) -> None:
    """Build the table anew. ``on_duplicate`` treats repeated keys as ``upsert`` does; None takes all rows.

    ``ranged`` rows are dealt out by ranges of ``leading`` columns already, and only sorted here.
    """
    if on_duplicate == "latest":
        df = latest_per_key(df.select(*types), key, order)
    elif on_duplicate == "raise":
        refuse_duplicates(df, key)
    layout = versions.Layout(partition_by, key, order if order in types else None, row_checks)
    columns = leading(partition_by, cluster_by)
    if ranged:
        replace_table(df.select(*types).sortWithinPartitions(*columns), path, layout=layout, types=types)
    else:
        replace_table(df.select(*types), path, columns, [key], layout, types)


def merge_into(batch: DataFrame, table: str, key: str) -> None:
    """The same merge as one statement, for catalogs whose tables support row-level changes.

    Not tested: no such catalog comes with Spark itself.
    """
    (
        batch.alias("s")
        .mergeInto(table, F.expr(f"{table}.`{key}` = s.`{key}`"))
        .whenMatched()
        .updateAll()
        .whenNotMatched()
        .insertAll()
        .merge()
    )


def leading(partition_by: str, cluster_by: Sequence[str]) -> list[str]:
    return [partition_by, *[c for c in cluster_by if c != partition_by]]
