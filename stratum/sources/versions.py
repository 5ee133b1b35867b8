"""Tables as versions: complete new files first, then one pointer that makes them count.

``<path>/version=<name>/`` holds what one commit wrote, partitioned if the table is; nothing in it is ever changed.
``<path>/_log`` is the pointer: a commit appends one small file to it, with a row for each partition it wrote or
emptied. A partition's current rows are those of the last commit that names it; a ``whole`` commit also ends all
partitions before it. So readers see the table before a commit or after it, never in between, and a run that dies
leaves folders that nothing points to. Reading prunes by the partition column as for any partitioned parquet.

The log also keeps, per partition, its number of rows, the least and the largest key, the newest load time, and the
failures of the row checks that the writer asked for. They are observed by the write itself, or, where a table is
partitioned, counted from the files it has just written; so later questions about the whole table open none of them.

Two commits on one predecessor: the one whose log file is older stands, the other raises ``ConcurrentCommit``.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from stratum import schemas
from stratum.sources import files
from stratum.sources.readers import read_appended
from stratum.sources.scratch import shuffles_dropped

_LOG_TYPES = {
    "seq": "bigint",
    "version": "string",
    "whole": "boolean",
    "partition_by": "string",
    "part": "string",
    "n_rows": "bigint",
    "low_key": "string",
    "high_key": "string",
    "newest": "timestamp_ntz",
    "failures": "map<string,bigint>",
    "source": "string",
}


_FAILURES = "failures_of_"


class ConcurrentCommit(RuntimeError):
    """Another writer committed first; nothing of this commit counts, and it can be run again."""


@dataclass(frozen=True)
class Part:
    """What the log knows of one partition (``part`` is its value as text) of the current table."""

    version: str
    part: str | None
    n_rows: int
    low_key: str | None
    high_key: str | None
    newest: dt.datetime | None
    failures: dict[str, int]
    source: str | None


@dataclass(frozen=True)
class Snapshot:
    path: str
    seq: int
    partition_by: str | None
    parts: list[Part]
    #: For each version how many partitions it wrote; those of them that are not among the parts are out of date.
    written: Mapping[str, int]

    @property
    def n_rows(self) -> int:
        return sum(p.n_rows for p in self.parts)

    @property
    def newest(self) -> dt.datetime | None:
        return max((p.newest for p in self.parts if p.newest is not None), default=None)

    def failures(self, name: str) -> int | None:
        """Rows of the table that fail a check counted by its writers; None if some part was written without it."""
        if any(name not in p.failures for p in self.parts):
            return None
        return sum(p.failures[name] for p in self.parts)

    def may_hold(self, low: str | None, high: str | None) -> list[Part]:
        """The partitions whose keys lie around the given ones; the files of all others need not be opened."""
        if low is None or high is None:
            return list(self.parts)
        return [p for p in self.parts if p.low_key is None or p.low_key <= high and low <= p.high_key]


@dataclass(frozen=True)
class Layout:
    """How a table is written, and what the log keeps of each partition."""

    partition_by: str | None = None
    key: str | None = None
    load_time: str | None = None
    #: Row checks by name: true where a row fails.
    row_checks: Mapping[str, Column] | None = None
    #: Bloom filters of the key in every file, for batches of few keys.
    bloom_rows: int = 1_000_000
    #: What each partition was made from, by partition; kept with it for the writer to compare.
    sources: Mapping[str | None, str] | None = None


def _read_log(spark: SparkSession, path: str) -> list:
    rows = read_appended(spark, f"{path}/_log", _LOG_TYPES)
    if rows is None:
        return []
    return rows.select("*", F.col("_metadata.file_modification_time").alias("written")).collect()


def current(spark: SparkSession, path: str) -> Snapshot | None:
    """The table as its last commit left it, or None when there is none. The log has a row per commit and partition."""
    rows = _read_log(spark, path)
    return _snapshot(path, rows) if rows else None


def _snapshot(path: str, rows: list) -> Snapshot:
    winner = _winners(rows)
    rows = sorted((r for r in rows if winner[r.seq] == r.version), key=lambda r: r.seq)
    parts: dict[str | None, Part] = {}
    for row in rows:
        if row.whole:
            parts = {k: p for k, p in parts.items() if p.version == row.version}
        parts[row.part] = Part(
            row.version, row.part, row.n_rows, row.low_key, row.high_key, row.newest, row.failures or {}, row.source
        )
    written: dict[str, int] = {}
    for row in rows:
        written[row.version] = written.get(row.version, 0) + (row.n_rows > 0)
    return Snapshot(path, max(winner), rows[-1].partition_by, [p for p in parts.values() if p.n_rows], written)


def _winners(rows: Iterable) -> dict[int, str]:
    first: dict[int, tuple] = {}
    for row in rows:
        first[row.seq] = min(first.get(row.seq, (row.written, row.version)), (row.written, row.version))
    return {seq: version for seq, (_, version) in first.items()}


def exists(spark: SparkSession, path: str) -> bool:
    return bool(_read_log(spark, path))


def read(
    spark: SparkSession,
    path: str,
    types: dict[str, str] | None = None,
    snapshot: Snapshot | None = None,
    parts: Sequence[Part] | None = None,
) -> DataFrame:
    """The table, current or of a snapshot, or the given partitions of it.

    Without ``types`` the columns are those of its files.
    """
    snapshot = snapshot or current(spark, path)
    if snapshot is None:
        raise FileNotFoundError(f"no table at {path}")
    parts = snapshot.parts if parts is None else parts
    if not parts:
        if types is None:
            raise ValueError(f"{path} holds no rows, so its columns have to be given")
        return spark.createDataFrame([], schemas.struct(types))
    reader = spark.read
    if types is not None:
        reader = reader.schema(schemas.struct(types | {"version": "string"}))
    versions = sorted({p.version for p in parts})
    rows = reader.option("basePath", path).parquet(*[f"{path}/version={v}" for v in versions])
    live = _live(rows, parts, snapshot)
    return rows.filter(live).select(*(types or [c for c in rows.columns if c != "version"]))


def _live(rows: DataFrame, parts: Sequence[Part], snapshot: Snapshot) -> Column:
    """The partitions of each version that count, as a condition on partition columns alone."""
    tests, partition_by = [], snapshot.partition_by
    for version in sorted({p.version for p in parts}):
        own = F.col("version") == version
        values = [p.part for p in parts if p.version == version]
        if partition_by is not None and len(values) < snapshot.written[version]:
            kind = rows.schema[partition_by].dataType
            named = F.col(partition_by).isin(*[F.lit(v).cast(kind) for v in values if v is not None])
            own &= (named | F.col(partition_by).isNull()) if None in values else named
        tests.append(own)
    return reduce(lambda a, b: a | b, tests)


def commit(
    spark: SparkSession,
    df: DataFrame,
    path: str,
    layout: Layout,
    types: dict[str, str] | None = None,
    base: Snapshot | None = None,
    replaces: Iterable[str | None] | None = None,
) -> Snapshot:
    """Write rows as a new version and point to it.

    ``replaces`` are the partitions of ``base`` that the rows stand for, next to those they fall into; None replaces
    the whole table. Returns the new snapshot.
    """
    version, seq = uuid.uuid4().hex, (base.seq if base else 0) + 1
    folder = f"{path}/version={version}"
    measures = _measures(df, layout)
    watched, observed = df, None
    if layout.partition_by is None:
        observed = Observation()
        watched = df.observe(observed, *measures)
    writer = watched.write.option("compression", "zstd")
    if layout.partition_by is not None:
        writer = writer.partitionBy(layout.partition_by)
    if layout.key is not None:
        writer = writer.option(f"parquet.bloom.filter.enabled#{layout.key}", "true").option(
            f"parquet.bloom.filter.expected.ndv#{layout.key}", str(layout.bloom_rows)
        )
    with shuffles_dropped(spark):
        writer.parquet(folder)

    if observed is not None:
        found = [observed.get | {"part": None}]
    else:
        written = spark.read.schema(schemas.struct(types) if types else df.schema).parquet(folder)
        part = F.col(layout.partition_by).cast("string").alias("part")
        found = [r.asDict() for r in written.groupBy(part).agg(*measures).collect()]
    failures = lambda r: {name: r[_FAILURES + name] for name in layout.row_checks or ()}
    rows = [
        (seq, version, replaces is None, layout.partition_by, r["part"], r["n_rows"], r["low_key"], r["high_key"], r["newest"],
         failures(r), (layout.sources or {}).get(r["part"]))
        for r in found
    ]
    emptied = set(replaces or ()) - {r["part"] for r in found}
    rows += [(seq, version, False, layout.partition_by, part, 0, None, None, None, {}, None) for part in emptied]
    if not rows:  # a partitioned table without any row
        rows = [(seq, version, replaces is None, layout.partition_by, None, 0, None, None, None, {}, None)]
    _log_entry(spark, rows).write.mode("append").parquet(f"{path}/_log")
    rows = _read_log(spark, path)
    if _winners(rows)[seq] != version:
        raise ConcurrentCommit(f"another writer has committed to {path}")
    return _snapshot(path, rows)


def _log_entry(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """One file, so that it appears as a whole."""
    return spark.createDataFrame(rows, schemas.struct(_LOG_TYPES)).coalesce(1)


def _measures(df: DataFrame, layout: Layout) -> list[Column]:
    """What the log keeps of a partition; no bounds of keys that are no text, and no time of what is no timestamp."""
    key = layout.key if layout.key and df.schema[layout.key].dataType.simpleString() == "string" else None
    timed = layout.load_time and df.schema[layout.load_time].dataType.simpleString().startswith("timestamp")
    newest = F.max(layout.load_time) if timed else F.max(F.lit(None).cast("timestamp_ntz"))
    return [
        F.count(F.lit(1)).alias("n_rows"),
        (F.min(key) if key else F.max(F.lit(None).cast("string"))).alias("low_key"),
        (F.max(key) if key else F.max(F.lit(None).cast("string"))).alias("high_key"),
        newest.cast("timestamp_ntz").alias("newest"),
        *[F.count_if(fails).alias(_FAILURES + name) for name, fails in (layout.row_checks or {}).items()],
    ]


def expire(spark: SparkSession, path: str) -> int:
    """Delete the folders that the current table doesn't read; returns their number.

    Not while others read an earlier version, or are writing one that nothing points to yet.
    """
    snapshot = current(spark, path)
    live = {f"version={p.version}" for p in snapshot.parts} if snapshot else set()
    dead = [f for f in files.children(spark, path) if f.startswith("version=") and f not in live]
    for folder in dead:
        files.delete(spark, f"{path}/{folder}")
    return len(dead)
