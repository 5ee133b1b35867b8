"""The bronze, silver and gold layers as folders, views and databases."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.sources import versions
from stratum.sources.scratch import materialize

# Fixed value: the layers, in build order.
LAYERS = ("bronze", "silver", "gold")


def create_view(df: DataFrame, name: str) -> DataFrame:
    """Publish a model as a view: nothing is stored, its expressions fuse into whatever reads it."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def create_catalog_view(
    spark: SparkSession,
    layer: str,
    model: str,
    expressions: Sequence[str],
    source: str,
    database_prefix: str = "",
) -> str:
    """Create or replace the view ``<layer>.<model>`` over a table, in the layer's database."""
    database = f"`{database_prefix}{layer}`"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    name = f"{database}.`{model}`"
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT {', '.join(expressions)} FROM {source}")
    return name


def cluster(df: DataFrame, cluster_by: Sequence[str], spread_by: Sequence[str] = ()) -> DataFrame:
    """Range-partition and sort by the clustering columns, so file statistics prune reads of them.

    ``spread_by`` extends the range key, so that one very frequent combination of the clustering columns
    is cut over many tasks instead of landing in one.
    """
    return df.repartitionByRange(*cluster_by, *spread_by).sortWithinPartitions(*cluster_by)


#: Ranges that each column is cut into before they are interleaved, and rows drawn to find where they begin.
MOST_RANGES = 64
_SAMPLE_ROWS = 10_000


def range_starts(df: DataFrame, columns: Sequence[str], most: int = MOST_RANGES) -> dict[str, list]:
    """For each column the values at which its ranges 1, 2, ... begin: those that cut a sample into even ones.

    Rows are drawn by a hash of their values, so equal tables are cut alike. A sample only shapes the layout.
    """
    total = df.count()
    lot = F.pmod(F.xxhash64(*columns, F.monotonically_increasing_id()), F.lit(1 << 30))
    drawn = df.filter(lot < F.lit((1 << 30) * min(_SAMPLE_ROWS, total) // max(total, 1) + 1)).select(*columns)
    found = {c: sorted(v for v in values if v is not None and v == v) for c, values in drawn.toPandas().items()}
    return {c: sorted({values[len(values) * i // most] for i in range(1, most)} - {values[0]}) if values else [] for c, values in found.items()}


def _range_number(value: Column, starts: Sequence[Column], first: int = 0) -> Column:
    """How many of the ascending starts are at or below the value, found by halving them; ``first`` for NULL."""
    if not starts:
        return F.lit(first)
    half = len(starts) // 2
    upper = _range_number(value, starts[half + 1 :], first + half + 1)
    return F.when(value >= starts[half], upper).otherwise(_range_number(value, starts[:half], first))


def cluster_interleaved(df: DataFrame, columns: Sequence[str], spread_by: Sequence[str] = ()) -> DataFrame:
    """Range-partition and sort by the interleaved ranges of the columns, so a filter on any one of them skips files.

    A row's ranges are numbered, and their bits put in turn, the highest first: rows that are near in that number are
    near in every column. ``cluster`` serves filters on its first column best; here each column gets its share.
    The rows are stored first, as they are read to be counted, for the sample, and twice to be laid out.
    """
    df = materialize(df, "to-interleave")
    kinds, starts = dict(df.dtypes), range_starts(df, columns)
    numbers = {
        f"_range_{i}": _range_number(F.col(c), [F.lit(v).cast(kinds[c]) for v in starts[c]]) for i, c in enumerate(columns)
    }
    bits = [len(starts[c]).bit_length() for c in columns]
    key = F.lit(0)
    for depth in range(max(bits, default=0)):
        for number, width in zip(numbers, bits):
            if depth < width:
                key = key * 2 + F.shiftright(F.col(number), width - 1 - depth).bitwiseAND(F.lit(1))
    laid = df.withColumns(numbers).withColumn("_ranges", key).drop(*numbers)
    return laid.repartitionByRange("_ranges", *spread_by).sortWithinPartitions("_ranges", *columns).drop("_ranges")


def write_bucketed(df: DataFrame, path: str, key: str, buckets: int) -> DataFrame:
    """Store a table in buckets of a key: joins and aggregates on the key of tables with equal buckets shuffle neither.

    Returns the stored table. Rows without a key share a bucket, and so do those of one key: for keys that hold a large
    share of a table ``operators.joins.left_join`` is the one to take. The catalog entry that the writer makes is
    dropped again, the files stay at ``path``.
    """
    spark = df.sparkSession
    name = f"bucketed_{uuid.uuid4().hex}"
    shuffled = df.repartition(buckets, key)  # so that each bucket is one file
    shuffled.write.bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(name)
    stored = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return stored


@dataclass(frozen=True)
class LayerStore:
    """Tables of the layered model as versioned parquet folders ``<root>/<layer>/<model>``."""

    spark: SparkSession
    root: str

    def path(self, layer: str, model: str) -> str:
        return f"{self.root.rstrip('/')}/{layer}/{model}"

    def exists(self, layer: str, model: str) -> bool:
        return versions.exists(self.spark, self.path(layer, model))

    def snapshot(self, layer: str, model: str) -> versions.Snapshot | None:
        return versions.current(self.spark, self.path(layer, model))

    def read(self, layer: str, model: str, types: dict[str, str] | None = None) -> DataFrame:
        return versions.read(self.spark, self.path(layer, model), types)

    def replace(
        self,
        df: DataFrame,
        layer: str,
        model: str,
        cluster_by: Sequence[str] = (),
        spread_by: Sequence[str] = (),
        row_checks: Mapping[str, Column] | None = None,
    ) -> DataFrame:
        """Full refresh. The new table is complete before one pointer makes it the current one."""
        path = self.path(layer, model)
        replace_table(df, path, cluster_by, spread_by, versions.Layout(row_checks=row_checks))
        types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
        return versions.read(self.spark, path, types)

    def publish(self, layer: str, model: str, database_prefix: str = "") -> str:
        """Make the stored table, as it is now, queryable as ``<layer>.<model>`` in the session catalog; returns that
        name. Publish again after a refresh."""
        path = self.path(layer, model)
        snapshot = versions.current(self.spark, path)
        parts, partition_by = snapshot.parts, snapshot.partition_by
        columns = versions.read(self.spark, path, snapshot=snapshot).columns
        selects = []
        for version in sorted({p.version for p in parts}):
            source = f"SELECT {', '.join(columns)} FROM parquet.`{path}/version={version}`"
            if partition_by is not None:
                values = [p.part for p in parts if p.version == version]
                listed = ", ".join("'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'" for v in values if v is not None)
                tests = [f"cast({partition_by} as string) IN ({listed})"] if listed else []
                tests += [f"{partition_by} IS NULL"] if None in values else []
                source += f" WHERE {' OR '.join(tests)}"
            selects.append(source)
        return create_catalog_view(self.spark, layer, model, columns, f"({' UNION ALL '.join(selects)})", database_prefix)


def replace_table(
    df: DataFrame,
    path: str,
    cluster_by: Sequence[str] = (),
    spread_by: Sequence[str] = (),
    layout: versions.Layout | None = None,
    types: dict[str, str] | None = None,
) -> versions.Snapshot:
    """Write a whole new version of the table. A failed job leaves the old one as it was."""
    spark = df.sparkSession
    if cluster_by:
        df = cluster(df, cluster_by, spread_by)
    return versions.commit(spark, df, path, layout or versions.Layout(), types, versions.current(spark, path))
