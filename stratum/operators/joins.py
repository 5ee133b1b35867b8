"""Left joins of a large fact table to a dimension."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.sources.scratch import materialize

# A dimension is sent whole to every executor only when measured below both limits.
BROADCAST_ROWS = 2_000_000
BROADCAST_BYTES = 256 * 1024 * 1024

# A key is cut over several tasks once it has more fact rows than one task should join.
ROWS_PER_TASK = 2_000_000

# So many frequent keys are broadcast at most.
MOST_FREQUENT_KEYS = 1_000_000

_FIXED_WIDTH = 16


def fits_broadcast(
    df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES
) -> bool:
    """Measure rows and bytes of a DataFrame in one aggregate (no rows leave the executors)."""
    texts = [f.name for f in df.schema.fields if f.dataType.simpleString() == "string"]
    fixed = _FIXED_WIDTH * len(df.columns)
    width = F.lit(fixed).cast("long")
    for name in texts:
        width = width + F.coalesce(F.octet_length(name), F.lit(0))
    rows, size = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(width), F.lit(0))).first()
    return rows <= max_rows and size <= max_bytes


def left_join(
    facts: DataFrame,
    dimension: DataFrame,
    key: str,
    spread_by: str | Sequence[str],
    broadcast: bool | None = None,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """``facts LEFT JOIN dimension USING (key)``, safe against very frequent keys.

    A dimension measured as small is broadcast, so the facts are not shuffled at all. Otherwise both sides
    are shuffled, and the fact rows of each key with more than ``rows_per_task`` rows are dealt over several
    salts by a hash of ``spread_by``, while only that key's dimension rows are repeated once per salt. The
    list of such keys is stored and broadcast; where it would be longer than ``MOST_FREQUENT_KEYS``, only the
    more frequent ones are dealt out. Rows without a key are dealt out the same way.
    """
    if broadcast is None:
        broadcast = fits_broadcast(dimension)
    if broadcast:
        return facts.join(F.broadcast(dimension), key, "left")
    return salted_left_join(facts, dimension, key, spread_by, rows_per_task)


def frequent_keys(facts: DataFrame, key: str, rows_per_task: int) -> DataFrame:
    """(``_hot``, ``_salts``) for each key, NULL included, with more rows than one task should take."""
    return (
        facts.groupBy(F.col(key).alias("_hot"))
        .agg(F.count(F.lit(1)).alias("_rows"))
        .filter(F.col("_rows") > rows_per_task)
        .select("_hot", F.ceil(F.col("_rows") / rows_per_task).cast("int").alias("_salts"))
    )


def _bounded(hot: DataFrame) -> DataFrame:
    """The most frequent of the keys, as far as they may be broadcast."""
    least = 1
    while hot.count() > MOST_FREQUENT_KEYS:
        least *= 2
        hot = hot.filter(F.col("_salts") > least)
    return hot


def salted_left_join(
    facts: DataFrame,
    dimension: DataFrame,
    key: str,
    spread_by: str | Sequence[str],
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    spread = [spread_by] if isinstance(spread_by, str) else list(spread_by)
    hot = F.broadcast(_bounded(materialize(frequent_keys(facts, key, rows_per_task), "frequent-keys")))
    dealt = (
        facts.join(hot, F.col(key).eqNullSafe(F.col("_hot")), "left")
        .withColumn("_salt", F.pmod(F.xxhash64(*spread), F.coalesce("_salts", F.lit(1))).cast("int"))
        .drop("_hot", "_salts")
    )
    repeated = (
        dimension.filter(F.col(key).isNotNull())
        .join(hot, F.col(key).eqNullSafe(F.col("_hot")), "left")
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)))
        .drop("_hot", "_salts")
    )
    return dealt.join(repeated, [key, "_salt"], "left").drop("_salt")
