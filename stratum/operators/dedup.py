"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """The first row of each key in the given order.

    Spark keeps only the first row per key within each task before the shuffle (WindowGroupLimit), so a key
    with very many rows reaches its reducer as one row per task.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_position", F.row_number().over(window)).filter("_position = 1").drop("_position")
