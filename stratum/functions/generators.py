"""Date spines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.functions.expressions import as_date

_STEPS = {"day": (1, "D"), "week": (7, "D"), "month": (1, "M"), "quarter": (3, "M"), "year": (12, "M")}


def spine_dates(start, end, datepart: str = "day", max_steps: int | None = None) -> Column:
    """Array of dates start, start + 1 part, ... up to and including end.

    Every date is counted from the start, so month steps from the 31st fall on each month's last day.
    An end before the start gives an empty array. ``max_steps`` cuts the spine; by default it has them all.
    """
    size, unit = _STEPS[datepart]
    first, last = as_date(start), as_date(end)
    if unit == "D":
        available = F.floor(F.datediff(last, first) / size)
    else:
        months = (F.year(last) - F.year(first)) * 12 + F.month(last) - F.month(first)
        available = F.floor(months / size)
    steps = (available if max_steps is None else F.least(available, F.lit(max_steps - 1))).cast("int")
    numbers = F.when(steps >= 0, F.sequence(F.lit(0), steps)).otherwise(F.array().cast("array<int>"))
    if unit == "D":
        dates = F.transform(numbers, lambda i: F.date_add(first, (i * size).cast("int")))
    else:
        dates = F.transform(numbers, lambda i: F.add_months(first, (i * size).cast("int")))
    return F.filter(dates, lambda d: d <= last)


def date_spine(
    spark: SparkSession, start, end, datepart: str = "day", max_steps: int | None = None
) -> DataFrame:
    """One row ``date_day`` per step from start to end, both included."""
    return spark.range(1).select(F.explode(spine_dates(start, end, datepart, max_steps)).alias("date_day"))
