"""Data checks. Each check is a query for the failing rows; a suite counts them for a whole table."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratum import functions as fx
from stratum.sources.scratch import shuffles_dropped

# Default thresholds of the freshness and completeness checks.
NOT_NULL_SHARE = 0.99
MAX_HOURS = 25
WARN_AFTER_HOURS = 6
ERROR_AFTER_HOURS = 24


@dataclass(frozen=True)
class Check:
    """One declared check of one column; an ``error`` blocks the pipeline, a ``warn`` is only reported."""

    column: str
    kind: str
    values: tuple = ()
    minimum: float | None = None
    maximum: float | None = None
    to: str | None = None
    severity: str = "error"

    @property
    def name(self) -> str:
        return f"{self.kind}_{self.column}"


def not_null(column: str) -> Check:
    return Check(column, "not_null")


def unique(column: str) -> Check:
    return Check(column, "unique")


def accepted_values(column: str, *values) -> Check:
    return Check(column, "accepted_values", values=values)


def accepted_range(column: str, minimum=None, maximum=None) -> Check:
    return Check(column, "accepted_range", minimum=minimum, maximum=maximum)


def relationships(column: str, to: str) -> Check:
    """Every non-NULL value must occur in the column of the same name of model ``to``."""
    return Check(column, "relationships", to=to)


def not_null_share(column: str, share: float = NOT_NULL_SHARE) -> Check:
    """At least that share of the rows has a value; an empty table passes."""
    return Check(column, "not_null_share", minimum=share)


def fresh(column: str, max_hours: float = MAX_HOURS) -> Check:
    """The newest value is at most so many hours old; a table without any fails."""
    return Check(column, "fresh", maximum=max_hours)


# --- failing rows of one check ------------------------------------------------------------


def null_rows(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def unaccepted_rows(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Rows with a value outside the list; NULL passes."""
    return df.filter(~F.col(column).isin(*values))


def out_of_range_rows(df: DataFrame, column: str, minimum=None, maximum=None) -> DataFrame:
    """Rows below the minimum or above the maximum; both bounds are allowed values and NULL passes."""
    return df.filter(_out_of_range(column, minimum, maximum))


def duplicate_keys(df: DataFrame, column: str) -> DataFrame:
    """Non-NULL values that occur more than once, with their number of rows."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n_records"))
        .filter("n_records > 1")
    )


def proven_unique(df: DataFrame, column: str) -> bool:
    """Whether no non-NULL value occurs more than once.

    Hashes are counted, which move in few bytes; values of one hash that may differ are counted themselves.
    """
    hashed = df.filter(F.col(column).isNotNull()).select(F.xxhash64(column).alias("_hash"))
    with shuffles_dropped(df.sparkSession):
        return duplicate_keys(hashed, "_hash").isEmpty() or duplicate_keys(df, column).isEmpty()


def orphan_keys(child: DataFrame, parent: DataFrame, column: str) -> DataFrame:
    """Non-NULL child values without a parent, with their number of child rows.

    The child rows are counted per value before the join, so a frequent value is joined once.
    """
    counted = (
        child.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n_records"))
    )
    return counted.join(parent.select(column), column, "left_anti")


def null_share_above(df: DataFrame, column: str, threshold: float = NOT_NULL_SHARE) -> DataFrame:
    """One row ``null_pct`` when the share of NULLs exceeds 1 - threshold; an empty table passes."""
    share = fx.safe_divide(F.count_if(F.col(column).isNull()), F.count(F.lit(1)))
    return df.agg(share.alias("null_pct")).filter(F.col("null_pct") > 1 - threshold)


def stale(
    df: DataFrame, column: str, max_hours: int = MAX_HOURS, now: Column | dt.datetime | str | None = None
) -> DataFrame:
    """One row ``hours_stale`` when the newest value is more than ``max_hours`` hours old."""
    age = fx.hours_between(F.max(column), fx.as_timestamp(now))
    return df.agg(age.alias("hours_stale")).filter(F.col("hours_stale") > max_hours)


def source_freshness(
    df: DataFrame,
    source: str,
    column: str = "_loaded_at",
    now: Column | dt.datetime | str | None = None,
    warn_after_hours: float = WARN_AFTER_HOURS,
    error_after_hours: float = ERROR_AFTER_HOURS,
) -> DataFrame:
    """One row per source: newest load, its age in seconds, and pass, warn or error.

    An age of exactly the limit still passes it. A source without any load time is an error.
    """
    newest = df.agg(F.max(column).cast("timestamp_ntz").alias("max_loaded_at"))
    seconds = F.expr("timestampdiff(SECOND, max_loaded_at, _now)")
    age = F.col("age_seconds")
    return (
        newest.withColumn("_now", fx.as_timestamp(now))
        .select(F.lit(source).alias("source"), "max_loaded_at", seconds.alias("age_seconds"))
        .withColumn(
            "status",
            F.when(age.isNull() | (age > error_after_hours * 3600), "error")
            .when(age > warn_after_hours * 3600, "warn")
            .otherwise("pass"),
        )
    )


def row_counts_not_grown(current: DataFrame, previous: DataFrame) -> DataFrame:
    """Models (model, n_rows) that did not grow since the previous counts; a new model passes."""
    before = previous.select("model", F.col("n_rows").alias("previous_rows"))
    return (
        current.join(before, "model")
        .select("model", F.col("n_rows").alias("current_rows"), "previous_rows")
        .filter("current_rows <= previous_rows")
    )


def _out_of_range(column: str, minimum, maximum) -> Column:
    tests = []
    if minimum is not None:
        tests.append(F.col(column) < minimum)
    if maximum is not None:
        tests.append(F.col(column) > maximum)
    return reduce(lambda a, b: a | b, tests)


# --- suites -------------------------------------------------------------------------------

_ROW_KINDS = ("not_null", "accepted_values", "accepted_range")
_TABLE_KINDS = ("not_null_share", "fresh")


def _table_fails(check: Check, now: Column | dt.datetime | str | None) -> Column:
    """1 where the whole table fails."""
    if check.kind == "not_null_share":
        share = fx.safe_divide(F.count_if(F.col(check.column).isNull()), F.count(F.lit(1)))
        return F.coalesce(share > 1 - check.minimum, F.lit(False)).cast("long")
    age = fx.hours_between(F.max(check.column), fx.as_timestamp(now))
    return F.coalesce(age > check.maximum, F.lit(True)).cast("long")


def _row_fails(check: Check) -> Column:
    column = F.col(check.column)
    if check.kind == "not_null":
        return column.isNull()
    if check.kind == "accepted_values":
        return ~column.isin(*check.values)
    return _out_of_range(check.column, check.minimum, check.maximum)


def row_checks(checks: Sequence[Check]) -> dict[str, Column]:
    """The checks of single rows by name, each true where a row fails it: to be counted while a table is written."""
    return {c.name: _row_fails(c) for c in checks if c.kind in _ROW_KINDS}


def run_suite(
    df: DataFrame,
    model: str,
    checks: Sequence[Check],
    parents: Mapping[str, DataFrame] | None = None,
    counted: Callable[[str], int | None] | None = None,
    now: Column | dt.datetime | str | None = None,
) -> DataFrame:
    """(model, column_name, check_type, severity, failures) for every check of one table.

    All checks of single rows, and of the share of NULLs and the age of the table (one failure at most, ``now`` given
    or the current time), share one scan and one aggregate. Uniqueness and relationships take one grouped count each. ``counted`` gives the failures of row checks by name (as ``row_checks`` has them) that were
    counted when the table was written, None where they were not; these need no scan.
    """
    results = []
    known = [(c, counted(c.name) if counted else None) for c in checks if c.kind in _ROW_KINDS]
    written = [_result(model, c, F.lit(n)) for c, n in known if n is not None]
    if written:
        results.append(df.sparkSession.range(1).select(F.inline(F.array(*written))))
    unknown = [c for c, n in known if n is None] + [c for c in checks if c.kind in _TABLE_KINDS]
    if unknown:
        fails = [_table_fails(c, now) if c.kind in _TABLE_KINDS else F.count_if(_row_fails(c)) for c in unknown]
        counted = df.agg(*[f.alias(f"failures_{i}") for i, f in enumerate(fails)])
        rows = [_result(model, c, F.col(f"failures_{i}")) for i, c in enumerate(unknown)]
        results.append(counted.select(F.inline(F.array(*rows))))
    for check in checks:
        if check.kind == "unique":
            counted = duplicate_keys(df, check.column).agg(F.count(F.lit(1)).alias("n"))
        elif check.kind == "relationships":
            orphans = orphan_keys(df, parents[check.to], check.column)
            counted = orphans.agg(F.coalesce(F.sum("n_records"), F.lit(0)).alias("n"))
        else:
            continue
        results.append(counted.select(F.inline(F.array(_result(model, check, F.col("n"))))))
    return reduce(DataFrame.unionByName, results)


def _result(model: str, check: Check, failures: Column) -> Column:
    return F.struct(
        F.lit(model).alias("model"),
        F.lit(check.column).alias("column_name"),
        F.lit(check.kind).alias("check_type"),
        F.lit(check.severity).alias("severity"),
        failures.cast("long").alias("failures"),
    )
