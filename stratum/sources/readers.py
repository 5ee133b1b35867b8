"""Raw feeds: tables, seed CSV files and landed JSON files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum import schemas
from stratum.sources import files
from stratum.sources.scratch import materialize

_BAD_LINE = "_bad_line"


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def read_appended(spark: SparkSession, path: str, types: dict[str, str]) -> DataFrame | None:
    """A folder that grows by appended files, or None before the first one."""
    return read_parquet(spark, path, types) if files.exists(spark, path) else None


def read_parquet(spark: SparkSession, path: str, types: dict[str, str]) -> DataFrame:
    """Parquet with a declared schema, so no file is opened while planning."""
    return spark.read.schema(schemas.struct(types)).parquet(path).select(*types)


def read_csv_seed(spark: SparkSession, path: str, types: dict[str, str]) -> DataFrame:
    """CSV with a header row; every column stays text (typed in bronze), an empty field is NULL.

    The header must list the columns in the declared order, otherwise reading fails.
    """
    return (
        spark.read.schema(schemas.text_struct(types))
        .option("header", True)
        .option("enforceSchema", False)
        .option("escape", '"')
        .option("mode", "FAILFAST")
        .csv(path)
    )


def split_json_landing(
    spark: SparkSession, path: str, types: dict[str, str], lineage: str = "_source_file"
) -> tuple[DataFrame, DataFrame]:
    """Landed JSON lines as ``read_json_landing`` reads them, and (``lineage``, ``line``) of those that are no records.

    Every line that is not blank is in one of the two. They are stored once, since both are read from the same pass.
    """
    text = schemas.text_struct({k: v for k, v in types.items() if k != lineage} | {_BAD_LINE: "string"})
    rows = (
        spark.read.schema(text)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", _BAD_LINE)
        .json(path)
        .withColumn(lineage, F.col("_metadata.file_name"))
    )
    stored = materialize(rows, "landed-json")
    bad = stored.filter(F.col(_BAD_LINE).isNotNull()).select(lineage, F.col(_BAD_LINE).alias("line"))
    return stored.filter(F.col(_BAD_LINE).isNull()).select(*types), bad


def read_json_landing(
    spark: SparkSession, path: str, types: dict[str, str], lineage: str | None = "_source_file"
) -> DataFrame:
    """One JSON object per line as text columns; ``lineage`` names the column that gets the file name."""
    df = (
        spark.read.schema(schemas.text_struct({k: v for k, v in types.items() if k != lineage}))
        .option("mode", "FAILFAST")
        .json(path)
    )
    if lineage in types:
        df = df.withColumn(lineage, F.col("_metadata.file_name"))
    return df.select(*types)
