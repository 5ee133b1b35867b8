"""Landed order files into silver, each file once.

The same enrichment and merge as the daily run. Which files are new is tracked by the stream's checkpoint
instead of the high-water mark, so a late file is not missed; its rows replace only rows that are not newer. A batch that is run again after a failure
merges to the same table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from stratum import schemas
from stratum.operators import checks, upsert
from stratum.plans import bronze, silver
from stratum.plans.check_catalog import checks_for
from stratum.plans.pipeline import SILVER, PipelineConfig
from stratum.sources.layers import LayerStore
from stratum.sources.scratch import dropped_after


def read_landed_orders(spark: SparkSession, landing: str, max_files: int = 1000) -> DataFrame:
    """Stream of raw order rows (text columns) with the name of the file each came from."""
    types = {k: v for k, v in schemas.ORDER_TYPES.items() if k != "_source_file"}
    return (
        spark.readStream.schema(schemas.text_struct(types))
        .option("maxFilesPerTrigger", max_files)
        .option("mode", "FAILFAST")
        .json(landing)
        .withColumn("_source_file", F.col("_metadata.file_name"))
    )


def merge_landed_orders(
    landed: DataFrame,
    customers: DataFrame,
    store: LayerStore,
    checkpoint: str,
    config: PipelineConfig | None = None,
) -> StreamingQuery:
    """Start a query that merges all files landed so far into silver, then stops."""
    config = config or PipelineConfig()
    layout = (schemas.SILVER_TYPES, silver.KEY, config.partition_by, silver.CLUSTER_BY)
    path = store.path("silver", SILVER)

    def merge(rows: DataFrame, batch_id: int) -> None:
        with dropped_after(rows.sparkSession):
            batch = silver.int_orders_enriched(bronze.stg_orders(rows), customers, config.now)
            checked = checks.row_checks(checks_for(SILVER))
            upsert.upsert(
                rows.sparkSession, batch, path, *layout, on_duplicate=config.on_duplicate, row_checks=checked
            )

    return (
        landed.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
