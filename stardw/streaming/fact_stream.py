"""The incremental fact load as a stream of staged order lines."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from stardw.plans import meta, pipeline
from stardw.schemas import DDL
from stardw.session import counted_cut, passing_scratch
from stardw.sources.snapshots import Overtaken, Warehouse


def read_lines(spark: SparkSession, folder: str, files_per_batch: int = 1000) -> DataFrame:
    """A stream over the parquet files that arrive in ``folder``."""
    return (spark.readStream.schema(DDL["lignes_commande"])
            .option("maxFilesPerTrigger", files_per_batch).parquet(folder))


def stream_id(warehouse: Warehouse, checkpoint: str) -> str:
    """The name that a stream keeps as long as its checkpoint."""
    return json.loads(warehouse._read_text(f"{checkpoint}/metadata"))["id"]


def load_batch(warehouse: Warehouse, log: meta.RunLog, lines: DataFrame, n: int,
               batch: tuple[str, int], table: str) -> bool:
    """Publish the ``n`` lines of a batch, once; False if they have been published.

    A load that publishes meanwhile makes it start again from what that one published.
    """
    while True:
        base, published = warehouse.snapshot()
        if warehouse.holds(batch):
            return False
        made = pipeline.load_fact(warehouse, log, lines, published, table, n=n,
                                  published=published)
        try:
            return warehouse.commit(made, base, batch)
        except Overtaken:
            warehouse.discard(made)


def load_available(lines: DataFrame, warehouse: Warehouse, checkpoint: str,
                   table: str = meta.FACT_JOB) -> StreamingQuery:
    """Load what has arrived, batch by batch, then stop.

    The checkpoint keeps track of the files read, and the manifest of the batches published, so a
    batch that runs again after a failure adds nothing. A line that comes again in a later batch
    replaces the earlier one. Keys come from the published dimensions.
    """
    log = meta.RunLog(warehouse)

    def load(batch: DataFrame, number: int) -> None:
        with passing_scratch(warehouse.spark):
            arrived, n = counted_cut(batch, "lot")
            if n:
                load_batch(warehouse, log, arrived, n, (stream_id(warehouse, checkpoint), number),
                           table)

    return (lines.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())
