"""Annual and running totals kept up to date as consolidated-table files arrive.

The batch products are recomputed from the whole table each run. When new years (or
corrected files) land in the gold folder, the same A1 aggregate can instead be kept as
streaming state: a file-source stream over the Parquet folder, a grouped sum in
``complete`` mode (the state is one row per pollutant and year -- small and bounded), and
``foreachBatch`` writing the totals with their running sums (W1) as a snapshot. The
stream's checkpoint lives in the shared checkpoint folder, so a restarted job resumes
from the files it has not yet seen instead of re-reading everything.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from airledger.operators import metrics
from airledger.session import checkpoint_dir


def totals_stream(spark: SparkSession, source_dir: str, schema: StructType, group: str = "contaminante_canon",
                  year: str = "año", value: str = "emision_total", max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming A1: total per (group, year) over every file that has arrived so far."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    facts = reader.parquet(source_dir)
    return (facts.where(F.col(year).isNotNull())
            .groupBy(group, year).agg(F.sum(value).alias("emision")))


def start_totals(spark: SparkSession, source_dir: str, schema: StructType, sink_dir: str,
                 query_name: str = "totals", checkpoint: str | None = None, available_now: bool = True,
                 group: str = "contaminante_canon", year: str = "año", value: str = "emision_total") -> StreamingQuery:
    """Start the stream. Each trigger writes the current totals and their running sums to a
    folder of their own under ``sink_dir`` (``epoch=n``), so a reader of an earlier one is not
    disturbed; ``latest_totals`` reads the last. ``query_name`` names the checkpoint, from which a
    restarted job resumes; ``available_now`` processes what is there and stops."""
    ckpt = checkpoint or f"{checkpoint_dir(spark).rstrip('/')}/totals-{query_name}"
    totals = totals_stream(spark, source_dir, schema, group, year, value)

    def write_snapshot(batch: DataFrame, epoch_id: int) -> None:
        running = metrics.running_totals(batch, group, year, "emision")
        running.write.mode("overwrite").parquet(f"{sink_dir}/epoch={epoch_id}")

    writer = (totals.writeStream.outputMode("complete").foreachBatch(write_snapshot)
              .option("checkpointLocation", ckpt))
    writer = writer.queryName(query_name)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def latest_totals(spark: SparkSession, sink_dir: str) -> DataFrame:
    """The snapshot of the last trigger that completed."""
    every = spark.read.parquet(sink_dir)
    last = every.agg(F.max("epoch")).scalar()
    return every.where(F.col("epoch") == last).drop("epoch")
