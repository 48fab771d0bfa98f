"""Batched mode as a stream: files that arrive in a folder go through a pipeline's steps, some files at a time."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tidewright.plans.pipeline import Pipeline, run_steps
from tidewright.sources import tables


def process_arrivals(spark: SparkSession, pipeline: Pipeline, source: str, schema: StructType, destination: str, checkpoint: str, files_at_once: int = 1) -> StreamingQuery:
    """Starts a query that handles what is there and ends. A batch that is repeated after a failure replaces its own output, and
    its model steps find their answers in the log."""
    work = tables.Folder(spark, destination).ensure_subdir(pipeline.name)

    def handle(batch: DataFrame, epoch: int) -> None:
        made = run_steps(pipeline.steps, batch, work, f"00000000_{epoch:06}")  # a run id, the same when the batch is repeated
        made.write.mode("overwrite").parquet(f"{destination}/{pipeline.name}_batch_{epoch}.parquet")

    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_at_once).parquet(source)
    return stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
