"""Structured Streaming over files: only new files are processed, each batch is merged into written state."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusforge.sources.storage import shared_folder


def counted(spark: SparkSession, path: str) -> DataFrame:
    """Counts per user of an event stream. Each batch appends its partial sums under its number, which a repeated batch
    overwrites, and the state is their sum; so every event counts once."""
    folder = shared_folder(spark)
    # as a glob, so that a single file may be the table
    events = spark.readStream.schema(spark.read.parquet(path).schema).parquet(f"{path[:-1]}[{path[-1]}]")

    def merge(batch: DataFrame, number: int) -> None:
        part = batch.groupBy("user_id").agg(F.count("*").alias("n"), F.min("event_id").alias("first_event"), F.sum(F.when(F.col("event_type") == "click", 1).otherwise(0)).alias("clicks"))
        part.write.mode("overwrite").parquet(f"{folder}/state/batch={number}")

    events.writeStream.foreachBatch(merge).option("checkpointLocation", f"{folder}/progress").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{folder}/state").groupBy("user_id").agg(F.sum("n").alias("n"), F.min("first_event").alias("first_event"), F.sum("clicks").alias("clicks"))
