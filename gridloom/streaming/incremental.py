"""Incremental runs over files that arrive, by Structured Streaming.

Each file is taken once, whatever the number of runs: the checkpoint records what
was seen, so earlier outputs are never computed again and a run that failed goes
on where it stopped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery


def new_files(spark: SparkSession, path: str, schema: T.StructType, max_files: int = 1000) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(path)


def slot_totals(rows: DataFrame, value: str, late: str = "1 hour", slot: str = "5 minutes") -> DataFrame:
    """Sums and counts by five-minute slot and source; a slot is closed once rows are that much later. Watermarks take zoned timestamps only, so the session's zone stands in for none."""
    timed = rows.withColumn("timestamp", F.col("timestamp").cast("timestamp")).withWatermark("timestamp", late)
    made = timed.groupBy(F.window("timestamp", slot), "source").agg(F.sum(value).alias("total_mw"), F.count("*").alias("n"))
    return made.select(F.col("window.start").cast("timestamp_ntz").alias("slot"), "source", "total_mw", "n")


def run_available(df: DataFrame, path: str, checkpoint: str, partition_by: list[str] | None = None) -> StreamingQuery:
    """Appends everything that has arrived to a Parquet folder, then ends."""
    writer = df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    query = writer.start()
    query.awaitTermination()
    return query
