"""Queries by Structured Streaming: the tables' rows arrive in files, in bad order."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..sources.scratch import scratch
from ..streaming import alerts, incremental
from .registry import query
from .scans import unified

#: Chunks of so many days, the order in which they arrive, and a lateness that covers it.
DAYS, CHUNKS, LATE = 5, (1, 0, 3, 2, 5, 4, 6), "10 days"


def replayed(spark, sf_dir, columns: list[str], copies: int = 1):
    """The unified table as a stream of files, later days before earlier ones; more than one copy: each file comes again after the next."""
    folder, u = scratch(spark, "replayed"), unified(spark, sf_dir).select(*columns)
    first = u.agg(F.min(F.to_date("timestamp"))).first()[0]
    chunk = F.floor(F.datediff(F.to_date("timestamp"), F.lit(first)) / DAYS)
    u.withColumn("chunk", F.least(chunk, F.lit(CHUNKS[-1]))).repartition(4).write.partitionBy("chunk").parquet(f"{folder}/all")
    source = spark.read.parquet(f"{folder}/all")
    order = list(CHUNKS) if copies == 1 else [c for i, c in enumerate(CHUNKS) for c in ([CHUNKS[i - 1], c] if i else [c])] + [CHUNKS[-1]]
    for c in order:  # an arrival each
        source.where(F.col("chunk") == c).drop("chunk").coalesce(1).write.mode("append").parquet(f"{folder}/arrived")
    return incremental.new_files(spark, f"{folder}/arrived", source.drop("chunk").schema, max_files=1)


@query(f"""WITH s AS (SELECT source, MIN(timestamp) AS a, MAX(timestamp) AS b FROM unified GROUP BY source), w AS (SELECT MAX(timestamp) - INTERVAL {LATE} AS mark FROM unified),
slots AS (SELECT source, unnest(generate_series(a, mark, INTERVAL 5 MINUTES)) AS timestamp FROM s, w)
SELECT source, timestamp FROM slots, w WHERE timestamp < mark AND NOT EXISTS (SELECT 1 FROM unified u WHERE u.source = slots.source AND u.timestamp = slots.timestamp)""")
def x05_missing_alerts(spark, sf_dir):
    """Slots told as missing by a stream with a watermark and keyed state, up to the last watermark."""
    out, mark = scratch(spark, "alerts"), scratch(spark, "mark")
    incremental.run_available(alerts.missing_slots(replayed(spark, sf_dir, ["timestamp", "source"]), LATE), out, mark)
    return spark.read.parquet(out)


@query("SELECT DISTINCT timestamp, source, generator_id, value_mw FROM unified")
def x05_late_copies_go(spark, sf_dir):
    """Files that arrive twice: rows that came before, within the lateness, are dropped."""
    out, mark = scratch(spark, "once"), scratch(spark, "mark")
    rows = replayed(spark, sf_dir, ["timestamp", "source", "generator_id", "value_mw"], copies=2)
    incremental.run_available(alerts.without_late_copies(rows, ["timestamp", "source", "generator_id", "value_mw"], LATE), out, mark)
    return spark.read.parquet(out).withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))
