"""Sinks: partitioned Parquet, CSV of the contract, manifests. Spark's commit protocol publishes whole or not at all."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.normalize import CSV_HEADER, csv_rows
from .scratch import filesystem
from .storage import copied


def write_partitioned(unified: DataFrame, path: str, mode: str = "overwrite") -> None:
    """source=/year=/month= folders, zstd, rows by time within a file.

    Rows are dealt by month and, so that a month of a hot source isn't one task,
    by day within it; only partitions that df has are replaced.
    """
    dated = unified.withColumn("year", F.year("timestamp")).withColumn("month", F.month("timestamp"))
    dealt = dated.repartition("source", "year", "month", F.dayofmonth("timestamp")).sortWithinPartitions("source", "year", "month", "timestamp", "generator_id")
    writer = dealt.write.mode(mode).option("compression", "zstd").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("source", "year", "month").parquet(path)


def write_single(unified: DataFrame, path: str) -> None:
    """One file, by month and source: for small results only, as one task writes it."""
    ordered = unified.orderBy(F.date_trunc("MONTH", "timestamp"), "source", "timestamp", "generator_id")
    ordered.coalesce(1).write.mode("overwrite").option("compression", "zstd").parquet(path)


def write_csv(unified: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV of the contract as text parts, each with its header: texts quoted, numbers bare, null blank.

    Spark's writer quotes a value or doesn't; its ``quoteAll`` would quote numbers
    and blanks too.  So lines are built and written as the one column, named like
    the header, of a CSV without quoting; nothing is shuffled.
    """
    lines = csv_rows(unified).withColumnRenamed("value", CSV_HEADER)
    # neither sign can stand in a text: no separator is needed for one column, and no quote
    writer = lines.write.mode(mode).option("header", True).option("sep", "\x01").option("quote", "\u0000").option("escapeQuotes", False).option("emptyValue", "")
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)


def write_csv_months(unified: DataFrame, path: str, months: list[str]) -> list[str]:
    """The contract's CSV in a folder for each month (month=YYYY-MM), one file in each, in order; the months that were written.

    A month that a run before has finished, which its _SUCCESS file tells, is
    passed over, so a run that was cut off goes on with the first month that is missing.
    Rows of one month come to one task, as one file is asked for.
    """
    spark, done = unified.sparkSession, []
    for month in months:
        place = f"{path}/month={month}"
        fs, mark = filesystem(spark, f"{place}/_SUCCESS")
        if fs.exists(mark):
            continue
        first = F.expr(f"TIMESTAMP_NTZ '{month}-01 00:00:00'")
        rows = unified.where((F.col("timestamp") >= first) & (F.col("timestamp") < F.expr(f"TIMESTAMP_NTZ '{month}-01 00:00:00' + INTERVAL 1 MONTH")))
        write_csv(rows.coalesce(1).sortWithinPartitions("timestamp", "source", "generator_id"), place)
        done.append(month)
    return done


def write_csv_typed(unified: DataFrame, path: str) -> None:
    """CSV with a header by Spark's own writer; numbers aren't quoted, texts where needed."""
    unified.write.mode("overwrite").option("header", True).option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss").csv(path)


def write_slice(unified: DataFrame, path: str, start: str, end: str) -> dict[str, int]:
    """A time slice as CSV, and its rows by source, counted in the same pass."""
    from pyspark.sql import Observation

    from ..schema import SIGNALS

    seen = Observation()
    span = (F.col("timestamp") >= F.expr(f"TIMESTAMP_NTZ '{start}'")) & (F.col("timestamp") < F.expr(f"TIMESTAMP_NTZ '{end}'"))
    rows = unified.where(span).observe(seen, *[F.count_if(F.col("source") == s).alias(s) for s in SIGNALS])
    write_csv_typed(rows, path)
    return seen.get


def write_manifest(files: DataFrame, path: str) -> None:
    """One JSON document: files with rows, bytes and hash, and totals. A row for each file comes to one task."""
    listed = F.array_sort(F.collect_list(F.struct("name", "rows", "bytes", "sha256")))
    files.agg(F.count("*").alias("n_files"), F.sum("rows").alias("total_rows"), F.sum("bytes").alias("total_bytes"), listed.alias("files")).coalesce(1).write.mode("overwrite").json(path)


def write_small(spark: SparkSession, path: str, content: bytes) -> None:
    """One small file of the driver's (a manifest, a report), whole or not at all: it is written beside its place and renamed over what is there."""
    fs, at = filesystem(spark, path)
    _, beside = filesystem(spark, f"{path}.{uuid.uuid4().hex}.part")
    out = fs.create(beside, True)
    try:
        out.write(bytearray(content))
    finally:
        out.close()
    hadoop = spark._jvm.org.apache.hadoop.fs
    rename = getattr(hadoop, "Options$Rename")
    how = spark.sparkContext._gateway.new_array(rename, 1)
    how[0] = rename.OVERWRITE
    hadoop.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration()).rename(beside, at, how)


def write_json(spark: SparkSession, path: str, document: dict) -> None:
    write_small(spark, path, (json.dumps(document, ensure_ascii=False, indent=2, sort_keys=True) + "\n").encode())


def release_table(spark: SparkSession, name: str, path: str) -> DataFrame:
    """A release of finished Parquet files as a table over them where they are: nothing is copied, and dropping the table leaves the files."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS `{name}` USING parquet LOCATION '{path}'")
    return spark.table(f"`{name}`")


def package(spark: SparkSession, files: list[str], folder: str) -> list[str]:
    """Copies of finished files in a release's folder, for stores without tables, made by tasks, a chunk at a time; those of equal name and size stay as they are. The names that were copied."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = [p.rpartition("/")[2] for p in batch.column(0).to_pylist() if copied(p, f"{folder}/{p.rpartition('/')[2]}")]
            yield pa.RecordBatch.from_arrays([pa.array(done, pa.string())], names=["name"])

    listed = spark.createDataFrame([(f,) for f in files], "path string")
    return sorted(r.name for r in listed.repartition(max(1, min(len(files), 200)), "path").mapInArrow(run, "name string").collect())
