"""Scans: pruned windows, typed CSV, manifests, files, and Parquet with nanoseconds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import UNIFIED


def load_window(data: DataFrame, source: str | None, start: str, end: str, columns: list[str]) -> DataFrame:
    """Rows of [start, end), by time; the filters reach the scan, and with the partitioned layout its folders."""
    span = (F.col("timestamp") >= F.expr(f"TIMESTAMP_NTZ '{start}'")) & (F.col("timestamp") < F.expr(f"TIMESTAMP_NTZ '{end}'"))
    if source is not None:
        span = (F.col("source") == source) & span
    if {"year", "month"} <= set(data.columns):
        number = F.col("year") * 12 + F.col("month")
        y0, m0, y1, m1 = int(start[:4]), int(start[5:7]), int(end[:4]), int(end[5:7])
        span = span & number.between(y0 * 12 + m0, y1 * 12 + m1)
    return data.where(span).select(*columns).orderBy("timestamp")


def read_unified(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType = UNIFIED) -> DataFrame:
    """Typed CSV of the contract; a bad number or timestamp fails the scan."""
    nullable = T.StructType([T.StructField(f.name, f.dataType, True) for f in schema])
    return spark.read.schema(nullable).option("header", True).option("mode", "FAILFAST").option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss").option("escape", '"').csv(path)


def read_manifests(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """All manifest.json files below a folder, one document each."""
    return spark.read.schema(schema).option("multiLine", True).option("recursiveFileLookup", True).option("pathGlobFilter", "*manifest.json").json(path)


def month_folders(df: DataFrame, start: str, end: str, column: str = "month") -> DataFrame:
    """A range of months, both included; on a partition column only their folders are read."""
    return df.where(F.col(column).between(start, end))


def month_range(df: DataFrame, column: str, start: str, end: str) -> DataFrame:
    """Rows of a range of months, YYYY-MM, both included, as a half-open range of a timestamp column."""
    first, last = (F.expr(f"TIMESTAMP_NTZ '{m}-01 00:00:00'") for m in (start, end))
    return df.where((F.col(column) >= first) & (F.col(column) < last + F.expr("INTERVAL 1 MONTH")))


def file_digests(spark: SparkSession, path: str) -> DataFrame:
    """name, bytes and SHA-256 of every file below a folder (of 2 GB at most each)."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select(F.element_at(F.split("path", "/"), -1).alias("name"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))


def count_lines(spark: SparkSession, path: str) -> int:
    return spark.read.text(path).count()


def read_nanos(spark: SparkSession, path: str, column: str = "timestamp") -> DataFrame:
    """Parquet whose timestamps count nanoseconds, which Spark reads as numbers only: to microseconds without zone. The session's own setting stays as it was."""
    name = "spark.sql.legacy.parquet.nanosAsLong"
    before = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        df = spark.read.parquet(path)
        schema = df.schema
    finally:
        spark.conf.set(name, before)
    if dict(df.dtypes)[column] != "bigint":
        return df
    micros = F.floor(F.col(column) / F.lit(1000))
    return spark.read.schema(schema).option("nanosAsLong", "true").parquet(path).withColumn(column, F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'") + F.make_dt_interval(secs=(micros / F.lit(1_000_000)).cast("decimal(18,6)")))


def read_dicts(spark: SparkSession, path: str) -> DataFrame:
    """CSV as a dictionary reader gives it: names from the header, every value a text, blanks and the ends of short rows empty."""
    return spark.read.option("header", True).option("inferSchema", False).option("emptyValue", "").option("multiLine", True).option("escape", '"').csv(path).na.fill("")
