"""Parquet footers, and scans by row group.

Footers tell rows, schema and the least and largest values of row groups without a
page being read.  Tasks read them, a file's footer each, so a folder of a million
files takes no longer on the driver than its listing.  ``scan`` deals row groups
that their statistics don't rule out to tasks, which read them in bounded batches.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .storage import store

BATCH_ROWS = 500_000
GROUPS = "path string, row_group int, rows long, bytes long, schema string, problem string, stats array<struct<column:string,least:double,most:double,nulls:long>>"
_STATS = pa.list_(pa.struct([("column", pa.string()), ("least", pa.float64()), ("most", pa.float64()), ("nulls", pa.int64())]))


def files(spark: SparkSession, path: str, pattern: str = "*.parquet") -> DataFrame:
    """path, name and bytes of the files below a folder, or of a file: Spark's listing, no content is read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(path)
    return found.select("path", F.element_at(F.split("path", "/"), -1).alias("name"), F.col("length").alias("bytes"))


def number(value) -> float | None:
    """A value of statistics as a number: times in microseconds, days as their number; null for texts and what isn't known."""
    if isinstance(value, dt.datetime):
        whole = value.replace(tzinfo=dt.timezone.utc) if value.tzinfo is None else value
        return float(round((whole - dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)) / dt.timedelta(microseconds=1)))
    if isinstance(value, dt.date):
        return float((value - dt.date(1970, 1, 1)).days)
    return float(value) if isinstance(value, (int, float)) and not isinstance(value, bool) else None


def _stats(group) -> list[dict]:
    out = []
    for i in range(group.num_columns):
        column = group.column(i)
        s = column.statistics
        least, most = (number(s.min), number(s.max)) if s is not None and s.has_min_max else (None, None)
        out.append({"column": column.path_in_schema, "least": least, "most": most, "nulls": s.null_count if s is not None and s.has_null_count else None})
    return out


def _footer(path: str) -> Iterator[tuple]:
    where, inner = store(path)
    try:
        with where.open_input_file(inner) as f:
            found = pq.ParquetFile(f)
            said = "; ".join(f"{x.name} {x.type}" for x in found.schema_arrow)
            for i in range(found.metadata.num_row_groups):
                group = found.metadata.row_group(i)
                yield path, i, group.num_rows, group.total_byte_size, said, None, _stats(group)
            if not found.metadata.num_row_groups:
                yield path, -1, 0, 0, said, None, []
    except (OSError, pa.ArrowException) as e:
        yield path, -1, None, None, None, f"unreadable: {type(e).__name__}", []


def row_groups(found: DataFrame) -> DataFrame:
    """A row for each row group of files (path): rows, bytes, the file's schema, and each column's least and largest number and nulls.

    A file without row groups has one row (row_group -1); one whose footer can't be read too, with its problem.
    """
    kinds = [pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.string(), _STATS]
    names = [f.split()[0] for f in GROUPS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                rows = list(_footer(path))
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    return found.select("path").mapInArrow(run, GROUPS)


def summed(groups: DataFrame, column: str) -> DataFrame:
    """One row: rows of all files, and of a column the least and largest value and nulls, by footers alone."""
    s = F.element_at(F.filter("stats", lambda x: x["column"] == column), 1)
    return groups.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("n_rows"), F.min(s["least"]).alias("least"), F.max(s["most"]).alias("most"), F.sum(s["nulls"]).alias("nulls"))


def chosen(groups: DataFrame, column: str, low: float, high: float) -> DataFrame:
    """Row groups that may have values of low to high (both included); groups without statistics may."""
    s = F.element_at(F.filter("stats", lambda x: x["column"] == column), 1)
    apart = (s["most"] < low) | (s["least"] > high)
    return groups.where((F.col("row_group") >= 0) & ~F.coalesce(apart, F.lit(False)))


def scan(spark: SparkSession, path: str, columns: list[str], column: str | None = None, low: float | None = None, high: float | None = None, batch_rows: int = BATCH_ROWS) -> DataFrame:
    """Rows of Parquet files, read by row group in batches of so many rows; with a range of a column, only row groups that may hold it. Rows within them are left to the caller's filter."""
    schema = spark.read.parquet(path).schema
    wanted = T.StructType([schema[c] for c in columns])
    groups = row_groups(files(spark, path))
    if column is not None:
        groups = chosen(groups, column, low, high)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for where, i in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                place, inner = store(where)
                with place.open_input_file(inner) as f:
                    for part in pq.ParquetFile(f, pre_buffer=False).iter_batches(batch_rows, row_groups=[i], columns=columns):
                        yield part.select(columns)

    # each row group by itself: Spark may put several in a task, but never one in two
    return groups.where("row_group >= 0").select("path", "row_group").repartition("path", "row_group").mapInArrow(run, wanted)
