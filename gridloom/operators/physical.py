"""A manifest against the files that are there."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import footers
from ..sources.storage import digest

#: Ends of names that unfinished or cut off writes leave.
LEFT_OVER = r"\.(part|tmp|crdownload)$|(^|/)_temporary(/|$)"


def _plain(path):
    """A path without scheme and repeated slashes."""
    return F.regexp_replace(path, "^[a-z0-9]+:/+", "/")


def digests(found: DataFrame) -> DataFrame:
    """path, bytes and SHA-256 of files (path) of any size; each is read once, by one task, a chunk at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                size, sha = digest(path)
                yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([size]), pa.array([sha])], names=["path", "bytes", "sha256"])

    return found.select("path").mapInArrow(run, "path string, bytes long, sha256 string")


def inventory(spark: SparkSession, folder: str) -> DataFrame:
    """A row for each file below a folder: name (from the folder on), bytes, sha256, and of Parquet files rows, schema and whether the footer can be read."""
    found = footers.files(spark, folder, "*")
    tables = footers.row_groups(found.where(F.col("name").endswith(".parquet")))
    by_file = tables.groupBy("path").agg(F.sum("rows").alias("rows"), F.first("schema").alias("schema"), F.first("problem").alias("problem"))
    base = spark.createDataFrame([(folder.rstrip("/"),)], "folder string").select(_plain("folder").alias("folder"))
    joined = digests(found).join(by_file, "path", "left").join(F.broadcast(base))
    name = F.substring(_plain(F.col("path")), F.length("folder") + 2, F.lit(1 << 20))
    return joined.select(name.alias("name"), "bytes", "sha256", "rows", "schema", "problem")


def problems(manifest: DataFrame, found: DataFrame) -> DataFrame:
    """A row (name, problem) for all that is wrong between a manifest (name, bytes, sha256, rows, schema) and an inventory of files.

    missing; unexpected, or left over from a write that was cut off; else size,
    digest, unreadable, rows, schema.  What the manifest has null isn't compared.
    """
    m, f = manifest.alias("m"), found.alias("f")
    both = m.join(f, F.col("m.name") == F.col("f.name"), "full")
    off = lambda c: F.col(f"m.{c}").isNotNull() & ~F.col(f"m.{c}").eqNullSafe(F.col(f"f.{c}"))
    bad = F.col("f.problem").isNotNull()
    compared = F.array(
        F.when(off("bytes"), "size"), F.when(off("sha256"), "digest"), F.when(bad, "unreadable"), F.when(~bad & off("rows"), "rows"), F.when(~bad & off("schema"), "schema"),
    )
    extra = F.array(F.when(F.col("f.name").rlike(LEFT_OVER), "left over").otherwise("unexpected"))
    said = F.when(F.col("f.name").isNull(), F.array(F.lit("missing"))).when(F.col("m.name").isNull(), extra).otherwise(compared)
    each = both.select(F.coalesce("m.name", "f.name").alias("name"), F.explode(said).alias("problem"))
    return each.where("problem IS NOT NULL")
