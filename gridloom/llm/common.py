"""What the operators share: tables, staged results, labelled samples, mapping over whole texts."""

from __future__ import annotations

import atexit
import ctypes
import gc
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bytes of text that one call of a text function gets, if no single text is longer.
SLICE = 4 << 20

_staged: list[tuple[SparkSession, str]] = []
_tables: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir; a temporary one only where that is unset and all runs in one process (tests)."""
    context = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if not found:
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="gridloom-shared-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def stage(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """Writes a frame to the shared folder and reads it again: lineage ends here and lost executors cost only what they held.

    by: the last column, whose values get partitions of their own.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/gridloom/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}-{name}"
    df.write.parquet(path, partitionBy=by)
    _staged.append((spark, path))
    return spark.read.schema(df.schema).parquet(path)


def stage_bucketed(df: DataFrame, name: str, column: str) -> DataFrame:
    """stage(), in buckets by a column: grouped by it, the table isn't shuffled again, only what it is grouped with."""
    spark = df.sparkSession
    made = f"gridloom_{name}_{uuid.uuid4().hex}"
    path = f"{shared_dir(spark)}/gridloom/{spark.sparkContext.applicationId}/{made}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.bucketBy(buckets, column).option("path", path).option("compression", "zstd").saveAsTable(made)
    _staged.append((spark, path))
    _tables[path] = made
    return spark.table(made)


def staged() -> int:
    """How many tables are staged so far."""
    return len(_staged)


@atexit.register
def release(first: int = 0, last: int | None = None) -> None:
    """Deletes staged tables from number first to before last (all). Frames that read them can't be evaluated afterwards."""
    gone = _staged[first:last]
    del _staged[first:last]
    for spark, path in gone:
        try:
            if path in _tables:
                spark.sql(f"DROP TABLE IF EXISTS {_tables.pop(path)}")
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
        except Exception:  # the session has gone
            return


def trim() -> None:
    """Gives memory that earlier tasks of this Python worker have freed back to the system, which allocators don't do by themselves. Elsewhere than under glibc only Arrow's part."""
    pa.default_memory_pool().release_unused()
    give_back = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if give_back:
        give_back(0)


def slices(texts: list[bytes], most: int = SLICE) -> Iterator[tuple[int, int]]:
    """Bounds of runs of texts of so many bytes at most, or of one text."""
    return runs([len(t) for t in texts], most)


def runs(sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    """slices() of texts of so many bytes."""
    a, size = 0, 0
    for i, n in enumerate(sizes):
        if size and size + n > most:
            yield a, i
            a, size = i, 0
        size += n + 1
    if a < len(sizes):
        yield a, len(sizes)


def text_slices(batches: Iterator[pa.RecordBatch], at: int, most: int = SLICE) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """The rows of batches in slices, each with the UTF-8 bytes of its texts, which are column at (null: empty). Only one slice's texts are taken out of Arrow at a time."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(at)), 0).to_pylist()
        for a, b in runs(sizes, most):
            part = batch.slice(a, b - a)
            yield part, as_bytes(part.column(at))
        batch = part = sizes = None  # before the next one is read


def tidy(spark: SparkSession) -> None:
    """Lets Spark delete the shuffle files of frames that nothing refers to any more; otherwise they stay until the driver happens to collect its garbage. What the last query held is let go by the first collection and found by the second."""
    for _ in range(2):
        gc.collect()
        spark._jvm.System.gc()


def as_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a text column; null: empty."""
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


def map_text(df: DataFrame, fn: Callable[[list[bytes]], list], fields: str, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Adds columns that fn computes from slices of whole texts, in Arrow batches.

    fn gets UTF-8 byte strings (null: empty) and returns a list of values, or an
    Arrow array, for each field.  Columns of df named like a new field are
    replaced.  keep: columns of df to carry (default: all).
    """
    new = T._parse_datatype_string(fields)
    names = {f.name.lower() for f in new}
    kept = [c for c in (df.columns if keep is None else keep) if c.lower() not in names]
    schema = T.StructType([df.schema[c] for c in kept] + list(new))
    source = df.select(*kept, F.col(text).alias("__text"))
    types = [_arrow(f.dataType) for f in new]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trim()
        for part, texts in text_slices(batches, len(kept)):
            made = [x if isinstance(x, pa.Array) else pa.array(x, t) for x, t in zip(fn(texts), types, strict=True)]
            yield pa.RecordBatch.from_arrays([*part.columns[: len(kept)], *made], names=[f.name for f in schema])

    return source.mapInArrow(run, schema)


def filter_text(df: DataFrame, fn: Callable[[list[bytes]], list[bool]], text: str = "text") -> DataFrame:
    """The rows that fn keeps, judging slices of whole texts (null: empty); all columns stay as they are."""
    at = df.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trim()
        for part, texts in text_slices(batches, at):
            yield part.filter(pa.array(fn(texts), pa.bool_()))

    return df.mapInArrow(run, df.schema)


def _arrow(t: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(t)


def labelled(docs: DataFrame, labels: DataFrame, label: str, max_rows: int, where=None) -> DataFrame:
    """At most max_rows rows (doc_id, text, label, part) of labelled documents, one for each doc_id.

    A document with several labels takes the largest; null ids and labels don't
    count.  Of rows of one doc_id, that with the least hash of its text counts.
    Which documents: those with the least hashes of their ids, so that the sample
    is random and the same each time.  part: a hash from 0 to 99.  The broadcast
    side has max_rows rows of two numbers at most.
    """
    chosen = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
    if where is not None:
        chosen = chosen.where(where)
    chosen = chosen.groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
    at = F.xxhash64("doc_id", F.lit("sample"))
    chosen = chosen.orderBy(at, "doc_id").limit(max_rows)
    part = F.pmod(F.xxhash64("doc_id", F.lit("part")), F.lit(100)).cast("int").alias("part")
    found = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    return found.groupBy("doc_id", "label").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text")).select("doc_id", "text", "label", part)


def remainder(by: int):
    """crc32(doc_id as text) mod by."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(by))
