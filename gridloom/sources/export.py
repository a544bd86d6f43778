"""One ordered CSV export in resumable ranges, hashed as it is written.

The whole history is cut into ranges of time once, and the cuts are recorded beside
the export (``plan.json``): they are the batches, numbered in the order of the rows.
All that are missing are written by one job, each by one task: a file that appears
whole or not at all, and then its record (rows by source, bytes, SHA-256, first and
last time), which makes the batch durable.  A run after a failure finds the records
and reads and writes the other ranges only; bytes are the same as without the
failure, since cuts and order are.  ``finished`` lists batches in order; the files
one after another, under the header of the contract, are the export.

The records are the writers' commit messages too: digests come from the tasks that
wrote, and nothing is read again.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import datasource as ds
from pyspark.sql import functions as F

from ..operators.normalize import csv_rows
from ..operators.series import bounds, range_of
from .storage import Hashed, small_file, store

NAME = "ordered_csv"
ROWS = "batch int, source string, timestamp string, value string"
RECORD = "batch int, name string, rows long, bytes long, sha256 string, first string, last string, by_source map<string,long>"
ORDER = ["timestamp", "source", "generator_id", "value_mw"]


@dataclass
class Written(ds.WriterCommitMessage):
    records: list[dict]


class Writer(ds.DataSourceArrowWriter):
    """Rows come sorted by batch; a task may have several batches, but no batch has two tasks."""

    def __init__(self, path: str):
        self.path = path

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        attempt, done, out, now = str(TaskContext.get().taskAttemptId()), [], None, None

        def end() -> None:
            now["bytes"], now["sha256"] = out.close()
            small_file(f"{self.path}/done/{now['batch']:06d}.json", json.dumps(now, sort_keys=True).encode(), attempt)
            done.append(now)

        for data in iterator:
            batches = data.column(0).to_numpy()
            at = 0
            while at < len(batches):
                n = int((batches[at:] == batches[at]).argmin()) or len(batches) - at  # up to the next batch
                part = data.slice(at, n)
                if now is None or now["batch"] != int(batches[at]):
                    if out:
                        end()
                    now = {"batch": int(batches[at]), "name": f"part-{batches[at]:06d}.csv", "rows": 0, "by_source": {}, "first": part.column(2)[0].as_py(), "last": None}
                    out = Hashed(f"{self.path}/{now['name']}", attempt)
                out.write(("\n".join(part.column(3).to_pylist()) + "\n").encode())
                now["rows"], now["last"] = now["rows"] + n, part.column(2)[n - 1].as_py()
                for c in part.column(1).value_counts().to_pylist():
                    now["by_source"][c["values"]] = now["by_source"].get(c["values"], 0) + c["counts"]
                at += n
        if out:
            end()
        return Written(done)

    def commit(self, messages):
        pass

    def abort(self, messages):
        pass  # batches that are done stay done


class OrderedCsv(ds.DataSource):
    @classmethod
    def name(cls):
        return NAME

    def schema(self):
        return ROWS

    def writer(self, schema, overwrite):
        return Writer(self.options["path"])


def _small(path: str) -> list[tuple[str, dict]]:
    """JSON documents of a folder, one a batch."""
    where, inner = store(path)
    if where.get_file_info(inner).type == fs.FileType.NotFound:
        return []
    found = [i.path for i in where.get_file_info(fs.FileSelector(inner)) if i.path.endswith(".json")]
    return [(p, json.loads(where.open_input_stream(p).readall())) for p in sorted(found)]


def plan(unified: DataFrame, path: str, batches: int) -> list:
    """The cuts between batches: those that are recorded, or new ones, which are recorded then."""
    where, inner = store(path)
    if where.get_file_info(f"{inner}/plan.json").type == fs.FileType.NotFound:
        cuts = [t.isoformat(" ") for t in bounds(unified, "timestamp", batches)]
        small_file(f"{path}/plan.json", json.dumps({"cuts": cuts}).encode(), "plan")
    return json.loads(where.open_input_stream(f"{inner}/plan.json").readall())["cuts"]


def finished(spark: SparkSession, path: str) -> DataFrame:
    """A row for each durable batch, in order: rows, bytes, SHA-256, first and last time, rows by source."""
    names = [f.split()[0] for f in RECORD.split(", ")]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for _, r in _small(f"{path}/done")], RECORD).orderBy("batch")


def export(unified: DataFrame, path: str, batches: int = 200) -> DataFrame:
    """Writes all batches of an export that aren't durable yet, and returns ``finished``.

    Rows without a time are no part of it.  The table must be the same in every
    run of an export.
    """
    spark = unified.sparkSession
    spark.dataSource.register(OrderedCsv)
    timed = unified.where(F.col("timestamp").isNotNull())
    cuts = plan(timed, path, batches)
    done = [r["batch"] for _, r in _small(f"{path}/done")]
    number = range_of(F.col("timestamp"), cuts, "timestamp_ntz")
    rows = timed.withColumn("batch", number).where(~F.col("batch").isin(done)) if done else timed.withColumn("batch", number)
    left = len(cuts) + 1 - len(done)
    if left:
        dealt = rows.repartition(min(left, 4096), "batch").sortWithinPartitions("batch", *ORDER)
        lines = csv_rows(dealt, keep=["batch", "source", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss").alias("timestamp")])
        lines.write.format(NAME).mode("append").option("path", path).save()
    return finished(spark, path)
