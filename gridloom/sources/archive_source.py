"""Archives as a data source of Spark: ``load(spark, folder)``, and readStream of the format ``signal_archives``.

A partition is a share of one archive's blocks: blocks are dealt round to the
archive's partitions, each of which unpacks the stream and parses its own.
Archives are opened in place and never held whole.  The month that stands in an archive's name, and the signal that its
folder is named after, are columns; filters on them are applied to names, so other
archives aren't opened.  As a stream, each archive is taken once, in the order in
which archives arrived.

Options: signal (if folders don't tell), part_bytes (packed bytes of an archive for
each partition), max_archives (of a batch of a stream).
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import datasource as ds

from ..schema import SIGNALS
from . import archives
from .storage import listed, store

NAME = "signal_archives"
SCHEMA = "signal string, month string, path string, member string, encoding string, preamble_rows int, ordinal long, c0 string, c1 string, c2 string"
PART_BYTES, MAX_ARCHIVES = 16 << 20, 1000
_MONTH = re.compile(r"(?<!\d)((?:19|20)\d\d)[-_]?(0[1-9]|1[0-2])(?!\d{3})")


@dataclass
class Part(ds.InputPartition):
    signal: str
    month: str | None
    path: str
    number: int
    of: int


def described(path: str, signal: str | None) -> tuple[str | None, str | None]:
    """Signal and month that a path tells; both null if it doesn't."""
    folders, _, name = path.rpartition("/")
    found = _MONTH.search(name)
    told = signal or next((f for f in reversed(folders.split("/")) if f in SIGNALS), None)
    return told, f"{found[1]}-{found[2]}" if found else None


def parts_of(path: str, size: int, signal: str | None, month: str | None, part_bytes: int) -> list[Part]:
    if signal is None:
        raise archives.FormatError(f"{path}: no folder and no option tells the signal")
    n = -(-size // part_bytes) or 1
    return [Part(signal, month, path, i, n) for i in range(n)]


def rows_of(part: Part) -> Iterator[pa.RecordBatch]:
    """The rows of a partition's blocks, as texts."""
    where, inner = store(part.path)
    schema = pa.schema([(n, {"string": pa.string(), "int": pa.int32(), "long": pa.int64()}[t]) for n, t in (f.split() for f in SCHEMA.split(", "))])
    with where.open_input_file(inner) as f:
        found = archives.member(part.signal, f)
        for n, data in enumerate(found.blocks):
            if n % part.of == part.number:
                made = archives.parse(data, found.encoding, found.width, found.keep, found.quoted).combine_chunks()
                known = [pa.repeat(pa.scalar(x, f.type), len(made)) for x, f in zip((part.signal, part.month, part.path, found.name, found.encoding, found.preamble), schema, strict=False)]
                ordinal = pa.array(range(n << 32, (n << 32) + len(made)), pa.int64())
                texts = [c.combine_chunks() for c in made.columns] + [pa.nulls(len(made), pa.string())] * (3 - made.num_columns)
                yield from pa.Table.from_arrays([*known, ordinal, *texts], schema=schema).to_batches(max_chunksize=50_000)


def _test(f: ds.Filter) -> Callable[[str | None], bool] | None:
    """What a filter on one column asks of its value; None for filters that aren't applied to names."""
    simple = {ds.EqualTo: lambda v, x: v == x, ds.GreaterThan: lambda v, x: v > x, ds.GreaterThanOrEqual: lambda v, x: v >= x, ds.LessThan: lambda v, x: v < x, ds.LessThanOrEqual: lambda v, x: v <= x, ds.In: lambda v, x: v in x}
    kind = simple.get(type(f))
    if type(f) is ds.IsNotNull:
        return lambda v: v is not None
    return kind and (lambda v: v is not None and kind(v, f.value))


class Reader(ds.DataSourceReader):
    def __init__(self, options):
        self.path, self.signal = options["path"], options.get("signal")
        self.part_bytes = int(options.get("part_bytes", PART_BYTES))
        self.asked: list[tuple[int, Callable]] = []

    def pushFilters(self, filters):
        self.asked = []  # Spark 4.1 hands on the reader of the frame's query before
        for f in filters:
            place = {("signal",): 0, ("month",): 1}.get(tuple(f.attribute)) if hasattr(f, "attribute") else None
            test = _test(f)
            if place is None or test is None:
                yield f
            else:
                self.asked.append((place, test))

    def partitions(self):
        out = []
        for info in listed(self.path, ".zip"):
            told = described(info.path, self.signal)
            if all(test(told[place]) for place, test in self.asked):
                out += parts_of(info.path, info.size, *told, self.part_bytes)
        return out

    def read(self, partition):
        return rows_of(partition) if partition else iter(())


class StreamReader(ds.DataSourceStreamReader):
    """An offset is the time and path of the last archive taken, so archives must come with the time at which they come."""

    def __init__(self, options):
        self.path, self.signal = options["path"], options.get("signal")
        self.part_bytes, self.most = int(options.get("part_bytes", PART_BYTES)), int(options.get("max_archives", MAX_ARCHIVES))
        self.last: tuple[int, str] = (0, "")

    def _after(self, since: tuple[int, str]) -> list:
        found = sorted(((i.mtime_ns or 0, i.path), i) for i in listed(self.path, ".zip"))
        return [(at, i) for at, i in found if at > since]

    def initialOffset(self):
        return {"time": 0, "path": ""}

    def latestOffset(self):
        some = self._after(self.last)[: self.most]
        if some:
            self.last = some[-1][0]
        return {"time": self.last[0], "path": self.last[1]}

    def partitions(self, start, end):
        since, until = ((o["time"], o["path"]) for o in (start, end))
        self.last = max(self.last, until)
        return [p for at, i in self._after(since) if at <= until for p in parts_of(i.path, i.size, *described(i.path, self.signal), self.part_bytes)]

    def read(self, partition):
        return rows_of(partition)

    def commit(self, end):
        pass


class ArchiveSource(ds.DataSource):
    @classmethod
    def name(cls):
        return NAME

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return Reader(self.options)

    def streamReader(self, schema):
        return StreamReader(self.options)


def register(spark: SparkSession) -> None:
    """Makes the format known to a session and lets filters reach it."""
    spark.dataSource.register(ArchiveSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def load(spark: SparkSession, folder: str, **options: str) -> DataFrame:
    """A folder's archives as a frame that can be used again and again.

    Spark 4.1 keeps what one query of a frame pushed for a later one that pushes
    nothing; here each query pushes something, so nothing of another stays.
    """
    register(spark)
    return spark.read.format(NAME).options(**options).load(folder).where("path IS NOT NULL")


def register_function(spark: SparkSession, name: str = "signal_rows") -> None:
    """The decoder as a table function of SQL: ``FROM signal_rows(TABLE(SELECT path, content, 'dispatch' AS signal FROM files))``.

    It gives path, member, encoding, ordinal and texts of the rows of each archive.
    It takes and gives Arrow batches, which Spark doesn't allow beside LATERAL, so
    the archives are its table argument.
    """
    from pyspark.sql.functions import arrow_udtf

    @arrow_udtf(returnType="path string, member string, encoding string, ordinal long, c0 string, c1 string, c2 string")
    class SignalRows:
        def eval(self, batch: pa.RecordBatch) -> Iterator[pa.Table]:
            for path, data, said in zip(batch.column("path").to_pylist(), batch.column("content"), batch.column("signal").to_pylist(), strict=True):
                if not data.is_valid:
                    continue
                found = archives.member(said, data.as_buffer().to_pybytes())
                for n, block in enumerate(found.blocks):
                    made = archives.parse(block, found.encoding, found.width, found.keep, found.quoted).combine_chunks()
                    texts = [c.combine_chunks() for c in made.columns] + [pa.nulls(len(made), pa.string())] * (3 - made.num_columns)
                    known = [pa.repeat(pa.scalar(x, pa.string()), len(made)) for x in (path, found.name, found.encoding)]
                    ordinal = pa.array(range(n << 32, (n << 32) + len(made)), pa.int64())
                    yield pa.Table.from_arrays([*known, ordinal, *texts], names=["path", "member", "encoding", "ordinal", "c0", "c1", "c2"])

    spark.udtf.register(name, SignalRows)


def write_archives(files, folder: str) -> int:
    """Writes archives (path, content) as files of a folder, by tasks; the number written. Tests and queries make their inputs so."""
    from .storage import small_file

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(*batch.columns, strict=True):
                small_file(f"{folder}/{name.as_py()}.zip", content.as_buffer().to_pybytes(), str(id(content)))
            yield pa.RecordBatch.from_arrays([batch.column(0)], names=["path"])

    return files.select("path", "content").mapInArrow(run, "path string").count()
