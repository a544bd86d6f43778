"""Where a dataset lies, and what raw attachments look like before any is parsed."""

from __future__ import annotations

import os
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import archives, workbooks
from .scratch import filesystem

#: The variable that may name the dataset, and how deep folders are searched.
VARIABLE, DEPTH = "GRIDLOOM_DATA", 6
PREVIEW, DELIMITERS = 5, ",\t;|"
STRUCTURE = "path string, member string, kind string, encoding string, bytes long, commas long, tabs long, semicolons long, bars long, preview array<string>, problem string"


def locate(spark: SparkSession, name: str, argument: str | None = None, roots: list[str] | None = None, variable: str = VARIABLE) -> str:
    """The path of a dataset: the argument, else what the variable says, else the one place below the roots that has this name.

    Any of Hadoop's file systems is searched, folders by name and by level, so the
    nearest counts; two of one level are an error, as is none, and an argument or
    a variable that names nothing.
    """
    for said, how in ((argument, "the argument"), (os.environ.get(variable), f"the variable {variable}")):
        if said:
            fs, at = filesystem(spark, said)
            if not fs.exists(at):
                raise FileNotFoundError(f"{how} names {said}, which isn't there")
            return said
    level = [r for r in roots or []]
    for _ in range(DEPTH):
        below, found = [], []
        for folder in level:
            fs, at = filesystem(spark, folder)
            if fs.exists(at):
                for s in sorted(fs.listStatus(at), key=lambda s: s.getPath().toString()):
                    if s.getPath().getName() == name:
                        found.append(s.getPath().toString())
                    elif s.isDirectory() and not s.getPath().getName().startswith((".", "_")):
                        below.append(s.getPath().toString())
        if len(found) > 1:
            raise FileNotFoundError(f"{name} is there more than once: {', '.join(found)}")
        if found:
            return found[0]
        level = below
    raise FileNotFoundError(f"{name} is below none of {roots or []}")


def _cells(row: list) -> str:
    return ",".join("" if c is None else str(c) for c in row)


def _looks(name: str, data: bytes) -> Iterator[list]:
    """What a member is: of a text its encoding, first lines and how often delimiters stand in them; of a workbook the first rows of each sheet."""
    kind = archives.kind_of(name, data[: archives.HEAD])
    if kind == "text":
        encoding = archives.encoding_of(data[: archives.PROBE])
        lines = data[: archives.HEAD].decode(encoding, "replace").splitlines()[:PREVIEW]
        yield [name, kind, encoding, len(data), *(sum(x.count(d) for x in lines) for d in DELIMITERS), lines, None]
        return
    for sheet, rows in workbooks.ole_sheets(data) if kind == "ole" else workbooks.xml_sheets(data):
        yield [f"{name}: {sheet}", kind, None, len(data), *[None] * 4, [_cells(r) for _, r in zip(range(PREVIEW), rows, strict=False)], None]


def structure(files: DataFrame) -> DataFrame:
    """A row for each member, and each worksheet, of archives (path, content): what it is and its first five lines or rows. What can't be read has its problem; nothing is parsed or typed."""
    schema = archives._arrow_schema(STRUCTURE)

    def looked(path: str, content: bytes) -> Iterator[list]:
        try:
            archive = archives.opened(content)
            for info in archive.infolist():
                try:
                    for row in _looks(info.filename, archive.read(info)):
                        yield [path, *row]
                except (archives.FormatError, workbooks.WorkbookError, zipfile.BadZipFile, UnicodeError) as e:
                    yield [path, info.filename, *[None] * 8, str(e)]
        except zipfile.BadZipFile as e:
            yield [path, *[None] * 9, str(e)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [r for p, c in zip(*batch.columns, strict=True) for r in looked(p.as_py(), c.as_buffer().to_pybytes())]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    return files.select("path", F.col("content")).mapInArrow(run, STRUCTURE)
