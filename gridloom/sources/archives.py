"""Decoding of monthly attachments: ZIP archives of text files or workbooks whose form drifts.

``blocks`` opens archives that the binaryFile source reads and cuts their text into
blocks of some megabytes, at line ends; Spark deals those out again, so that the
rows of one large month are parsed by all tasks (``decode``), by Arrow's CSV reader,
to texts.  Types are given by ``operators.normalize``, on the JVM.  An archive is
held in one task in its compressed form, as binaryFile hands it over; its text isn't.
"""

from __future__ import annotations

import csv
import io
import re
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import groupby

import pyarrow as pa
import pyarrow.csv as arrow_csv
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.expressions import CODE_KO, ESTIMATED_KO, GENERATOR_KO, TIME_KO
from ..schema import DEMAND, DISPATCH, STATE
from . import workbooks

# How files begin, how far headers are looked for, and the bytes that tell an encoding.
ZIP_MAGIC, OLE_MAGIC, BOM = b"PK\x03\x04", bytes.fromhex("d0cf11e0a1b11ae1"), b"\xef\xbb\xbf"
HEADER_LINES = {DEMAND: 20, DISPATCH: 100, STATE: 100}
SHEET_ROWS, PROBE, HEAD = 20, 4096, 1 << 16
#: Bytes of text in a block, and rows of a workbook.
BLOCK, BLOCK_ROWS = 4 << 20, 100_000
FIELDS = "path string, member string, encoding string, preamble_rows int, ordinal long, c0 string, c1 string, c2 string"
BLOCK_FIELDS = "path string, member string, encoding string, preamble_rows int, block int, width int, keep array<int>, quoted boolean, data binary"

#: What a column's name says, without white space and in capitals.
ROLES = {
    "time": re.compile(f"TIME|{TIME_KO}"), "generator": re.compile(rf"(?=.*(?:GEN|{GENERATOR_KO}))(?=.*(?:CODE|{CODE_KO})).*"),
    "basepoint": re.compile("BASEPOINT"), "estimate": re.compile(rf"(?=.*MW)(?=.*(?:EST|{ESTIMATED_KO})).*"),
}
#: The roles of a signal's columns, and whether there may be others and any order.
HEADERS = {DISPATCH: (("time", "generator", "basepoint"), True), STATE: (("time", "generator", "estimate"), False)}
_DEMAND_HEADER = re.compile(rf"﻿?TIME,|.*{TIME_KO}.*,|.*,.*{TIME_KO}", re.I)
#: Kinds of member that can hold a signal.
KINDS = {DEMAND: ("ole", "workbook", "text"), DISPATCH: ("workbook", "text"), STATE: ("text",)}
_DATE = re.compile(r"\d{4}.\d{2}.\d{2}")


class FormatError(RuntimeError):
    pass


def encoding_of(head: bytes) -> str:
    """utf-8-sig, ascii, utf-8 or cp949. A character that the end of the bytes cuts is no error."""
    if head.startswith(BOM):
        return "utf-8-sig"
    for name in ("ascii", "utf-8", "cp949"):
        try:
            head.decode(name)
        except UnicodeDecodeError as e:
            if name == "ascii" or e.start < len(head) - 3 or e.end < len(head):
                continue
        return name
    raise FormatError("not a text in ASCII, UTF-8 or CP949")


def token(name: str) -> str:
    return re.sub(r"[\s﻿]+", "", name).upper()


def places(signal: str, columns: list[str]) -> tuple[int, ...] | None:
    """Where a header has the signal's columns; None if it isn't one."""
    if signal not in HEADERS:
        return None
    roles, free = HEADERS[signal]
    names = [token(c) for c in columns]
    found = [[i for i, n in enumerate(names) if ROLES[r].fullmatch(n)] for r in roles]
    if not free:
        return (0, 1, 2) if len(names) == 3 and all(i in f for i, f in enumerate(found)) else None
    return tuple(f[0] for f in found) if all(len(f) == 1 for f in found) else None


@dataclass
class Layout:
    """How a text is laid out: its encoding, the lines before its header, the header's columns, those that are kept, and whether fields may be quoted."""

    encoding: str
    preamble: int
    columns: list[str]
    keep: tuple[int, ...]
    quoted: bool


def layout(signal: str, head: bytes) -> Layout | None:
    """Of a text that begins so; None without a header near its beginning."""
    encoding = encoding_of(head[:PROBE])
    for n, line in enumerate(head.decode(encoding, "replace").split("\n", HEADER_LINES[signal])[: HEADER_LINES[signal]]):
        columns = [c.strip().strip('"').strip() for c in line.split(",")]
        keep = ((0, 1) if _DEMAND_HEADER.match(line) else None) if signal == DEMAND else places(signal, columns)
        if keep:
            return Layout(encoding, n, columns, keep, b'"' in head)
    return None


def kind_of(name: str, head: bytes) -> str:
    if head.startswith(OLE_MAGIC):
        return "ole"
    if head.startswith(ZIP_MAGIC):
        return "workbook" if name.lower().endswith((".xlsx", ".xlsm")) else "archive"
    return "text"


def opened(content) -> zipfile.ZipFile:
    """An archive, of bytes or of an open file; names that aren't marked as UTF-8 are read as CP949, or all as they are where that fails."""
    place = io.BytesIO(content) if isinstance(content, bytes) else content
    try:
        return zipfile.ZipFile(place, metadata_encoding="cp949")
    except UnicodeDecodeError:
        return zipfile.ZipFile(place)


def select_member(signal: str, archive: zipfile.ZipFile) -> tuple[zipfile.ZipInfo, list[str]]:
    """The one member that holds the signal, and the names of the others. A single member isn't looked at."""
    infos = archive.infolist()
    fit = infos
    if len(infos) != 1:
        fit = [i for i in infos if _holds(signal, archive, i)]
    if len(fit) != 1:
        raise FormatError(f"{signal}: {len(fit)} of {len(infos)} members can hold it")
    return fit[0], [i.filename for i in infos if i is not fit[0]]


def _holds(signal: str, archive: zipfile.ZipFile, info: zipfile.ZipInfo) -> bool:
    with archive.open(info) as f:
        head = f.read(HEAD)
    kind = kind_of(info.filename, head)
    try:
        return kind in KINDS[signal] and (kind != "text" or layout(signal, head) is not None)
    except FormatError:
        return False


def is_time_cell(cell: str | None) -> bool:
    said = (cell or "").strip()
    return "-" in said and bool(_DATE.match(said))


def sheet_rows(data: bytes) -> Iterator[tuple[str | None, ...]]:
    """Time, generator and value of all worksheets of a workbook; where the three columns stand is told by each sheet's first rows: by their header, or by the first row of data."""
    some = False
    for name, rows in workbooks.xml_sheets(data):
        some = True
        first = [row for _, row in zip(range(SHEET_ROWS), rows, strict=False)]
        spots = [(n, i, row[i : i + 3]) for n, row in enumerate(first) for i in range(len(row) - 2)]
        begin = next(((n + 1, i) for n, i, (a, b, c) in spots if token(a or "") and "CODE" in token(b or "") and token(c or "") == "BASEPOINT"), None)
        begin = begin or next(((n, i) for n, i, (a, b, c) in spots if is_time_cell(a) and b is not None and c is not None), None)
        if begin is None:
            raise FormatError(f"dispatch: worksheet {name!r} has no three columns of data")
        start, at = begin
        for part in (first[start:], rows):
            yield from (tuple(row[at : at + 3]) for row in part if len(row) > at + 2 and is_time_cell(row[at]))
    if not some:
        raise FormatError("dispatch: a workbook without worksheets")


def demand_rows(data: bytes, kind: str) -> Iterator[tuple[str | None, ...]]:
    """The first two columns of the first worksheet, below its header. Times given as day numbers become texts."""
    sheets = workbooks.ole_sheets(data) if kind == "ole" else workbooks.xml_sheets(data)
    found = next(sheets, None)
    since = kind == "ole" and workbooks.ole_since_1904(data)
    for n, row in enumerate(found[1] if found else ()):
        time, value = (row + [None, None])[:2]
        if n and (time, value) != (None, None):
            yield (workbooks.serial_text(float(time), since) if re.fullmatch(r"\d+(\.\d+)?", time or "") else time), value


@dataclass
class Member:
    """The part of an archive that holds a signal, and its text in blocks of whole lines: (width, places to keep, bytes)."""

    name: str
    ignored: list[str]
    kind: str
    encoding: str | None = None
    preamble: int | None = None
    ignored_columns: list[str] = field(default_factory=list)
    width: int = 0
    keep: tuple[int, ...] = ()
    quoted: bool = True
    blocks: Iterator[bytes] = iter(())


def member(signal: str, content) -> Member:
    """Of an archive, as bytes or as an open file. Its blocks are read from the archive as they are taken."""
    archive = opened(content)
    info, ignored = select_member(signal, archive)
    with archive.open(info) as f:
        head = f.read(HEAD)
    kind = kind_of(info.filename, head)
    out = Member(info.filename, ignored, "workbook" if kind == "archive" else kind)
    if kind == "text":
        found = layout(signal, head)
        if found is None:
            raise FormatError(f"{signal}: {info.filename} has no header among its first {HEADER_LINES[signal]} lines")
        out.encoding, out.preamble, out.width, out.keep, out.quoted = found.encoding, found.preamble, len(found.columns), found.keep, found.quoted
        out.ignored_columns = [c for i, c in enumerate(found.columns) if i not in found.keep]
        out.blocks = _text_blocks(archive.open(info), found.preamble + 1, found.quoted)
        return out
    data = archive.read(info)
    if kind == "ole" and signal != DEMAND or kind not in ("ole", "workbook", "archive"):
        raise FormatError(f"{signal}: {info.filename} is a workbook of the old form")
    rows = sheet_rows(data) if signal == DISPATCH else demand_rows(data, kind)
    out.width = 3 if signal == DISPATCH else 2
    out.encoding, out.keep, out.blocks = None, tuple(range(out.width)), _row_blocks(rows)
    return out


def _text_blocks(stream, skip: int, quoted: bool = True) -> Iterator[bytes]:
    """Cut at line ends, in files with quotes at such as don't stand within them.

    Every byte is looked at once, and no more than two blocks are held.  A quote that
    isn't closed within a block is an error; in files whose first lines have none, a
    quote is a character like others.
    """
    for _ in range(skip):
        stream.readline()
    held, within = b"", False
    while some := stream.read(BLOCK):
        cut, end = 0, len(some)
        parts = some.split(b'"') if quoted else [some]
        within_at_end = within ^ (len(parts) % 2 == 0)
        inside = within_at_end
        for part in reversed(parts):  # from the last quote back to a line end outside
            if not inside and b"\n" in part:
                cut = end - len(part) + part.rfind(b"\n") + 1
                break
            inside, end = not inside, end - len(part) - 1
        if cut:
            yield held + some[:cut]
            held = some[cut:]
        elif len(held) + len(some) > 2 * BLOCK:
            raise FormatError("a line or a quoted field that doesn't end within a block")
        else:
            held += some
        within = within_at_end
    if within:
        raise FormatError("a quote that isn't closed")
    if held:
        yield held


def _row_blocks(rows: Iterator[tuple]) -> Iterator[bytes]:
    while some := [r for _, r in zip(range(BLOCK_ROWS), rows, strict=False)]:
        out = io.StringIO()
        csv.writer(out, lineterminator="\n").writerows(some)
        yield out.getvalue().encode()


def parse(data: bytes, encoding: str | None, width: int, keep: tuple[int, ...], quoted: bool = True) -> pa.Table:
    """The kept columns of a block as texts, by Arrow's reader; blocks with rows of other widths row by row: short rows are padded, longer ones an error. quoted: whether quotes enclose fields."""
    names = [str(i) for i in range(width)]
    text = data if encoding in (None, "ascii", "utf-8", "utf-8-sig") else data.decode(encoding).encode()
    try:
        read = arrow_csv.ReadOptions(column_names=names, use_threads=False, block_size=max(len(text), 1) + 1)
        typed = arrow_csv.ConvertOptions(column_types=dict.fromkeys(names, pa.string()), include_columns=[str(k) for k in keep], strings_can_be_null=False)
        return arrow_csv.read_csv(pa.BufferReader(text), read, arrow_csv.ParseOptions(quote_char='"' if quoted else False, newlines_in_values=quoted and b'"' in text), typed)
    except pa.ArrowInvalid as e:
        if "Empty CSV" in str(e):
            return pa.table({str(k): pa.array([], pa.string()) for k in keep})
    rows = [r for r in csv.reader(io.StringIO(text.decode(), newline=""), quoting=csv.QUOTE_MINIMAL if quoted else csv.QUOTE_NONE) if r]
    if any(len(r) > width for r in rows):
        raise FormatError(f"a row of {max(map(len, rows))} fields under a header of {width}")
    return pa.table({str(k): pa.array([r[k] if k < len(r) else None for r in rows], pa.string()) for k in keep})


def archives(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.zip").load(path)


def packed(lines: DataFrame, name: str, before: str = "", encoding: str = "utf-8") -> DataFrame:
    """Archives (path, content) of lines (path, line), each with one member of that name, which begins with ``before``.

    Lines go into the archive as they stream by, in the order of their paths: a task
    holds a batch of lines and one archive in its compressed form, never a whole text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = where = None

        def closed() -> pa.RecordBatch:
            out, archive, text = held
            text.close()
            archive.close()
            return pa.RecordBatch.from_arrays([pa.array([where], pa.string()), pa.array([out.getvalue()], pa.binary())], names=["path", "content"])

        for batch in batches:
            for path, some in groupby(zip(*(c.to_pylist() for c in batch.columns), strict=True), lambda r: r[0]):
                if held is None or path != where:
                    if held:
                        yield closed()
                    out, where = io.BytesIO(), path
                    archive = zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED)
                    info = zipfile.ZipInfo(name)
                    info.compress_type = zipfile.ZIP_DEFLATED
                    held = out, archive, archive.open(info, "w", force_zip64=True)
                    held[2].write(before.encode(encoding))
                held[2].write("".join(f"{line}\n" for _, line in some).encode(encoding))
        if held:
            yield closed()

    return lines.select("path", "line").repartition("path").sortWithinPartitions("path").mapInArrow(run, "path string, content binary")


def blocks(files: DataFrame, signal: str) -> DataFrame:
    """The texts of archives (path, content), in blocks, with how to read them."""
    schema = _arrow_schema(BLOCK_FIELDS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for where, content in zip(*batch.columns, strict=True):
                found = member(signal, content.as_buffer().to_pybytes())
                for n, data in enumerate(found.blocks):
                    row = [where.as_py(), found.name, found.encoding, found.preamble, n, found.width, list(found.keep), found.quoted, data]
                    yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(row, schema, strict=True)], schema=schema)

    return files.select("path", "content").mapInArrow(run, BLOCK_FIELDS)


def decode(spark: SparkSession, path: str, signal: str) -> DataFrame:
    """All archives below a folder as rows of texts."""
    return decoded(archives(spark, path), signal)


def decoded(files: DataFrame, signal: str) -> DataFrame:
    """Archives (path, content) as rows of texts, with where they came from; ordinal gives the order of a file's rows (its block * 2^32 + the row's place there)."""
    schema = _arrow_schema(FIELDS)

    def run(group: pa.Table) -> pa.Table:
        parts = []
        for block in group.to_pylist():
            made = parse(block["data"], block["encoding"], block["width"], tuple(block["keep"]), block["quoted"]).combine_chunks()
            n = len(made)
            known = [pa.repeat(pa.scalar(block[x], schema.field(x).type), n) for x in ("path", "member", "encoding", "preamble_rows")]
            ordinal = pa.array(range((block["block"] << 32), (block["block"] << 32) + n), pa.int64())
            columns = [c.combine_chunks() for c in made.columns] + [pa.nulls(n, pa.string())] * (3 - made.num_columns)
            parts += pa.Table.from_arrays([*known, ordinal, *columns], schema=schema).to_batches(max_chunksize=50_000)
        return pa.Table.from_batches(parts, schema)

    # a group is one block: mapInArrow would hold all blocks of a partition in one batch
    return blocks(files, signal).groupBy("path", "block").applyInArrow(run, FIELDS)


def _arrow_schema(fields: str) -> pa.Schema:
    from pyspark.sql import types as T
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(T._parse_datatype_string(fields))


def probe(spark: SparkSession, path: str, signal: str) -> DataFrame:
    return probed(archives(spark, path), signal)


def probed(files: DataFrame, signal: str) -> DataFrame:
    """A light look at each archive (path, content): member, kind, encoding, and what is wrong with it (a member whose checksum fails, or no member that fits); no row is parsed."""
    fields = "path string, bytes long, member string, format string, encoding string, problem string"
    schema = _arrow_schema(fields)

    def look(where: str, size: int, content: bytes) -> list:
        try:
            found, broken = member(signal, content), opened(content).testzip()
            return [where, size, found.name, found.kind, found.encoding, broken]
        except (FormatError, workbooks.WorkbookError, zipfile.BadZipFile, UnicodeError) as e:
            return [where, size, None, None, None, str(e)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [look(w.as_py(), n.as_py(), c.as_buffer().to_pybytes()) for w, n, c in zip(*batch.columns, strict=True)]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    return files.select("path", F.octet_length("content").cast("long"), "content").mapInArrow(run, fields)
