"""Rows of cell texts out of workbooks: zipped XML, and the older binary form in an OLE container.

Both give (sheet name, rows); a cell is a text, or None. Numbers are written so that they read back the same.
"""

from __future__ import annotations

import io
import re
import struct
import zipfile
from collections.abc import Iterator
from datetime import datetime, timedelta
from xml.etree import ElementTree

Sheet = tuple[str, Iterator[list[str | None]]]
_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
# Fixed values of the binary form: record numbers, and sector numbers that end a chain.
CONTINUE, BOUNDSHEET, SST, DATEMODE, EOF = 0x3C, 0x85, 0xFC, 0x22, 0x0A
LABELSST, LABEL, NUMBER, RK, MULRK, FORMULA, STRING = 0xFD, 0x204, 0x203, 0x27E, 0xBD, 0x06, 0x207
_NO_MORE = 0xFFFFFFFA


class WorkbookError(RuntimeError):
    pass


def serial_text(serial: float, since_1904: bool = False) -> str:
    """A day number as text, to the second."""
    start = datetime(1904, 1, 1) if since_1904 else datetime(1899, 12, 30)
    return str(start + timedelta(seconds=round(serial * 86_400)))


def number_text(value: float) -> str:
    return str(int(value)) if value == int(value) and abs(value) < 1e15 else repr(value)


# ---- zipped XML


def xml_sheets(data: bytes) -> Iterator[Sheet]:
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        texts = []
        if "xl/sharedStrings.xml" in z.namelist():
            texts = ["".join(t.text or "" for t in item.iter(f"{_MAIN}t")) for item in ElementTree.fromstring(z.read("xl/sharedStrings.xml")).iter(f"{_MAIN}si")]
        places = {r.get("Id"): r.get("Target").lstrip("/") for r in ElementTree.fromstring(z.read("xl/_rels/workbook.xml.rels"))}
        for sheet in ElementTree.fromstring(z.read("xl/workbook.xml")).iter(f"{_MAIN}sheet"):
            place = places[sheet.get(f"{_REL}id")]
            yield sheet.get("name"), _xml_rows(z, place if place.startswith("xl/") else f"xl/{place}", texts)


def _xml_rows(z: zipfile.ZipFile, place: str, texts: list[str]) -> Iterator[list[str | None]]:
    with z.open(place) as f:
        for _, row in ElementTree.iterparse(f):
            if row.tag == f"{_MAIN}row":
                cells: dict[int, str] = {}
                for c in row.iter(f"{_MAIN}c"):
                    letters = re.match("[A-Z]*", c.get("r", ""))[0]
                    at = sum((ord(x) - 64) * 26**i for i, x in enumerate(reversed(letters))) - 1 if letters else len(cells)
                    said = "".join(t.text or "" for t in c.iter(f"{_MAIN}t")) if c.get("t") == "inlineStr" else c.findtext(f"{_MAIN}v")
                    if said is not None:
                        cells[at] = texts[int(said)] if c.get("t") == "s" else said
                yield [cells.get(i) for i in range(max(cells, default=-1) + 1)]
                row.clear()


# ---- the OLE container and its records


def ole_stream(data: bytes, names: tuple[str, ...] = ("Workbook", "Book")) -> bytes:
    """The first stream of one of these names."""
    sector, mini = 1 << struct.unpack_from("<H", data, 30)[0], 1 << struct.unpack_from("<H", data, 32)[0]
    first_dir, cutoff, first_mini_table = struct.unpack_from("<I", data, 48)[0], *struct.unpack_from("<II", data, 56)
    tables, more = list(struct.unpack_from("<109I", data, 76)), struct.unpack_from("<I", data, 68)[0]

    def at(n: int) -> bytes:
        return data[(n + 1) * sector : (n + 2) * sector]

    while more < _NO_MORE:
        *listed, more = struct.unpack(f"<{sector // 4}I", at(more))
        tables += listed
    joined = b"".join(at(n) for n in tables if n < _NO_MORE)
    after = struct.unpack(f"<{len(joined) // 4}I", joined)

    def chain(n: int, follow: tuple[int, ...]) -> Iterator[int]:
        for _ in range(len(follow) + 1):
            if n >= _NO_MORE:
                return
            if n >= len(follow):
                break
            yield n
            n = follow[n]
        raise WorkbookError("a chain of sectors is broken")

    entries = b"".join(at(n) for n in chain(first_dir, after))
    listed = {}
    for i in range(0, len(entries) - 127, 128):
        e = entries[i : i + 128]
        name = e[: max(struct.unpack_from("<H", e, 64)[0] - 2, 0)].decode("utf-16-le")
        listed.setdefault(name, (*struct.unpack_from("<I", e, 116), struct.unpack_from("<I", e, 120)[0], e[66]))
    found = next((listed[n] for n in names if n in listed), None)
    if found is None:
        raise WorkbookError("the container holds no workbook")
    first, size, _ = found
    if size >= cutoff:
        return b"".join(at(n) for n in chain(first, after))[:size]
    root = next(x for x in listed.values() if x[2] == 5)
    small = b"".join(at(n) for n in chain(root[0], after))
    table = b"".join(at(n) for n in chain(first_mini_table, after))
    follow = struct.unpack(f"<{len(table) // 4}I", table)
    return b"".join(small[n * mini : (n + 1) * mini] for n in chain(first, follow))[:size]


def _records(stream: bytes, at: int = 0) -> Iterator[tuple[int, list[bytes]]]:
    """Records from a place on, each with the parts that continue it."""
    held: tuple[int, list[bytes]] | None = None
    while at + 4 <= len(stream):
        kind, size = struct.unpack_from("<HH", stream, at)
        body, at = stream[at + 4 : at + 4 + size], at + 4 + size
        if kind == CONTINUE and held:
            held[1].append(body)
            continue
        if held:
            yield held
        held = kind, [body]
        if kind == EOF:
            break
    if held:
        yield held


class _Strings:
    """Strings over the parts of a record; within one, characters may change their width where a part begins."""

    def __init__(self, parts: list[bytes], skip: int):
        self.parts, self.part, self.at = parts, 0, skip

    def take(self, size: int) -> bytes:
        out = b""
        while len(out) < size:
            if self.at >= len(self.parts[self.part]):
                self.part, self.at = self.part + 1, 0
                if self.part >= len(self.parts):
                    raise WorkbookError("a string is cut short")
            some = self.parts[self.part][self.at : self.at + size - len(out)]
            out, self.at = out + some, self.at + len(some)
        return out

    def next(self, counted: str = "<H") -> str:
        left = struct.unpack(counted, self.take(struct.calcsize(counted)))[0]
        flags = self.take(1)[0]
        runs = struct.unpack("<H", self.take(2))[0] if flags & 8 else 0
        extra = struct.unpack("<I", self.take(4))[0] if flags & 4 else 0
        out = ""
        while left:
            if self.at >= len(self.parts[self.part]):
                self.part, self.at = self.part + 1, 0
                flags = self.take(1)[0]
            width = 2 if flags & 1 else 1
            n = min(left, (len(self.parts[self.part]) - self.at) // width)
            out += self.take(n * width).decode("utf-16-le" if width == 2 else "latin-1")
            left -= n
        self.take(4 * runs + extra)
        return out


def _packed(bits: int) -> float:
    """A number in 30 bits: whole or the upper part of a double, and perhaps in hundredths."""
    value = float(bits >> 2 if not bits & 1 << 31 else (bits >> 2) - (1 << 30)) if bits & 2 else struct.unpack("<d", struct.pack("<Q", (bits & 0xFFFFFFFC) << 32))[0]
    return value / 100 if bits & 1 else value


def ole_sheets(data: bytes) -> Iterator[Sheet]:
    stream = ole_stream(data)
    texts: list[str] = []
    listed: list[tuple[str, int]] = []
    for kind, parts in _records(stream):
        if kind == BOUNDSHEET and parts[0][5] == 0:
            listed.append((_Strings(parts, 6).next("<B"), struct.unpack_from("<I", parts[0])[0]))
        elif kind == SST:
            read = _Strings(parts, 8)
            texts += [read.next() for _ in range(struct.unpack_from("<I", parts[0], 4)[0])]
    for name, at in listed:
        yield name, _ole_rows(stream, at, texts)


def ole_since_1904(data: bytes) -> bool:
    return any(kind == DATEMODE and parts[0][:1] == b"\x01" for kind, parts in _records(ole_stream(data)))


def _ole_cells(stream: bytes, at: int, texts: list[str]) -> Iterator[tuple[int, int, str]]:
    said = None  # the cell whose formula's text comes next
    for kind, parts in _records(stream, at):
        body = parts[0]
        if kind == STRING and said:
            yield *said, _Strings(parts, 0).next()
        if kind not in (LABELSST, LABEL, NUMBER, RK, MULRK, FORMULA):
            continue
        row, column = struct.unpack_from("<HH", body)
        said = None
        if kind == LABELSST:
            yield row, column, texts[struct.unpack_from("<I", body, 6)[0]]
        elif kind == LABEL:
            yield row, column, _Strings(parts, 6).next()
        elif kind == NUMBER:
            yield row, column, number_text(struct.unpack_from("<d", body, 6)[0])
        elif kind == RK:
            yield row, column, number_text(_packed(struct.unpack_from("<I", body, 6)[0]))
        elif kind == MULRK:
            for i in range((len(body) - 6) // 6):
                yield row, column + i, number_text(_packed(struct.unpack_from("<I", body, 6 + 6 * i)[0]))
        elif body[12:14] != b"\xff\xff":
            yield row, column, number_text(struct.unpack_from("<d", body, 6)[0])
        elif body[6] == 0:
            said = row, column


def _ole_rows(stream: bytes, at: int, texts: list[str]) -> Iterator[list[str | None]]:
    now, cells = None, {}
    for row, column, said in _ole_cells(stream, at, texts):
        if now is not None and row != now:
            yield [cells.get(i) for i in range(max(cells) + 1)]
            cells = {}
        now, cells[column] = row, said
    if cells:
        yield [cells.get(i) for i in range(max(cells) + 1)]
