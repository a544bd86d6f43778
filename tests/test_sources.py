"""Decoding of archives, sinks and their round trips, incremental runs."""

import hashlib
import io
import json
import struct
import zipfile
from datetime import datetime

import pandas as pd
import pytest
from pyspark.sql import functions as F

from gridloom.operators import normalize
from gridloom.plans import files, scans
from gridloom.schema import DEMAND, DISPATCH, STATE, UNIFIED
from gridloom.sources import archives, readers, sinks, workbooks
from gridloom.streaming import collection, incremental

from .conftest import DATA
from .test_plans import plan


def archive(**members: bytes) -> bytes:
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, data in members.items():
            z.writestr(name.replace("__", "."), data)
    return out.getvalue()


def workbook(*sheets: list) -> bytes:
    """A workbook of inline texts and numbers."""
    main, rel = workbooks._MAIN[1:-1], workbooks._REL[1:-1]

    def cell(place, v):
        ref = f"{chr(65 + place[1])}{place[0] + 1}"
        return "" if v is None else f'<c r="{ref}" t="inlineStr"><is><t>{v}</t></is></c>' if isinstance(v, str) else f'<c r="{ref}"><v>{v}</v></c>'

    files = {
        "xl/workbook.xml": f'<workbook xmlns="{main}" xmlns:r="{rel}"><sheets>' + "".join(f'<sheet name="S{i}" sheetId="{i}" r:id="r{i}"/>' for i in range(len(sheets))) + "</sheets></workbook>",
        "xl/_rels/workbook.xml.rels": "<Relationships>" + "".join(f'<Relationship Id="r{i}" Target="worksheets/s{i}.xml"/>' for i in range(len(sheets))) + "</Relationships>",
    }
    for i, rows in enumerate(sheets):
        body = "".join(f'<row r="{r + 1}">' + "".join(cell((r, c), v) for c, v in enumerate(row)) + "</row>" for r, row in enumerate(rows))
        files[f"xl/worksheets/s{i}.xml"] = f'<worksheet xmlns="{main}"><sheetData>{body}</sheetData></worksheet>'
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, text in files.items():
            z.writestr(name, text)
    return out.getvalue()


def container(stream: bytes, sector: int = 512) -> bytes:
    """An OLE container of one stream, Workbook; below 4096 bytes it goes to the small sectors."""
    small = len(stream) < 4096
    content = stream.ljust(-(-len(stream) // 64) * 64, b"\0") if small else stream
    n = -(-len(content) // sector)
    # sectors: 0 the table, 1 the directory, 2 the table of small sectors, then the content
    chain = [0xFFFFFFFD, 0xFFFFFFFE, 0xFFFFFFFE, *range(4, 3 + n), 0xFFFFFFFE]
    assert len(chain) <= sector // 4
    minis = len(content) // 64 if small else 0
    follow = [*range(1, minis), 0xFFFFFFFE][: max(minis, 0)] if small else []

    def entry(name: str, kind: int, first: int, size: int) -> bytes:
        text = (name + "\0").encode("utf-16-le")
        return text.ljust(64, b"\0") + struct.pack("<HBB", len(text), kind, 1) + struct.pack("<III", *[0xFFFFFFFF] * 3) + bytes(36) + struct.pack("<II", first, size) + bytes(4)

    root = entry("Root Entry", 5, 3 if small else 0xFFFFFFFE, len(content) if small else 0)
    directory = (root + entry("Workbook", 2, 0 if small else 3, len(stream))).ljust(sector, b"\0")
    pack = lambda x: struct.pack(f"<{len(x)}I", *x).ljust(sector, b"\xff")
    header = archives.OLE_MAGIC + bytes(16) + struct.pack("<HHHHH", 0x3E, 3, 0xFFFE, 9, 6) + bytes(6) + struct.pack("<IIIIIIIII", 0, 1, 1, 0, 4096, 2, 1, 0xFFFFFFFE, 0) + struct.pack("<109I", 0, *[0xFFFFFFFF] * 108)
    return header + pack(chain) + directory + pack(follow) + content.ljust(n * sector, b"\0")


def binary_workbook(rows: list[list], packed: bool = False, cut: int | None = None, filler: int = 0) -> bytes:
    """A binary workbook of one sheet. packed: numbers as 30-bit ones.  cut: the table of texts goes on in another record after so many bytes of characters."""
    record = lambda kind, body: struct.pack("<HH", kind, len(body)) + body
    texts = list(dict.fromkeys(v for r in rows for v in r if isinstance(v, str)))
    table = struct.pack("<II", len(texts), len(texts))
    parts = [table]
    for t in texts:
        raw = t.encode("utf-16-le")
        head = struct.pack("<HB", len(t), 1)
        if cut and len(t) > cut:  # the second part in one byte a character, if it can be
            parts[-1] += head + raw[: 2 * cut]
            rest = t[cut:]
            parts.append(b"\0" + rest.encode("latin-1") if max(map(ord, rest)) < 256 else b"\1" + rest.encode("utf-16-le"))
        else:
            parts[-1] += head + raw
    shared = record(0xFC, parts[0]) + b"".join(record(0x3C, p) for p in parts[1:])
    bof, eof = record(0x809, struct.pack("<HH", 0x600, 5) + bytes(12)), record(0x0A, b"")
    cells = b""
    for r, row in enumerate(rows):
        for c, v in enumerate(row):
            at = struct.pack("<HHH", r, c, 0)
            if isinstance(v, str):
                cells += record(0xFD, at + struct.pack("<I", texts.index(v)))
            elif v is not None and packed:
                cells += record(0x27E, at + struct.pack("<I", (round(v * 100) & (1 << 30) - 1) << 2 | 3))
            elif v is not None:
                cells += record(0x203, at + struct.pack("<d", v))
    name = b"\x05\0Sheet"
    size = len(bof) + len(record(0x85, bytes(6) + name)) + len(shared) + len(eof)
    stream = bof + record(0x85, struct.pack("<IBB", size, 0, 0) + name) + shared + eof + bof + cells + record(0x1234, bytes(filler)) + eof
    return container(stream)


def read(signal: str, content: bytes) -> tuple[archives.Member, list[tuple]]:
    found = archives.member(signal, content)
    tables = [archives.parse(b, found.encoding, found.width, found.keep) for b in found.blocks]
    return found, [tuple(r.values()) for t in tables for r in t.to_pylist()]


def test_encodings():
    text = "제주,발전기 자료\n"
    assert [archives.encoding_of(x) for x in (b"TIME,A", text.encode("cp949"), text.encode(), b"\xef\xbb\xbf" + text.encode())] == ["ascii", "cp949", "utf-8", "utf-8-sig"]
    for name in ("cp949", "utf-8"):
        long = (text + "나" * 3000).encode(name)
        assert {archives.encoding_of(long[:n]) for n in range(4000, 4010)} == {name}
    with pytest.raises(archives.FormatError):
        archives.encoding_of(b"\xff\xff\xff")


def test_headers():
    text = "급전 자료, 참고\n\n단위, MW, 기준\n시간 , 발전기CODE,BASEPOINT\n2030-01-01,X7,1\n"
    found = archives.layout(DISPATCH, text.encode("cp949"))
    assert (found.encoding, found.preamble, found.keep) == ("cp949", 3, (0, 1, 2))
    assert archives.layout(DISPATCH, b'"TIME","GEN_CODE","BASEPOINT"\n').preamble == 0
    assert archives.places(DISPATCH, ["BASEPOINT", "x", "TIME", "gen code"]) == (2, 3, 0)
    assert archives.places(DISPATCH, ["TIME", "TIME", "GENCODE", "BASEPOINT"]) is None
    assert archives.places(STATE, ["시간", "발전기 CODE", "상태추정(MW)"]) == (0, 1, 2)
    assert archives.places(STATE, ["시간", "발전기 CODE", "BASEPOINT"]) is None and archives.places(STATE, ["시간", "발전기 CODE", "EST_MW", "x"]) is None
    assert archives.layout(DISPATCH, b"x,y\n" * 100 + b"TIME,GEN_CODE,BASEPOINT\n") is None
    with pytest.raises(archives.FormatError):
        archives.member(DISPATCH, archive(a__txt=b"x,y\n" * 101))


def test_wide_rows_short_rows_and_quotes():
    text = "시간,이름,발전기CODE,BASEPOINT,MIN,MAX\n2030-01-01,a,X7,1\n2030-01-01,b,X8,2,0,9\n\n"
    found, rows = read(DISPATCH, archive(d__txt=text.encode("cp949")))
    assert rows == [("2030-01-01", "X7", "1"), ("2030-01-01", "X8", "2")]
    assert found.ignored_columns == ["이름", "MIN", "MAX"]
    quoted = 'TIME,GEN_CODE,BASEPOINT\n2030-01-01,"X,\n""7""",1\n2030-01-02,,\n'
    assert read(DISPATCH, archive(d__txt=quoted.encode()))[1] == [("2030-01-01", 'X,\n"7"', "1"), ("2030-01-02", "", "")]
    with pytest.raises(archives.FormatError):
        read(DISPATCH, archive(d__txt=b"TIME,GEN_CODE,BASEPOINT\na,b,c,d\n"))
    assert read(DISPATCH, archive(d__txt=b"TIME,GEN_CODE,BASEPOINT\n"))[1] == [] == read(DISPATCH, archive(d__txt=b"TIME,GEN_CODE,BASEPOINT"))[1]


def test_blocks_hold_whole_rows(monkeypatch):
    monkeypatch.setattr(archives, "BLOCK", 50)
    body = [(f"2030-01-{d:02d}", f'G{d}"\n,' if d % 3 else f"G{d}", "1.5") for d in range(1, 29)]
    text = "TIME,GEN_CODE,BASEPOINT\n" + "".join(f'{a},"{b.replace(chr(34), chr(34) * 2)}",{c}\n' for a, b, c in body)
    content = archive(d__txt=text.strip().encode())
    assert len(list(archives.member(DISPATCH, content).blocks)) > 5 and read(DISPATCH, content)[1] == body


def test_workbook_blocks():
    one = [["안내"], [None, None, None], [None, "TIME", "GEN_CODE", "BASEPOINT"], [None, "2030-01-01 00:00:00", "X7", 1.5], [None, "total", "x", 9], [None, "2030-01-01 00:05:00", "X7", 2]]
    two = [["2030-01-01 00:10:00", "X8", 3], ["2030-01-01 00:15:00", "X8", 4]]
    _, rows = read(DISPATCH, archive(book__xlsx=workbook(one, two)))
    assert [r[1:] for r in rows] == [("X7", "1.5"), ("X7", "2"), ("X8", "3"), ("X8", "4")]
    with pytest.raises(archives.FormatError):
        list(archives.sheet_rows(workbook([["nothing"]])))
    assert read(DEMAND, archive(book__xlsx=workbook([["TIME", "LF"], ["2030-01-01", 7.25], [47484.5, 8]])))[1] == [("2030-01-01", "7.25"), ("2030-01-01 12:00:00", "8")]


@pytest.mark.parametrize("options", [{}, {"packed": True}, {"cut": 4}, {"filler": 5000}, {"filler": 5000, "cut": 7, "packed": True}])
def test_binary_workbooks(options):
    rows = [["TIME", "LF05_1 예측"], ["2030-01-01 00:05", 59000.5], ["2030-01-01 00:10", -12.25], [47484.5, 7], [None, None], ["2030-01-02 한글", None]]
    wanted = [("2030-01-01 00:05", "59000.5"), ("2030-01-01 00:10", "-12.25"), ("2030-01-01 12:00:00", "7"), ("2030-01-02 한글", None)]
    data = binary_workbook(rows, **options)
    assert [[v for v in r] for r in next(workbooks.ole_sheets(data))[1]][0] == rows[0]
    found, got = read(DEMAND, archive(demand__xlsx=data))
    assert found.kind == "ole" and [(a, b or None) for a, b in got] == wanted
    with pytest.raises(workbooks.WorkbookError):
        workbooks.ole_stream(data, ("Other",))


def test_texts_of_formulas_and_short_chains():
    record = lambda kind, body: struct.pack("<HH", kind, len(body)) + body
    cells = record(0x06, struct.pack("<HHH", 0, 0, 0) + b"\0" * 6 + b"\xff\xff" + bytes(8)) + record(0x207, struct.pack("<HB", 2, 0) + b"ab") + record(0x06, struct.pack("<HHHd", 0, 1, 0, 2.5) + bytes(8))
    cells += record(0xBD, struct.pack("<HHHIHIH", 0, 2, 0, 4 << 2 | 2, 0, 0x3FF00000, 3)) + record(0x204, struct.pack("<HHHHB", 1, 0, 0, 1, 0) + b"z")
    assert list(workbooks._ole_rows(cells + record(0x0A, b""), 0, [])) == [["ab", "2.5", "4", "1"], ["z"]]
    broken = bytearray(binary_workbook([["a"]], filler=5000))
    broken[512 + 4 * 4 : 512 + 4 * 4 + 4] = struct.pack("<I", 3)  # a chain that turns back
    with pytest.raises(workbooks.WorkbookError):
        workbooks.ole_stream(bytes(broken))


def test_member_selection():
    text = "시간,발전기CODE,상태추정MW\n2030-01-01,X7,1\n".encode("cp949")
    with archives.opened(archive(values__txt=text, other__zip=archive(x__txt=b"x"))) as z:
        info, ignored = archives.select_member(STATE, z)
    assert info.filename == "values.txt" and ignored == ["other.zip"]
    for content in (archive(a__txt=text, b__txt=text), archive(), archive(a__txt=b"\xff\xff", b__txt=b"x")):
        with archives.opened(content) as z, pytest.raises(archives.FormatError):
            archives.select_member(STATE, z)


def test_names_in_korean():
    name = "상태추정.txt"
    marked = archive(**{"상태추정__txt": b"x"})
    plain = marked.replace(name.encode(), name.encode("cp949").ljust(len(name.encode()), b"_"))
    for a, b in ((b"PK\x03\x04", 6), (b"PK\x01\x02", 8)):  # the mark of UTF-8 goes
        at = plain.index(a) + b
        plain = plain[: at + 1] + bytes([plain[at + 1] & ~8]) + plain[at + 2 :]
    assert [archives.opened(c).namelist()[0].rstrip("_") for c in (marked, plain)] == [name, name]


def test_decode_in_spark(spark, tmp_path):
    text = "시간,발전기CODE,상태추정MW\n2030-07-01 오전 12:05:00,Y1,1.5\n2030-07-01,Y2,\n"
    (tmp_path / "m1").mkdir()
    (tmp_path / "m1" / "a.zip").write_bytes(archive(s__txt=text.encode("cp949")))
    rows = archives.decode(spark, str(tmp_path), STATE)
    assert [(r.ordinal, r.encoding, r.preamble_rows) for r in rows.collect()] == [(0, "cp949", 0), (1, "cp949", 0)]
    table = normalize.normalize(STATE, rows.select("c0", "c1", "c2")).orderBy("timestamp").collect()
    assert [tuple(r) for r in table] == [(datetime(2030, 7, 1), "Y2", None), (datetime(2030, 7, 1, 0, 5), "Y1", 1.5)]
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "d.zip").write_bytes(archive(d__csv="안내\nTIME,LF05_1\n2030-07-01 00:05,59000.5\n".encode()))
    (tmp_path / "d" / "e.zip").write_bytes(archive(d__xls=binary_workbook([["TIME", "LF05_1"], ["2030-07-01 00:10", 59001]])))
    rows = archives.decode(spark, str(tmp_path / "d"), DEMAND)
    assert sorted(tuple(r) for r in normalize.normalize(DEMAND, rows.select("c0", "c1")).collect()) == [(datetime(2030, 7, 1, 0, 5), 59000.5), (datetime(2030, 7, 1, 0, 10), 59001.0)]
    (tmp_path / "m1" / "b.zip").write_bytes(b"no archive")
    found = {r.path.rsplit("/", 1)[-1]: r for r in archives.probe(spark, str(tmp_path / "m1"), STATE).collect()}
    assert (found["a.zip"].member, found["a.zip"].encoding, found["a.zip"].problem) == ("s.txt", "cp949", None)
    assert found["b.zip"].member is None and found["b.zip"].problem


def test_partitioned_round_trip(spark, tmp_path):
    u = scans.unified(spark, DATA)
    sinks.write_partitioned(u, str(tmp_path / "u"))
    back = readers.read_unified(spark, str(tmp_path / "u")).select(u.columns)
    assert back.exceptAll(u).count() == 0 and u.exceptAll(back).count() == 0
    assert readers.month_folders(spark.read.parquet(str(tmp_path / "u")), 1, 1).count() == u.count()


def test_csv_round_trip_and_slice(spark, tmp_path):
    u = scans.unified(spark, DATA)
    sinks.write_csv_typed(u, str(tmp_path / "c"))
    back = readers.read_csv(spark, str(tmp_path / "c"))
    assert back.schema.names == UNIFIED.names and back.exceptAll(u).count() == 0 and back.count() == u.count()
    seen = sinks.write_slice(u, str(tmp_path / "s"), "2024-01-05 00:00:00", "2024-01-06 00:00:00")
    kept = readers.read_csv(spark, str(tmp_path / "s"))
    assert sum(seen.values()) == kept.count() == u.where("timestamp >= '2024-01-05' AND timestamp < '2024-01-06'").count()
    odd = [(datetime(2030, 1, 1), "dispatch", v, 1.5) for v in ('a"b', "a,b", " a ", "é", "\\", "", "#x", None)]
    rows = u.limit(40).unionByName(spark.createDataFrame(odd, u.schema)).repartition(4)
    sinks.write_csv(rows, str(tmp_path / "t"))
    parts = [p.read_text().splitlines() for p in (tmp_path / "t").glob("part-*")]
    assert len(parts) == 4 and all(p[0] == normalize.CSV_HEADER and p.count(normalize.CSV_HEADER) == 1 for p in parts)
    assert sorted(x for p in parts for x in p[1:]) == sorted(r.value for r in normalize.csv_rows(rows).collect())
    back = readers.read_csv(spark, str(tmp_path / "t"))
    assert back.exceptAll(rows.replace("", None, "generator_id")).count() <= 1 and back.count() == 48 and readers.count_lines(spark, str(tmp_path / "t")) == 52


def test_months_as_csv_go_on_where_they_stopped(spark, tmp_path):
    u = scans.unified(spark, DATA)
    months = ["2023-12", "2024-01", "2024-02"]
    assert sinks.write_csv_months(u, str(tmp_path / "m"), months) == months
    (tmp_path / "m" / "month=2024-01" / "_SUCCESS").unlink()
    assert sinks.write_csv_months(u, str(tmp_path / "m"), months) == ["2024-01"]
    files = list((tmp_path / "m" / "month=2024-01").glob("part-*"))
    lines = files[0].read_text().splitlines()
    assert len(files) == 1 and lines.count(normalize.CSV_HEADER) == 1 and len(lines) == u.count() + 1 and lines[1:] == sorted(lines[1:], key=lambda x: x[:21])


def test_rows_as_dictionaries(spark, tmp_path):
    (tmp_path / "d.csv").write_text('a,b,c\n1,"x ""y"", z",\n ,NA,"two\nlines"\n')
    assert [r.asDict() for r in readers.read_dicts(spark, str(tmp_path / "d.csv")).collect()] == [{"a": "1", "b": 'x "y", z', "c": ""}, {"a": " ", "b": "NA", "c": "two\nlines"}]


def test_manifests_and_digests(spark, tmp_path):
    for m in ("2026-06", "2026-07"):
        (tmp_path / m).mkdir()
        (tmp_path / m / "manifest.json").write_text(json.dumps({"source": "demand", "month": m, "status": "success"}, indent=1))
    found = readers.read_manifests(spark, str(tmp_path), "source string, month string, status string, note string")
    assert sorted(r.month for r in found.collect()) == ["2026-06", "2026-07"]
    digest = readers.file_digests(spark, str(tmp_path / "2026-06")).first()
    assert digest.sha256 == hashlib.sha256((tmp_path / "2026-06" / "manifest.json").read_bytes()).hexdigest()
    files = spark.createDataFrame([("a", 2, 10, "x"), ("b", 3, 20, "y")], "name string, rows long, bytes long, sha256 string")
    sinks.write_manifest(files, str(tmp_path / "out"))
    r = spark.read.json(str(tmp_path / "out")).first()
    assert (r.n_files, r.total_rows, r.total_bytes) == (2, 5, 30)


def test_nanoseconds(spark, tmp_path):
    pdf = pd.DataFrame({"timestamp": pd.to_datetime(["2026-07-01 00:05:00", "1969-12-31 23:55:00", None]), "v": [1.0, 2.0, 3.0]}).astype({"timestamp": "datetime64[ns]"})
    import pyarrow as pa
    import pyarrow.parquet as pq

    pq.write_table(pa.Table.from_pandas(pdf), tmp_path / "n.parquet", version="2.6")
    got = [r.timestamp for r in readers.read_nanos(spark, str(tmp_path / "n.parquet")).orderBy("v").collect()]
    assert got == [datetime(2026, 7, 1, 0, 5), datetime(1969, 12, 31, 23, 55), None]


def test_incremental_runs_take_each_file_once(spark, tmp_path):
    u = scans.unified(spark, DATA).limit(50).coalesce(1)
    source, out, mark = (str(tmp_path / x) for x in ("in", "out", "mark"))
    u.write.parquet(source)
    nullable = spark.read.parquet(source).schema
    for expected in (50, 50, 100):
        if expected == 100:
            u.write.mode("append").parquet(source)
        incremental.run_available(incremental.new_files(spark, source, nullable), out, mark)
        assert spark.read.parquet(out).count() == expected
    totals = incremental.slot_totals(incremental.new_files(spark, source, nullable), "value_mw")
    assert totals.isStreaming and totals.columns == ["slot", "source", "total_mw", "n"]
    assert u.agg(F.count("*")).first()[0] == 50


def test_retries_wait_longer_each_time():
    waited, failures = [], iter([OSError("a"), OSError("b")])

    def action():
        if error := next(failures, None):
            raise error
        return "done"

    assert collection.with_retries(action, wait=0.5, sleep=waited.append) == ("done", 2) and waited == [0.5, 1.0]
    with pytest.raises(OSError):
        collection.with_retries(lambda: (_ for _ in ()).throw(OSError("x")), attempts=2, sleep=waited.append)
    with pytest.raises(KeyError):
        collection.with_retries(lambda: {}["x"], sleep=waited.append)
    with pytest.raises(ValueError):
        collection.with_retries(lambda: 1, attempts=0)


def test_what_is_to_be_fetched(spark):
    manifest = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", "3"), ("d", None)], "name string, sha256 string")
    files = spark.createDataFrame([("a", "1"), ("b", "9"), ("d", "4"), ("e", "5")], "name string, sha256 string")
    got = {r.name: (r.action, r.fetch) for r in collection.to_fetch(manifest, files).collect()}
    assert got == {"a": ("skip", False), "b": ("changed", True), "c": ("missing", True), "d": ("changed", True)}
    assert collection.to_fetch(manifest, files.limit(0)).where("fetch").count() == 4


def test_small_files_and_release_tables(spark, tmp_path):
    at = str(tmp_path / "m" / "manifest.json")
    for n in (1, 2):
        sinks.write_json(spark, at, {"n": n, "text": "é"})
    assert json.loads((tmp_path / "m" / "manifest.json").read_text()) == {"n": 2, "text": "é"} and not list((tmp_path / "m").glob("*.part"))
    u = scans.unified(spark, DATA)
    sinks.write_single(u, str(tmp_path / "u"))
    made = sinks.release_table(spark, "release_of_a_test", str(tmp_path / "u"))
    assert made.count() == u.count()
    spark.sql("DROP TABLE release_of_a_test")
    assert spark.read.parquet(str(tmp_path / "u")).count() == u.count()


def test_nanos_leave_the_session_alone(spark, tmp_path):
    test_nanoseconds(spark, tmp_path)
    assert spark.conf.get("spark.sql.legacy.parquet.nanosAsLong", "false") == "false"


def test_lines_go_into_archives_as_they_stream_by(spark):
    """Archives begin and end within batches and go on over them; no text is put together, and blocks are decoded one by one."""
    rows = [(p, f"2024-01-01 오전 1:{i % 60:02d}:00,IJ{i},{i}.5") for p in ("b", "a", None) for i in range(7)] + [("c", "2024-01-01 오후 1:00:00,IJ9,1.0")]
    df = spark.createDataFrame(rows, "path string, line string").repartition(4)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 3)
    try:
        made = archives.packed(df, "m.txt", "자료\n시간,발전기CODE,상태추정MW\n", "cp949")
        found = made.collect()
        decoded = archives.decoded(made, STATE)
        back = decoded.collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted(str(r.path) for r in found) == ["None", "a", "b", "c"]
    for r in found:
        text = archives.opened(bytes(r.content)).read("m.txt").decode("cp949")
        assert text.startswith("자료\n시간,") and sorted(text.splitlines()[2:]) == sorted(x for p, x in rows if p == r.path)
    assert sorted((str(r.path), f"{r.c0},{r.c1},{r.c2}") for r in back) == sorted((str(p), x) for p, x in rows)
    said = plan(decoded)
    assert "FlatMapGroupsInArrow" in said and "collect_list" not in plan(files.s01_state_archives(spark, DATA))
