"""Archives as a data source and in SQL, footers and row groups, manifests against files, exports that go on after a failure."""

import glob
import hashlib
import io
import os
import time
import zipfile
from datetime import datetime, timedelta

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from gridloom.operators import physical
from gridloom.schema import DISPATCH, UNIFIED
from gridloom.sources import archive_source, archives, export, footers, storage

from .test_sources import archive

START = datetime(2031, 5, 30, 22)
HEAD = "TIME,GEN_CODE,BASEPOINT\n"


def text_of(n: int, first: int = 0) -> str:
    return HEAD + "".join(f"2031-05-01 00:{i % 60:02d}:00,G{first + i},{i}.5\n" for i in range(n))


# ---- the decoder and quotes


def blocks_of(text: str, quoted: bool = True) -> list[bytes]:
    return list(archives._text_blocks(io.BytesIO(text.encode()), 0, quoted))


def test_blocks_end_outside_quotes(monkeypatch):
    monkeypatch.setattr(archives, "BLOCK", 40)
    rows = [f'a{i},"x{i}\ny""{i}",z\n' if i % 3 else f"b{i},plain,z\n" for i in range(60)]
    made = blocks_of("".join(rows))
    assert b"".join(made) == "".join(rows).encode() and len(made) > 20
    assert all(b.count(b'"') % 2 == 0 for b in made)


def test_stray_quotes_take_linear_time_or_fail(monkeypatch):
    with pytest.raises(archives.FormatError, match="quote"):
        blocks_of('a,"b\n' + "c,d\n" * 20_000)
    monkeypatch.setattr(archives, "BLOCK", 1 << 12)
    with pytest.raises(archives.FormatError, match="doesn't end"):
        blocks_of('a,"b\n' + "c,d\n" * 20_000)
    took = []
    for n in (50_000, 200_000):
        began = time.process_time()
        assert b"".join(blocks_of("a,b\n" * n + 'x,"\n' + 'y,"\n' + "c,d\n" * n, True))
        took.append(time.process_time() - began)
    assert took[1] < 12 * took[0] + 0.2


def test_a_quote_is_a_character_where_the_first_lines_have_none(spark):
    text = text_of(20_000) + '2031-05-01 00:00:00,G"7,1.5\n' + text_of(3)[len(HEAD) :]
    found = archives.member(DISPATCH, archive(a__txt=text.encode()))
    assert not found.quoted
    rows = [r for b in found.blocks for r in archives.parse(b, found.encoding, found.width, found.keep, found.quoted).to_pylist()]
    assert len(rows) == 20_004 and rows[20_000]["1"] == 'G"7'


# ---- the data source


@pytest.fixture
def folder(tmp_path):
    """Two months of dispatch; a third month's archive can't be opened."""
    os.makedirs(tmp_path / "in" / DISPATCH)
    for month, first in (("2031-05", 0), ("2031-06", 1000)):
        (tmp_path / "in" / DISPATCH / f"data_{month}.zip").write_bytes(archive(a__txt=text_of(500, first).encode()))
    (tmp_path / "in" / DISPATCH / "data_2031-07.zip").write_bytes(b"PK not an archive")
    return str(tmp_path / "in")


def test_filters_choose_the_archives_that_are_opened(spark, folder):
    data = archive_source.load(spark, folder)
    may = data.where("month = '2031-05' AND signal = 'dispatch'")
    assert may.count() == 500 and may.select("month", "member").distinct().collect() == [("2031-05", "a.txt")]
    assert data.where("month < '2031-07'").count() == 1000 and data.where("month IN ('2031-06')").select(F.min("c1")).first()[0] == "G1000"
    assert data.where("signal = 'demand'").count() == 0
    with pytest.raises(Exception, match="zip|Zip"):
        data.count()
    reader = archive_source.Reader({"path": folder})
    from pyspark.sql.datasource import EqualTo, GreaterThan

    left = list(reader.pushFilters([EqualTo(("month",), "2031-05"), GreaterThan(("c2",), "1")]))
    assert [f.attribute for f in left] == [("c2",)] and [p.month for p in reader.partitions()] == ["2031-05"]


def test_partitions_of_one_archive_have_each_row_once(spark, folder, monkeypatch):
    monkeypatch.setattr(archives, "BLOCK", 1 << 10)
    path = f"{folder}/{DISPATCH}/data_2031-05.zip"
    parts = archive_source.parts_of(path, os.path.getsize(path), DISPATCH, None, 300)
    each = [[r for b in archive_source.rows_of(p) for r in b.to_pylist()] for p in parts]
    assert len(parts) > 2 and sum(map(bool, each)) > 2
    rows = sorted((r["ordinal"], r["c1"]) for e in each for r in e)
    assert [c for _, c in rows] == [f"G{i}" for i in range(500)] and len({o for o, _ in rows}) == 500


def test_month_and_signal_of_names():
    told = archive_source.described
    assert told("/x/dispatch/power_202405.zip", None) == ("dispatch", "2024-05") and told("/x/y/2024-05-06.zip", "demand") == ("demand", "2024-05")
    assert told("/x/y/part20240x.zip", None) == (None, None)


def test_a_stream_takes_each_archive_once(spark, tmp_path):
    archive_source.register(spark)
    source, out, mark = (str(tmp_path / n) for n in ("in/dispatch", "out", "mark"))
    os.makedirs(source)

    def run():
        rows = spark.readStream.format(archive_source.NAME).load(str(tmp_path / "in"))
        query = rows.writeStream.format("parquet").option("path", out).option("checkpointLocation", mark).trigger(once=True).start()
        query.awaitTermination(120)
        return spark.read.parquet(out).count()

    for i, total in ((0, 50), (1, 100)):
        with open(f"{source}/data_2031-0{i + 5}.zip", "wb") as f:
            f.write(archive(a__txt=text_of(50, 100 * i).encode()))
        os.utime(f"{source}/data_2031-0{i + 5}.zip", (1000 + i, 1000 + i))
        assert run() == total
    assert run() == 100


def test_table_function(spark, folder):
    archive_source.register_function(spark)
    archives.archives(spark, f"{folder}/{DISPATCH}").where("path NOT LIKE '%2031-07%'").createOrReplaceTempView("some_archives")
    rows = spark.sql("SELECT member, count(*) AS n, min(c1) AS least FROM signal_rows(TABLE(SELECT path, content, 'dispatch' AS signal FROM some_archives)) GROUP BY path, member")
    assert sorted(tuple(r) for r in rows.collect()) == [("a.txt", 500, "G0"), ("a.txt", 500, "G1000")]


# ---- footers and row groups


def test_row_groups_are_skipped_by_their_statistics(spark, tmp_path):
    for k in range(3):
        n = [1000 * k + i for i in range(1000)]
        pq.write_table(pa.table({"k": n, "t": [START + timedelta(minutes=x) for x in n], "s": [f"s{x}" for x in n], "v": [None if x % 10 else float(x) for x in n]}), tmp_path / f"p{k}.parquet", row_group_size=100)
    (tmp_path / "cut.parquet").write_bytes(b"PAR1 cut")
    good = footers.row_groups(footers.files(spark, str(tmp_path), "p*.parquet"))
    assert good.count() == 30 and tuple(footers.summed(good, "v").first()) == (3000, 0.0, 2990.0, 2700)
    assert tuple(footers.summed(good, "s").first()) == (3000, None, None, 0)
    assert footers.chosen(good, "k", 950, 1149).count() == 3
    at = footers.number(START + timedelta(minutes=205))
    assert [tuple(r) for r in footers.chosen(good, "t", at, at).select(F.element_at(F.split("path", "/"), -1), "row_group").collect()] == [("p0.parquet", 2)]
    bad = footers.row_groups(footers.files(spark, str(tmp_path), "cut.parquet")).first()
    assert bad.row_group == -1 and bad.problem.startswith("unreadable")
    rows = footers.scan(spark, str(tmp_path / "p*.parquet"), ["s", "k"], "k", 950, 1149, batch_rows=7)
    assert rows.columns == ["s", "k"] and rows.count() == 300 and rows.where("k BETWEEN 950 AND 1149").count() == 200
    assert footers.scan(spark, str(tmp_path / "p0.parquet"), ["v"]).where("v IS NULL").count() == 900


def test_problems_are_named(spark, tmp_path):
    manifest = []
    for name in ("kept", "missing", "cut", "changed", "other"):
        table = pa.table({"k": [1, 2, 3], "v": [1.0, 2.0, None]})
        pq.write_table(table, tmp_path / f"{name}.parquet")
        size, sha = storage.digest(str(tmp_path / f"{name}.parquet"))
        manifest.append((f"{name}.parquet", size, sha, 3, "k int64; v double"))
    content = (tmp_path / "cut.parquet").read_bytes()
    (tmp_path / "cut.parquet").write_bytes(content[:-4])
    (tmp_path / "changed.parquet").write_bytes(content[:5] + b"\xff" + content[6:])
    pq.write_table(pa.table({"k": [1, 2], "v": ["a", "b"]}), tmp_path / "other.parquet")
    os.remove(tmp_path / "missing.parquet")
    os.makedirs(tmp_path / "deep")
    for name in ("deep/extra.txt", "kept.parquet.part"):
        (tmp_path / name).write_bytes(b"x")
    listed = spark.createDataFrame([*manifest, ("loose.txt", None, None, None, None)], "name string, bytes long, sha256 string, rows long, schema string")
    found = physical.inventory(spark, str(tmp_path))
    got = sorted((r.name, r.problem) for r in physical.problems(listed, found).collect())
    assert got == sorted(
        [("missing.parquet", "missing"), ("loose.txt", "missing"), ("cut.parquet", "size"), ("cut.parquet", "digest"), ("cut.parquet", "unreadable"), ("changed.parquet", "digest"),
         ("other.parquet", "size"), ("other.parquet", "digest"), ("other.parquet", "rows"), ("other.parquet", "schema"), ("deep/extra.txt", "unexpected"), ("kept.parquet.part", "left over")]
    )


# ---- the export


def history(spark, n=3000):
    rows = [(START + timedelta(minutes=5 * (i * 7919 % n)), ("demand", "dispatch")[i % 2], None if i % 2 == 0 else f'g"{i % 9}', None if i % 11 == 0 else i / 4) for i in range(n)]
    nullable = "timestamp timestamp_ntz, source string, generator_id string, value_mw double"
    return spark.createDataFrame([*rows, (None, "demand", None, 1.0)], nullable).repartition(4)


def content(path):
    return b"".join(open(f, "rb").read() for f in sorted(glob.glob(f"{path}/part-*.csv")))


def test_an_export_goes_on_after_a_failure(spark, tmp_path):
    u = history(spark)
    assert [f.name for f in UNIFIED] == u.columns
    whole, again = str(tmp_path / "whole"), str(tmp_path / "again")
    records = export.export(u, whole, 12).collect()
    lines = content(whole).decode().splitlines()
    assert len(lines) == 3000 and [x[1:20] for x in lines] == sorted(x[1:20] for x in lines)
    assert [r.batch for r in records] == sorted(r.batch for r in records) and sum(r.rows for r in records) == 3000 and len(records) > 8
    for r in records:
        data = open(f"{whole}/{r.name}", "rb").read()
        assert (r.bytes, r.sha256, r.rows) == (len(data), hashlib.sha256(data).hexdigest(), data.count(b"\n")) and sum(r.by_source.values()) == r.rows
    stop = START + timedelta(minutes=5 * 1500)
    broken = u.withColumn("generator_id", F.when(F.col("timestamp") >= F.lit(stop), F.raise_error(F.lit("cut off"))).otherwise(F.col("generator_id")))
    with pytest.raises(Exception, match="cut off"):
        export.export(broken, again, 12)
    part_way = {r.batch for r in export.finished(spark, again).collect()}
    assert len(part_way) < len(records)
    before = {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{again}/part-*.csv") if int(f[-10:-4]) in part_way}
    export.export(u, again, 99)  # the recorded cuts hold
    assert content(again) == content(whole) and {f: os.stat(f).st_mtime_ns for f in before} == before
    assert export.finished(spark, again).drop("x").collect() == records
    assert not glob.glob(f"{again}/**/*.part", recursive=True) or part_way  # a broken attempt may leave its own
    nothing = export.export(u.limit(0), str(tmp_path / "none"), 3)
    assert nothing.count() == 0


def test_archives_are_closed_forms(tmp_path):
    """A file is there whole or not at all."""
    out = storage.Hashed(str(tmp_path / "a" / "b.txt"), "7")
    out.write(b"12")
    assert not (tmp_path / "a" / "b.txt").exists()
    assert out.close() == (2, hashlib.sha256(b"12").hexdigest()) and (tmp_path / "a" / "b.txt").read_bytes() == b"12"
    assert zipfile.is_zipfile(io.BytesIO(archive(a__txt=b"x")))
