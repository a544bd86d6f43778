"""Where datasets lie, what raw files look like, references on pages."""

import os
from urllib.parse import urljoin

import pytest
from pyspark.sql import functions as F

from gridloom.functions import expressions as X
from gridloom.sources import locate

from .test_sources import archive, binary_workbook


def test_locator(spark, tmp_path, monkeypatch):
    os.makedirs(tmp_path / "a" / "b" / "grid")
    os.makedirs(tmp_path / "c" / ".hidden" / "grid")
    roots = [str(tmp_path / "a"), str(tmp_path / "c"), str(tmp_path / "nowhere")]
    monkeypatch.delenv(locate.VARIABLE, raising=False)
    assert locate.locate(spark, "grid", roots=roots).endswith("/a/b/grid")
    monkeypatch.setenv(locate.VARIABLE, str(tmp_path / "c"))
    assert locate.locate(spark, "grid", roots=roots) == str(tmp_path / "c")
    assert locate.locate(spark, "grid", str(tmp_path / "a"), roots) == str(tmp_path / "a")
    for bad in (dict(argument=str(tmp_path / "x")), dict(variable="NOT_SET_AT_ALL")):
        with pytest.raises(FileNotFoundError):
            locate.locate(spark, "elsewhere", roots=roots, **bad)
    os.makedirs(tmp_path / "c" / "d" / "grid")
    with pytest.raises(FileNotFoundError, match="more than once"):
        locate.locate(spark, "grid", roots=roots, variable="NOT_SET_AT_ALL")


def test_structure_of_raw_archives(spark):
    text = "a;b\tc\n1,2,3\n" + "x|y\n" * 9
    files = [("t", archive(a__txt=text.encode(), b__xls=binary_workbook([["TIME", "LF"], ["2030-01-01", 2.5]]), c__txt=b"\xff\xff\xff")), ("broken", b"PK no archive")]
    rows = {(r.path, r.member): r for r in locate.structure(spark.createDataFrame(files, "path string, content binary")).collect()}
    got = rows["t", "a.txt"]
    assert (got.kind, got.encoding, got.bytes, got.commas, got.tabs, got.semicolons, got.bars) == ("text", "ascii", len(text), 2, 1, 1, 3)
    assert got.preview == ["a;b\tc", "1,2,3", "x|y", "x|y", "x|y"]
    sheet = next(r for (_, m), r in rows.items() if m and m.startswith("b.xls: "))
    assert sheet.kind == "ole" and sheet.preview[0] == "TIME,LF" and sheet.preview[1].startswith("2030-01-01,2.5")
    assert rows["t", "c.txt"].problem and rows["broken", None].problem


def test_references_are_joined_as_browsers_do(spark):
    bases = ["http://h.example/a/b/c.html?x=1#f", "https://h.example", "https://h.example/", "http://h.example/one", "http://h.example/a/b/"]
    refs = ["d.zip", "./d", "../d", "../../d/./e", "/root?q=1", "//other.example/y", "?p=2", "#top", "", "mailto:x@y.example", "https://z.example/q", "d/..", "d/../e#f"]
    df = spark.createDataFrame([(b, r) for b in bases for r in refs], "b string, r string")
    for row in df.select("b", "r", X.url_join(df.b, df.r).alias("u")).collect():
        want = urljoin(row.b, row.r) if row.r else row.b.partition("#")[0]
        assert row.u == want, (row.b, row.r)
    assert spark.createDataFrame([("http://h/x", None)], "b string, r string").select(X.url_join(F.col("b"), F.col("r"))).first()[0] == "http://h/x"
