"""Runs against comparing every word with those before it; factors against their definition; edges; SQL."""

import hashlib
import random

import pytest

from gridloom.llm import periodic, queries

from ..conftest import DATA, agrees
from .helpers import CLASHES, crc32, documents, empty


def plain(w, least, times=3):
    """Runs by comparing the words of each distance."""
    n, found = len(w), {}
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            if w[i] == w[i + q]:
                j = i
                while j + q < n and w[j] == w[j + q]:
                    j += 1
                if j + q - i >= max(least, times * q):
                    found.setdefault((i, j + q), q)
                i = j
            i += 1
    return sorted((s, e, q) for (s, e), q in found.items())


def sequences(count, seed):
    rng = random.Random(seed)
    for _ in range(count):
        n, letters = rng.randint(0, 90), rng.choice([1, 2, 2, 3, 5])
        w = [rng.randrange(letters) for _ in range(n)]
        if n and rng.random() < 0.5:
            a, p = rng.randrange(n), rng.randint(1, 12)
            w = [w[i] if i < a else w[min(n - 1, a + (i - a) % p)] for i in range(n)]
        if rng.random() < 0.3:
            w = w + w[: rng.randint(0, n)] + w
        yield rng.choice([3, 4, 6, 9, 24]), w


def test_runs_are_those_of_comparing_all():
    for least, w in sequences(3000, 1):
        assert periodic.runs_of(w, least) == plain(w, least), (w, least)


def test_nested_and_copied_runs():
    inner = ([0, 1] * 15 + [2, 3, 4]) * 5
    assert periodic.runs_of(inner) == plain(inner, 24)
    words = [0]
    following = [0, 1]
    while len(following) < 1200:
        words, following = following, following + words  # Fibonacci words have runs of many periods
    assert periodic.runs_of(following) == plain(following, 24)


def test_factors_are_the_longest_that_occur_before():
    for _, w in sequences(400, 2):
        at = 0
        for begin, size, source in periodic.factors(w):
            assert begin == at
            occurs = [s for s in range(at) if w[s : s + size] == w[at : at + size]]
            assert (source < 0 and size == 1 and not occurs) or source in occurs
            assert at + size == len(w) or source < 0 or not any(w[s : s + size + 1] == w[at : at + size + 1] for s in range(at))
            at += size
        assert at == len(w)


def test_texts_are_cut_only_where_no_run_passes():
    many = list(sequences(600, 3))
    texts = [" ".join(f"w{x}" for x in w).encode() for _, w in many]
    for least in (3, 9, 24):
        n, runs, _ = periodic.analysed(texts, least)
        for (_, w), count, found in zip(many, n.tolist(), runs, strict=True):
            assert count == len(w) and [(r["start"], r["start"] + r["length"], r["period"]) for r in found] == plain(w, least)


def test_prose_reaches_no_automaton(monkeypatch):
    rng = random.Random(5)
    some = [f"word{rng.randrange(900)}" for _ in range(5000)]
    prose = " ".join([*some, *some[:2000]])  # a passage that comes twice isn't periodic
    monkeypatch.setattr(periodic, "runs_of", lambda *a: pytest.fail("nothing here comes three times in a row"))
    assert periodic.analysed([prose.encode()])[1] == [[]]


def test_edges(spark):
    twice = "one two three four " * 2_000
    texts = ["", None, "a few plain words", twice, "x " * 23, "x\t" * 24, "Ünïcode 中文 " * 12, twice]
    rows = {r.doc_id: r for r in periodic.find_runs(documents(spark, texts, CLASHES | {"runs": 1, "collapsed": "x"})).collect()}
    assert [rows[i].n_words for i in range(8)] == [0, 0, 4, 8000, 23, 24, 24, 8000]
    assert [[tuple(x) for x in rows[i].runs] for i in range(8)] == [[], [], [], [(0, 8000, 4)], [], [(0, 24, 1)], [(0, 24, 2)], [(0, 8000, 4)]]
    assert [rows[i].collapsed for i in (0, 1, 3, 4, 5, 6)] == ["", "", "one two three four", " ".join("x" * 23), "x", "Ünïcode 中文"]
    assert rows[3].score == "x"
    assert periodic.digest(periodic.find_runs(empty(spark), periodic.planted)).count() == 0
    null = spark.createDataFrame([(None, twice), (None, None)], "doc_id long, text string")
    assert sorted(r.n_runs for r in periodic.digest(periodic.find_runs(null, periodic.planted)).collect()) == [0, 1]


def test_digest(spark):
    texts = [" ".join(str(j % (3 + i % 4)) if j % 90 < 60 else f"{j}" for j in range(40 * i)) for i in range(40)]
    for r in periodic.digest(periodic.find_runs(documents(spark, texts), periodic.planted)).collect():
        words, h = texts[r.doc_id].split(), crc32(r.doc_id)
        if h % 10 == 0 and words:
            a = h // 10 % len(words)
            p = 1 + (len(words) - a) // (3 + h // 10 % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        runs = plain(words, 24)
        gone = {i for s, e, p in runs for i in range(s + p, e)}
        assert r.n_runs == len(runs)
        assert r.runs_sha256 == hashlib.sha256("".join(f"{s},{e - s},{p}\n" for s, e, p in runs).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(" ".join(w for i, w in enumerate(words) if i not in gone).encode()).hexdigest()
        if runs:
            s, e, p = max(runs, key=lambda x: ((x[1] - x[0]) / x[2], -x[0], -x[2]))
            assert (r.start, r.length, r.period, r.exponent_milli) == (s, e - s, p, 1000 * (e - s) // p)
        else:
            assert (r.start, r.length, r.period, r.exponent_milli) == (None,) * 4


def test_sql(spark, duck):
    agrees(spark, duck, queries.op11_periodic, queries.ORACLE_SQL["op11_periodic"], DATA)
