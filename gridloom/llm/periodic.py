"""Periodic runs of words, by Kolpakov and Kucherov's method, and texts without their repetitions.

A run is a stretch of words with smallest period q, at least ``LEAST`` words and
``TIMES`` * q words long, that no neighbouring word extends.

1. A text is cut where no run can pass, with array operations over many texts at a
   time.  Every window of LEAST / 3 words of a run comes again in it, q words away.
   So words that no such window covers, one that comes again within a third of its
   stretch, lie in no run, and what is left falls into stretches; the same again for
   each stretch, until nothing falls off.  Most prose is gone then.
2. Each stretch is factorised (LZ): the longest beginning of the rest that occurs
   before, overlapping or not, is the next factor.  A suffix automaton of the stretch,
   which knows where each state's words end first, gives length and place.
3. Main's algorithm finds runs that cross or touch the beginning of a factor, from
   longest common extensions to both sides, for all periods at once.
4. Runs strictly inside a factor are copied from its earlier occurrence.

All of this takes time and memory in proportion to the words of a stretch (some 150
bytes a word).  Texts are independent: nothing is shuffled.

Edge cases.  A null text has no words, no runs and an empty collapsed text.  Texts
are taken whole.  Words are compared as they are, with their bytes; equal hashes only
keep stretches.  Repeated rows are treated alike; columns of the input are kept,
those named like a result are replaced.  An empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import _arrow, as_bytes, slices
from .kernels import U64, grams, mix, ranges, words

LEAST, TIMES = 24, 3
FIELDS = "n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


def stretches(hashes: np.ndarray, before: np.ndarray, least: int = LEAST) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends, in words, of what is left of texts when words that lie in no run are taken away.  before: words before each text and in all."""
    width = max(1, least // 3)
    window = grams(hashes, width)
    starts, ends = before[:-1], before[1:]
    while True:
        long = ends - starts >= least
        starts, ends = starts[long], ends[long]
        if not len(starts):
            return starts, ends
        at, of = ranges(starts, ends - width + 1)
        order = np.argsort(window[at] ^ mix((of + 1).astype(U64) * U64(0x9E3779B97F4A7C15)), kind="stable")
        at, of = at[order], of[order]
        again = (window[at[1:]] == window[at[:-1]]) & (of[1:] == of[:-1])
        again &= at[1:] - at[:-1] <= (ends - starts)[of[1:]] // TIMES
        again = np.concatenate([again, [False]]) | np.concatenate([[False], again])
        depth = np.zeros(int(ends[-1]) + 1, np.int32)
        np.add.at(depth, at[again], 1)
        np.subtract.at(depth, at[again] + width, 1)
        covered = np.cumsum(depth) > 0
        edge = np.zeros(len(covered) + 1, bool)
        edge[1:-1] = covered[1:] != covered[:-1]
        edge[0] = covered[0]
        edge[starts] |= covered[starts]  # stretches stay apart
        edge[ends] |= covered[ends - 1]
        cut = np.flatnonzero(edge)
        some = covered[cut[:-1]] if len(cut) else np.empty(0, bool)
        new_starts, new_ends = cut[:-1][some], cut[1:][some]
        if (new_ends - new_starts).sum() == (ends - starts).sum():
            return starts, ends
        starts, ends = new_starts, new_ends


class _Automaton:
    """Suffix automaton of a sequence of numbers.  A state's first transition is held in arrays, further ones in a dictionary of its own."""

    def __init__(self, w: list[int]):
        n = len(w)
        blank = array("i", [-1]) * (2 * n + 2)
        length, link, first_end, letter, target = (blank[:] for _ in range(5))
        more: dict[int, dict[int, int]] = {}
        self.first_end, self.letter, self.target, self.more = first_end, letter, target, more
        length[0], last, size = 0, 0, 1
        for i, c in enumerate(w):
            new, size = size, size + 1
            length[new], first_end[new] = i + 1, i
            p, q = last, -1
            while p >= 0:
                if letter[p] == c:
                    q = target[p]
                    break
                if letter[p] < 0:
                    letter[p], target[p] = c, new
                else:
                    others = more.get(p)
                    if others is None:
                        more[p] = {c: new}
                    elif c in others:
                        q = others[c]
                        break
                    else:
                        others[c] = new
                p = link[p]
            if q < 0:
                link[new] = 0
            elif length[q] == length[p] + 1:
                link[new] = q
            else:
                twin, size = size, size + 1
                length[twin], link[twin], first_end[twin] = length[p] + 1, link[q], first_end[q]
                letter[twin], target[twin] = letter[q], target[q]
                if q in more:
                    more[twin] = dict(more[q])
                while p >= 0:
                    if letter[p] == c:
                        if target[p] != q:
                            break
                        target[p] = twin
                    else:
                        others = more.get(p)
                        if others is None or others.get(c) != q:
                            break
                        others[c] = twin
                    p = link[p]
                link[q] = link[new] = twin
            last = new


def factors(w: list[int]) -> list[tuple[int, int, int]]:
    """LZ factors (begin, length, where it occurs before; -1: a word that is new)."""
    known = _Automaton(w)
    first_end, letter, target, more = known.first_end, known.letter, known.target, known.more
    out, i, n = [], 0, len(w)
    while i < n:
        state, j = 0, i
        while j < n:
            c = w[j]
            to = target[state] if letter[state] == c else more[state][c]
            if first_end[to] == j:  # not before
                break
            state, j = to, j + 1
        if j == i:
            out.append((i, 1, -1))
            i += 1
        else:
            out.append((i, j - i, first_end[state] - (j - i) + 1))
            i = j
    return out


def _common(s: list[int]) -> np.ndarray:
    """For each place the length of the longest beginning of s that stands there (at 0: 0)."""
    n = len(s)
    z, a, b = [0] * n, 0, 0
    for i in range(1, n):
        k = min(z[i - a], b - i) if i < b else 0
        if i + k >= b:
            while i + k < n and s[k] == s[i + k]:
                k += 1
            a, b = i, i + k
        z[i] = k
    return np.array(z, np.int64)


def _crossing(w: list[int], lo: int, b: int, hi: int, most: int, times: int) -> Iterator[tuple[int, int, int]]:
    """Stretches (start, end, period) within lo and hi that cross or touch b, have a period of at most ``most`` and are ``times`` periods long."""
    u, t = w[b:hi], w[lo:b]
    back = t[::-1]
    right, left = _common([*u, -1, *t, *u]), _common([*back, -1, *u[::-1], *back])
    nu, nt = len(u), len(t)
    p = np.arange(1, min(most, nu) + 1)  # a period to the right of b
    if len(p):
        forth = np.append(right[:nu], 0)[p]
        ago = np.minimum(left[nt + 1 + nu - p], nt)
        for k in np.flatnonzero(forth + ago >= (times - 1) * p).tolist():
            yield b - int(ago[k]), b + k + 1 + int(forth[k]), k + 1
    p = np.arange(1, min(most, nt) + 1)  # a period to the left of b
    if len(p):
        forth = np.minimum(right[nu + 1 + nt - p], nu)
        ago = np.append(left[:nt], 0)[p]
        for k in np.flatnonzero(forth + ago >= (times - 1) * p).tolist():
            yield b - k - 1 - int(ago[k]), b + int(forth[k]), k + 1


def runs_of(w: list[int], least: int = LEAST, times: int = TIMES) -> list[tuple[int, int, int]]:
    """All runs (start, end, period) of a sequence of numbers from 0 on, by start and period.  times is 3 or more.

    A run that ends behind the beginning b of factor u and starts before u's
    predecessor v starts less than a period before v, as v and the word after it
    don't occur earlier.  So 2 * period < |v| + |u|, and the surroundings of b that
    are looked at suffice.
    """
    n, found, at = len(w), {}, {}

    def add(start: int, end: int, period: int) -> None:
        if (start, end) not in found:
            at.setdefault(start, []).append(end)
        found[start, end] = min(period, found.get((start, end), period))

    before = 0
    for b, size, source in [*factors(w), (n, 0, -1)]:
        both, hi = before + size, b + size
        if 3 * both > 2 * least:
            most = max(1, both // 2)
            lo = max(0, b - before - most - 1)
            for start, end, period in _crossing(w, lo, b, hi, most, times):
                if end - start < least or end - start < times * period:
                    continue
                if start and w[start - 1] == w[start - 1 + period] or end < n and w[end] == w[end - period]:
                    continue  # it goes on beyond what was looked at
                add(start, end, period)
        if source >= 0 and size > least:
            shift = b - source
            for j in range(source + 1, source + size):
                if j in at:
                    for end in list(at[j]):
                        if end < source + size:
                            add(j + shift, end + shift, found[j, end])
        before = size
    return sorted((start, end, period) for (start, end), period in found.items())


def _collapsed(found: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words but those of runs after the first period."""
    if not runs:
        return b" ".join(found)
    stays = np.ones(len(found), bool)
    for start, end, period in runs:
        stays[start + period : end] = False
    return b" ".join([x for x, s in zip(found, stays.tolist(), strict=True) if s])


def analysed(texts: list[bytes], least: int = LEAST, times: int = TIMES) -> list:
    """n_words, runs and collapsed texts."""
    hashes, before = words(texts)
    starts, ends = stretches(hashes, before, least)
    runs: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    of = np.searchsorted(before, starts, "right") - 1
    split = [t.split() for t in texts]
    for i, a, b in zip(of.tolist(), (starts - before[of]).tolist(), (ends - before[of]).tolist(), strict=True):
        number: dict[bytes, int] = {}
        w = [number.setdefault(x, len(number)) for x in split[i][a:b]]
        runs[i] += [(a + s, a + e, p) for s, e, p in runs_of(w, least, times)]
    shown = [[{"start": s, "length": e - s, "period": p} for s, e, p in r] for r in runs]
    return [np.diff(before), shown, [_collapsed(x, r).decode() for x, r in zip(split, runs, strict=True)]]


def find_runs(docs: DataFrame, prepare: Callable | None = None, least: int = LEAST, times: int = TIMES, keep: list[str] | None = None) -> DataFrame:
    """Adds n_words, runs (start, length, period; by start, then period) and collapsed, the words outside repetitions joined by a space.

    prepare(doc_id, text) gives the bytes of the text to be looked at instead.
    """
    new = T._parse_datatype_string(FIELDS)
    names = {f.name.lower() for f in new}
    kept = [c for c in (docs.columns if keep is None else keep) if c.lower() not in names]
    schema = T.StructType([docs.schema[c] for c in kept] + list(new))
    source = docs.select(*kept, F.col("doc_id").alias("__id"), F.col("text").alias("__text"))
    types = [_arrow(f.dataType) for f in new]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = as_bytes(batch.column(len(kept) + 1))
            if prepare:
                texts = [prepare(i, t) for i, t in zip(batch.column(len(kept)).to_pylist(), texts, strict=True)]
            for a, b in slices(texts):
                made = [pa.array(x, t) for x, t in zip(analysed(texts[a:b], least, times), types, strict=True)]
                yield pa.RecordBatch.from_arrays([*batch.slice(a, b - a).columns[: len(kept)], *made], names=[f.name for f in schema])

    return source.mapInArrow(run, schema)


def planted(doc_id: int | None, text: bytes) -> bytes:
    """A text with a repetition at its end, for one document of ten, as the crc32 of its id says."""
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10:
        return text
    found, g = text.split(), h // 10
    if not found:
        return text
    a = g % len(found)
    rest = len(found) - a
    p = 1 + rest // (3 + g % 8)
    return b" ".join(found[:a] + (found[a : a + p] * (rest // p + 1))[:rest])


def digest(found: DataFrame) -> DataFrame:
    """doc_id, n_runs, the run of the greatest exponent, and SHA-256 of all runs and of the collapsed text."""
    better = lambda best, r: best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"])
    none = F.lit(None).cast("struct<start:long,length:long,period:long>")
    best = F.reduce("runs", none, lambda b, r: F.when(better(b, r), r).otherwise(b))
    line = lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    lines = F.array_join(F.transform("runs", line), "")
    found = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
    exponent = F.expr("best.length * 1000 DIV best.period").alias("exponent_milli")
    return found.select("doc_id", "n_runs", "best.start", "best.length", "best.period", exponent, "runs_sha256", "collapsed_sha256")


#: Runs from pairs of equal windows of 8 words at one distance, of the texts with what planted() makes of them, in DuckDB.
ORACLE_SQL = r"""
WITH table_of AS (
  SELECT list(list_reduce(list_prepend(k, range(8)), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY k) AS t FROM range(256) r(k)),
d AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
    xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
      lambda c, b: xor(c >> 8, t[CAST(xor(c, b) & 255 AS INTEGER) + 1])), 4294967295) AS h
  FROM documents, table_of),
a AS (SELECT *, len(words) AS n, CASE WHEN h % 10 = 0 AND len(words) > 0 THEN (h // 10) % len(words) END AS a FROM d),
p AS (SELECT *, CASE WHEN a IS NOT NULL THEN 1 + (n - a) // (3 + (h // 10) % 8) END AS p FROM a),
w AS MATERIALIZED (
  SELECT r, doc_id, n, CASE WHEN a IS NULL THEN words ELSE list_transform(range(n), lambda i: words[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % p END]) END AS words FROM p),
g AS (
  SELECT r, n, i, array_to_string(words[i + 1:i + 8], ' ') AS gram FROM (SELECT r, n, words, unnest(range(n - 7)) AS i FROM w WHERE n >= 24)),
q AS (SELECT x.r, x.i, y.i - x.i AS q FROM g x JOIN g y ON x.r = y.r AND x.gram = y.gram AND y.i > x.i AND 3 * (y.i - x.i) <= x.n),
island AS (SELECT r, q, i, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS k FROM q),
stretch AS (SELECT r, q, min(i) AS s, count(*) + 7 + q AS l FROM island GROUP BY r, q, k),
runs AS MATERIALIZED (SELECT r, s, l, min(q) AS p FROM stretch WHERE l >= 24 AND l >= 3 * q GROUP BY r, s, l),
best AS (
  SELECT r, count(*) AS n_runs, sha256(string_agg(s || ',' || l || ',' || p || chr(10), '' ORDER BY s, p)) AS runs_sha256 FROM runs GROUP BY r),
first AS (
  SELECT x.* FROM runs x WHERE NOT EXISTS (
    SELECT 1 FROM runs y WHERE y.r = x.r AND (y.l * x.p > x.l * y.p OR y.l * x.p = x.l * y.p AND (y.s < x.s OR y.s = x.s AND y.p < x.p)))),
gone AS (SELECT DISTINCT r, unnest(range(s + p, s + l)) AS i FROM runs),
left_over AS (
  SELECT r, string_agg(word, ' ' ORDER BY i) AS text FROM (
    SELECT w.r, unnest(range(n)) AS i, unnest(words) AS word FROM w WHERE w.r IN (SELECT r FROM runs)) e
  ANTI JOIN gone USING (r, i) GROUP BY r)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, s AS "start", l AS length, first.p AS period, CAST(1000 * l // first.p AS BIGINT) AS exponent_milli,
  coalesce(runs_sha256, sha256('')) AS runs_sha256, sha256(coalesce(left_over.text, array_to_string(words, ' '))) AS collapsed_sha256
FROM w LEFT JOIN best ON best.r = w.r LEFT JOIN first ON first.r = w.r LEFT JOIN left_over ON left_over.r = w.r
"""
