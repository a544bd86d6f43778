"""Seats against their exact distribution, whole scores against a plain model of dictionaries, the base score, edges."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridloom.llm import pitman_yor, queries
from gridloom.llm.common import remainder
from gridloom.llm.kernels import U64, mix, words

from ..conftest import DATA
from .helpers import CLASHES, crc32, documents, empty


def tokens(text):
    return [w.encode() for w in re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))] + [None]


def exact(c, strength, share, d):
    """Chances of 1, 2, ... tables: the sum over all seatings of c customers, built up one by one."""
    at = {(1,): 1.0}
    for _ in range(c - 1):
        more = defaultdict(float)
        for sizes, weight in at.items():
            for i, n in enumerate(sizes):
                more[tuple(sorted([*sizes[:i], n + 1, *sizes[i + 1 :]]))] += weight * (n - d)
            more[tuple(sorted([*sizes, 1]))] += weight
        at = more
    p = np.zeros(c)
    for sizes, weight in at.items():
        t = len(sizes)
        p[t - 1] += weight * math.prod((strength + d * i) * share for i in range(t))
    return p / p.sum()


@pytest.mark.parametrize(("c", "strength", "share", "d"), [(2, 1.0, 0.3, 0.8), (5, 4.0, 0.2, 0.5), (9, 30.0, 0.05, 0.7)])
def test_seats_follow_their_conditional_distribution(c, strength, share, d):
    n = 40_000
    keys = mix(np.arange(n, dtype=U64))
    t = pitman_yor.seat(np.full(n, c), np.full(n, strength), np.full(n, share), d, keys, 1)
    assert np.abs(np.bincount(t, minlength=c + 1)[1:] / n - exact(c, strength, share, d)).max() < 0.01


@pytest.mark.parametrize(("c", "strength", "share", "d"), [(40, 3.0, 0.2, 0.6), (60, 50.0, 0.02, 0.8)])
def test_large_dishes_are_seated_alike(c, strength, share, d):
    n = 20_000
    t = pitman_yor.seat(np.full(n, c), np.full(n, strength), np.full(n, share), d, mix(np.arange(n, dtype=U64)), 1)
    i = np.arange(1, c + 1)
    log = np.log(strength + d * np.arange(c)).cumsum() + i * math.log(share) + pitman_yor.log_ways(d, c)[c, 1:]
    p = np.exp(log - log.max())
    p /= p.sum()
    assert abs(t.mean() - (p * i).sum()) < 0.05 * (p * i).sum()
    assert np.abs(np.bincount(t, minlength=c + 1)[1:] / n - p).max() < 0.03


def test_log_gamma():
    z = np.array([1e-3, 0.2, 1, 2.5, 9, 1e3, 1e7])
    assert np.allclose(pitman_yor.log_gamma(z), [math.lgamma(x) for x in z], rtol=1e-9, atol=1e-9)


def key_of(word):
    return pitman_yor.END if word is None else words([word])[0][0]


def pair_key(u, w):
    with np.errstate(over="ignore"):
        return mix(np.array([key_of(u)]) * pitman_yor.RUN_KEYS[0] + np.array([key_of(w)]) * pitman_yor.RUN_KEYS[1])


def plain(texts, held, sweeps=3, burn=1):
    """The same model in dictionaries, a dish at a time; draws are those of a dish's key."""
    docs = [tokens(t) for t in texts]
    pairs, count = Counter(), Counter()
    for ws, out in zip(docs, held, strict=True):
        if not out:
            pairs.update(zip([None, *ws[:-1]], ws, strict=True))
            count.update(ws)
    base, theta = 1 / (len(count) + 1), pitman_yor.THETA

    def discount(n):
        n = Counter(n)
        return min(0.95, max(0.05, n[1] / (n[1] + 2 * n[2]))) if n[1] else 0.5

    def seat(c, strength, share, d, key, sweep):
        return int(pitman_yor.seat(np.array([c]), np.array([strength]), np.array([share]), d, key, sweep)[0])

    t, samples = dict.fromkeys(pairs, 1), []
    d, seats = discount(pairs.values()), {}
    for sweep in range(sweeps + 1):
        tables, customers = Counter(), Counter()
        for (u, w), n in t.items():
            tables[u] += n
            customers[w] += n
        if sweep:
            strength = max(theta + d0 * (sum(seats.values()) - 1), 1e-9)
            seats = {w: seat(c, strength, base, d0, np.array([key_of(w)]), sweep) for w, c in customers.items()}
        else:
            d0, seats = discount(customers.values()), dict.fromkeys(customers, 1)
        new = (theta + d0 * sum(seats.values())) * base
        root = {w: (customers[w] - d0 * seats.get(w, 0) + new) / (theta + sum(customers.values())) for w in {w for ws in docs for w in ws}}
        if sweep > burn:
            samples.append((dict(t), dict(tables), root))
        t = {(u, w): seat(c, theta + d * (tables[u] - t[u, w]), root[w], d, pair_key(u, w), sweep + 1) for (u, w), c in pairs.items()}

    def p(u, w):
        return sum((pairs[u, w] - d * t.get((u, w), 0) + (theta + d * tables[u]) * root[w]) / (theta + count[u]) for t, tables, root in samples) / len(samples)

    scores = [sum(math.log10(p(u, w)) for u, w in zip([None, *ws[:-1]], ws, strict=True)) for ws in docs]
    bases = [sum(math.log10((count[w] + 1) / (sum(count.values()) + len(count) + 1)) for w in ws) for ws in docs]
    return [(len(ws), sum(count[w] > 0 for w in ws), sum(count.values()), b, s) for ws, b, s in zip(docs, bases, scores, strict=True)]


def texts_of(n, seed=4):
    rng = random.Random(seed)
    return [" ".join(rng.choice("the a Cat dog saw the the ran of of and big".split()) + rng.choice(["", "", "", str(rng.randrange(9))]) for _ in range(rng.randrange(60))) for _ in range(n)]


@pytest.mark.parametrize("sizes", [{}, {"slice_bytes": 300, "bucket": 16}])
def test_whole_scores_equal_a_plain_model(spark, sizes):
    """However texts are cut into slices and keys into buckets."""
    texts = texts_of(120)
    texts[5] = "the of " * 200  # pairs of many customers
    held = [crc32(i) % 7 == 2 for i in range(len(texts))]
    rows = sorted(pitman_yor.score(documents(spark, texts).repartition(3), remainder(7) == 2, **sizes).collect(), key=lambda r: r.doc_id)
    assert [r.held_out for r in rows] == held
    for r, (n, known, total, base, score) in zip(rows, plain(texts, held), strict=True):
        assert (r.n_tokens, r.n_known, r.train_tokens) == (n, known, total)
        assert r.base_score == pytest.approx(base) and r.score == pytest.approx(score) and r.perplexity == pytest.approx(10 ** (-score / n))


@pytest.mark.parametrize("sizes", [{}, {"slice_bytes": 300, "bucket": 16}])
def test_base_scores_need_no_pairs(spark, monkeypatch, sizes):
    def unwanted(*_):
        raise AssertionError("pairs are exchanged")

    monkeypatch.setattr(pitman_yor, "_send_pairs", unwanted)
    monkeypatch.setattr(queries, "table", lambda *_: docs)
    monkeypatch.setattr(pitman_yor, "base_scores", lambda *args, f=pitman_yor.base_scores: f(*args, **sizes))
    texts = ["", None, *texts_of(120)]
    docs = documents(spark, texts, CLASHES).repartition(3)
    held = [crc32(i) % 7 == 2 for i in range(len(texts))]
    rows = sorted(queries.base12_unigrams(spark, DATA).collect(), key=lambda r: r.doc_id)
    want = [(i, held[i], n, known, total, pytest.approx(base, abs=1e-6)) for i, (n, known, total, base, _) in enumerate(plain(texts, held))]
    assert [tuple(r) for r in rows] == want
    assert pitman_yor.base_scores(empty(spark), remainder(7) == 2).count() == 0


def test_held_out_texts_are_foreseen_better_than_by_the_base(spark):
    rows = [r for r in queries.op12_pitman_yor(spark, DATA).collect() if r.held_out]
    assert len(rows) > 20 and sum(r.score for r in rows) > 0.95 * sum(r.base_score for r in rows)


def test_edges(spark):
    texts = ["", None, "one word", "word " * 50_000, "Ünïcode É 中文", "\x85 \xa0x", "ONE word"]
    docs = documents(spark, texts, CLASHES | {"held": 1, "slice": "x"}).unionByName(documents(spark, texts[2:3], CLASHES | {"held": 1, "slice": "x"}))
    rows = pitman_yor.score(docs, F.col("doc_id") == 6).collect()
    assert sorted(r.doc_id for r in rows) == [0, 0, 1, 2, 3, 4, 5, 6]
    by = {r.doc_id: r for r in rows}
    assert [by[i].n_tokens for i in (1, 3, 4, 5, 6)] == [1, 50_001, 4, 3, 3]
    assert by[6].held_out and by[6].n_known == 3 and all(r.score <= 0 and r.base_score <= 0 for r in rows)
    nobody = pitman_yor.score(docs, F.lit(True)).collect()
    assert all(r.score == r.base_score == 0 and r.train_tokens == r.n_known == 0 for r in nobody)
    null = spark.createDataFrame([(None, "a b"), (None, None)], "doc_id long, text string")
    assert [r.held_out for r in pitman_yor.score(null, remainder(7) == 2).collect()] == [False, False]
    assert pitman_yor.score(empty(spark), remainder(7) == 2).count() == 0
