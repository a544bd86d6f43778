"""Operators that must not hang on one task: quantiles by digits, runs by merging, neighbours across ranges."""

import math
import random
import struct
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from gridloom.operators import completeness, selection, series
from gridloom.plans import scans

from .conftest import DATA
from .test_plans import plan

START = datetime(2024, 2, 28, 22)


# ---- quantiles by radix selection


def test_bits_are_in_the_order_of_the_numbers(spark):
    rng = np.random.default_rng(2)
    numbers = [0.0, -0.0, 5e-324, -5e-324, 2.2250738585072014e-308, 2.225073858507201e-308, 1.7976931348623157e308, -1.7976931348623157e308]
    numbers += [s * 2.0**e * f for e in range(-1073, 1024, 7) for f in (1.0, 1 + 2**-52, 2 - 2**-52) for s in (1, -1) if 2.0**e * f < math.inf]
    numbers += rng.normal(size=500).tolist()
    df = spark.createDataFrame([(float(x),) for x in numbers], "v double").select("v", selection.ordered_bits(F.col("v")).alias("k"))
    rows = sorted({(r.v, r.k) for r in df.collect()})
    assert all(b[1] >= a[1] for a, b in zip(rows, rows[1:], strict=False))
    for v, k in rows:
        bits = struct.unpack("<q", struct.pack("<d", abs(v)))[0]
        assert abs(abs(k) - bits) <= 1 and k * v >= 0, v


def test_an_outlier_leaves_no_task_with_many_values(spark):
    n = 300_000
    df = spark.range(n).select(F.rand(3).alias("v")).unionByName(spark.createDataFrame([(1e12,)], "v double"))
    values = df.select(F.struct(F.lit(0).alias("all")).alias("g"), "v", selection.ordered_bits(F.col("v")).alias("key"))
    assert selection._first(values, [0.1, 0.5, 0.9, 1.0], selection.SHIFTS[0]).agg(F.max("size")).first()[0] < n / 1000
    whole = np.sort([r.v for r in df.collect()])
    got = {r.probability: r.quantile for r in selection.quantiles(df, "v", [0.0, 0.5, 0.999, 1.0]).collect()}
    assert got == {p: pytest.approx(float(np.quantile(whole, p))) for p in (0.0, 0.5, 0.999, 1.0)}


def test_values_that_share_their_first_digits_go_through_all_passes(spark, monkeypatch):
    monkeypatch.setattr(selection, "FEW", 1)
    close = [1e9 + i * 2.0**-22 for i in range(2000)] + [1e9] * 500
    rows = [("x", v) for v in close] + [(None, -v) for v in close]
    df = spark.createDataFrame(rows, "k string, v double").repartition(5)
    for local in (20_000, 0):  # with digits in play at the driver, and without
        monkeypatch.setattr(selection, "LOCAL", local)
        got = {(r.k, r.probability): r.quantile for r in selection.quantiles(df, "v", [0.1, 0.5, 0.77], ["k"]).collect()}
        assert got == {(k, p): float(np.quantile(np.array(close) * s, p)) for k, s in (("x", 1), (None, -1)) for p in (0.1, 0.5, 0.77)}


# ---- the longest run by merging


def stamped(spark, rows):
    return spark.createDataFrame([(g, None if k is None else START + timedelta(minutes=5 * k)) for g, k in rows], "g string, timestamp timestamp_ntz")


def test_longest_runs_equal_the_window_form(spark):
    rng = random.Random(3)
    rows = [(g, k) for g in ("a", "b", None) for k in range(2500) if rng.random() < 0.93]
    rows += [("whole", k) for k in range(1000)] + [("one", 7)] + [("twice", k) for k in (1, 1, 2, 2, 9)] + [("timeless", None)]
    slots = stamped(spark, rows).repartition(6)
    got = {r.g: (r.run_start, r.run_end, r.slots) for r in completeness.longest_run(slots, ["g"]).collect()}
    w = Window.partitionBy("g").orderBy(F.desc("slots"), "run_start")
    distinct = slots.where("timestamp IS NOT NULL").distinct()
    want = completeness.runs(distinct, ["g"]).withColumn("n", F.row_number().over(w)).where("n = 1")
    assert got == {r.g: (r.run_start, r.run_end, r.slots) for r in want.collect()}
    assert got["whole"][2] == 1000 and got["twice"][2] == 2 and "timeless" not in got


def test_states_merge_in_any_grouping(spark):
    rng = random.Random(5)
    names = ("lo", "hi", "prefix", "suffix", "start", "length")

    def state(k):
        return F.struct(*[F.lit(x).cast("long").alias(n) for x, n in zip((k, k + 1, 1, 1, k, 1), names, strict=True)])

    def grouped(part):
        if len(part) == 1:
            return state(part[0])
        cut = rng.randrange(1, len(part))
        return completeness.merged(grouped(part[:cut]), grouped(part[cut:]))

    for _ in range(6):
        ks = sorted(rng.sample(range(7), 4))
        best, run = (0, 0), 0
        for k in range(8):
            run = run + 1 if k in ks else 0
            best = max(best, (run, -(k - run + 1)))
        for _ in range(2):
            s = spark.range(1).select(grouped(ks).alias("s")).first().s
            assert (s.length, s.start, s.lo, s.hi) == (best[0], -best[1], ks[0], ks[-1] + 1)


def test_no_group_is_windowed(spark):
    assert "Window" not in plan(scans.g03_longest_gap_of_history(spark, DATA))


def test_runs_pass_over_months(spark):
    slots = stamped(spark, [("a", k) for k in range(0, 60)] + [("a", k) for k in range(100, 130)])  # from 28 to 29 February
    r = completeness.longest_run(slots, ["g"]).first()
    assert (r.run_start, r.slots) == (START, 60)
    gaps = completeness.gaps(slots, ["g"])
    assert gaps.count() == 40 and completeness.longest_run(gaps, ["g"]).first().run_start == START + timedelta(minutes=300)


# ---- neighbours across ranges


def crowded(spark):
    """Nine rows of ten on one day."""
    day = spark.range(9000).select((F.lit(START).cast("timestamp_ntz") + F.make_dt_interval(secs=F.col("id"))).alias("timestamp"), (F.col("id") * 7 % 101).cast("double").alias("v"))
    rest = spark.range(1000).select((F.lit(datetime(2024, 3, 5)).cast("timestamp_ntz") + F.make_dt_interval(hours=F.col("id").cast("int"))).alias("timestamp"), F.col("id").cast("double").alias("v"))
    return day.unionByName(rest)


def test_a_crowded_day_is_spread(spark):
    df = crowded(spark)
    cuts = series.bounds(df, "timestamp", 16)
    sizes = [r["count"] for r in df.groupBy(series.range_of(F.col("timestamp"), cuts)).count().collect()]
    assert len(sizes) == 16 and max(sizes) < 2 * len(sizes) ** -1 * 10_000


def test_neighbours_equal_one_window(spark):
    rng = random.Random(8)
    rows = [(START + timedelta(minutes=rng.randrange(400)), rng.choice([None, 1.0, 2.0]), i) for i in range(500)] + [(None, 3.0, 1000 + i) for i in range(20)]
    df = spark.createDataFrame(rows, "timestamp timestamp_ntz, v double, k int").repartition(5)
    w = Window.orderBy("timestamp", "k")
    want = {r.k: (r.p, r.t) for r in df.where("timestamp IS NOT NULL").select("k", F.lag("v").over(w).alias("p"), F.lag("timestamp").over(w).alias("t")).collect()}
    for n in (1, 2, 7, 40):
        got = {r.k: (r.prev_v, r.prev_timestamp) for r in series.previous(df, ["v", "timestamp"], tie=["k"], ranges=n).collect()}
        assert {k: v for k, v in got.items() if k < 1000} == want
        assert all(got[k] == (None, None) for k in range(1000, 1020))
