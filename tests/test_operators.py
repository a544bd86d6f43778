"""Operators on small literal inputs: nulls, ties, duplicates, empty tables, errors."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from gridloom.functions import expressions as X
from gridloom.operators import analytics, cleaning, completeness, gates, lineage, normalize, selection, series
from gridloom.schema import DEMAND, DISPATCH, STATE, UNIFIED

CANON = "timestamp timestamp_ntz, generator_id string, estimated_generation_mw double"
KEYS = ["timestamp", "generator_id"]


def at(text):
    return datetime.fromisoformat(text)


def test_timestamp_texts(spark):
    wanted = {
        "2026-07-01": "2026-07-01 00:00:00", "2026/07/01 0:05": "2026-07-01 00:05:00", "2026-07-01 오전 12:05:00": "2026-07-01 00:05:00", "2026-07-01 오후 1:05:00": "2026-07-01 13:05:00",
        "2026-07-01 오후 12:05:00": "2026-07-01 12:05:00", "2019-08-01 00": "2019-08-01 00:00:00", "2026-7-1 00:05:00": "2026-07-01 00:05:00", " 2026-07-01 00:05:00 ": "2026-07-01 00:05:00",
        "bad": None, "2026-07-01 24:00:00": None, "07-01-2026": None, "2026-02-30": None, None: None, "": None,
    }
    df = spark.createDataFrame([(k,) for k in wanted], "text string").select("text", X.parse_ts(F.col("text")).alias("t"))
    assert {r.text: r.t and str(r.t) for r in df.collect()} == wanted


def test_number_texts(spark):
    wanted = {"1.5": 1.5, " 2 ": 2.0, "-2.5e3": -2500.0, "inf": float("inf"), "1,000": None, "1d": None, "0x10": None, "1_000": None, "nan": None, "": None, None: None, ".5": 0.5, "5.": 5.0}
    df = spark.createDataFrame([(k,) for k in wanted], "text string").select("text", X.to_num(F.col("text")).alias("n"))
    assert {r.text: r.n for r in df.collect()} == wanted


def test_hundredths_are_those_of_sql(spark, duck):
    values = [1.005, 79.585, 23.544999999999998, 115.55499999999999, 0.125, -0.125, -1.005, 0.0, -0.001, 1234567890123456.78, 1234567890123.455, None]
    values += [s * (k / 1000 + 5e-4 * (k % 3)) for k in range(3000) for s in (1, -1)]
    df = spark.createDataFrame([(v,) for v in values], "v double").select(X.two_places(F.col("v")).cast("string"))
    said = duck.execute("SELECT CAST(CAST(unnest(CAST(? AS DOUBLE[])) AS DECIMAL(18,2)) AS VARCHAR)", [values]).fetchall()
    assert [r[0] for r in df.collect()] == [r[0] for r in said]


def test_month_of_titles(spark):
    rows = [
        ("2031년 3월 급전 자료", None, "2031-03"), ("자료 (2031년도 11월)", "2032.01.05", "2031-11"), ("급전203107", None, "2031-07"), ("120310 203113 5분", None, None),
        ("4월 실적", "2031-05-02", "2031-04"), ("11월 실적", "2031.01.15", "2030-11"), ("2031년 자료", "2031-05-02", None), ("13월", "2031/05/02", None), ("5월", None, None), (None, None, None),
    ]
    df = spark.createDataFrame(rows, "title string, published string, wanted string")
    got = df.select("wanted", X.month_of_title(F.col("title"), F.col("published")).alias("month")).collect()
    assert [r.month for r in got] == [r.wanted for r in got]


def test_months_are_newest_first(spark):
    f = lambda a, b: spark.range(1).select(X.months(F.lit(a), F.lit(b))).first()[0]
    assert f("2031-11", "2032-02") == ["2032-02", "2032-01", "2031-12", "2031-11"]
    assert f("2031-03", "2031-03") == ["2031-03"]


def test_attachment_name(spark):
    from urllib.parse import quote

    names = ["수요 2030-07 (2).zip", "a+b%20.txt"]
    headers = [f"inline; FileName* = UTF-8'ko'{quote(n)}" for n in names] + ['attachment; filename="b.zip"; size=3', "attachment", None]
    df = spark.createDataFrame([(h,) for h in headers], "h string").select(X.attachment_name(F.col("h")))
    assert [r[0] for r in df.collect()] == [*names, "b.zip", None, None]


def test_normalize_and_unify(spark):
    raw = spark.createDataFrame([("2026/07/01 0:05", " GEN1 ", "1.5"), ("bad", "NA", "1,0"), (None, None, None)], "a string, b string, c string")
    rows = normalize.normalize(DISPATCH, raw).collect()
    assert [tuple(r) for r in rows] == [(at("2026-07-01 00:05"), "GEN1", 1.5), (None, None, None), (None, None, None)]
    with pytest.raises(ValueError):
        normalize.normalize(DEMAND, raw)
    demand = spark.createDataFrame([(at("2026-07-01"), 59000.5), (at("2026-07-01 00:05"), float("nan"))], "timestamp timestamp_ntz, demand_forecast_mw double")
    long = normalize.to_long(DEMAND, demand)
    assert [tuple(r) for r in long.collect()] == [(at("2026-07-01"), "demand", None, 59000.5), (at("2026-07-01 00:05"), "demand", None, None)]
    assert not gates.same_schema(long.schema, UNIFIED, nullability=False)
    with pytest.raises(ValueError):
        normalize.to_long("weather", demand)


def test_csv_text(spark):
    df = spark.createDataFrame([(at("2026-07-01 00:05"), "state_estimation", 'G"2', 42.0), (at("2026-07-01 00:05"), "demand", None, None)], "timestamp timestamp_ntz, source string, generator_id string, value_mw double")
    assert [r.value for r in normalize.csv_rows(df).collect()] == ['"2026-07-01 00:05:00","state_estimation","G""2",42.0', '"2026-07-01 00:05:00","demand",,']


def readings(spark, *rows):
    """Rows (minute of the hour, generator, value) of one hour."""
    return spark.createDataFrame([(datetime(2031, 8, 9, 4, m), g, v) for m, g, v in rows], CANON)


#: Minute 30 stands twice, for three generators of which two changed; minute 35 once.
TWICE = [(30, g, v) for g, v in (("p", 10.0), ("p", 11.0), ("q", 5.0), ("q", 5.0), ("r", None), ("r", 3.0))] + [(35, g, 1.0) for g in "pqr"]
COUNTED = {"rows_at_timestamp": 6, "unique_candidate_keys": 3, "conflicting_candidate_keys": 2}


def listed(*minutes, action="drop_ambiguous_duplicate_timestamp", **evidence):
    return {"source": STATE, "month": "2031-08", "action": action, "timestamps": [f"2031-08-09T04:{m:02d}:00" for m in minutes], "evidence": evidence}


def applied(df, *items, month="2031-08"):
    return cleaning.apply_exceptions(df, KEYS, "estimated_generation_mw", STATE, month, list(items))


def test_ambiguous_snapshot_goes_whole(spark):
    df = readings(spark, *TWICE)
    left, done = applied(df, listed(30, **COUNTED))
    assert sorted((r.timestamp.minute, r.generator_id) for r in left.collect()) == [(35, g) for g in "pqr"]
    assert len(done) == 1 and {k: done[0][k] for k in ("rows_removed", "unique_candidate_keys", "conflicting_candidate_keys", "exact_candidate_keys")} == dict(zip(("rows_removed", "unique_candidate_keys", "conflicting_candidate_keys", "exact_candidate_keys"), (6, 3, 2, 1), strict=True))
    for name, n in COUNTED.items():
        with pytest.raises(cleaning.GateError, match=name):
            applied(df, listed(30, **COUNTED | {name: n + 1}))
    same, done = applied(df, listed(30, **COUNTED), month="2031-09")
    assert same.count() == 9 and not done
    nulls = df.unionByName(df.limit(1).withColumn("timestamp", F.lit(None).cast("timestamp_ntz")))
    assert applied(nulls, listed(30))[0].count() == 4


def test_ambiguous_snapshot_errors(spark):
    df = readings(spark, *TWICE)
    for item, message in ((listed(35), "twice"), (listed(40), "no rows"), (listed(30, 40), "no rows"), (listed(30, action="average"), "average")):
        with pytest.raises(cleaning.GateError, match=message):
            applied(df, item)
    with pytest.raises(cleaning.GateError, match="equal"):
        applied(readings(spark, (5, "p", 2.0), (5, "p", 2.0), (5, "q", None), (5, "q", None)), listed(5))
    with pytest.raises(cleaning.GateError, match="twice"):
        applied(readings(spark, *TWICE, (30, "s", 1.0)), listed(30))


def test_null_counts_as_a_value(spark):
    df = readings(spark, (0, "p", None), (0, "p", 1.0), (0, "q", None), (0, "q", None))
    assert {r.generator_id: r.n_values for r in cleaning.conflicts(df, KEYS, "estimated_generation_mw").collect()} == {"p": 2, "q": 1}


def test_exact_duplicates_go_and_others_fail(spark):
    df = readings(spark, (0, "p", 1.0), (0, "p", 1.0), (0, None, None), (0, None, None))
    assert cleaning.dedup_exact(df, KEYS).count() == 2
    with pytest.raises(cleaning.GateError):
        cleaning.dedup_exact(readings(spark, (0, "p", 1.0), (0, "p", 1.1)), KEYS)
    assert cleaning.dedup_exact(df.limit(0), KEYS).count() == 0


def test_ramps_span_gaps_days_and_ties(spark):
    rows = [("2024-01-01 23:55", 1.0), ("2024-01-02 00:00", 4.0), ("2024-01-05 00:00", None), ("2024-01-05 00:05", 2.0), ("2024-01-05 00:05", 3.0)]
    df = spark.createDataFrame([(at(t), v) for t, v in rows], "timestamp timestamp_ntz, v double")
    got = [r.v_ramp for r in series.ramps(df, ["v"], tie=["v"]).orderBy("timestamp", "v").collect()]
    assert got == [None, 3.0, None, None, 1.0]
    assert [r.v_ramp for r in series.ramps(df, ["v"], tie=["v"], gap_minutes=5).orderBy("timestamp", "v").collect()] == [None, 3.0, None, None, 1.0]
    assert series.ramps(df.limit(0), ["v"]).count() == 0


def test_longest_run_takes_the_first_of_equals(spark):
    times = ["00:00", "00:05", "01:00", "01:05", "03:00"]
    df = spark.createDataFrame([("demand", at(f"2024-01-01 {t}")) for t in times], "source string, timestamp timestamp_ntz")
    r = completeness.longest_run(df, ["source"]).first()
    assert (r.run_start, r.run_end, r.slots) == (at("2024-01-01 00:00"), at("2024-01-01 00:05"), 2)
    assert completeness.longest_run(df.limit(0), ["source"]).count() == 0


def test_missingness_ties_take_the_earliest(spark):
    df = spark.createDataFrame([("a", "2024-02", 3), ("a", "2024-01", 3), ("a", "2024-03", 0)], "source string, month string, missing int")
    r = lineage.missingness(df, "source", "month", "missing").first()
    assert tuple(r) == ("a", 3, 2, 6, 3, "2024-01")


def test_quantiles_and_quality_ignore_what_is_not_finite(spark):
    df = spark.createDataFrame([(v,) for v in (0.0, -1.0, 4.0, None, float("nan"), float("inf"), float("-inf"))], "v double")
    assert [r.quantile for r in selection.quantiles(df, "v", [0.0, 0.5, 1.0]).orderBy("probability").collect()] == [-1.0, 0.0, 4.0]
    assert tuple(cleaning.numeric_quality(df, "v").first()) == (7, 1, 1, 1, 1, 1, 1, 3)


def test_sums_lose_no_digit(spark):
    cases = {"a": [0.004] * 1000, "b": [1e-9, 2e-9], "c": [1e300, 1.0], "d": [float("nan"), 1.0], "e": [float("inf"), -1.0], "f": [None, None], "g": [0.1] * 10, "h": [-0.25, 123456789.125], "i": [None, 2.5]}
    df = spark.createDataFrame([(k, v) for k, vs in cases.items() for v in vs], "k string, v double")
    got = {r.k: r.s for r in df.groupBy("k").agg(X.exact_sum(F.col("v")).alias("s")).collect()}
    assert got.pop("d") != got.get("d") and got == {"a": 4.0, "b": pytest.approx(3e-9, rel=1e-12), "c": 1e300, "e": float("inf"), "f": None, "g": 1.0, "h": 123456788.875, "i": 2.5}


def test_quantiles_of_any_shape(spark):
    import numpy as np

    rng = np.random.default_rng(1)
    shapes = {"smooth": rng.normal(size=3000), "few": rng.integers(0, 3, 500).astype(float), "far": np.array([1e300, -1e308, 0.0, 1.0, 2.0, 1.7e308]), "one": np.array([7.0]), "same": np.full(50, -2.5), "log": 10 ** rng.uniform(-300, 300, 800), "two": np.array([1.0, 2.0])}
    probabilities = [0.0, 0.01, 0.25, 0.5, 0.9, 1.0]
    df = spark.createDataFrame([(None if k == "two" else k, float(v)) for k, vs in shapes.items() for v in vs], "k string, v double").repartition(7)
    got = {(r.k, r.probability): r.quantile for r in selection.quantiles(df, "v", probabilities, ["k"]).collect()}
    wanted = {(None if k == "two" else k, p): float(np.quantile(vs / 2, p) * 2) for k, vs in shapes.items() for p in probabilities}
    assert got.keys() == wanted.keys() and all(got[k] == pytest.approx(v, rel=1e-9) for k, v in wanted.items() if np.isfinite(v))
    assert selection.quantiles(df.limit(0), "v", probabilities, ["k"]).count() == 0


def test_difference_summary_of_nothing(spark):
    df = spark.createDataFrame([(None,)], "d double")
    assert tuple(analytics.difference_summary(df, "d").first()) == (0, None, None, None, None, None, None)


def test_shares_of_nothing_are_null(spark):
    df = spark.createDataFrame([("a", 0.0), ("b", 0.0)], "generator_id string, sum_mw double")
    assert [r.share_pct for r in analytics.with_shares(df).collect()] == [None, None]


def test_verdicts(spark):
    good = spark.createDataFrame([("a", True), ("b", True)], "check_name string, passed boolean")
    assert gates.verdict(good).first().verdict == "PASS"
    assert gates.verdict(good, F.count("*") > 1).first().verdict == "PASS_WITH_OBSERVATIONS"
    assert gates.verdict(good.withColumn("passed", F.col("check_name") == "a")).first().verdict == "FAIL"
    assert gates.verdict(good.limit(0)).first().verdict == "FAIL"
    gates.require("PASS_WITH_OBSERVATIONS")
    with pytest.raises(RuntimeError):
        gates.require("FAIL")


def test_file_reconciliation(spark):
    e = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "name string, bytes long")
    a = spark.createDataFrame([("a", 1), ("b", 5), ("d", 4)], "name string, bytes long")
    assert {r.name: r.status for r in lineage.reconcile_files(e, a).collect()} == {"a": "ok", "b": "size_mismatch", "c": "missing", "d": "unexpected"}
