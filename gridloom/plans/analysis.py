"""Queries of aggregation, ramps, top-k and concentration."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.expressions import exact_sum, share
from ..operators import analytics, series
from ..schema import DEMAND, DISPATCH, SLOTS_PER_DAY, STATE
from ..sources.tables import shipments, signals, table
from .registry import query
from .scans import RECONCILED, three, unified

DEC = "CAST(SUM(CAST({} AS DECIMAL(38,6))) AS DOUBLE)"


def r6(name: str):
    return F.round(name, 6).alias(name)


@query(f"SELECT timestamp, {DEC.format('dispatch_mw')} AS value_mw FROM dispatch WHERE timestamp IS NOT NULL GROUP BY timestamp")
def a01_sum_by_ts(spark, sf_dir):
    return signals(spark, sf_dir)[DISPATCH].where("timestamp IS NOT NULL").groupBy("timestamp").agg(exact_sum(F.col("dispatch_mw")).alias("value_mw"))


@query(f"SELECT timestamp, {DEC.format('dispatch_mw')} AS dispatch_mw, COUNT(*) AS dispatch_rows FROM dispatch WHERE dispatch_mw IS NOT NULL GROUP BY timestamp")
def a02_sum_count_by_ts(spark, sf_dir):
    return analytics.by_timestamp(signals(spark, sf_dir)[DISPATCH], "dispatch_mw", "dispatch")


@query("""SELECT CAST(timestamp AS DATE) AS date, COUNT(*) AS n, MIN(demand_forecast_mw) AS min_mw, ROUND(AVG(demand_forecast_mw), 6) AS mean_mw, MAX(demand_forecast_mw) AS max_mw,
ROUND(MAX(demand_forecast_mw) - MIN(demand_forecast_mw), 6) AS peak_to_trough_mw FROM demand GROUP BY 1""")
def a03_daily_load_shape(spark, sf_dir):
    made = analytics.daily_shape(signals(spark, sf_dir)[DEMAND], "demand_forecast_mw")
    return made.select("date", "n", "min_mw", r6("mean_mw"), "max_mw", r6("peak_to_trough_mw"))


SUMMARY_SQL = f"g AS (SELECT generator_id, COUNT(*) AS n, AVG(dispatch_mw) AS mean_mw, MAX(dispatch_mw) AS max_mw, {DEC.format('dispatch_mw')} AS sum_mw FROM dispatch WHERE dispatch_mw IS NOT NULL GROUP BY generator_id), total AS (SELECT {DEC.format('sum_mw')} AS total_mw FROM g)"


def summary(spark, sf_dir):
    return analytics.generator_summary(signals(spark, sf_dir)[DISPATCH], "dispatch_mw")


@query(f"WITH {SUMMARY_SQL} SELECT generator_id, n, ROUND(mean_mw, 6) AS mean_mw, max_mw, sum_mw FROM g")
def a04_generator_summary(spark, sf_dir):
    return summary(spark, sf_dir).select("generator_id", "n", r6("mean_mw"), "max_mw", "sum_mw")


@query(f"WITH {SUMMARY_SQL} SELECT generator_id, sum_mw, total_mw, ROUND(CASE WHEN total_mw <> 0 THEN 100 * sum_mw / total_mw END, 6) AS share_pct FROM g, total")
def a05_generator_shares(spark, sf_dir):
    return analytics.with_shares(summary(spark, sf_dir)).select("generator_id", "sum_mw", "total_mw", r6("share_pct"))


@query(f"WITH {SUMMARY_SQL} SELECT ROUND(SUM(POW(sum_mw / total_mw, 2)) * 10000, 6) AS hhi FROM g, total")
def a06_hhi(spark, sf_dir):
    return analytics.hhi(summary(spark, sf_dir)).select(r6("hhi"))


@query("SELECT source, COUNT(*) AS n FROM unified GROUP BY source")
def a07_rows_by_source(spark, sf_dir):
    return unified(spark, sf_dir).groupBy("source").agg(F.count("*").alias("n"))


@query("SELECT source, COUNT(*) AS n, ROUND(100.0 * COUNT(*) / SUM(COUNT(*)) OVER (), 6) AS share_pct FROM unified GROUP BY source")
def a08_share_by_source(spark, sf_dir):
    n = a07_rows_by_source(spark, sf_dir)
    total = n.agg(F.sum("n").alias("total"))
    return n.join(F.broadcast(total)).select("source", "n", F.round(share(F.col("n"), F.col("total")), 6).alias("share_pct"))


@query(f"WITH {RECONCILED}, x AS (SELECT timestamp, unnest(['dispatch_minus_demand', 'state_minus_demand', 'state_minus_dispatch']) AS metric, unnest([dispatch_mw - demand_mw, state_mw - demand_mw, state_mw - dispatch_mw]) AS gap FROM three) SELECT metric, COUNT(gap) AS n, ROUND(AVG(gap), 6) AS mean, ROUND(MEDIAN(gap), 6) AS median, ROUND(MIN(gap), 6) AS min, ROUND(MAX(gap), 6) AS max FROM x GROUP BY metric")
def a19_gap_summary(spark, sf_dir):
    names = ["dispatch_minus_demand", "state_minus_demand", "state_minus_dispatch"]
    long = three(spark, sf_dir).unpivot("timestamp", names, "metric", "gap")
    made = analytics.spread(long, "metric", "gap")
    return made.select("metric", "n", *[r6(c) for c in ("mean", "median", "min", "max")])


@query(f"WITH {RECONCILED}, x AS (SELECT state_mw - demand_mw AS d FROM three WHERE state_mw - demand_mw IS NOT NULL) SELECT COUNT(*) AS n, ROUND(AVG(d), 6) AS mean, ROUND(MEDIAN(d), 6) AS median, ROUND(AVG(ABS(d)), 6) AS mae, ROUND(quantile_cont(d, 0.01), 6) AS q01, ROUND(quantile_cont(d, 0.5), 6) AS q50, ROUND(quantile_cont(d, 0.99), 6) AS q99 FROM x")
def a20_diff_summary(spark, sf_dir):
    made = analytics.difference_summary(three(spark, sf_dir), "state_minus_demand")
    return made.select("n", *[r6(c) for c in made.columns[1:]])


@query("""WITH a AS (SELECT DISTINCT generator_id FROM dispatch WHERE generator_id IS NOT NULL), b AS (SELECT DISTINCT generator_id FROM state WHERE generator_id IS NOT NULL), i AS (SELECT COUNT(*) AS n FROM a JOIN b USING (generator_id)), c AS (SELECT (SELECT COUNT(*) FROM a) AS x, (SELECT COUNT(*) FROM b) AS y)
SELECT x AS size_a, y AS size_b, n AS overlap, x - n AS only_a, y - n AS only_b, n / (x + y - n) AS jaccard FROM c, i""")
def a28_jaccard(spark, sf_dir):
    t = signals(spark, sf_dir)
    return analytics.jaccard(t[DISPATCH], t[STATE], "generator_id")


@query(f"SELECT source, CAST(timestamp AS DATE) AS date, COUNT(DISTINCT timestamp) AS observed, {SLOTS_PER_DAY} - COUNT(DISTINCT timestamp) AS missing, ROUND(100.0 * COUNT(DISTINCT timestamp) / {SLOTS_PER_DAY}, 6) AS coverage_pct FROM unified GROUP BY ALL")
def a29_coverage(spark, sf_dir):
    n = unified(spark, sf_dir).groupBy("source", F.to_date("timestamp").alias("date")).agg(F.count_distinct("timestamp").alias("observed"))
    return n.select("source", "date", "observed", (SLOTS_PER_DAY - F.col("observed")).alias("missing"), F.round(100.0 * F.col("observed") / SLOTS_PER_DAY, 6).alias("coverage_pct"))


RAMP_SQL = "r AS (SELECT timestamp, demand_forecast_mw AS value_mw, demand_forecast_mw - LAG(demand_forecast_mw) OVER (ORDER BY timestamp) AS ramp FROM demand)"


def demand_ramps(spark, sf_dir):
    d = signals(spark, sf_dir)[DEMAND].withColumnRenamed("demand_forecast_mw", "value_mw")
    return series.ramps(d, ["value_mw"]).withColumnRenamed("value_mw_ramp", "ramp")


@query(f"WITH {RAMP_SQL} SELECT timestamp, value_mw, ROUND(ramp, 6) AS ramp, ROUND(ABS(ramp), 6) AS abs_ramp FROM r")
def w01_ramp(spark, sf_dir):
    return demand_ramps(spark, sf_dir).select("timestamp", "value_mw", r6("ramp"), F.round(F.abs("ramp"), 6).alias("abs_ramp"))


@query("WITH r AS (SELECT timestamp, demand_forecast_mw AS v, demand_forecast_mw - LAG(demand_forecast_mw) OVER (ORDER BY timestamp) AS ramp, timestamp - LAG(timestamp) OVER (ORDER BY timestamp) AS gap FROM demand) SELECT timestamp, ROUND(CASE WHEN gap <= INTERVAL 5 MINUTES THEN ramp END, 6) AS ramp FROM r")
def w01_ramp_gap_aware(spark, sf_dir):
    return series.ramps(signals(spark, sf_dir)[DEMAND], ["demand_forecast_mw"], gap_minutes=5).select("timestamp", F.round("demand_forecast_mw_ramp", 6).alias("ramp"))


THREE_RAMPS = f"{RECONCILED}, t AS (SELECT timestamp, demand_mw - LAG(demand_mw) OVER w AS demand_ramp, dispatch_mw - LAG(dispatch_mw) OVER w AS dispatch_ramp, state_mw - LAG(state_mw) OVER w AS state_ramp FROM three WINDOW w AS (ORDER BY timestamp))"


def three_ramps(spark, sf_dir):
    made = series.ramps(three(spark, sf_dir), ["demand_mw", "dispatch_mw", "state_mw"])
    return made.select("timestamp", *[F.col(f"{s}_mw_ramp").alias(f"{s}_ramp") for s in ("demand", "dispatch", "state")])


@query(f"WITH {THREE_RAMPS} SELECT timestamp, ROUND(demand_ramp, 6) AS demand_ramp, ROUND(dispatch_ramp, 6) AS dispatch_ramp, ROUND(state_ramp, 6) AS state_ramp FROM t")
def w02_three_ramps(spark, sf_dir):
    return three_ramps(spark, sf_dir).select("timestamp", r6("demand_ramp"), r6("dispatch_ramp"), r6("state_ramp"))


@query("WITH u AS (SELECT DISTINCT timestamp FROM demand) SELECT timestamp, CAST(date_diff('minute', LAG(timestamp) OVER (ORDER BY timestamp), timestamp) AS BIGINT) AS minutes FROM u")
def w03_deltas(spark, sf_dir):
    return deltas(spark, sf_dir)


def deltas(spark, sf_dir):
    u = signals(spark, sf_dir)[DEMAND].select("timestamp").distinct()
    return series.previous(u, ["timestamp"]).select("timestamp", series.minutes_between(F.col("prev_timestamp"), F.col("timestamp")).alias("minutes"))


@query("WITH u AS (SELECT DISTINCT timestamp FROM demand), d AS (SELECT CAST(date_diff('minute', LAG(timestamp) OVER (ORDER BY timestamp), timestamp) AS BIGINT) AS minutes FROM u) SELECT minutes, COUNT(*) AS n FROM d WHERE minutes IS NOT NULL GROUP BY minutes ORDER BY n DESC, minutes LIMIT 10")
def a18_delta_histogram(spark, sf_dir):
    n = deltas(spark, sf_dir).where("minutes IS NOT NULL").groupBy("minutes").agg(F.count("*").alias("n"))
    return series.top_by(n, F.col("n"), 10, F.col("minutes"))


@query(f"WITH {RAMP_SQL} SELECT timestamp, value_mw, ROUND(ramp, 6) AS ramp FROM r ORDER BY ROUND(ABS(ramp), 6) DESC NULLS LAST, timestamp LIMIT 10")
def t02_top_ramps(spark, sf_dir):
    made = demand_ramps(spark, sf_dir).select("timestamp", "value_mw", r6("ramp"))
    return series.top_by(made, F.round(F.abs("ramp"), 6), 10, F.col("timestamp"))


@query(f"WITH {THREE_RAMPS}, x AS (SELECT timestamp, unnest(['demand', 'dispatch', 'state']) AS signal, ROUND(unnest([demand_ramp, dispatch_ramp, state_ramp]), 6) AS ramp FROM t) SELECT signal, timestamp, ramp FROM x WHERE ramp IS NOT NULL QUALIFY ROW_NUMBER() OVER (PARTITION BY signal ORDER BY ABS(ramp) DESC, timestamp) <= 5")
def t03_top_ramps_per_signal(spark, sf_dir):
    named = three_ramps(spark, sf_dir).select("timestamp", *[F.round(f"{s}_ramp", 6).alias(s) for s in ("demand", "dispatch", "state")])
    long = named.unpivot("timestamp", ["demand", "dispatch", "state"], "signal", "ramp").where("ramp IS NOT NULL")
    return series.top_per(long, ["signal"], F.abs("ramp"), 5, F.col("timestamp")).select("signal", "timestamp", "ramp")


@query("SELECT timestamp, demand_forecast_mw FROM demand ORDER BY demand_forecast_mw DESC NULLS LAST, timestamp LIMIT 1")
def t04_peak_row(spark, sf_dir):
    return series.top_by(signals(spark, sf_dir)[DEMAND], F.col("demand_forecast_mw"), 1, F.col("timestamp"))


@query(f"WITH {SUMMARY_SQL} SELECT generator_id, ROUND(sum_mw * (5.0 / 60.0), 6) AS energy_mwh FROM g")
def t05_energy_sort(spark, sf_dir):
    made = summary(spark, sf_dir).select("generator_id", F.round(F.col("sum_mw") * (5.0 / 60.0), 6).alias("energy_mwh"))
    return made.orderBy(F.desc("energy_mwh"), "generator_id")


@query(f"WITH {SUMMARY_SQL} SELECT generator_id, sum_mw, max_mw FROM g ORDER BY sum_mw DESC, generator_id LIMIT 15")
def t06_top_generators(spark, sf_dir):
    return series.top_by(summary(spark, sf_dir).select("generator_id", "sum_mw", "max_mw"), F.col("sum_mw"), 15, F.col("generator_id"))


@query(f"""WITH {RECONCILED}, peak AS (SELECT CAST(timestamp AS DATE) AS day FROM demand ORDER BY demand_forecast_mw DESC NULLS LAST, timestamp LIMIT 1)
SELECT timestamp, demand_mw, dispatch_mw, state_mw FROM three, peak WHERE CAST(timestamp AS DATE) = day""")
def c05_peak_day(spark, sf_dir):
    """The day of the peak is one row, which chooses the rows of the other signals."""
    peak = t04_peak_row(spark, sf_dir).select(F.to_date("timestamp").alias("day"))
    rows = three(spark, sf_dir)
    return rows.join(F.broadcast(peak), F.to_date("timestamp") == F.col("day")).select("timestamp", "demand_mw", "dispatch_mw", "state_mw")


@query("SELECT time_bucket(INTERVAL '5 minutes', ts) AS slot, event_type, COUNT(*) AS n, CAST(SUM(CAST(value AS DECIMAL(38,6))) AS DOUBLE) AS total FROM events GROUP BY ALL", signals=False)
def x05_slots(spark, sf_dir):
    from ..functions.expressions import slot

    e = table(spark, sf_dir, "events")
    return e.groupBy(slot(F.col("ts")).alias("slot"), "event_type").agg(F.count("*").alias("n"), exact_sum(F.col("value")).alias("total"))


FINE = "fine AS (SELECT event_type, CASE WHEN event_type = 'error' AND event_id % 50 = 3 THEN 'NaN'::DOUBLE WHEN event_type = 'view' AND event_id % 90 = 1 THEN 'Infinity'::DOUBLE WHEN event_id % 11 = 0 THEN NULL ELSE value / 100 END AS v FROM events)"


@query(f"WITH {FINE}, t AS (SELECT event_type, SUM(v) AS t FROM fine GROUP BY 1) SELECT event_type, CASE WHEN isfinite(t) THEN ROUND(t, 6) END AS total, isnan(t) AS is_nan, isinf(t) AS is_infinite FROM t", signals=False)
def a01_sum_of_fine_values(spark, sf_dir):
    """Sums of values of four decimals, some of them no numbers: nothing is rounded before it is added."""
    k, kind, t = F.col("event_id"), F.col("event_type"), F.col("t")
    v = F.when((kind == "error") & (k % 50 == 3), float("nan")).when((kind == "view") & (k % 90 == 1), float("inf")).when(k % 11 == 0, F.lit(None).cast("double")).otherwise(F.col("value") / 100)
    sums = table(spark, sf_dir, "events").select("event_type", v.alias("v")).groupBy("event_type").agg(exact_sum(F.col("v")).alias("t"))
    finite = ~F.isnan(t) & (F.abs(t) < float("inf"))
    return sums.select("event_type", F.when(finite, F.round(t, 6)).alias("total"), F.isnan(t).alias("is_nan"), (F.abs(t) == float("inf")).alias("is_infinite"))


# ---- the same operators over line items, for volume


@query(f"SELECT timestamp, {DEC.format('value_mw')} AS shipped_mw, COUNT(*) AS shipped_rows FROM ship GROUP BY timestamp")
def v_a02_sum_count(spark, sf_dir):
    return analytics.by_timestamp(shipments(spark, sf_dir), "value_mw", "shipped")


@query(f"SELECT generator_id, COUNT(*) AS n, ROUND(AVG(value_mw), 6) AS mean_mw, MAX(value_mw) AS max_mw, {DEC.format('value_mw')} AS sum_mw FROM ship GROUP BY generator_id")
def v_a04_supplier_summary(spark, sf_dir):
    made = analytics.generator_summary(shipments(spark, sf_dir), "value_mw")
    return made.select("generator_id", "n", r6("mean_mw"), "max_mw", "sum_mw")


@query(f"WITH g AS (SELECT generator_id, {DEC.format('value_mw')} AS s FROM ship GROUP BY 1), total AS (SELECT {DEC.format('s')} AS t FROM g) SELECT ROUND(SUM(POW(s / t, 2)) * 10000, 6) AS hhi FROM g, total")
def v_a06_hhi(spark, sf_dir):
    return analytics.hhi(analytics.generator_summary(shipments(spark, sf_dir), "value_mw")).select(r6("hhi"))


@query(f"WITH d AS (SELECT timestamp, {DEC.format('value_mw')} AS v FROM ship GROUP BY timestamp) SELECT timestamp, v AS shipped_mw, ROUND(v - LAG(v) OVER (ORDER BY timestamp), 6) AS ramp FROM d")
def v_w01_ramp(spark, sf_dir):
    d = v_a02_sum_count(spark, sf_dir).select("timestamp", "shipped_mw")
    return series.ramps(d, ["shipped_mw"]).select("timestamp", "shipped_mw", F.round("shipped_mw_ramp", 6).alias("ramp"))


@query(f"SELECT generator_id, {DEC.format('value_mw')} AS sum_mw FROM ship GROUP BY 1 ORDER BY sum_mw DESC, generator_id LIMIT 15")
def v_t06_top_suppliers(spark, sf_dir):
    g = shipments(spark, sf_dir).groupBy("generator_id").agg(exact_sum(F.col("value_mw")).alias("sum_mw"))
    return series.top_by(g, F.col("sum_mw"), 15, F.col("generator_id"))
