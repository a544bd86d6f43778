"""Queries of scans, projections, filters and set operations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import exact_sum, no_nan, ts_text, two_places
from ..operators import cleaning, completeness, lineage, normalize
from ..operators.analytics import min_max, reconcile
from ..schema import DEMAND, DISPATCH, STATE
from ..sources.readers import load_window
from ..sources.tables import shipments, signals, table
from .registry import query


def unified(spark, sf_dir) -> DataFrame:
    return normalize.unify(signals(spark, sf_dir))


@query("SELECT timestamp, source, generator_id, value_mw FROM unified")
def p03_unify_long(spark, sf_dir):
    return unified(spark, sf_dir)


@query("SELECT timestamp, generator_id, value_mw FROM unified WHERE source = 'dispatch' AND timestamp >= TIMESTAMP '2024-01-10' AND timestamp < TIMESTAMP '2024-01-12'")
def s16_load_window(spark, sf_dir):
    return load_window(unified(spark, sf_dir), DISPATCH, "2024-01-10 00:00:00", "2024-01-12 00:00:00", ["timestamp", "generator_id", "value_mw"])


@query("SELECT timestamp, source, generator_id, value_mw FROM unified WHERE timestamp >= TIMESTAMP '2024-01-05' AND timestamp < TIMESTAMP '2024-01-06'")
def s17_time_slice(spark, sf_dir):
    return load_window(unified(spark, sf_dir), None, "2024-01-05 00:00:00", "2024-01-06 00:00:00", ["timestamp", "source", "generator_id", "value_mw"])


@query("SELECT ts AS timestamp FROM events", signals=False)
def s13_timestamp_scan(spark, sf_dir):
    return table(spark, sf_dir, "events").select(F.col("ts").alias("timestamp"))


@query(" UNION ALL ".join(f"SELECT '{t}' AS table_name, COUNT(*) AS n_rows FROM {t}" for t in ("customer", "events", "lineitem", "orders", "part")), signals=False)
def s15_row_counts(spark, sf_dir):
    names = ("customer", "events", "lineitem", "orders", "part")
    return reduce(DataFrame.unionByName, [table(spark, sf_dir, t).agg(F.count("*").alias("n_rows")).select(F.lit(t).alias("table_name"), "n_rows") for t in names])


@query("SELECT o_orderkey, o_orderdate, strftime(o_orderdate, '%Y-%m') AS month FROM orders WHERE strftime(o_orderdate, '%Y-%m') BETWEEN '1995-03' AND '1995-05'", signals=False)
def s22_month_range(spark, sf_dir):
    span = (F.col("o_orderdate") >= F.expr("TIMESTAMP_NTZ '1995-03-01 00:00:00'")) & (F.col("o_orderdate") < F.expr("TIMESTAMP_NTZ '1995-06-01 00:00:00'"))
    return table(spark, sf_dir, "orders").where(span).select("o_orderkey", "o_orderdate", F.date_format("o_orderdate", "yyyy-MM").alias("month"))


@query("""SELECT '"' || strftime(timestamp, '%Y-%m-%d %H:%M:%S') || '","' || source || '",' || coalesce('"' || generator_id || '"', '') || ',' || coalesce(CAST(CAST(value_mw AS DECIMAL(18,2)) AS VARCHAR), '') AS value FROM unified""")
def p05_csv_text(spark, sf_dir):
    fixed = unified(spark, sf_dir).withColumn("value_mw", two_places(F.col("value_mw")))
    return normalize.csv_rows(fixed)


RECONCILED = """
p AS (SELECT timestamp, CAST(SUM(CAST(dispatch_mw AS DECIMAL(38,6))) AS DOUBLE) AS dispatch_mw, COUNT(*) AS dispatch_rows FROM dispatch WHERE dispatch_mw IS NOT NULL GROUP BY timestamp),
s AS (SELECT timestamp, CAST(SUM(CAST(estimated_generation_mw AS DECIMAL(38,6))) AS DOUBLE) AS state_mw, COUNT(*) AS state_rows FROM state WHERE estimated_generation_mw IS NOT NULL GROUP BY timestamp),
three AS (SELECT timestamp, demand_forecast_mw AS demand_mw, dispatch_mw, dispatch_rows, state_mw, state_rows
  FROM demand FULL JOIN p USING (timestamp) FULL JOIN s USING (timestamp))
"""


def three(spark, sf_dir) -> DataFrame:
    t = signals(spark, sf_dir)
    return reconcile(t[DEMAND], t[DISPATCH], t[STATE])


@query(f"WITH {RECONCILED} SELECT * FROM three")
def j01_three_way_outer(spark, sf_dir):
    return three(spark, sf_dir).select("timestamp", "demand_mw", "dispatch_mw", "dispatch_rows", "state_mw", "state_rows")


@query(f"""WITH {RECONCILED} SELECT timestamp, ROUND(dispatch_mw - demand_mw, 6) AS dispatch_minus_demand, ROUND(state_mw - demand_mw, 6) AS state_minus_demand, ROUND(state_mw - dispatch_mw, 6) AS state_minus_dispatch FROM three""")
def p06_signal_gaps(spark, sf_dir):
    names = ("dispatch_minus_demand", "state_minus_demand", "state_minus_dispatch")
    return three(spark, sf_dir).select("timestamp", *[F.round(n, 6).alias(n) for n in names])


@query("SELECT generator_id, ROUND(CAST(SUM(CAST(dispatch_mw AS DECIMAL(38,6))) AS DOUBLE) * (5.0 / 60.0), 6) AS energy_mwh FROM dispatch GROUP BY generator_id")
def p07_energy_proxy(spark, sf_dir):
    d = signals(spark, sf_dir)[DISPATCH]
    return d.groupBy("generator_id").agg(F.round(exact_sum(F.col("dispatch_mw")) * (5.0 / 60.0), 6).alias("energy_mwh"))


@query("SELECT timestamp, source, generator_id, value_mw AS mw_value FROM unified")
def p10_rename(spark, sf_dir):
    return unified(spark, sf_dir).withColumnRenamed("value_mw", "mw_value")


@query("SELECT DISTINCT source || '_' || replace(strftime(timestamp, '%Y-%m'), '-', '_') || '.parquet' AS release_file FROM unified")
def p13_release_names(spark, sf_dir):
    month = F.translate(F.date_format("timestamp", "yyyy-MM"), "-", "_")
    return unified(spark, sf_dir).select(F.concat("source", F.lit("_"), month, F.lit(".parquet")).alias("release_file")).distinct()


@query("""WITH b AS (SELECT CAST(SUM(strlen(props)) AS BIGINT) AS bytes FROM events), h(horizon, months) AS (VALUES ('one_month', 1), ('one_year', 12), ('three_years', 36), ('five_years', 60), ('eleven_years', 132))
SELECT horizon, months, bytes * months AS projected_bytes, ROUND(bytes * months / 1e9, 3) AS projected_gb FROM b, h""")
def p14_size_projection(spark, sf_dir):
    b = table(spark, sf_dir, "events").agg(F.sum(F.octet_length("props")).alias("bytes"))
    return lineage.size_projection(b, {"one_month": 1, "one_year": 12, "three_years": 36, "five_years": 60, "eleven_years": 132})


@query("""SELECT timestamp, ROUND((demand_forecast_mw - MIN(demand_forecast_mw) OVER w) / GREATEST(MAX(demand_forecast_mw) OVER w - MIN(demand_forecast_mw) OVER w, 1.0), 6) AS normalized
FROM demand WINDOW w AS (PARTITION BY CAST(timestamp AS DATE))""")
def p15_minmax(spark, sf_dir):
    d = signals(spark, sf_dir)[DEMAND].withColumn("date", F.to_date("timestamp"))
    return min_max(d, "demand_forecast_mw", ["date"]).select("timestamp", F.round("normalized", 6).alias("normalized"))


@query("SELECT timestamp, generator_id, dispatch_mw FROM dispatch WHERE timestamp NOT IN (SELECT timestamp FROM state WHERE estimated_generation_mw > 200)")
def f03_drop_timestamps(spark, sf_dir):
    t = signals(spark, sf_dir)
    return cleaning.drop_timestamps(t[DISPATCH], t[STATE].where("estimated_generation_mw > 200")).select("timestamp", "generator_id", "dispatch_mw")


@query("SELECT timestamp, value_mw FROM unified WHERE timestamp IS NOT NULL AND value_mw IS NOT NULL")
def f02_null_rejection(spark, sf_dir):
    return unified(spark, sf_dir).select("timestamp", "value_mw").dropna()


@query("SELECT event_id, n FROM (SELECT event_id, CASE WHEN event_id % 7 = 0 THEN NULL WHEN event_id % 11 = 0 THEN ' ' ELSE event_type END AS n FROM events) WHERE n IS NULL OR trim(n) = ''", signals=False)
def f07_blank_ids(spark, sf_dir):
    n = F.when(F.col("event_id") % 7 == 0, F.lit(None).cast("string")).when(F.col("event_id") % 11 == 0, " ").otherwise(F.col("event_type"))
    return cleaning.blank_ids(table(spark, sf_dir, "events").select("event_id", n.alias("n")), "n")


@query("""WITH d AS (SELECT CAST(timestamp AS DATE) AS day, COUNT(*) FILTER (value_mw IS NULL) AS nulls, COUNT(*) FILTER (value_mw < 0) AS negatives, COUNT(*) - COUNT(DISTINCT generator_id) AS repeated, COUNT(*) FILTER (value_mw > 400) AS extremes FROM unified WHERE source = 'dispatch' GROUP BY 1)
SELECT * FROM d WHERE nulls > 0 OR negatives > 0 OR repeated > 60 OR extremes > 2""")
def f08_anomalies(spark, sf_dir):
    u = unified(spark, sf_dir).where(F.col("source") == DISPATCH)
    v = F.col("value_mw")
    d = u.groupBy(F.to_date("timestamp").alias("day")).agg(
        F.count_if(v.isNull()).alias("nulls"), F.count_if(v < 0).alias("negatives"), (F.count("*") - F.count_distinct("generator_id")).alias("repeated"), F.count_if(v > 400).alias("extremes")
    )
    return d.where("nulls > 0 OR negatives > 0 OR repeated > 60 OR extremes > 2")


ODD_SQL = """WITH odd AS (SELECT event_id, CASE event_id % 40 WHEN 0 THEN NULL WHEN 1 THEN 'NaN'::DOUBLE WHEN 2 THEN 'Infinity'::DOUBLE WHEN 3 THEN '-Infinity'::DOUBLE WHEN 4 THEN -value WHEN 5 THEN 0 ELSE value END AS v FROM events)"""


def odd(spark, sf_dir) -> DataFrame:
    k, v = F.col("event_id") % 40, F.col("value")
    made = F.when(k == 1, float("nan")).when(k == 2, float("inf")).when(k == 3, float("-inf")).when(k == 4, -v).when(k == 5, 0.0).when(k > 5, v)
    return table(spark, sf_dir, "events").select("event_id", made.alias("v"))


@query(f"{ODD_SQL} SELECT event_id, v FROM odd WHERE isfinite(v)", signals=False)
def f09_finite_only(spark, sf_dir):
    v = no_nan(F.col("v"))
    return odd(spark, sf_dir).where(F.abs(v) < float("inf"))


@query("SELECT timestamp, demand_forecast_mw FROM demand WHERE CAST(timestamp AS DATE) = DATE '2024-01-15'")
def f10_calendar_day(spark, sf_dir):
    d = signals(spark, sf_dir)[DEMAND]
    return d.where("timestamp >= TIMESTAMP_NTZ '2024-01-15 00:00:00' AND timestamp < TIMESTAMP_NTZ '2024-01-16 00:00:00'")


@query("SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'F' OR starts_with(o_orderpriority, '1')", signals=False)
def f06_status_filter(spark, sf_dir):
    return table(spark, sf_dir, "orders").where((F.col("o_orderstatus") == "F") | F.col("o_orderpriority").startswith("1")).select("o_orderkey", "o_orderstatus")


AXIS_SQL = "axis AS (SELECT unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-31 23:55:00', INTERVAL 5 MINUTES)) AS timestamp), src(source) AS (VALUES ('demand'), ('dispatch'), ('state_estimation')), missing AS (SELECT source, axis.timestamp FROM axis CROSS JOIN src WHERE NOT EXISTS (SELECT 1 FROM unified u WHERE u.source = src.source AND u.timestamp = axis.timestamp))"


def january(spark) -> DataFrame:
    return completeness.axis(spark, "2024-01-01 00:00:00", "2024-02-01 00:00:00")


def missing_january(spark, sf_dir) -> DataFrame:
    """Three sources are a bounded side of the product."""
    sources = spark.createDataFrame([(DEMAND,), (DISPATCH,), (STATE,)], "source string")
    return completeness.missing(january(spark).crossJoin(F.broadcast(sources)), unified(spark, sf_dir), ["source"])


@query(f"WITH {AXIS_SQL} SELECT source, timestamp FROM missing")
def j03_missing_slots(spark, sf_dir):
    return missing_january(spark, sf_dir).select("source", "timestamp")


@query("SELECT DISTINCT timestamp FROM demand WHERE timestamp < TIMESTAMP '2024-01-03' OR timestamp >= TIMESTAMP '2024-01-20'")
def j04_outside_slots(spark, sf_dir):
    return completeness.outside(completeness.axis(spark, "2024-01-03 00:00:00", "2024-01-20 00:00:00"), signals(spark, sf_dir)[DEMAND])


@query(f"WITH {AXIS_SQL} SELECT timestamp FROM missing GROUP BY timestamp HAVING COUNT(*) = 3")
def j05_shared_gaps(spark, sf_dir):
    m = missing_january(spark, sf_dir)
    return completeness.shared(*[m.where(F.col("source") == s) for s in (DEMAND, DISPATCH, STATE)])


@query(f"""WITH {AXIS_SQL}, k AS (SELECT source, strftime(timestamp, '%Y-%m') AS month, timestamp - INTERVAL 5 MINUTES * (ROW_NUMBER() OVER (PARTITION BY source ORDER BY timestamp)) AS island, timestamp FROM missing),
r AS (SELECT source, month, MIN(timestamp) AS run_start, MAX(timestamp) AS run_end, COUNT(*) AS slots FROM k GROUP BY source, month, island)
SELECT source, month, run_start, run_end, slots FROM r QUALIFY ROW_NUMBER() OVER (PARTITION BY source, month ORDER BY slots DESC, run_start) = 1""")
def w04_longest_gap(spark, sf_dir):
    m = missing_january(spark, sf_dir).withColumn("month", F.date_format("timestamp", "yyyy-MM"))
    return completeness.longest_run(m, ["source", "month"])


@query("""WITH span AS (SELECT source, MIN(timestamp) AS a, MAX(timestamp) AS b FROM unified WHERE timestamp IS NOT NULL GROUP BY source),
slots AS (SELECT source, unnest(generate_series(a, b, INTERVAL 5 MINUTES)) AS timestamp FROM span),
gone AS (SELECT * FROM slots s WHERE NOT EXISTS (SELECT 1 FROM unified u WHERE u.source = s.source AND u.timestamp = s.timestamp)),
k AS (SELECT *, timestamp - INTERVAL 5 MINUTES * (ROW_NUMBER() OVER (PARTITION BY source ORDER BY timestamp)) AS island FROM gone),
r AS (SELECT source, MIN(timestamp) AS run_start, MAX(timestamp) AS run_end, COUNT(*) AS slots FROM k GROUP BY source, island)
SELECT source, run_start, run_end, slots FROM r QUALIFY ROW_NUMBER() OVER (PARTITION BY source ORDER BY slots DESC, run_start) = 1""")
def g03_longest_gap_of_history(spark, sf_dir):
    """Over the borders of days and months, by merging states of days."""
    return completeness.longest_run(completeness.gaps(unified(spark, sf_dir), ["source"]), ["source"])


@query("""WITH d AS (SELECT DISTINCT generator_id, CAST(timestamp AS DATE) AS day FROM ship), k AS (SELECT *, day - CAST(ROW_NUMBER() OVER (PARTITION BY generator_id ORDER BY day) AS INTEGER) AS island FROM d),
r AS (SELECT generator_id, CAST(MIN(day) AS TIMESTAMP) AS run_start, CAST(MAX(day) AS TIMESTAMP) AS run_end, COUNT(*) AS slots FROM k GROUP BY generator_id, island)
SELECT generator_id, run_start, run_end, slots FROM r QUALIFY ROW_NUMBER() OVER (PARTITION BY generator_id ORDER BY slots DESC, run_start) = 1""")
def v_g03_longest_streak(spark, sf_dir):
    """The longest run of days on which a supplier ships."""
    return completeness.longest_run(shipments(spark, sf_dir), ["generator_id"], minutes=24 * 60)


@query("SELECT timestamp, demand_mw, dispatch_mw, ROUND(dispatch_mw - demand_mw, 6) AS difference FROM (SELECT timestamp, demand_forecast_mw AS demand_mw, d.mw AS dispatch_mw FROM demand JOIN (SELECT timestamp, CAST(SUM(CAST(dispatch_mw AS DECIMAL(38,6))) AS DOUBLE) AS mw FROM dispatch GROUP BY timestamp) d USING (timestamp)) WHERE demand_mw IS NOT NULL AND dispatch_mw IS NOT NULL")
def j02_inner_diff(spark, sf_dir):
    t = signals(spark, sf_dir)
    d = t[DISPATCH].groupBy("timestamp").agg(exact_sum(F.col("dispatch_mw")).alias("dispatch_mw"))
    both = t[DEMAND].withColumnRenamed("demand_forecast_mw", "demand_mw").join(d, "timestamp").dropna()
    return both.select("timestamp", "demand_mw", "dispatch_mw", F.round(F.col("dispatch_mw") - F.col("demand_mw"), 6).alias("difference"))


@query("SELECT timestamp FROM demand UNION ALL SELECT timestamp FROM dispatch UNION ALL SELECT timestamp FROM state")
def u01_union_all(spark, sf_dir):
    return reduce(DataFrame.unionByName, [d.select("timestamp") for d in signals(spark, sf_dir).values()])


@query("SELECT DISTINCT timestamp FROM unified")
def u05_distinct(spark, sf_dir):
    return unified(spark, sf_dir).select("timestamp").distinct()


@query("SELECT timestamp FROM demand INTERSECT SELECT timestamp FROM dispatch INTERSECT SELECT timestamp FROM state")
def u06_intersect(spark, sf_dir):
    return completeness.shared(*signals(spark, sf_dir).values())


@query("SELECT timestamp FROM dispatch EXCEPT SELECT timestamp FROM demand")
def u07_except(spark, sf_dir):
    t = signals(spark, sf_dir)
    return t[DISPATCH].select("timestamp").subtract(t[DEMAND].select("timestamp"))


@query("SELECT generator_id FROM dispatch UNION SELECT generator_id FROM state")
def u08_union_distinct(spark, sf_dir):
    t = signals(spark, sf_dir)
    return t[DISPATCH].select("generator_id").union(t[STATE].select("generator_id")).distinct()


@query("WITH a AS (SELECT DISTINCT c_custkey AS k FROM customer WHERE c_mktsegment <> 'BUILDING'), b AS (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderstatus = 'F') SELECT k AS member, 'left' AS side FROM a WHERE k NOT IN (SELECT k FROM b) UNION ALL SELECT k, 'right' FROM b WHERE k NOT IN (SELECT k FROM a)", signals=False)
def u09_set_equality(spark, sf_dir):
    from ..operators.gates import equal_sets

    return equal_sets(table(spark, sf_dir, "customer").where("c_mktsegment <> 'BUILDING'").select("c_custkey"), table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select("o_custkey"))


@query("SELECT timestamp, source FROM unified")
def t01_time_sort(spark, sf_dir):
    return unified(spark, sf_dir).select("timestamp", "source").orderBy("timestamp")


@query("SELECT strftime(timestamp, '%Y-%m-%d %H:%M:%S') AS text, generator_id FROM dispatch")
def x_ts_text(spark, sf_dir):
    return signals(spark, sf_dir)[DISPATCH].select(ts_text(F.col("timestamp")).alias("text"), "generator_id")


@query("SELECT timestamp, generator_id, COUNT(*) AS n FROM ship GROUP BY ALL HAVING COUNT(*) > 1")
def v_shipments_repeated(spark, sf_dir):
    return cleaning.key_counts(shipments(spark, sf_dir), ["timestamp", "generator_id"]).where("n > 1")
