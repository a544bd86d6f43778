"""Queries of duplicates, quality counters, quantiles and gates."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import cleaning, gates, selection
from ..schema import DEMAND, DISPATCH, STATE
from ..sources.tables import shipments, signals, table
from .registry import query
from .scans import ODD_SQL, missing_january, AXIS_SQL, odd, unified

KEYS = ["source", "timestamp", "generator_id"]
BY_KEY = "k AS (SELECT source, timestamp, generator_id, COUNT(*) AS n, COUNT(DISTINCT value_mw) + MAX(CASE WHEN value_mw IS NULL THEN 1 ELSE 0 END) AS n_values FROM unified GROUP BY ALL)"


@query(f"WITH {BY_KEY} SELECT source, CAST(COALESCE(SUM(n) FILTER (n > 1), 0) AS BIGINT) AS members FROM k GROUP BY source")
def a09_dup_rows(spark, sf_dir):
    k = cleaning.key_counts(unified(spark, sf_dir), KEYS)
    return k.groupBy("source").agg(F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("members"))


@query(f"WITH {BY_KEY} SELECT source, CAST(SUM(n - 1) AS BIGINT) AS extra FROM k GROUP BY source")
def a10_dup_key_extra(spark, sf_dir):
    return cleaning.key_counts(unified(spark, sf_dir), KEYS).groupBy("source").agg(F.sum(F.col("n") - 1).alias("extra"))


@query("WITH k AS (SELECT source, timestamp, generator_id, value_mw, COUNT(*) AS n FROM unified GROUP BY ALL) SELECT source, CAST(SUM(n - 1) AS BIGINT) AS extra FROM k GROUP BY source")
def a11_dup_row_extra(spark, sf_dir):
    return cleaning.key_counts(unified(spark, sf_dir), [*KEYS, "value_mw"]).groupBy("source").agg(F.sum(F.col("n") - 1).alias("extra"))


@query(f"WITH {BY_KEY} SELECT source, n AS group_size, COUNT(*) AS n_keys FROM k GROUP BY source, n")
def a12_group_size_hist(spark, sf_dir):
    k = cleaning.key_counts(unified(spark, sf_dir), KEYS)
    return k.groupBy("source", F.col("n").alias("group_size")).agg(F.count("*").alias("n_keys"))


@query(f"WITH {BY_KEY} SELECT source, timestamp, generator_id, n, CAST(n_values AS BIGINT) AS n_values FROM k WHERE n_values > 1")
def a13_conflicting_keys(spark, sf_dir):
    return cleaning.conflicts(unified(spark, sf_dir), KEYS, "value_mw").where("n_values > 1")


PROBABILITIES = [0.0, 0.01, 0.05, 0.5, 0.95, 0.99, 1.0]


@query("SELECT unnest([0.0, 0.01, 0.05, 0.5, 0.95, 0.99, 1.0]::DOUBLE[]) AS probability, unnest(list_transform(quantile_cont(dispatch_mw, [0.0, 0.01, 0.05, 0.5, 0.95, 0.99, 1.0]), lambda x: ROUND(x, 6))) AS quantile FROM dispatch")
def a14_quantiles(spark, sf_dir):
    made = selection.quantiles(signals(spark, sf_dir)[DISPATCH], "dispatch_mw", PROBABILITIES)
    return made.select("probability", F.round("quantile", 6).alias("quantile"))


@query("SELECT l_returnflag, unnest([0.01, 0.5, 0.99]::DOUBLE[]) AS probability, unnest(list_transform(quantile_cont(l_extendedprice, [0.01, 0.5, 0.99]), lambda x: ROUND(x, 4))) AS quantile FROM lineitem GROUP BY l_returnflag", signals=False)
def v_a14_quantiles(spark, sf_dir):
    made = selection.quantiles(table(spark, sf_dir, "lineitem"), "l_extendedprice", [0.01, 0.5, 0.99], ["l_returnflag"])
    return made.select("l_returnflag", "probability", F.round("quantile", 4).alias("quantile"))


@query(f"{ODD_SQL} SELECT COUNT(*) AS n_rows, COUNT(*) FILTER (v IS NULL) AS n_null, COUNT(*) FILTER (isnan(v)) AS n_nan, COUNT(*) FILTER (v = 'Infinity'::DOUBLE) AS n_pos_inf, COUNT(*) FILTER (v = '-Infinity'::DOUBLE) AS n_neg_inf, COUNT(*) FILTER (isfinite(v) AND v < 0) AS n_negative, COUNT(*) FILTER (isfinite(v) AND v = 0) AS n_zero, COUNT(*) FILTER (isfinite(v)) AS n_finite FROM odd", signals=False)
def a15_numeric_quality(spark, sf_dir):
    return cleaning.numeric_quality(odd(spark, sf_dir), "v")


@query("SELECT source, MIN(timestamp) AS first_ts, MAX(timestamp) AS last_ts, COUNT(*) FILTER (timestamp IS NULL) AS n_null, COUNT(DISTINCT timestamp) AS n_distinct FROM unified GROUP BY source")
def a16_ts_summary(spark, sf_dir):
    t = F.col("timestamp")
    return unified(spark, sf_dir).groupBy("source").agg(F.min(t).alias("first_ts"), F.max(t).alias("last_ts"), F.count_if(t.isNull()).alias("n_null"), F.count_distinct(t).alias("n_distinct"))


@query("SELECT source, COUNT(DISTINCT generator_id) AS generators FROM unified GROUP BY source")
def a17_distinct_ids(spark, sf_dir):
    return unified(spark, sf_dir).groupBy("source").agg(F.count_distinct("generator_id").alias("generators"))


@query("SELECT timestamp, generator_id, value_mw FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY source, timestamp ORDER BY generator_id, value_mw) AS r FROM unified WHERE source = 'dispatch') WHERE r = 1")
def w05_keep_first(spark, sf_dir):
    d = unified(spark, sf_dir).where(F.col("source") == DISPATCH)
    return cleaning.keep_first(d, ["timestamp"], ["generator_id", "value_mw"]).select("timestamp", "generator_id", "value_mw")


@query("SELECT DISTINCT timestamp, source, generator_id, value_mw FROM unified")
def w06_exact_dedup(spark, sf_dir):
    return unified(spark, sf_dir).dropDuplicates()


@query("SELECT user_id, event_id, event_type FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id, strftime(ts, '%Y-%m') ORDER BY ts, event_id) AS r FROM events) WHERE r = 1", signals=False)
def w07_first_post(spark, sf_dir):
    e = table(spark, sf_dir, "events").withColumn("month", F.date_format("ts", "yyyy-MM"))
    return cleaning.keep_first(e, ["user_id", "month"], ["ts", "event_id"]).select("user_id", "event_id", "event_type")


@query("WITH k AS (SELECT timestamp, generator_id, COUNT(*) AS n FROM ship GROUP BY ALL), r AS (SELECT timestamp, generator_id, value_mw, COUNT(*) AS n FROM ship GROUP BY ALL) SELECT (SELECT CAST(SUM(n - 1) AS BIGINT) FROM k) AS key_extra, (SELECT CAST(SUM(n - 1) AS BIGINT) FROM r) AS row_extra")
def v_a10_a11_extra(spark, sf_dir):
    s = shipments(spark, sf_dir)
    rows = s.groupBy(*s.columns).agg(F.count("*").alias("n"))
    by_key = rows.groupBy("timestamp", "generator_id").agg(F.sum("n").alias("rows"), F.count("*").alias("different"))
    return by_key.agg(F.sum(F.col("rows") - 1).alias("key_extra"), F.sum(F.col("rows") - F.col("different")).alias("row_extra"))


@query(f"""WITH {AXIS_SQL}
SELECT 'has_rows' AS check_name, COUNT(*) > 0 AS passed FROM unified
UNION ALL SELECT 'sources_known', COALESCE(BOOL_AND(source IN ('demand', 'dispatch', 'state_estimation')), FALSE) FROM unified
UNION ALL SELECT 'demand_has_no_generator', COALESCE(BOOL_AND(source <> 'demand' OR generator_id IS NULL), FALSE) FROM unified
UNION ALL SELECT 'others_have_one', COALESCE(BOOL_AND(source = 'demand' OR generator_id IS NOT NULL), FALSE) FROM unified
UNION ALL SELECT 'on_the_grid', COALESCE(BOOL_AND(date_part('minute', timestamp) % 5 = 0 AND date_part('second', timestamp) = 0), FALSE) FROM unified
UNION ALL SELECT 'keys_unique', (SELECT COUNT(*) FROM unified) = (SELECT COUNT(*) FROM (SELECT DISTINCT source, timestamp, generator_id FROM unified))
UNION ALL SELECT 'complete', COUNT(*) = 0 FROM missing""")
def q_gate_report(spark, sf_dir):
    return gate_report(spark, sf_dir)


def gate_report(spark, sf_dir):
    u = unified(spark, sf_dir)
    s, t, g = F.col("source"), F.col("timestamp"), F.col("generator_id")
    rows = gates.checks(
        u,
        has_rows=F.count("*") > 0,
        sources_known=F.bool_and(s.isin(DEMAND, DISPATCH, STATE)),
        demand_has_no_generator=F.bool_and((s != DEMAND) | g.isNull()),
        others_have_one=F.bool_and((s == DEMAND) | g.isNotNull()),
        on_the_grid=F.bool_and((F.minute(t) % 5 == 0) & (F.second(t) == 0)),
    )
    unique = gates.checks(cleaning.key_counts(u, KEYS), keys_unique=F.max("n") == 1)
    complete = gates.checks(missing_january(spark, sf_dir), complete=F.count("*") == 0)
    return gates.all_checks(rows, unique, complete)


@query("WITH c(check_name, passed) AS (VALUES ('a', TRUE), ('b', TRUE)), n AS (SELECT COUNT(*) FILTER (o_totalprice < 0) AS bad FROM orders) SELECT CAST(2 AS BIGINT) AS n_checks, CAST(CASE WHEN bad > 0 THEN 1 ELSE 0 END AS BIGINT) AS n_failed, CASE WHEN bad > 0 THEN 'FAIL' ELSE 'PASS' END AS verdict FROM n", signals=False)
def q06_verdict(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return gates.verdict(gates.checks(o, no_negative=F.count_if(F.col("o_totalprice") < 0) == 0, has_rows=F.count("*") > 0))
