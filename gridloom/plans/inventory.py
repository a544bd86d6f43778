"""Queries of the smaller operators: previews, probes, guarded columns, lookups, set gates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import exact_sum, magic, months, share
from ..operators import gates, series
from ..schema import SLOTS_PER_DAY, VALUE_COLUMN
from ..sources.readers import month_range
from ..sources.tables import signals, table
from .lineage import DAYS, missing_by_day
from .registry import query
from .scans import AXIS_SQL, missing_january, unified


@query("SELECT event_id, ts, event_type FROM events ORDER BY event_id LIMIT 5", signals=False)
def s19_preview(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", "ts", "event_type").orderBy("event_id").limit(5)


@query("SELECT doc_id, length(x) - length(replace(x, ',', '')) AS commas, length(x) - length(replace(x, chr(9), '')) AS tabs, length(x) - length(replace(x, '|', '')) AS bars FROM (SELECT doc_id, split_part(text, chr(10), 1) AS x FROM documents WHERE text IS NOT NULL)", signals=False)
def s24_delimiters(spark, sf_dir):
    first = F.substring_index("text", "\n", 1)
    count = lambda c: (F.length("x") - F.length(F.replace("x", F.lit(c), F.lit("")))).cast("long")
    d = table(spark, sf_dir, "documents").where("text IS NOT NULL").select("doc_id", first.alias("x"))
    return d.select("doc_id", count(",").alias("commas"), count("\t").alias("tabs"), count("|").alias("bars"))


@query("SELECT page_id, lower(hex(encode(html))[1:16]) AS magic, strlen(html) >= 32 AS large_enough FROM pages", signals=False)
def s10_magic_f11_payload(spark, sf_dir):
    content = F.encode("html", "utf-8")
    return table(spark, sf_dir, "pages").select("page_id", magic(content).alias("magic"), (F.octet_length("html") >= 32).alias("large_enough"))


@query("SELECT source, CASE source WHEN 'demand' THEN 'demand_forecast_mw' WHEN 'dispatch' THEN 'dispatch_mw' ELSE 'estimated_generation_mw' END AS value_column, COUNT(*) AS n FROM unified GROUP BY ALL")
def p04_value_columns(spark, sf_dir):
    named = F.element_at(F.create_map(*[F.lit(x) for pair in VALUE_COLUMN.items() for x in pair]), F.col("source"))
    return unified(spark, sf_dir).groupBy("source", named.alias("value_column")).agg(F.count("*").alias("n"))


@query("WITH g AS (SELECT l_suppkey AS id, SUM(CASE WHEN l_suppkey % 2 = 0 THEN l_quantity ELSE 0 END) AS part, SUM(CASE WHEN l_suppkey % 3 = 0 THEN l_quantity ELSE 0 END) AS whole FROM lineitem GROUP BY 1) SELECT id, part, whole, ROUND(CASE WHEN whole <> 0 THEN 100 * part / whole END, 6) AS share_pct FROM g", signals=False)
def p08_guarded_share(spark, sf_dir):
    q, s = F.col("l_quantity"), F.col("l_suppkey")
    g = table(spark, sf_dir, "lineitem").groupBy(s.alias("id")).agg(F.sum(F.when(s % 2 == 0, q).otherwise(0.0)).alias("part"), F.sum(F.when(s % 3 == 0, q).otherwise(0.0)).alias("whole"))
    return g.withColumn("share_pct", F.round(share(F.col("part"), F.col("whole")), 6))


@query(f"WITH {DAYS} SELECT source, day, {SLOTS_PER_DAY} AS expected, missing, ROUND(100.0 * ({SLOTS_PER_DAY} - missing) / {SLOTS_PER_DAY}, 6) AS coverage_pct FROM d")
def p12_coverage_columns(spark, sf_dir):
    m = F.col("missing")
    return missing_by_day(spark, sf_dir).select("source", "day", F.lit(SLOTS_PER_DAY).alias("expected"), m, F.round(100.0 * (SLOTS_PER_DAY - m) / SLOTS_PER_DAY, 6).alias("coverage_pct"))


CATALOGUE = [("demand", "2024-01", "2024-01-03 00:00:00"), ("dispatch", "2024-01", "2024-01-09 00:00:00"), ("dispatch", "2024-02", "2024-02-01 00:00:00")]


@query("WITH x(source, month, stamp) AS (VALUES " + ", ".join(map(str, CATALOGUE)) + ") SELECT u.source, x.stamp, COUNT(*) AS n FROM unified u JOIN x ON x.source = u.source AND x.month = strftime(u.timestamp, '%Y-%m') GROUP BY ALL")
def f04_exception_lookup(spark, sf_dir):
    x = spark.createDataFrame(CATALOGUE, "source string, month string, stamp string")
    u = unified(spark, sf_dir).withColumn("month", F.date_format("timestamp", "yyyy-MM"))
    return u.join(F.broadcast(x), ["source", "month"]).groupBy("source", "stamp").agg(F.count("*").alias("n"))


@query("SELECT strftime(l_shipdate, '%Y-%m') AS month, COUNT(*) AS n FROM lineitem WHERE strftime(l_shipdate, '%Y-%m') BETWEEN '1996-02' AND '1996-06' GROUP BY 1", signals=False)
def f05_month_range(spark, sf_dir):
    """The range is one of the column as it is stored, so that it reaches the scan."""
    rows = month_range(table(spark, sf_dir, "lineitem"), "l_shipdate", "1996-02", "1996-06")
    return rows.groupBy(F.date_format("l_shipdate", "yyyy-MM").alias("month")).agg(F.count("*").alias("n"))


@query("WITH m AS (SELECT o_orderkey AS k, CAST(COUNT(*) OVER (PARTITION BY o_orderkey) AS BIGINT) + o_orderkey % 2 AS wanted FROM orders), f AS (SELECT l_orderkey AS k, COUNT(*) AS n_rows FROM lineitem GROUP BY 1) SELECT COALESCE(m.k, f.k) AS k, CASE WHEN f.k IS NULL THEN 'no_file' WHEN m.k IS NULL THEN 'no_manifest' ELSE 'row_count' END AS problem FROM m FULL JOIN f ON m.k = f.k WHERE f.k IS NULL OR m.k IS NULL OR wanted <> n_rows", signals=False)
def j10_manifest_reconcile(spark, sf_dir):
    m = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), (1 + F.col("o_orderkey") % 2).alias("wanted"))
    f = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("k")).agg(F.count("*").alias("n_rows"))
    problem = F.when(F.col("n_rows").isNull(), "no_file").when(F.col("wanted").isNull(), "no_manifest").when(F.col("wanted") != F.col("n_rows"), "row_count")
    return m.join(f, "k", "full").select("k", problem.alias("problem")).where("problem IS NOT NULL")


@query(f"WITH {AXIS_SQL}, r AS (SELECT source, timestamp, ROW_NUMBER() OVER (PARTITION BY source ORDER BY timestamp) AS n FROM missing) SELECT source, strftime(timestamp, '%Y-%m-%d %H:%M') AS example FROM r WHERE n <= 20")
def t07_first_examples(spark, sf_dir):
    """The first 20 missing slots of each source, kept as a bounded heap a task before they meet."""
    m = missing_january(spark, sf_dir)
    return series.top_per(m, ["source"], F.lit(0), 20, F.col("timestamp")).select("source", F.date_format("timestamp", "yyyy-MM-dd HH:mm").alias("example"))


@query("SELECT user_id, COUNT(*) AS n FROM events GROUP BY 1 ORDER BY n DESC, user_id LIMIT 10", signals=False)
def t08_histogram_top(spark, sf_dir):
    n = table(spark, sf_dir, "events").groupBy("user_id").agg(F.count("*").alias("n"))
    return series.top_by(n, F.col("n"), 10, F.col("user_id"))


@query("SELECT strftime(unnest(generate_series(DATE '2025-12-01', DATE '2026-02-01', INTERVAL 1 MONTH)), '%Y-%m') AS month", signals=False)
def t09_months_newest_first(spark, sf_dir):
    return spark.range(1).select(F.explode(months(F.lit("2025-12"), F.lit("2026-02"))).alias("month"))


@query("SELECT strftime(timestamp, '%Y-%m') AS month, source, COUNT(*) AS n FROM unified GROUP BY ALL")
def t10_month_source_order(spark, sf_dir):
    u = unified(spark, sf_dir).groupBy(F.date_format("timestamp", "yyyy-MM").alias("month"), "source")
    return u.agg(F.count("*").alias("n")).orderBy("month", "source")


@query("SELECT event_type, COUNT(*) AS n, ROUND(COUNT(*) / SUM(COUNT(*)) OVER (), 6) AS fraction FROM events GROUP BY 1", signals=False)
def w08_share_of_total(spark, sf_dir):
    n = table(spark, sf_dir, "events").groupBy("event_type").agg(F.count("*").alias("n"))
    total = n.agg(F.sum("n").alias("total"))
    return n.join(F.broadcast(total)).select("event_type", "n", F.round(F.col("n") / F.col("total"), 6).alias("fraction"))


@query("SELECT 'up' AS kind, COUNT(*) AS n FROM (SELECT demand_forecast_mw - LAG(demand_forecast_mw) OVER (ORDER BY timestamp) AS r FROM demand) WHERE r > 0 UNION ALL SELECT 'down', COUNT(*) FROM (SELECT demand_forecast_mw - LAG(demand_forecast_mw) OVER (ORDER BY timestamp) AS r FROM demand) WHERE r < 0")
def u02_ramp_events(spark, sf_dir):
    r = series.ramps(signals(spark, sf_dir)["demand"], ["demand_forecast_mw"]).withColumnRenamed("demand_forecast_mw_ramp", "r")
    parts = [r.where(c).agg(F.count("*").alias("n")).select(F.lit(k).alias("kind"), "n") for k, c in (("up", "r > 0"), ("down", "r < 0"))]
    return reduce(DataFrame.unionByName, parts)


@query("SELECT * FROM (SELECT 'events' AS report, CAST(ts AS DATE) AS day, COUNT(*) AS n FROM events GROUP BY ALL UNION ALL SELECT 'orders', CAST(o_orderdate AS DATE), COUNT(*) FROM orders GROUP BY ALL)", signals=False)
def u04_union_of_reports(spark, sf_dir):
    by_day = lambda t, c: table(spark, sf_dir, t).groupBy(F.to_date(c).alias("day")).agg(F.count("*").alias("n")).select(F.lit(t).alias("report"), "day", "n")
    return by_day("events", "ts").unionByName(by_day("orders", "o_orderdate"))


@query("WITH pinned AS (SELECT CASE WHEN event_type = 'view' THEN 'demand' WHEN event_type IN ('click', 'purchase') THEN 'dispatch' ELSE 'state_estimation' END AS source, CASE WHEN event_type = 'view' THEN COUNT(DISTINCT time_bucket(INTERVAL '5 minutes', ts)) ELSE COUNT(*) END AS wanted FROM events GROUP BY event_type), p AS (SELECT source, CAST(SUM(wanted) AS BIGINT) AS wanted FROM pinned GROUP BY 1), n AS (SELECT source, COUNT(*) AS n FROM unified GROUP BY 1) SELECT source, wanted, n, wanted = n AS passed FROM p JOIN n USING (source)")
def q02_pinned_totals(spark, sf_dir):
    """Totals that are known from elsewhere, here the raw events, against the unified table's."""
    kind = F.col("event_type")
    source = F.when(kind == "view", "demand").when(kind.isin("click", "purchase"), "dispatch").otherwise("state_estimation")
    by_kind = table(spark, sf_dir, "events").groupBy(kind, source.alias("source")).agg(F.when(kind == "view", F.count_distinct(F.window("ts", "5 minutes"))).otherwise(F.count("*")).alias("w"))
    pinned = by_kind.groupBy("source").agg(F.sum("w").alias("wanted"))
    n = unified(spark, sf_dir).groupBy("source").agg(F.count("*").alias("n"))
    return pinned.join(n, "source").withColumn("passed", F.col("wanted") == F.col("n"))


@query("SELECT column_name, FALSE AS documented FROM (VALUES ('value_mw')) t(column_name)", signals=False)
def q09_undocumented_columns(spark, sf_dir):
    """Columns of the unified table without a description in the dictionary given."""
    dictionary = spark.createDataFrame([("timestamp", "slot"), ("source", "signal"), ("generator_id", "generator"), ("value_mw", " ")], "column_name string, description string")
    columns = spark.createDataFrame([(c,) for c in unified(spark, sf_dir).columns], "column_name string")
    described = dictionary.where("trim(description) <> ''")
    return columns.join(described, "column_name", "left_anti").withColumn("documented", F.lit(False))


@query("WITH a AS (SELECT DISTINCT CAST(timestamp AS DATE) AS day FROM demand), b AS (SELECT DISTINCT CAST(timestamp AS DATE) AS day FROM dispatch) SELECT COUNT(*) = 0 AS equal_sets FROM ((SELECT * FROM a EXCEPT SELECT * FROM b) UNION ALL (SELECT * FROM b EXCEPT SELECT * FROM a))")
def q08_same_days(spark, sf_dir):
    t = signals(spark, sf_dir)
    days = [t[s].select(F.to_date("timestamp").alias("day")) for s in ("demand", "dispatch")]
    return gates.equal_sets(*days).agg((F.count("*") == 0).alias("equal_sets"))


@query("SELECT 'demand' AS signal, COUNT(*) FILTER (demand_ramp IS NOT NULL) AS n FROM (SELECT demand_forecast_mw - LAG(demand_forecast_mw) OVER (ORDER BY timestamp) AS demand_ramp FROM demand)")
def w02_demand_ramps_alone(spark, sf_dir):
    """Demand's ramps within the three-signal series differ from its own, as the series has rows without demand; this counts its own."""
    r = series.ramps(signals(spark, sf_dir)["demand"], ["demand_forecast_mw"])
    return r.agg(F.count("demand_forecast_mw_ramp").alias("n")).select(F.lit("demand").alias("signal"), "n")


@query("SELECT source, CAST(SUM(CAST(value_mw AS DECIMAL(38,6))) AS DOUBLE) AS total, COUNT(*) AS n FROM unified GROUP BY source")
def k08_manifest_rows(spark, sf_dir):
    return unified(spark, sf_dir).groupBy("source").agg(exact_sum(F.col("value_mw")).alias("total"), F.count("*").alias("n"))
