"""Queries of lineage roll-ups, joins with defaults and reconciliations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.expressions import exact_sum
from ..operators import lineage
from ..sources.tables import table
from .registry import query
from .scans import AXIS_SQL, missing_january, unified

DAYS = f"{AXIS_SQL}, d AS (SELECT src.source, strftime(axis.timestamp, '%Y-%m-%d') AS day, COUNT(*) FILTER (m.timestamp IS NOT NULL) AS missing FROM axis CROSS JOIN src LEFT JOIN missing m ON m.source = src.source AND m.timestamp = axis.timestamp GROUP BY ALL)"


def missing_by_day(spark, sf_dir):
    """Each day of each source, with its missing slots; days without any count 0."""
    from ..schema import SIGNALS
    from .scans import january

    days = january(spark).select(F.date_format("timestamp", "yyyy-MM-dd").alias("day")).distinct()
    sources = spark.createDataFrame([(s,) for s in SIGNALS], "source string")
    n = missing_january(spark, sf_dir).groupBy("source", F.date_format("timestamp", "yyyy-MM-dd").alias("day")).agg(F.count("*").alias("missing"))
    return lineage.left_default(days.crossJoin(F.broadcast(sources)), n, ["source", "day"], "missing", 0)


@query("SELECT source, COUNT(*) AS n, CAST(SUM(CAST(value_mw AS DECIMAL(38,6))) AS DOUBLE) AS total_mw FROM unified GROUP BY GROUPING SETS ((source), ())")
def a21_grouping_sets(spark, sf_dir):
    return lineage.totals(unified(spark, sf_dir), "source", n=F.count("*"), total_mw=exact_sum(F.col("value_mw")))


@query(f"WITH {DAYS} SELECT source, COUNT(*) AS units, COUNT(*) FILTER (missing > 0) AS units_with_missing, CAST(SUM(missing) AS BIGINT) AS missing_slots, MAX(missing) AS max_missing, (arg_min(day, {{'n': -missing, 'day': day}})) AS worst_unit FROM d GROUP BY source")
def a22_missingness(spark, sf_dir):
    return lineage.missingness(missing_by_day(spark, sf_dir), "source", "day", "missing")


@query(f"WITH {DAYS} SELECT source, day AS worst_day FROM d QUALIFY ROW_NUMBER() OVER (PARTITION BY source ORDER BY missing DESC, day) = 1")
def a23_argmax_month(spark, sf_dir):
    made = lineage.missingness(missing_by_day(spark, sf_dir), "source", "day", "missing")
    return made.select("source", F.col("worst_unit").alias("worst_day"))


@query("SELECT o_orderstatus AS status, COUNT(*) AS n FROM orders GROUP BY 1", signals=False)
def a24_status_histogram(spark, sf_dir):
    return table(spark, sf_dir, "orders").groupBy(F.col("o_orderstatus").alias("status")).agg(F.count("*").alias("n"))


SIGNATURES = "g AS (SELECT strftime(o_orderdate, '%Y-%m') AS month, string_agg(DISTINCT o_orderpriority, '|' ORDER BY o_orderpriority) AS signature FROM orders GROUP BY 1)"


def signatures(spark, sf_dir):
    o = table(spark, sf_dir, "orders").groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("month"))
    return o.agg(F.array_join(F.array_sort(F.collect_set("o_orderpriority")), "|").alias("signature"))


@query(f"WITH {SIGNATURES} SELECT signature, COUNT(DISTINCT month) AS n, string_agg(DISTINCT month, ',' ORDER BY month) AS members FROM g GROUP BY signature", signals=False)
def a25_signature_months(spark, sf_dir):
    return lineage.grouped_lists(signatures(spark, sf_dir), "signature", "month")


@query(f"WITH {SIGNATURES} SELECT signature, COUNT(*) AS n FROM g GROUP BY signature", signals=False)
def a26_signature_histogram(spark, sf_dir):
    return signatures(spark, sf_dir).groupBy("signature").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "signature")


@query("SELECT event_type AS source, CAST(SUM(strlen(props)) AS BIGINT) AS bytes, COUNT(*) AS records FROM events GROUP BY 1", signals=False)
def a27_bytes_by_source(spark, sf_dir):
    return table(spark, sf_dir, "events").groupBy(F.col("event_type").alias("source")).agg(F.sum(F.octet_length("props")).alias("bytes"), F.count("*").alias("records"))


@query("SELECT ROUND(SUM(strlen(props)) / (SUM(strlen(props)) + 24 * COUNT(*)), 6) AS text_ratio, ROUND(SUM(strlen(event_type)) / SUM(strlen(props)), 6) AS type_ratio FROM events", signals=False)
def a30_ratios(spark, sf_dir):
    b, t = F.sum(F.octet_length("props")), F.sum(F.octet_length("event_type"))
    return table(spark, sf_dir, "events").agg(F.round(b / (b + 24 * F.count("*")), 6).alias("text_ratio"), F.round(t / b, 6).alias("type_ratio"))


@query("SELECT source, COUNT(DISTINCT CAST(timestamp AS DATE)) = 31 AS covers_all, string_agg(DISTINCT strftime(timestamp, '%d'), ',' ORDER BY strftime(timestamp, '%d')) AS days FROM unified GROUP BY source")
def a31_month_coverage(spark, sf_dir):
    days = F.array_sort(F.collect_set(F.date_format("timestamp", "dd")))
    return unified(spark, sf_dir).groupBy("source").agg((F.size(days) == 31).alias("covers_all"), F.array_join(days, ",").alias("days"))


@query("SELECT doc_id, 1 + length(text) - length(replace(text, chr(10), '')) AS n_lines FROM documents WHERE text IS NOT NULL", signals=False)
def a32_line_counts(spark, sf_dir):
    d = table(spark, sf_dir, "documents").where("text IS NOT NULL")
    return d.select("doc_id", (1 + F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit("")))).cast("long").alias("n_lines"))


@query(f"WITH {DAYS}, x(source, day, extra) AS (VALUES ('demand', '2024-01-03', 4), ('dispatch', '2024-01-09', 7)) SELECT d.source, d.day, COALESCE(x.extra, 0) AS extra, d.missing + COALESCE(x.extra, 0) AS downstream_missing FROM d LEFT JOIN x USING (source, day)")
def j06_left_default(spark, sf_dir):
    x = spark.createDataFrame([("demand", "2024-01-03", 4), ("dispatch", "2024-01-09", 7)], "source string, day string, extra int")
    made = lineage.left_default(missing_by_day(spark, sf_dir), x, ["source", "day"], "extra", 0)
    return made.select("source", "day", "extra", (F.col("missing") + F.col("extra")).alias("downstream_missing"))


@query("SELECT o_orderkey, COALESCE(c_name, 'unknown') AS c_name FROM orders LEFT JOIN customer ON c_custkey = o_custkey WHERE o_orderstatus = 'P'", signals=False)
def j07_lookup(spark, sf_dir):
    o, c = table(spark, sf_dir, "orders").where("o_orderstatus = 'P'"), table(spark, sf_dir, "customer")
    return o.join(c, o["o_custkey"] == c["c_custkey"], "left").select("o_orderkey", F.coalesce("c_name", F.lit("unknown")).alias("c_name"))


@query("WITH m AS (SELECT strftime(unnest(generate_series(DATE '2023-11-01', DATE '2024-03-01', INTERVAL 1 MONTH)), '%Y-%m') AS month), s(source) AS (VALUES ('demand'), ('dispatch'), ('state_estimation')), i AS (SELECT DISTINCT source, strftime(timestamp, '%Y-%m') AS month FROM unified) SELECT s.source, m.month, CASE WHEN i.month IS NULL THEN 'missing_post' ELSE 'found' END AS status FROM m CROSS JOIN s LEFT JOIN i ON i.source = s.source AND i.month = m.month")
def j08_cross_plan(spark, sf_dir):
    from ..functions.expressions import months
    from ..schema import SIGNALS

    wanted = spark.range(1).select(F.explode(months(F.lit("2023-11"), F.lit("2024-03"))).alias("month"))
    sources = spark.createDataFrame([(s,) for s in SIGNALS], "source string")
    index = unified(spark, sf_dir).select("source", F.date_format("timestamp", "yyyy-MM").alias("month"))
    return lineage.plan(wanted, sources, index)


@query("WITH e AS (SELECT c_name AS name, CAST(round(c_acctbal) AS BIGINT) AS expected_bytes FROM customer WHERE c_custkey % 3 <> 0), a AS (SELECT c_name AS name, CAST(round(c_acctbal) AS BIGINT) + CASE WHEN c_custkey % 7 = 0 THEN 1 ELSE 0 END AS actual_bytes FROM customer WHERE c_custkey % 5 <> 0) SELECT name, expected_bytes, actual_bytes, CASE WHEN actual_bytes IS NULL THEN 'missing' WHEN expected_bytes IS NULL THEN 'unexpected' WHEN actual_bytes <> expected_bytes THEN 'size_mismatch' ELSE 'ok' END AS status FROM e FULL JOIN a USING (name)", signals=False)
def j09_reconcile(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    size = F.round("c_acctbal").cast("long")
    e = c.where("c_custkey % 3 <> 0").select(F.col("c_name").alias("name"), size.alias("bytes"))
    a = c.where("c_custkey % 5 <> 0").select(F.col("c_name").alias("name"), (size + F.when(F.col("c_custkey") % 7 == 0, 1).otherwise(0)).alias("bytes"))
    return lineage.reconcile_files(e, a)


@query("WITH a AS (SELECT source, COUNT(*) AS n FROM unified GROUP BY 1), b AS (SELECT source, SUM(c) AS n FROM (SELECT source, timestamp, COUNT(*) AS c FROM unified GROUP BY ALL) GROUP BY 1) SELECT source, a.n AS loaded, CAST(b.n AS BIGINT) AS processed, a.n = b.n AS equal FROM a JOIN b USING (source)")
def q05_accounting(spark, sf_dir):
    u = unified(spark, sf_dir)
    a = u.groupBy("source").agg(F.count("*").alias("loaded"))
    b = u.groupBy("source", "timestamp").agg(F.count("*").alias("c")).groupBy("source").agg(F.sum("c").alias("processed"))
    return a.join(b, "source").withColumn("equal", F.col("loaded") == F.col("processed"))


@query("SELECT l_returnflag, l_linestatus, COUNT(*) AS n, CAST(SUM(CAST(l_quantity AS DECIMAL(38,6))) AS DOUBLE) AS quantity FROM lineitem GROUP BY GROUPING SETS ((l_returnflag, l_linestatus), (l_returnflag), ())", signals=False)
def v_a21_rollup(spark, sf_dir):
    r = table(spark, sf_dir, "lineitem").rollup("l_returnflag", "l_linestatus")
    return r.agg(F.count("*").alias("n"), exact_sum(F.col("l_quantity")).alias("quantity"))
