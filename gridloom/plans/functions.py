"""Queries of scalar functions, over texts made from the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import expressions as X
from ..sources.tables import table
from .registry import query

TEXTS_SQL = """t AS (SELECT event_id, CASE event_id % 7
 WHEN 0 THEN strftime(ts, '%Y-%m-%d %H:%M:%S') WHEN 1 THEN strftime(ts, '%Y/%m/%d %H:%M') WHEN 2 THEN strftime(ts, ' %Y-%m-%d ')
 WHEN 3 THEN strftime(ts, '%Y-%m-%d ') || CASE WHEN date_part('hour', ts) < 12 THEN '오전' ELSE '오후' END || strftime(ts, ' %I:%M:%S')
 WHEN 4 THEN strftime(ts, '%d-%m-%Y') WHEN 5 THEN strftime(ts, '%Y-%m-%d 24:00:00') ELSE NULL END AS text FROM events)"""


def _texts(spark, sf_dir):
    e, k = table(spark, sf_dir, "events"), F.col("event_id") % 7
    fmt = lambda p: F.date_format("ts", p)
    marker = F.when(F.hour("ts") < 12, X.AM).otherwise(X.PM)
    text = F.when(k == 0, fmt("yyyy-MM-dd HH:mm:ss")).when(k == 1, fmt("yyyy/MM/dd HH:mm")).when(k == 2, fmt(" yyyy-MM-dd ")).when(
        k == 3, F.concat(fmt("yyyy-MM-dd "), marker, fmt(" hh:mm:ss"))
    ).when(k == 4, fmt("dd-MM-yyyy")).when(k == 5, fmt("yyyy-MM-dd 24:00:00"))
    return e.select("event_id", text.alias("text"))


@query(f"""WITH {TEXTS_SQL}, n AS (SELECT event_id, text, replace(trim(text), '/', '-') AS x FROM t)
SELECT event_id, text, CASE WHEN contains(x, '오') THEN try_strptime(replace(replace(x, '오전', 'AM'), '오후', 'PM'), '%Y-%m-%d %p %I:%M:%S')
 WHEN length(x) = 10 THEN try_strptime(x, '%Y-%m-%d') WHEN length(x) = 16 THEN try_strptime(x, '%Y-%m-%d %H:%M') ELSE try_strptime(x, '%Y-%m-%d %H:%M:%S') END AS parsed FROM n""", signals=False)
def x_ts_parse(spark, sf_dir):
    return _texts(spark, sf_dir).withColumn("parsed", X.parse_ts(F.col("text")))


NUMBERS_SQL = "n AS (SELECT event_id, CASE event_id % 8 WHEN 0 THEN CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) WHEN 1 THEN ' ' || CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) || ' ' WHEN 2 THEN '1,000' WHEN 3 THEN '1d' WHEN 4 THEN 'inf' WHEN 5 THEN '-2.5e3' WHEN 6 THEN 'n/a' ELSE NULL END AS text FROM events)"


@query(f"WITH {NUMBERS_SQL} SELECT event_id, text, CASE WHEN regexp_full_match(trim(text), '[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?|[+-]?inf') THEN TRY_CAST(trim(text) AS DOUBLE) END AS number FROM n", signals=False)
def x_num_parse(spark, sf_dir):
    k, v = F.col("event_id") % 8, X.two_places(F.col("value")).cast("string")
    text = F.when(k == 0, v).when(k == 1, F.concat(F.lit(" "), v, F.lit(" "))).when(k == 2, "1,000").when(k == 3, "1d").when(k == 4, "inf").when(k == 5, "-2.5e3").when(k == 6, "n/a")
    rows = table(spark, sf_dir, "events").select("event_id", text.alias("text"))
    return rows.withColumn("number", X.to_num(F.col("text")))


@query("SELECT o_orderkey, CASE o_orderkey % 4 WHEN 3 THEN NULL ELSE strftime(o_orderdate, '20%y-%m') END AS month FROM orders WHERE o_orderdate < TIMESTAMP '1999-11-01'", signals=False)
def x_month_title(spark, sf_dir):
    """Titles are made of order dates, with centuries set to 20, as patterns only know those years."""
    o, k = table(spark, sf_dir, "orders").where("o_orderdate < TIMESTAMP_NTZ '1999-11-01 00:00:00'"), F.col("o_orderkey") % 4
    fmt = lambda p, d="o_orderdate": F.date_format(d, p)
    late = (F.col("o_orderdate") + F.expr("INTERVAL 40 DAYS")).alias("late")
    title = F.when(k == 0, fmt("'20'yy'년 'M'월 수요예측'")).when(k == 1, F.concat(F.lit("수요예측_20"), fmt("yyMM"))).when(k == 2, fmt("M'월분 실적'")).otherwise("unrelated")
    rows = o.select("o_orderkey", title.alias("title"), late).withColumn("published", F.concat(F.lit("20"), F.date_format("late", "yy/MM/dd")))
    return rows.select("o_orderkey", X.month_of_title(F.col("title"), F.col("published")).alias("month"))


@query("SELECT strftime(unnest(generate_series(DATE '2015-08-01', DATE '2026-07-01', INTERVAL 1 MONTH)), '%Y-%m') AS month", signals=False)
def x_month_axis(spark, sf_dir):
    return spark.range(1).select(F.explode(X.months(F.lit("2015-08"), F.lit("2026-07"))).alias("month"))


@query("SELECT doc_id, sha256(text) AS sha256 FROM documents", signals=False)
def x_sha256(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.sha2("text", 256).alias("sha256"))


@query("SELECT event_id, replace(replace(event_type, 'e', '%65'), '%65', 'e') || '.txt' AS name FROM events", signals=False)
def x_attachment_name(spark, sf_dir):
    header = F.concat(F.lit("attachment; filename*=UTF-8''"), F.replace("event_type", F.lit("e"), F.lit("%65")), F.lit(".txt"))
    return table(spark, sf_dir, "events").select("event_id", X.attachment_name(header).alias("name"))


@query(r"""WITH p AS (SELECT page_id, url, regexp_extract(url, '^([a-z]+:)', 1) AS scheme, regexp_extract(url, '^([a-z]+://[^/]*)', 1) AS site, regexp_extract(regexp_extract(url, '^[^?#]*'), '^[a-z]+://[^/]*(/.*/|/)', 1) AS folder FROM pages)
SELECT page_id, CASE page_id % 7 WHEN 0 THEN site || '/a/b.zip' WHEN 1 THEN 'https://other.example.com/x' WHEN 2 THEN scheme || '//cdn.example.org/y' WHEN 3 THEN regexp_extract(url, '^[^?#]*') || '?page=3'
 WHEN 4 THEN regexp_extract(url, '^[^#]*') || '#top' WHEN 5 THEN site || regexp_replace(folder, '(.)[^/]*/$', '\1') || 'z.html' ELSE site || folder || 'sub/w?q=1' END AS joined FROM p""", signals=False)
def x_url_join(spark, sf_dir):
    """References of seven kinds on each page's URL."""
    kinds = ["/a/b.zip", "https://other.example.com/x", "//cdn.example.org/y", "?page=3", "#top", "../z.html", "sub/./w?q=1"]
    ref = F.element_at(F.array(*map(F.lit, kinds)), (F.col("page_id") % 7 + 1).cast("int"))
    return table(spark, sf_dir, "pages").select("page_id", X.url_join(F.col("url"), ref).alias("joined"))


@query(r"SELECT page_id, trim(regexp_replace(regexp_replace(regexp_replace(html, '(?is)<(script|style)[^>]*>.*?</(script|style)>', ' ', 'g'), '(?s)<[^>]+>', ' ', 'g'), '\s+', ' ', 'g')) AS text FROM pages", signals=False)
def x_plain_text(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", X.plain_text(F.col("html")).alias("text"))


@query("SELECT event_id, event_type, json_extract_string(props, '$.k') AS k, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS iso, substr(event_type, 1, 3) AS head FROM events", signals=False)
def x_json_iso(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", "event_type", F.get_json_object("props", "$.k").alias("k"), X.iso_text(F.col("ts")).alias("iso"), F.substring("event_type", 1, 3).alias("head"))
