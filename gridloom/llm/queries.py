"""The queries opN_<name>: each operator over its whole tables, with the columns of its contract."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import attention, centroids, chat, decontamination, licenses, lsh_forest, packing, periodic, pii, pitman_yor, quality, substrings, toxicity
from .common import remainder, table


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.digest(packing.pack(table(spark, sf_dir, "documents"), tokenizer_path()))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.judge(docs, model, keep=["doc_id"])


def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return found.select("doc_id", F.array_join("sentence_ids", ",").alias("sentence_ids"), F.array_join("licenses", ",").alias("licenses"))


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.find_pii(table(spark, sf_dir, "documents"), keep=["doc_id"]))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substrings.repeated_spans(table(spark, sf_dir, "documents"))
    shown = F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["start"], s["end"])), ",")
    chars = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select("doc_id", F.size("spans").cast("long").alias("n_spans"), chars.alias("removed_chars"), shown.alias("removed_spans"))


def op7_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    probe = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select(*probe.columns).unionByName(probe)
    return chat.read_back(chat.format_conversations(chat.replayed(rows)))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), toxicity.TRAIN)
    return _held_out(toxicity.score(docs, model, keep=["doc_id"]), 3, 1).select("doc_id", "held_out", "score", "predicted", "evidence")


def op9_attention(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = attention.fit(docs, table(spark, sf_dir, "labels"), remainder(4) != 2)
    return _held_out(attention.score(docs, model, keep=["doc_id"]), 4, 2).select("doc_id", "held_out", "score", "predicted", "top_passage")


def op10_lsh_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lsh_forest.near_duplicates(table(spark, sf_dir, "documents"), 85).select("doc_id", "n_shingles", "component_id", "kept")


def op11_periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.digest(periodic.find_runs(table(spark, sf_dir, "documents"), periodic.planted, keep=["doc_id"]))


def op12_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pitman_yor.score(table(spark, sf_dir, "documents"), remainder(7) == 2)


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.digest(*centroids.cluster(centroids.whole(table(spark, sf_dir, "embeddings"))))


def base2_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What op2 counts before its model judges."""
    return op2_quality_rules(spark, sf_dir).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def base4_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What op4 counts by the base patterns."""
    return op4_pii(spark, sf_dir).select("doc_id", "n_email", "n_ip", "n_card", "n_phone")


def base12_unigrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The score of single words that op12's is held against, to six digits; no pair is counted for it."""
    made = pitman_yor.base_scores(table(spark, sf_dir, "documents"), remainder(7) == 2)
    return made.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", F.round("base_score", 6).alias("base_score"))


def _held_out(scored: DataFrame, by: int, rest: int) -> DataFrame:
    return scored.withColumn("held_out", remainder(by) == rest).withColumn("predicted", (F.col("score") >= 0.7).cast("int"))


OP7_SQL = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (
  SELECT *, length(text) + length(role) + length(regexp_replace(text || role, '[^\\<\[]', '', 'g')) + 24 AS shown FROM c)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(shown) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""

OP10_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
    ELSE list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' ')) END) AS shingle FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS both_n FROM s x JOIN s y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id GROUP BY ALL),
link AS (
  SELECT p.a, p.b FROM p JOIN n na ON na.doc_id = p.a JOIN n nb ON nb.doc_id = p.b WHERE 100 * both_n >= 85 * (na.n + nb.n - both_n)),
reach(doc_id, node) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, l.b FROM reach r JOIN link l ON l.a = r.node)
SELECT r.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(r.node) AS component_id, r.doc_id = min(r.node) AS kept
FROM reach r LEFT JOIN n ON n.doc_id = r.doc_id GROUP BY r.doc_id
"""

BASE2_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT r, doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM d),
three AS (SELECT r, i, array_to_string(words[i:i + 2], chr(10)) AS t FROM (SELECT r, words, unnest(range(1, len(words) - 1)) AS i FROM w WHERE len(words) >= 3)),
again AS (SELECT r, i FROM three QUALIFY count(*) OVER (PARTITION BY r, t) > 1),
repeated AS (SELECT r, count(DISTINCT i) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS i FROM again) GROUP BY r),
line AS (SELECT r, unnest(string_split(text, chr(10))) AS l FROM d),
copies AS (SELECT r, count(*) - count(DISTINCT l) AS n FROM line WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY r),
n AS (
  SELECT doc_id, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars, length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    coalesce(copies.n, 0) AS n_dup_lines, coalesce(repeated.n, 0) AS n_repeat_words
  FROM w LEFT JOIN copies ON copies.r = w.r LEFT JOIN repeated ON repeated.r = w.r)
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM n
"""

BASE4_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
found AS (
  SELECT doc_id, regexp_extract_all(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+') AS email, regexp_extract_all(text, '[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)') AS ip,
    list_transform(regexp_extract_all(text, '[0-9]([\x20-]?[0-9])+'), lambda x: regexp_replace(x, '[^0-9]', '', 'g')) AS card,
    list_transform(regexp_extract_all(text, '\+[0-9][\x20().0-9-]+[0-9]'), lambda x: regexp_replace(x, '[^0-9]', '', 'g')) AS phone
  FROM d)
SELECT doc_id, len(email) AS n_email, len(list_filter(ip, lambda x: len(list_filter(string_split(x, '.'), lambda p: CAST(p AS HUGEINT) > 255)) = 0)) AS n_ip,
  len(list_filter(card, lambda x: length(x) BETWEEN 12 AND 19 AND
    list_sum(list_transform(range(length(x)), lambda i: CASE WHEN i % 2 = 0 THEN CAST(x[length(x) - i] AS INTEGER) ELSE (2 * CAST(x[length(x) - i] AS INTEGER)) // 10 + (2 * CAST(x[length(x) - i] AS INTEGER)) % 10 END)) % 10 = 0)) AS n_card,
  len(list_filter(phone, lambda x: length(x) BETWEEN 9 AND 15)) AS n_phone
FROM found
"""

BASE12_SQL = r"""
WITH table_of AS (
  SELECT list(list_reduce(list_prepend(k, range(8)), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY k) AS t FROM range(256) r(k)),
d AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id,
    list_append(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), ' ') AS tokens,
    xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
      lambda c, b: xor(c >> 8, t[CAST(xor(c, b) & 255 AS INTEGER) + 1])), 4294967295) % 7 = 2 AS held_out
  FROM documents, table_of),
c AS (SELECT token, count(*) AS c FROM (SELECT unnest(tokens) AS token FROM d WHERE NOT held_out) GROUP BY token),
total AS (SELECT CAST(sum(c) AS BIGINT) AS n, count(*) AS v FROM c)
SELECT doc_id, held_out, count(*) AS n_tokens, count(c.c) AS n_known, any_value(n) AS train_tokens, ROUND(sum(log10((coalesce(c.c, 0) + 1) / (n + v + 1))), 6) AS base_score
FROM (SELECT r, doc_id, held_out, unnest(tokens) AS token FROM d) x LEFT JOIN c ON c.token = x.token, total GROUP BY r, doc_id, held_out
"""

QUERIES = {"op1_pack": op1_pack, "op2_quality_rules": op2_quality_rules, "op3_licenses": op3_licenses, "op4_pii": op4_pii, "op5_decontamination": op5_decontamination, "op6_substrings": op6_substrings, "op7_chat": op7_chat, "op8_toxicity": op8_toxicity, "op9_attention": op9_attention, "op10_lsh_forest": op10_lsh_forest, "op11_periodic": op11_periodic, "op12_pitman_yor": op12_pitman_yor, "op13_centroids": op13_centroids, "base2_counts": base2_counts, "base4_counts": base4_counts, "base12_unigrams": base12_unigrams}
ORACLE_SQL = {"op3_licenses": licenses.oracle(), "op10_lsh_forest": OP10_SQL, "op7_chat": OP7_SQL, "op11_periodic": periodic.ORACLE_SQL, "op13_centroids": centroids.oracle(), "base2_counts": BASE2_SQL, "base4_counts": BASE4_SQL, "base12_unigrams": BASE12_SQL}
