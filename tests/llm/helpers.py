"""Small tables for the operators' tests."""

from __future__ import annotations

import zlib

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, texts, extra=None):
    """Documents 0, 1, ... of texts; extra: columns by name that each get the same value."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(i, t, "en", "src", None if t is None else len(t)) for i, t in enumerate(texts)], DOCS)
    for name, value in (extra or {}).items():
        df = df.withColumn(name, F.lit(value))
    return df


def empty(spark):
    return spark.createDataFrame([], DOCS)


#: Names that clash with columns the operators make.
CLASHES = dict.fromkeys(["score", "spans", "length", "kept", "licenses", "rep", "label", "value", "__text_", "hash", "n_words", "signature"], "x")


def crc32(doc_id) -> int:
    return zlib.crc32(str(doc_id).encode())
