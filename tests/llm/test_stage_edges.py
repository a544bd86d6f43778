"""Every stage of the pipeline on nulls in any column, empty and long texts, repeated rows, empty tables and clashing columns."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline

from .helpers import DOCS


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    at = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame([(0, 1, 0), (1, None, None), (None, 1, 1), (2, 0, 1), (2, 0, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    spark.createDataFrame([(0, "an item of the benchmark, with words enough to be one"), (None, "x"), (2, None), (3, "")], "item_id long, text string").write.parquet(f"{at}/benchmark.parquet")
    return at


@pytest.mark.parametrize(("name", "stage"), corpus_pipeline.STAGES)
def test_edges(spark, sf_dir, name, stage):
    texts = ["", None, "plain text of a few words", "long word " * 20_000, "Ünïcode é 中文", "mail a@b.org"]
    rows = [(i, t, None, None, None) for i, t in enumerate(texts)] + [(None, "no id", "en", "s", 5), (5, texts[5], None, None, None)]
    docs = spark.createDataFrame(rows, DOCS).withColumn("score", F.lit("x")).withColumn("spans", F.lit(1)).withColumn("kept", F.lit(None).cast("boolean")).withColumn("rep", F.lit("y"))
    made = stage(spark, docs, sf_dir)
    out = made.collect()
    ids = {r.doc_id for r in out}
    assert {None, 0, 1, 2, 3, 4, 5} == ids
    if name != "packing":
        assert made.columns == docs.columns and all(r.score == "x" and r.rep == "y" for r in out)
        assert len(out) == (7 if name == "near_duplicates" else 8)
    none = stage(spark, docs.limit(0), sf_dir)
    assert none.count() == 0
