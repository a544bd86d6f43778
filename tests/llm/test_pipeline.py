"""The pipeline's stages, each against what it should do to its own input."""

import zlib

import numpy as np
from tokenizers import Tokenizer

import corpus_pipeline
from gridloom.llm import pii, toxicity
from gridloom.llm.queries import tokenizer_path

from ..conftest import DATA
from .test_duplicates import brute_components


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "near_duplicates", "decontamination", "pii", "packing"]
    seen = {}
    for name, f in corpus_pipeline.STAGES:
        made = f(spark, docs, DATA)
        if name != "packing":
            assert made.columns == docs.columns
        made.write.parquet(str(tmp_path / name))
        before, docs = {r.doc_id: r for r in docs.collect()}, spark.read.parquet(str(tmp_path / name))
        seen[name] = (before, docs.collect())
    before, after = seen["toxicity"]
    model = toxicity.fit(spark.read.parquet(f"{DATA}/documents.parquet"), spark.read.parquet(f"{DATA}/labels.parquet"), toxicity.TRAIN)
    scores = {i: model.scores([(r.text or "").encode()])[0][0] for i, r in before.items()}
    assert {r.doc_id for r in after} == {i for i, s in scores.items() if s < 0.7}
    before, after = seen["near_duplicates"]
    ids = sorted(before)
    assert sorted(r.doc_id for r in after) == [ids[i] for i, _, c in brute_components([before[i].text for i in ids], 80) if c == i]
    before, after = seen["decontamination"]
    assert 0 < len(after) < len(before) and all(before[r.doc_id] == r for r in after)
    before, after = seen["pii"]
    assert len(after) == len(before) and all(r.n_chars == len(r.text) for r in after)
    assert any(r.text != before[r.doc_id].text for r in after) and not any(pii.detect(r.text) for r in after)
    before, after = seen["packing"]
    tokenizer = Tokenizer.from_file(tokenizer_path())
    pieces: dict = {}
    for r in sorted(after, key=lambda r: (r.doc_id, r.start)):
        pieces.setdefault(r.doc_id, []).extend(np.frombuffer(r.tokens, "<u4").tolist())
    assert {i: zlib.crc32(str(x).encode()) for i, x in pieces.items()} == {i: zlib.crc32(str([*tokenizer.encode(r.text, add_special_tokens=False).ids, 2]).encode()) for i, r in before.items()}


def test_run(spark):
    assert corpus_pipeline.run(spark, DATA).count() > 0 and corpus_pipeline.ORACLE_SQL is None
