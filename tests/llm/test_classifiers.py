import re
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gridloom.llm import attention, quality, toxicity
from gridloom.llm.common import labelled, remainder, text_slices
from gridloom.llm.learn import platt, sigmoid
from gridloom.llm.queries import op2_quality_rules, op8_toxicity, op9_attention

from ..conftest import DATA
from .helpers import CLASHES, documents, empty

LARGE = "/root/testdata/sf0.1"
LABELS = "doc_id long, quality int, toxic int"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def no_labels(spark):
    return spark.createDataFrame([], LABELS)


# ---- quality rules


def brute_counts(text):
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    repeated = {j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in range(i, i + 3)}
    return len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), sum(x in lines[:i] for i, x in enumerate(lines)), len(repeated)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab \n\té#|\x1c ", max_size=80))
def test_counts(text):
    assert quality.counts(text.encode()) == brute_counts(text)


def test_quality_accuracy_and_counts(spark):
    rows = op2_quality_rules(spark, LARGE).join(spark.read.parquet(f"{LARGE}/labels.parquet"), "doc_id").join(spark.read.parquet(f"{LARGE}/documents.parquet").select("doc_id", "text"), "doc_id").collect()
    for r in rows[:300]:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute_counts(r.text or "")
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words) and not (r.base_failed and r.kept)
    judged = [r for r in rows if not r.base_failed]
    assert np.mean([r.kept == bool(r.quality) for r in judged]) > 0.95


def test_scores_do_not_depend_on_neighbours():
    rng = np.random.default_rng(2)
    texts = [b"", b"a", b"some words ###", "é ü".encode(), b"x " * 500]
    m = quality.Model(rng.normal(size=quality.WIDTH).astype(np.float32), rng.normal(size=quality.WIDTH).astype(np.float32))
    assert np.allclose(m.raw(texts), [m.raw([t])[0] for t in texts], atol=1e-6)


def peak(run) -> int:
    tracemalloc.start()
    try:
        run()
        return tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_memory_follows_a_part_of_the_texts():
    texts = [b"one two %d " % i * 300 for i in range(1000)]
    model = quality.Model(np.zeros(quality.WIDTH, np.float32), np.zeros(quality.WIDTH, np.float32))
    assert peak(lambda: model.raw(texts)) < 100 * quality.PART < 10 * sum(map(len, texts))
    assert len(model.raw([])) == 0


def test_texts_leave_arrow_slice_by_slice():
    texts = [b"x" * 1000, None, b"", b"y" * 5000, *[b"z" * 1000] * 2000]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts, pa.string())], names=["k", "text"])
    made = [(part.column(0).to_pylist(), some) for part, some in text_slices(iter([batch, batch.slice(0, 2), batch.slice(0, 0)]), 1, 3000)]
    assert [k for ks, _ in made for k in ks] == [*range(len(texts)), 0, 1]
    assert [t for _, some in made for t in some] == [t or b"" for t in [*texts, *texts[:2]]]
    assert all(sum(map(len, some)) <= 3000 or len(some) == 1 for _, some in made)
    assert peak(lambda: [None for _ in text_slices(iter([batch]), 1, 30_000)]) < 500_000


def test_quality_edges(spark):
    docs = documents(spark, ["", None, "one two three " * 4000, "x" * 100_000], CLASHES)
    made = quality.judge(docs, quality.fit(docs, no_labels(spark))).orderBy("doc_id").collect()
    assert [r.base_failed for r in made] == [True, True, True, True] and not any(r.kept for r in made)
    assert made[0].score == "x" and [r.n_words for r in made] == [0, 0, 12000, 1]
    assert quality.judge(empty(spark), quality.fit(empty(spark), no_labels(spark))).count() == 0


# ---- toxicity


@pytest.mark.parametrize("head", [1e-9, 8, 1e9])  # all terms by postings, some, all dense
def test_nearest_against_brute_force(monkeypatch, head):
    monkeypatch.setattr(toxicity, "HEAD", head)
    rng = np.random.default_rng(3)
    n, terms = 400, 30
    dense = np.where(rng.random((n, terms)) < np.linspace(0.02, 0.3, terms), rng.random((n, terms)), 0)
    dense[200:230] = dense[:30]  # ties
    dense = dense[dense.any(1)]
    dense /= np.linalg.norm(dense, axis=1, keepdims=True)
    m = toxicity.Model(np.arange(terms, dtype=np.uint64), np.ones(terms), 0.1, k=10)
    rows = [np.flatnonzero(d) for d in dense]
    m.ptr, m.idx, m.val = np.cumsum([0] + [len(r) for r in rows]), np.concatenate(rows), np.concatenate([d[r] for d, r in zip(dense, rows, strict=True)])
    m.count, m.toxic, m.ids = rng.integers(1, 4, len(dense)).astype(float), np.zeros(len(dense)), np.arange(len(dense))
    m.build()
    for q in range(0, len(dense), 7):
        vector = rows[q], dense[q][rows[q]]
        entries, sims = m.nearest(*vector, m.partial([vector])[0])
        all_sims = np.round(dense @ dense[q], 9)
        order = np.lexsort((np.arange(len(dense)), -all_sims))
        order = order[all_sims[order] > 0]
        cut = np.searchsorted(np.cumsum(m.count[order]), m.k)
        kth = all_sims[order[cut]] if cut < len(order) else 0
        wanted = order[all_sims[order] >= max(kth, 1e-12)]
        assert sorted(entries) == sorted(wanted) and np.allclose(sims, all_sims[entries])


def test_toxicity_query_against_dense_brute_force(spark, duck):
    """Every score of the query from dense vectors over all terms of the examples, with a sort instead of an index."""
    from .helpers import crc32

    docs = dict(duck.execute("SELECT doc_id, text FROM documents ORDER BY doc_id").fetchall())
    label = {i: y for i, y in duck.execute("SELECT doc_id, toxic FROM labels WHERE toxic IS NOT NULL").fetchall() if crc32(i) % 3 != 1 and i in docs}
    bags = {i: Counter(re.findall(r"[a-z0-9\x80-\U0010ffff]+", (t or "").lower())) for i, t in docs.items()}
    terms = {w: k for k, w in enumerate(sorted({w for i in label for w in bags[i]}))}
    n, pos, df = np.zeros(len(terms)), np.zeros(len(terms)), np.zeros(len(terms))
    for i, bag in bags.items():
        for w in bag:
            if w in terms:
                df[terms[w]] += 1
                n[terms[w]] += i in label
                pos[terms[w]] += label.get(i, 0)
    share = (sum(label.values()) + 0.5) / (len(label) + 1)
    weight = (np.log((1 + len(docs)) / (1 + df)) + 1) * toxicity.dependence(n, pos, share)

    def vector(i):
        v = np.zeros(len(terms))
        for w, c in bags[i].items():
            if w in terms:
                v[terms[w]] = (1 + np.log(c)) * weight[terms[w]]
        return v / max(np.linalg.norm(v), 1e-12)

    ids = [i for i in label if vector(i).any()]
    index, y = np.stack([vector(i) for i in ids]), np.array([label[i] for i in ids], float)

    def vote(i):
        sims = np.round(index @ vector(i), 9)
        sims = np.where([j == i and i in label and leave for j in ids], 0, sims)
        kth = np.sort(sims)[::-1][toxicity.NEIGHBOURS - 1] if len(ids) >= toxicity.NEIGHBOURS else 0
        near = sims >= max(kth, 1e-12)
        return (sims * y)[near].sum() / sims[near].sum() if near.any() else None

    leave = True
    told = [(v, label[i]) for i in sorted(ids) if (v := vote(i)) is not None]
    a, b = platt(*map(np.array, zip(*told, strict=True)))
    leave = False
    empty_labels = [label[i] for i in label if i not in ids]
    prior = (sum(empty_labels) + share) / (len(empty_labels) + 1)
    scores = {r.doc_id: r.score for r in op8_toxicity(spark, DATA).collect()}
    wanted = {i: prior if (v := vote(i)) is None else float(sigmoid(a * v + b)) for i in docs}
    assert scores.keys() == wanted.keys() and all(scores[i] == pytest.approx(s, abs=1e-6) for i, s in wanted.items())


def test_few_texts_are_without_a_vector(spark):
    rows = op8_toxicity(spark, LARGE).join(spark.read.parquet(f"{LARGE}/documents.parquet").where("length(text) > 0").select("doc_id"), "doc_id")
    assert rows.where("size(evidence) = 0").count() < 0.01 * rows.count()


def test_toxicity_held_out(spark):
    rows = op8_toxicity(spark, LARGE).join(spark.read.parquet(f"{LARGE}/labels.parquet"), "doc_id").where("held_out").collect()
    assert np.mean([r.predicted == r.toxic for r in rows]) > 0.95
    toxic = [r.predicted for r in rows if r.toxic]
    assert np.mean(toxic) > 0.7 and np.mean([r.predicted for r in rows if not r.toxic]) < 0.03


def test_toxicity_edges(spark):
    docs = documents(spark, ["", None, "word " * 30_000, "Ünïcode"], CLASHES)
    none = toxicity.fit(docs, no_labels(spark))
    assert [r.score for r in toxicity.score(docs, none).collect()] == [0.0] * 4
    one = toxicity.fit(docs, spark.createDataFrame([(0, 1, 1), (1, None, None), (2, 1, 0), (None, 1, 1), (2, 1, 0)], LABELS))
    assert all(0 <= r.score <= 1 for r in toxicity.score(docs, one).collect())
    assert toxicity.score(empty(spark), one).count() == 0


def test_labels_outside_the_condition_do_not_matter(spark):
    docs = documents(spark, [f"word{i % 5} thing other" for i in range(60)])
    labels = spark.createDataFrame([(i, i % 2, int(i % 5 == 0)) for i in range(60)], LABELS)
    flipped = labels.withColumn("toxic", F.when(remainder(3) == 1, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    scores = [[r.score for r in toxicity.score(docs, toxicity.fit(docs, x, toxicity.TRAIN)).orderBy("doc_id").collect()] for x in (labels, flipped)]
    assert scores[0] == scores[1]


def test_samples_are_bounded_and_labels_unique(spark):
    docs = documents(spark, ["a"] * 50)
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(50)] + [(3, 0, 0), (None, 1, 1), (4, None, None)], LABELS)
    made = labelled(docs, labels, "toxic", 20).collect()
    assert len(made) == 20 == len({r.doc_id for r in made})
    assert {r.doc_id: r.label for r in labelled(docs, labels, "toxic", 100).collect()} == {i: i % 2 for i in range(50)}
    often = docs.crossJoin(spark.range(100).withColumnRenamed("id", "copy")).withColumn("text", F.concat("text", F.col("copy").cast("string")))
    assert sorted(r.doc_id for r in labelled(often, labels, "toxic", 20).collect()) == sorted(r.doc_id for r in made)


# ---- attention


def test_gradient():
    x, bag = attention.passages([b"a b. C! d " * 40, b"", b"### *** " * 30, b"x"])
    assert list(np.diff(bag)) == [3, 1, 1, 1]
    rng = np.random.default_rng(1)
    m = attention.Model({k: v.astype(np.float64) for k, v in {
        "enc": rng.normal(0, 0.3, (attention.FEATURES, 6)), "enc_b": rng.normal(size=6), "tan": rng.normal(size=(6, 4)), "gate": rng.normal(size=(6, 4)), "att": rng.normal(size=4), "out": rng.normal(size=6), "out_b": rng.normal(size=1),
    }.items()})
    y = np.array([1.0, 0, 1, 0])

    def loss():
        p = sigmoid(m.forward(x, bag)["raw"])
        return -np.mean(y * np.log(p) + (1 - y) * np.log(1 - p)) + sum(5e-5 * (v**2).sum() for v in m.params.values())

    grads = m.gradient(x, bag, y)
    for k, v in m.params.items():
        for i in rng.choice(v.size, min(5, v.size), replace=False):
            at = np.unravel_index(i, v.shape)
            held = v[at]
            v[at] = held + 1e-5
            up = loss()
            v[at] = held - 1e-5
            down = loss()
            v[at] = held
            assert grads[k][at] == pytest.approx((up - down) / 2e-5, abs=1e-6), k


def test_passages_hold_all_words():
    texts = [("w%d " % i * 70).encode() for i in range(5)] + [b"", b"one"]
    x, bag = attention.passages(texts)
    assert list(np.diff(bag)) == [2] * 5 + [1, 1]
    alone = [attention.passages([t])[0] for t in texts]
    assert np.allclose(x, np.concatenate(alone))


def test_attention_query_against_plain_loops(spark, duck):
    """Features and the forward pass of some texts, written out in loops, against the query's scores of all."""
    docs = duck.execute("SELECT doc_id, text FROM documents ORDER BY length(text), doc_id").fetchall()
    model = attention.fit(spark.read.parquet(f"{DATA}/documents.parquet"), spark.read.parquet(f"{DATA}/labels.parquet"), remainder(4) != 2)
    scores = {r.doc_id: r.score for r in op9_attention(spark, DATA).collect()}
    assert scores.keys() == {i for i, _ in docs}
    p = model.params

    def features(part, n, repeats):
        pairs = Counter((int(attention.CLASS[a]), int(attention.CLASS[b])) for a, b in zip(part, part[1:], strict=False))
        total = max(sum(pairs.values()), 1)
        x = np.zeros(attention.FEATURES)
        for (a, b), c in pairs.items():
            x[16 * a + b] = np.float32(np.sqrt(c / total))
        x[256:] = np.array([repeats / max(n, 1), min(len(part) / max(n, 1), 40) / 20, n / attention.PASSAGE, 1], np.float32)
        return x

    for i, text in docs[::3]:
        data = (text or "").encode()
        found = list(re.finditer(rb"[^\x20\x09-\x0D]+", data))
        bag = []
        for k in range(0, max(len(found), 1), attention.PASSAGE):
            some = found[k : k + attention.PASSAGE]
            begin = some[0].start() if k else 0
            end = found[k + attention.PASSAGE].start() if k + attention.PASSAGE < len(found) else len(data)
            said = [m[0].lower() for m in some]
            x = features(data[begin : end + 1], len(some), len(said) - len(set(said)))
            x[257] = np.float32(min((end - begin) / max(len(some), 1), 40) / 20)
            bag.append(np.tanh(x @ p["enc"] + p["enc_b"]))
        e = np.array([np.tanh(h @ p["tan"]) * sigmoid(h @ p["gate"]) @ p["att"] for h in bag])
        w = np.exp(e - e.max()) / np.exp(e - e.max()).sum()
        raw = (w[:, None] * bag).sum(0) @ p["out"] + p["out_b"][0]
        assert scores[i] == pytest.approx(float(sigmoid(model.a * raw + model.b)), abs=1e-6), i


def test_attention_scores_do_not_depend_on_the_batch(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    model = attention.fit(docs, spark.read.parquet(f"{DATA}/labels.parquet"))
    texts = [(r.text or "").encode() for r in docs.collect()]
    assert model.scores(texts)[0] == [model.scores([t])[0][0] for t in texts]


def test_attention_held_out(spark):
    rows = op9_attention(spark, LARGE).join(spark.read.parquet(f"{LARGE}/labels.parquet"), "doc_id").where("held_out").collect()
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.95


def test_attention_edges(spark):
    docs = documents(spark, ["", None, "word " * 40_000, "###"], CLASHES)
    none = attention.score(docs, attention.fit(docs, no_labels(spark))).collect()
    assert [r.score for r in none] == [0.5] * 4
    one = attention.fit(docs, spark.createDataFrame([(0, 1, 1), (2, 0, 0), (3, None, None)], LABELS))
    assert all(0 <= r.score <= 1 for r in attention.score(docs, one).collect())
    assert attention.score(empty(spark), one).count() == 0


def test_platt_is_finite_on_one_sided_data():
    for y in (np.ones(5), np.zeros(5), np.array([0, 0, 1, 1])):
        a, b = platt(np.arange(len(y), dtype=float), y)
        assert np.isfinite([a, b]).all() and a >= 0
