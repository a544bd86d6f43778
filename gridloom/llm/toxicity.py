"""Toxicity by the nearest labelled examples, under exact TF-IDF cosine.

Terms are small alphanumeric words, all of them.  The weight of a term is
(1 + ln tf) * idf * dependence: document frequencies are counted over all
documents, and dependence, between FLOOR and 1, rises smoothly with how far the
labels of the examples that hold the term depart from the common share, so that a
few insults in a long text aren't drowned by its length and language.  No term is
dropped.  Words that no example holds have no weight: they would lengthen a
text's vector, which changes all its cosines by one factor and so no neighbour and
no vote.

Examples with equal vectors share an entry and entries stand in blocks of BLOCK.
The inverted index holds for each term the blocks in which it stands, its largest
weight there, and its postings; of terms that stand in more than a HEAD-th of the
entries it holds a dense row, so that many texts meet them in one product of
matrices.  A search adds to that exact part the largest weights of the other terms
for a bound on each block, scores the most promising blocks exactly, and then all
others whose bound reaches the k-th nearest found; all ties of the k-th count.  The vote is the mean
label weighted by cosine, calibrated by the votes that the examples get from the
others.  A text without any term of the examples has no direction: it takes the
share of toxic labels among such examples.

Bounds.  At most ``max_examples`` labelled rows, with all terms of their texts; the
index is of that size, whatever the corpus.

Edge cases.  A null text is empty.  Without labelled rows each score is 0.  Labels
that are null don't count.  Of rows of one doc_id one is an example (see
``labelled``).  Repeated rows are scored alike.  Columns of the input are kept;
those named like a result are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_bytes, filter_text, labelled, map_text, slices, stage
from .kernels import NOT_ALNUM, ranges, words
from .learn import platt, sigmoid

MAX_EXAMPLES, NEIGHBOURS, BLOCK, FIRST, HEAD, AT_ONCE = 4000, 24, 32, 4, 16, 128
#: The least dependence of a term, the score z at which it is half way to 1, and how steeply it rises there.
FLOOR, HALF_Z, STEEP = 0.02, 5.0, 4

#: Condition on rows whose labels may be learnt; the others are held out. SQL text, as no session is there yet.
TRAIN = "pmod(crc32(cast(cast(doc_id as string) as binary)), 3) != 1"


def _terms(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return words([t if t.isascii() else t.decode().lower().encode() for t in texts], NOT_ALNUM, lower=True)


def dependence(n: np.ndarray, toxic: np.ndarray, share: float) -> np.ndarray:
    """FLOOR to 1 for terms that stand in n examples, so many of them toxic."""
    z = np.abs(toxic - n * share) / np.sqrt(np.maximum(n, 1) * share * (1 - share))
    return FLOOR + (1 - FLOOR) * z**STEEP / (z**STEEP + HALF_Z**STEEP)


@dataclass
class Model:
    terms: np.ndarray  # sorted hashes
    weight: np.ndarray  # of each: idf * dependence
    prior: float  # of texts without terms
    a: float = 1.0
    b: float = 0.0
    k: int = NEIGHBOURS
    # entries: vectors in rows, with the numbers of examples and of toxic ones, and one example's id
    ptr: np.ndarray = field(default_factory=lambda: np.zeros(1, np.int64))
    idx: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    val: np.ndarray = field(default_factory=lambda: np.zeros(0))
    count: np.ndarray = field(default_factory=lambda: np.zeros(0))
    toxic: np.ndarray = field(default_factory=lambda: np.zeros(0))
    ids: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))

    def __post_init__(self) -> None:
        self.build()

    def __getstate__(self) -> dict:
        """What goes to tasks: the entries; each task builds the index from them."""
        return {name: getattr(self, name) for name in self.__dataclass_fields__}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self.build()

    def vectors(self, texts: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
        """(term numbers, weights of unit length) of each text."""
        h, before = _terms(texts)
        at = np.searchsorted(self.terms, h)
        hit = np.flatnonzero(self.terms[np.minimum(at, len(self.terms) - 1)] == h) if len(self.terms) else np.zeros(0, np.int64)
        found, cut = at[hit], np.searchsorted(hit, before)
        return [self.unit(*np.unique(found[a:b], return_counts=True)) for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)]

    def unit(self, t: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        w = (1 + np.log(n)) * self.weight[t]
        return t, w / np.sqrt((w * w).sum()) if len(t) else w

    def build(self) -> None:
        """The index: a dense matrix of terms that stand in more than a HEAD-th of the entries; of others, postings by term and row, and for each term its blocks, with their largest weights and first postings."""
        entries = len(self.count)
        rows = np.repeat(np.arange(entries), np.diff(self.ptr))
        head = np.flatnonzero(np.bincount(self.idx, minlength=len(self.terms)) * HEAD > entries)
        self.head_at = np.full(len(self.terms), -1)
        self.head_at[head] = np.arange(len(head))
        own = self.head_at[self.idx]
        self.dense = np.zeros((len(head), entries))
        self.dense[own[own >= 0], rows[own >= 0]] = self.val[own >= 0]
        order = np.flatnonzero(own < 0)
        order = order[np.lexsort((rows[order], self.idx[order]))]
        self.post_row, self.post_val = rows[order].astype(np.int32), self.val[order]
        term, block = self.idx[order], rows[order] // BLOCK
        self.block_start = np.arange(0, entries, BLOCK)
        new = np.ones(len(term), bool)
        new[1:] = (term[1:] != term[:-1]) | (block[1:] != block[:-1])
        first = np.flatnonzero(new)
        self.block_of, self.block_post = block[first].astype(np.int32), np.append(first, len(term))
        self.block_max = np.maximum.reduceat(self.post_val, first) if len(first) else np.zeros(0)
        self.term_ptr = np.searchsorted(term[first], np.arange(len(self.terms) + 1))

    def partial(self, vectors: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """What the dense terms add to the cosine of each vector with each entry."""
        query = np.zeros((len(vectors), len(self.dense)))
        for i, (t, w) in enumerate(vectors):
            at = self.head_at[t]
            query[i, at[at >= 0]] = w[at >= 0]
        return query @ self.dense

    def nearest(self, t: np.ndarray, w: np.ndarray, sims: np.ndarray, own: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """Entries among the k nearest examples with all ties of the k-th, and their cosines, nearest first.

        sims: the vector's row of partial().  own: an entry of which one example is left out.
        """
        rest = self.head_at[t] < 0
        at, of = ranges(self.term_ptr[t[rest]], self.term_ptr[t[rest] + 1])
        block, weight = self.block_of[at], w[rest][of]
        n_blocks = len(self.block_start)
        bound = np.bincount(block, weight * self.block_max[at], n_blocks) + np.maximum.reduceat(sims, self.block_start)
        some = np.zeros(n_blocks, bool)
        some[np.argpartition(-bound, FIRST)[:FIRST] if n_blocks > FIRST else slice(None)] = True
        left = ~some
        while some.any():
            pair = np.flatnonzero(some[block])
            post, by = ranges(self.block_post[at[pair]], self.block_post[at[pair] + 1])
            sims = sims + np.bincount(self.post_row[post], weight[pair][by] * self.post_val[post], len(sims))
            # what isn't added yet only makes a cosine too small, so the k-th so far is none too large
            least = np.partition(sims, -self.k - 1)[-self.k - 1] if len(sims) > self.k else 0.0
            entries = np.flatnonzero(sims >= max(least - 1e-8, 1e-9))
            close = np.round(sims[entries], 9)
            order = np.lexsort((entries, -close))
            entries, close = entries[order], close[order]
            full = np.searchsorted(np.cumsum(self.count[entries] - (entries == own)), self.k)
            kth = close[full] if full < len(close) else 0.0
            some = left & (bound > 0) & (bound >= kth - 1e-8)
            left &= ~some
        return entries[close >= kth], close[close >= kth]

    def vote(self, t: np.ndarray, w: np.ndarray, sims: np.ndarray, own: int = -1, own_label: int = 0) -> tuple[float | None, list, list]:
        """The vote, or None if no example is near; ids of some nearest examples, and their cosines."""
        if not len(t) or not len(self.count):
            return None, [], []
        entries, near = self.nearest(t, w, sims, own)
        mine = entries == own
        n, pos = self.count[entries] - mine, self.toxic[entries] - mine * own_label
        total = float((near * n).sum())
        if total <= 0:
            return None, [], []
        return float((near * pos).sum()) / total, self.ids[entries[:3]].tolist(), near[:3].tolist()

    def votes(self, vectors: list[tuple[np.ndarray, np.ndarray]], own: list[tuple[int, int]] | None = None) -> Iterator[tuple[float | None, list, list]]:
        """own: for each vector the entry and the label of an example that is left out."""
        for i in range(0, len(vectors), AT_ONCE):
            some = vectors[i : i + AT_ONCE]
            for j, (v, sims) in enumerate(zip(some, self.partial(some), strict=True)):
                yield self.vote(*v, sims, *(own[i + j] if own else ()))

    def scores(self, texts: list[bytes]) -> list:
        out, ids, sims = [], [], []
        for vote, near, cosines in self.votes(self.vectors(texts)):
            out.append(self.prior if vote is None else float(sigmoid(self.a * vote + self.b)))
            ids.append(near)
            sims.append(cosines)
        return [out, ids, sims]


def fit(docs: DataFrame, labels: DataFrame, where=None, max_examples: int = MAX_EXAMPLES) -> Model:
    """where: a condition on labels' doc_id; labels of other rows aren't read.  The examples' term counts come to the driver."""
    sample = stage(map_text(labelled(docs, labels, "toxic", max_examples, where), _counts, "terms binary, counts binary", keep=["doc_id", "label"]), "examples")
    rows = sorted(sample.collect(), key=lambda r: r.doc_id)
    y = np.array([r.label for r in rows], float)
    share = (y.sum() + 0.5) / (len(y) + 1)
    model = Model(np.zeros(0, np.uint64), np.zeros(0), float(y.mean()) if len(y) else 0.0)
    if not rows:
        return model
    held = [np.frombuffer(r.terms, np.uint64) for r in rows]
    n = [np.frombuffer(r.counts, np.int64) for r in rows]
    model.terms, back = np.unique(np.concatenate(held), return_inverse=True)
    n_terms = len(model.terms)
    of = np.repeat(np.arange(len(rows)), [len(x) for x in held])
    depend = dependence(np.bincount(back, minlength=n_terms), np.bincount(back, y[of], n_terms), share)
    model.weight = idf(docs, model.terms) * depend
    cut = np.cumsum([0] + [len(x) for x in held])
    vectors = [model.unit(back[a:b], x) for a, b, x in zip(cut[:-1], cut[1:], n, strict=True)]
    model.prior = (sum(y[i] for i, (t, _) in enumerate(vectors) if not len(t)) + share) / (sum(not len(t) for t, _ in vectors) + 1)
    entries: dict[tuple[bytes, bytes], list[int]] = {}
    for i, (t, w) in enumerate(vectors):
        if len(t):
            entries.setdefault((t.tobytes(), w.tobytes()), []).append(i)
    members = sorted(entries.values(), key=lambda m: (vectors[m[0]][0][np.argmax(vectors[m[0]][1])], m[0]))  # like vectors stand in one block
    model.ptr = np.cumsum([0] + [len(vectors[m[0]][0]) for m in members])
    model.idx = np.concatenate([vectors[m[0]][0] for m in members] or [np.zeros(0)]).astype(np.int32)
    model.val = np.concatenate([vectors[m[0]][1] for m in members] or [np.zeros(0)])
    model.count, model.toxic = np.array([float(len(m)) for m in members]), np.array([float(y[m].sum()) for m in members])
    model.ids = np.array([rows[m[0]].doc_id for m in members], np.int64)
    model.build()
    own = {rows[i].doc_id: e for e, m in enumerate(members) for i in m}

    def votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            some = [(r["doc_id"], r["label"], np.searchsorted(model.terms, np.frombuffer(r["terms"], np.uint64)), np.frombuffer(r["counts"], np.int64)) for r in batch.to_pylist()]
            made = model.votes([model.unit(t, n) for _, _, t, n in some], [(own.get(i, -1), label) for i, label, _, _ in some])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([v for v, _, _ in made], pa.float64()), batch.column(1)], names=["doc_id", "vote", "label"])

    spread = sample.repartition(max(1, len(rows) // 250), "doc_id")
    told = sorted(r for r in spread.mapInArrow(votes, "doc_id long, vote double, label int").collect() if r.vote is not None)
    if told:
        model.a, model.b = platt(np.array([r.vote for r in told]), np.array([r.label for r in told]))
    return model


def _counts(texts: list[bytes]) -> list:
    """Each text's terms, in order, and how often they occur."""
    h, before = _terms(texts)
    own = [np.unique(h[a:b], return_counts=True) for a, b in zip(before[:-1], before[1:], strict=True)]
    return [[t.tobytes() for t, _ in own], [n.astype(np.int64).tobytes() for _, n in own]]


def idf(docs: DataFrame, terms: np.ndarray) -> np.ndarray:
    """Of sorted terms, by their document frequencies over all documents; tasks count before anything is shuffled."""
    if not len(terms):
        return np.zeros(0)

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rows = np.zeros(len(terms), np.int64), 0
        for batch in batches:
            texts = as_bytes(batch.column(0))
            for a, b in slices(texts):
                h, before = _terms(texts[a:b])
                at = np.searchsorted(terms, h)
                hit = np.flatnonzero(terms[np.minimum(at, len(terms) - 1)] == h)
                doc = np.searchsorted(before, hit, side="right")
                total += np.bincount(np.unique(doc * len(terms) + at[hit]) % len(terms), minlength=len(terms))
                rows += b - a
        some = np.flatnonzero(total)
        made = [np.append(some, -1), np.append(total[some], rows)]
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in made], names=["term", "n"])

    found = docs.select("text").mapInArrow(counts, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    at, n = found["term"].to_numpy(), found["n"].to_numpy()
    df = np.zeros(len(terms), np.int64)
    df[at[at >= 0]] = n[at >= 0]
    return np.log((1 + int(n[at < 0].sum())) / (1 + df)) + 1


def score(docs: DataFrame, model: Model, keep: list[str] | None = None) -> DataFrame:
    """Adds score, evidence (ids of nearest examples) and evidence_cosines."""
    return map_text(docs, model.scores, "score double, evidence array<long>, evidence_cosines array<double>", keep=keep)


def civil(docs: DataFrame, model: Model, toxic_at: float) -> DataFrame:
    """The documents that score less than toxic_at, with all their columns."""
    return filter_text(docs, lambda texts: [s < toxic_at for s in model.scores(texts)[0]])
