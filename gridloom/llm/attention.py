"""Quality classifier: attention-based multiple-instance learning.

A document is a bag of passages of ``PASSAGE`` words.  Every passage is encoded
from its pairs of neighbouring byte classes and from figures on its words; gated
attention gives each passage a weight, and the weighted mean of the encodings is
scored.  All weights are learned from document labels alone; probabilities are
calibrated on labelled rows that aren't trained on.

Bounds.  At most ``max_examples`` labelled rows are fitted on, with every passage of
theirs; scoring takes every passage of every text.  Scores are rounded to nine
digits, so that they don't depend on what else is in a batch.

Edge cases.  A null or empty text is one passage without words.  Without labelled
rows every score is one half.  Null labels don't count.  Repeated rows are scored
alike; columns of the input are kept, those named like a result are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame

from .common import labelled, map_text
from .kernels import words
from .learn import Adam, platt, sigmoid

PASSAGE, MAX_EXAMPLES, CALIBRATE = 64, 3000, 20
HIDDEN, GATE, EPOCHS = 24, 12, 20
#: Byte classes: small letters, capitals, digits, space, new line, some signs, other languages' bytes, all else.
CLASS = np.full(256, 15, np.int64)
CLASS[97:123], CLASS[65:91], CLASS[48:58], CLASS[128:] = 0, 1, 2, 14
for _n, _c in enumerate(" \n.,!#*$%&|", 3):
    CLASS[ord(_c)] = _n
FIGURES = 4
FEATURES = 256 + FIGURES


def passages(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Features of all passages in order, and the number of passages before each text and in all."""
    h, before, starts, _ = words(texts, lower=True, places=True)
    n = np.maximum(-(-np.diff(before) // PASSAGE), 1)
    bag = np.concatenate([[0], np.cumsum(n)])
    first = np.repeat(before[:-1], n) + PASSAGE * (np.arange(bag[-1]) - np.repeat(bag[:-1], n))
    base = np.cumsum([0] + [len(t) + 1 for t in texts])
    doc = np.repeat(np.arange(len(texts)), n)
    buf = np.frombuffer(b"\n".join(texts) + b"\n\n", np.uint8)
    some = first < before[doc + 1]
    lead = np.arange(bag[-1]) == bag[doc]
    at = base[doc].copy()  # where a passage begins: its first passage at the text's first byte
    go = some & ~lead
    at[go] += starts[first[go]]
    kind = CLASS[buf]
    two = kind[:-1] * 16 + kind[1:]
    own = np.repeat(np.arange(bag[-1]), np.diff(np.append(at, len(two))))
    inside = np.ones(len(two), bool)  # pairs of one text only: a score doesn't depend on what text comes next
    inside[base[1:] - 1] = inside[np.maximum(base[1:] - 2, 0)] = False
    inside[-1] = False
    x = np.bincount((own * 256 + two)[inside], minlength=256 * bag[-1]).reshape(-1, 256)
    x = np.sqrt(x / np.maximum(x.sum(1, keepdims=True), 1)).astype(np.float32)
    last = np.minimum(first + PASSAGE, before[doc + 1])
    size = np.maximum(last - first, 0)
    which = np.repeat(np.arange(bag[-1]), size)
    order = np.lexsort((h, which))
    same = (which[order][1:] == which[order][:-1]) & (h[order][1:] == h[order][:-1])
    again = np.bincount(which[order][1:][same], minlength=bag[-1])
    length = np.minimum(np.append(at[1:], len(two)), base[doc + 1] - 1) - at
    figures = np.stack([again / np.maximum(size, 1), np.minimum(length / np.maximum(size, 1), 40) / 20, size / PASSAGE, np.ones(bag[-1])], 1)
    return np.concatenate([x, figures.astype(np.float32)], 1), bag


@dataclass
class Model:
    params: dict[str, np.ndarray]
    a: float = 0.0
    b: float = 0.0

    def forward(self, x: np.ndarray, bag: np.ndarray) -> dict:
        p = self.params
        h = np.tanh(x @ p["enc"] + p["enc_b"])
        t, g = np.tanh(h @ p["tan"]), sigmoid(h @ p["gate"])
        e = (t * g) @ p["att"]
        first, doc = bag[:-1], np.repeat(np.arange(len(bag) - 1), np.diff(bag))
        w = np.exp(e - np.maximum.reduceat(e, first)[doc])
        w /= np.add.reduceat(w, first)[doc]
        z = np.add.reduceat(h * w[:, None], first, axis=0)
        return {"h": h, "t": t, "g": g, "w": w, "z": z, "doc": doc, "raw": z @ p["out"] + p["out_b"][0]}

    def gradient(self, x: np.ndarray, bag: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        p, f = self.params, self.forward(x, bag)
        h, t, g, w, z, doc = (f[k] for k in ("h", "t", "g", "w", "z", "doc"))
        off = (sigmoid(f["raw"]) - y) / len(y)
        dz = off[:, None] * p["out"]
        dw = (h * dz[doc]).sum(1)
        de = w * (dw - np.add.reduceat(w * dw, bag[:-1])[doc])
        dt, dg = de[:, None] * p["att"] * g * (1 - t * t), de[:, None] * p["att"] * t * g * (1 - g)
        dh = (w[:, None] * dz[doc] + dt @ p["tan"].T + dg @ p["gate"].T) * (1 - h * h)
        made = {"enc": x.T @ dh, "enc_b": dh.sum(0), "tan": h.T @ dt, "gate": h.T @ dg, "att": (t * g).T @ de, "out": z.T @ off, "out_b": np.array([off.sum()])}
        return {k: v + 1e-4 * p[k] for k, v in made.items()}

    def scores(self, texts: list[bytes]) -> list:
        """Scores, and the number of the passage that weighs most in each text."""
        x, bag = passages(texts)
        f = self.forward(x.astype(np.float64), bag)
        top = [int(np.argmax(np.round(f["w"][a:b], 9))) for a, b in zip(bag[:-1], bag[1:], strict=True)]
        return [np.round(sigmoid(self.a * f["raw"] + self.b), 9).tolist(), top]


def _bags(texts: list[bytes]) -> list:
    x, bag = passages(texts)
    out = []
    for a, b in zip(bag[:-1], bag[1:], strict=True):
        out.append(x[a:b].astype(np.float16).tobytes())
    return [out]


def fit(docs: DataFrame, labels: DataFrame, where=None, max_examples: int = MAX_EXAMPLES) -> Model:
    """where: a condition on labels' doc_id; labels of other rows aren't read."""
    rng = np.random.default_rng(11)
    shapes = {"enc": (FEATURES, HIDDEN), "enc_b": (HIDDEN,), "tan": (HIDDEN, GATE), "gate": (HIDDEN, GATE), "att": (GATE,), "out": (HIDDEN,), "out_b": (1,)}
    model = Model({k: rng.normal(0, 1 / np.sqrt(s[0]), s).astype(np.float32) * (k[-2:] != "_b") for k, s in shapes.items()})
    rows = map_text(labelled(docs, labels, "quality", max_examples, where), _bags, "bag binary", keep=["doc_id", "label", "part"]).collect()
    rows = sorted(rows, key=lambda r: (r.part, r.doc_id, r.label))
    train = [r for r in rows if r.part >= CALIBRATE]
    if not train:
        return model
    bags = [np.frombuffer(r.bag, np.float16).reshape(-1, FEATURES) for r in rows]
    y = np.array([r.label for r in rows], np.float32)
    learnt = np.array([i for i, r in enumerate(rows) if r.part >= CALIBRATE])

    def batch(some) -> tuple[np.ndarray, np.ndarray]:
        return np.concatenate([bags[i] for i in some]).astype(np.float32), np.cumsum([0] + [len(bags[i]) for i in some])

    adam = Adam(model.params, 0.004)
    for _ in range(EPOCHS):
        order = rng.permutation(learnt)
        for i in range(0, len(order), 64):
            adam.step(model.gradient(*batch(order[i : i + 64]), y[order[i : i + 64]]))
    held = np.array([i for i, r in enumerate(rows) if r.part < CALIBRATE] or learnt)
    raw = [model.forward(*batch(held[i : i + 64]))["raw"] for i in range(0, len(held), 64)]
    model.a, model.b = platt(np.concatenate(raw), y[held])
    model.params = {k: v.astype(np.float64) for k, v in model.params.items()}
    return model


def score(docs: DataFrame, model: Model, keep: list[str] | None = None) -> DataFrame:
    """Adds score and top_passage (from 0)."""
    return map_text(docs, model.scores, "score double, top_passage int", keep=keep)
