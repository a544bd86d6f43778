"""Quality rules: hashed word and character n-grams in a calibrated logistic regression.

Features of a text: its words and pairs of words (small ASCII letters), and its
single bytes and runs of three bytes, hashed into two tables; each table's part
is the mean of its grams' weights.  The regression is fitted on labelled rows and
its probabilities are calibrated on labelled rows that it hasn't seen.  Scoring
runs in Arrow batches against fixed thresholds, beside plain counts.

Bounds.  At most ``max_examples`` labelled rows are fitted on; the weights have
2 * WIDTH numbers.

Edge cases.  A null text has no words: all counts are 0 and the base rules fail.
Without labelled rows every probability is one half, which keeps.  Null labels
don't count.  Texts are taken whole.  Repeated rows are scored alike; columns of
the input are kept, those named like a result are replaced.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame

from .common import labelled, map_text, slices
from .kernels import grams, words
from .learn import Adam, platt, sigmoid

WIDTH = 1 << 15
MAX_EXAMPLES = 3000
KEEP_AT = 0.5
CALIBRATE = 20  # hundredths of the examples that only calibrate
MIN_WORDS, MAX_REPEATED = 50, 50  # base rules; the second in hundredths of the words
SYMBOLS = "#*$%&|<>"
#: Bytes of text whose grams are held at a time, unless one text is longer; a byte takes some 80 in all.
PART = 1 << 18


def counts(text: bytes) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    found = text.split()  # on the six ASCII white spaces
    chars = len(b"".join(found).decode())
    symbols = sum(text.count(c) for c in SYMBOLS.encode())
    lines = [x for x in text.split(b"\n") if x and not x.isspace()]
    windows = list(zip(found, found[1:], found[2:], strict=False))
    repeated = 0
    if len(set(windows)) < len(windows):
        often = Counter(windows)
        covered = -1  # the last word that is counted
        for i, w in enumerate(windows):
            if often[w] > 1:
                repeated += i + 2 - max(covered, i - 1)
                covered = i + 2
    return len(found), chars, symbols, len(lines) - len(set(lines)), repeated


def _grams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Table indexes of word grams and of character grams, with their bounds (start, end) by text."""
    h, before = words(texts, lower=True)
    pair = grams(h, 2)
    ends = before[1:-1] - 1
    own = np.ones(len(pair), bool)
    own[ends[(ends >= 0) & (ends < len(pair))]] = False  # pairs that cross texts
    at = np.concatenate([[0], np.cumsum(own)])
    pairs = at[np.minimum(before, len(pair))]
    of_word = np.concatenate([h, pair[own]])
    of_text = np.concatenate([np.repeat(np.arange(len(texts)), np.diff(before)), np.repeat(np.arange(len(texts)), np.diff(pairs))])
    order = np.argsort(of_text, kind="stable")
    word_idx = (of_word[order] >> np.uint64(40)).astype(np.int64) % WIDTH
    word_at = before + pairs
    buf = np.frombuffer(b"\0\0".join(texts) + b"\0\0", np.uint8).astype(np.uint32)
    three = buf[:-2] | buf[1:-1] << np.uint32(8) | buf[2:] << np.uint32(16) if len(buf) > 2 else np.zeros(0, np.uint32)
    one = buf[: len(three)] + np.uint32(1 << 24)
    hashed = [((x * np.uint32(0x9E3779B1)) >> np.uint32(17)).astype(np.int64) for x in (three, one)]
    size = np.array([len(t) for t in texts], np.int64)
    first = np.cumsum(size + 2) - size - 2
    # only grams that begin in the text itself: a score doesn't depend on what text comes next
    return word_idx, np.stack([word_at[:-1], word_at[1:]], 1), np.stack(hashed, 1).ravel(), 2 * np.stack([first, first + size], 1)


def _means(weights: np.ndarray, idx: np.ndarray, at: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0.0], np.cumsum(weights[idx], dtype=np.float64)])
    return (total[at[:, 1]] - total[at[:, 0]]) / np.maximum(at[:, 1] - at[:, 0], 1)


@dataclass
class Model:
    word: np.ndarray
    char: np.ndarray
    a: float = 1.0
    b: float = 0.0

    def raw(self, texts: list[bytes]) -> np.ndarray:
        def part(some: list[bytes]) -> np.ndarray:
            word_idx, word_at, char_idx, char_at = _grams(some)
            return _means(self.word, word_idx, word_at) + _means(self.char, char_idx, char_at)

        return np.concatenate([part(texts[a:b]) for a, b in slices(texts, PART)] or [np.zeros(0)])

    def probabilities(self, texts: list[bytes]) -> np.ndarray:
        return sigmoid(self.a * self.raw(texts) + self.b)


def _sparse(texts: list[bytes]) -> list:
    out: list = [[], []]
    for a, b in slices(texts, PART):
        word_idx, word_at, char_idx, char_at = _grams(texts[a:b])
        for i in range(b - a):
            idx, val = [], []
            for table, at, shift in ((word_idx, word_at, 0), (char_idx, char_at, WIDTH)):
                k, n = np.unique(table[at[i, 0] : at[i, 1]], return_counts=True)
                idx.append((k + shift).astype(np.uint16))
                val.append((n / max(1, at[i, 1] - at[i, 0])).astype(np.float32))
            out[0].append(np.concatenate(idx).tobytes())
            out[1].append(np.concatenate(val).tobytes())
    return out


def fit(docs: DataFrame, labels: DataFrame, where=None, max_examples: int = MAX_EXAMPLES) -> Model:
    rows = map_text(labelled(docs, labels, "quality", max_examples, where), _sparse, "idx binary, val binary", keep=["doc_id", "label", "part"]).collect()
    rows = sorted(rows, key=lambda r: (r.part, r.doc_id, r.label))
    model = Model(np.zeros(WIDTH, np.float32), np.zeros(WIDTH, np.float32))
    train = [r for r in rows if r.part >= CALIBRATE]
    if not train:
        return model
    idx = [np.frombuffer(r.idx, np.uint16).astype(np.int64) for r in train]
    val = [np.frombuffer(r.val, np.float32) for r in train]
    y = np.array([r.label for r in train], np.float32)
    n = len(train)
    flat, fval = np.concatenate(idx), np.concatenate(val)
    mean = np.bincount(flat, fval, 2 * WIDTH) / n
    scale = 1 / (np.sqrt(np.maximum(np.bincount(flat, fval.astype(np.float64) ** 2, 2 * WIDTH) / n - mean**2, 0)) + 1e-4)
    val = [v * scale[i] for i, v in zip(idx, val, strict=True)]
    w = {"w": np.zeros(2 * WIDTH), "b": np.zeros(1)}
    adam, rng = Adam(w, 0.003), np.random.default_rng(7)
    for _ in range(8):
        order = rng.permutation(n)
        for i in range(0, n, 64):
            some = order[i : i + 64]
            lengths = [len(idx[j]) for j in some]
            k, x = np.concatenate([idx[j] for j in some]), np.concatenate([val[j] for j in some])
            row = np.repeat(np.arange(len(some)), lengths)
            off = (sigmoid(np.bincount(row, w["w"][k] * x, len(some)) + w["b"]) - y[some]) / len(some)
            adam.step({"w": np.bincount(k, off[row] * x, 2 * WIDTH) + 1e-4 * w["w"], "b": np.array([off.sum()])})
    own = (w["w"] * scale).astype(np.float32)
    model.word, model.char = own[:WIDTH], own[WIDTH:]
    held = [r for r in rows if r.part < CALIBRATE] or train
    raw = np.array([float(np.dot(own[np.frombuffer(r.idx, np.uint16)], np.frombuffer(r.val, np.float32))) for r in held])
    model.a, model.b = platt(raw, np.array([r.label for r in held]))
    return model


def judge(docs: DataFrame, model: Model, keep_at: float = KEEP_AT, keep: list[str] | None = None) -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, quality_probability and kept."""

    def fn(texts: list[bytes]) -> list:
        found = np.array([counts(t) for t in texts], np.int64).reshape(len(texts), 5)
        failed = (found[:, 0] < MIN_WORDS) | (100 * found[:, 4] > MAX_REPEATED * found[:, 0])
        p = model.probabilities(texts)
        return [*found.T.tolist(), failed.tolist(), p.tolist(), (~failed & (p >= keep_at)).tolist()]

    fields = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, quality_probability double, kept boolean"
    return map_text(docs, fn, fields, keep=keep)
