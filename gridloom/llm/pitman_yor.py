"""Language-model scores by a hierarchical Pitman-Yor model of word pairs.

Every word is a context with a restaurant of its own, whose customers are the words
that follow it; all of them share one parent, the restaurant of single words, whose
customers are their tables; its base is uniform over the vocabulary and one unknown
word.  The end of a text is a word, and the context of the next text's first.

    P(w | u) = (c_uw - d t_uw + (theta + d T_u) P(w)) / (theta + c_u)
    P(w)     = (C_w - d0 t_w + (theta0 + d0 T) / (V + 1)) / (theta0 + C)

c are customers, t and T tables.  Seats are sampled by Gibbs: in each sweep all
customers of one dish in one restaurant are seated anew, given all other seats as
they were after the last sweep.  A dish with up to EXACT customers gets its number of
tables from its exact conditional distribution (sizes of tables are summed out); a
larger one is seated customer by customer, going from new table to new table, and
TRIES such seatings are a Metropolis chain towards the same distribution (an
approximation where nearly every customer would have a table of their own).  All
restaurants are seated at once, as is usual where a sampler is spread over machines.
Predictive probabilities are averaged over the sweeps after BURN.  Discounts follow
from the numbers of pairs (words) that occur once and twice.

How it is spread.  Texts are cut into slices of so many bytes, which are tokenised
once and written with their words as numbers.  Each slice sends its distinct pairs to
buckets by hash, which count them and send the counts back; so do the words with their
customers and tables in each sweep.  What is sent is packed: a row has all keys of one
slice in one bucket.  A hot word or pair is one key a slice, so no bucket is large for
it, and buckets are as many as the data ask for.  Of slices that share a pair the
first seats it, and sends the others its tables when all sweeps are done.  Draws
depend on the pair and sweep only, so results don't depend on slices or buckets.
Slices and their seats stay in place, so what they send and are answered is all that
is shuffled.  Each sweep is written to the shared folder; the
driver sees sums of a bucket's rows only.  Nothing is dropped: every pair of every
training text is a customer.

Words are known by 64 bits of hash.  Of v words any two share theirs with a chance of
some v * v / 2^65.

Edge cases.  A null text is empty: one token, its end.  Without training texts every
token has probability one (V = 0).  Rows without doc_id are learned from.  Repeated
rows count each.  Texts are taken whole; one long text is a slice of its own.  Other
columns are ignored.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import as_bytes, release, slices, stage, stage_bucketed, staged, tidy
from .kernels import RUN_KEYS, U64, mix, words

SLICE_BYTES, BUCKET = 8 << 20, 1 << 20
SWEEPS, BURN, EXACT, TRIES = 3, 1, 32, 3
THETA = 1.0
END = U64(0x9D39247E33776D41)  # no word's hash, but for chance
RESULT = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, perplexity double"
BASE = RESULT[: RESULT.index(", score")]
SLICES = "slice long, ids array<long>, held array<boolean>, sizes binary, words binary, tokens binary, n_tokens long, n_words long"
#: Of the pairs of two customers or more that the slice seats: u (as steps), w, c, t tables in the last sweep, t_sum over sampled sweeps; lone, many: of all its pairs, whether
#: they have one customer, or more; lone_t, lone_c: of each word, tables and customers by the pairs of one customer that the slice counts; n: its tokens in training texts; samples: of each
#: sampled sweep and word tables in its restaurant, customers and tables of the word itself.
STATE = "slice long, words binary, u binary, w binary, c binary, t binary, t_sum binary, lone binary, many binary, lone_t binary, lone_c binary, n binary, samples binary"
#: What scores need of it; c, t_sum: of all pairs of two customers or more, in the order of their keys.
FINAL = "slice long, c binary, t_sum binary, lone binary, many binary, n binary, samples binary"
PARTS = "bucket int, slice long, keys binary, n binary, tables binary, customers binary"
COUNTED = "bucket int, slice long, n binary, tables binary, customers binary, seats binary, n_sum long, known long, customer_sum long, seat_sum long, once long, twice long"


def _uniform(key: np.ndarray, *parts: int) -> np.ndarray:
    """Numbers above 0, up to 1, that depend on key and parts only."""
    h = key + (np.array(parts, U64) + U64(1)) @ RUN_KEYS[50 : 50 + len(parts)]
    return ((mix(h) >> U64(11)).astype(np.float64) + 1) * 2.0**-53


def log_gamma(z: np.ndarray) -> np.ndarray:
    """For numbers above 0, to some 1e-9."""
    low = np.ones_like(z)
    for i in range(8):
        low = low * (z + i)
    y = z + 8
    return (y - 0.5) * np.log(y) - y + 0.9189385332046727 + (1 / 12 - (1 / 360 - 1 / (1260 * y * y)) / (y * y)) / y - np.log(low)


def log_ways(discount: float, most: int = EXACT) -> np.ndarray:
    """[c, t]: the log of the sum, over all ways of c customers at t tables, of the product of (1 - d)(2 - d)... of each table's later customers."""
    ways = np.full((most + 1, most + 1), -np.inf)
    ways[1, 1] = 0
    t = np.arange(1, most + 1)
    for c in range(1, most):
        stay = np.where(t <= c, ways[c, 1:] + np.log(np.maximum(c - discount * t, 1e-300)), -np.inf)
        ways[c + 1, 1:] = np.logaddexp(stay, ways[c, :-1])
    return ways


def _seated(c: np.ndarray, strength: np.ndarray, share: np.ndarray, discount: float, key: np.ndarray, *parts: int) -> tuple[np.ndarray, np.ndarray]:
    """Tables when c customers take their seats one after the other, and the log of how much likelier these seats are than to be proposed.

    The next new table is opened at a customer drawn from a law whose rate falls as
    customers come, as it does given that all c are to be seated.
    """
    tables, weight = np.ones(len(c), np.int64), np.zeros(len(c))
    some, at, turn = np.arange(len(c)), np.ones(len(c)), 0
    while len(some):
        t, m, s = tables[some], c[some].astype(np.float64), share[some]
        opens = (strength[some] + discount * t) * s
        power = discount * (1 - s)
        rate = opens / (power * m**power)
        since = at**power
        to = np.floor((since - np.log(_uniform(key[some], *parts, turn)) / rate) ** (1 / power))
        to = np.minimum(np.maximum(to, at), m)
        weight[some] += log_gamma(to - discount * t) - log_gamma(at - discount * t) + rate * (to**power - since)
        new = to < m
        some, at, opens, rate, power = some[new], to[new], opens[new], rate[new], power[new]
        weight[some] += np.log(opens) - np.log(-np.expm1(rate * (at**power - (at + 1) ** power)))
        tables[some] += 1
        more = at + 1 < c[some]
        some, at, turn = some[more], at[more] + 1, turn + 1
    return tables, weight


def seat(c: np.ndarray, strength: np.ndarray, share: np.ndarray, discount: float, key: np.ndarray, sweep: int) -> np.ndarray:
    """New numbers of tables of dishes with c customers.

    strength: concentration + discount * tables of the restaurant's other dishes;
    share: the parent's probability of the dish; key: what the draws depend on.
    """
    tables = np.minimum(c, 1).astype(np.int64)
    ways, draw = log_ways(discount), _uniform(key, sweep, 0)
    small = np.flatnonzero((c > 1) & (c <= EXACT))
    small = small[np.argsort(c[small], kind="stable")]
    for some in np.split(small, np.flatnonzero(np.diff(c[small])) + 1):
        n = int(c[some[0]]) if len(some) else 0
        if n == 2:
            second = (strength[some] + discount) * share[some] / (1 - discount)
            tables[some] = 1 + (draw[some] * (1 + second) > 1)
        elif n:
            for part in np.array_split(some, len(some) * n // (1 << 20) + 1):
                new = np.log((strength[part, None] + discount * np.arange(n)) * share[part, None]).cumsum(1) + ways[n, 1 : n + 1]
                chance = np.exp(new - new.max(1, keepdims=True)).cumsum(1)
                tables[part] = 1 + (chance < draw[part, None] * chance[:, -1:]).sum(1)
    large = np.flatnonzero(c > EXACT)
    if len(large):
        args = c[large], strength[large], share[large], discount, key[large], sweep
        held, weight = _seated(*args, 1)
        for i in range(2, TRIES + 1):
            other, its = _seated(*args, i)
            taken = np.log(_uniform(key[large], sweep, 100 + i)) <= its - weight
            held, weight = np.where(taken, other, held), np.where(taken, its, weight)
        tables[large] = held
    return tables


def _tokenised(docs: DataFrame, held: Column, slice_bytes: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            texts = as_bytes(batch.column(2))
            for a, b in slices(texts, slice_bytes):
                h, before = words(texts[a:b], lower=True)
                with_ends = np.insert(h, before[1:], END)
                known, tokens = np.unique(with_ends, return_inverse=True)
                size = np.diff(before) + 1
                row = [[number], [batch.column(0)[a:b].to_pylist()], [batch.column(1)[a:b].to_pylist()], [size.tobytes()], [known.tobytes()], [tokens.astype(np.uint32).tobytes()], [len(tokens)], [len(known)]]
                number += 1
                yield _rows(row, SLICES)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(held, F.lit(False)).alias("held"), "text").mapInArrow(run, SLICES)


def _rows(columns: list[list], schema: str) -> pa.RecordBatch:
    fields = [f.split() for f in schema.split(", ")]
    kind = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "double": pa.float64(), "boolean": pa.bool_(), "array<long>": pa.list_(pa.int64()), "array<boolean>": pa.list_(pa.bool_())}
    return pa.RecordBatch.from_arrays([pa.array(x, kind[t]) for x, (_, t) in zip(columns, fields, strict=True)], names=[n for n, _ in fields])


def _pairs(size: np.ndarray, tokens: np.ndarray, end: int) -> np.ndarray:
    """Context and word of each token, as one number."""
    context = np.empty(len(tokens), np.uint64)
    context[1:] = tokens[:-1]
    context[np.cumsum(size) - size] = end
    return context << U64(32) | tokens


def _pair_keys(known: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    u, w = (pairs >> U64(32)).astype(np.int64), (pairs & U64(0xFFFFFFFF)).astype(np.int64)
    return mix(known[u] * RUN_KEYS[0] + known[w] * RUN_KEYS[1])


def _array(row: dict, name: str, kind) -> np.ndarray:
    return np.frombuffer(row[name], kind)


def _packed(x: np.ndarray) -> bytes:
    """Whole numbers from 0 on in as few bytes each as the largest needs; the first byte says how many."""
    kind = np.min_scalar_type(int(x.max())) if len(x) else np.dtype(np.uint8)
    return bytes([kind.itemsize]) + x.astype(kind).tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(data, f"u{data[0]}", offset=1).astype(np.int64)


def _sent(number: int, keys: np.ndarray, bits: int, n: np.ndarray, tables: np.ndarray | None = None, customers: np.ndarray | None = None) -> pa.RecordBatch:
    """A row for each bucket of sorted keys."""
    bucket = (keys >> U64(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)
    cut = np.concatenate([[0], np.flatnonzero(np.diff(bucket)) + 1, [len(keys)]]) if len(keys) else np.zeros(1, np.int64)
    part = lambda x, how=_packed: [None if x is None else how(x[a:b]) for a, b in zip(cut[:-1], cut[1:], strict=True)]
    return _rows([bucket[cut[:-1]].tolist(), [number] * (len(cut) - 1), part(keys, np.ndarray.tobytes), part(n), part(tables), part(customers)], PARTS)


def _bits(n: int, bucket: int) -> int:
    return max(0, int(n - 1).bit_length() - bucket.bit_length() + 1) if n else 0


def _send_pairs(rows: DataFrame, bits: int) -> DataFrame:
    """Every slice's distinct pairs with their numbers in training texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                known, size = _array(row, "words", U64), _array(row, "sizes", np.int64)
                pairs = _pairs(size, _array(row, "tokens", np.uint32), int(np.searchsorted(known, END)))
                learned = np.repeat(~np.array(row["held"], bool), size)
                distinct, of = np.unique(pairs, return_inverse=True)
                n = np.bincount(of[learned], minlength=len(distinct)).astype(np.int64)
                keys = _pair_keys(known, distinct)
                order = np.argsort(keys)
                yield _sent(row["slice"], keys[order], bits, n[order])

    return rows.select("slice", "held", "sizes", "words", "tokens").mapInArrow(run, PARTS)


def _send_counts(rows: DataFrame, bits: int) -> DataFrame:
    """Every slice's words with their tokens in training texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                known = _array(row, "words", U64)
                learned = np.repeat(~np.array(row["held"], bool), _array(row, "sizes", np.int64))
                yield _sent(row["slice"], known, bits, np.bincount(_array(row, "tokens", np.uint32)[learned], minlength=len(known)))

    return rows.select("slice", "held", "sizes", "words", "tokens").mapInArrow(run, PARTS)


def _count(root: dict | None = None, shared: bool = False):
    """Adds up what the slices sent to one bucket and answers each of them.

    Pairs are answered with their number and whether the slice is the first to have
    them, or, shared, with number and tables; words with numbers, tables, customers
    and new seats, which are drawn with ``root``.
    """

    def run(group: pa.Table) -> pa.Table:
        rows = [r for b in group.to_batches() for r in b.to_pylist()]
        keys = np.frombuffer(b"".join(r["keys"] for r in rows), U64)
        distinct, first, of = np.unique(keys, return_index=True, return_inverse=True)

        def total(name: str) -> np.ndarray:
            sums = np.zeros(len(distinct), np.int64)
            np.add.at(sums, of, np.concatenate([_unpacked(r[name]) for r in rows]))
            return sums

        n, zero = total("n"), np.zeros(0, np.int64)
        own = np.zeros(len(keys), np.int64)
        own[first] = 1
        answer = {"n": n[of] << 1 | own}
        tables = customers = seats = zero
        counted = n
        if shared:
            answer = {"n": n[of], "tables": total("tables")[of]}
        if root is not None:
            tables, customers = total("tables"), total("customers")
            seats = np.minimum(customers, 1)
            if root["sweep"]:
                strength = np.maximum(THETA + root["discount"] * (root["seat_sum"] - 1.0), 1e-9)
                seats = seat(customers, np.full(len(customers), strength), np.full(len(customers), root["base"]), root["discount"], distinct, root["sweep"])
            answer = {"n": n[of], "tables": tables[of], "customers": customers[of], "seats": seats[of]}
            counted = customers
        cut = np.cumsum([0] + [len(r["keys"]) // 8 for r in rows])
        columns = [[[r["bucket"] for r in rows], [r["slice"] for r in rows]]]
        columns += [[[_packed(answer[k][a:b]) if k in answer else None for a, b in zip(cut[:-1], cut[1:], strict=True)] for k in ("n", "tables", "customers", "seats")]]
        sums = [n.sum(), (n > 0).sum(), customers.sum(), seats.sum(), (counted == 1).sum(), (counted == 2).sum()]
        columns += [[[int(x)] + [0] * (len(rows) - 1) for x in sums]]
        return pa.Table.from_batches([_rows(sum(columns, []), COUNTED)])

    return run


def _totals(counted: DataFrame) -> dict:
    names = ("n_sum", "known", "customer_sum", "seat_sum", "once", "twice")
    row = counted.agg(*[F.coalesce(F.sum(x), F.lit(0)).alias(x) for x in names]).first()
    return row.asDict()


def _discount(once: int, twice: int) -> float:
    return min(0.95, max(0.05, once / (once + 2 * twice))) if once else 0.5


def _answers(group: pa.Table, name: str) -> np.ndarray:
    """What the buckets sent to one slice, in the order of its keys."""
    sent = sorted(zip(group["bucket"].to_pylist(), group[name].to_pylist(), strict=True))
    return np.concatenate([_unpacked(x) for _, x in sent] or [np.zeros(0, np.int64)])


def _begin(left: pa.Table, right: pa.Table) -> pa.Table:
    """A slice with the counts of its pairs: each pair has one table."""
    row = left.to_pylist()[0]
    known, size = _array(row, "words", U64), _array(row, "sizes", np.int64)
    tokens = _array(row, "tokens", np.uint32)
    distinct = np.sort(_pairs(size, tokens, int(np.searchsorted(known, END))))
    distinct = distinct[np.append(True, distinct[1:] != distinct[:-1])]
    sent = np.empty(len(distinct), np.int64)
    sent[np.argsort(_pair_keys(known, distinct))] = _answers(right, "n")
    c, own = sent >> 1, (sent & 1) > 0
    u, w = (distinct >> U64(32)).astype(np.uint32), (distinct & U64(0xFFFFFFFF)).astype(np.uint32)
    lone, seated = (c == 1) & own, (c > 1) & own
    learned = np.repeat(~np.array(row["held"], bool), size)
    of_words = lambda x: _packed(np.bincount(x, minlength=len(known)))
    steps, tables = np.diff(u[seated].astype(np.int64), prepend=0), np.ones(int(seated.sum()), np.int64)
    made = [row["slice"], row["words"], _packed(steps), w[seated].tobytes(), _packed(c[seated]), _packed(tables), _packed(0 * tables)]
    made += [np.packbits(c == 1).tobytes(), np.packbits(c > 1).tobytes(), of_words(u[lone]), of_words(w[lone]), of_words(tokens[learned]), b""]
    return pa.Table.from_batches([_rows([[x] for x in made], STATE)])


def _contexts(state: dict) -> tuple[np.ndarray, np.ndarray]:
    """Contexts and words of the pairs that a slice seats."""
    return np.cumsum(_unpacked(state["u"])), _array(state, "w", np.uint32).astype(np.int64)


def _send_words(state: DataFrame, bits: int) -> DataFrame:
    """Every slice's words with their tokens, and tables and customers by the pairs it counts for all slices."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                known, (u, w) = _array(row, "words", U64), _contexts(row)
                t = _unpacked(row["t"]).astype(np.float64)
                sums = [_unpacked(row[lone]) + np.bincount(by, t, len(known)).astype(np.int64) for lone, by in (("lone_t", u), ("lone_c", w))]
                yield _sent(row["slice"], known, bits, _unpacked(row["n"]), *sums)

    return state.select("slice", "words", "u", "w", "t", "lone_t", "lone_c", "n").mapInArrow(run, PARTS)


def _many(row: dict, state: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of a slice: its distinct pairs, which of them each token is, the places of those of two customers or more, and the order of these by their keys."""
    known = _array(row, "words", U64)
    pairs = _pairs(_array(row, "sizes", np.int64), _array(row, "tokens", np.uint32), int(np.searchsorted(known, END)))
    distinct, of = np.unique(pairs, return_inverse=True)
    many = np.flatnonzero(np.unpackbits(_array(state, "many", np.uint8), count=len(distinct)))
    return distinct, of, many, np.argsort(_pair_keys(known, distinct[many]))


def _send_seats(bits: int):
    """Every slice's pairs of two customers or more, with customers and summed tables of those that it seats."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        row, state = left.to_pylist()[0], right.to_pylist()[0]
        distinct, _, many, order = _many(row, state)
        u, w = _contexts(state)
        at = np.searchsorted(distinct[many], u.astype(U64) << U64(32) | w.astype(U64))
        c, t = np.zeros(len(many), np.int64), np.zeros(len(many), np.int64)
        c[at], t[at] = _unpacked(state["c"]), _unpacked(state["t_sum"])
        keys = _pair_keys(_array(row, "words", U64), distinct[many])
        return pa.Table.from_batches([_sent(row["slice"], keys[order], bits, c[order], t[order])])

    return run


def _root(customers: np.ndarray, seats: np.ndarray, model: dict) -> np.ndarray:
    """The parent's probabilities of words."""
    new = (THETA + model["root_discount"] * model["seat_sum"]) * model["base"]
    return (customers - model["root_discount"] * seats + new) / (THETA + model["customer_sum"])


def _sweep(model: dict, sweep: int, sampled: bool, last: bool):
    """Takes a sample of the last sweep's seats, if it counts, and seats all pairs anew, unless that was the last."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        row = left.to_pylist()[0]
        tables, customers, seats = (_answers(right, x) for x in ("tables", "customers", "seats"))
        t = _unpacked(row["t"])
        if sampled:
            row["t_sum"] = _packed(_unpacked(row["t_sum"]) + t)
            row["samples"] += _packed(tables) + _packed(customers) + _packed(seats)
        if last:
            row["n"] = _packed(_answers(right, "n"))
        else:
            known, (u, w) = _array(row, "words", U64), _contexts(row)
            strength, root = THETA + model["discount"] * (tables[u] - t), _root(customers, seats, model)
            key = _pair_keys(known, u.astype(U64) << U64(32) | w.astype(U64))
            row["t"] = _packed(seat(_unpacked(row["c"]), strength, root[w], model["discount"], key, sweep))
        return pa.Table.from_batches([_rows([[row[f.split()[0]]] for f in STATE.split(", ")], STATE)])

    return run


def _together(left: pa.Table, right: pa.Table) -> pa.Table:
    """What scores need of a slice, with what its pairs of two customers or more were answered."""
    row = left.to_pylist()[0] | {"c": _packed(_answers(right, "n")), "t_sum": _packed(_answers(right, "tables"))}
    return pa.Table.from_batches([_rows([[row[f.split()[0]]] for f in FINAL.split(", ")], FINAL)])


def _base(size: np.ndarray, tokens: np.ndarray, n: np.ndarray, n_sum: int, known: int) -> list:
    """Of each text of a slice: n_tokens, n_known, train_tokens, base_score."""
    first = np.cumsum(size) - size
    base = np.add.reduceat(np.log10((n + 1) / (n_sum + known + 1))[tokens], first)
    return [size, np.add.reduceat((n > 0).astype(np.int64)[tokens], first), [n_sum] * len(size), base]


def _scored(models: list[dict]):
    """models: of each sampled sweep."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        row, state = left.to_pylist()[0], right.to_pylist()[0]
        size, tokens = _array(row, "sizes", np.int64), _array(row, "tokens", np.uint32)
        distinct, of, many, order = _many(row, state)
        u, w = (distinct >> U64(32)).astype(np.int64), (distinct & U64(0xFFFFFFFF)).astype(np.int64)
        n, discount = _unpacked(state["n"]), models[0]["discount"]
        held = np.unpackbits(_array(state, "lone", np.uint8), count=len(distinct)) * (1 - discount)  # customers less discounts
        held[many[order]] = _unpacked(state["c"]) - discount * _unpacked(state["t_sum"]) / len(models)
        p, at = held / (THETA + n[u]), 0
        for model in models:
            some = []
            for _ in range(3):
                to = at + 1 + len(n) * state["samples"][at]
                some.append(_unpacked(state["samples"][at:to]))
                at = to
            tables, customers, seats = some
            p += ((THETA + discount * tables) / (THETA + n))[u] * _root(customers, seats, model)[w] / len(models)
        score = np.add.reduceat(np.log10(p)[of], np.cumsum(size) - size)
        base = _base(size, tokens, n, models[0]["n_sum"], models[0]["known"])
        return pa.Table.from_batches([_rows([row["ids"], row["held"], *base, score, 10 ** -(score / size)], RESULT)])

    return run


def base_scores(docs: DataFrame, held: Column, slice_bytes: int = SLICE_BYTES, bucket: int = BUCKET) -> DataFrame:
    """score() without what its pairs give: doc_id, held_out, n_tokens, n_known, train_tokens and base_score of every row of docs. Only the slices' distinct words are exchanged, once each way."""
    rows = stage_bucketed(_tokenised(docs, held, slice_bytes), "slices", "slice")
    n_words = rows.agg(F.coalesce(F.sum("n_words"), F.lit(0))).first()[0]
    counts = stage(_send_counts(rows, _bits(n_words, bucket // 2)).groupBy("bucket").applyInArrow(_count(), COUNTED), "words")
    sums = _totals(counts)

    def scored(left: pa.Table, right: pa.Table) -> pa.Table:
        row = left.to_pylist()[0]
        n = _answers(right, "n") >> 1
        base = _base(_array(row, "sizes", np.int64), _array(row, "tokens", np.uint32), n, sums["n_sum"], sums["known"])
        return pa.Table.from_batches([_rows([row["ids"], row["held"], *base], BASE)])

    tidy(docs.sparkSession)
    return rows.select("slice", "ids", "held", "sizes", "tokens").groupBy("slice").cogroup(counts.select("slice", "bucket", "n").groupBy("slice")).applyInArrow(scored, BASE)


def score(docs: DataFrame, held: Column, sweeps: int = SWEEPS, burn: int = BURN, slice_bytes: int = SLICE_BYTES, bucket: int = BUCKET) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score and perplexity of every row of docs; the model learns from rows for which ``held`` isn't true.

    score is the log10 of the text's probability.  Runs a job for each sweep when
    it is called; the frame reads tables of the shared folder.
    """
    rows = stage_bucketed(_tokenised(docs, held, slice_bytes), "slices", "slice")
    n_tokens, n_words = rows.agg(F.coalesce(F.sum("n_tokens"), F.lit(0)), F.coalesce(F.sum("n_words"), F.lit(0))).first()
    pair_bits, word_bits = _bits(n_tokens, bucket), _bits(n_words, bucket // 2)
    tidy(docs.sparkSession)
    counts = stage(_send_pairs(rows, pair_bits).groupBy("bucket").applyInArrow(_count(), COUNTED), "pairs")
    tidy(docs.sparkSession)
    pairs = _totals(counts)
    state = stage_bucketed(rows.groupBy("slice").cogroup(counts.select("slice", "bucket", "n").groupBy("slice")).applyInArrow(_begin, STATE), "state", "slice")
    release(staged() - 2, staged() - 1)
    tidy(docs.sparkSession)
    model, models = {"discount": _discount(pairs["once"], pairs["twice"])}, []
    for sweep in range(sweeps + 1):
        root = {"sweep": sweep} if not sweep else {"sweep": sweep, "discount": model["root_discount"], "seat_sum": model["seat_sum"], "base": model["base"]}
        found = stage(_send_words(state, word_bits).groupBy("bucket").applyInArrow(_count(root), COUNTED), "words")
        sums = _totals(found)
        if not sweep:
            model |= {"root_discount": _discount(sums["once"], sums["twice"]), "n_sum": sums["n_sum"], "known": sums["known"], "base": 1 / (sums["known"] + 1)}
        model |= {"customer_sum": sums["customer_sum"], "seat_sum": sums["seat_sum"]}
        sampled, last = sweep > min(burn, sweeps - 1), sweep == sweeps
        models += [dict(model)] if sampled else []
        step = _sweep(dict(model), sweep + 1, sampled, last)
        tidy(docs.sparkSession)
        answers = found.select("slice", "bucket", *["n"] * last, "tables", "customers", "seats").groupBy("slice")
        state = stage_bucketed(state.groupBy("slice").cogroup(answers).applyInArrow(step, STATE), "state", "slice")
        release(staged() - 3, staged() - 1)  # the state before, and the words
        tidy(docs.sparkSession)
    seated = state.select("slice", "u", "w", "c", "t_sum", "many").groupBy("slice")
    sent = rows.select("slice", "sizes", "words", "tokens").groupBy("slice").cogroup(seated).applyInArrow(_send_seats(pair_bits), PARTS)
    shared = stage(sent.groupBy("bucket").applyInArrow(_count(shared=True), COUNTED), "shared")
    tidy(docs.sparkSession)
    answers = shared.select("slice", "bucket", "n", "tables").groupBy("slice")
    kept = state.select("slice", "lone", "many", "n", "samples").groupBy("slice")
    used = stage_bucketed(kept.cogroup(answers).applyInArrow(_together, FINAL), "final", "slice")
    release(staged() - 3, staged() - 1)
    tidy(docs.sparkSession)
    return rows.groupBy("slice").cogroup(used.groupBy("slice")).applyInArrow(_scored(models), RESULT)
