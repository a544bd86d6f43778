"""Benchmark decontamination by spaced-seed hashing.

A mask over consecutive words looks at some positions and ignores the others, so
that a seed survives a word that was replaced there.  Seeds of all benchmark items
and of all documents are hashed under the same masks and joined on the hash.  Each
side brings the hashes of the words around its seed (REACH to the left and to the
right), and where two seeds meet, item and document are laid over one another
there: an overlap counts if some window of WINDOW words of the item (the whole item
if it is shorter) agrees in AGREE hundredths of its words or more; of items under
SHORT words every word must agree.  Windows that count are put together over all
seeds of one shift between text and item, so an overlap is as long as it is: agreeing
words are bits of the item's blocks of 64 words, which tasks merge before they are
shuffled.

A Bloom filter of the items' seeds, of BITS bits at most, keeps other seeds of
documents out of the join; where a benchmark fills it, more seeds go into the join
and none is lost.  Equal surroundings of one seed within a text, or an item, are
taken once, so that repeats don't multiply.  Whether a text overlaps depends on the
text alone: what is found is kept by two hashes of the text and joined with the
rows afterwards.  The documents are read twice, whatever the size of the benchmark.

Edge cases.  Null and empty texts and items match nothing.  Words are runs of
letters and digits, in small letters.  Texts are taken whole.  Repeated rows give
repeated rows.  Rows without doc_id have no row in ``contaminated``, but ``clean``
judges them as others; rows without item_id are ignored, and other columns too.
An empty benchmark gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_bytes, slices, stage
from .kernels import NOT_ALNUM, RUN_KEYS, U64, lower_in_place, mix, words

#: Fixed masks, all of four looked-at positions.
MASKS = ("1111", "11011", "110101", "1010011")
WINDOW, AGREE, SHORT, REACH, BITS = 20, 80, 8, 32, 28
#: Texts that are removed by a broadcast join, 16 bytes each; beyond that Spark chooses.
MOST_BROADCAST = 1_000_000
KEY = ["text_key", "text_key_2"]


def _words(texts: list[bytes]):
    return words([lower_in_place(t) for t in texts], NOT_ALNUM, lower=True)


def seeds(h: np.ndarray, mask: str) -> np.ndarray:
    """A hash for each place where the mask fits."""
    size = len(h) - len(mask) + 1
    if size <= 0:
        return np.empty(0, U64)
    out = np.full(size, U64(len(mask)))
    for k, c in enumerate(mask):
        if c == "1":
            out += h[k : k + size] * RUN_KEYS[k]
    return mix(out)


class Bloom:
    """Bits of 64-bit hashes: four for each, 32 bits of room for each and 2^BITS at most."""

    def __init__(self, bits: int):
        self.bits, self.held = bits, np.zeros(1 << bits - 3, np.uint8)

    def _slots(self, keys: np.ndarray, k: int) -> np.ndarray:
        """The first slot is of the keys themselves, which are mixed already."""
        return ((mix(keys * RUN_KEYS[k]) if k else keys) >> U64(64 - self.bits)).astype(np.int64)

    def add(self, keys: np.ndarray) -> None:
        for k in range(4):
            at = self._slots(keys, k)
            np.bitwise_or.at(self.held, at >> 3, np.uint8(1) << (at & 7).astype(np.uint8))

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Places of keys that may be among those added."""
        left = np.arange(len(keys))
        for k in range(4):
            at = self._slots(keys[left], k)
            left = left[self.held[at >> 3] >> (at & 7).astype(np.uint8) & 1 == 1]
        return left


def bloom(seeds: DataFrame) -> Bloom:
    """Of the column seed. Tasks set bits in a map each and send the bytes that aren't empty, which are merged before any comes to the driver."""
    bits = min(BITS, max(12, (32 * seeds.count()).bit_length()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Bloom(bits)
        for batch in batches:
            own.add(batch.column(0).to_numpy().view(U64))
        words = own.held.view(np.int64)
        some = np.flatnonzero(words)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(words[some])], names=["word", "bits"])

    made, out = seeds.select("seed").mapInArrow(run, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")), Bloom(bits)
    found = made.toArrow()
    out.held.view(np.int64)[found["word"].to_numpy()] = found["bits"].to_numpy()
    return out


def placed(h: np.ndarray, filled: Bloom | None, short: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Seeds of one text's words, their places and the words around (REACH before, REACH from there on; 0 beyond the text).

    filled: only seeds that it may hold.  short: single words too, for items that
    no mask fits into.  Each seed with equal surroundings is given once.
    """
    found = [h[:1] if filled is None and 0 < len(h) < len(MASKS[0]) else h if short else h[:0]]
    found += [seeds(h, mask) for mask in MASKS]
    at = [np.arange(len(x)) if filled is None else filled.find(x) for x in found]
    key, place = np.concatenate([x[i] for x, i in zip(found, at, strict=True)]), np.concatenate(at)
    if not len(key):
        return key, place, np.zeros((0, 2 * REACH), np.uint32)
    low = np.concatenate([np.zeros(REACH, np.uint32), (h & U64(0xFFFFFFFF)).astype(np.uint32), np.zeros(REACH, np.uint32)])
    around = low[place[:, None] + np.arange(2 * REACH)]
    rows = np.concatenate([key.view(np.uint32).reshape(-1, 2), around], 1)
    _, once = np.unique(rows, axis=0, return_index=True)
    once.sort()
    return key[once], place[once], around[once]


def _hit(h: np.ndarray, before: np.ndarray, filled: Bloom | None, short: bool) -> list[int]:
    """Numbers of the texts with a seed that the filter may hold (some of them by a seed that crosses into the next text); all texts without a filter."""
    if filled is None:
        return list(range(len(before) - 1))
    at = [filled.find(x) for x in ([h] if short else []) + [seeds(h, mask) for mask in MASKS]]
    return np.unique(np.searchsorted(before, np.concatenate(at), side="right") - 1).tolist()


def _seeded(filled: Bloom | None, short: bool, names: list[str]):
    """Rows (..., text) to rows (seed, ..., place, n_words, around), one for each seed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = as_bytes(batch.column(batch.num_columns - 1))
            for a, b in slices(texts):
                h, before = _words(texts[a:b])
                for i in _hit(h, before, filled, short):
                    x, y = before[i], before[i + 1]
                    key, place, around = placed(h[x:y], filled, short)
                    if len(key):
                        held = [pa.array([batch.column(c)[a + i].as_py()] * len(key), pa.int64()) for c in range(batch.num_columns - 1)]
                        made = [pa.array(key.view(np.int64)), *held, pa.array(place), pa.array(np.full(len(key), y - x)), pa.array([r.tobytes() for r in around], pa.binary())]
                        yield pa.RecordBatch.from_arrays(made, names=names)

    return run


def laid_over(item: np.ndarray, text: np.ndarray, place: np.ndarray, n_words: np.ndarray) -> np.ndarray:
    """Of surroundings in rows, seed over seed: which words agree within windows that count.

    place, n_words: the seed's word in the item, and the item's words.
    """
    at = np.arange(2 * REACH)
    first, last = np.maximum(REACH - place, 0), np.minimum(REACH - place + n_words, 2 * REACH)
    same = (item == text) & (at >= first[:, None]) & (at < last[:, None])
    total = np.concatenate([np.zeros((len(same), 1), np.int64), np.cumsum(same, axis=1)], axis=1)
    inside = np.zeros_like(same)
    sizes = np.minimum(n_words, WINDOW)
    for size in np.unique(sizes).tolist():
        rows = np.flatnonzero(sizes == size)
        need = np.where(n_words[rows] < SHORT, size, -(-AGREE * size // 100))
        start = np.arange(2 * REACH - size + 1)
        good = (total[rows, size:] - total[rows, : len(start)] >= need[:, None]) & (start >= first[rows, None]) & (start + size <= last[rows, None])
        edge = np.zeros((len(rows), 2 * REACH + 1), np.int64)
        edge[:, : len(start)] += good
        edge[:, size : size + len(start)] -= good
        inside[rows] = same[rows] & (np.cumsum(edge, axis=1)[:, :-1] > 0)
    return inside


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Seeds that met to agreeing words: a row for each block of the item's words that has some."""
    for batch in batches:
        if batch.num_rows:
            get = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            item, text = (np.frombuffer(b"".join(get[n].to_pylist()), np.uint32).reshape(-1, 2 * REACH) for n in ("item_around", "around"))
            at, n_words = get["item_place"].to_numpy(), get["item_words"].to_numpy()
            inside = laid_over(item, text, at, n_words)
            some = np.flatnonzero(inside.any(1))
            inside, at, place = inside[some], at[some], get["place"].to_numpy()[some]
            first, end = place - REACH + inside.argmax(1), place + REACH - inside[:, ::-1].argmax(1)
            bits = np.packbits(inside, axis=1, bitorder="little").view(U64)[:, 0]
            move = ((at - REACH) & 63).astype(U64)
            high = np.where(move > 0, bits >> ((U64(64) - move) & U64(63)), U64(0))
            for block, part in (((at - REACH) >> 6, bits << move), (((at - REACH) >> 6) + 1, high)):
                kept = np.flatnonzero(part)
                known = [get[k].take(pa.array(some[kept])) for k in [*KEY, "item_id", "item_words"]]
                numbers = (place - at, block, part.view(np.int64), first, end)
                yield pa.RecordBatch.from_arrays([*known, *(pa.array(x[kept]) for x in numbers)], names=_FOUND)


_FOUND = [*KEY, "item_id", "n_words", "shift", "block", "bits", "first_word", "end_word"]


def keyed(docs: DataFrame) -> DataFrame:
    """Adds two hashes of the text, null for a null text."""
    return docs.withColumns({KEY[0]: F.when(F.col("text").isNotNull(), F.xxhash64("text")), KEY[1]: F.when(F.col("text").isNotNull(), F.xxhash64(F.lit(7), "text"))})


def overlaps(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row for each text and item that overlap: the text's hashes, item_id, first_word and end_word (numbers of words of the text, the end exclusive), n_matched (agreeing words), n_words (the item's). Of several shifts that with the most agreeing words."""
    items = benchmark.where("item_id IS NOT NULL AND text IS NOT NULL").select(F.col("item_id").cast("long"), F.col("text").cast("string"))
    names = ["seed", "item_id", "item_place", "item_words", "item_around"]
    sown = stage(items.mapInArrow(_seeded(None, False, names), "seed long, item_id long, item_place long, item_words long, item_around binary"), "items")
    short = not sown.where(F.col("item_words") < len(MASKS[0])).isEmpty()
    texts = keyed(docs.select(F.col("text").cast("string"))).where("text IS NOT NULL").select(*KEY, "text")
    hits = texts.mapInArrow(_seeded(bloom(sown), short, ["seed", *KEY, "place", "words", "around"]), "seed long, text_key long, text_key_2 long, place long, words long, around binary")
    met = hits.join(sown, "seed").select(*KEY, "place", "around", "item_id", "item_place", "item_words", "item_around")
    found = met.mapInArrow(_met, ", ".join(f"{n} long" for n in _FOUND))
    ends = [F.max("n_words").alias("n_words"), F.min("first_word").alias("first_word"), F.max("end_word").alias("end_word")]
    blocks = found.groupBy(*KEY, "item_id", "shift", "block").agg(F.bit_or("bits").alias("bits"), *ends)
    shifts = blocks.groupBy(*KEY, "item_id", "shift").agg(F.sum(F.bit_count("bits")).alias("n_matched"), *ends)
    best = F.max_by(F.struct("first_word", "end_word", "n_matched"), F.struct("n_matched", -F.col("first_word"), -F.col("end_word"))).alias("best")
    return shifts.groupBy(*KEY, "item_id").agg(best, F.max("n_words").alias("n_words")).select(*KEY, "item_id", "best.*", "n_words")


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row for each document and item that overlap: doc_id and what ``overlaps`` gives."""
    found = stage(overlaps(docs, benchmark), "overlaps")
    rows = keyed(docs.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long"), F.col("text").cast("string"))).drop("text")
    return rows.join(found, KEY).drop(*KEY)


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that overlap no item, with all their columns.

    Texts that go are broadcast if they are MOST_BROADCAST at most; else the join is Spark's to plan.
    """
    bad = stage(overlaps(docs, benchmark).select(*[F.col(k).alias(f"__{k}") for k in KEY]).distinct(), "overlaps")
    made = keyed(docs.select(F.struct(*docs.columns).alias("row"), F.col("text").cast("string").alias("text")))
    if bad.count() <= MOST_BROADCAST:
        bad = F.broadcast(bad)
    kept = made.join(bad, (made[KEY[0]] == bad[f"__{KEY[0]}"]) & (made[KEY[1]] == bad[f"__{KEY[1]}"]), "left_anti")
    return kept.select("row.*")
