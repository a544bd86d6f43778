"""Substring deduplication by sliding spans of sentences.

Every word may end a sentence, as passages without punctuation have no other ends
and ends that depend on what stands before a passage differ between documents.
So from every word on, the run of LEAST words (a parameter) is hashed, and each longer run of
sentences is covered by such runs.  Equal hashes are joined over all documents.
The occurrence in the least doc_id, and there the first, stays; what other
occurrences cover is removed.

A run that occurs again within its text is marked where the text is read.  All
others meet in shortened form, 32 bits in one of many buckets: a task sends what it
gathered, each hash twice at most, as sorted numbers of four bytes, and there are so
many buckets that one holds some BUCKET of them (24 million at 100 TB, where there are
2^MOST_BUCKETS).  What meets there sets bits in a map of 2^BITS bits at most.  The texts are read again for
the full hashes of runs whose bit is set, aggregated to the least and largest doc_id
before they are shuffled, and once more for the places of those runs, which are
joined with the hashes of several documents.  So a false bit costs work and changes
nothing.  (In a corpus so large that the map fills, more runs go into the second and
the third shuffle, and none is lost.)  The join has one row for each hash on one
side, so a hash of very many places is split by adaptive execution.

Edge cases.  Null and empty texts, and those of fewer words, have no runs.
Texts are taken whole.  Letter case, punctuation and white space don't count.
Repeated rows of one doc_id are one document.  Rows without doc_id are ignored.
Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_bytes, slices, stage
from .kernels import NOT_ALNUM, U64, lower_in_place, mix, words

#: Sentences and words of a run at least; a sentence ends after words whose hash is a multiple of CUT, which are all, and so before LONGEST words.
SEVERAL, LEAST, CUT, LONGEST = 2, 15, 1, 32
AT_ONCE = 1 << 20  # bytes of text, each of which takes some 40 bytes of arrays
#: Bits of the map and of bucket numbers at most, of bucket numbers at least; hashes of a bucket; hashes that a task gathers before it sends them.
BITS, MOST_BUCKETS, LEAST_BUCKETS, BUCKET, GATHERED = 28, 20, 8, 1 << 22, 1 << 21
RADIX = U64(0x9E3779B97F4A7C55)
_INVERSE = U64(pow(int(RADIX), -1, 1 << 64))


def runs(texts: list[bytes], least: int = LEAST) -> tuple[np.ndarray, ...]:
    """Hash, text number, start and end (code points) of every run, in order, and whether it occurred before in its text."""
    h, before, starts, ends = words([lower_in_place(t) for t in texts], NOT_ALNUM, lower=True, places=True)
    n = len(h)
    if not n:
        none = np.empty(0, np.int64)
        return none.view(U64), none, none, none, none.astype(bool)
    doc = np.repeat(np.arange(len(texts)), np.diff(before))
    base = np.cumsum([0] + [len(t) + 1 for t in texts])
    buf = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    first, last = starts + base[doc], ends + base[doc]
    at = np.arange(max(n - least + 1, 0))
    at = at[doc[at] == doc[at + least - 1]]
    of, to = doc[at], at + least
    power = np.cumprod(np.full(n + 1, RADIX), dtype=U64)
    total = np.concatenate([np.zeros(1, U64), np.cumsum(h * power[:n], dtype=U64)])
    back = np.cumprod(np.full(n + 1, _INVERSE), dtype=U64)
    key = mix((total[to] - total[at]) * back[at] + (to - at).astype(U64))
    points = np.concatenate([[0], np.cumsum((buf & 0xC0) != 0x80)])  # code points before each byte
    origin = points[base[of]]
    start, end = points[first[at]] - origin, points[last[to - 1]] - origin
    order = np.lexsort((start, key, of))
    again = np.zeros(len(key), bool)
    same = (key[order][1:] == key[order][:-1]) & (of[order][1:] == of[order][:-1])
    again[order[1:][same]] = True
    return key, of, start, end, again


def _sizes(source: DataFrame) -> tuple[int, int]:
    """Bits of bucket numbers and of the map, for as many runs as there are words (of four bytes with what parts them)."""
    n = (source.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // 4
    buckets = min(max((n // BUCKET).bit_length(), LEAST_BUCKETS), MOST_BUCKETS)
    return buckets, min(max((4 * n).bit_length(), buckets + 3), BITS)


def _bucketed(held: list[np.ndarray], bits: int) -> pa.RecordBatch:
    """Sorted 32-bit numbers after the first bits of the hashes, for each value of those; of equal ones two at most."""
    short = np.sort(np.concatenate(held)) >> U64(32 - bits)
    new = np.ones(len(short), bool)
    new[2:] = short[2:] != short[:-2]
    short = short[new]
    cut = np.searchsorted(short, np.arange((1 << bits) + 1, dtype=U64) << U64(32))
    data = (short & U64(0xFFFFFFFF)).astype(np.uint32)
    numbers = pa.Array.from_buffers(pa.binary(), 1 << bits, [None, pa.py_buffer((4 * cut).astype(np.int32)), pa.py_buffer(data)])
    made = pa.RecordBatch.from_arrays([pa.array(np.arange(1 << bits, dtype=np.int32)), numbers], names=["bucket", "numbers"])
    return made.filter(pa.array(np.diff(cut) > 0))


def _shortened(least: int, bits: int):
    """The shortened hashes of each document's runs, by bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            texts = as_bytes(batch.column(1))
            for a, b in slices(texts, AT_ONCE):
                key, _, _, _, again = runs(texts[a:b], least)
                held.append(key[~again])
                n += len(held[-1])
                if n >= GATHERED:
                    yield _bucketed(held, bits)
                    held, n = [], 0
        if n:
            yield _bucketed(held, bits)

    return run


def _met(bits: int):
    """A bucket's part of the map: its numbers that several rows, or one row twice, hold, by their first bits."""

    def run(table: pa.Table) -> pa.Table:
        numbers = np.sort(np.frombuffer(b"".join(table.column("numbers").to_pylist()), np.uint32))
        part = np.zeros(1 << bits, bool)
        part[numbers[1:][numbers[1:] == numbers[:-1]] >> np.uint32(32 - bits)] = True
        return pa.table([table.column("bucket")[:1], pa.array([np.packbits(part, bitorder="little").tobytes()], pa.binary())], names=["bucket", "bits"])

    return run


def _map(source: DataFrame, least: int) -> np.ndarray:
    """A bit for each value of the first digits of the hashes, as bytes: 0 if no two documents share a run of it."""
    buckets, bits = _sizes(source)
    sent = source.mapInArrow(_shortened(least, buckets), "bucket int, numbers binary")
    size = 1 << bits - buckets - 3
    out = np.zeros(size << buckets, np.uint8)
    found = sent.groupBy("bucket").applyInArrow(_met(bits - buckets), "bucket int, bits binary").toArrow()  # the map's size at most
    for bucket, part in zip(found["bucket"].to_pylist(), found["bits"]):
        out[bucket * size : (bucket + 1) * size] = np.frombuffer(part.as_buffer(), np.uint8)
    return out


def _marked(key: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Whether the hashes' bits are set."""
    slot = (key >> U64(64 - (8 * len(bits) - 1).bit_length())).astype(np.int64)
    return (bits[slot >> 3] >> (slot & 7).astype(np.uint8) & 1).astype(bool)


def _once(bits: np.ndarray, least: int):
    """The hashes of each document's runs whose bit is set, each once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0).to_numpy(), as_bytes(batch.column(1))
            for a, b in slices(texts, AT_ONCE):
                key, of, _, _, again = runs(texts[a:b], least)
                some = ~again & _marked(key, bits)
                yield pa.RecordBatch.from_arrays([pa.array(key[some].view(np.int64)), pa.array(ids[a:b][of[some]], pa.int64())], names=["hash", "doc_id"])

    return run


def _places(bits: np.ndarray, least: int):
    """Runs that occur again in their text, and those whose bit is set; place: start * 2^32 + length * 2 + whether it occurs again."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0).to_numpy(), as_bytes(batch.column(1))
            for a, b in slices(texts, AT_ONCE):
                key, of, start, end, again = runs(texts[a:b], least)
                some = again | _marked(key, bits)
                place = (start[some] << 32) + ((end - start)[some] << 1) + again[some]
                made = [pa.array(key[some].view(np.int64)), pa.array(ids[a:b][of[some]], pa.int64()), pa.array(place, pa.int64())]
                yield pa.RecordBatch.from_arrays(made, names=["hash", "doc_id", "place"])

    return run


def repeated_spans(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """least: words of a run; repeats of fewer words stay.

    doc_id, spans: array of struct(start, end), in code points, merged and in order: what is to be removed. Documents without any are left out."""
    source = docs.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    bits = _map(source, least)
    once = source.mapInArrow(_once(bits, least), "hash long, doc_id long")
    shared = once.groupBy("hash").agg(F.min("doc_id").alias("keeper"), F.max("doc_id").alias("other")).where("other > keeper").select("hash", "keeper")
    shared = stage(shared, "shared")
    found = source.mapInArrow(_places(bits, least), "hash long, doc_id long, place long")
    spans = found.join(shared, "hash", "left").where("place & 1 = 1 OR doc_id > keeper").select("doc_id", "place")
    return _merged(spans.groupBy("doc_id").agg(F.collect_list("place").alias("places")))


def _merged(spans: DataFrame) -> DataFrame:
    """Sorts each document's places, and joins overlapping and touching ones to spans."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = batch.column(1).flatten().to_numpy()
            start = place >> 32
            end = start + ((place & 0xFFFFFFFF) >> 1)
            row = np.repeat(np.arange(len(batch)), batch.column(1).value_lengths().to_numpy())
            order = np.lexsort((start, row))
            start, end = start[order], end[order]
            far = int(end.max(initial=0)) + 1
            reach = np.maximum.accumulate(end + row * far) - row * far  # the largest end so far in the row
            new = np.ones(len(start), bool)
            new[1:] = (row[1:] != row[:-1]) | (start[1:] > reach[:-1])
            first = np.flatnonzero(new)
            last = np.append(first[1:], len(start))[: len(first)] - 1
            made = pa.StructArray.from_arrays([pa.array(start[first]), pa.array(reach[last])], names=["start", "end"])
            cut = np.searchsorted(row[first], np.arange(len(batch) + 1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(cut, pa.int32()), made)], names=["doc_id", "spans"])

    return spans.mapInArrow(run, "doc_id long, spans array<struct<start:long,end:long>>")


def remove_spans(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """The documents without what the spans cover."""
    pieces = F.expr(
        "array_join(transform(sequence(0, size(__spans)), i -> substring(text, if(i = 0, 1, cast(__spans[i - 1].end as int) + 1),"
        " if(i = size(__spans), length(text), cast(__spans[i].start as int)) - if(i = 0, 0, cast(__spans[i - 1].end as int)))), '')"
    )
    joined = docs.join(spans.select("doc_id", F.col("spans").alias("__spans")), "doc_id", "left")
    return joined.withColumn("text", F.when(F.col("__spans").isNull(), F.col("text")).otherwise(pieces)).select(*docs.columns)
