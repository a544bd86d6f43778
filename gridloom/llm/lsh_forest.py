"""Near duplicates by MinHash and an LSH forest.

1. Every document gives the set of its runs of five words, a fingerprint of the
   set and a signature of 64 minima.  Documents of equal sets form a class; only
   its least doc_id goes on.
2. The forest: each tree takes another run of ``depth`` minima as the prefix of
   its order and sorts by all minima after it, wrapping round.  Documents of one
   prefix form a region.  ``depth`` is the largest at which a pair that just
   reaches the similarity misses every tree with a chance under ``MISS``.
   All regions of all trees are sorted together and dealt to tasks by ranges of
   that order, so that a large region is spread; a task slides over its rows with
   two chunks of CHUNK classes in hand.  What stands within them has the longest
   common prefixes: such neighbours are candidates if enough of their minima agree,
   and they are one block.
3. In each block candidates are compared on their full sets.  Documents that are
   linked already, over others of the block, aren't compared again, so that a
   group of n near copies takes some n comparisons.  A pair belongs to its first
   common tree and is compared there only.
4. Links of all blocks give components.  A region that two chunks didn't hold whole
   is open.  If it has several components, the classes outside the largest one are
   compared with all of it, in parts of PART classes, where that takes DIRECT pairs
   of minima at most.  Where it takes more, the region goes deeper: its rows are dealt
   anew by some more minima of any place, each place giving a region of its own, and
   those of several components go through steps 2 to 4 again.  So depth follows each
   region.
   A pair belongs to the first deeper place at which it agrees, and meets there.
   After DEEPEST rounds, in which pairs at the similarity are missed with a chance
   under MISS, what is still open is compared in parts all the same.

What is held in one task: two chunks of short rows (150 bytes a class), or the sets
of a block (two chunks at most), or a part of a region and the classes outside its
largest component.  What is shuffled: a
signature and the short forest rows of each class, and sets of classes that have
candidates; texts aren't.  A bitmap of fixed size at most tells the second reading
of the texts which of them have candidates.

Edge cases.  Null texts, and texts without words, have the empty set: they are
linked with nothing and kept.  Shorter texts are one shingle.  Texts are taken
whole.  Repeated rows of one doc_id are one node and each row is returned.  Rows
without doc_id are linked with nothing: component_id is null and kept is true.
An empty table gives an empty result.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import as_bytes, map_text, slices, stage
from .components import components
from .kernels import RUN_KEYS, U64, mix, shingle_sets, stream

HASHES, CHUNK, MISS, WORDS, MAX_BITS, DEEPEST = 64, 256, 1e-5, 5, 26, 3
#: A class at a place of the forest: which tree, the deeper places taken last and now (-1: none), and its minima.
PLACE = "region long, tree int, last int, band int, rep long, minima binary"
PLACE_NAMES = [f.split()[0] for f in PLACE.split(", ")]
#: Rows of a region that are compared in one task with those outside its largest component; and such pairs of one region at most, or it goes deeper.
PART, DIRECT = 4096, 1 << 24
#: task: of a row without a block, the task that saw no more of its region than two chunks hold (-1: there was more).
SEAT = f"block long, {PLACE}, component long, task int"
KEYS = stream(HASHES, 5)


def depth_for(percent: int) -> int:
    j = percent / 100
    return max([d for d in range(1, 17) if (1 - j**d) ** (HASHES // d) <= MISS], default=1)


def agreeing(percent: int) -> int:
    """Minima that must agree: five standard deviations below what is expected at the similarity."""
    j = percent / 100
    return max(1, int(HASHES * j - 5 * (HASHES * j * (1 - j)) ** 0.5))


def signature(shingles: np.ndarray) -> np.ndarray:
    """16 bits of each of the 64 minima."""
    least = np.full(HASHES, np.iinfo(np.uint64).max, U64)
    for i in range(0, len(shingles), 8192):
        np.minimum(least, (shingles[None, i : i + 8192] * KEYS[:, None]).min(1), out=least)
    return (mix(least) >> U64(48)).astype(np.uint16)


def _sign(texts: list[bytes]) -> list:
    out: list = [[], [], [], []]
    for s in shingle_sets(texts, WORDS):
        made = (len(s), int(s.sum().view(np.int64)), int(mix(s * RUN_KEYS[40]).sum().view(np.int64)), signature(s).tobytes() if len(s) else None)
        for column, x in zip(out, made, strict=True):
            column.append(x)
    return out


def inner_bands(tree: int, depth: int) -> list[np.ndarray]:
    """Places of the minima by which a region of a tree is dealt anew, some fewer at a time than the tree's own, which aren't among them."""
    inner = max(1, depth - 1)
    own = range(tree * depth, (tree + 1) * depth)
    made = [np.arange(i, i + inner) for i in range(0, HASHES - inner + 1, inner)]
    return [b for b in made if not set(b.tolist()) & set(own)]


def _key(minima: np.ndarray, *parts) -> np.ndarray:
    """Regions of rows that agree in these minima and parts; the same 16 bits make the same region, without exception."""
    total = (minima.astype(U64) * RUN_KEYS[: minima.shape[1]]).sum(1, dtype=U64)
    for i, p in enumerate(parts):
        total += np.asarray([p] if isinstance(p, int) else p, np.int64).view(U64) * RUN_KEYS[20 + i]
    return mix(total).view(np.int64)


def _order(minima: np.ndarray, first: int) -> list[bytes]:
    """Minima from a place on, wrapping round, as bytes that sort as they do."""
    return [x.tobytes() for x in np.roll(minima, -first, axis=1).astype(">u2")]


def _plant(depth: int):
    """Signatures to forest rows, one for each tree, with what sorts them within their region."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                sig = _matrix(batch.column(1))
                for t in range(HASHES // depth):
                    yield _forest(_key(sig[:, t * depth : (t + 1) * depth], t), t, -1, -1, batch.column(0), sig, t * depth)

    return run


def _forest(region: np.ndarray, tree, last, band, rep, minima: np.ndarray, first: int) -> pa.RecordBatch:
    n = len(minima)
    numbers = [pa.array(np.broadcast_to(np.asarray(x, np.int32), n)) for x in (tree, last, band)]
    columns = [pa.array(region), pa.array(_order(minima, first), pa.binary()), *numbers, rep if isinstance(rep, pa.Array) else pa.array(rep, pa.int64())]
    return pa.RecordBatch.from_arrays(columns, names=FOREST_NAMES)


FOREST = "region long, sorted binary, tree int, last int, band int, rep long"
FOREST_NAMES = [f.split()[0] for f in FOREST.split(", ")]


def _deepen(depth: int):
    """Rows of open regions (PLACE, component) to forest rows, one for each deeper place beyond the last one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            region, tree, band, rep = (batch.column(i).to_numpy() for i in (0, 1, 3, 4))
            minima = _matrix(batch.column(5))
            for t in np.unique(tree).tolist():
                for j, places in enumerate(inner_bands(t, depth)):
                    some = np.flatnonzero((tree == t) & (band < j))
                    if len(some):
                        yield _forest(_key(minima[some][:, places], region[some], j), t, band[some], j, rep[some], minima[some], int(places[0]))

    return run


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows in runs of one region; the batches are sorted by region (the first column)."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        key = batch.column(0).to_numpy()
        cut = np.flatnonzero(key[1:] != key[:-1]) + 1
        if held and held[-1].column(0)[-1].as_py() != key[0]:
            yield pa.Table.from_batches(held)
            held = []
        for a, b in zip([0, *cut.tolist()], [*cut.tolist(), len(key)], strict=True):
            part = batch.slice(a, b - a)
            if b < len(key):
                if held:
                    yield pa.Table.from_batches([*held, part])
                    held = []
                elif b - a > 1:
                    yield pa.Table.from_batches([part])
            else:
                held.append(part)
    if held:
        yield pa.Table.from_batches(held)


def candidates(minima: np.ndarray, place: tuple[int, int, int], depth: int, least: int) -> Iterator[tuple[int, np.ndarray]]:
    """For each row i, the later rows that may be near it and meet it at no earlier place. place: tree, last and present deeper place."""
    before = earlier(place, depth)
    for i in range(len(minima) - 1):
        same = minima[i + 1 :] == minima[i]
        near = np.flatnonzero(np.count_nonzero(same, axis=1) >= least)
        for places in before if len(near) else ():
            near = near[~same[near][:, places].all(1)]
        if len(near):
            yield i, near + i + 1


def _matrix(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, HASHES)


def _natural(table: pa.Table, depth: int) -> tuple[tuple[int, int, int], np.ndarray, np.ndarray]:
    """A region's place, reps, and minima in their natural order."""
    place = tuple(table.column(n)[0].as_py() for n in ("tree", "last", "band"))
    first = place[0] * depth if place[2] < 0 else int(inner_bands(place[0], depth)[place[2]][0])
    rolled = np.frombuffer(b"".join(table.column("sorted").to_pylist()), ">u2").reshape(-1, HASHES).astype(np.uint16)
    return place, table.column("rep").to_numpy(), np.roll(rolled, first, axis=1)


def _rows(block: int | None, region: int, place: tuple[int, int, int], reps: np.ndarray, minima: np.ndarray, component: np.ndarray | None = None, task: int | None = None) -> pa.RecordBatch:
    n = len(reps)
    columns = [pa.array([block] * n, pa.int64()), pa.array([region] * n, pa.int64()), *(pa.array([x] * n, pa.int32()) for x in place), pa.array(reps, pa.int64())]
    columns += [pa.array([x.tobytes() for x in minima], pa.binary()), pa.array([None] * n if component is None else component, pa.int64()), pa.array([task] * n, pa.int32())]
    return pa.RecordBatch.from_arrays(columns, names=[f.split()[0] for f in SEAT.split(", ")])


def _name(*parts: int) -> int:
    return int(mix(np.array([sum(p * int(k) for p, k in zip(parts, RUN_KEYS.tolist(), strict=False)) & (1 << 64) - 1], U64)).view(np.int64)[0])


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, pa.Table, str]]:
    """Rows sorted by region as (region, number, rows, kind): the two chunks in hand at every step of one chunk.

    kind: they are the whole region, or long, if there is more of it, or the
    edge, as a task's first and last region may go on in other tasks.
    """
    key, number, held, first = None, 0, None, True

    def step(last: bool, edge: bool) -> Iterator:
        nonlocal held, number
        while held.num_rows > 2 * CHUNK or last:
            if number and held.num_rows <= CHUNK:  # in hand before
                break
            few = last and number == 0 and held.num_rows <= 2 * CHUNK
            yield key, number, held.slice(0, 2 * CHUNK), "whole" if few and not edge else "edge" if few else "long"
            held, number = held.slice(CHUNK), number + 1
            if last and held.num_rows <= CHUNK:
                break
        if last:
            held = None

    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(0).to_numpy()
        cut = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
        for a, b in zip(cut, cut[1:], strict=False):
            if held is not None and keys[a] != key:
                yield from step(True, first)
                number, first = 0, False
            if b - a == 1 and 0 < a and b < len(keys):  # alone in its region, and none at an edge
                continue
            key = int(keys[a])
            part = pa.Table.from_batches([batch.slice(a, b - a)])
            held = part if held is None else pa.concat_tables([held, part])
            yield from step(False, first)
    if held is not None:
        yield from step(True, True)


def _seat(depth: int, least: int):
    """Sorted forest rows to the blocks in which classes are compared on full sets, and, without a block, the rows of open regions."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        for key, number, table, kind in _parts(batches):
            place, reps, minima = _natural(table, depth)
            if len(reps) > 1:
                seated = np.zeros(len(reps), bool)
                for i, near in candidates(minima, place, depth, least):
                    seated[i] = True
                    seated[near] = True
                if seated.any():
                    yield _rows(_name(key, number, int(reps[0])), key, place, reps[seated], minima[seated])
            if kind != "whole":  # what stood in the chunk before has been given with it
                own = slice(CHUNK if number else 0, None)
                yield _rows(None, key, place, reps[own], minima[own], task=-1 if kind == "long" else task)

    return run


def _seat_rest(depth: int, least: int):
    """Rows of a part of an open region, with the components so far, to blocks of what no block has compared: those outside the region's largest component (``main``) with all others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _runs(batches):
            if part.num_rows < 2:
                continue
            get = {n: part.column(n) for n in part.column_names}
            place = tuple(get[n][0].as_py() for n in ("tree", "last", "band"))
            reps, minima, component = get["rep"].to_numpy(), _matrix(get["minima"]), get["component"].to_numpy()
            before = earlier(place, depth)
            rest = np.flatnonzero(component != get["main"][0].as_py())
            for i in range(0, len(rest), CHUNK):
                for j in range(0, len(reps), CHUNK):
                    chunk = np.arange(j, min(j + CHUNK, len(reps)))
                    seated: set[int] = set()
                    for r in rest[i : i + CHUNK].tolist():
                        same = minima[chunk] == minima[r]
                        near = np.flatnonzero((np.count_nonzero(same, axis=1) >= least) & (component[chunk] != component[r]))
                        for places in before if len(near) else ():
                            near = near[~same[near][:, places].all(1)]
                        if len(near):
                            seated.add(r)
                            seated.update(chunk[near].tolist())
                    if seated:
                        at = np.array(sorted(seated))
                        yield _rows(_name(get["piece"][0].as_py(), i, j, 1), get["region"][0].as_py(), place, reps[at], minima[at], component[at])

    return run


def earlier(place: tuple[int, int, int], depth: int) -> list[np.ndarray]:
    """Minima that don't all agree in a pair that belongs to a place."""
    tree, last, band = place
    return [np.arange(t * depth, (t + 1) * depth) for t in range(tree)] + (inner_bands(tree, depth)[last + 1 : band] if band > 0 else [])


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """100 * size of the intersection >= percent * size of the union, of sorted distinct hashes."""
    if len(a) > len(b):
        a, b = b, a
    if 100 * len(a) < percent * len(b):
        return False
    at = np.searchsorted(b, a)
    both = int(np.count_nonzero(b[np.minimum(at, len(b) - 1)] == a))
    return 100 * both >= percent * (len(a) + len(b) - both)


def _verify(depth: int, least: int, percent: int):
    """Blocks with full sets to links (a, b): for each class that has one, with the least of its group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _runs(batches):
            if block.num_rows < 2:
                continue
            place, reps, minima = tuple(block.column(n)[0].as_py() for n in ("tree", "last", "band")), block.column("rep").to_pylist(), _matrix(block.column("minima"))
            sets = [np.frombuffer(x, U64) for x in block.column("shingles").to_pylist()]
            root, first = np.arange(len(reps)), {}
            for i, c in enumerate(block.column("component").to_pylist()):
                if c is not None:  # what is in one component already
                    root[i] = first.setdefault(c, i)
            for i, near in candidates(minima, place, depth, least):
                for j in near.tolist():
                    if root[i] != root[j] and similar(sets[i], sets[j], percent):
                        root[root == root[j]] = root[i]
            linked = np.flatnonzero(root != np.arange(len(reps))).tolist()
            if linked:
                yield pa.RecordBatch.from_arrays([pa.array([reps[i] for i in linked], pa.int64()), pa.array([reps[root[i]] for i in linked], pa.int64())], names=["a", "b"])

    return run


def _bit(ids: np.ndarray, bits: int) -> np.ndarray:
    return mix(ids.astype(np.int64).view(U64) + U64(1)) >> U64(64 - bits)


def wanted(ids: DataFrame) -> tuple[np.ndarray, int]:
    """A bitmap in which the bit of every id is set, and the binary logarithm of its size: eight bits for an id, 2^MAX_BITS at most.

    It only spares texts that no block needs: an id too many is dropped by the
    join that follows.  Tasks merge their words before any comes to the driver.
    """
    bits = min(MAX_BITS, max(12, (8 * ids.count()).bit_length()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.zeros((1 << bits) // 64, U64)
        for batch in batches:
            at = _bit(batch.column(0).to_numpy(), bits)
            np.bitwise_or.at(own, (at >> U64(6)).astype(np.int64), U64(1) << (at & U64(63)))
        some = np.flatnonzero(own)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(own[some].view(np.int64))], names=["word", "bits"])

    found = ids.mapInArrow(run, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros((1 << bits) // 64, U64)
    out[found["word"].to_numpy()] = found["bits"].to_numpy().view(U64)
    return out, bits


def _sets(bitmap: np.ndarray, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = _bit(batch.column(0).to_numpy(), bits)
            batch = batch.filter(pa.array(bitmap[(at >> U64(6)).astype(np.int64)] >> (at & U64(63)) & U64(1) == 1))
            texts = as_bytes(batch.column(1))
            for a, b in slices(texts):
                made = [s.tobytes() for s in shingle_sets(texts[a:b], WORDS)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(made, pa.binary())], names=["rep", "shingles"])

    return run


def near_duplicates(docs: DataFrame, percent: int = 80) -> DataFrame:
    """One row for each row of docs: doc_id, n_shingles, class_id, component_id, kept.

    Documents are linked whose sets have a Jaccard similarity of percent / 100
    or more.  class_id: the least doc_id of those with an equal set.
    component_id: the least doc_id reachable.  kept: whether that is the document.
    """
    depth, least = depth_for(percent), agreeing(percent)
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    signed = stage(map_text(docs, _sign, "n_shingles long, f1 long, f2 long, signature binary", keep=["doc_id"]), "signatures")
    full = signed.where("doc_id IS NOT NULL AND n_shingles > 0")
    classes = stage(full.groupBy("n_shingles", "f1", "f2").agg(F.min("doc_id").alias("rep")), "classes")
    own = F.when(F.col("doc_id") == F.col("rep"), F.col("signature")).alias("signature")
    members = stage(full.join(classes, ["n_shingles", "f1", "f2"]).select("doc_id", "n_shingles", "rep", own), "members")
    forest = members.where("signature IS NOT NULL").select("rep", "signature").mapInArrow(_plant(depth), FOREST)

    def seats(forest: DataFrame) -> DataFrame:
        dealt = forest.repartitionByRange("region", "sorted", "rep").sortWithinPartitions("region", "sorted", "rep")
        return stage(dealt.mapInArrow(_seat(depth, least), SEAT), "seats")

    def links(seats: DataFrame) -> DataFrame:
        texts = docs.where("doc_id IS NOT NULL").withColumnRenamed("doc_id", "rep")
        sets = texts.mapInArrow(_sets(*wanted(seats.select("rep"))), "rep long, shingles binary")
        held = ["block", "tree", "last", "band", "rep", "minima", "component", "shingles"]
        blocks = seats.join(sets, "rep").select(*held).repartition("block").sortWithinPartitions("block")
        return stage(blocks.mapInArrow(_verify(depth, least, percent), "a long, b long"), "links")

    def apart(rows: DataFrame, *more: Column) -> DataFrame:
        """Those of regions with several components (and of which more holds), with the largest component, how many rows stand outside it, and all."""
        by = rows.groupBy("region", "component").agg(F.count("*").alias("n"), *[c.alias(f"c{i}") for i, c in enumerate(more)])
        sizes = by.groupBy("region").agg(F.max_by("component", F.struct("n", "component")).alias("main"), (F.sum("n") - F.max("n")).alias("outside"), F.sum("n").alias("size"), *[F.min(f"c{i}").alias(f"c{i}") for i in range(len(more))])
        return rows.join(sizes.where("outside > 0"), "region")

    def compared_whole(rows: DataFrame) -> DataFrame:
        """Blocks of what stands outside the largest component of regions and all else there: those rows go to every part of the others."""
        parts = F.ceil(F.col("size") / PART).cast("int")
        outside = F.col("component") != F.col("main")
        part = F.when(outside, F.sequence(F.lit(0), parts - 1)).otherwise(F.array(F.pmod(F.xxhash64("rep"), parts).cast("int")))
        dealt = rows.withColumn("part", F.explode(part)).withColumn("piece", F.xxhash64("region", "part")).select("piece", *PLACE_NAMES, "component", "main")
        return stage(dealt.repartition("piece").sortWithinPartitions("piece", "rep").mapInArrow(_seat_rest(depth, least), SEAT), "rest")

    placed = seats(forest)
    linked = links(placed.where("block IS NOT NULL"))
    found = components(linked)
    for level in range(DEEPEST + 1):
        open_rows = placed.where("block IS NULL").drop("block", "component")
        labelled = open_rows.join(found, open_rows["rep"] == found["node"], "left").select(*open_rows.columns, F.coalesce("component", "rep").alias("component"))
        tasks = labelled.groupBy("region").agg(F.min("task").alias("a"), F.max("task").alias("b")).where("a < 0 OR a != b").select("region")
        left = stage(apart(labelled.drop("task").join(tasks, "region", "left_semi")), "open")
        if left.isEmpty():
            break
        few = F.lit(level == DEEPEST) | (F.col("outside") * F.col("size") <= DIRECT)
        more = compared_whole(left.where(few))
        deeper = left.where(~few).select(*PLACE_NAMES).mapInArrow(_deepen(depth), FOREST)
        placed = seats(apart(deeper.join(left.select("rep", "component").distinct(), "rep")).select(*FOREST_NAMES))
        more = more.unionByName(placed.where("block IS NOT NULL"))
        if not more.isEmpty():
            linked = stage(linked.unionByName(links(more)), "links")
            found = components(linked)
    named = members.join(found, members["rep"] == found["node"], "left").select("doc_id", "n_shingles", F.col("rep").alias("class_id"), F.coalesce("component", "rep").alias("component_id"))
    alone = signed.where("doc_id IS NULL OR n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("class_id"), F.col("doc_id").alias("component_id"))
    return named.unionByName(alone).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def keep_one(docs: DataFrame, percent: int = 80) -> DataFrame:
    """The documents with one of each component, the least doc_id; of repeated rows one stays, rows without doc_id all stay."""
    found = near_duplicates(docs, percent).where("kept AND doc_id IS NOT NULL").select("doc_id").distinct()
    kept = docs.where("doc_id IS NOT NULL").join(found, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return kept.unionByName(docs.where("doc_id IS NULL")).select(*docs.columns)
