"""Near duplicates, repeated spans and benchmark overlaps, against brute force."""

import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridloom.llm import components, decontamination, lsh_forest, substrings
from gridloom.llm.queries import OP10_SQL, op5_decontamination, op6_substrings, op10_lsh_forest

from ..conftest import DATA, agrees
from .helpers import CLASHES, documents, empty

rng = np.random.default_rng(5)
VOCABULARY = np.array([f"w{i}x" for i in range(3000)])


def words(n):
    return rng.choice(VOCABULARY, n).tolist()


# ---- components


def test_components(spark):
    n = 300
    links = [(i, i + 1) for i in range(0, 100)] + [(200, 150), (150, 250), (7, 7), (250, 150), (299, 298)] + [(None, 3)]
    parent = list(range(n))
    for _ in range(n):
        for a, b in links:
            if a is not None:
                parent[a] = parent[b] = min(parent[a], parent[b])
    got = dict(components.components(spark.createDataFrame(links, "a long, b long")).collect())
    assert got == {i: p for i, p in enumerate(parent) if p != i}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


# ---- near duplicates


def brute_components(texts, percent):
    sets = []
    for t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    label = list(range(len(texts)))
    links = [(i, j) for i in range(len(texts)) for j in range(i) if sets[i] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])]
    for _ in links:
        before = list(label)
        for i, j in links:
            label[i] = label[j] = min(label[i], label[j])
        if label == before:
            break
    return [(i, len(s), label[i]) for i, s in enumerate(sets)]


def near_copies():
    out = []
    for _ in range(25):
        base = words(int(rng.integers(40, 200)))
        for _ in range(int(rng.integers(1, 6))):
            copy = list(base)
            for k in rng.choice(len(base), int(rng.integers(0, 1 + len(base) // 40)), replace=False):
                copy[k] = str(rng.choice(VOCABULARY))
            out.append(" ".join(copy))
    one = words(120)  # a large group of near copies
    for i in range(60):
        out.append(" ".join([*one[:i], f"odd{i}", *one[i + 1 :]]))
    return [*out, "", None, "Short Text", "short text", "four words are here", " \n\t", "É é", *out[:5], out[0].upper()]


@pytest.mark.parametrize("percent", [85, 80])
def test_forest_against_brute_force(spark, percent):
    texts = near_copies()
    rows = lsh_forest.near_duplicates(documents(spark, texts, CLASHES), percent).orderBy("doc_id").collect()
    assert [(r.doc_id, r.n_shingles, r.component_id) for r in rows] == brute_components(texts, percent)
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)


def test_large_regions_are_compared_in_blocks(spark, monkeypatch):
    texts = near_copies()
    monkeypatch.setattr(lsh_forest, "CHUNK", 4)
    rows = lsh_forest.near_duplicates(documents(spark, texts), 85).orderBy("doc_id").collect()
    assert [(r.doc_id, r.n_shingles, r.component_id) for r in rows] == brute_components(texts, 85)


@pytest.mark.parametrize(("deepest", "direct"), [(0, 0), (1, 0), (3, 0), (3, 400), (3, 1 << 24)])
def test_open_regions_go_deeper(spark, monkeypatch, deepest, direct):
    """Texts of one template, of which each differs, with pairs of near copies among them: regions are large and hold many components."""
    monkeypatch.setattr(lsh_forest, "CHUNK", 4)
    monkeypatch.setattr(lsh_forest, "DEEPEST", deepest)
    monkeypatch.setattr(lsh_forest, "DIRECT", direct)
    monkeypatch.setattr(lsh_forest, "PART", 16)
    template, texts = words(60), []
    for _ in range(60):
        own = [*template, *words(45)]
        texts += [" ".join(own), " ".join([*own[:-1], "odd"])] if rng.random() < 0.5 else [" ".join(own)]
    rows = lsh_forest.near_duplicates(documents(spark, texts), 85).orderBy("doc_id").collect()
    assert [(r.doc_id, r.n_shingles, r.component_id) for r in rows] == brute_components(texts, 85)


def test_forest_edges(spark):
    assert lsh_forest.near_duplicates(empty(spark), 85).count() == 0
    docs = documents(spark, ["a b c d e f g", "a b c d e f g", "other text"])
    some = docs.unionByName(docs.where("doc_id = 1")).unionByName(docs.where("doc_id = 2").withColumn("doc_id", F.lit(None).cast("long")))
    got = sorted((str(r.doc_id), r.component_id, r.kept) for r in lsh_forest.near_duplicates(some, 85).collect())
    assert got == [("0", 0, True), ("1", 0, False), ("1", 0, False), ("2", 2, True), ("None", None, True)]
    kept = lsh_forest.keep_one(some.unionByName(docs.where("doc_id = 0")))
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["0", "2", "None"] and kept.columns == docs.columns


def test_depth_keeps_the_promise():
    for percent in (80, 85, 95):
        d = lsh_forest.depth_for(percent)
        assert (1 - (percent / 100) ** d) ** (64 // d) <= lsh_forest.MISS


def test_forest_query(spark, duck):
    agrees(spark, duck, op10_lsh_forest, OP10_SQL)


# ---- repeated spans


def brute_spans(texts):
    from gridloom.llm.kernels import NOT_ALNUM
    from gridloom.llm.kernels import words as hashed

    first, found = {}, {}
    for d, t in enumerate(texts):
        t = t or ""
        tokens = [(m[0].lower(), m.start(), m.end()) for m in re.finditer(r"[a-z0-9\x80-\U0010ffff]+", t, re.I | re.A)]
        units, own = [], []
        for i, (w, a, _) in enumerate(tokens):
            if i and (re.search(r"[.!?\n]", t[tokens[i - 1][2] : a]) or hashed([tokens[i - 1][0].encode()], NOT_ALNUM)[0][0] % np.uint64(substrings.CUT) == 0 or len(own) == substrings.LONGEST):
                units.append(own)
                own = []
            own.append(i)
        units += [own] if own else []
        for i in range(len(units)):
            for j in range(i + substrings.SEVERAL - 1, len(units)):
                if sum(map(len, units[i : j + 1])) >= substrings.LEAST:
                    span = [k for u in units[i : j + 1] for k in u]
                    key = tuple(tokens[k][0] for k in span)
                    if key in first:
                        found.setdefault(d, set()).update(range(tokens[span[0]][1], tokens[span[-1]][2]))
                    first.setdefault(key, d)
                    break
    out = {}
    for d, chars in found.items():
        spans = []
        for c in sorted(chars):
            if spans and spans[-1][1] == c:
                spans[-1][1] = c + 1
            else:
                spans.append([c, c + 1])
        out[d] = spans
    return out


def test_spans_against_brute_force(spark):
    passage = ". ".join(" ".join(words(7)) for _ in range(12))
    texts = [" ".join(words(30)) + ". " + " ".join(words(9)) + "!" for _ in range(8)]
    texts += [f"{texts[0]} {passage} {texts[1]}", f"Ünïcode é {texts[2]}\n{passage.upper()}\n{texts[3]}", f"{passage}\n{passage}", "word " * 300, "", None, "Short. Text.", texts[1]]
    docs = documents(spark, texts, CLASHES)
    rows = substrings.repeated_spans(docs).collect()
    got = {r.doc_id: [[s.start, s.end] for s in r.spans] for r in rows}
    assert got == brute_spans(texts)
    assert {9, 10, 11, 15} <= set(got) and 8 in got and 0 not in got
    cleaned = {r.doc_id: r.text for r in substrings.remove_spans(docs, substrings.repeated_spans(docs)).collect()}
    for d, t in enumerate(texts):
        wanted = t if d not in got else "".join(c for i, c in enumerate(t) if not any(a <= i < b for a, b in got[d]))
        assert cleaned[d] == wanted


def test_spans_query_against_brute_force(spark, duck):
    texts = [t for _, t in duck.execute("SELECT doc_id, text FROM documents ORDER BY doc_id").fetchall()]
    got = {r.doc_id: r.removed_spans for r in op6_substrings(spark, DATA).collect()}
    assert got == {d: ",".join(f"{a}:{b}" for a, b in s) for d, s in brute_spans(texts).items()}


def test_spans_edges(spark):
    assert substrings.repeated_spans(empty(spark)).count() == 0
    docs = documents(spark, ["one two three four five six seven eight. nine ten eleven twelve thirteen fourteen fifteen sixteen."])
    assert substrings.repeated_spans(docs.unionByName(docs)).count() == 0  # one document, twice


def test_passages_of_51_words_without_punctuation_go_whole(spark):
    passages = [" ".join(words(51)) for _ in range(60)] + [" ".join(words(5) * 11)]
    texts = [" ".join([*words(int(rng.integers(0, 80))), p, *words(int(rng.integers(0, 80)))]) for p in passages * 2]
    rows = substrings.repeated_spans(documents(spark, texts)).collect()
    covered = {r.doc_id: {c for s in r.spans for c in range(s.start, s.end)} for r in rows}
    for d in range(len(passages), len(texts)):
        at = texts[d].index(passages[d - len(passages)])
        assert set(range(at, at + len(passages[d - len(passages)]))) <= covered[d]


# ---- benchmark overlaps


def test_overlaps(spark):
    item = words(40)
    changed = list(item)
    for k in (3, 9, 14, 22, 27, 33):
        changed[k] = "zzz"
    half = item[:25]
    texts = [
        " ".join(words(30) + item + words(30)), "Préambule. " + " ".join(x.upper() for x in changed) + ".", " ".join(words(10) + half + words(10)), " ".join(words(200)),
        " ".join(words(20) + item[:8] + words(20)), "", None, "alpha beta gamma", " ".join(words(50_000) + item),
    ]
    benchmark = spark.createDataFrame([(1, " ".join(item)), (2, "Alpha, beta gamma"), (3, None), (None, "x"), (4, "")], "item_id long, text string")
    docs = documents(spark, texts, CLASHES)
    rows = decontamination.contaminated(docs, benchmark).collect()
    assert sorted((r.doc_id, r.item_id) for r in rows) == [(0, 1), (1, 1), (2, 1), (7, 2), (8, 1)]
    by = {(r.doc_id, r.item_id): r for r in rows}
    assert texts[0].split()[by[0, 1].first_word : by[0, 1].end_word] == item and by[0, 1].n_matched == by[0, 1].n_words == 40
    assert by[1, 1].n_matched == 34 and (by[1, 1].first_word, by[1, 1].end_word) == (1, 41)
    left = decontamination.clean(docs, benchmark)
    assert sorted(r.doc_id for r in left.collect()) == [3, 4, 5, 6] and left.columns == docs.columns


def test_a_full_filter_loses_nothing(spark, monkeypatch):
    items = [words(20) for _ in range(30)]
    docs = documents(spark, [" ".join(i) for i in items])
    benchmark = spark.createDataFrame([(k, " ".join(i)) for k, i in enumerate(items)], "item_id long, text string")
    monkeypatch.setattr(decontamination, "BITS", 6)
    monkeypatch.setattr(decontamination, "MOST_BROADCAST", 0)
    assert sorted((r.doc_id, r.item_id) for r in decontamination.contaminated(docs, benchmark).collect()) == [(k, k) for k in range(30)]
    assert decontamination.clean(docs, benchmark).count() == 0


def test_repeats_do_not_multiply(spark):
    """An item of one word, 500 times, against a document of that word, 100,000 times: few surroundings differ."""
    key, place, around = decontamination.placed(decontamination._words([b"a " * 100_000])[0], None, False)
    assert len(key) < 500
    benchmark = spark.createDataFrame([(1, "a " * 500)], "item_id long, text string")
    began = time.time()
    rows = decontamination.contaminated(documents(spark, ["a " * 100_000, "b " * 100_000]), benchmark).collect()
    assert [(r.doc_id, r.item_id) for r in rows] == [(0, 1)] and time.time() - began < 60


def test_overlaps_are_as_long_as_they_are(spark):
    """A long item, copied whole, with words replaced, and in two parts at two shifts: spans and agreeing words as laid over by hand."""
    item = [f"k{i}q" for i in range(300)]
    replaced = [w if i % 11 else f"z{i}" for i, w in enumerate(item)]
    texts = [["lead", *item, "tail"], [*replaced], [*item[:100], *["gap"] * 7, *item[100:]], item[40:58] + ["odd"] * 50]
    rows = {r.doc_id: r for r in decontamination.contaminated(documents(spark, [" ".join(t) for t in texts]), spark.createDataFrame([(9, " ".join(item))], "item_id long, text string")).collect()}
    got = {k: (r.first_word, r.end_word, r.n_matched, r.n_words) for k, r in rows.items()}
    assert got == {0: (1, 301, 300, 300), 1: (1, 300, sum(i % 11 > 0 for i in range(300)), 300), 2: (107, 307, 200, 300), 3: (0, 18, 18, 300)}


def test_overlap_edges(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    docs = documents(spark, ["a b c"])
    assert decontamination.contaminated(docs, none).count() == 0 and decontamination.clean(docs, none).count() == 1
    some = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    assert decontamination.contaminated(empty(spark), some).count() == 0
    assert decontamination.contaminated(docs.unionByName(docs), some).count() == 2


def test_overlap_query_against_brute_force(spark, duck):
    def tokens(t):
        return re.findall(r"[a-z0-9\x80-\U0010ffff]+", (t or "").lower())

    docs = [(i, tokens(t)) for i, t in duck.execute("SELECT doc_id, text FROM documents").fetchall()]
    items = [(i, tokens(t)) for i, t in duck.execute("SELECT item_id, text FROM benchmark").fetchall()]
    wanted = set()
    for d, w in docs:
        at: dict = {}
        for p, x in enumerate(w):
            at.setdefault(x, []).append(p)
        for i, b in items:
            size = min(20, len(b))
            need = len(b) if len(b) < 8 else -(-80 * size // 100)
            same: dict = {}
            for k, x in enumerate(b):
                for p in at.get(x, ()):
                    same.setdefault(p - k, set()).add(k)
            if any(sum(k in s for k in range(a, a + size)) >= need for s in same.values() if len(s) >= need for a in range(len(b) - size + 1)):
                wanted.add((d, i))
    assert {(r.doc_id, r.item_id) for r in op5_decontamination(spark, DATA).collect()} == wanted


def test_rows_share_a_region_just_if_their_minima_agree():
    import pyarrow as pa

    sig = rng.integers(0, 3, (200, 64)).astype(np.uint16)
    batch = pa.RecordBatch.from_arrays([pa.array(range(200), pa.int64()), pa.array([x.tobytes() for x in sig], pa.binary())], names=["rep", "signature"])
    seen = set()
    for depth in (3, 4):
        for t, made in enumerate(lsh_forest._plant(depth)(iter([batch]))):
            region = made.column(0).to_pylist()
            part = [x.tobytes() for x in sig[:, t * depth : (t + 1) * depth]]
            assert len(set(region)) == len(set(part)) == len(set(zip(region, part, strict=True)))
            assert np.array_equal(lsh_forest._natural(pa.Table.from_batches([made]), depth)[2], sig)
            seen |= {(depth, r) for r in region}
            assert len(seen) >= len(set(region))


def test_deeper_places_leave_the_tree_out():
    for depth in (1, 2, 3, 4, 5):
        for tree in range(64 // depth):
            bands = lsh_forest.inner_bands(tree, depth)
            places = np.concatenate(bands)
            assert len(set(places.tolist())) == len(places) and not set(places.tolist()) & set(range(tree * depth, (tree + 1) * depth))


def test_letters_of_other_lengths_leave_the_rest_in_small_letters(spark):
    item = [f"é{w}" for w in words(20)]
    text = "İ ẞ \u212a Ⱥ " + " ".join(item).upper()
    benchmark = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    rows = decontamination.contaminated(documents(spark, [text]), benchmark).collect()
    assert [(r.first_word, r.end_word, r.n_matched) for r in rows] == [(4, 24, 20)]
    spans = substrings.repeated_spans(documents(spark, [" ".join(item), text])).collect()
    assert [[text[s.start : s.end] for s in r.spans] for r in spans] == [[" ".join(item).upper()]]


@pytest.mark.parametrize(("bits", "gathered", "at_once"), [(11, 64, 300), (28, 1, 1), (13, 1 << 21, 1 << 20)])
def test_spans_do_not_depend_on_the_map_or_on_what_is_sent_at_once(spark, monkeypatch, bits, gathered, at_once):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text")
    wanted = {r.doc_id: r.spans for r in substrings.repeated_spans(docs).collect()}
    for name, value in (("BITS", bits), ("GATHERED", gathered), ("AT_ONCE", at_once)):
        monkeypatch.setattr(substrings, name, value)
    assert {r.doc_id: r.spans for r in substrings.repeated_spans(docs).collect()} == wanted and wanted


@pytest.mark.parametrize("buckets", [8, 11])
def test_shortened_hashes_meet_by_bucket(buckets):
    import pyarrow as pa

    rng = np.random.default_rng(5)
    key = rng.integers(0, 1 << 64, 4000, np.uint64)
    sent = [substrings._bucketed([key[:3000], key[:10], key[:10]], buckets), substrings._bucketed([key[2900:]], buckets)]
    rows = pa.Table.from_batches(sent).to_pydict()
    bits, size = 18, (1 << 18 - buckets) // 8
    made = np.zeros(size << buckets, np.uint8)
    for bucket in set(rows["bucket"]):
        held = [n for b, n in zip(rows["bucket"], rows["numbers"]) if b == bucket]
        part = substrings._met(bits - buckets)(pa.table({"bucket": pa.array([bucket] * len(held), pa.int32()), "numbers": pa.array(held, pa.binary())}))
        made[bucket * size : (bucket + 1) * size] = np.frombuffer(part["bits"][0].as_py(), np.uint8)
    assert sum(len(n) for n in rows["numbers"]) == 4 * (3000 + 10 + 1100)  # of equal ones two at most
    both = np.concatenate([key[:10], key[2900:3000]])
    assert substrings._marked(both, made).all()
    assert np.unpackbits(made).sum() == len(np.unique(both >> np.uint64(64 - bits)))


def test_least_length_is_a_parameter(spark):
    footer = "Follow us here every day. Sign up for our letter. Thank you."
    docs = documents(spark, [f"{' '.join(words(20))}. {footer} {' '.join(words(20))}" for _ in range(3)])
    rows = {r.doc_id: r.spans for r in substrings.repeated_spans(docs, 12).collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert {d: [texts[d][s.start : s.end] for s in spans] for d, spans in rows.items()} == dict.fromkeys((1, 2), [footer[:-1]])
    assert substrings.repeated_spans(docs).count() == 0


@pytest.mark.parametrize("sizes", [[1], [3, 9, 8, 1], [8], [9], [16], [17], [4, 4, 30, 5, 8], [1, 1, 1]])
def test_windows_hold_every_neighbouring_chunk(monkeypatch, sizes):
    import pyarrow as pa

    monkeypatch.setattr(lsh_forest, "CHUNK", 4)
    keys = np.repeat(np.arange(len(sizes)), sizes)
    rows = pa.RecordBatch.from_arrays([pa.array(keys), pa.array(range(len(keys)))], names=["region", "n"])
    for cut in (1, 3, 100):
        seen: dict = {}
        for key, number, table, kind in lsh_forest._parts(iter([rows.slice(i, cut) for i in range(0, len(keys), cut)])):
            assert set(table.column("region").to_pylist()) == {key} and table.num_rows <= 8
            seen.setdefault(key, []).append((number, table.column("n").to_pylist(), kind))
        for key, size in enumerate(sizes):
            own = np.flatnonzero(keys == key).tolist()
            edge = key in (0, len(sizes) - 1)
            if size == 1 and not edge and key not in seen:  # has no neighbour
                continue
            assert {k for _, _, k in seen[key]} == ({"long"} if size > 8 else {"edge"} if edge else {"whole"})
            together = {(a, b) for _, held, _ in seen[key] for a in held for b in held}
            assert {(a, b) for i, a in enumerate(own) for j, b in enumerate(own) if i // 4 - j // 4 in (-1, 0, 1)} <= together
            assert sum((held[4:] if number else held for number, held, _ in seen[key]), []) == own
