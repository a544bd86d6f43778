import numpy as np
import pytest
from tokenizers import Tokenizer

from gridloom.llm import packing
from gridloom.llm.queries import op1_pack, tokenizer_path

from ..conftest import DATA
from .helpers import CLASHES, documents, empty

ODD = ["", None, "Ångström Å é İstanbul ΣΑΣ ǅ ﬁn ﬀ x's don't 12.5 a<|endoftext|>b  y 中文 한국 ª º ② ½ ' ''s\x0bq\x1cz ​", "The the THE, the. the!! the###", "é é", "x" * 50_000]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(tokenizer_path())


def test_words_give_the_tokenizers_ids(tokenizer, duck):
    texts = [t or "" for t in ODD] + [r[0] or "" for r in duck.execute("SELECT text FROM documents").fetchall()]
    words = packing.Words(tokenizer_path())
    for _ in range(2):  # the second time everything is known
        for text, made in zip(texts, words([t.encode() for t in texts]), strict=True):
            assert np.frombuffer(made, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_a_full_cache_starts_anew(tokenizer, monkeypatch):
    monkeypatch.setattr(packing, "CACHE_WORDS", 5)
    words = packing.Words(tokenizer_path())
    for text in ("a b c d e", "a f g h", "a b c d e f g h i"):
        assert np.frombuffer(words([text.encode()])[0], "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize(("n", "most", "wanted"), [(1, 4096, [1]), (13, 8, [8, 4, 1]), (8192, 4096, [4096, 4096]), (4097, 4096, [4096, 1]), (0, 8, [])])
def test_lengths(n, most, wanted):
    assert packing.lengths(n, most) == wanted


def test_pieces_are_whole_documents(spark, tokenizer):
    docs = documents(spark, ODD, CLASHES)
    rows = packing.pack(docs, tokenizer_path(), 1024).orderBy("doc_id", "start").collect()
    by_doc: dict = {}
    for r in rows:
        assert r.length & (r.length - 1) == 0 and r.length <= 1024 and 1 << r.bucket == r.length and r.offset == 0 and len(r.tokens) == 4 * r.length
        assert r.start == sum(len(x) for x in by_doc.setdefault(r.doc_id, []))
        by_doc[r.doc_id].append(np.frombuffer(r.tokens, "<u4").tolist())
    assert len({r.sequence_id for r in rows}) == len(rows)
    for i, text in enumerate(ODD):
        assert sum(by_doc[i], []) == [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]


def test_empty_table_and_bad_length(spark):
    assert packing.pack(empty(spark), tokenizer_path()).count() == 0
    with pytest.raises(ValueError):
        packing.pack(empty(spark), tokenizer_path(), 1000)


def test_query_against_brute_force(spark, tokenizer, duck):
    import zlib

    rows = op1_pack(spark, DATA).collect()
    ids = {i: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 2] for i, t in duck.execute("SELECT doc_id, text FROM documents").fetchall()}
    for r in rows:
        assert r.ids_crc32 == zlib.crc32(np.array(ids[r.doc_id][r.start : r.start + r.length], "<u4").tobytes()) and r.doc_tokens == len(ids[r.doc_id])
    assert sum(r.length for r in rows) == sum(map(len, ids.values()))


def test_words_are_learned_in_several_texts_at_a_time(monkeypatch):
    """Groups that aren't full, and one with a word that normalisation cuts, among others."""
    monkeypatch.setattr(packing.Words, "AT_ONCE", 7)
    monkeypatch.setattr(packing.Words, "TEXTS", 3)
    words = packing.Words(tokenizer_path())
    texts = [" ".join(f"{chr(97 + i % 26)}{chr(97 + i // 26)}Word{'é' * (i % 3)}{',' * (i % 2)}" for i in range(100)), "ASCII Ünïcode É ﬁne x1 a.b", ""]
    assert words([t.encode() for t in texts]) == [b"".join(words.alone(w) for w in t.split()) for t in texts]


def test_new_letters_are_not_looked_at_one_by_one(monkeypatch):
    """Letters, with or without punctuation behind them, are cut, made small and encoded many at a time, and once in whatever form they come."""
    words = packing.Words(tokenizer_path())
    alone, looked = words.alone, []
    monkeypatch.setattr(words, "small", lambda t: looked.append(t) or packing.Words.small(words, t))
    text = "Word wORD, été ÉTÉ; Straße straße. word### Ñandú \u00d7 a\u00d7, a|b <|ENDOFTEXT|> <|endoftext|>, H\u0331, \u00e9\u0301. x1, »,"
    assert words([text.encode(), b"", b" \n", b"word"]) == [b"".join(map(alone, text.split())), b"", b"", alone("word")]
    assert set(looked) == {",", ";", ".", "###", "\u00d7", "a\u00d7,", "a|b", "<|ENDOFTEXT|>", "<|endoftext|>,", "H\u0331,", "\u00e9\u0301.", "x1,", "»,"}
    assert {k.decode() for k in words.known} - set(looked) == {"word", "été", "straße", "ñandú"}


@pytest.mark.parametrize("most", [1, 8, 4096])
def test_pieces_of_many_texts(most):
    n = [1, 7, 8, 4097, 9000, 13]
    size, times = packing.pieces(np.array(n), most)
    assert [x.tolist() for x in np.split(size, np.cumsum(times)[:-1])] == [packing.lengths(x, most) for x in n]
    assert [sum(packing.lengths(x, most)) for x in n] == n
