"""Packing by power-of-two decomposition.

Each document's tokens, with the end token, are split into pieces whose lengths
are powers of two: as many of the longest length as fit, then the binary digits
of the rest, longest first.  A piece is a training sequence of its own, so that
no sequence crosses documents and none is padded; sequences of equal length form
a bucket, from which batches are drawn (``bucket`` is the binary logarithm of
the length; write with ``partitionBy("bucket")``).

Edge cases.  A null or empty text is its end token alone: one piece of length 1.
Very long texts are encoded whole; memory follows one text's length.  Repeated
rows are packed as often as they occur.  A null doc_id stays null.  An empty
table gives no rows.  Other columns are ignored.

There is no shuffle: a task tokenises its rows and numbers its sequences
(sequence_id = 2^40 * the task's partition + a running number), so a lost task
that is run again numbers them the same.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from itertools import compress
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_slices, trim

MAX_LENGTH = 4096
END_ID = 2
#: Words whose ids a worker keeps, some 200 bytes each; then it starts anew.
CACHE_WORDS = 900_000
#: Bytes of text that are looked at together, if no single text is longer.
AT_A_TIME = 8 << 20


#: Of each byte: 0 white space (the six ASCII ones), 1 a letter, 2 punctuation that may follow letters, 3 anything else.
MARKS = ".,;:!?|#*$%&"
_KIND = np.full(256, 3, np.uint8)
_KIND[list(b"\t\n\v\f\r ")] = 0
_KIND[[c for c in range(128) if chr(c).isalpha()]] = 1
_KIND[list(MARKS.encode())] = 2
_SMALL = np.frombuffer(bytes(range(256)).lower(), np.uint8)


def kinds(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """_KIND of bytes of UTF-8, with U+00C0 to U+00FF as letters but for two signs; where the second bytes of those letters are."""
    kind, second = _KIND[raw], np.flatnonzero(raw[:-1] == 0xC3) + 1
    second = second[(raw[second] != 0x97) & (raw[second] != 0xB7)]
    kind[second] = kind[second - 1] = 1
    return kind, second


def parts(texts: list[bytes]) -> tuple[pa.Array, np.ndarray]:
    """What stands between white spaces in the texts, punctuation apart that follows a letter and ends it; where each text's parts end.

    Latin letters are small ones, but not in parts that hold anything else: a
    small letter may compose otherwise, and special tokens are what they are.
    """
    raw = np.frombuffer(b" ".join([*texts, b""]), np.uint8)
    kind, second = kinds(raw)
    low = _SMALL[raw]
    low[second[raw[second] <= 0x9E]] += 0x20
    mark = kind == 2
    after = np.flatnonzero(mark[:-1] & ~mark[1:]) + 1  # runs of punctuation
    begin = np.flatnonzero((kind[:-1] == 1) & mark[1:]) + 1
    begin = begin[kind[after[np.searchsorted(after, begin, "right")]] == 0] if len(begin) else begin
    end = kind == 0
    end[begin] = True
    end = np.flatnonzero(end)
    if len(other := np.flatnonzero(kind == 3)):
        as_is = np.zeros(len(end), bool)
        as_is[np.searchsorted(end, other, "right")] = True
        as_is = np.repeat(as_is, np.diff(end, prepend=0))
        np.copyto(low[: len(as_is)], raw[: len(as_is)], where=as_is)
    space = kind[end] == 0
    to = end - (np.cumsum(space) - space)  # without white space
    some = np.diff(to, prepend=0) > 0
    offsets = np.concatenate([[0], to[some]])
    found = pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(low[kind != 0])])
    return found, np.searchsorted(end[some], np.cumsum([len(t) + 1 for t in texts]))


class Words:
    """Token ids of texts by a tokenizer that drops white space, makes letters small and splits them from the rest.

    Such a tokenizer encodes what stands between two ASCII white spaces alike
    wherever it stands, and so letters and the punctuation that ends them; each
    distinct string (see parts) is encoded once and kept.  Strings of letters
    are encoded many at a time.
    """

    #: Strings of letters that are encoded as one text, and such texts at a time.
    AT_ONCE, TEXTS = 500, 16

    def __init__(self, path: str):
        import os

        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.bare = self._bare()
        self.forget()

    def forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.learned = pa.array([], pa.large_binary())

    def _bare(self):
        """The same model without steps that leave small composed letters as they are; the whole tokenizer if it has others."""
        from tokenizers import Tokenizer
        from tokenizers import pre_tokenizers as pre

        made = json.loads(self.tokenizer.to_str())
        listed = lambda x, inner: [y["type"] for y in (x or {}).get(inner, [x] if x else [])]
        if not set(listed(made["normalizer"], "normalizers")) <= {"NFC", "Replace", "Lowercase"} or listed(made["pre_tokenizer"], "pretokenizers") != ["Split", "ByteLevel"]:
            return self.tokenizer
        bare = Tokenizer(self.tokenizer.model)
        bare.pre_tokenizer = pre.Sequence([pre.WhitespaceSplit(), pre.ByteLevel(add_prefix_space=False, use_regex=False)])
        return bare

    def __call__(self, texts: list[bytes]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        ids, ends = self.ids(texts)
        return [x.tobytes() for x in np.split(ids, ends[:-1])]

    def ids(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after another, and where each text's end."""
        found, ends = parts(texts)
        if not len(found):
            return np.empty(0, "<u4"), ends
        coded = found.dictionary_encode()
        words = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(coded.dictionary)], pa.int32()), coded.dictionary), pa.scalar(b" ", pa.large_binary()))[0].as_py().split(b" ")
        made = list(map(self.known.get, words))
        if new := [w for w, x in zip(words, made, strict=True) if x is None]:
            if len(self.known) + len(new) > CACHE_WORDS:
                self.forget()
                new = words
            self.learn(new)
            made = list(map(self.known.__getitem__, words))
        taken = self.learned.take(pa.array(made, pa.int64()).take(coded.indices))
        at = np.frombuffer(taken.buffers()[1], np.int64, len(taken) + 1) // 4
        return np.frombuffer(taken.buffers()[2] or b"", "<u4", at[-1]), at[ends]

    def alone(self, word: str) -> bytes:
        return np.array(self.tokenizer.encode(word, add_special_tokens=False).ids, "<u4").tobytes()

    def small(self, text: str) -> tuple[str, str] | None:
        """Small composed letters and the punctuation that follows them, if a string is no more than that."""
        if text.isascii() and text.isalpha():
            return text.lower(), ""
        letters = text.rstrip(MARKS)
        low = letters.lower()
        if letters.isalpha() and (low.isascii() or (low.isalpha() and len(low) == len(letters) and "\u03a3" not in letters and is_normalized("NFC", low))):
            return low, text[len(letters) :]
        return None

    def learn(self, new: list[bytes]) -> None:
        """new: parts() of texts."""
        raw = np.frombuffer(b" ".join([*new, b""]), np.uint8)
        kind, _ = kinds(raw)
        plain = np.ones(len(new), bool)  # small letters
        plain[np.searchsorted(np.flatnonzero(kind == 0), np.flatnonzero(kind > 1))] = False
        letters, others = list(compress(new, plain)), list(compress(new, ~plain))
        split = [self.small(t.decode()) for t in others]
        more = list({p[0] for p in split if p})
        coded = self.encoded([*b" ".join(letters).decode().split(), *more])
        known = dict(zip(more, coded[len(letters) :].to_pylist(), strict=True))
        made = [known[p[0]] + self.alone(p[1]) if p else self.alone(t.decode()) for t, p in zip(others, split, strict=True)]
        self.known.update(zip([*letters, *others], range(len(self.known), len(self.known) + len(new)), strict=True))
        self.learned = pa.concat_arrays([self.learned, coded[: len(letters)], pa.array(made, pa.large_binary())])

    def encoded(self, letters: list[str]) -> pa.Array:
        """Ids of strings of small composed letters."""
        ids, sizes = [np.empty(0, "<u4")], [np.zeros(1, np.int64)]
        groups = [letters[i : i + self.AT_ONCE] for i in range(0, len(letters), self.AT_ONCE)]
        for i in range(0, len(groups), self.TEXTS):
            few = groups[i : i + self.TEXTS]
            for some, made in zip(few, self.bare.encode_batch([" ".join(g) for g in few], add_special_tokens=False), strict=True):
                first = np.flatnonzero(np.diff(np.array(made.word_ids, np.int64), prepend=-1))
                if len(first) == len(some):
                    ids.append(np.array(made.ids, "<u4"))
                    sizes.append(np.diff(first, append=len(made.ids)))
                else:  # a word that normalisation cuts
                    each = [np.frombuffer(self.alone(w), "<u4") for w in some]
                    ids += each
                    sizes.append(np.array([len(x) for x in each]))
        at, raw = 4 * np.cumsum(np.concatenate(sizes)), np.concatenate(ids)
        return pa.Array.from_buffers(pa.large_binary(), len(letters), [None, pa.py_buffer(at), pa.py_buffer(raw)])


def pieces(n: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Lengths of the pieces of texts of n tokens, text by text, and how many each has: powers of two, longest first."""
    whole, rest = np.divmod(n, most)
    bits = range(most.bit_length() - 2, -1, -1)
    times = np.stack([whole, *(rest >> k & 1 for k in bits)], axis=1)
    return np.repeat(np.tile(np.array([most, *(1 << k for k in bits)]), len(n)), times.ravel()), times.sum(axis=1)


def lengths(n: int, most: int = MAX_LENGTH) -> list[int]:
    """pieces() of one text."""
    return pieces(np.array([n]), most)[0].tolist()


def pack(docs: DataFrame, tokenizer_path: str, max_length: int = MAX_LENGTH, end_id: int = END_ID) -> DataFrame:
    """One row for each piece: doc_id, start, length, bucket, tokens (binary, little-endian unsigned 32-bit ids), doc_tokens, sequence_id, offset.

    max_length: a power of two.  tokenizer_path: a file of the ``tokenizers``
    library, of a kind that drops white space and splits letters from other characters.
    """
    if max_length < 1 or max_length & (max_length - 1):
        raise ValueError("max_length must be a power of two")
    names = ["doc_id", "start", "length", "bucket", "tokens", "doc_tokens", "sequence_id", "offset"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trim()
        words, number = Words(tokenizer_path), TaskContext.get().partitionId() << 40
        for part, texts in text_slices(batches, 1, AT_A_TIME):
            ids, ends = words.ids(texts)
            ids, n = np.insert(ids, ends, end_id), np.diff(ends, prepend=0) + 1
            size, times = pieces(n, max_length)
            to, doc = np.cumsum(size), np.repeat(np.arange(len(n)), times)
            columns = [
                part.column(0).take(pa.array(doc)), to - size - (np.cumsum(n) - n)[doc], size, np.log2(size).astype(np.int32),
                pa.Array.from_buffers(pa.binary(), len(size), [None, pa.array(np.concatenate([[0], 4 * to])).cast(pa.int32()).buffers()[1], pa.py_buffer(ids)]),
                n[doc], number + np.arange(len(size)), np.zeros(len(size), np.int64),
            ]
            yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], names=names)
            number += len(size)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, start long, length long, bucket int, tokens binary, doc_tokens long, sequence_id long, offset long"
    )


def digest(pieces: DataFrame) -> DataFrame:
    """The pieces with a checksum in place of their tokens."""
    return pieces.select("doc_id", "start", "length", F.crc32("tokens").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "bucket")
