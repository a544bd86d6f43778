"""Vectorised text kernels that the operators share: words, their hashes, shingles, n-grams.

All of them take a list of UTF-8 byte strings (a null text is given as ``b""``)
and work on whole texts.  Temporary arrays are bounded by ``CHUNK`` bytes of
text, however long a single text is.
"""

from __future__ import annotations

import re
from functools import cache

import numpy as np

CHUNK = 1 << 21
U64 = np.uint64

#: ASCII white space, the separators of ``[^\x20\x09-\x0D]+``.
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
#: Separators of alphanumeric tokens: every ASCII byte that is no letter or digit.
NOT_ALNUM = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
#: ASCII lower-casing of bytes.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


@cache
def _plain_runs() -> re.Pattern:
    """Runs of characters whose small letter has as many bytes of UTF-8. No letter beyond the range has a small one."""
    odd = [c for c in map(chr, [*range(0x80, 0xD800), *range(0xE000, 0x1F000)]) if len(c.lower().encode()) != len(c.encode())]
    return re.compile("[^" + "".join(map(re.escape, odd)) + "]+")


def lower_in_place(text: bytes) -> bytes:
    """Small letters, but for characters whose length would change, so that a place stays a place; ASCII texts as they are."""
    return text if text.isascii() else _plain_runs().sub(lambda m: m[0].lower(), text.decode()).encode()


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (in place): every input bit reaches every output bit."""
    h ^= h >> U64(32)
    h *= U64(0xD6E8FEB86659FD93)
    h ^= h >> U64(32)
    h *= U64(0xD6E8FEB86659FD93)
    h ^= h >> U64(32)
    return h


def stream(n: int, seed: int) -> np.ndarray:
    """n fixed pseudo-random odd 64-bit numbers."""
    with np.errstate(over="ignore"):
        return mix((np.arange(1, n + 1, dtype=U64) + U64(seed << 32)) * U64(0x9E3779B97F4A7C15)) | U64(1)


BYTE_KEYS = stream(256, 1)
POSITION_KEYS = stream(64, 2)
RUN_KEYS = stream(64, 3)


def _bounds(buf: np.ndarray, sep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends (exclusive) of the runs of bytes that are no separators."""
    edge = np.empty(len(buf) + 2, bool)
    edge[0] = edge[-1] = False
    np.logical_not(sep[buf], out=edge[1:-1])
    at = np.flatnonzero(edge[1:] != edge[:-1])
    return at[::2], at[1::2]


def _run_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool) -> np.ndarray:
    """One 64-bit hash for each run of bytes."""
    if not len(starts):
        return np.empty(0, U64)
    lengths = ends - starts
    first = np.cumsum(lengths) - lengths
    within = np.arange(int(lengths.sum()), dtype=np.int64) - np.repeat(first, lengths)
    data = buf[within + np.repeat(starts, lengths)]
    if lower:
        data = LOWER[data]
    keys = POSITION_KEYS[within & 63]
    if (lengths > 64).any():
        keys = keys * (2 * (within >> 6).astype(U64) + U64(1))
    h = np.add.reduceat(BYTE_KEYS[data] * keys, first)
    h += lengths.astype(U64)
    return mix(h)


def words(texts: list[bytes], sep: np.ndarray = SPACE, lower: bool = False, places: bool = False):
    """Hashes of all words in order, and the number of words before each text and in all.

    With ``places``, also each word's start and end, in bytes of its own text.
    """
    hashes, counts, starts_out, ends_out = [], np.zeros(len(texts) + 1, np.int64), [], []
    i = 0
    while i < len(texts):
        if len(texts[i]) > CHUNK:
            h, s, e = _long(texts[i], sep, lower)
            hashes.append(h)
            starts_out.append(s)
            ends_out.append(e)
            counts[i + 1] = len(h)
            i += 1
            continue
        j, size = i, 0
        while j < len(texts) and size + len(texts[j]) <= CHUNK:
            size += len(texts[j]) + 1
            j += 1
        j = max(j, i + 1)
        buf = np.frombuffer(b"\n".join(texts[i:j]), np.uint8)
        at = np.cumsum([0] + [len(t) + 1 for t in texts[i : j - 1]])
        s, e = _bounds(buf, sep)
        hashes.append(_run_hashes(buf, s, e, lower))
        cut = np.searchsorted(s, at)
        n = np.diff(np.append(cut, len(s)))
        counts[i + 1 : j + 1] = n
        if places:
            base = np.repeat(at, n)
            starts_out.append(s - base)
            ends_out.append(e - base)
        i = j
    h = np.concatenate(hashes) if hashes else np.empty(0, U64)
    before = np.cumsum(counts)
    if not places:
        return h, before
    none = np.empty(0, np.int64)
    return h, before, np.concatenate(starts_out) if starts_out else none, np.concatenate(ends_out) if ends_out else none


def _long(text: bytes, sep: np.ndarray, lower: bool):
    """words() of one long text, piece by piece; pieces end at separators."""
    buf, hashes, starts, ends, at = np.frombuffer(text, np.uint8), [], [], [], 0
    while at < len(buf):
        to = min(at + CHUNK, len(buf))
        while to < len(buf) and not sep[buf[to]]:
            to += 1
        s, e = _bounds(buf[at:to], sep)
        hashes.append(_run_hashes(buf[at:to], s, e, lower))
        starts.append(s + at)
        ends.append(e + at)
        at = to
    return np.concatenate(hashes), np.concatenate(starts), np.concatenate(ends)


def ranges(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of the half-open ranges, one range after the other, and the number of the range of each."""
    size = ends - starts
    of = np.repeat(np.arange(len(size)), size)
    return np.arange(len(of)) + (starts - np.cumsum(size) + size)[of], of


def grams(h: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of n consecutive hashes, over text bounds too; see within()."""
    if len(h) < n:
        return np.empty(0, U64)
    size = len(h) - n + 1
    out = h[:size] * RUN_KEYS[0]
    for k in range(1, n):
        out += h[k : k + size] * RUN_KEYS[k]
    return mix(out)


def shingle_sets(texts: list[bytes], n: int = 5) -> list[np.ndarray]:
    """For each text the sorted distinct hashes of its runs of n words.

    ASCII capitals count as small letters.  A text of fewer words gives its
    whole sequence as one; a text without words gives none.
    """
    h, before = words(texts, SPACE, lower=True)
    run, out = grams(h, n), []
    for a, b in zip(before[:-1].tolist(), before[1:].tolist(), strict=True):
        if b - a >= n:
            out.append(np.unique(run[a : b - n + 1]))
        elif b > a:
            out.append(mix(np.array([sum(int(x) * int(k) for x, k in zip(h[a:b], RUN_KEYS, strict=False)) + (b - a) * int(RUN_KEYS[32]) & (1 << 64) - 1], U64)))
        else:
            out.append(np.empty(0, U64))
    return out
