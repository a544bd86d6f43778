"""Personal data by offset-preserving deobfuscation.

Plain identifiers are found in the text as it stands (the base).  Texts with
signs of disguise then pass through three transducers, each of which keeps, for
every character it writes, the span of source characters it came from:

1. homoglyphs: full-width forms, look-alike letters, other scripts' digits and
   dashes become ASCII; invisible characters vanish; among digits, the letters O
   and l become digits;
2. spelled digits: runs of digit words ("four two double nine", with "plus" and
   "dot") become digits;
3. at/dot disguises: "name (at) host [dot] org", "name at host dot org".

The same detectors run over the normalised text, and what they find is mapped
back to source characters.  Such a span is added unless it lies inside a base
span of its kind; base spans always stay.

Edge cases.  A null text is empty and has no spans.  Texts are taken whole; every
detector takes time in proportion to the text.  Columns of the input are kept,
except for one named ``spans``, which is replaced.  Repeated rows and null ids
pass through.  An empty table gives an empty result.
"""

from __future__ import annotations

import re
from bisect import bisect_left

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_text

KINDS = ("email", "ip", "card", "phone")
Span = tuple[str, int, int]

_HOST = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
#: A match can only begin where a run of digits begins: within a run it would end, or fail, at the same place.
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile(r"[^0-9]+")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        total += n if i % 2 == 0 else 2 * n - 9 * (n > 4)
    return total % 10 == 0


def detect(text: str) -> list[Span]:
    """Identifiers of each kind, leftmost and non-overlapping within a kind."""
    out: list[Span] = []
    at, done = text.find("@"), 0
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        m = _HOST.match(text, at + 1) if start < at else None
        if m:
            out.append(("email", start, m.end()))
            done = m.end()
        at = text.find("@", max(at + 1, done))
    if "." in text:
        for m in _IP.finditer(text):
            if all(len(p) <= 3 and int(p) <= 255 for p in (q.lstrip("0") or "0" for q in m[0].split("."))):
                out.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 12 and 12 <= len(d := _DIGITS.sub("", m[0])) <= 19 and luhn(d):
            out.append(("card", *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_DIGITS.sub("", m[0])) <= 15:
                out.append(("phone", *m.span()))
    return out


# Characters that look like ASCII ones.
_LOOK_ALIKE = dict(zip("аеорсухіјѕһԁԛԝвкмнтАВЕКМНОРСТУХІЈЅ", "aeopcyxijshdqwbkmhtABEKMHOPCTYXIJS", strict=True))
_LOOK_ALIKE |= dict(zip("αονρτυικχΑΒΕΖΗΙΚΜΝΟΡΤΥΧ", "aovptuikxABEZHIKMNOPTYX", strict=True))
_LOOK_ALIKE |= dict.fromkeys("‐‑‒–—―−﹣", "-") | dict.fromkeys("․。｡·", ".") | dict.fromkeys("﹫", "@") | dict.fromkeys("        　", " ")
# Invisible characters.
_LOOK_ALIKE |= dict.fromkeys("­​‌‍⁠﻿", "")
# By rule: full-width forms, and digits of other scripts and styles.
_LOOK_ALIKE |= {chr(0xFEE0 + c): chr(c) for c in range(0x21, 0x7F)}
_LOOK_ALIKE |= {chr(zero + d): str(d) for zero in (0x660, 0x6F0, 0x966, 0x9E6) for d in range(10)}
_LOOK_ALIKE |= {chr(0x1D7CE + i): str(i % 10) for i in range(50)}
_LOOK_ALIKE_SET = frozenset(_LOOK_ALIKE)
_LOOK_ALIKE_RE = re.compile("[" + "".join(map(re.escape, _LOOK_ALIKE)) + "]")

# Letters that stand for digits among digits.
_DIGIT_LIKE = {"O": "0", "o": "0", "l": "1", "I": "1"}
#: What _CONFUSED matches with a digit and a letter holds both side by side, or with signs between.
_CONFUSED_HINT = re.compile(r"[0-9][.()\x20-]*[OolI]|[OolI][.()\x20-]*[0-9]")
_CONFUSED = re.compile(r"(?<![A-Za-z0-9.])\+?[0-9OolI][0-9OolI.()\x20-]{5,}[0-9OolI](?![A-Za-z0-9])")

# Digit words of the corpus's languages.
_WORDS = {
    **dict(zip("zero one two three four five six seven eight nine".split(), "0123456789", strict=True)), "oh": "0",
    **dict(zip("null eins zwei drei vier fünf sechs sieben acht neun".split(), "0123456789", strict=True)),
    **dict(zip("zéro un deux trois quatre cinq sept huit neuf".split(), "012345789", strict=True)),
    **dict(zip("cero uno dos tres cuatro cinco seis siete ocho nueve".split(), "0123456789", strict=True)),
}
_TIMES = {"double": 2, "triple": 3}
#: Letters that patterns take for ASCII ones where case doesn't count.
_FOLD = str.maketrans("\u017f\u0130\u0131\u212a", "siik")
_DOT_WORDS = r"dot|punkt|punto|point"
_DIGIT_WORD = "|".join(sorted(_WORDS, key=len, reverse=True))
_DOT = rf"\s{{0,3}}[\[({{<]\s{{0,3}}(?:{_DOT_WORDS}|\.)\s{{0,3}}[\])}}>]\s{{0,3}}|[\x20]{{1,3}}(?:{_DOT_WORDS})[\x20]{{1,3}}"
_AT = r"\s{0,3}[\[({<]\s{0,3}(?:at|arroba|@)\s{0,3}[\])}>]\s{0,3}|[\x20]{1,3}(?:at|arroba)[\x20]{1,3}"
_ONE = rf"(?:(?:double|triple)[\x20-]+)?(?:(?:{_DIGIT_WORD})(?![^\W_])|[0-9]+)"
_SPELLED = re.compile(rf"(?<![^\W_])(?:(?:plus[\x20]+|\+[\x20]?)?{_ONE}(?:(?:{_DOT}|[\x20,-]{{1,3}}){_ONE})+)", re.I)
_SPELLED_PART = re.compile(rf"(?P<dot>{_DOT})|(?P<plus>plus[\x20]+|\+[\x20]?)|(?:(?P<times>double|triple)[\x20-]+)?(?:(?P<word>(?:{_DIGIT_WORD})(?![^\W_]))|(?P<digits>[0-9]+))|(?P<gap>[\x20,-]+)", re.I)
_NAME_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789_%+-.")
#: Looked at from an "at" to the right; to its left, text is walked back once.
_HOST_SAID = re.compile(rf"[A-Za-z0-9-]+(?:(?:{_DOT}|\.)[A-Za-z0-9-]+)+", re.I)
_DOTTED = re.compile(rf"(?<![0-9.])[0-9]{{1,3}}(?:(?:{_DOT}|\.)[0-9]{{1,3}}){{3}}(?![0-9])", re.I)
_AT_RE, _DOT_RE = re.compile(rf"{_AT}|@", re.I), re.compile(_DOT, re.I)
#: Every _DOT, and every _AT but a bare "at" (which counts only beside a _DOT), holds one of these; every run of spelled digits holds a digit word.
_AT_DOT_HINT = re.compile(rf"{_DOT_WORDS}|arroba|[\[({{<]\s{{0,3}}(?:at|@|\.)", re.I)
_SPELLED_HINT = re.compile(rf"(?<![^\W_])(?:{_DIGIT_WORD})(?![^\W_])", re.I)
# Last labels of host names that bare "at" and "dot" are believed before.
_TOP = frozenset("com org net edu gov mil int info biz io co ai app dev me tv us uk eu de fr es it nl be ch at pl pt br mx ar ru ua jp kr cn in au ca nz ie se no fi dk cz test example invalid local".split())


class Tape:
    """A text under way: chars, and the source span of each."""

    def __init__(self, text: str):
        self.text, self.starts, self.ends = text, range(len(text)), range(1, len(text) + 1)

    def rewrite(self, edits: list[tuple[int, int, str]]) -> None:
        """edits: (start, end, text instead), in order, not overlapping.  What is written spans what it replaces."""
        if not edits:
            return
        out, starts, ends, at = [], [], [], 0
        for a, b, new in edits:
            out += [self.text[at:a], new]
            starts += self.starts[at:a]
            ends += self.ends[at:a]
            starts += [self.starts[a]] * len(new)
            ends += [self.ends[b - 1]] * len(new)
            at = b
        self.text = "".join([*out, self.text[at:]])
        self.starts, self.ends = [*starts, *self.starts[at:]], [*ends, *self.ends[at:]]


def _homoglyphs(tape: Tape) -> None:
    if not tape.text.isascii():
        tape.rewrite([(m.start(), m.end(), _LOOK_ALIKE[m[0]]) for m in _LOOK_ALIKE_RE.finditer(tape.text)])
    tape.rewrite(_confused(tape.text))


def _confused(text: str) -> list[tuple[int, int, str]]:
    edits = []
    for m in _CONFUSED.finditer(text):
        letters = [i for i in range(m.start(), m.end()) if text[i] in _DIGIT_LIKE]
        if letters and sum(c.isdigit() for c in m[0]) >= 2 * len(letters):
            edits += [(i, i + 1, _DIGIT_LIKE[text[i]]) for i in letters]
    return edits


def _spelled(tape: Tape) -> None:
    edits = []
    for run in _SPELLED.finditer(tape.text):
        own, digits, spelled = [], 0, False
        for m in _SPELLED_PART.finditer(tape.text, run.start(), run.end()):
            if m["word"] or m["digits"]:
                new = (_WORDS[m["word"].translate(_FOLD).lower()] if m["word"] else m["digits"]) * _TIMES.get((m["times"] or "").translate(_FOLD).lower(), 1)
                digits, spelled = digits + len(new), spelled or bool(m["word"])
            else:
                new = "." if m["dot"] else "+" if m["plus"] else ""
            own.append((m.start(), m.end(), new))
        if spelled and digits >= 4:
            edits += own
    tape.rewrite(edits)


def _said(text: str, a: int, done: int, dot_before: dict[int, int]) -> int:
    """Where the name that ends at a begins: parts of name characters, with spelled dots between; a if there is none. Nothing before done is looked at."""
    found = at = a
    while True:
        start = at
        while start > done and text[start - 1] in _NAME_CHARS:
            start -= 1
        while start < at and text[start] == ".":
            start += 1
        if start == at:
            return found
        found, at = start, dot_before.get(start, -1)
        if at <= done or text[at - 1] not in _NAME_CHARS:
            return found


def _at_dot(tape: Tape) -> None:
    """Addresses are looked for at every "at", not at every name, and what lies left of it is walked once."""
    edits, done, text = [], 0, tape.text
    dot_before = {d.end(): d.start() for d in _DOT_RE.finditer(text)}
    for m in _AT_RE.finditer(text):
        a, b = m.span()
        host = _HOST_SAID.match(text, b)
        start = _said(text, a, done, dot_before) if host else a
        if start == a:
            continue
        end = host.end()
        dots = [d for part in ((start, a), (b, end)) for d in _DOT_RE.finditer(text, *part)]
        in_host = [d for d in dots if d.start() >= b]
        bare = text[a:b].strip().isalpha()
        done = b
        if (bare and not in_host) or (not dots and text[a:b] == "@"):
            continue
        words_only = bare or (in_host and all(text[d.start() : d.end()].strip().isalpha() for d in in_host))
        if words_only and re.split(r"[^A-Za-z0-9-]+", host[0])[-1].lower() not in _TOP:
            continue
        edits += [(d.start(), d.end(), ".") for d in dots] + [(a, b, "@")] * (text[a:b] != "@")
        done = end
    taken = sorted(edits)
    for m in _DOTTED.finditer(tape.text):
        dots = list(_DOT_RE.finditer(tape.text, *m.span()))
        if dots and not any(e[0] < m.end() and e[1] > m.start() for e in taken):
            edits += [(d.start(), d.end(), ".") for d in dots]
    tape.rewrite(sorted(edits))


def disguised(text: str) -> list[Span]:
    """Identifiers in the normalised text, as spans of the source; none if nothing was normalised."""
    return _normalised(text) if _may_be_disguised(text) else []


def _may_be_disguised(text: str) -> bool:
    """False only for texts that no transducer changes."""
    if not text.isascii() and not _LOOK_ALIKE_SET.isdisjoint(text):
        return True
    return bool(_AT_DOT_HINT.search(text) or _SPELLED_HINT.search(text) or (_CONFUSED_HINT.search(text) and _confused(text)))


def _normalised(text: str) -> list[Span]:
    tape = Tape(text)
    _homoglyphs(tape)
    _spelled(tape)
    _at_dot(tape)
    if tape.text == text:
        return []
    return [(kind, tape.starts[a], tape.ends[b - 1]) for kind, a, b in detect(tape.text)]


def spans(text: str) -> list[tuple[str, int, int, bool]]:
    """All spans (kind, start, end, whether it is a base span), by start, kind and end."""
    base = detect(text)
    by_kind = {k: sorted((a, b) for kind, a, b in base if kind == k) for k in KINDS}
    out = [(*s, True) for s in base]
    for kind, a, b in disguised(text):
        own = by_kind[kind]
        i = bisect_left(own, (a + 1,)) - 1  # the last that begins at a or before
        if i < 0 or own[i][1] < b:
            out.append((kind, a, b, False))
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def find_pii(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Adds spans: array of struct(kind, start, end, base), code points, end exclusive."""

    def fn(texts: list[bytes]) -> list:
        return [[[dict(zip(("kind", "start", "end", "base"), s, strict=True)) for s in spans(t.decode())] for t in texts]]

    return map_text(docs, fn, "spans array<struct<kind:string,start:long,end:long,base:boolean>>", text, keep)


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents with each span, or each union of overlapping spans, replaced by its first kind in capitals in angle brackets; texts without any stay, null too."""

    def fn(texts: list[bytes]) -> list:
        return [[_redacted(t.decode()) for t in texts]]

    made = map_text(docs, fn, "__redacted string", text)
    return made.withColumn(text, F.coalesce("__redacted", text)).select(*docs.columns)


def _redacted(text: str) -> str | None:
    found = spans(text)
    if not found:
        return None
    out, at, i = [], 0, 0
    while i < len(found):
        kind, a, b, _ = found[i]
        i += 1
        while i < len(found) and found[i][1] < b:
            b = max(b, found[i][2])
            i += 1
        out += [text[at:a], f"<{kind.upper()}>"]
        at = b
    return "".join([*out, text[at:]])


def digest(found: DataFrame) -> DataFrame:
    """doc_id, the numbers of base spans by kind, base_sha256, spans as one string, and the number of added spans."""

    def joined(column):
        return F.array_join(F.transform(column, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    base = F.filter("spans", lambda s: s["base"])
    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["base"] & (s["kind"] == kind))).cast("long").alias(f"n_{kind}")

    added = F.size(F.filter("spans", lambda s: ~s["base"])).cast("long").alias("n_added")
    return found.select("doc_id", *map(count, KINDS), F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"), added)
