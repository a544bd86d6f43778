"""Scalar functions as column expressions: everything stays in the JVM."""

from __future__ import annotations

from decimal import Decimal
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# The Korean markers of morning and afternoon, and words of titles and headers.
AM, PM = "오전", "오후"
YEAR, MONTH = "년", "월"
TIME_KO, GENERATOR_KO, CODE_KO, ESTIMATED_KO = "시간", "발전기", "코드", "상태추정"
# Patterns of months in titles (in words, in digits, alone) and of publication dates.
TITLE_IN_WORDS = rf"(20\d{{2}})\s*{YEAR}(?:도)?\s*(\d{{1,2}})\s*{MONTH}"
TITLE_IN_DIGITS = r"(?<!\d)(20\d{2})(0[1-9]|1[0-2])(?!\d)"
TITLE_MONTH_ALONE = rf"(?<!\d)(1[0-2]|0?[1-9])\s*{MONTH}"
PUBLISHED = r"(20\d{2})[./-](\d{1,2})[./-](\d{1,2})"
# Texts that stand for a missing value when a file is read as text.
MISSING_TEXTS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")

TIMESTAMP = rf"^\s*(\d{{4}})[-/](\d{{1,2}})[-/](\d{{1,2}})(?:[ T]+({AM}|{PM})?\s*(\d{{1,2}})(?::(\d{{1,2}}))?(?::(\d{{1,2}})(?:\.\d*)?)?)?\s*$"
#: Stands between the parts of a text that is taken apart.
MARK = "\x01"
PLAIN_TIMESTAMP = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$"
NUMBER = r"^\s*[+-]?(?:(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?|[iI][nN][fF](?:[iI][nN][iI][tT][yY])?)\s*$"
MONTH_TEXT = r"^20\d{2}-(0[1-9]|1[0-2])$"


def parse_ts(text: Column) -> Column:
    """Year-first date and time texts, with / or -, single digits, and Korean morning or afternoon. Others: null.

    Texts in the plain form are cast; only others are taken apart, by one pass of
    the pattern that sets marks between the parts.
    """
    parts = F.split(F.regexp_replace(text, TIMESTAMP, MARK.join(f"${i}" for i in range(1, 8))), MARK)

    def made(p: Column) -> Column:
        number = lambda i, default=None: F.coalesce(F.get(p, i).try_cast("int"), F.lit(default))
        marker, said = F.get(p, 3), number(4, 0)
        hour = F.when(marker == "", said).when(said.between(1, 12), said % 12 + F.when(marker == PM, 12).otherwise(0))
        second = number(6, 0)
        return F.when(second < 60, F.try_make_timestamp_ntz(number(0), number(1), number(2), hour, number(5, 0), second.cast("decimal(16,6)")))

    taken_apart = F.get(F.transform(F.array(parts), made), F.lit(0))
    return F.when(text.rlike(PLAIN_TIMESTAMP), text.try_cast("timestamp_ntz")).when(~F.contains(text, F.lit(MARK)), taken_apart)


def to_num(text: Column) -> Column:
    """A decimal number or an infinity; all else, NaN too, is null."""
    return F.when(text.rlike(NUMBER), F.trim(text).try_cast("double"))


def two_places(value: Column) -> Column:
    """A double as decimal(18,2) by the nearest whole number of hundredths, ties away from zero: 1.005 * 100 lies below 100.5, so 1.00 it is. A plain cast rounds the digits that the double is shown with, to 1.01. NaN and infinities: null."""
    finite = F.when(F.abs(value) < float("inf"), value)
    hundredths = F.round(100 * finite).cast("long").cast("decimal(18,0)")
    return (hundredths * F.lit(Decimal("0.01"))).cast("decimal(18,2)")


def no_nan(value: Column) -> Column:
    return F.when(~F.isnan(value), value)


def missing_to_null(text: Column) -> Column:
    """Texts that a text reader takes for missing become null, before any trimming."""
    return F.when(~text.isin(*MISSING_TEXTS), text)


def identifier(text: Column) -> Column:
    return F.trim(missing_to_null(text))


def month_of_title(title: Column, published: Column | None = None) -> Column:
    """YYYY-MM of a post's title: year and month in words, else six digits, else a month alone with the year of publication (the year before if that month was still to come)."""

    def group(text: Column, pattern: str, i: int) -> Column:
        found = F.regexp_extract(text, pattern, i)
        return F.when(found != "", found)

    pad = lambda c: F.lpad(c.cast("int").cast("string"), 2, "0")
    tiers = [F.concat(group(title, p, 1), F.lit("-"), pad(group(title, p, 2))) for p in (TITLE_IN_WORDS, TITLE_IN_DIGITS)]
    if published is not None:
        month = group(title, TITLE_MONTH_ALONE, 1).cast("int")
        year = group(published, PUBLISHED, 1).cast("int") - F.when(month > group(published, PUBLISHED, 2).cast("int"), 1).otherwise(0)
        tiers.append(F.concat(year.cast("string"), F.lit("-"), pad(month)))
    return F.coalesce(*tiers)


def is_month(text: Column) -> Column:
    return text.rlike(MONTH_TEXT)


def slot(ts: Column) -> Column:
    """The start of the five-minute slot."""
    return F.window(ts, "5 minutes")["start"]


def exact_sum(value: Column, scale: int = 6) -> Column:
    """A sum of doubles that doesn't depend on the order of rows as far as values have so many decimals.

    Those go through decimals; what a value has beyond them, if anything, is summed
    as doubles and added, so no digit is dropped.  NaN, infinities and numbers of
    1e18 and more take part as doubles, with the results that those have; nulls don't count.
    """
    plain = F.abs(value) < 1e18  # not so for NaN, which is the largest number to Spark
    fixed = F.when(plain, value).cast(f"decimal({18 + scale},{scale})")
    rest = F.sum(F.when(plain, value - fixed.cast("double")).otherwise(value))
    return F.coalesce(F.sum(fixed).cast("double"), F.when(rest.isNotNull(), 0.0)) + rest


def share(part: Column, whole: Column) -> Column:
    """Per cent; null if the whole is zero."""
    return F.when(whole != 0, 100 * part / whole)


def ts_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")


def iso_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")


def csv_line(*columns: Column) -> Column:
    """One line of the CSV contract: texts quoted, with quotes doubled, numbers bare, null blank. Takes (text or number) columns; texts must be quoted by quoted()."""
    return F.concat_ws(",", *[F.coalesce(c.cast("string"), F.lit("")) for c in columns])


def quoted(text: Column) -> Column:
    return F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))


def header_token(text: Column) -> Column:
    """A header's name without byte order mark and white space, in capitals."""
    return F.regexp_replace(F.upper(F.regexp_replace(text, "^\\s*﻿*", "")), r"\s+", "")


def attachment_name(header: Column) -> Column:
    """The file name of a Content-Disposition header: the extended form, percent-decoded, else the plain one."""
    extended = F.regexp_extract(header, r"(?i)filename\*\s*=\s*(?:UTF-8'[^']*')?([^;]+)", 1)
    plain = F.regexp_extract(header, r'(?i)filename\s*=\s*"?([^";]+)"?', 1)
    name = F.when(extended != "", extended).when(plain != "", plain)
    return F.url_decode(F.replace(F.trim(name), F.lit("+"), F.lit("%2B")))


def plain_text(html: Column) -> Column:
    """HTML without scripts, styles and tags, white space collapsed."""
    steps = ((r"(?is)<(script|style)[^>]*>.*?</\1>", " "), (r"(?s)<[^>]+>", " "), (r"\s+", " "))
    return F.trim(reduce(lambda c, s: F.regexp_replace(c, *s), steps, html))


def magic(content: Column) -> Column:
    return F.lower(F.hex(F.substring(content, 1, 8)))


def months(start: Column, end: Column) -> Column:
    """All months from start to end, YYYY-MM, newest first."""
    first, last = F.to_date(F.concat(start, F.lit("-01"))), F.to_date(F.concat(end, F.lit("-01")))
    return F.transform(F.sequence(last, first, F.expr("INTERVAL -1 MONTH")), lambda d: F.date_format(d, "yyyy-MM"))


def url_join(base: Column, reference: Column) -> Column:
    """A reference as it is meant on a page: whole URLs as they are, others put to the page's scheme, host or folder; dots of the path are resolved. A blank one is the page itself."""
    ref = F.coalesce(F.trim(reference), F.lit(""))
    scheme, host = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*:)", 1), F.regexp_extract(base, r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/?#]*)", 1)
    path = F.regexp_extract(base, r"^[A-Za-z][A-Za-z0-9+.-]*:(?://[^/?#]*)?([^?#]*)", 1)
    plain = F.regexp_extract(base, r"^[^#]*", 0)
    query_less = F.regexp_extract(base, r"^[^?#]*", 0)
    ref_path, rest = F.regexp_extract(ref, r"^[^?#]*", 0), F.regexp_extract(ref, r"[?#].*$", 0)
    folder = F.regexp_extract(path, r"^.*/", 0)
    whole = F.when(ref_path.startswith("/"), ref_path).otherwise(F.concat(F.when(folder == "", F.lit("/")).otherwise(folder), ref_path))
    step = lambda done, part: F.when(part == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0)))).when(part == ".", done).otherwise(F.concat(done, F.array(part)))
    parts = F.split(F.regexp_replace(whole, "^/", ""), "/")
    walked = F.array_join(F.reduce(parts, F.array().cast("array<string>"), step), "/")
    open_end = F.when(whole.rlike(r"/\.{1,2}$") & (walked != ""), "/").otherwise("")
    joined = F.concat(scheme, host, F.lit("/"), walked, open_end, rest)
    return (
        F.when(ref.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), ref).when(ref.startswith("//"), F.concat(scheme, ref)).when(ref == "", plain)
        .when(ref.startswith("#"), F.concat(plain, ref)).when(ref.startswith("?"), F.concat(query_less, ref)).otherwise(joined)
    )
