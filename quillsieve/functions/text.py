"""Cleaning, normalising and matching of text, as column expressions.

White space is that of ECMAScript (with no-break and other Unicode spaces); lengths are counted
in code points. A null is an empty text throughout.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillsieve.functions.wordlists import PLACEHOLDERS

SPACE = r"[\t\n\x0B\f\r \x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}]"
MONTHS = "january|jan|february|feb|march|mar|april|apr|may|june|jun|july|jul|august|aug|september|sept|sep|october|oct|november|nov|december|dec"
#: In this order, which decides what nested entities become.
ENTITIES = [
    ("nbsp", " "), ("amp", "&"), ("quot", '"'), ("apos", "'"), ("rsquo", "'"), ("lsquo", "'"),
    ("rdquo", '"'), ("ldquo", '"'), ("ndash", "-"), ("mdash", "-"), ("#39", "'"),
]


def text(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def let(value: Column, make) -> Column:
    """make(value) with the value computed once, however often ``make`` uses it."""
    return F.transform(F.array(value), make)[0]


def trim(c: Column) -> Column:
    return F.regexp_replace(c, f"^{SPACE}+|{SPACE}+$", "")


def collapse(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, f"{SPACE}+", " "))  # all that is left at the ends is a space


def _numeric(c: Column, pattern: str, prefix: str, digits: str) -> Column:
    """Numeric entities as characters; a code that names no character stays."""
    code = {"16": lambda x: F.conv(x, 16, 10), "10": lambda x: x}[digits]
    number = lambda x: F.try_to_number(F.right(F.concat(F.lit("0" * 10), code(x)), F.lit(10)), F.lit("9999999999")).cast("long")
    valid = lambda x: (F.length(x) <= 9) & (number(x) <= 0x10FFFF) & ~number(x).between(0xD800, 0xDFFF)
    char = lambda x: F.decode(F.unhex(F.lpad(F.hex(number(x)), 8, "0")), "UTF-32")
    found = F.array_distinct(F.regexp_extract_all(c, F.lit(pattern), F.lit(1)))
    return F.aggregate(found, c, lambda acc, x: F.when(valid(x), F.replace(acc, F.concat(F.lit(prefix), x, F.lit(";")), char(x))).otherwise(acc))


def strip_html(c: Column, numeric: bool = True) -> Column:
    """Text without tags, with the entities above decoded and white space collapsed."""
    def decoded(x: Column) -> Column:
        for name, value in ENTITIES:
            x = F.regexp_replace(x, f"(?i)&{name};" if name[0] != "#" else f"&{name};", value)
        if not numeric:
            return x
        hexa = lambda y: _numeric(F.regexp_replace(y, "&#X", "&#x"), "&#x([0-9a-fA-F]+);", "&#x", "16")
        both = lambda y: let(hexa(y), lambda z: _numeric(z, "&#([0-9]+);", "&#", "10"))
        return let(x, lambda y: F.when(F.contains(y, F.lit("&#")), both(y)).otherwise(y))

    # Most texts have no entity, and then nothing looks for one.
    tagless = F.regexp_replace(text(c), "<[^>]*>", " ")
    return collapse(let(tagless, lambda x: F.when(F.contains(x, F.lit("&")), decoded(x)).otherwise(x)))


def clean_text(c: Column, limit: int = 600, numeric: bool = True) -> Column:
    """Stripped text of at most ``limit`` characters: a longer one loses its last, partial word
    and gets a full stop."""
    marks = r"[\x{200B}-\x{200D}\x{FEFF}]"
    whole = let(strip_html(c, numeric), lambda x: F.when(x.rlike(marks), collapse(F.regexp_replace(x, marks, ""))).otherwise(x))
    tail = rf"{SPACE}+[^\t\n\x0B\f\r \x{{A0}}\x{{FEFF}}]*$"
    short = lambda x: F.concat(trim(F.regexp_replace(F.substring(x, 1, limit), tail, "")), F.lit("."))
    return let(whole, lambda x: F.when(F.length(x) <= limit, x).otherwise(short(x)))


def clean_title(c: Column, numeric: bool = True) -> Column:
    out = clean_text(c, 180, numeric)
    out = F.regexp_replace(out, r"(?i)\s+[|-]\s+(?:latest news|news|real estate news)$", "")
    out = F.regexp_replace(out, r"(?i)^(?:watch|photos?|video):\s*", "")
    out = F.regexp_replace(out, rf"(?i)\s*(?:{MONTHS})\.?\s+\d{{1,2}},?\s+\d{{4}}.*$", "")
    out = F.regexp_replace(out, rf"(?i)\s*\d{{1,2}}\s+(?:{MONTHS})\.?\s+\d{{4}}.*$", "")
    return trim(out)


def normalize_title(c: Column) -> Column:
    out = F.replace(F.lower(text(c)), F.lit("&"), F.lit(" and "))
    return F.trim(F.regexp_replace(out, "[^a-z0-9]+", " "))


def first_of(*columns: Column) -> Column:
    """The first that isn't blank, trimmed; else empty."""
    return F.coalesce(*[F.nullif(trim(text(c)), F.lit("")) for c in columns], F.lit(""))


def is_placeholder(c: Column) -> Column:
    return F.lower(clean_text(c, 120)).isin(PLACEHOLDERS)


def first_description(*columns: Column) -> Column:
    return F.coalesce(*[F.when((trim(text(c)) != "") & ~is_placeholder(c), trim(text(c))) for c in columns], F.lit(""))


# Matching


def quoted(words: list[str]) -> str:
    return "|".join(re.sub(r"([.*+?^${}()|\[\]\\])", r"\\\1", w) for w in words)


def any_of(c: Column, words: list[str]) -> Column:
    """Whether a lower-case text has any of the words as a substring."""
    return c.rlike(f"(?:{quoted(words)})") if words else F.lit(False)


def whole_word(words: list[str]) -> str:
    """Pattern of the words with ASCII word boundaries."""
    return f"(?<![A-Za-z0-9_])(?:{quoted(words)})(?![A-Za-z0-9_])"


def any_word(c: Column, words: list[str]) -> Column:
    return c.rlike(whole_word(words)) if words else F.lit(False)


def mentions(c: Column, words: list[str]) -> Column:
    """Sum of each word's own mentions: words that overlap count one by one."""
    total = F.lit(0)
    for w in words:
        total = total + F.regexp_count(c, F.lit(whole_word([w])))
    return total
