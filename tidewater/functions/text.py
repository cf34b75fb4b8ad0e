"""Text cleaning as composed column expressions.

Every step maps null to '' (the reference returns '' for falsy input) and
stays a JVM expression, so a whole cleaning chain is one codegen'd
projection over the text column.
"""

from __future__ import annotations

import string
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(x: ColumnOrName) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _nz(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


# Python's Unicode ``\w`` = letters, numbers and underscore.
NON_WORD = "[^\\p{L}\\p{N}_]"

# ASCII punctuation as listed by Python's ``string.punctuation``.
PUNCTUATION = string.punctuation

# Transliterations that are more than dropping a mark.
MULTI_LETTER = {"ß": "ss", "æ": "ae", "Æ": "AE", "œ": "oe", "Œ": "OE", "þ": "th", "Þ": "Th"}
SINGLE_LETTER = {"ø": "o", "Ø": "O", "đ": "d", "Đ": "D", "ð": "d", "Ð": "D", "ł": "l",
                 "Ł": "L", "ħ": "h", "Ħ": "H", "ı": "i"}


def _accent_table() -> tuple[str, str]:
    """Latin letters U+00C0..U+024F whose canonical decomposition starts
    with an ASCII letter map to that letter (built by rule, not by hand)."""
    src, dst = [], []
    for cp in range(0x00C0, 0x0250):
        ch = chr(cp)
        base = unicodedata.normalize("NFD", ch)[0]
        if base != ch and base.isascii() and base.isalpha():
            src.append(ch)
            dst.append(base)
    for ch, rep in SINGLE_LETTER.items():
        if ch not in src:
            src.append(ch)
            dst.append(rep)
    return "".join(src), "".join(dst)


ACCENT_FROM, ACCENT_TO = _accent_table()


# S9
def to_lower(col: ColumnOrName) -> Column:
    return _nz(F.lower(_c(col)))


# S10
def strip_marks(col: ColumnOrName) -> Column:
    """Drop apostrophes, other non-word characters -> space, trim. Every
    whitespace character is a non-word character, so after the replacement
    only spaces are left and a plain ``trim`` equals Python's ``strip()``."""
    c = F.replace(_c(col), F.lit("'"), F.lit(""))
    c = F.regexp_replace(c, NON_WORD, " ")
    return _nz(F.trim(c))


def strip_ws(c: Column) -> Column:
    """Python ``str.strip()``: leading and trailing whitespace of any kind."""
    return F.regexp_replace(c, "^\\s+|\\s+$", "")


# S11
def strip_punctuation(col: ColumnOrName) -> Column:
    return _nz(F.translate(_c(col), PUNCTUATION, ""))


# S12
def strip_accents(col: ColumnOrName) -> Column:
    c = _c(col)
    for ch, rep in MULTI_LETTER.items():
        c = F.replace(c, F.lit(ch), F.lit(rep))
    return _nz(F.translate(c, ACCENT_FROM, ACCENT_TO))


# S13
def strip_non_ascii(col: ColumnOrName) -> Column:
    return _nz(F.regexp_replace(_c(col), "[^\\x00-\\x7F]", ""))


# S14
def digits_to_space(col: ColumnOrName) -> Column:
    return _nz(F.regexp_replace(_c(col), "[0-9]", " "))


# S15
def squeeze_spaces(col: ColumnOrName) -> Column:
    return _nz(strip_ws(F.regexp_replace(_c(col), " +", " ")))


# S25
def strip_links(col: ColumnOrName) -> Column:
    c = F.regexp_replace(_c(col), "https?://\\S+", " ")
    return _nz(F.regexp_replace(c, "[@#][\\p{L}\\p{N}_]+", " "))


# S16
def clean_text(col: ColumnOrName, links: bool = False) -> Column:
    """lower -> marks -> punctuation -> accents -> non-ASCII -> digits ->
    spaces, in that order; ``links=True`` strips links/mentions first."""
    c = to_lower(col)
    if links:
        c = strip_links(c)
    c = strip_marks(c)
    c = strip_punctuation(c)
    c = strip_accents(c)
    c = strip_non_ascii(c)
    c = digits_to_space(c)
    # only spaces can be left as whitespace here: plain trim, no regex
    return _nz(F.trim(F.regexp_replace(c, " +", " ")))


# S17
def tokenize(col: ColumnOrName) -> Column:
    return F.split(_c(col), " ")


def token_set(col: ColumnOrName) -> Column:
    return F.array_distinct(tokenize(col))
