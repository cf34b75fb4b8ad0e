"""DuckDB spellings of the text column functions, for oracle SQL only."""

from __future__ import annotations

from ..functions.text import ACCENT_FROM, ACCENT_TO, MULTI_LETTER, PUNCTUATION


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def strip_ws(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def lower(x):
    return f"coalesce(lower({x}), '')"


def strip_marks(x):
    c = f"regexp_replace({x}, '''', '', 'g')"
    c = f"regexp_replace({c}, '[^\\p{{L}}\\p{{N}}_]', ' ', 'g')"
    return f"coalesce({strip_ws(c)}, '')"


def strip_punctuation(x):
    return f"coalesce(translate({x}, {q(PUNCTUATION)}, ''), '')"


def strip_accents(x):
    c = x
    for ch, rep in MULTI_LETTER.items():
        c = f"replace({c}, {q(ch)}, {q(rep)})"
    return f"coalesce(translate({c}, {q(ACCENT_FROM)}, {q(ACCENT_TO)}), '')"


def strip_non_ascii(x):
    return f"coalesce(regexp_replace({x}, '[^\\x00-\\x7F]', '', 'g'), '')"


def digits_to_space(x):
    return f"coalesce(regexp_replace({x}, '[0-9]', ' ', 'g'), '')"


def squeeze_spaces(x):
    c = "regexp_replace(" + x + ", ' +', ' ', 'g')"
    return f"coalesce({strip_ws(c)}, '')"


def strip_links(x):
    c = f"regexp_replace({x}, 'https?://\\S+', ' ', 'g')"
    return f"coalesce(regexp_replace({c}, '[@#][\\p{{L}}\\p{{N}}_]+', ' ', 'g'), '')"


def clean_text(x, links=False):
    c = lower(x)
    if links:
        c = strip_links(c)
    for f in (strip_marks, strip_punctuation, strip_accents, strip_non_ascii,
              digits_to_space, squeeze_spaces):
        c = f(c)
    return c
