"""Stemming rules of several languages as data, and the columns that apply them.

The rules are those of the published Snowball descriptions. A rule is a suffix, what
must hold of the part before it, and the replacement. In a step the first rule whose
suffix fits decides: it replaces where its condition holds, and else nothing happens.
Every step is one JVM expression over the word column; ``stems`` applies them to a
table of distinct words; ``stemmer`` is the same for one word, for whole texts in place.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass
class Rule:
    """``suffix`` -> ``put``, if ``before`` (patterns) all hold of the part before it and
    ``never`` does not. ``only`` is a pattern of that part without which the suffix does
    not fit at all; ``after`` names rules of the step before, by mark, one of which must
    have replaced.
    """
    suffix: str
    put: str = ""
    before: tuple = ()
    never: tuple = ()
    mark: str = ""
    after: str = ""
    only: str = ""


@dataclass
class Language:
    """First replacements (pattern, text), steps of rules, last replacements; words that
    stay or have a stem of their own, and words that stop after the first step."""
    prepare: list
    steps: list
    finish: list
    own: dict = field(default_factory=dict)
    stop_after_first: tuple = ()
    shortest: int = 1


def each(suffixes: str, **how) -> list[Rule]:
    return [Rule(s, **how) for s in suffixes.split()]


# Patterns and rules of the published English algorithm.
_SPECIAL = "gener|commun|arsen"
E_R1 = rf"^(?:{_SPECIAL})|^(?!{_SPECIAL}).*?[aeiouy][^aeiouy]"
E_R2 = rf"^(?:{_SPECIAL}).*?[aeiouy][^aeiouy]|^(?!{_SPECIAL}).*?[aeiouy][^aeiouy].*?[aeiouy][^aeiouy]"
E_NOTHING_IN_R1 = rf"^(?:{_SPECIAL}).|^(?!{_SPECIAL}).*?[aeiouy][^aeiouy]."
E_VOWEL = "[aeiouy]"
E_SHORT = "[^aeiouy][aeiouy][^aeiouywxY]$|^[aeiouy][^aeiouy]$"

ENGLISH = Language(
    prepare=[("^'", ""), ("^y", "Y"), ("([aeiouy])y", "$1Y"), ("('s'|'s|')$", "")],
    steps=[
        [Rule("sses", "ss"), Rule("ied", "i", only=".."), Rule("ied", "ie"),
         Rule("ies", "i", only=".."), Rule("ies", "ie"), Rule("us", "us"), Rule("ss", "ss"), Rule("s", before=("[aeiouy].",))],
        [Rule("eedly", "ee", before=(E_R1,)), Rule("eed", "ee", before=(E_R1,)),
         *each("ingly edly ing ed", before=(E_VOWEL,), mark="cut")],
        [*[Rule(s, s + "e", after="cut") for s in ("at", "bl", "iz")],
         *[Rule(c + c, c, after="cut") for c in "bdfgmnprt"],
         Rule("", "e", before=(E_SHORT,), never=(E_NOTHING_IN_R1,), after="cut")],
        [Rule("y", "i", before=("[^aeiouy]$", "..")), Rule("Y", "i", before=("[^aeiouy]$", ".."))],
        [Rule(s, r, before=(E_R1,)) for s, r in (
            ("ization", "ize"), ("ational", "ate"), ("fulness", "ful"), ("ousness", "ous"),
            ("iveness", "ive"), ("tional", "tion"), ("biliti", "ble"), ("lessli", "less"),
            ("entli", "ent"), ("ation", "ate"), ("alism", "al"), ("aliti", "al"),
            ("ousli", "ous"), ("iviti", "ive"), ("fulli", "ful"), ("enci", "ence"),
            ("anci", "ance"), ("abli", "able"), ("izer", "ize"), ("ator", "ate"),
            ("alli", "al"), ("bli", "ble"))]
        + [Rule("ogi", "og", before=(E_R1, "l$")), Rule("li", before=(E_R1, "[cdeghkmnrt]$"))],
        [Rule(s, r, before=(E_R1,)) for s, r in (
            ("ational", "ate"), ("tional", "tion"), ("alize", "al"), ("icate", "ic"),
            ("iciti", "ic"))]
        + [Rule("ative", before=(E_R1, E_R2)), Rule("ical", "ic", before=(E_R1,)),
           *each("ness ful", before=(E_R1,))],
        [*each("ement ance ence able ible ment ant ent ism ate iti ous ive ize", before=(E_R2,)),
         Rule("ion", before=(E_R2, "[st]$")), *each("al er ic", before=(E_R2,))],
        [Rule("e", before=(rf"{E_R2}|(?=.*(?:{E_R1}))(?!.*(?:{E_SHORT}))^.",)),
         Rule("l", before=(E_R2, "l$"))],
    ],
    finish=[("Y", "y")], shortest=3,
    own={
        "skis": "ski", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie",
        "idly": "idl", "gently": "gentl", "ugly": "ugli", "early": "earli", "only": "onli",
        "singly": "singl", "sky": "sky", "news": "news", "howe": "howe", "atlas": "atlas",
        "cosmos": "cosmos", "bias": "bias", "andes": "andes"},
    stop_after_first=("inning", "outing", "canning", "herring", "earring", "proceed", "exceed",
                      "succeed"))

# Patterns and rules of the published German algorithm.
G_R1 = "^(?=...).*?[aeiouyäöü][^aeiouyäöü]"
G_R2 = "^.*?[aeiouyäöü][^aeiouyäöü].*?[aeiouyäöü][^aeiouyäöü]"

GERMAN = Language(
    prepare=[("ß", "ss"), ("(?<=[aeiouyäöü])u(?=[aeiouyäöü])", "U"),
             ("(?<=[aeiouyäöü])y(?=[aeiouyäöü])", "Y")],
    steps=[
        [*each("ern em er", before=(G_R1,)), *each("en es e", before=(G_R1,), mark="e"),
         Rule("s", before=(G_R1, "[bdfghklmnrt]$"))],
        [Rule("niss", "nis", after="e")],
        [*each("est en er", before=(G_R1,)), Rule("st", before=(G_R1, "...[bdfghklmnt]$"))],
        [Rule("isch", before=(G_R2, "[^e]$")), *each("lich heit", before=(G_R2,), mark="lich"),
         Rule("keit", before=(G_R2,), mark="keit"), *each("end ung", before=(G_R2,), mark="end"),
         *each("ig ik", before=(G_R2, "[^e]$"))],
        [*each("er en", before=(G_R1,), after="lich"), *each("lich ig", before=(G_R2,), after="keit"),
         Rule("ig", before=(G_R2, "[^e]$"), after="end")],
    ],
    finish=[("U", "u"), ("Y", "y"), ("ä", "a"), ("ö", "o"), ("ü", "u")])

LANGUAGES = {"english": ENGLISH, "german": GERMAN}


def _applied(rule: Rule, word: Column) -> tuple[Column, Column]:
    """Whether the rule replaces, and the word with the replacement."""
    part = F.substring(word, F.lit(1), F.length(word) - len(rule.suffix))
    holds = F.lit(True)
    for pattern in rule.before:
        holds = holds & part.rlike(pattern)
    for pattern in rule.never:
        holds = holds & ~part.rlike(pattern)
    return holds, F.concat(part, F.lit(rule.put))


def _step(words: DataFrame, rules: list[Rule]) -> DataFrame:
    """One step over ``__w`` (word) and ``__m`` (marks of the rules that replaced)."""
    word, mark = F.col("__w"), F.col("__m")
    new, marks = None, None
    for rule in rules:
        fits = word.endswith(rule.suffix)
        if rule.after:
            fits = fits & (mark == rule.after)
        holds, replaced = _applied(rule, word)
        if rule.only:
            fits = fits & F.substring(word, F.lit(1), F.length(word) - len(rule.suffix)).rlike(
                rule.only)
        value = F.when(holds, replaced).otherwise(word)
        made = F.when(holds, F.lit(rule.mark)).otherwise(F.lit(""))
        new = F.when(fits, value) if new is None else new.when(fits, value)
        marks = F.when(fits, made) if marks is None else marks.when(fits, made)
    return words.withColumns({"__w": new.otherwise(word), "__m": marks.otherwise(F.lit(""))})


def stems(words: DataFrame, language: str = "english", word: str = "word",
          out: str = "stem") -> DataFrame:
    """``words`` with the stem of the column ``word``; null stays null.

    A language without rules (or null) raises ValueError: its words have no stems here.
    """
    if language not in LANGUAGES:
        raise ValueError(f"stemming rules exist for {', '.join(sorted(LANGUAGES))}")
    rules = LANGUAGES[language]
    start = F.col(word)
    for pattern, put in rules.prepare:
        start = F.regexp_replace(start, pattern, put)
    found = words.withColumns({"__w": start, "__m": F.lit("")})
    stay = F.col(word).isin(list(rules.own)) | (F.length(word) < rules.shortest)
    for k, step in enumerate(rules.steps):
        found = _step(found, step)
        if k == 0 and rules.stop_after_first:
            found = found.withColumn("__first", F.col("__w"))
    stem = F.col("__w")
    if rules.stop_after_first:
        stem = F.when(F.col("__first").isin(*rules.stop_after_first),
                      F.col("__first")).otherwise(stem)
    for pattern, put in rules.finish:
        stem = F.regexp_replace(stem, pattern, put)
    own = F.col(word)
    for a, b in rules.own.items():
        own = F.when(F.col(word) == a, F.lit(b)).otherwise(own)
    return found.withColumn(out, F.when(stay, own).otherwise(stem)).drop("__w", "__m", "__first")


def stemmer(language: str) -> Callable[[str], str]:
    """The rules of a language as a function of one word, equal to ``stems``."""
    rules = LANGUAGES[language]
    prepare = [(re.compile(p), put.replace("$1", r"\1")) for p, put in rules.prepare]
    finish = [(re.compile(p), put.replace("$1", r"\1")) for p, put in rules.finish]

    def compiled(rule: Rule) -> tuple:
        return (rule.suffix, rule.put, [re.compile(p).search for p in rule.before],
                [re.compile(p).search for p in rule.never], rule.mark, rule.after,
                re.compile(rule.only).search)

    # the rules that can fit, by a word's last character, in their order
    steps = [({c: [compiled(r) for r in step if r.suffix[-1:] in ("", c)]
               for c in {r.suffix[-1:] for r in step}}, [compiled(r) for r in step if not r.suffix])
             for step in rules.steps]

    def stem(word: str) -> str:
        if len(word) < rules.shortest or word in rules.own:
            return rules.own.get(word, word)
        w, mark = word, ""
        for search, put in prepare:
            w = search.sub(put, w)
        for k, (by_last, always) in enumerate(steps):
            made = ""
            for suffix, put, before, never, name, after, only in by_last.get(w[-1:], always):
                part = w[:len(w) - len(suffix)]
                if w.endswith(suffix) and (not after or mark == after) and only(part):
                    if all(f(part) for f in before) and not any(f(part) for f in never):
                        w, made = part + put, name
                    break
            mark = made
            if k == 0 and w in rules.stop_after_first:
                break
        for search, put in finish:
            w = search.sub(put, w)
        return w

    return stem
