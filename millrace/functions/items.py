"""Normalizing one item of an ingredient list."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.functions import rules
from millrace.functions.regex import (
    any_word,
    bind,
    constant,
    matches,
    spaced,
    sub,
    sub_where,
    whole_words,
)

_NUMBER = (
    r"(?<!\w)(?:\d+(?:\.\d+)?(?:\s*/\s*\d+)?|[" + rules.FRACTIONS + r"])(?!\w)"
)
_UNIT = any_word(rules.UNITS)
_PARENTHESES = r"\s*\([^)]*\)"


# A text without any of these holds nothing for the rewrite rules: every rule needs one of them. The
# last three can stand for an s or an i when case is ignored.
_TELLTALES = [
    "lily", "eagle", "campbell", "smucker", "chicken", "betty", "jell", "velveeta", "philadelphia",
    "margarine", "shortening", "honey", "cocoa", "lemon", "milk", "peanut", "pollack", "tract",
    "pcz", "low", "ſ", "ı", "i\u0307",
]


# An item that is one word of Latin letters, alone, is nearly always its own name or the plural of it:
# all other rules need a blank, a digit or a sign, or one of the words listed here.
_LETTERS = "etaoinshrdlucmfwypvbgkjqxz" + "".join(map(chr, [*range(0xDF, 0xF7), *range(0xF8, 0x100)]))
_LETTERS += "".join(c.upper() for c in _LETTERS if c not in "ßÿ")
_EDGES = ".;:-–—•×*"  # of DASHES and STOPS, which become blanks; the slash also parts alternatives


_SIGNS = "%&$#!?'\""  # that only the last step removes; behind them no plural is seen


def _spellings(pattern: str) -> list[str]:
    """What a pattern of one word matches, in letters only."""
    word = re.sub(r"\[[^\]]*\]\?|\\s\*", "", pattern)
    return [w for w in (word.replace("s?", ""), word.replace("?", "")) if w.isalpha()]


def _plurals(name: str) -> list[str]:
    """All words whose singular could be ``name``."""
    return [name, name + "s", name + "es", name[:-1] + "ies", name[:-1] + "ves"]


_NAMED = sorted({w for t in [*rules.BRANDS, *[wrong for wrong, _ in rules.MISREADINGS]] for w in _spellings(t)})
_DROPPED = sorted({w for w in [*rules.UNITS, *rules.DESCRIPTORS] if w.isalpha()})
_SPECIAL = {*_NAMED, *_DROPPED}
_SPECIAL |= {w for name in [*rules.SPELLING, *rules.ALIASES] for w in _plurals(name)}


def bare(item: Column) -> Column:
    """An item without what only becomes blanks at its ends."""
    return F.btrim(item, F.lit(_EDGES))


def only_letters(word: Column) -> Column:
    return F.ltrim(word, F.lit(_LETTERS)) == ""


def is_plain(item: Column) -> Column:
    """Is the item one word, which no rewrite rule names?"""
    core = F.rtrim(bare(item), F.lit(_SIGNS))
    return only_letters(core) & ~F.lower(core).isin(*_NAMED)


def rewrite_rules(col: Column) -> Column:
    """Delete brands, separate nouns that were run together, repair misreadings; in that order.

    A few plain searches tell if a text needs the fifteen rewrites at all; most texts do not.
    """
    words = constant(_TELLTALES)

    def needed(text: Column) -> Column:
        return bind(
            F.lower(text),
            lambda t: F.exists(words, lambda w: F.contains(t, w))
            | (F.contains(t, F.lit("mi")) & matches(t, r"\bmi\b")),
        )

    return bind(col, lambda s: F.when(needed(s), rewrite_always(s)).otherwise(s))


def rewrite_always(col: Column) -> Column:
    col = sub(col, whole_words(rules.BRANDS), "", ignore_case=True)
    for first, second in rules.STUCK_PAIRS[:-1]:
        col = _unstick(col, first, second)
    col = sub(col, r"(?<!\w)" + spaced(rules.STUCK_PREFIX) + r"\s+", "", ignore_case=True)
    col = _unstick(col, *rules.STUCK_PAIRS[-1])
    for wrong, right in rules.MISREADINGS:
        col = sub(col, whole_words([wrong]), right, ignore_case=True)
    return col


def _unstick(col: Column, first: str, second: str) -> Column:
    return sub(col, stuck(first, second), f"$1 or {second}", ignore_case=True)


def stuck(first: str, second: str) -> str:
    return rf"(?<!\w)({first})\s+{spaced(second)}(?!\w)"


def drop_parentheses(col: Column) -> Column:
    return sub_where(col, "(", _PARENTHESES, "")


def drop_phrases(col: Column) -> Column:
    return sub(col, whole_words(rules.PHRASES), " ", ignore_case=True)


def strip_quantities(col: Column) -> Column:
    return sub(col, _NUMBER, "")


def strip_units(col: Column) -> Column:
    return sub(col, _UNIT, "", ignore_case=True)


def has_quantity(col: Column) -> Column:
    """Does the text hold a number or a unit?"""
    searched = matches(col, _NUMBER) | matches(col, _UNIT, ignore_case=True)
    # a word of letters holds a unit only as a whole
    return F.when(only_letters(col), F.lower(col).isin(*rules.UNITS)).otherwise(searched)


def dashes_to_space(col: Column) -> Column:
    return sub(col, f"{rules.DASHES}|{rules.STOPS}", " ")


def collapse_whitespace(col: Column) -> Column:
    return F.trim(sub(col, r"\s+", " "))  # only plain blanks are left to trim


def drop_stopwords(tokens: Column, words: list[str] | None = None) -> Column:
    listed = ", ".join("'" + w.replace("\\", "\\\\").replace("'", "\\'") + "'" for w in words or rules.DESCRIPTORS)
    # one parsed text instead of a literal per word; Spark turns the list into a hash set
    return F.call_function("filter", tokens, F.expr(f"t -> t NOT IN ({listed})"))


def singularize(word: Column) -> Column:
    """Cheap English singular of one word. The odd stems ("appl", "olif") are the keys."""
    size = F.length(word)

    def ends(*suffixes: str) -> Column:
        cond = word.endswith(suffixes[0])
        for s in suffixes[1:]:
            cond = cond | word.endswith(s)
        return cond

    def cut(n: int) -> Column:
        return F.substring(word, F.lit(1), size - n)

    return (
        F.when(~word.endswith("s"), word)
        .when((size > 3) & ends("ies"), F.concat(cut(3), F.lit("y")))
        .when((size > 3) & ends("ves"), F.concat(cut(3), F.lit("f")))
        .when((size > 3) & ends("es") & ~ends(*rules.KEEP_ES), cut(2))
        .when((size > 2) & ends("s") & ~ends(*rules.KEEP_S), cut(1))
        .otherwise(word)
    )


def strip_edges(col: Column) -> Column:
    """Remove everything but word characters from both ends."""
    return sub(col, r"^[^\w]+|[^\w]+\z", "")


def preferred_name(col: Column) -> Column:
    """Spelling, then alias, both of the whole text, as one lookup in the two combined."""
    names = {**rules.ALIASES, **{k: rules.ALIASES.get(v, v) for k, v in rules.SPELLING.items()}}
    # a hash set tells most texts apart before the map is searched
    return bind(col, lambda s: F.when(s.isin(*names), F.element_at(constant(names), s)).otherwise(s))


def normalize_item(col: Column) -> Column:
    """Canonical name of an item, without quantity, unit and description. Not idempotent.

    Most items are one word that no list holds, of which only the plural may go, or signs at its end.
    """
    s = F.lower(F.coalesce(col, F.lit("")))
    word = bare(s)
    core = F.rtrim(word, F.lit(_SIGNS))
    plain = only_letters(core) & ~core.isin(*sorted(_SPECIAL))
    return (
        F.when(plain, F.when(core == word, singularize(word)).otherwise(core))
        .when(word.isin(*_DROPPED), F.lit(""))
        .otherwise(normalize_always(s))
    )


def normalize_always(s: Column) -> Column:
    """All steps, for a lower-case text."""
    s = rewrite_rules(s)
    s = sub_where(s, "sugar", whole_words([rules.TEN_X[0]]), rules.TEN_X[1])
    s = drop_parentheses(s)
    s = drop_phrases(s)
    s = strip_quantities(s)
    s = strip_units(s)
    s = dashes_to_space(s)
    s = collapse_whitespace(s)
    tokens = F.transform(drop_stopwords(F.split(s, " ")), singularize)
    return preferred_name(strip_edges(F.array_join(tokens, " ")))
