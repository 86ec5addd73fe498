"""Patterns must mean in Java what they mean in Python."""

import re
import sys
import unicodedata

import pytest
from pyspark.sql import functions as F

from millrace.functions import items, rules
from millrace.functions.regex import portable, spaced, strip, sub, whole_words

PROBES = [
    "½ cup", "2½ c", "½c", "½é", "é½ ", "٣ cups", "éa!", "½ a½", "!!é", "oz²", "a\xa0b", "a b",
    "a　b", "a\x85b", "a\x1cb", "-\n- a", "a\r- b", "a - b", "• x\n• y\n\n* z", "1/2 / 3x",
    "2.5/3", "2.55x", "12ab", "K g oz", "CUP ſlice", "a - b", "1 / 2", "x​b", "_1_ 1",
    "ा1", "ⅷ 4", "٣/٤", "tsp. tbsp", "", " ", "jell-o Jell O jello jell\xa0o",
]
PATTERNS = [
    (r"(?m)^[•\-*]\s*", 0), (r"\s+", 0), (r"^[^\w]+|[^\w]+\Z", 0), (r"https?://\S+", 0),
    (r"\s*\([^)]*\)", 0), (r"\b", 0), (r"\d+", 0), (r"\be\s*tract\b", re.I),
]


@pytest.mark.parametrize("pattern,flags", PATTERNS)
def test_same_as_python(apply, pattern, flags):
    java = pattern.replace(r"\Z", r"\z")
    got = apply(lambda c: F.regexp_replace(c, portable(java, bool(flags)), "#"), PROBES)
    assert got == [re.sub(pattern, "#", p, flags=flags) for p in PROBES]


def test_number_and_unit_patterns(apply):
    number = re.compile(items._NUMBER)
    unit = re.compile(whole_words(rules.UNITS), re.I)
    assert apply(items.strip_quantities, PROBES) == [number.sub("", p) for p in PROBES]
    assert apply(items.strip_units, PROBES) == [unit.sub("", p) for p in PROBES]


def test_phrase_and_brand_patterns(apply):
    texts = [
        "salt to taste", "cut  into inch pieces", "Campbell's soup", "campbell’s", "campbell'x",
        "smuckers jam", "a chicken of  the sea b", "jell-o jello jell o jellox", "dash of x",
        "carefully washed,dried and", "for the sauce", "for sauces", "betty cro betty crocker",
        "peeled and diced,peeled and diced", "mi mix e tract etract lowfat low fat",
    ]
    for words in (rules.PHRASES, rules.BRANDS, [w for w, _ in rules.MISREADINGS]):
        want = re.compile(whole_words(words), re.I)
        got = apply(lambda c: sub(c, whole_words(words), "#", ignore_case=True), texts)
        assert got == [want.sub("#", t) for t in texts]


def test_strip(apply):
    texts = [c + "x y" + c for c in (" ", "\t", "\x1c", "\x85", "\xa0", " ", "　", "​")]
    assert apply(strip, texts) == [t.strip() for t in texts]


def test_every_character_class(apply):
    """Space, digit and word classes, over all assigned characters of the older Unicode tables."""
    chars = [
        chr(c) for c in range(0x3000 + 0x200)
        if not 0xD800 <= c <= 0xDFFF and unicodedata.category(chr(c)) != "Cn"
    ]
    known = unicodedata.ucd_3_2_0
    chars = [c for c in chars if known.category(c) == unicodedata.category(c)]
    assert sys.version_info >= (3, 10)
    for cls in (r"\s", r"\d", r"\w"):
        want = [bool(re.match(cls, c)) for c in chars]
        assert apply(lambda x: x.rlike("^" + portable(cls)[4:] + r"\z"), chars) == want


def test_spaced():
    assert spaced("a b") == r"a\s+b"
