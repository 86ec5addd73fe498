r"""Regular expressions that mean the same in Java as in Python.

Java's ``\w``, ``\s``, ``\d`` and ``\b`` follow other character tables than Python's. The classes are
therefore spelled out; ``\p{L}\p{N}_`` is exactly Python's word character for text, and the space
class lists the characters of ``str.isspace``. Every pattern of the library goes through
:func:`portable`.
"""

from __future__ import annotations

import json

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD = r"\p{L}\p{N}_"
SPACE = (
    r"\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
DIGIT = r"\p{Nd}"
BLANKS = "".join(c for c in map(chr, range(0x3001)) if c.isspace())  # the space class as a text

# The same characters for Java, shaped for speed: Latin ones as single members (one bit set), the
# others behind one range check. A list of ranges is tried range by range for every character.
_WIDE_SPACE = r"\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
_JAVA_SPACE = (
    r"\t\n\x{0b}\f\r\x{1c}\x{1d}\x{1e}\x{1f}\x{20}\x{85}\x{a0}"
    rf"[\x{{1680}}-\x{{3000}}&&[{_WIDE_SPACE}]]"
)

_BOUNDARY = f"(?:(?<=[{WORD}])(?![{WORD}])|(?<![{WORD}])(?=[{WORD}]))"
_CLASSES = {"w": WORD, "s": _JAVA_SPACE, "d": DIGIT}


def portable(pattern: str, ignore_case: bool = False) -> str:
    r"""Spell out ``\w \s \S \d \b`` of a Python pattern for Java."""
    out, in_set, i = [], False, 0
    while i < len(pattern):
        ch = pattern[i]
        if ch == "\\":
            esc = pattern[i + 1]
            if esc in _CLASSES:
                out.append(_CLASSES[esc] if in_set else f"[{_CLASSES[esc]}]")
            elif esc == "S" and not in_set:
                out.append(f"[^{SPACE}]")
            elif esc == "b" and not in_set:
                out.append(_boundary(pattern, i))
            else:
                out.append(ch + esc)
            i += 2
            continue
        if ch == "[" and not in_set:
            in_set = True
        elif ch == "]" and in_set:
            in_set = False
        out.append(ch)
        i += 1
    # d: only \n ends a line; i and u: Unicode-aware case folding
    return ("(?iud)" if ignore_case else "(?d)") + "".join(out)


def _boundary(pattern: str, at: int) -> str:
    """A cheaper one-sided check where the neighbour in the pattern is surely a word character."""
    after = pattern[at + 2 : at + 3]
    before = pattern[at - 1 : at]
    if after.isalnum():
        return f"(?<![{WORD}])"
    if before.isalnum() and pattern[at - 2 : at - 1] != "\\":
        return f"(?![{WORD}])"
    return _BOUNDARY


def spaced(text: str) -> str:
    """A plain space in a rule text stands for a run of whitespace."""
    return text.replace(" ", r"\s+")


def whole_words(texts: list[str]) -> str:
    """One alternation of rule texts, bounded on both sides; the order is the priority.

    Every rule text starts with a word character, so a look-behind is the whole left boundary.
    """
    return r"(?<!\w)(?:" + "|".join(spaced(t) for t in texts) + r")\b"


def any_word(words: list[str]) -> str:
    """Plain words as one pattern, grouped by first letter: fewer tries at each word start."""
    letters: dict[str, list[str]] = {}
    for w in words:
        letters.setdefault(w[0], []).append(w[1:])
    groups = [f"{c}(?:{'|'.join(rest)})" for c, rest in letters.items()]
    return r"(?<!\w)(?:" + "|".join(groups) + r")(?!\w)"


def constant(value: list | dict) -> Column:
    """A list or map of texts as one literal, folded when the plan is optimized."""
    kind = "map<string, string>" if isinstance(value, dict) else "array<string>"
    return F.from_json(F.lit(json.dumps(value)), kind)


def sub(col: Column, pattern: str, replacement: str, ignore_case: bool = False) -> Column:
    return F.regexp_replace(col, portable(pattern, ignore_case), replacement)


def matches(col: Column, pattern: str, ignore_case: bool = False) -> Column:
    return col.rlike(portable(pattern, ignore_case))


def split(col: Column, pattern: str, ignore_case: bool = False) -> Column:
    return F.split(col, portable(pattern, ignore_case))


def strip(col: Column) -> Column:
    """``str.strip``: Spark's ``trim`` alone only knows the blank. Looks at the ends, not at the whole text."""
    return F.btrim(col, F.lit(BLANKS))


def sub_where(col: Column, needle: str, pattern: str, replacement: str) -> Column:
    """``sub`` for a pattern that cannot match without ``needle``: a plain search decides first."""
    return bind(
        col,
        lambda s: F.when(F.contains(s, F.lit(needle)), sub(s, pattern, replacement)).otherwise(s),
    )


def bind(col: Column, fn) -> Column:
    """Evaluate ``col`` once and hand it to ``fn``, which may use it several times."""
    return F.transform(F.array(col), fn)[0]
