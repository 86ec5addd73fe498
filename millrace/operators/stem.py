"""The Porter stemmer (1980) with the usual extensions, as a table of suffix rules.

A small helper for the scoring tasks: it only ever sees distinct words.
"""

from __future__ import annotations

import re

# --- fixed values: words that stem to themselves or irregularly ----------------------------------
IRREGULAR = {
    "sky": "sky", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie",
    "news": "news", "innings": "inning", "inning": "inning", "outings": "outing",
    "outing": "outing", "cannings": "canning", "canning": "canning", "howe": "howe",
    "proceed": "proceed", "exceed": "exceed", "succeed": "succeed",
}

# --- fixed values: suffix rules of steps 2 to 4 ---------------------------------------------------
STEP_2 = [
    ("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"), ("izer", "ize"),
    ("bli", "ble"), ("alli", "al"), ("entli", "ent"), ("eli", "e"), ("ousli", "ous"),
    ("ization", "ize"), ("ation", "ate"), ("ator", "ate"), ("alism", "al"), ("iveness", "ive"),
    ("fulness", "ful"), ("ousness", "ous"), ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble"),
    ("fulli", "ful"),
]
STEP_3 = [
    ("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"),
    ("ful", ""), ("ness", ""),
]
STEP_4 = [
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion", "ou",
    "ism", "ate", "iti", "ous", "ive", "ize",
]


def _shape(stem: str) -> str:
    """"c" and "v" per letter. A y is a vowel unless it is first or follows a vowel."""
    out = ""
    for i, ch in enumerate(stem):
        vowel = ch in "aeiou" or (ch == "y" and i > 0 and out[-1] == "c")
        out += "v" if vowel else "c"
    return out


def _measure(stem: str) -> int:
    return len(re.findall("v+c", _shape(stem)))


def _has_vowel(stem: str) -> bool:
    return "v" in _shape(stem)


def _double(word: str) -> bool:
    return len(word) > 1 and word[-1] == word[-2] and _shape(word)[-1] == "c"


def _short(word: str) -> bool:
    """Ends consonant, vowel, consonant (not w, x, y); or is a vowel and a consonant."""
    shape = _shape(word)
    return (len(word) > 2 and shape.endswith("cvc") and word[-1] not in "wxy") or shape == "vc"


def _swap(word: str, rules, least: int) -> str:
    """First rule whose suffix fits decides, whether or not its condition holds."""
    for suffix, new in rules:
        if word.endswith(suffix):
            head = word[: -len(suffix)]
            return head + new if _measure(head) > least else word
    return word


def _plural(w: str) -> str:
    if w.endswith("ies") and len(w) == 4:
        return w[:-1]
    for suffix, new in (("sses", "ss"), ("ies", "i"), ("ss", "ss"), ("s", "")):
        if w.endswith(suffix):
            return w[: -len(suffix)] + new
    return w


def _past(w: str) -> str:
    if w.endswith("ied"):
        return w[:-1] if len(w) == 4 else w[:-2]
    if w.endswith("eed"):
        return w[:-1] if _measure(w[:-3]) > 0 else w
    for suffix in ("ed", "ing"):
        head = w[: -len(suffix)]
        if w.endswith(suffix) and _has_vowel(head):
            break
    else:
        return w
    if head.endswith(("at", "bl", "iz")):
        return head + "e"
    if _double(head):
        return head if head[-1] in "lsz" else head[:-1]
    return head + "e" if _measure(head) == 1 and _short(head) else head


def _final_y(w: str) -> str:
    if w.endswith("y") and len(w) > 2 and _shape(w[:-1])[-1] == "c":
        return w[:-1] + "i"
    return w


def _step_2(w: str) -> str:
    if w.endswith("alli") and _measure(w[:-4]) > 0:
        return _step_2(w[:-4] + "al")
    if w.endswith("logi") and not w.endswith(tuple(s for s, _ in STEP_2)):
        return w[:-1] if _measure(w[:-3]) > 0 else w
    return _swap(w, STEP_2, 0)


def _step_4(w: str) -> str:
    for suffix in STEP_4:
        if w.endswith(suffix):
            head = w[: -len(suffix)]
            good = _measure(head) > 1 and (suffix != "ion" or head[-1:] in ("s", "t"))
            return head if good else w
    return w


def _final_e(w: str) -> str:
    if w.endswith("e"):
        m = _measure(w[:-1])
        if m > 1 or (m == 1 and not _short(w[:-1])):
            return w[:-1]
    return w


def stem(word: str) -> str:
    if word in IRREGULAR:
        return IRREGULAR[word]
    if len(word) <= 2:
        return word
    w = _final_y(_past(_plural(word)))
    w = _step_4(_swap(_step_2(w), STEP_3, 0))
    w = _final_e(w)
    return w[:-1] if w.endswith("ll") and _measure(w[:-1]) > 1 else w
