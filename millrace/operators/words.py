"""From texts to counted words, byte by byte."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed value: the published byte-level split pattern ------------------------------------------
# 's|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+
# with \s spelled out as the White_Space characters, which Java and the published one disagree on,
# and shaped for speed like the space class of the regex kit.
_WIDE = r"\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
_WHITE = (
    r"\t\n\x{0b}\f\r\x{20}\x{85}\x{a0}" + rf"[\x{{1680}}-\x{{3000}}&&[{_WIDE}]]"
)
PIECES = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+"
    rf"| ?[^{_WHITE}\p{{L}}\p{{N}}]+|[{_WHITE}]+(?![^{_WHITE}])|[{_WHITE}]+"
)


def byte_letters() -> str:
    """The letter that stands for each byte 0..255 in byte-level words.

    Bytes that are visible in Latin-1 stand for themselves; the others, in order, get the letters
    from U+0100 on.
    """
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in visible]
    table = {b: chr(b) for b in visible} | {b: chr(0x100 + i) for i, b in enumerate(hidden)}
    return "".join(table[b] for b in range(256))


_LATIN = "".join(map(chr, range(256)))


def to_letters(word: Column) -> Column:
    """UTF-8 bytes of a word, one letter per byte."""
    latin = F.decode(F.encode(word, "UTF-8"), "ISO-8859-1")
    return F.translate(latin, _LATIN, byte_letters())


def from_letters(letters: Column) -> Column:
    """Text of byte letters; bytes that are no UTF-8 become the replacement character."""
    table = byte_letters()
    latin = F.translate(letters, table[1:], _LATIN[1:])
    latin = F.replace(latin, F.lit(table[0]), F.lit("\0"))  # translate reads \0 as "delete"
    return F.make_valid_utf8(F.encode(latin, "ISO-8859-1").cast("string"))


def pretokenize(text: Column) -> Column:
    """Words of a text, each with its leading blank; joined, they give the text again."""
    return F.regexp_extract_all(text, F.lit(f"({PIECES})"), F.lit(1))


# ---- normalizer ---------------------------------------------------------------------------------


def _nfkc_stable() -> str:
    """Ranges of characters below U+0250 that no compatibility composition changes."""
    ranges, start = [], None
    for cp in range(0x251):
        ok = cp < 0x250 and unicodedata.is_normalized("NFKC", chr(cp))
        if ok and start is None:
            start = cp
        elif not ok and start is not None:
            ranges.append(rf"\x{{{start:x}}}-\x{{{cp - 1:x}}}")
            start = None
    return "".join(ranges)


def _nfkc(texts: pd.Series) -> pd.Series:
    return texts.map(lambda s: None if s is None else unicodedata.normalize("NFKC", s))


def nfkc_risky(text: Column) -> Column:
    """Does the text hold a character that NFKC may change? One anchored run over the text."""
    return ~text.rlike(rf"^[{_nfkc_stable()}]*+\z")


def nfkc(text: Column) -> Column:
    """Unicode NFKC. Spark has no function for it; texts of plain Latin letters skip Python."""
    changed = F.pandas_udf(_nfkc, "string")(F.when(nfkc_risky(text), text))
    return F.coalesce(changed, text)


def lowered(text: Column) -> Column:
    """Lower case by character: a capital sigma gives the same letter at a word's end as elsewhere."""
    return F.lower(F.replace(text, F.lit("Σ"), F.lit("σ")))


def normalize_text(text: Column, lower: bool = True, use_nfkc: bool = True) -> Column:
    if use_nfkc:
        text = nfkc(text)
    return lowered(text) if lower else text


# ---- counts -------------------------------------------------------------------------------------


def chunks(text: Column) -> Column:
    """A text cut before white space that follows something else: no word goes across such a place.

    Neither does a normal form: white space starts a new one, and no other character ends as white
    space. So the words of the chunks, normalized or not, are those of the text.
    """
    return F.split(text, rf"(?=[{_WHITE}])(?<=[^{_WHITE}])")


def word_counts(df: DataFrame, text: Column, normal: Callable[[Column], Column] = lambda c: c) -> DataFrame:
    """(word, n) of the texts, which ``normal`` normalizes by characters or by NFKC.

    Chunks are counted first, so that only distinct ones are normalized and searched for words. Both
    are counted inside each task first, so a frequent word stays one row each.
    """
    counted = df.select(F.explode(chunks(text)).alias("chunk")).groupBy("chunk").agg(F.count("*").alias("n"))
    words = counted.select(normal(F.col("chunk")).alias("chunk"), "n")
    return (
        words.select(F.explode(pretokenize(F.col("chunk"))).alias("word"), "n")
        .groupBy("word")
        .agg(F.sum("n").alias("n"))
    )


def byte_alphabet(words: DataFrame) -> DataFrame:
    """(letter, n): the byte letters that occur, weighted by word count. At most 256 rows."""
    letters = F.explode(F.split(to_letters(F.col("word")), ""))
    return (
        words.select(letters.alias("letter"), "n")
        .where("letter <> ''")
        .groupBy("letter")
        .agg(F.sum("n").alias("n"))
    )
