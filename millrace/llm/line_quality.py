"""Quality rules, line first: drop failing lines, then reject documents that lose too much text."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.once import with_once
from millrace.llm.texts import ID, TEXT, id_text, whole_rows

# --- fixed values: word characters, symbols and the line rules' lists ------------------------------
BLANKS = " \t\n\x0b\f\r"
WORD = r"[^\x20\x09-\x0D]"
SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
SEPARATORS = "|<>•·›"
MARKS = r"[|<>•·›#*$%&]"
PUNCTUATION = r"[,.;:!?…。、！？]"
# without their first letters, which may be capitals
BOILERPLATE = (
    "ll rights reserved",
    "rivacy policy",
    "erms of use",
    "erms of service",
    "avaScript",
    "orem ipsum",
    "lick here",
    "ubscribe to our",
)
ORDINARY = r"[$#]\p{N}|\p{N}\x20?[%$]|\p{L}&\p{L}|(?<=[\p{L}.]\x20)&(?=\x20\p{L})"  # $50, #1, 5%, AT&T, Marks & Spencer
# a line fails from so many marks on, where more than one word in so many carries one; characters it
# may have for each bang, how long a line without punctuation may be, and one that is boilerplate
LEAST_MARKS, PER_MARK, PER_BANG, BARE, SHORT = 3, 10, 60, 60, 120


def _count(text: Column, characters: str) -> Column:
    return F.char_length(text) - F.char_length(F.translate(text, characters, ""))


def words_of(text: Column) -> Column:
    """Maximal runs of non-blank characters."""
    inner = F.trim(text, F.lit(BLANKS))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, SPACE))


def _windows(hashes: Column) -> Column:
    """Hashes of all 5-word windows, from the words' hashes."""
    n = F.size(hashes)
    following = [lambda i, k=k: F.get(hashes, i + k) for k in range(1, 5)]
    return F.transform(
        F.slice(hashes, 1, F.greatest(n - 4, F.lit(0))),
        lambda h, i: F.xxhash64(h, *[f(i) for f in following]),
    )


def _holds_boilerplate(text: Column) -> Column:
    return reduce(or_, [F.contains(text, F.lit(p)) for p in BOILERPLATE])


def _line_fails(line: Column, marks: Column, boilerplate: Column) -> Column:
    """The rules for one line; ``marks`` and ``boilerplate``: what its document holds at all."""
    size = F.char_length(line)
    plain = F.regexp_replace(line, ORDINARY, "")
    carry = F.size(F.filter(words_of(plain), lambda w: w.rlike(MARKS)))
    many = _count(plain, SEPARATORS) + _count(plain, SYMBOLS.replace("|", "").replace("<", "").replace(">", ""))
    odd = (many >= LEAST_MARKS) & (carry * PER_MARK > F.size(words_of(line)))
    return (
        F.when(~line.rlike(WORD), False)
        .when(marks & odd, True)
        .when(line.contains("!!"), (_count(line, "!") * PER_BANG > size) & ~line.rlike(r"\p{Ll}"))
        .when((size > BARE) & ~line.rlike(PUNCTUATION), True)
        .when(boilerplate & (size <= SHORT), _holds_boilerplate(line))
        .otherwise(False)
    )


def clean_lines(
    docs: DataFrame,
    min_kept: float = 0.5,
    min_words: int = 10,
    max_repeat: int = 20,
    keep: bool = False,
) -> DataFrame:
    """Clean every text line by line and judge the document by what is left.

    Returned per row: ``doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words``
    (5-word windows by 64-bit hash), ``base_failed, clean_text`` (lines that pass; blank lines stay),
    ``kept_chars`` (word characters in it) and ``kept``: not base_failed, and at least ``min_kept``
    of the word characters stayed. A line fails if separators (navigation) or symbols take the place
    of prose, if it shouts, if it is long and has no punctuation, or is short and holds a boilerplate
    phrase. Sums of money, shares and names such as "Marks & Spencer" are prose.

    Null and empty texts have no words: counts 0, base_failed, not kept. Long texts are judged whole.
    Repeated rows are judged one by one, null ids are ids like others, an empty table gives no rows; no
    row is shuffled. Extra columns are not read; with ``keep`` the whole row comes
    along as ``doc``.
    """
    text = F.col(TEXT)
    source, ids = (id_text(docs), [ID]) if not keep else (whole_rows(docs), [ID, "doc"])
    lines = F.split(text, "\n")
    rows = with_once(
        source,
        ids,
        words=words_of(text),
        lines=lines,
        marks=text.rlike(MARKS),
        boilerplate=_holds_boilerplate(text),
        n_symbols=F.when(text.rlike(MARKS), _count(text, SYMBOLS)).otherwise(0),
    )
    full = F.filter("lines", lambda x: x.rlike(WORD))
    passed = F.filter("lines", lambda x: ~_line_fails(x, F.col("marks"), F.col("boilerplate")))
    rows = with_once(
        rows,
        [*ids, "n_symbols"],
        n_words=F.size("words"),
        word_chars=F.char_length(F.array_join("words", "")),
        n_dup_lines=F.size(full) - F.size(F.array_distinct(full)),
        hashes=F.transform("words", lambda w: F.xxhash64(w)),
        all_lines=F.size("lines"),
        passed=passed,
    )
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines"]
    clean = F.array_join("passed", "\n")
    kept_chars = F.when(F.size("passed") == F.col("all_lines"), F.col("word_chars")).otherwise(
        F.char_length(F.translate(clean, BLANKS, ""))
    )
    rows = with_once(
        rows, [*ids, *counts], clean_text=clean, kept_chars=kept_chars, windows=_windows(F.col("hashes"))
    )
    # only texts in which a window occurs twice are sorted
    twice = F.size("windows") > F.size(F.array_distinct("windows"))
    pair = lambda h, i: F.struct(h.alias("h"), i.alias("i"))
    ordered = F.when(twice, F.sort_array(F.transform("windows", pair)))
    rows = with_once(rows, [*ids, *counts, "clean_text", "kept_chars"], ordered=ordered)
    o = F.col("ordered")
    again = F.filter(
        o,
        lambda x, j: (F.get(o, j - 1)["h"].eqNullSafe(x["h"]))
        | (F.get(o, j + 1)["h"].eqNullSafe(x["h"])),
    )
    rows = with_once(
        rows,
        [*ids, *counts, "clean_text", "kept_chars"],
        at=F.sort_array(F.transform(again, lambda x: x["i"])),
    )
    at = F.col("at")
    covered = F.aggregate(
        F.transform(at, lambda p, j: F.least(F.lit(5), F.coalesce(F.get(at, j + 1) - p, F.lit(5)))),
        F.lit(0),
        lambda a, v: a + v,
    )
    repeat = F.coalesce(covered, F.lit(0)).cast("bigint")
    rows = rows.select(
        *ids,
        *[F.col(c).cast("bigint").alias(c) for c in counts],
        repeat.alias("n_repeat_words"),
        "clean_text",
        F.col("kept_chars").cast("bigint").alias("kept_chars"),
    )
    failed = (F.col("n_words") < min_words) | (
        100 * F.col("n_repeat_words") > max_repeat * F.col("n_words")
    )
    enough = F.col("kept_chars") >= min_kept * F.col("word_chars")
    return rows.withColumn("base_failed", failed).withColumn("kept", ~failed & enough)
