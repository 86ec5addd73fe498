"""Operators on one row's list of items. All stay within the row: no shuffle.

Whole lists of names are made by Arrow helpers, batch by batch, with the rules as plain Python (``names``).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.functions.items import (
    drop_parentheses,
    has_quantity,  # noqa: F401 - for those who ask this module
    is_plain,
    normalize_item,
    rewrite_rules,
)
from millrace.functions.names import best_displays, distinct_keys, shown_items
from millrace.functions.regex import bind, split, strip
from millrace.functions.text import collapse_commas

# A bracketed cell that JSON reads exactly as a Python literal would be read: quoted texts without
# a backslash other than \" or a \uXXXX outside the surrogates, or plain numbers.
# Possessive loops throughout: Java then needs no stack on long cells.
_DOUBLE = r'"(?:[^"\\\x00-\x1f]|\\"|\\u(?!0000|[dD][89a-fA-F])[0-9a-fA-F]{4})*+"'
_SINGLE = r"'[^'\\\x00-\x1f]*+'"
_NUMBER = r"(?:0|-?[1-9][0-9]{0,17})"
_ITEM = rf"(?:{_DOUBLE}|{_SINGLE}|{_NUMBER})"
PLAIN_LITERAL = rf"^\[ *+(?:{_ITEM} *+(?:, *+{_ITEM} *+)*+)?\]\z"


_PIECE = 1 << 22  # bytes of a batch that are Python objects at a time


def _pieces(columns: list[pa.Array]) -> Iterator[list[pa.Array]]:
    """Runs of rows of few bytes, or of one row."""
    n = len(columns[0])
    if n <= 1 or sum(c.nbytes for c in columns) <= _PIECE:
        yield columns
    else:
        for at, size in ((0, n // 2), (n // 2, n - n // 2)):
            yield from _pieces([c.slice(at, size) for c in columns])


def _values(column: pa.Array) -> Iterator[str | list[str | None] | None]:
    """The texts of a column, or its lists of texts."""
    if not pa.types.is_list(column.type):
        yield from column.to_numpy(zero_copy_only=False)
        return
    texts, end = column.flatten().to_numpy(zero_copy_only=False).tolist(), 0
    for size in column.value_lengths().to_pylist():
        yield None if size is None else texts[end : end + size]
        end += size or 0


def _by_row(fn: Callable, kind: str, *columns: Column) -> Column:
    """A plain function of a row's texts or lists, run over Arrow batches; several of them share a Python process."""
    of_kind = pa.string() if kind == "string" else pa.list_(pa.string())

    def run(*batch: pa.Array) -> pa.Array:
        return pa.concat_arrays([pa.array(list(map(fn, *map(_values, p))), of_kind) for p in _pieces(list(batch))])

    return F.arrow_udf(run, kind)(*columns)


def split_cell(col: Column) -> Column:
    """Parts of a cell between commas and semicolons; blank parts are left out."""
    # of a stripped text, the pattern leaves no white space at a part's ends
    return F.array_remove(split(strip(F.coalesce(col, F.lit(""))), r"\s*[;,]\s*"), "")


def is_bracketed(col: Column) -> Column:
    cell = strip(F.coalesce(col, F.lit("")))
    return cell.startswith("[") & cell.endswith("]")


def is_plain_literal(col: Column) -> Column:
    """Bracketed and simple enough for the native reader."""
    return strip(col).rlike(PLAIN_LITERAL)


def read_plain_literal(col: Column) -> Column:
    items = F.from_json(strip(col), "array<string>", {"allowSingleQuotes": "true"})
    return F.filter(F.transform(items, strip), lambda x: x != "")


def split_alternatives(col: Column) -> Column:
    """Split at " or ", " | " and at a slash that stands between no digits."""
    text = strip(F.coalesce(col, F.lit("")))
    parts = split(text, r"\s+(?:or|\|)\s+|(?<!\d)\s*/\s*(?!\d)", ignore_case=True)
    # plain searches tell if there is anything to split at
    signs = F.contains(text, F.lit("/")) | F.contains(text, F.lit("|"))
    parts = F.when(signs | F.contains(F.lower(text), F.lit("or")), parts).otherwise(F.array(text))
    return F.filter(F.transform(parts, strip), lambda x: x != "")


def _alternatives_or_self(item: Column) -> Column:
    parts = bind(
        drop_parentheses(rewrite_rules(item)),
        lambda s: bind(
            split_alternatives(s),
            lambda parts: F.when(F.size(parts) > 0, parts).otherwise(F.array(strip(s))),
        ),
    )
    return F.when(is_plain(item), F.array(item)).otherwise(parts)


def expand_items(items: Column) -> Column:
    """Every item replaced by its alternatives, order kept."""
    return F.filter(F.flatten(F.transform(items, _alternatives_or_self)), lambda x: x != "")


def _keys(items: list[str | None] | None) -> list[str] | None:
    return None if items is None else distinct_keys(items)


def normalized_set(items: Column) -> Column:
    """Distinct non-empty keys of a list of items, in order of first appearance."""
    return _by_row(_keys, "array<string>", items)


def merge_sets(first: Column, second: Column, mode: str = "union") -> Column:
    """Merge two key sets and sort. Any unknown mode means "first list only"."""
    if mode == "union":
        merged = F.array_union(first, second)
    elif mode == "intersection":
        merged = F.array_intersect(first, second)
    elif mode == "ner_only":
        merged = F.array_distinct(second)
    else:
        merged = F.array_distinct(first)
    return F.sort_array(F.array_except(merged, F.array(F.lit(""), F.lit(None))))


def _heads(rows: Column) -> Column:
    """First row of every run of equal keys in a sorted list."""
    return bind(
        rows,
        lambda rs: F.filter(
            rs, lambda r, i: ~F.get(rs, i - 1)["key"].eqNullSafe(r["key"])
        ),
    )


def _by_first_seen(rows: Column) -> Column:
    """First row per key as (pos, item), sorted by key."""
    return _heads(
        F.array_sort(
            F.transform(rows, lambda r: F.struct(r["key"], r["pos"], r["item"]))
        )
    )


def dedup_best_display(col: Column) -> Column:
    """One item per key: the one with a quantity, then the longest, then the first."""
    return _by_row(best_displays, "string", col)


def dedup_keep_first(col: Column) -> Column:
    """One item per key: the first. All items without a key share the empty key."""
    parts = F.filter(F.transform(F.split(col, ","), strip), lambda x: x != "")
    rows = F.transform(
        parts,
        lambda x, i: F.struct(normalize_item(x).alias("key"), i.alias("pos"), x.alias("item")),
    )
    kept = F.transform(_by_first_seen(rows), lambda r: F.struct(r["pos"], r["item"]))
    return F.array_join(F.transform(F.array_sort(kept), lambda r: r["item"]), ", ")


def build_input(items: Column, second: Column, mode: str = "union") -> Column:
    """The whole way from two item lists to one input text.

    A last pass that keeps the first item of each key would change nothing: the best-display pass
    leaves exactly one item per key.
    """
    merged = merge_sets(normalized_set(items), normalized_set(second), mode)
    return F.lower(dedup_best_display(F.array_join(merged, ", ")))


def _displays(items: list[str | None] | None, second: list[str | None] | None) -> list[str] | None:
    return None if items is None or second is None else shown_items(items, second)


def merge_keep_display(items: Column, second: Column) -> Column:
    """Like :func:`build_input` in union mode, but items keep their quantities.

    Opt-in: no flag of :func:`build_input` leads here. Items of the second list only come in if the
    first has no item of that key, and are then shown as their key.
    """
    shown = _by_row(_displays, "array<string>", items, second)
    return F.lower(dedup_best_display(collapse_commas(F.array_join(shown, ", "))))
