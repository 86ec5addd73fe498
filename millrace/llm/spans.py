"""Spans of pattern matches as columns, without Python: positions are code points, ends exclusive."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_BLOCK = 256
SPAN = "array<struct<kind:string,start:int,end:int,match:string>>"


def _scan(values: Column, start: Column) -> Column:
    """start, start + v0, start + v0 + v1, ... (one more than there are values)."""
    return F.aggregate(
        values,
        F.array(start),
        lambda acc, v: F.concat(acc, F.array(F.element_at(acc, -1) + v)),
    )


def running(values: Column) -> Column:
    """Sums of the ints before each position, block by block, so that a step copies few numbers."""
    zero = F.lit(0)
    blocks = F.transform(
        F.sequence(zero, F.floor((F.size(values) - 1) / _BLOCK).cast("int")),
        lambda b: F.slice(values, b * _BLOCK + 1, F.lit(_BLOCK)),
    )
    sums = F.transform(blocks, lambda x: F.aggregate(x, zero, lambda a, v: a + v))
    parts = F.zip_with(
        blocks,
        F.slice(_scan(sums, zero), 1, F.size(sums)),
        lambda x, s: F.slice(_scan(x, s), 1, F.size(x)),
    )
    return F.when(F.size(values) > 0, F.flatten(parts)).otherwise(F.array().cast("array<int>"))


def matches(text: Column, pattern: str, kind: str, gate: Column) -> Column:
    """Leftmost non-overlapping matches as (kind, start, end, match).

    ``gate`` is a cheap test that holds for every text with a match worth keeping; other texts give
    an empty array without running the pattern. Matches and what lies between them come from the
    same search, so their lengths give the positions.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.split(text, pattern, -1)
    steps = F.zip_with(
        F.slice(between, 1, F.size(found)), found, lambda g, m: F.char_length(g) + F.char_length(m)
    )
    ends = F.zip_with(running(steps), steps, lambda before, step: before + step)
    spans = F.zip_with(
        found,
        ends,
        lambda m, e: F.struct(
            F.lit(kind).alias("kind"), (e - F.char_length(m)).alias("start"), e.alias("end"), m.alias("match")
        ),
    )
    return F.when(gate, spans).otherwise(F.array().cast(SPAN))


def in_order(spans: Column, kinds: list[str]) -> Column:
    """Sorted by start, then kind as listed, then end."""
    place = F.array(*[F.lit(k) for k in kinds])
    return F.array_sort(
        F.transform(
            spans,
            lambda s: F.struct(
                s["start"].alias("start"),
                F.array_position(place, s["kind"]).alias("place"),
                s["end"].alias("end"),
                s["kind"].alias("kind"),
            ),
        )
    )
