"""Token counts by offset-mapped attribution: a document is encoded once, its tokens go to sections."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.encoder import WordEncoder
from millrace.llm.spans import running as running_sums
from millrace.llm.texts import ID, TEXT, id_type, small, text_array

RULES = ("start", "majority")
SECTIONS = "array<struct<name:string,start:bigint,end:bigint>>"
_ENCODERS: dict[str, WordEncoder] = {}


def windows(text: Column, size: int) -> Column:
    """Sections of ``size`` code points; the last may be shorter, an empty text has one empty section."""
    last = F.floor((F.greatest(F.char_length(text), F.lit(1)) - 1) / size).cast("bigint")
    return F.transform(
        F.sequence(F.lit(0).cast("bigint"), last),
        lambda i: F.struct(
            F.lit("window").alias("name"),
            (i * size).alias("start"),
            F.least((i + 1) * size, F.char_length(text).cast("bigint")).alias("end"),
        ),
    )


def lines(text: Column) -> Column:
    """Sections of one line each, without the line ends."""
    parts = F.split(text, "\n")
    begins = running_sums(F.transform(parts, lambda x: F.char_length(x) + 1))
    return F.zip_with(
        begins,
        parts,
        lambda s, x: F.struct(F.lit("line").alias("name"), s.alias("start"), (s + F.char_length(x)).alias("end")),
    )


def assign(spans: np.ndarray, starts: np.ndarray, ends: np.ndarray, rule: str) -> np.ndarray:
    """Index of the section of every token; all positions on one axis, sections sorted and disjoint.

    A token belongs to the section with its first character ("start") or with most of its
    characters, the earlier one at a tie ("majority"). A token that touches no section goes to the
    last one that starts before it, or the first.
    """
    first = np.maximum(np.searchsorted(starts, spans[:, 0], side="right") - 1, 0)
    if rule == "start":
        return first
    last = np.maximum(np.searchsorted(starts, spans[:, 1] - 1, side="right") - 1, first)
    best = first.copy()
    most = np.minimum(spans[:, 1], ends[first]) - np.maximum(spans[:, 0], starts[first])
    open_ = np.flatnonzero(last > first)
    step = 1
    while len(open_):  # tokens that go on over another boundary
        section = first[open_] + step
        here = np.minimum(spans[open_, 1], ends[section]) - np.maximum(spans[open_, 0], starts[section])
        better = here > np.maximum(most[open_], 0)
        best[open_[better]] = section[better]
        most[open_] = np.maximum(most[open_], here)
        step += 1
        open_ = open_[last[open_] >= first[open_] + step]
    return best


def section_tokens(docs: DataFrame, sections: Column, path: str, rule: str = "majority") -> DataFrame:
    """Tokens of every section: ``doc_id, section`` (0, 1, ...), ``name, start, end, n_tokens`` and
    ``n_crossing``, the tokens of it that also lie in other sections.

    ``sections`` gives a text's sections (``windows``, ``lines`` or any sorted, disjoint spans in
    code points). Every token is counted in exactly one section, so counts add up to the document's
    length in tokens. Sections are joined to tokens by position inside the document's row: nothing
    is shuffled. Null texts count as empty, long ones are encoded whole; documents without sections
    give no rows, and so does an empty table; rows of one id are counted one by one. Extra columns are
    not read.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    rows = docs.select(F.col(ID), F.coalesce(F.col(TEXT), F.lit("")).alias(TEXT))
    rows = rows.select(ID, TEXT, sections.cast(SECTIONS).alias("sections"))
    schema = f"{ID} {id_type(rows)}, section bigint, name string, start bigint, end bigint, n_tokens bigint, n_crossing bigint"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _ENCODERS:
            _ENCODERS[path] = WordEncoder(path, spans=True)
        for batch in small(batches):
            texts = text_array(batch.column(TEXT))
            spans, offsets, chars = _ENCODERS[path].encode_spans(texts)
            column = batch.column("sections")
            flat, counts = column.flatten(), np.diff(column.offsets.to_numpy())
            if not len(flat):
                continue
            names, begin, end = (flat.field(k) for k in range(3))
            # lay all documents on one axis, a gap between them
            base = np.concatenate([[0], np.cumsum(chars + 1)])[:-1]
            shift = np.repeat(base, counts)
            starts, ends = begin.to_numpy() + shift, end.to_numpy() + shift
            has = np.repeat(counts > 0, np.diff(offsets))
            spans = (spans + np.repeat(base, np.diff(offsets))[:, None])[has]
            owner = assign(spans, starts, ends, rule)
            # a token before its document's first section would fall to the document before
            least = np.repeat(np.cumsum(counts) - counts, np.diff(offsets))[has]
            owner = np.maximum(owner, least)
            crossing = (spans[:, 0] < starts[owner]) | (spans[:, 1] > ends[owner])
            n = np.bincount(owner, minlength=len(starts))
            over = np.bincount(owner[crossing], minlength=len(starts))
            doc = np.repeat(np.arange(len(texts)), counts)
            number = np.arange(len(starts)) - np.repeat(np.cumsum(counts) - counts, counts)
            yield pa.RecordBatch.from_arrays(
                [batch.column(ID).take(pa.array(doc)), *map(pa.array, (number, names, begin, end, n, over))],
                schema=out,
            )

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    out = to_arrow_schema(StructType.fromDDL(schema))
    return rows.mapInArrow(run, schema)
