"""What the operators share: the two columns they read, and Arrow helpers for tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ID, TEXT = "doc_id", "text"


def id_text(docs: DataFrame, id_col: str = ID, text_col: str = TEXT) -> DataFrame:
    """Only the id and the text (null: empty). Other columns, whatever their names, go no further."""
    return docs.select(
        F.col(f"`{id_col}`").alias(ID), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias(TEXT)
    )


def whole_rows(docs: DataFrame) -> DataFrame:
    """Id, text (null: empty) and the whole row as ``doc``, so that names of its columns cannot clash."""
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    return docs.select(whole.alias("doc")).select(
        F.col(f"doc.{ID}").alias(ID), F.coalesce(f"doc.{TEXT}", F.lit("")).alias(TEXT), "doc"
    )


def id_type(docs: DataFrame) -> str:
    return docs.schema[ID].dataType.simpleString()


def joined_spans(spans: Column) -> Column:
    """``kind:start:end`` of every span, comma-joined."""
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(
                ":", s["kind"], s["start"].cast("string"), s["end"].cast("string")
            ),
        ),
        ",",
    )


def text_array(column: pa.Array) -> pa.Array:
    """A text column as one array that starts at offset 0 of its buffers."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.type != pa.string():
        column = column.cast(pa.string())
    if column.null_count:
        column = column.fill_null("")
    return column if column.offset == 0 else column.take(pa.array(np.arange(len(column))))


def small(batches: Iterator[pa.RecordBatch], limit: int = 6 << 20) -> Iterator[pa.RecordBatch]:
    """The rows of the batches in runs of about ``limit`` bytes of text: what a task works on at once."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, off = raw(text_array(batch.column(TEXT)))
        start = 0
        while start < batch.num_rows:
            stop = int(np.searchsorted(off, off[start] + limit, side="right")) - 1
            stop = min(max(stop, start + 1), batch.num_rows)
            yield batch.slice(start, stop - start)
            start = stop


def raw(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, byte offsets) of a text array."""
    _, offsets, data = texts.buffers()
    off = np.frombuffer(offsets, np.int32, len(texts) + 1) if offsets else np.zeros(1, np.int32)
    size = int(off[-1])
    return (np.frombuffer(data, np.uint8, size) if size else np.zeros(0, np.uint8)), off


def binary_array(words: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Rows of little-endian unsigned 32-bit numbers as binaries, without copying."""
    off = (offsets * 4).astype(np.int32)
    return pa.Array.from_buffers(
        pa.binary(),
        len(off) - 1,
        [None, pa.py_buffer(off), pa.py_buffer(np.ascontiguousarray(words, dtype="<u4"))],
    )


def gather(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices of the runs ``start .. start + length``, one after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(total)


def gathered(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, step: int = 1 << 20) -> np.ndarray:
    """``data[gather(starts, lengths)]``, with the indices of about ``step`` elements at a time."""
    ends = np.cumsum(lengths)
    cuts = np.unique(np.searchsorted(ends, np.arange(step, int(ends[-1]) if len(ends) else 0, step)))
    cuts = [0, *cuts.tolist(), len(lengths)]
    parts = [data[gather(starts[a:b], lengths[a:b])] for a, b in zip(cuts, cuts[1:]) if a < b]
    return np.concatenate(parts) if parts else data[:0]


def running(counts: np.ndarray) -> np.ndarray:
    """0, c0, c0 + c1, ..."""
    out = np.zeros(len(counts) + 1, np.int64)
    np.cumsum(counts, out=out[1:])
    return out
