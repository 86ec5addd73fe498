"""Encode documents in the order of their ids, with running counts that need no task to see all rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.llm.encoder import WordEncoder
from millrace.llm.texts import ID, TEXT, id_text, id_type, running, small, text_array

_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """One encoder a worker process: later tasks find the words of earlier ones."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def encoded_in_order(
    docs: DataFrame,
    path: str,
    end_id: int,
    emit: Callable,
    columns: str,
    counters: Callable[[np.ndarray], np.ndarray] = lambda n: n[:, None],
) -> DataFrame:
    """Range-partition ``docs`` by id, encode each partition in order, and let ``emit`` make columns.

    ``emit(part)`` gives a function from (ids, offsets) of a batch, end ids included, to its columns.
    ``counters`` turns the documents' lengths into rows of counts; ``own`` has a document's counts,
    ``before`` those of the documents before it in its partition ``part`` (see ``with_base``).
    Rows of one id are ordered by their texts.
    """
    rows = id_text(docs)
    schema = f"{ID} {id_type(rows)}, part int, {columns}, own array<bigint>, before array<bigint>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        encode, make, seen = encoder(path).encode, emit(part), 0
        for batch in small(batches):
            texts = text_array(batch.column(TEXT))
            ids, offsets = encode(texts)
            n = np.diff(offsets) + 1
            ids = np.insert(ids, offsets[1:], end_id)
            offsets = running(n)
            own = np.asarray(counters(n), np.int64)
            sums = np.cumsum(own, axis=0) + seen
            before, seen = sums - own, sums[-1]
            width = np.arange(len(n) + 1, dtype=np.int32) * own.shape[1]
            lists = [
                pa.ListArray.from_arrays(pa.array(width), pa.array(x.ravel())) for x in (own, before)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(ID), pa.array(np.full(len(n), part, np.int32)), *make(ids, offsets), *lists],
                names=[ID, "part", *names, "own", "before"],
            )
        if hasattr(make, "close"):
            make.close()

    names = [c.split()[0] for c in columns.split(",")]
    ordered = rows.repartitionByRange(ID).sortWithinPartitions(ID, TEXT)
    return ordered.mapInArrow(run, schema)


def with_base(rows: DataFrame, width: int) -> DataFrame:
    """Add ``base``: the counts of all partitions before, to be added to ``before``.

    One row a partition goes through the window and the broadcast: the bound is the number of tasks.
    """
    sums = rows.groupBy("part").agg(*[F.sum(F.col("own")[k]).alias(f"c{k}") for k in range(width)])
    w = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    base = F.array(*[F.coalesce(F.sum(f"c{k}").over(w), F.lit(0)) for k in range(width)])
    return rows.join(F.broadcast(sums.select("part", base.alias("base"))), "part")


def total(k: int | Column) -> Column:
    return F.get("base", k if isinstance(k, Column) else F.lit(k)) + F.get(
        "before", k if isinstance(k, Column) else F.lit(k)
    )
