"""Packing by power-of-two decomposition: pieces of binary length, equal lengths in one bucket."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.ordered import encoded_in_order, total, with_base
from millrace.llm.texts import ID, binary_array
from millrace.sources.shared import materialize


def pack(docs: DataFrame, path: str, end_id: int = 2, max_length: int = 4096) -> DataFrame:
    """Cut every document's ids into pieces of power-of-two length, each a sequence of its own.

    A document of n ids (``end_id`` included) gives n // max_length full pieces and one piece for
    each binary digit of the rest, long ones first. No sequence crosses documents and none is
    padded. Returned per piece: ``doc_id, start, length, ids`` (binary, little-endian unsigned
    32-bit), ``doc_tokens, sequence_id`` (0, 1, ... by document and start), ``offset`` (0),
    ``bucket`` (log2 of the length) and ``bucket_index`` (0, 1, ... within the bucket), so that a
    batch is a run of indices of one bucket.

    Null texts count as empty: one piece with the end id. Rows of one doc_id are separate documents,
    ordered by text; null ids come first. Long texts are encoded whole. An empty table gives no rows. Extra columns are not read.
    """
    top = max_length.bit_length() - 1
    if max_length != 1 << top:
        raise ValueError("max_length must be a power of two")

    def counters(n: np.ndarray) -> np.ndarray:
        bits = [(n >> k) & 1 for k in range(top)]
        return np.stack([*bits, n >> top, n], axis=1)

    def emit(part: int):
        return lambda ids, offsets: [binary_array(ids, offsets)]

    rows = encoded_in_order(docs, path, end_id, emit, "ids binary", counters)
    rows = with_base(materialize(rows, "packed-ids"), top + 2)

    n = F.col("own")[top + 1]
    full, rest = n.bitwiseAND(F.lit(-max_length)), n.bitwiseAND(F.lit(max_length - 1))
    size = F.lit(max_length).cast("bigint")

    def piece(start, length, bucket, index):
        return F.struct(
            start.alias("start"), length.alias("length"), bucket.alias("bucket"), index.alias("bucket_index")
        )

    whole = F.transform(
        F.filter(F.sequence(F.lit(0), F.col("own")[top]), lambda i: i < F.col("own")[top]),
        lambda i: piece(i * size, size, F.lit(top), total(top) + i),
    )
    digits = F.filter(
        F.array(*[F.lit(k) for k in reversed(range(top))]),
        lambda k: F.get("own", k) == 1,
    )

    def digit(k):
        length = F.call_function("shiftleft", F.lit(1).cast("bigint"), k)
        higher = rest.bitwiseAND(-(length * 2))
        return piece(full + higher, length, k, total(k))

    pieces = F.concat(whole, F.transform(digits, digit))
    cut = F.transform(
        pieces,
        lambda p: F.struct(
            p["start"].alias("start"),
            p["length"].alias("length"),
            F.substring("ids", (p["start"] * 4 + 1).cast("int"), (p["length"] * 4).cast("int")).alias("ids"),
            p["bucket"].alias("bucket"),
            p["bucket_index"].alias("bucket_index"),
        ),
    )
    first = sum((total(k) for k in range(1, top + 1)), total(0))
    return rows.select(ID, n.alias("doc_tokens"), first.alias("_first"), F.posexplode(cut)).select(
        ID,
        "col.start",
        "col.length",
        "col.ids",
        "doc_tokens",
        (F.col("_first") + F.col("pos")).alias("sequence_id"),
        F.lit(0).cast("bigint").alias("offset"),
        "col.bucket",
        "col.bucket_index",
    )
