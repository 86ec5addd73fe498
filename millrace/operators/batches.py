"""Batches, padding and shifting of token arrays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.functions.rules import IGNORED_TARGET, PAD
from millrace.operators.encode import at_least_two
from millrace.operators.numbering import number_by_id, number_shuffled

def assign_batches(
    df: DataFrame, size: int, seed: int | None = None, epoch: int = 0, id_col: str = "row_id"
) -> DataFrame:
    """Add ``batch_id`` and ``pos``: consecutive groups of ``size`` rows; the last may be short.

    With a seed (training) the order is shuffled anew per epoch, without one (validation) it is the
    order of the ids.
    """
    if seed is None:
        numbered = number_by_id(df, id_col)
    else:
        numbered = number_shuffled(df, f"{seed}-{epoch}", id_col)
    idx = F.col("idx")
    return numbered.withColumns(
        {"batch_id": F.floor(idx / size).cast("bigint"), "pos": (idx % size).cast("int")}
    ).drop("idx")


# ---- padding ------------------------------------------------------------------------------------


def _longest(ids: str, batch: str) -> Column:
    """Longest list of the batch; a batch holds a fixed small number of rows."""
    return F.max(F.size(ids)).over(W.partitionBy(batch))


def pad_batch(
    df: DataFrame,
    ids: str = "ids",
    batch: str = "batch_id",
    pad_to: int | None = None,
    left: bool = False,
    pad: int = PAD,
) -> DataFrame:
    """Add ``input_ids`` and ``mask``, padded to the longest list of the batch or to ``pad_to``.

    A list longer than ``pad_to`` stays as it is.
    """
    to = _longest(ids, batch) if pad_to is None else F.lit(pad_to)
    df = df.withColumn("_gap", F.greatest(F.lit(0), to - F.size(ids)))
    gap, real = F.col("_gap"), F.array_repeat(F.lit(1), F.size(ids))
    pads, zeros = F.array_repeat(F.lit(pad), gap), F.array_repeat(F.lit(0), gap)
    if left:
        columns = {"input_ids": F.concat(pads, ids), "mask": F.concat(zeros, real)}
    else:
        columns = {"input_ids": F.concat(ids, pads), "mask": F.concat(real, zeros)}
    return df.withColumns(columns).drop("_gap")


def shift_mask(
    df: DataFrame, ids: str = "ids", batch: str = "batch_id", pad: int = PAD
) -> DataFrame:
    """Add ``x`` (all but the last id) and ``y`` (all but the first, pads ignored) per batch."""
    df = df.withColumn("_ids", at_least_two(F.col(ids), pad))
    df = pad_batch(df, "_ids", batch, pad=pad)
    full = F.col("input_ids")
    size = F.size(full) - 1
    targets = F.slice(full, F.lit(2), size)
    return df.withColumns(
        {
            "x": F.slice(full, F.lit(1), size),
            "y": F.transform(
                targets, lambda t: F.when(t == pad, F.lit(IGNORED_TARGET)).otherwise(t)
            ),
        }
    ).drop("_ids", "input_ids", "mask")


def token_stats(
    df: DataFrame, group: str, batch_size: int, max_len: int, ids: str = "ids"
) -> DataFrame:
    """Token totals of encoded, not yet truncated rows, by group.

    ``approx_tokens`` is the usual estimate from batch count, batch size and width; the others are
    exact: predicted tokens, rows that lose ids, and the share of padding at full width.
    """
    size = F.size(ids)
    kept = F.least(size, F.lit(max_len))
    n = F.count("*")
    return df.groupBy(group).agg(
        n.alias("samples"),
        F.sum((kept - 1).cast("bigint")).alias("tokens"),
        (F.ceil(n / batch_size) * batch_size * (F.max(kept) - 2)).cast("bigint").alias(
            "approx_tokens"
        ),
        F.avg((size > max_len).cast("int")).alias("truncated_share"),
        (1 - F.sum(kept) / (n * F.max(kept))).alias("pad_share"),
    )
