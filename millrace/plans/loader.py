"""Cached ids, or texts, to padded batches."""

from __future__ import annotations

from pyspark.sql import DataFrame

from millrace.operators.batches import assign_batches, pad_batch, shift_mask
from millrace.operators.bpe import Vocabulary
from millrace.operators.encode import encode_corpus


def training_batches(cached: DataFrame, size: int = 256, seed: int = 42, epoch: int = 0) -> DataFrame:
    """(batch_id, pos, x, y) in the shuffled order of an epoch."""
    return shift_mask(assign_batches(cached, size, seed, epoch)).select("batch_id", "pos", "x", "y")


def validation_batches(cached: DataFrame, size: int = 256) -> DataFrame:
    """(batch_id, pos, x, y) in the order of the row ids."""
    return shift_mask(assign_batches(cached, size)).select("batch_id", "pos", "x", "y")


def encode_batch(
    texts: DataFrame,
    vocab: Vocabulary,
    size: int,
    text_col: str = "text",
    add_special: bool = True,
    max_len: int | None = None,
    pad_to: int | None = None,
    left: bool = False,
) -> DataFrame:
    """(row_id, batch_id, pos, input_ids, mask) of texts in the order of their ids."""
    ids = encode_corpus(texts, text_col, vocab, add_special, max_len)
    padded = pad_batch(assign_batches(ids, size), pad_to=pad_to, left=left)
    return padded.select("row_id", "batch_id", "pos", "input_ids", "mask")
