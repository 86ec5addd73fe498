"""Processed rows to a vocabulary, and to cached token arrays."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.once import with_once
from millrace.functions.rules import PAD
from millrace.functions.text import corpus_text, sample_text
from millrace.operators.bpe import Vocabulary, train_bpe
from millrace.operators.encode import at_least_two, encode_corpus
from millrace.operators.numbering import first_n
from millrace.operators.words import normalize_text, word_counts
from millrace.sources.files import SPLITS, write_token_cache


def corpus(
    rows: DataFrame,
    splits: tuple[str, ...] = ("train",),
    fields: tuple[str, ...] = ("ingredients", "recipe", "title"),
    sample_limit: int = 0,
) -> DataFrame:
    """(row_id, text) of the rows a vocabulary is learned from; the limit counts across splits."""
    texts = with_once(
        rows.where(F.col("split").isin(*splits)),
        ["row_id", "split"],
        text=corpus_text(F.col("ingredients"), F.col("recipe"), fields),
    )
    kept = texts.where(F.col("text") != "")
    if not sample_limit:
        return kept.select("row_id", "text")
    parts = []
    for split in splits:
        if sample_limit <= 0:
            break
        part = kept.where(F.col("split") == split).select("row_id", "text")
        parts.append(first_n(part, sample_limit))
        sample_limit -= part.count()
    return reduce(DataFrame.unionByName, parts)


def build_vocabulary(
    texts: DataFrame,
    vocab_size: int = 16_000,
    min_frequency: int = 2,
    lower: bool = False,
    nfkc: bool = False,
) -> Vocabulary:
    counts = word_counts(texts, F.col("text"), lambda c: normalize_text(c, lower, nfkc))
    return train_bpe(counts, vocab_size, min_frequency, lower, nfkc)


def cache_tokens(
    rows: DataFrame,
    vocab: Vocabulary,
    path: str,
    max_len: int = 512,
    splits: tuple[str, ...] = SPLITS,
) -> None:
    """Encode every row once and store it by split."""
    texts = rows.where(F.col("split").isin(*splits)).select(
        "row_id", "split", sample_text(F.col("ingredients"), F.col("recipe")).alias("text")
    )
    ids = encode_corpus(texts, "text", vocab, max_len=max_len)
    ids = ids.withColumn("ids", at_least_two(F.col("ids")))
    write_token_cache(ids, path, max_len, PAD, vocab.fingerprint())


