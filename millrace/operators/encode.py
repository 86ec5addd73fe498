"""Texts to token ids and back."""

from __future__ import annotations

import heapq
import unicodedata
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.regex import constant
from millrace.functions.rules import BOS, EOS, PAD, SPECIALS, UNK
from millrace.operators.bpe import Vocabulary
from millrace.operators.words import byte_letters, from_letters, lowered, nfkc_risky, pretokenize

_MEMO = 100_000  # encoded words a task remembers before it starts afresh
_PIECE = 1 << 18  # words a task looks at at once
_LETTERS = dict(enumerate(byte_letters()))


def _either(tokens: list[str]) -> str:
    return "|".join(rf"\Q{t}\E" for t in tokens)


def split_specials(text: Column) -> Column:
    """Segments of a text: special tokens that are spelled out, and what lies between them."""
    any_special = _either(SPECIALS)
    parts = F.split(text, f"(?={any_special})|(?<={any_special})")
    return F.when(text.rlike(any_special), F.filter(parts, lambda s: s != "")).otherwise(
        F.array(text)
    )


def _nfkc_each(rows: pd.Series) -> pd.Series:
    return rows.map(
        lambda segments: None
        if segments is None
        else [unicodedata.normalize("NFKC", s) for s in segments]
    )


def words_of(text: Column, lower: bool, use_nfkc: bool) -> Column:
    """Words of a text in order; a special token is one word, as it is spelled.

    Special tokens are looked for in the raw text, so the normalizer runs on the segments between.
    """
    raw = split_specials(F.coalesce(text, F.lit("")))
    normal = raw
    if use_nfkc:
        to_change = F.when(nfkc_risky(text), raw)
        normal = F.coalesce(F.pandas_udf(_nfkc_each, "array<string>")(to_change), raw)

    def words(segment: Column) -> Column:
        return pretokenize(lowered(segment) if lower else segment)

    return F.flatten(
        F.zip_with(
            raw, normal, lambda r, n: F.when(r.isin(SPECIALS), F.array(r)).otherwise(words(n))
        )
    )


def _segment(word: str, ranks: dict[tuple[str, str], int]) -> list[str]:
    """Merge the pair of lowest rank, leftmost first, until none is left."""
    parts: list[str | None] = list(word)
    after = list(range(1, len(parts))) + [-1]
    before = list(range(-1, len(parts) - 1))
    heap: list[tuple[int, int, str, str]] = []

    def offer(i: int) -> None:
        j = after[i] if i >= 0 else -1
        if j >= 0 and (rank := ranks.get((parts[i], parts[j]))) is not None:
            heapq.heappush(heap, (rank, i, parts[i], parts[j]))

    for i in range(len(parts)):
        offer(i)
    while heap:
        _, i, left, right = heapq.heappop(heap)
        j = after[i]
        if parts[i] != left or j < 0 or parts[j] != right:
            continue  # one of the two was merged meanwhile
        parts[i], parts[j] = left + right, None
        after[i] = after[j]
        if after[i] >= 0:
            before[after[i]] = i
        offer(before[i])
        offer(i)
    return [p for p in parts if p is not None]


def _ids_of(words: pa.Array, of_word: Callable[[str], bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of words in turn, and how many there are up to each word's end."""
    coded = words.dictionary_encode()
    packed = [of_word(w) for w in coded.dictionary.to_pylist()]
    which = coded.indices.to_numpy(zero_copy_only=False)
    sizes = np.asarray([len(c) >> 2 for c in packed], dtype=np.int64)
    starts = np.cumsum(sizes) - sizes
    pool = np.frombuffer(b"".join(packed), np.int32)
    lengths = sizes[which]
    ends = np.cumsum(lengths)
    # place of every id in the pool: start of its word plus its offset in the word
    at = np.arange(ends[-1]) - np.repeat(ends - lengths - starts[which], lengths)
    return pool[at], ends


def _word_encoder(vocab: Vocabulary, spark):
    """Arrow function from lists of words to lists of ids.

    The vocabulary is the only thing sent to all tasks; its size is what the user asked for. A batch
    is worked on in pieces of ``_PIECE`` words, of which each distinct one is looked at once; a task
    remembers words it has met.
    """
    ids = {t: i for i, t in enumerate(vocab.tokens)}
    ranks = {pair: rank for rank, pair in reversed(list(enumerate(vocab.merges)))}
    shared = spark.sparkContext.broadcast((ids, ranks))

    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        ids, ranks = shared.value
        memo: dict[str, bytes] = {}

        def of_word(word: str) -> bytes:
            found = memo.get(word)
            if found is None:
                if len(memo) >= _MEMO:
                    memo.clear()
                if word in SPECIALS:
                    out = [ids[word]]
                else:
                    letters = word.encode().decode("latin-1").translate(_LETTERS)
                    out = [ids.get(p, UNK) for p in _segment(letters, ranks)]
                found = memo[word] = np.asarray(out, np.int32).tobytes()
            return found

        for batch in batches:
            flat, parts, ends = batch.flatten(), [np.zeros(0, np.int32)], [np.zeros(1, np.int32)]
            seen = 0  # ids before the piece
            for begin in range(0, len(flat), _PIECE):
                got, upto = _ids_of(flat.slice(begin, _PIECE), of_word)
                parts.append(got)
                ends.append((seen + upto).astype(np.int32))
                seen += len(got)
            words_per_row = batch.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            row_ends = np.concatenate([[0], np.cumsum(words_per_row)])
            offsets = pa.array(np.concatenate(ends)[row_ends], pa.int32())
            yield pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(parts), pa.int32()))

    return F.arrow_udf(encode, "array<int>")


def encode_corpus(
    df: DataFrame,
    text_col: str,
    vocab: Vocabulary,
    add_special: bool = True,
    max_len: int | None = None,
    ids_col: str = "ids",
) -> DataFrame:
    """Add the token ids of a text column. Narrow: no shuffle, whatever the corpus size."""
    words = words_of(F.col(text_col), vocab.lower, vocab.nfkc)
    df = df.withColumn(ids_col, _word_encoder(vocab, df.sparkSession)(words))
    ids = F.col(ids_col)
    if add_special:
        ids = add_specials(ids)
    if max_len is not None:
        ids = truncate(ids, max_len)
    return df.withColumn(ids_col, ids)


def add_specials(ids: Column) -> Column:
    return F.concat(F.array(F.lit(BOS)), ids, F.array(F.lit(EOS)))


def truncate(ids: Column, max_len: int) -> Column:
    """First ``max_len`` ids; a sample that is cut loses its end token."""
    return F.slice(ids, 1, max_len)


def decode(ids: Column, vocab: Vocabulary, stop_at_eos: bool = True) -> Column:
    """Text of ids up to the first end token, special tokens left out. Stays in the JVM."""
    if stop_at_eos:
        end = F.array_position(ids, F.lit(EOS))
        ids = F.when(end > 0, F.slice(ids, F.lit(1), (end - 1).cast("int"))).otherwise(ids)
    kept = F.filter(ids, lambda i: i >= len(SPECIALS))
    tokens = constant(vocab.tokens)
    return from_letters(F.array_join(F.transform(kept, lambda i: F.get(tokens, i)), ""))


def attention_mask(ids: Column) -> Column:
    return F.array_repeat(F.lit(1), F.size(ids))


def at_least_two(ids: Column, pad: int = PAD) -> Column:
    """Shifting needs two ids: append the pad to a shorter list."""
    return F.when(F.size(ids) < 2, F.concat(ids, F.array(F.lit(pad)))).otherwise(ids)
