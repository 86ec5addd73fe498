"""Subword vocabulary: byte-pair merges learned from a table of counted words.

The words stay in Spark, as blocks of numbers with an inverted index from pairs to words (see
``train_bpe``). The driver sees the most frequent pairs and the changes of their counts.

Many merges per round, exactly. Rank pairs by (count, then pair) and take the longest run from the
top in which no pair starts with a symbol that another one ends with. Greedy merging would take the
same pairs one by one:

* merging (a, b) uses up places of "x a" and of "b y" only, that is of pairs ending with a or
  starting with b; there is none in the run, so all its counts stay as they are;
* a pair born from (a, b) stands where "x a" or "b y" stood. Those older pairs are not in the run,
  so they rank after all of it, and the newborn counts no more than they did. On a tie the newborn
  still ranks later, because its new symbol is greater than every old one.

A pair of two equal symbols, or one whose text is already a piece, may only end a run: what it makes
can outrank what follows.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.rules import SPECIALS
from millrace.operators.words import byte_alphabet, to_letters
from millrace.sources.shared import materialize

_HEAD = 50_000  # ranked pairs the driver keeps the counts of
_RUN = 512  # of those, looked at per round
_WORDS_PER_TASK = 100_000
_PENDING = 512  # merges replayed on the stored words before they are written anew
_FIRST_MERGED = 0x1000  # symbols of merged pieces; a byte letter is its code point

Merge = tuple[int, int, int]  # left, right, what they become


@dataclass
class Vocabulary:
    """Pieces in id order (after the special tokens) and merges in rank order."""

    pieces: list[str]
    merges: list[tuple[str, str]]
    lower: bool = True
    nfkc: bool = True

    @property
    def tokens(self) -> list[str]:
        return SPECIALS + self.pieces

    def fingerprint(self) -> str:
        parts = [self.tokens, self.merges, self.lower, self.nfkc]
        return hashlib.md5(json.dumps(parts).encode()).hexdigest()

    def tables(self, spark: SparkSession) -> dict[str, DataFrame]:
        n = len(SPECIALS)
        vocab = [(t, i, i < n) for i, t in enumerate(self.tokens)]
        merges = [(i, a, b, a + b) for i, (a, b) in enumerate(self.merges)]
        meta = {"vocab_size": len(vocab), "lower": self.lower, "nfkc": self.nfkc}
        meta |= {f"special:{t}": i for i, t in enumerate(SPECIALS)}
        return {
            "vocab": spark.createDataFrame(vocab, "token string, id int, is_special boolean"),
            "merges": spark.createDataFrame(
                merges, "rank int, left string, right string, merged string"
            ),
            "meta": spark.createDataFrame(
                [(k, json.dumps(v)) for k, v in meta.items()], "key string, value string"
            ),
        }


def adjacent_pairs(syms: Column) -> Column:
    """All neighbours in a text of symbols: the pairs at even places, then those at odd ones."""
    two = F.lit("(?s)(..)")
    return F.concat(
        F.regexp_extract_all(syms, two, F.lit(1)),
        F.regexp_extract_all(F.substring(syms, F.lit(2), F.length(syms)), two, F.lit(1)),
    )


def pair_counts(words: DataFrame) -> DataFrame:
    """(pair, n) over a table of (syms, n)."""
    return (
        words.select(F.explode(adjacent_pairs(F.col("syms"))).alias("pair"), "n")
        .groupBy("pair")
        .agg(F.sum("n").alias("n"))
    )


# ---- words in blocks ---------------------------------------------------------------------------------
# A block holds the words of an Arrow batch as numbers: their symbols in turn, a 0 after each word,
# where each word starts, the words' counts, and an inverted index: the pairs that begin at each
# place, sorted, and those places.


def _codes(syms: np.ndarray) -> np.ndarray:
    """The pair that begins at each place, as one number; 0 across a word's end."""
    left, right = syms[:-1].astype(np.int64), syms[1:].astype(np.int64)
    return np.where((left > 0) & (right > 0), left << 32 | right, 0)


def _summed(codes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs and the sums of their counts."""
    order = np.argsort(codes, kind="stable")
    codes, counts = codes[order], counts[order]
    first = np.flatnonzero(np.append(True, codes[1:] != codes[:-1])) if len(codes) else np.zeros(0, np.int64)
    return codes[first], np.add.reduceat(counts, first) if len(first) else counts


def _merged(syms: np.ndarray, word: np.ndarray, a: int, b: int, x: int) -> tuple[np.ndarray, np.ndarray]:
    """Every ``a b`` replaced by ``x``, left to right, without overlaps."""
    at = np.flatnonzero((syms[:-1] == a) & (syms[1:] == b))
    if not len(at):
        return syms, word
    if a == b:  # of a run every second place
        run = np.append(True, np.diff(at) > 1)
        at = at[(at - at[run][np.cumsum(run) - 1]) % 2 == 0]
    syms = syms.copy()
    syms[at] = x
    left = np.ones(len(syms), bool)
    left[at + 1] = False
    return syms[left], word[left]


@dataclass
class _Block:
    syms: np.ndarray
    starts: np.ndarray
    counts: np.ndarray
    codes: np.ndarray
    places: np.ndarray

    KINDS = {"syms": np.int32, "starts": np.int32, "counts": np.int64, "codes": np.int64, "places": np.int32}

    @classmethod
    def of(cls, syms: np.ndarray, counts: np.ndarray) -> _Block:
        codes = _codes(syms)
        order = np.argsort(codes, kind="stable")
        starts = np.append(0, np.flatnonzero(syms == 0) + 1)
        return cls(syms, starts, counts, codes[order], order)

    def row(self) -> dict:
        return {name: [getattr(self, name).astype(kind).tobytes()] for name, kind in self.KINDS.items()}

    def holding(self, pairs: list[tuple[int, int]]) -> np.ndarray:
        """The words with one of the pairs, found by the index."""
        asked = np.array([a << 32 | b for a, b in pairs], np.int64)
        first, last = np.searchsorted(self.codes, asked), np.searchsorted(self.codes, asked, side="right")
        places = np.concatenate([self.places[f:t] for f, t in zip(first, last)] or [np.zeros(0, np.int32)])
        return np.unique(np.searchsorted(self.starts, places, side="right") - 1)

    def words(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(symbols, the word of each symbol) of some words."""
        begins, sizes = self.starts[which].astype(np.int64), np.diff(self.starts)[which]
        ends = np.cumsum(sizes)
        places = np.repeat(begins - (ends - sizes), sizes) + np.arange(int(ends[-1]) if len(ends) else 0)
        return self.syms[places], np.repeat(which, sizes)

    def deltas(self, pending: list[Merge], new: list[Merge]) -> tuple[np.ndarray, np.ndarray]:
        """Pairs whose counts the new merges change, after the pending ones, and by how much."""
        syms, word = self.words(self.holding([(a, b) for a, b, _ in pending + new]))
        for a, b, x in pending:
            syms, word = _merged(syms, word, a, b, x)
        changed = np.isin(_codes(syms), [a << 32 | b for a, b, _ in new])
        kept = np.isin(word, word[:-1][changed])
        syms, word = syms[kept], word[kept]
        before = _codes(syms), -self.counts[word[:-1]]
        for a, b, x in new:
            syms, word = _merged(syms, word, a, b, x)
        after = _codes(syms), self.counts[word[:-1]]
        codes, sums = _summed(*map(np.concatenate, zip(before, after)))
        kept = (sums != 0) & (codes > 0)
        return codes[kept], sums[kept]

    def after(self, pending: list[Merge]) -> tuple[np.ndarray, np.ndarray]:
        """All words after the pending merges; only those the index finds are worked on."""
        touched = self.holding([(a, b) for a, b, _ in pending])
        syms, word = self.words(touched)
        for a, b, x in pending:
            syms, word = _merged(syms, word, a, b, x)
        rest, others = self.words(np.setdiff1d(np.arange(len(self.counts)), touched))
        return np.concatenate([rest, syms]), np.concatenate([others, word])

    def totals(self, pending: list[Merge]) -> tuple[np.ndarray, np.ndarray]:
        syms, word = self.after(pending)
        codes, sums = _summed(_codes(syms), self.counts[word[:-1]])
        return codes[codes > 0], sums[codes > 0]

    def rewritten(self, pending: list[Merge]) -> _Block:
        """The block after the merges, without words that are one piece by now: they have no pairs."""
        syms, word = self.after(pending)
        sizes = np.bincount(word, minlength=len(self.counts))
        kept = sizes[word] > 2  # a symbol and the 0 at the end are two
        syms, word = syms[kept], word[kept]
        return _Block.of(syms, self.counts[word[syms == 0]])


_BLOCK_SCHEMA = ", ".join(f"{name} binary" for name in _Block.KINDS)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[_Block]:
    for batch in batches:
        for k in range(batch.num_rows):
            yield _Block(*[np.frombuffer(batch.column(n)[k].as_py(), t) for n, t in _Block.KINDS.items()])


def _to_blocks(words: DataFrame) -> DataFrame:
    """(syms, n) with a word's symbols as text into blocks of words, as many a task as it has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(0).to_pylist()
            syms = np.frombuffer("\0".join([*texts, ""]).encode("utf-32-le"), np.int32)
            counts = batch.column(1).to_numpy().astype(np.int64)
            yield pa.RecordBatch.from_pydict(_Block.of(syms, counts).row())

    return words.select("syms", "n").mapInArrow(run, _BLOCK_SCHEMA)


def _pairs(blocks: DataFrame, count: Callable[[_Block], tuple[np.ndarray, np.ndarray]]) -> DataFrame:
    """(pair, n) summed over all blocks; a task has summed up its own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches):
            codes, sums = count(block)
            yield pa.RecordBatch.from_pydict({"pair": codes, "n": sums})

    return blocks.mapInArrow(run, "pair bigint, n bigint").groupBy("pair").agg(F.sum("n").alias("n"))


def _rewritten(blocks: DataFrame, pending: list[Merge]) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches):
            yield pa.RecordBatch.from_pydict(block.rewritten(pending).row())

    return blocks.mapInArrow(run, _BLOCK_SCHEMA)


def _width(words: DataFrame) -> int:
    """Tasks per round: few bytes but much work per word, so not what AQE would merge them to."""
    spark = words.sparkSession
    most = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return min(most, max(spark.sparkContext.defaultParallelism, words.count() // _WORDS_PER_TASK))


class _Head:
    """Exact counts of all pairs up to the ``last`` of a ranking: what the driver knows until the next.

    A merge takes from old pairs and gives only to pairs with its new symbol, so a pair that ranks
    behind the last one never comes before it again, and a new pair never has more than at its birth.
    """

    def __init__(self, ranked: list[tuple[int, int]], complete: bool, least: int):
        self.least = least if complete else ranked[-1][1]
        self.last = (-least, 1 << 63) if complete else (-ranked[-1][1], ranked[-1][0])
        self.counts = dict(ranked)

    def top(self, k: int) -> list[tuple[int, int]]:
        """(left, right) of the most frequent pairs, ties by the smaller symbols."""
        best = heapq.nsmallest(k, ((-n, pair) for pair, n in self.counts.items()))
        return [(pair >> 32, pair & 0xFFFFFFFF) for _, pair in best]

    def add(self, deltas: list[tuple[int, int]]) -> None:
        for pair, n in deltas:
            n += self.counts.get(pair, 0)
            if (-n, pair) <= self.last:
                self.counts[pair] = n
            else:
                self.counts.pop(pair, None)


def train_bpe(
    words: DataFrame,
    vocab_size: int,
    min_frequency: int = 2,
    lower: bool = True,
    nfkc: bool = True,
) -> Vocabulary:
    """Learn merges from (word, n) until the vocabulary is full or no pair is frequent enough.

    The words lie in blocks in the shared folder, each with an inverted index. A round looks up the
    words that hold a chosen pair, merges in those alone and sends signed changes of pair counts, so
    its work follows the changed words. The driver keeps the exact counts of the most frequent pairs
    and asks for a new ranking of all pairs only when they are used up. After ``_PENDING`` merges the
    blocks are written anew.
    """
    words = words.select("word", to_letters(F.col("word")).alias("syms"), "n")
    stored = materialize(words, "words")
    letters = [r["letter"] for r in byte_alphabet(stored).select("letter").collect()]
    pieces = sorted(letters)
    text_of = {ord(c): c for c in pieces}  # symbol -> piece
    symbol_of = {piece: x for x, piece in text_of.items()}
    merges: list[tuple[str, str]] = []
    pending: list[Merge] = []
    dealt = stored.repartition(_width(stored), "syms")
    blocks = materialize(_to_blocks(dealt), "word-blocks").persist()
    room = vocab_size - len(SPECIALS) - len(pieces)
    head: _Head | None = None

    while room > 0:
        if head is None:
            totals = _pairs(blocks, lambda block, done=tuple(pending): block.totals(list(done)))
            ranked = totals.where(F.col("n") >= min_frequency).orderBy(F.desc("n"), "pair").limit(_HEAD)
            rows = [(r["pair"], r["n"]) for r in ranked.collect()]
            if not rows:
                break
            head = _Head(rows, len(rows) < _HEAD, min_frequency)
        new: list[Merge] = []
        starts: set[int] = set()
        ends: set[int] = set()
        again = False
        for left, right in head.top(_RUN):
            if room == 0 or left in ends or right in starts:
                break
            piece = text_of[left] + text_of[right]
            again = piece in symbol_of
            if not again:
                symbol_of[piece] = _FIRST_MERGED + len(merges)
                text_of[symbol_of[piece]] = piece
                pieces.append(piece)
                room -= 1
            merges.append((text_of[left], text_of[right]))
            new.append((left, right, symbol_of[piece]))
            starts.add(left)
            ends.add(right)
            if again or left == right:
                break
        if room:
            deltas = _pairs(blocks, lambda block, done=tuple(pending), now=tuple(new): block.deltas(list(done), list(now)))
            # losses, and what is born that frequent
            seen = deltas.where((F.col("n") < 0) | (F.col("n") >= head.least)).collect()
            head.add([(r["pair"], r["n"]) for r in seen])
        pending += new
        if again or not head.counts:  # an old symbol may have gained, or the known pairs are used up
            head = None
        if len(pending) >= _PENDING:
            written = materialize(_rewritten(blocks, pending), "word-blocks").persist()
            blocks.unpersist()
            blocks, pending = written, []
    blocks.unpersist()
    return Vocabulary(pieces, merges, lower, nfkc)
