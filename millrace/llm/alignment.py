"""Two tokenizers' tokens of the same bytes: where both end, groups, links, and how usual a link is."""

from __future__ import annotations

import os
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.memo import Memo
from millrace.llm.texts import ID, TEXT, gather, gathered, id_text, id_type, raw, running, small, text_array
from millrace.sources.shared import materialize

MARK = "▁"
_GROUP = 256  # new words encoded at once
_CHUNK = 1 << 14  # and aligned at once
_MEMO = 300_000  # words a task remembers
_BLOCK = ["block", "links", "width", "pairs", "counts"]  # columns that only ``weigh`` needs


def _gallop(x: np.ndarray, long: np.ndarray, low: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """For every number of ``x`` the first place from ``low`` (below ``stop``) in the rising ``long``
    that is not smaller: steps of 1, 2, 4, ... reach past it, a binary search goes back."""
    low, high, step = low.copy(), low.copy(), 1
    rows = np.arange(len(x))
    while len(rows):
        rows = rows[high[rows] < stop[rows]]
        rows = rows[long[high[rows]] < x[rows]]
        low[rows] = high[rows] + 1
        high[rows] += step
        step *= 2
    high = np.minimum(high, stop)
    while True:
        rows = np.flatnonzero(low < high)
        if not len(rows):
            return low
        middle = (low[rows] + high[rows]) // 2
        less = long[middle] < x[rows]
        low[rows[less]] = middle[less] + 1
        high[rows[~less]] = middle[~less]


def common_ends(
    a: np.ndarray, b: np.ndarray, bounds_a: np.ndarray, bounds_b: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Places in ``a`` and in ``b`` of the numbers that two rising lists share, by galloping.

    The lists are cut into texts by their ``bounds``; of each text the shorter part drives, and every
    one of its numbers is searched in the longer part.
    """
    short = np.diff(bounds_a) <= np.diff(bounds_b)
    found = []
    for driver, other, bounds, others, mine in ((a, b, bounds_a, bounds_b, short), (b, a, bounds_b, bounds_a, ~short)):
        text = np.repeat(np.arange(len(short)), np.diff(bounds))
        at = np.flatnonzero(mine[text])
        low, stop = others[:-1][text[at]], others[1:][text[at]]
        place = _gallop(driver[at], other, low, stop)
        hit = place < stop
        hit[hit] = other[place[hit]] == driver[at[hit]]
        found.append((at[hit], place[hit]))
    i = np.concatenate([found[0][0], found[1][1]])
    j = np.concatenate([found[0][1], found[1][0]])
    order = np.argsort(i)
    return i[order], j[order]


def _byte_level() -> dict[str, int]:
    """The printable characters that stand for bytes in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table = {chr(b): b for b in plain}
    others = (b for b in range(256) if b not in table.values())
    return table | {chr(256 + k): b for k, b in enumerate(others)}


def _digits(size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, starts, lengths) of the decimal ids of a vocabulary, each after one byte for a separator."""
    texts = [b"," + str(i).encode() for i in range(size)]
    lengths = np.array(list(map(len, texts)))
    return np.frombuffer(b"".join(texts), np.uint8), running(lengths)[:-1], lengths


def _spelling(tokens: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    lengths = np.array(list(map(len, tokens)))
    return np.frombuffer(b"".join(tokens), np.uint8), running(lengths)[:-1], lengths


class Aligner:
    """Align the tokens of vocabulary A (byte-level, ``tokenizers``) and B (``sentencepiece``).

    Both see a text with one blank in front, and neither has a token that goes on past a blank run's
    end or begins inside a word before one, so a text is cut into words (blanks, then no blanks) and
    every distinct word is encoded and aligned once. What is kept a word: its numbers of tokens and
    groups, the text of its groups (``;a1,a2|b1``), its linked pairs, and whether its tokens spell it.
    """

    def __init__(self, path_a: str, path_b: str, memo: int = _MEMO):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        letters = _byte_level()
        size = self.a.get_vocab_size(with_added_tokens=True)
        names = [self.a.id_to_token(i) or "" for i in range(size)]
        self.spell_a = _spelling([bytes(letters[c] for c in t) if all(c in letters for c in t) else t.encode() for t in names])
        self.size_b = self.b.vocab_size()
        pieces = [self.b.id_to_piece(i) for i in range(self.size_b)]
        self.spell_b = _spelling(
            [
                bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(MARK, " ").encode()
                for i, p in enumerate(pieces)
            ]
        )
        if any(MARK in p.lstrip(MARK) for p in pieces):
            raise ValueError("vocabulary B has a piece that goes on past a blank")
        self.blank = self.b.encode("x ")[len(self.b.encode("x")) :]
        self.digits = _digits(max(size, self.size_b))
        columns = {"text": np.zeros(0, np.uint8), "pairs": np.zeros(0, np.int64)}
        self.memo = Memo(memo, columns, ("n_a", "n_b", "ok"))

    # ---- words --------------------------------------------------------------------------------

    def _ids(self, texts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        a = [e.ids for e in self.a.encode_batch_fast(texts, add_special_tokens=False)]
        # B adds the first blank itself, but not to an empty text
        b = self.b.encode([t[1:] for t in texts], num_threads=1)
        return a, [ids if t != " " else self.blank for t, ids in zip(texts, b)]

    def _align(self, groups: list[list[str]]) -> list[str]:
        """Encode each group of words as one text, align all, and remember every word.

        Gives back the words of groups that the tokens do not spell; a group of one such word is
        remembered as not spelled.
        """
        texts = ["".join(g) for g in groups]
        ids_a, ids_b = self._ids(texts)
        data = [np.frombuffer(t.encode(), np.uint8) for t in texts]
        sides, right = [], np.ones(len(groups), bool)
        for ids, (letters, starts, lengths) in ((ids_a, self.spell_a), (ids_b, self.spell_b)):
            sizes = np.array(list(map(len, ids)))
            flat = np.fromiter(chain.from_iterable(ids), np.int64, sizes.sum())
            spelled, ends = letters[gather(starts[flat], lengths[flat])], running(lengths[flat])
            borders = ends[running(sizes)]
            for k, d in enumerate(data):
                right[k] &= np.array_equal(spelled[borders[k] : borders[k + 1]], d)
            sides.append((flat, sizes, lengths))
        again = [w for g, r in zip(groups, right) if not r and len(g) > 1 for w in g]
        wrong = [g[0] for g, r in zip(groups, right) if not r and len(g) == 1]
        if wrong:
            none = np.zeros(len(wrong), np.int64)
            nothing = {name: (empty, none) for name, empty in self.memo.empty.items()}
            self.memo.add(wrong, nothing, n_a=none, n_b=none, ok=none)
        if right.any():
            kept = [(flat[np.repeat(right, sizes)], lengths) for flat, sizes, lengths in sides]
            self._remember([w for g, r in zip(groups, right) if r for w in g], *kept)
        return again

    def _remember(self, words: list[str], side_a: tuple, side_b: tuple) -> None:
        """The ids of both sides run through all words in turn."""
        borders = np.cumsum(np.fromiter((len(w.encode()) for w in words), np.int64, len(words)))
        (a, lengths_a), (b, lengths_b) = side_a, side_b
        ends_a, ends_b = np.cumsum(lengths_a[a]), np.cumsum(lengths_b[b])
        bounds_a = np.append(0, np.searchsorted(ends_a, borders) + 1)
        bounds_b = np.append(0, np.searchsorted(ends_b, borders) + 1)
        i, j = common_ends(ends_a, ends_b, bounds_a, bounds_b)
        groups = np.append(0, np.searchsorted(i, bounds_a[1:] - 1) + 1)  # each word ends a group
        if not np.array_equal(ends_a[bounds_a[1:] - 1], borders) or not np.array_equal(ends_b[bounds_b[1:] - 1], borders):
            raise ValueError("a word's end is no end of a token")
        # the tokens of both sides, group by group: first those of A, then those of B
        group_a = np.repeat(np.arange(len(i)), np.diff(i, prepend=-1))
        group_b = np.repeat(np.arange(len(j)), np.diff(j, prepend=-1))
        at_a = np.arange(len(a)) + np.append(0, j + 1)[group_a]
        at_b = np.arange(len(b)) + (i + 1)[group_b]
        ids = np.empty(len(a) + len(b), np.int64)
        ids[at_a], ids[at_b] = a, b
        letters, starts, lengths = self.digits
        text, begins = letters[gather(starts[ids], lengths[ids])], running(lengths[ids])
        text[begins[at_a[np.append(0, i + 1)[:-1]]]] = ord(";")
        text[begins[at_b[np.append(0, j + 1)[:-1]]]] = ord("|")
        sizes = np.diff(begins[bounds_a + bounds_b])
        pairs = a[i] * self.size_b + b[j]
        columns = {"text": (text, sizes), "pairs": (pairs, np.diff(groups))}
        self.memo.add(words, columns, n_a=np.diff(bounds_a), n_b=np.diff(bounds_b), ok=np.ones(len(words), np.int64))

    def words(self, distinct: list[str]) -> np.ndarray:
        """The rows of all words; new ones are aligned."""
        slots = self.memo.slots(distinct)
        new = [distinct[k] for k in np.flatnonzero(slots < 0)]
        if new:
            joined = [w for w in new if not w.endswith(" ")]  # blanks at a word's end would meet the next word's
            alone = [w for w in new if w.endswith(" ")]
            for start in range(0, len(joined), _CHUNK):
                chunk = joined[start : start + _CHUNK]
                alone += self._align([chunk[k : k + _GROUP] for k in range(0, len(chunk), _GROUP)])
            if alone:
                self._align([[w] for w in alone])
            slots = np.fromiter(map(self.memo.place.__getitem__, distinct), np.int64, len(distinct))
        return slots

    # ---- texts --------------------------------------------------------------------------------

    def batch(self, texts: pa.Array) -> dict:
        """Columns of a batch of texts, and its distinct pairs with their counts."""
        full = pc.binary_length(texts).to_numpy() > 0
        data, off = raw(pc.binary_join_element_wise(pa.scalar(" "), texts, ""))
        blank = data == 32
        first = blank.copy()
        first[1:] &= ~blank[:-1]
        first[off[:-1]] = True
        cuts = np.flatnonzero(first)
        ends = np.append(cuts, len(data)).astype(np.int32)
        cut = pa.Array.from_buffers(pa.string(), len(cuts), [None, pa.py_buffer(ends), pa.py_buffer(data)])
        words = cut.dictionary_encode()
        distinct, bounds = words.indices.to_numpy(), np.searchsorted(cuts, off)
        slots, memo = self.words(words.dictionary.to_pylist()), self.memo

        # the words of texts that the tokens spell, and where each such text begins among them
        bad = running(1 - memo.fixed["ok"][slots][distinct])[bounds]
        ok = full & (bad[1:] == bad[:-1])
        distinct = distinct[np.repeat(ok, np.diff(bounds))]
        bounds = running(np.where(ok, np.diff(bounds), 0))
        which = slots[distinct]

        def per_text(counts: np.ndarray) -> np.ndarray:
            return running(counts[which])[bounds]

        pairs = memo.counts["pairs"]
        out = {name: np.diff(per_text(memo.fixed[name])) for name in ("n_a", "n_b")}
        stops = per_text(pairs)
        out["n_groups"] = out["n_links"] = np.diff(stops)
        # the groups of all words in turn; a text's first separator goes
        starts, sizes = memo.starts["text"][which], memo.counts["text"][which]
        begin = bounds[:-1][ok]
        starts[begin] += 1
        sizes[begin] -= 1
        text = gathered(memo.data["text"], starts, sizes)
        out["groups"] = pa.Array.from_buffers(
            pa.string(), len(texts), [None, pa.py_buffer(running(sizes)[bounds].astype(np.int32)), pa.py_buffer(text)]
        )
        # links as places in the block's list of distinct pairs
        codes, place = np.unique(memo.data["pairs"][gather(memo.starts["pairs"][slots], pairs[slots])], return_inverse=True)
        links = place[gather(running(pairs[slots])[:-1][distinct], pairs[which])]
        width = 2 if len(codes) <= 1 << 16 else 4
        buffers = [None, pa.py_buffer((stops * width).astype(np.int32)), pa.py_buffer(links.astype(f"<u{width}"))]
        out["links"] = pa.Array.from_buffers(pa.binary(), len(texts), buffers)
        return out | {"width": width, "pairs": codes, "counts": np.bincount(links, minlength=len(codes))}


def size_of(path_b: str) -> int:
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path_b).vocab_size()


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def _aligner(path_a: str, path_b: str) -> Aligner:
    """One a worker process: later tasks find the words of earlier ones."""
    if (path_a, path_b) not in _ALIGNERS:
        _ALIGNERS[path_a, path_b] = Aligner(path_a, path_b)
    return _ALIGNERS[path_a, path_b]


def align(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Tokens of both vocabularies of every whole text, cut into groups where both end.

    Per row: ``doc_id, n_a, n_b, n_groups, n_links`` (long), ``groups`` (``a1,a2|b1;a3|b2``: the ids
    of A and of B of every group in order; the sizes of a group are the overlap ranges). The last
    tokens of a group end together and are its link. For ``weigh`` there are ``block`` (rows of about
    6 MB of text), ``links`` (places in the block's list of pairs, ``width`` bytes each), and on a
    block's first row that list: ``pairs`` (id of A times size of B plus id of B) and ``counts``.

    Null and empty texts, and texts that the tokens of A or B do not spell byte for byte, have zeros
    and empty groups. Long texts are never cut: a longer one than 6 MB is a block of its own.
    Repeated rows and null ids are rows like others. An empty table gives no rows. Extra columns are
    not read. No row is shuffled.
    """
    rows = id_text(docs)
    schema = (
        f"{ID} {id_type(rows)}, n_a bigint, n_b bigint, n_groups bigint, groups string, n_links bigint, "
        "block bigint, links binary, width int, pairs array<bigint>, counts array<bigint>"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(path_a, path_b)
        block = TaskContext.get().partitionId() << 32
        for batch in small(batches):
            got = aligner.batch(text_array(batch.column(TEXT)))
            n = batch.num_rows
            lists = {k: pa.array([got[k]] + [None] * (n - 1), pa.list_(pa.int64())) for k in ("pairs", "counts")}
            columns = got | lists | {
                ID: batch.column(ID),
                "block": np.full(n, block),
                "width": np.full(n, got["width"], np.int32),
            }
            names = [c.split()[0] for c in schema.split(", ")]
            yield pa.RecordBatch.from_arrays(
                [c if isinstance(c, pa.Array) else pa.array(c) for c in (columns[k] for k in names)], names=names
            )
            block += 1

    return rows.mapInArrow(run, schema)


def pair_counts(aligned: DataFrame, size_b: int) -> DataFrame:
    """``pair, n, best``: in how many links an id pair is linked, and whether no other A id is oftener
    linked with its B id (ties are all best). Blocks are counted before anything is shuffled."""
    pairs = _block_pairs(aligned).groupBy("pair").agg(F.sum("n").alias("n"))
    pairs = materialize(pairs, "pair-counts")
    most = pairs.groupBy((F.col("pair") % size_b).alias("b")).agg(F.max("n").alias("most"))
    # one row an id of B: the vocabulary bounds what is broadcast
    return pairs.join(F.broadcast(most), F.col("pair") % size_b == F.col("b")).select(
        "pair", "n", (F.col("n") == F.col("most")).alias("best")
    )


def _block_pairs(aligned: DataFrame) -> DataFrame:
    """One row for each block and distinct pair."""
    first = aligned.where(F.col("pairs").isNotNull())
    return first.select("block", F.posexplode(F.arrays_zip("pairs", "counts"))).select(
        "block", "pos", F.col("col.pairs").alias("pair"), F.col("col.counts").alias("n")
    )


def weigh(aligned: DataFrame, size_b: int) -> DataFrame:
    """Add ``n_best`` (links whose pair is the best of its B id) and ``count_sum`` (of the pair counts
    over the links) to written rows of ``align``; the columns for this step go.

    Only the blocks' lists of pairs are joined with the counts of the whole table; a block's list and
    its documents then meet in one task, which a block's size bounds.
    """
    counts = pair_counts(aligned, size_b).alias("c")
    mine = _block_pairs(aligned).join(counts, "pair")
    mine = mine.select(F.col("block").alias("of_block"), "pos", "c.n", "best")  # another name: both sides have one origin
    kept = [f for f in aligned.schema if f.name not in _BLOCK]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    names = [f.name for f in kept]

    def run(docs: pa.Table, pairs: pa.Table) -> pa.Table:
        place = pairs.column("pos").to_numpy()
        n, best = np.zeros(len(place), np.int64), np.zeros(len(place), np.int64)
        n[place] = pairs.column("n").to_numpy()
        best[place] = pairs.column("best").to_numpy(zero_copy_only=False)
        width = docs.column("width")[0].as_py()
        links = np.frombuffer(b"".join(docs.column("links").to_pylist()), f"<u{width}")
        stops = running(pc.binary_length(docs.column("links")).to_numpy().astype(np.int64) // width)
        out = docs.select(names)
        for name, values in (("n_best", best), ("count_sum", n)):
            sums = running(values[links])
            out = out.append_column(name, pa.array(sums[stops[1:]] - sums[stops[:-1]]))
        return out

    docs = aligned.select(*names, "block", "links", "width")
    return docs.groupBy("block").cogroup(mine.groupBy("of_block")).applyInArrow(
        run, f"{schema}, n_best bigint, count_sum bigint"
    )
