"""SentencePiece encoding and decoding by a shared-prefix Viterbi search.

Texts are marked (a blank becomes U+2581, one more stands in front) and cut into marked words: no
piece goes on after a word's end. A task sorts the distinct marked words of a batch and walks the
trie that sorting lays out, depth first: the forward state of a prefix (best piece ending there, and
its score) is computed once and used by every word below it.

For a unigram vocabulary the best predecessor is the one with the highest score. For a BPE
vocabulary a path is valid only if every two neighbouring pieces would stay apart when merged alone;
exactly one path is, and it is what the merges give, so each state has one predecessor.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from millrace.llm.texts import ID, TEXT, id_text, id_type, small, text_array

MARK = "▁"
_WORD = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")
_PENALTY = 10.0  # of an unknown character below the lowest score


class Pieces:
    """A vocabulary read from a model file: encode and decode batches of texts."""

    def __init__(self, path: str, kind: str = "bpe", memo: int = 200_000):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.vocab_size()
        self.kind, self.memo = kind, memo
        self.pieces = [model.id_to_piece(i) for i in range(size)]
        normal = [
            i
            for i in range(size)
            if not (model.is_unknown(i) or model.is_control(i) or model.is_unused(i) or model.is_byte(i))
        ]
        self.id = {self.pieces[i]: i for i in normal}
        self.score = {self.pieces[i]: model.get_score(i) for i in normal}
        self.longest = max(map(len, self.id))
        self.byte = {
            int(self.pieces[i][3:5], 16): i for i in range(size) if model.is_byte(i)
        }
        self.unknown = model.unk_id()
        self.lowest = min(self.score.values()) - _PENALTY
        # what a piece adds to the bytes of a text
        self.bytes = [b""] * size
        for i in normal:
            self.bytes[i] = self.pieces[i].replace(MARK, " ").encode()
        for value, i in self.byte.items():
            self.bytes[i] = bytes([value])
        self.bytes[self.unknown] = " ⁇ ".encode()
        self.size = size
        self.apart: dict[int, bool] = {}
        self.words: dict[str, bytes] = {}
        self.packed = [np.array([i], "<u4").tobytes() for i in range(size)]
        # BPE: pieces that their own merges give, and by their last three characters their lengths
        self.stable = {p: i for p, i in self.id.items() if kind == "bpe" and self.merged(p) == [p]}
        ends: dict[str, set[int]] = {}
        for piece in self.stable:
            if len(piece) > 2:
                ends.setdefault(piece[-3:], {1, 2}).add(len(piece))
        self.lengths = {e: sorted(n, reverse=True) for e, n in ends.items()}

    # ---- transitions ----------------------------------------------------------------------------

    def merged(self, text: str) -> list[str]:
        """Merge neighbours, the highest score (then the leftmost) first; for short texts."""
        parts = list(text)
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = self.score.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _stay_apart(self, left: int, right: int) -> bool:
        if len(self.apart) > self.memo:
            self.apart.clear()
        pair = [self.pieces[left], self.pieces[right]]
        known = self.apart[left * self.size + right] = self.merged("".join(pair)) == pair
        return known

    def _bpe_state(self, word: str, states: list[int]) -> int:
        """Forward state after ``len(states)`` characters: the last piece; -1 for a character in none."""
        end = len(states)
        for n in self.lengths.get(word[end - 3 : end], (2, 1)) if end > 2 else (2, 1):
            piece = self.stable.get(word[end - n : end]) if n <= end else None
            if piece is None:
                continue
            before = states[end - n]
            if before < 0:
                return piece
            known = self.apart.get(before * self.size + piece)
            if self._stay_apart(before, piece) if known is None else known:
                return piece
        return self.id.get(word[end - 1], -1)

    def _unigram_state(self, word: str, states: list[tuple[float, int]]) -> tuple[float, int]:
        """Forward state after ``len(states)`` characters: (score, last piece or -1)."""
        end = len(states)
        best, found = (states[end - 1][0] + self.lowest, -1), False
        for begin in range(max(0, end - self.longest), end):
            piece = word[begin:end]
            score = self.score.get(piece)
            if score is not None and (not found or states[begin][0] + score > best[0]):
                best, found = (states[begin][0] + score, self.id[piece]), True
        return best

    def _path(self, word: str, last: list[int]) -> bytes:
        """Ids of the path to the word's end; ``last`` has the last piece of each prefix."""
        out, end = [], len(word)
        while end > 0:
            piece = last[end]
            if piece < 0:
                out.append(b"".join(self.packed[i] for i in self._fallback(word[end - 1])))
                end -= 1
            else:
                out.append(self.packed[piece])
                end -= len(self.pieces[piece])
        out.reverse()
        return b"".join(out)

    def _fallback(self, character: str) -> list[int]:
        if not self.byte:
            return [self.unknown]
        return [self.byte[b] for b in character.encode()]

    def _walk(self, words: list[str]) -> None:
        """Encode distinct words, sorted: a depth-first walk over the trie of their prefixes."""
        bpe = self.kind == "bpe"
        step = self._bpe_state if bpe else self._unigram_state
        states: list = [-1 if bpe else (0.0, -1)]
        before = ""
        for word in sorted(words):
            shared = 0
            for a, b in zip(before, word):
                if a != b:
                    break
                shared += 1
            del states[shared + 1 :]
            for _ in range(len(word) - shared):
                states.append(step(word, states))
            self.words[word] = self._path(word, states if bpe else [piece for _, piece in states])
            before = word

    # ---- texts ------------------------------------------------------------------------------------

    def _split(self, marked: str) -> list[str]:
        """Marked words; a run of marks is cut before its last one, which belongs to the word.

        Pieces of several marks merge after all others, so the last mark stays with the run only if
        the word's own first piece is the mark alone; then the run takes it along.
        """
        words = _WORD.findall(marked)
        if MARK + MARK not in marked:
            return words
        out = []
        for word in words:
            if word.startswith(MARK + MARK):
                marks = len(word) - len(word.lstrip(MARK))
                out += [word[: marks - 1], word[marks - 1 :]]
            else:
                out.append(word)
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of every text."""
        marked = [MARK + t.replace(" ", MARK) if t else "" for t in texts]
        split = list(map(self._split, marked))
        needed = set().union(*split)
        if len(self.words) > self.memo:
            self.words = {w: self.words[w] for w in needed & self.words.keys()}
        new = needed - self.words.keys()
        if new:
            self._walk(list(new))
        get = self.words.__getitem__
        mark = self.packed[self.id[MARK]] if MARK in self.id else b""
        out = []
        for text, words in zip(marked, split):
            parts = list(map(get, words))
            if MARK + MARK in text or text.endswith(MARK):
                parts = self._runs(words, parts, mark)
            out.append(b"".join(parts))
        return out

    def _runs(self, words: list[str], parts: list[bytes], mark: bytes) -> list[bytes]:
        """Let a run of marks take along a last mark that its word leaves alone."""
        out, i = list(parts), 0
        for i in range(len(words) - 1):
            run, word = words[i], words[i + 1]
            if run == MARK * len(run) and word.startswith(MARK) and mark and out[i + 1][:4] == mark:
                out[i] = b"".join(self._marks(len(run) + 1))
                out[i + 1] = out[i + 1][4:]
            elif run == MARK * len(run):
                out[i] = b"".join(self._marks(len(run)))
        return out

    def _marks(self, n: int) -> list[bytes]:
        """Ids of a run of marks: merged from the left as long as pieces go."""
        word = MARK * n
        if word not in self.words:
            self._walk([word])
        return [self.words[word]]

    def decode(self, ids: bytes) -> str:
        """Text of a row of ids; the mark put in front goes again."""
        text = b"".join(map(self.bytes.__getitem__, np.frombuffer(ids, "<u4").tolist()))
        out = text.decode("utf-8", errors="replace")
        return out[1:] if out.startswith(" ") else out


_MODELS: dict[tuple[str, str], Pieces] = {}


def _model(path: str, kind: str) -> Pieces:
    if (path, kind) not in _MODELS:
        _MODELS[path, kind] = Pieces(path, kind)
    return _MODELS[path, kind]


def encode_pieces(docs: DataFrame, path: str, kind: str = "bpe") -> DataFrame:
    """Add ``ids`` (binary, little-endian unsigned 32-bit) to ``doc_id, text``, row by row.

    Null texts count as empty and have no ids. Equal texts have equal ids, long ones are encoded whole,
    null ids are ids like others. An empty table gives no rows. No row is shuffled and extra columns
    are not read.
    """
    rows = id_text(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _model(path, kind)
        for batch in small(batches):
            texts = text_array(batch.column(TEXT))
            ids = model.encode(texts.to_numpy(zero_copy_only=False).tolist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(ID), texts, pa.array(ids, pa.binary())], names=[ID, TEXT, "ids"]
            )

    return rows.mapInArrow(run, f"{ID} {id_type(rows)}, {TEXT} string, ids binary")


def decode_pieces(encoded: DataFrame, path: str, kind: str = "bpe") -> DataFrame:
    """Add ``decoded`` to rows with ``ids``. Null ids give an empty text."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _model(path, kind)
        for batch in batches:
            texts = [model.decode(x or b"") for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, "decoded"]
            )

    return encoded.mapInArrow(run, f"{schema}, decoded string")
