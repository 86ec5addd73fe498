"""Two tokenizers aligned, against whole texts by the libraries and a plain count of all links."""

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from millrace.llm import alignment
from millrace.sources.shared import materialize

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")
TEXTS = [
    "A plain sentence, with unbelievably long words.",
    "two  blanks, a line\nbreak, \t tabs \n\n and an end ",
    " leads with a blank",
    "   ",
    "",
    None,
    "▁ mark that becomes a blank",
    "in▁side",
    "<|endoftext|> and <s> are plain text </s>",
    "Größe, naïve café, 東京 と 日本語, emoji 🙂🙂 and   odd spaces　 here\r\n",
    "\x00 zero",
    "x" * 5000,
    "same text same text same text",
    "same text same text same text",
    "one two three. " * 3000,
]


def brute(texts):
    a, b = Tokenizer.from_file(BYTE_BPE), sentencepiece.SentencePieceProcessor(model_file=PIECE_BPE)
    a.encode_special_tokens = True
    letters = alignment._byte_level()
    spell_a = {i: bytes(letters.get(c, 0) for c in t) for t, i in a.get_vocab().items()}
    spell_b = [
        bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
        for i in range(b.vocab_size())
    ]
    rows, links, counts = [], [], Counter()
    for text in texts:
        ids_a = a.encode(" " + text, add_special_tokens=False).ids if text else []
        ids_b = b.encode(text) if text else []
        data = (" " + (text or "")).encode()
        if b"".join(spell_a[i] for i in ids_a) != data or b"".join(spell_b[i] for i in ids_b) != data:
            ids_a, ids_b = [], []
        at, ends_a = 0, {}
        for k, i in enumerate(ids_a):
            at += len(spell_a[i])
            ends_a[at] = k
        at, groups, mine, i0, j0 = 0, [], [], 0, 0
        for j, i in enumerate(ids_b):
            at += len(spell_b[i])
            if at in ends_a:
                k = ends_a[at]
                groups.append(",".join(map(str, ids_a[i0 : k + 1])) + "|" + ",".join(map(str, ids_b[j0 : j + 1])))
                mine.append((ids_a[k], i))
                i0, j0 = k + 1, j + 1
        counts.update(mine)
        links.append(mine)
        sha = hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""
        rows.append((len(ids_a), len(ids_b), len(groups), len(mine), sha))
    most = Counter()
    for (_, i), n in counts.items():
        most[i] = max(most[i], n)
    return [
        (*row, sum(counts[p] == most[p[1]] for p in mine), sum(counts[p] for p in mine)) for row, mine in zip(rows, links)
    ]


def run(docs):
    rows = alignment.align(docs, BYTE_BPE, PIECE_BPE)
    digest = F.when(F.col("n_groups") > 0, F.sha2(F.col("groups").cast("binary"), 256)).otherwise("")
    rows = materialize(rows.withColumn("sha", digest).drop("groups"), "aligned")
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "sha", "n_best", "count_sum"]
    return [tuple(r) for r in alignment.weigh(rows, alignment.size_of(PIECE_BPE)).select(names).collect()]


def test_edges_equal_brute_force(spark):
    rows = [(None if i == 3 else i, t, 1, 1) for i, t in enumerate(TEXTS)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, block int, pairs int").repartition(3)
    want = sorted((-1 if i == 3 else i, *row) for i, row in enumerate(brute(TEXTS)))
    assert sorted((-1 if r[0] is None else r[0], *r[1:]) for r in run(docs)) == want


def test_documents_equal_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}
    want = sorted((i, *row) for i, row in zip(texts, brute(texts.values())))
    assert sorted(run(docs.repartition(3))) == want


def test_empty_table(spark):
    assert run(spark.createDataFrame([], "doc_id bigint, text string")) == []


@pytest.mark.parametrize("memo", [0, 1000])
def test_forgetting_words_changes_nothing(memo):
    aligner = alignment.Aligner(BYTE_BPE, PIECE_BPE, memo)
    want = [row[:4] for row in brute(TEXTS)]
    for _ in range(3):
        got = [aligner.batch(pa.array([text or ""])) for text in TEXTS]
        assert [tuple(int(g[c][0]) for c in ("n_a", "n_b", "n_groups", "n_links")) for g in got] == want
    got = aligner.batch(pa.array([t or "" for t in TEXTS]))
    assert list(zip(*[got[c].tolist() for c in ("n_a", "n_b", "n_groups", "n_links")])) == want


lists = st.lists(st.tuples(st.sets(st.integers(0, 60)), st.sets(st.integers(0, 60))), max_size=5)


@given(lists)
def test_galloping(texts):
    """Texts one after another, as they lie in the bytes."""
    a = [sorted(100 * k + x for x in xs) for k, (xs, _) in enumerate(texts)]
    b = [sorted(100 * k + x for x in xs) for k, (_, xs) in enumerate(texts)]
    flat = [np.array([x for xs in side for x in xs], np.int64) for side in (a, b)]
    bounds = [np.append(0, np.cumsum([len(xs) for xs in side])).astype(np.int64) for side in (a, b)]
    i, j = alignment.common_ends(*flat, *bounds)
    common = np.intersect1d(*flat)
    assert flat[0][i].tolist() == flat[1][j].tolist() == common.tolist()
