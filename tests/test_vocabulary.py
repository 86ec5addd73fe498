"""Words, merges, ids: against the public tokenizer package and against brute force."""

import random
import unicodedata
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.functions.rules import SPECIALS
from millrace.operators import bpe, encode, words
from millrace.plans import vocabulary

tokenizers = pytest.importorskip("tokenizers")

SAMPLE = [
    "It's  we'll I'd you've\n\n 12½ abc_def --> x!! ", "naïve ﬁne Ａbc　d", "a\tb\x1cc  \n", "",
    "日本語 テスト ½ kg", "aaaa aaa aa banana bananas", "\xa0x  ", "[EOS]x <ING> y [PAD][PAD]",
    "＜ING＞ [eos] [ EOS]", "é é", "emoji 😀😀 ok", "the " * 40 + "end",
]


def package(vocab_size, texts, lower=True, nfkc=True, min_frequency=2):
    tk = tokenizers.Tokenizer(tokenizers.models.BPE(unk_token="[UNK]"))
    norms = [tokenizers.normalizers.NFKC()] * nfkc + [tokenizers.normalizers.Lowercase()] * lower
    if norms:
        tk.normalizer = tokenizers.normalizers.Sequence(norms)
    tk.pre_tokenizer = tokenizers.pre_tokenizers.ByteLevel(add_prefix_space=False)
    tk.decoder = tokenizers.decoders.ByteLevel()
    trainer = tokenizers.trainers.BpeTrainer(
        vocab_size=vocab_size, min_frequency=min_frequency, special_tokens=SPECIALS,
        show_progress=False,
    )
    tk.train_from_iterator(texts, trainer=trainer)
    return tk


def tokens_of(tk):
    return [t for t, _ in sorted(tk.get_vocab().items(), key=lambda p: p[1])]


@pytest.fixture(scope="module")
def docs(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    return rows.repartition(4, "doc_id").cache()


@pytest.fixture(scope="module")
def trained(spark, docs):
    texts = [r["text"] for r in docs.collect()]
    return package(300, texts), vocabulary.build_vocabulary(docs, 300, lower=True, nfkc=True)


def test_pretokenize(apply, docs):
    texts = SAMPLE + [r["text"] for r in docs.limit(100).collect()]
    pre = tokenizers.pre_tokenizers.ByteLevel(add_prefix_space=False)
    got = apply(lambda c: F.transform(words.pretokenize(c), words.to_letters), texts)
    assert got == [[w for w, _ in pre.pre_tokenize_str(t)] for t in texts]
    assert apply(lambda c: F.array_join(words.pretokenize(c), ""), texts) == texts


def test_letters(apply):
    texts = SAMPLE + [chr(c) for c in (0, 0x7F, 0xFF, 0x100, 0x2028, 0x1F600)]
    assert apply(lambda c: words.from_letters(words.to_letters(c)), texts) == texts
    assert len(set(words.byte_letters())) == 256


def test_nfkc(apply):
    texts = SAMPLE + ["plain", "déjà vu", "ſt", "ä", "ẛ̣", "ĳ"]
    assert apply(words.nfkc, texts) == [unicodedata.normalize("NFKC", t) for t in texts]


def test_word_counts(spark, docs):
    got = {r["word"]: r["n"] for r in words.word_counts(docs, F.lower("text")).collect()}
    pre = tokenizers.pre_tokenizers.ByteLevel(add_prefix_space=False)
    want = Counter()
    for r in docs.collect():
        text = r["text"].lower()
        want.update(text[a:b] for _, (a, b) in pre.pre_tokenize_str(text))
    assert got == want


def test_chunks_of_normalized_words(spark, docs):
    """Chunks are counted before they are normalized; no character ends as white space unless it is some."""
    white = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000 and chr(c).isspace() and c not in range(0x1C, 0x20)]
    for c in range(0x110000):
        if not 0xD800 <= c < 0xE000 and chr(c) not in white:
            assert unicodedata.normalize("NFKC", chr(c))[-1] not in white
    for c in white:  # a blank starts anew
        assert all(unicodedata.normalize("NFKC", x + c + "\u0301") == x + unicodedata.normalize("NFKC", c + "\u0301") for x in "aéΣ")
    odd = SAMPLE + ["a\u00a0b", "x\u2003 y\u3000\u0301z", "ΑΣ ΑΣ\u0301", "¨ ¨a", " a  b ", "\n\nc", "İ I"]
    df = docs.select("text").unionByName(spark.createDataFrame([(t,) for t in odd], "text string"))
    normal = lambda c: words.normalize_text(c)
    got = words.word_counts(df, F.col("text"), normal)
    assert {r["word"]: r["n"] for r in got.collect()} == Counter(
        w for r in df.select(words.pretokenize(normal(F.col("text"))).alias("w")).collect() for w in r["w"]
    )
    many = spark.createDataFrame([("the same words again",)] * 1000, "text string")
    plan = words.word_counts(many, F.col("text"), normal)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("ArrowEvalPython") < plan.rindex("keys=[chunk")  # counted below Python


def test_vocabulary_equals_package(trained):
    tk, vocab = trained
    assert vocab.tokens == tokens_of(tk)


@pytest.mark.parametrize("seed", range(4))
def test_small_corpora(spark, seed):
    """Dense ties, repeated letters, minimum frequency."""
    rng = random.Random(seed)
    texts = [
        " ".join("".join(rng.choice("abcd"[: 2 + seed % 3]) for _ in range(rng.randint(1, 9))) for _ in range(12))
        for _ in range(40)
    ]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "row_id long, text string")
    vocab = vocabulary.build_vocabulary(df, 60, min_frequency=3)
    assert vocab.tokens == tokens_of(package(60, texts, lower=False, nfkc=False, min_frequency=3))


@pytest.mark.parametrize("head, run, pending", [(50_000, 512, 512), (3, 512, 512), (7, 2, 1), (1, 1, 5)])
def test_merges_against_one_by_one(spark, monkeypatch, head, run, pending):
    """Merging a whole run of pairs per round equals plain greedy merging, whatever the driver knows."""
    for name, value in (("_HEAD", head), ("_RUN", run), ("_PENDING", pending)):
        monkeypatch.setattr(bpe, name, value)
    rng = random.Random(11)
    counts = Counter("".join(rng.choice("abcde") for _ in range(rng.randint(2, 8))) for _ in range(300))
    table = spark.createDataFrame(list(counts.items()), "word string, n long")
    vocab = bpe.train_bpe(table, 8 + 5 + 60, 2)
    work = {w: list(w) for w in counts}
    order = {c: i for i, c in enumerate("abcde")}
    merges = []
    while len(merges) < 60:
        pairs = Counter()
        for w, syms in work.items():
            for p in zip(syms, syms[1:]):
                pairs[p] += counts[w]
        pair, n = min(pairs.items(), key=lambda x: (-x[1], order[x[0][0]], order[x[0][1]]))
        if n < 2:
            break
        merges.append(pair)
        order.setdefault("".join(pair), len(order))
        for syms in work.values():
            i = 0
            while i < len(syms) - 1:
                if (syms[i], syms[i + 1]) == pair:
                    syms[i : i + 2] = ["".join(pair)]
                i += 1
    assert vocab.merges == merges[: len(vocab.merges)]
    assert len(set(vocab.pieces)) == 65


def test_block_changes_equal_recounts():
    """Signed changes of pair counts against counting all words again, with runs of one symbol."""
    rng = random.Random(4)
    for _ in range(50):
        words = ["".join(rng.choice("aab") for _ in range(rng.randint(1, 7))) for _ in range(30)]
        syms = np.array([x for w in words for x in [*map(ord, w), 0]], np.int32)
        block = bpe._Block.of(syms, np.array([rng.randint(1, 9) for _ in words]))
        done = [(ord("a"), ord("a"), 5000), (5000, ord("b"), 5001)][: rng.randint(0, 2)]
        new = [(ord("a"), ord("b"), 5002)]
        before, after = (dict(zip(*map(np.ndarray.tolist, block.totals(m)))) for m in (done, done + new))
        got = dict(zip(*map(np.ndarray.tolist, block.deltas(done, new))))
        assert got == {p: after.get(p, 0) - before.get(p, 0) for p in {*before, *after} if after.get(p) != before.get(p)}
        again = block.rewritten(done)
        assert dict(zip(*map(np.ndarray.tolist, again.totals(new)))) == after


def test_encode_equals_package(spark, docs, trained):
    tk, vocab = trained
    extra = spark.createDataFrame([(10**6 + i, t) for i, t in enumerate(SAMPLE + [None])], "doc_id long, text string")
    rows = encode.encode_corpus(docs.unionByName(extra), "text", vocab, add_special=False).collect()
    for r in rows:
        assert r["ids"] == tk.encode(r["text"] or "").ids, r["text"]


def test_decode_equals_package(spark, docs, trained):
    tk, vocab = trained
    extra = spark.createDataFrame([(10**6 + i, t) for i, t in enumerate(SAMPLE)], "doc_id long, text string")
    coded = encode.encode_corpus(docs.unionByName(extra), "text", vocab)
    rows = coded.select("ids", encode.decode(F.col("ids"), vocab).alias("back")).collect()
    for r in rows:
        ids = r["ids"][: r["ids"].index(2)]
        assert r["back"] == tk.decode(ids, skip_special_tokens=True)


def test_unknown_bytes(spark):
    vocab = bpe.Vocabulary(["a", "b", "ab"], [("a", "b")], lower=False, nfkc=False)
    df = spark.createDataFrame([("abéb",)], "text string")
    assert encode.encode_corpus(df, "text", vocab).first()["ids"] == [1, 10, 3, 3, 9, 2]
    cut = encode.encode_corpus(df, "text", vocab, max_len=3).first()["ids"]
    assert cut == [1, 10, 3]


def test_long_word(spark, trained):
    tk, vocab = trained
    text = "abcdefghij" * 3000
    df = spark.createDataFrame([(text,)], "text string")
    assert encode.encode_corpus(df, "text", vocab, add_special=False).first()["ids"] == tk.encode(text).ids


def test_corpus_limit(spark):
    rows = [(i, "t", "i", "Title: x\ny" if i % 2 else "", "train" if i < 6 else "val") for i in range(10)]
    df = spark.createDataFrame(rows, "row_id long, title string, ingredients string, recipe string, split string")
    got = vocabulary.corpus(df, ("val", "train"), sample_limit=6)
    assert sorted(r["row_id"] for r in got.collect()) == [0, 1, 6, 7, 8, 9]
    only = vocabulary.corpus(df, ("train",), fields=("recipe",))
    assert sorted(r["row_id"] for r in only.collect()) == [1, 3, 5]


def test_pieces_of_a_batch_give_the_ids_of_the_whole():
    import pyarrow as pa

    rng = random.Random(2)
    coded = {f"w{i}": np.arange(i % 5 + 1, dtype=np.int32).tobytes() for i in range(40)}
    flat = pa.array([rng.choice(list(coded)) for _ in range(1000)])
    want = [i for w in flat.to_pylist() for i in np.frombuffer(coded[w], np.int32)]
    for size in (1, 7, 1000):
        parts = [encode._ids_of(flat.slice(k, size), coded.__getitem__) for k in range(0, 1000, size)]
        assert [i for ids, _ in parts for i in ids] == want
        assert all(ends[-1] == len(ids) for ids, ends in parts)
