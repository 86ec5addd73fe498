"""The pipeline's near-copy stage on planted rows."""

import random

import corpus_pipeline
import pytest
from corpus_pipeline import drop_near_copies
from tokenizers import Tokenizer

from millrace.llm import line_quality, pii, toxicity
from millrace.llm.queries import WORD_BPE


def text_of(seed, n=100):
    rng = random.Random(seed)
    return [f"w{rng.randrange(10**9)}" for _ in range(n)]


def changed(words, *places):
    return " ".join(f"x{i}" if i in places else w for i, w in enumerate(words))


def kept(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    return sorted(((r["doc_id"] or 0, r["text"]) for r in drop_near_copies(spark, docs, "").collect()), key=repr)


def test_copies_between_the_two_limits(spark):
    """100 words: two changed ones give 86 / 106 of the 5-word shingles, three give 81 / 111."""
    a, b = text_of(1), text_of(2)
    rows = [
        (1, " ".join(a), "x"),
        (2, changed(a, 30, 70), "x"),
        (3, " ".join(b), "x"),
        (4, changed(b, 20, 50, 80), "x"),
        (5, " ".join(text_of(3)), "x"),
    ]
    assert [i for i, _ in kept(spark, rows)] == [1, 3, 4, 5]


def test_rows_are_told_apart_by_id_and_text(spark):
    """Null ids, a shared id with different texts, a copy under another's id, and repeated rows."""
    a, b, c, d, e = (" ".join(text_of(i)) for i in range(10, 15))
    rows = [
        (None, a, "x"),
        (None, b, "x"),
        (None, b, "x"),
        (7, c, "x"),
        (7, d, "x"),
        (3, changed(d.split(), 50), "x"),
        (9, e, "x"),
        (9, e, "x"),
        (None, e, "x"),
        (None, "", "x"),
        (None, None, "x"),
    ]
    want = [(0, a), (0, b), (0, ""), (0, None), (3, changed(d.split(), 50)), (7, c), (9, e)]
    assert sorted(kept(spark, rows), key=repr) == sorted(want, key=repr)


SCHEMA = "doc_id bigint, text string, source string, n_chars bigint, score double, kept boolean, row int, rest int"
TEXTS = [
    "A plain text of more than ten words that says nothing bad about you or anyone else here.",
    "Write to a.b@c.de or call +49 30 1234567 for more of all this, it is quite free of charge.",
    "Home | About | Contact | Login | Search | Help\nA plain text of more than ten words, with a menu line above it, stays.",
    "You are a vile scumbo, scumbo, and you know it, you scumbo, as all the others here do!",
    "",
    None,
    "Long words of a long text, again and again. " * 3000,
]


@pytest.fixture(scope="module")
def stage_docs(spark):
    rows = [(None if i == 5 else i // 2, t, "x", len(t or ""), 0.5, False, 1, 2) for i, t in enumerate([*TEXTS, *TEXTS])]
    return spark.createDataFrame(rows, SCHEMA)


def plain(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_toxicity_stage_keeps_rows_as_they_are(spark, stage_docs, monkeypatch):
    """Against scoring alone: all rows below the limit, every column of them, null texts too."""
    model = toxicity.Model(["scumbo"], [], [], [-5.0, 6.0, 6.0, 0.0])
    monkeypatch.setattr(toxicity, "train", lambda docs, labels: model)
    got = corpus_pipeline.remove_toxic(spark, stage_docs, "/root/testdata/sf0.001")
    assert got.dtypes == stage_docs.dtypes
    assert plain(got) == plain(stage_docs.where("text IS NULL OR text NOT LIKE '%scumbo%'"))


def test_quality_stage(spark, stage_docs):
    judged = line_quality.clean_lines(stage_docs).where("kept").select("doc_id", "clean_text").collect()
    got = corpus_pipeline.clean_lines(spark, stage_docs, "")
    assert got.dtypes == stage_docs.dtypes
    assert sorted((r["doc_id"], r["text"]) for r in got.collect()) == sorted(map(tuple, judged))
    assert all(r["n_chars"] == len(r["text"]) and "Login" not in r["text"] for r in got.collect())
    assert {TEXTS[0], TEXTS[1]} <= {r["text"] for r in got.collect()}


def test_pii_stage(spark, stage_docs):
    got = corpus_pipeline.redact_pii(spark, stage_docs, "")
    assert got.dtypes == stage_docs.dtypes and got.count() == stage_docs.count()
    want = sorted(r["redacted"] for r in pii.find_pii(stage_docs).collect())
    assert sorted(r["text"] or "" for r in got.collect()) == want
    assert any(t.startswith("Write to [EMAIL] or call [PHONE] for") for t in want)
    assert all(r["n_chars"] == len(r["text"] or "") for r in got.collect())


def test_packing_stage(spark, stage_docs):
    library, want = Tokenizer.from_file(WORD_BPE), []
    for text in [*TEXTS, *TEXTS]:
        want.append(library.encode(text or "", add_special_tokens=False).ids + [2])
    rows = corpus_pipeline.pack(spark, stage_docs, "").orderBy("sequence_id").collect()
    assert [r["sequence_id"] for r in rows] == list(range(len(rows)))
    assert all(r["length"] == len(r["ids"]) // 4 and r["length"] & (r["length"] - 1) == 0 for r in rows)
    found, ids = [], []
    for r in rows:
        ids = ([] if r["start"] == 0 else ids) + [int.from_bytes(r["ids"][k : k + 4], "little") for k in range(0, len(r["ids"]), 4)]
        if len(ids) == r["doc_tokens"]:
            found.append(ids)
    assert sorted(found) == sorted(want)


def test_stages_of_empty_tables(spark, stage_docs):
    none = stage_docs.limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, "/root/testdata/sf0.001").count() == 0, name
