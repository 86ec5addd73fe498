"""Whole queries against plain Python and the public libraries, row by row, on the smallest tables."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from millrace.llm import attribution, toxicity
from millrace.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
WORD = r"[^\x20\x09-\x0D]+"


@pytest.fixture(scope="module")
def docs():
    rows = pq.read_table(f"{FOLDER}/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    return sorted((r["doc_id"], r["text"] or "") for r in rows)


@pytest.fixture(scope="module")
def ids(docs):
    encoded = Tokenizer.from_file(WORD_BPE).encode_batch([t for _, t in docs], add_special_tokens=False)
    return [e.ids for e in encoded]


def rows_of(spark, name, *columns):
    return sorted(tuple(r) for r in QUERIES[name](spark, FOLDER).select(*columns).collect())


def crc(numbers):
    return zlib.crc32(np.array(numbers, "<u4").tobytes())


def test_packing(spark, docs, ids):
    want, sequence = [], 0
    for (doc, _), own in zip(docs, ids):
        own, at = [*own, 2], 0
        while at < len(own):
            size = min(4096, 1 << ((len(own) - at).bit_length() - 1))
            want.append((doc, at, size, crc(own[at : at + size]), len(own), sequence, 0))
            at, sequence = at + size, sequence + 1
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    assert rows_of(spark, "op1_power_of_two_packing", *columns) == sorted(want)


def test_records(spark, docs, ids):
    want, start = [], 0
    for (doc, _), own in zip(docs, ids):
        want.append((doc, start, len(own) + 1, crc([*own, 1])))
        start += len(own) + 1
    assert rows_of(spark, "op6_token_records", "doc_id", "start", "n_tokens", "ids_crc32") == want


def tokens_by_section(spans, sections):
    """Most characters decide, the earlier section at a tie; one that touches none goes to the last before."""
    counts, crossing = [0] * len(sections), [0] * len(sections)
    for a, b in spans:
        shared = [min(b, e) - max(a, s) for s, e in sections]
        best = max(range(len(sections)), key=lambda k: (shared[k], -k))
        if shared[best] <= 0:
            best = max([k for k, (s, _) in enumerate(sections) if s <= a], default=0)
        counts[best] += 1
        crossing[best] += a < sections[best][0] or b > sections[best][1]
    return list(zip(counts, crossing))


def test_sections(spark, docs):
    library = Tokenizer.from_file(WORD_BPE)
    few = [(i, t) for i, t in docs if len(t) < 20_000]
    windows = {i: [(s, min(s + 1000, len(t))) for s in range(0, max(len(t), 1), 1000)] for i, t in few}
    lines = {}
    for i, t in few:
        at = np.cumsum([0] + [len(x) + 1 for x in t.split("\n")])
        lines[i] = [(int(a), int(b) - 1) for a, b in zip(at, at[1:])]
    frame = spark.createDataFrame(few, "doc_id bigint, text string").repartition(3)
    for sections, found in ((windows, attribution.windows(F.col("text"), 1000)), (lines, attribution.lines(F.col("text")))):
        want = []
        for i, t in few:
            e = library.encode(t, add_special_tokens=False)
            want += [(i, k, *n) for k, n in enumerate(tokens_by_section(e.offsets, sections[i]))]
        rows = attribution.section_tokens(frame, found, WORD_BPE).select("doc_id", "section", "n_tokens", "n_crossing")
        assert sorted(map(tuple, rows.collect())) == sorted(want)


def test_sections_of_very_many_lines(spark):
    frame = spark.createDataFrame([(1, "a\n" * 50_000)], "doc_id bigint, text string")
    rows = attribution.section_tokens(frame, attribution.lines(F.col("text")), WORD_BPE)
    assert rows.agg(F.count("*"), F.sum("n_tokens")).first() == (50_001, 50_000)


def test_secret_base(spark, docs):
    kinds = [
        ("assign", r"(?ai)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", lambda m: len(m.group(2)) >= 8),
        ("access", r"AKIA[A-Z0-9]+", lambda m: len(m.group()) >= 16),
        ("hex", r"[0-9a-f]+", lambda m: len(m.group()) >= 32),
    ]
    want = []
    for doc, text in docs:
        found = [(m.start(), k, name, m.end()) for k, (name, p, good) in enumerate(kinds) for m in re.finditer(p, text) if good(m)]
        counts = Counter(f[2] for f in found)
        spans = ",".join(f"{name}:{a}:{b}" for a, _, name, b in sorted(found))
        want.append((doc, *[counts[k[0]] for k in kinds], hashlib.sha256(spans.encode()).hexdigest()))
    columns = ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256"]
    assert rows_of(spark, "op3_randomness_battery", *columns) == want


def test_edited_texts_and_likeness(spark, docs):
    got = {r["doc_id"]: r for r in QUERIES["op7_i_match"](spark, FOLDER).collect()}
    order = sorted(docs, reverse=True)
    for k, (doc, text) in enumerate(order):
        other = order[(k + 1) % len(order)]
        half = len(text) // 2
        edited = text[: len(text) - half] + other[1][:half]
        r, following = got[doc], got[other[0]]
        assert r["n_chars"] == len(text)
        assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
        assert (r["fingerprint"] == following["fingerprint"]) == (r["near_next"] == 1)
        if text == other[1]:
            assert r["near_next"] == 1
    assert len(got) == len(docs)


def test_quality_base(spark, docs):
    want = []
    for doc, text in docs:
        words = re.findall(WORD, text)
        lines = [x for x in text.split("\n") if re.search(WORD, x)]
        windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
        counts = Counter(windows)
        repeated = {i + j for i, w in enumerate(windows) if counts[w] > 1 for j in range(5)}
        n = len(words)
        failed = n < 10 or 100 * len(repeated) > 20 * n
        symbols = sum(text.count(c) for c in "#*$%&|<>")
        want.append((doc, n, sum(map(len, words)), symbols, len(lines) - len({*lines}), len(repeated), failed))
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    assert rows_of(spark, "op8_line_first_cleaning", *columns) == want
    kept = rows_of(spark, "op8_line_first_cleaning", "base_failed", "kept")
    assert not any(f and k for f, k in kept)


def test_toxicity_rows(spark, docs):
    got = rows_of(spark, "op9_levenshtein_toxicity", "doc_id", "held_out", "score", "predicted")
    assert [r[0] for r in got] == [d for d, _ in docs]
    for doc, held, score, predicted in got:
        assert held == (zlib.crc32(str(doc).encode()) % 3 == 1)
        assert 0 <= score <= 1 and predicted == (score >= 0.7)


def test_toxicity_scores_equal_the_plain_windows(spark, docs):
    """Scores of the job against scoring each text alone, and labels of the held-out third never read."""
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    model = toxicity.train(frame, labels)
    turned = labels.withColumn("toxic", F.when(toxicity.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert toxicity.train(frame, turned) == model
    from millrace.llm.automaton import Automaton

    automaton, known = Automaton(model.words, model.stems), {*model.known}
    match = lambda w: 0 if w in known else automaton.match(w)
    for r in toxicity.score_toxicity(frame, model).collect():
        abuse, quoted = toxicity.hits_of(dict(docs)[r["doc_id"]], match)
        x = toxicity._inputs(np.array([abuse]), np.array([quoted]))
        assert r["score"] == pytest.approx(float(1 / (1 + np.exp(-x @ np.array(model.weights)))[0]))
