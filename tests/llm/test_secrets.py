"""Reported shares of identifiers and of keys, the evidence as a p value, and the base by plain patterns."""

import random

import numpy as np
import pytest

from millrace.llm import secret_scan as S

WORDS = (
    "get user account balance list item name value total count page index open close read write file path node tree "
    "parent child update delete create table column row cell format parse render request response header body token "
    "session cache store load save config option default message error warning debug trace event handler listener "
    "stream buffer queue stack vector matrix image color width height margin border shadow button window dialog"
).split()
ALPHABETS = {
    "base62": ("0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz", 32),
    "lower": ("abcdefghijklmnopqrstuvwxyz", 32),
    "hex": ("0123456789abcdef", 24),
    "base32": ("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", 32),
}


def identifiers(rng, n):
    shapes = [
        lambda w: "".join(x.capitalize() for x in w) + str(rng.randrange(10)),
        lambda w: w[0] + "".join(x.capitalize() for x in w[1:]),
        "_".join,
        lambda w: "_".join(w).upper(),
        "-".join,
        lambda w: "/".join(w) + ".py",
        lambda w: "/usr/" + "/".join(w) + "/" + "".join(x.capitalize() for x in w[:2]),
        lambda w: "".join(w),
    ]
    return [rng.choice(shapes)([rng.choice(WORDS) for _ in range(rng.randint(4, 6))]) for _ in range(n)]


def keys(rng, kind, n):
    letters, size = ALPHABETS[kind]
    return ["".join(rng.choice(letters) for _ in range(size)) for _ in range(n)]


def reported(spark, tokens, prose=True):
    """The share of tokens, each in a line of a document of its own, that have a span of their own."""
    rows = [(i, f"it stands {t} there") for i, t in enumerate(tokens)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    if prose:
        docs = docs.unionByName(spark.read.parquet("/root/testdata/sf0.001/documents.parquet").selectExpr("-1 - doc_id AS doc_id", "text"))
    found = {r["doc_id"] for r in S.find_secrets(docs).collect() if r["added"] or any(b["kind"] == "hex" for b in r["base"])}
    return np.array([i in found for i in range(len(tokens))])


@pytest.mark.parametrize("n_names, n_keys, prose", [(1000, 0, True), (1000, 100, True), (100, 1000, True), (1000, 40, False)])
def test_names_are_left_alone_and_keys_are_found(spark, n_names, n_keys, prose):
    rng = random.Random(n_names + n_keys)
    tokens = identifiers(rng, n_names)
    for kind in ALPHABETS:
        tokens += keys(rng, kind, n_keys)
    hit = reported(spark, tokens, prose)
    assert hit[:n_names].mean() < 0.01 or n_names == 100 and hit[:n_names].sum() <= 1  # of 4,000 reported
    for k, kind in enumerate(ALPHABETS):
        mine = hit[n_names + k * n_keys : n_names + (k + 1) * n_keys]
        if n_keys and (prose or kind != "lower"):  # without prose there is no law of letters
            assert mine.mean() >= 0.9, kind


def test_clean_documents_have_no_spans(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    assert sum(len(r["added"]) for r in S.find_secrets(docs).collect()) <= 2


def test_evidence_is_a_p_value():
    """Tokens drawn from the law of text itself seldom look random, whatever the level."""
    rng = random.Random(3)
    law = S.TextLaw({i: rng.randrange(100) for i in range(27 * 27)})
    probability = np.exp(np.array(law.letter))
    for _ in range(3):
        evidence = []
        for _ in range(2000):
            last, token = 26, ""
            for _ in range(20):
                last = rng.choices(range(26), probability[last])[0]
                token += chr(97 + last)
            evidence.append(law.evidence(token, S.alphabet_of(token)))
        for x in (1.0, 2.0, 3.0):
            assert np.mean(np.array(evidence) >= x) <= np.exp(-x) * 1.3


@pytest.mark.parametrize("kind", ALPHABETS)
def test_the_battery_keeps_random_tokens_and_rejects_structure(kind):
    rng = random.Random(9)
    letters, size = ALPHABETS[kind]
    tokens = keys(rng, kind, 400)
    assert np.mean([S.looks_random(t, S.alphabet_of(t)) for t in tokens]) > 0.96
    assert not S.looks_random((letters[0] + letters[-1]) * (size // 2), S.alphabet_of(tokens[0]))
    assert not S.looks_random(letters[0] * size, S.alphabet_of(tokens[0]))


@pytest.mark.parametrize("size", [128, 1024, 5000])
def test_every_symbol_counts(size):
    rng = random.Random(3)
    for kind in ("hex", "base62"):
        letters = ALPHABETS[kind][0]
        tokens = ["".join(rng.choices(letters, k=size + 127)) for _ in range(200)]
        encodings = [S.alphabet_of(t) for t in tokens]
        assert np.mean([S.looks_random(t, e) for t, e in zip(tokens, encodings)]) > 0.95
        run = letters[0] * 127  # behind a random beginning whose length is a multiple of 128
        first = [t[: size // 128 * 128] for t in tokens]
        assert not any(S.looks_random(t + run, e) for t, e in zip(first, encodings))


@pytest.mark.parametrize("shape", [str.capitalize, str.upper, lambda t: t + "==", lambda t: t[0].upper() + t[1:-1] + t[-1].upper()])
def test_every_shape_of_token_is_judged(shape):
    rng = random.Random(4)
    law = S.TextLaw({})
    for kind in ALPHABETS:
        for size in (20, 127, 128, 129, 300):
            token = shape("".join(rng.choice(ALPHABETS[kind][0]) for _ in range(size)))
            assert len(S.candidates(f"a {token} b", law)) == 1
            S.looks_random(token, S.alphabet_of(token))


def test_parts_of_paths():
    rng = random.Random(2)
    law = S.TextLaw({})
    key = keys(rng, "base62", 1)[0]
    text = f"see home/lib/{key} now"
    found = [(text[a:b], level > 0) for a, b, _, level in S.candidates(text, law)]
    assert len(found) == 1 and key in found[0][0] and found[0][1]


def test_long_and_empty_texts(spark):
    rng = random.Random(1)
    long = "".join(rng.choice("ab") for _ in range(50_000))
    rows = [(1, long), (2, ""), (3, None), (4, "=" * 50), (5, "/" * 50), (6, "a" * 20_000 + "1")]
    got = S.find_secrets(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert len(got) == 6 and not any(r["added"] for r in got)
