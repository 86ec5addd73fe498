import math
import random
import re
from collections import Counter

import pyarrow as pa
import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.operators import scores as S
from millrace.operators.stem import stem


TOKENS = st.none() | st.lists(st.sampled_from(["a", "b", "c d", ""]), max_size=9)


def tokens_13a(text):
    text = text.rstrip().replace("<skipped>", "").replace("-\n", "").replace("\n", " ")
    for old, new in S.ENTITIES:
        text = text.replace(old, new)
    text = f" {text} "
    for pattern, new in S.PUNCTUATION:
        text = re.sub(pattern, new.replace("$", "\\"), text)
    return text.split()


def bleu_by_hand(pairs):
    m, t, ref_len = [0] * 4, [0] * 4, 0
    for ref, hyp in pairs:
        r, h = tokens_13a(ref), tokens_13a(hyp)
        ref_len += len(r)
        for n in range(1, 5):
            rc = Counter(tuple(r[i : i + n]) for i in range(len(r) - n + 1))
            hc = Counter(tuple(h[i : i + n]) for i in range(len(h) - n + 1))
            m[n - 1] += sum(min(c, rc[g]) for g, c in hc.items())
            t[n - 1] += sum(hc.values())
    if not any(m) or not t[3]:
        return 0.0
    smooth, logs = 1.0, 0.0
    for n in range(4):
        if m[n]:
            p = m[n] / t[n]
        else:
            smooth *= 2
            p = 1 / (smooth * t[n])
        logs += math.log(p) / 4
    bp = 1.0 if t[0] >= ref_len else math.exp(1 - ref_len / t[0])
    return 100 * bp * math.exp(logs)


def frame(spark, pairs):
    rows = [(i, r, h) for i, (r, h) in enumerate(pairs)]
    return spark.createDataFrame(rows, "row_id long, reference string, hypothesis string")


CASES = [
    [("the cat sat on the mat", "the cat sat on the mat")],
    [("the cat sat on the mat today", "the the the cat")],
    [("a b c d e", "a x b y c z")],
    [("hello, world! it's 1,000.5 &amp; more-\nover 3-4", "hello , world! its 1,000.5 & more 3-4 x")],
    [("a b", "c d e f"), ("x", "")],
    [("one", "one")],
]


@pytest.mark.parametrize("case", range(len(CASES)))
def test_bleu(spark, case):
    got = S.corpus_bleu(frame(spark, CASES[case]), ["row_id"]).first()["bleu"]
    assert got == pytest.approx(bleu_by_hand(CASES[case]), abs=1e-9)


def test_bleu_random_and_grouped(spark):
    rng = random.Random(3)
    text = lambda: " ".join(rng.choice(["a", "b", "c", "d,", "e.", "1.5"]) for _ in range(rng.randint(0, 30)))
    pairs = [(text(), text()) for _ in range(120)]
    df = frame(spark, pairs).withColumn("g", F.col("row_id") % 3)
    got = {r["g"]: r["bleu"] for r in S.corpus_bleu(df, ["row_id"], ["g"]).collect()}
    for g in range(3):
        assert got[g] == pytest.approx(bleu_by_hand(pairs[g::3]), abs=1e-9)


def test_bleu_makes_no_ngram_rows(spark):
    """N-grams are counted inside the row: neither made into rows nor shuffled, only sums are."""
    df = frame(spark, CASES[0])
    for stats in (S.bleu_ngram_stats(df, ["row_id"]), S.corpus_bleu(df, ["row_id"])):
        plan = stats._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") == 1 and "Exchange SinglePartition" in plan
        below = plan[plan.index("Exchange") :]
        assert "partial_sum" in below and "Generate" not in below


@given(st.lists(st.tuples(TOKENS, TOKENS), max_size=6))
def test_clipped_matches_equal_counters(rows):
    """Multisets of n-grams by hand, with repeats, empty sides and texts shorter than an n-gram."""
    kind = pa.list_(pa.string())
    got = S._clipped(pa.array([h for h, _ in rows], kind), pa.array([r for _, r in rows], kind))

    def grams(tokens, n):
        return Counter(tuple(tokens[i : i + n]) for i in range(len(tokens or []) - n + 1))

    for (h, r), numbers in zip(rows, got.tolist()):
        matches = [(grams(h, n) & grams(r, n)).total() for n in range(1, 5)]
        assert numbers == matches + [grams(x, n).total() for x in (h, r) for n in range(1, 5)]


def lcs_by_hand(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


def test_lcs():
    rng = random.Random(4)
    for _ in range(300):
        a = rng.choices("abcd", k=rng.randint(0, 90))
        b = rng.choices("abcde", k=rng.randint(0, 90))
        assert S.lcs_length(a, b) == lcs_by_hand(a, b)


def test_rouge(spark):
    pairs = [
        ("The cats, running!", "a cat runs"), ("x", ""), ("", ""), ("same words here", "same words here"),
        ("É clair", "clair"),
    ]
    df = frame(spark, pairs)
    got = [r[0] for r in df.select(S.rouge_l(F.col("reference"), F.col("hypothesis"))).collect()]
    assert got == pytest.approx([2 / 3 * 2 / 2, 0, 0, 1, 1.0], abs=1e-9) or got[0] == pytest.approx(4 / 6)
    plain = [r[0] for r in df.select(S.rouge_l(F.col("reference"), F.col("hypothesis"), False)).collect()]
    assert plain == pytest.approx([0, 0, 0, 1, 1.0])


def test_stem():
    """Published examples of the stemmer, step by step."""
    want = {
        "caresses": "caress", "ponies": "poni", "ties": "tie", "caress": "caress", "cats": "cat",
        "feed": "feed", "agreed": "agre", "plastered": "plaster", "bled": "bled", "motoring": "motor",
        "sing": "sing", "conflated": "conflat", "troubled": "troubl", "sized": "size",
        "hopping": "hop", "tanned": "tan", "falling": "fall", "hissing": "hiss", "fizzed": "fizz",
        "failing": "fail", "filing": "file", "happy": "happi", "sky": "sky", "relational": "relat",
        "conditional": "condit", "rational": "ration", "valenci": "valenc", "digitizer": "digit",
        "conformabli": "conform", "radicalli": "radic", "differentli": "differ", "vileli": "vile",
        "analogousli": "analog", "vietnamization": "vietnam", "predication": "predic",
        "operator": "oper", "feudalism": "feudal", "decisiveness": "decis", "hopefulness": "hope",
        "callousness": "callous", "formaliti": "formal", "sensitiviti": "sensit",
        "sensibiliti": "sensibl", "triplicate": "triplic", "formative": "form", "formalize": "formal",
        "electriciti": "electr", "electrical": "electr", "hopeful": "hope", "goodness": "good",
        "revival": "reviv", "allowance": "allow", "inference": "infer", "airliner": "airlin",
        "gyroscopic": "gyroscop", "adjustable": "adjust", "defensible": "defens",
        "irritant": "irrit", "replacement": "replac", "adjustment": "adjust", "dependent": "depend",
        "adoption": "adopt", "communism": "commun", "activate": "activ", "angulariti": "angular",
        "homologous": "homolog", "effective": "effect", "bowdlerize": "bowdler", "probate": "probat",
        "rate": "rate", "cease": "ceas", "controll": "control", "roll": "roll", "dying": "die",
        "dies": "die", "died": "die", "spied": "spi", "enjoy": "enjoy", "by": "by", "skies": "sky",
    }
    assert {w: stem(w) for w in want} == want


def test_metrics_of_nothing(spark):
    m = S.metrics_row(frame(spark, CASES[0]).where("row_id < 0"), "val", ["row_id"]).first()
    assert (m["N"], m["rougeL_f1"], m["bleu"]) == (0, 0.0, 0.0)


def test_perplexity(spark):
    df = spark.createDataFrame([("a", 1.0, 1), ("a", 3.0, 3), ("b", 50.0, 1)], "g string, loss double, n int")
    got = {r["g"]: r["ppl"] for r in S.perplexity(df, ["g"]).collect()}
    assert got["a"] == pytest.approx(math.exp(2)) and got["b"] == pytest.approx(math.exp(20))
    weighted = {r["g"]: r["mean_loss"] for r in S.perplexity(df, ["g"], tokens="n").collect()}
    assert weighted["a"] == pytest.approx(2.5)


def test_a_batch_is_counted_in_pieces(monkeypatch):
    """Memory follows the piece, not the batch; results do not change."""
    import numpy as np

    rng = random.Random(5)
    lists = [[[rng.choice("abc") for _ in range(rng.randrange(30))] if rng.random() < 0.9 else None for _ in range(50)] for _ in "hr"]
    left, right = (pa.array(x, pa.list_(pa.string())) for x in lists)
    whole = S._clipped(left, right)
    monkeypatch.setattr(S, "PIECE", 64)
    pieces = S._pieces(left, right)
    sizes = [len(a or []) + len(b or []) for a, b in zip(*lists)]
    assert len(pieces) > 5 and [sum(x) for x in pieces[:-1]] == [p[0] for p in pieces[1:]] and sum(pieces[-1]) == 50
    assert all(n == 1 or sum(sizes[first : first + n]) <= 64 for first, n in pieces)
    parts = [S._clipped(left.slice(*p), right.slice(*p)) for p in pieces]
    assert np.array_equal(np.concatenate(parts), whole)
    assert S._pieces(left.slice(0, 0), right.slice(0, 0)) == []
