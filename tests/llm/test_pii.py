"""Personal data that no strict format holds is learned, added and redacted."""

import random

from millrace.llm import pii


def iban(rng):
    body = "".join(rng.choice("0123456789") for _ in range(18))
    return f"DE{98 - int(body + '131400') % 97:02d}{body}"


def test_loose_kinds_are_added(spark):
    rng, rows = random.Random(5), []
    for i in range(300):
        a, b, c = rng.randrange(200, 999), rng.randrange(200, 999), rng.randrange(1000, 9999)
        rows += [
            (5 * i, f"Please pay to {iban(rng)} today."),
            (5 * i + 1, f"Write to user{i} (at) host{i % 7} (dot) org for more."),
            (5 * i + 2, f"Please call ({a}) {b}-{c} after noon."),
            (5 * i + 3, f"The order 2024{rng.randrange(10**6, 10**7)} was shipped."),
            (5 * i + 4, f"The bell of ({a}) {b}-{c} is new." if i < 5 else f"It was on 2024-{i % 12 + 1:02d}-11 again."),
        ]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    out = {r["doc_id"]: r for r in pii.find_pii(docs).collect()}
    share = lambda k, mark: sum(mark in out[5 * i + k]["redacted"] for i in range(300)) / 300
    assert share(0, "[ACCOUNT]") == share(1, "[ADDRESS]") == 1
    assert share(2, "[NUMBER]") == 1 and share(3, "[NUMBER]") == 0
    assert not any(out[i]["base"] for i in range(1500))


def test_check_sum_of_accounts(spark):
    rows = [("DE89370400440532013000",), ("GB82 WEST 1234 5698 7654 32",), ("DE89370400440532013001",)]
    df = spark.createDataFrame(rows, "a string")
    assert [r[0] for r in df.select(pii._mod97(df["a"])).collect()] == [True, True, False]


def test_sure_spans_need_no_trees(spark):
    """Five documents: too few to teach anything."""
    rng = random.Random(1)
    rows = [(i, f"Pay {iban(rng)} or write to me{i} (at) host (dot) org, or call 555 12{i} 4567.") for i in range(5)]
    rows += [(9, "It was in 2019 2020 2021, at (at) night, DE00370400440532013000.")]
    out = pii.find_pii(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    for r in out:
        marks = [r["redacted"].count(m) for m in ("[ACCOUNT]", "[ADDRESS]", "[NUMBER]")]
        assert marks == ([0, 0, 0] if r["doc_id"] == 9 else [1, 1, 1]), r


def plain_base(text):
    """The strict formats by Python's patterns, as the contract words them."""
    import re

    def luhn(d):
        v = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(d))]
        return sum(x - 9 * (x > 9) for x in v) % 10 == 0

    digits = lambda m: re.sub("[^0-9]", "", m)
    kinds = [
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 13 <= len(digits(m)) <= 19 and luhn(digits(m))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(digits(m)) <= 15),
    ]
    return [(k, m.start(), m.end()) for k, p, good in kinds for m in re.finditer(p, text or "") if good(m.group())]


def test_base_equals_plain_patterns(spark):
    rng = random.Random(7)
    parts = ["a@b.co", "x.y@h-1.org.", "1.2.3.4", "256.1.1.1", "1.2.3.4.5.6.7.8", "4111 1111 1111 1111", "+49 30 (12) 34-56 7",
             "+1", "007", " ", "-", "@", ".", "é", "🙂", "12", "(", ")", "\n"]
    texts = ["".join(rng.choice(parts) + rng.choice(["", " "]) for _ in range(rng.randint(0, 25))) for _ in range(400)] + [None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    docs = docs.unionByName(spark.read.parquet("/root/testdata/sf0.001/documents.parquet").selectExpr("doc_id + 1000 AS doc_id", "text"))
    want = {r["doc_id"]: plain_base(r["text"]) for r in docs.collect()}
    got = {r["doc_id"]: [(s["kind"], s["start"], s["end"]) for s in r["base"]] for r in pii.find_pii(docs).collect()}
    assert got == want
