"""Dictionaries as tables against plain lookups, by both joins; names over all rows; first rows."""

import random

import pytest
from pyspark.sql import functions as F

from millrace.functions import items as I
from millrace.operators import dictionaries as D
from millrace.operators import numbering


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(50)] + ["the"] * 50
    lists = [[rng.choice(words) for _ in range(rng.randrange(0, 30))] for _ in range(200)] + [None, ["the"] * 500]
    ids = [(i, "a") for i in range(200)] + [(None, "a"), (None, "b")]
    return [(*k, t) for k, t in zip(ids, lists)], "i int, part string, tokens array<string>"


@pytest.mark.parametrize("limit", [0, 100_000])
def test_both_joins_equal_plain_lookups(spark, monkeypatch, rows, limit):
    monkeypatch.setattr(D, "BROADCAST_ROWS", limit)
    data, schema = rows
    df = spark.createDataFrame(data, schema).repartition(3)
    listed = ["w1", "the", "w7", "w7", None, "other"]
    table = spark.createDataFrame([(w,) for w in listed], "w string")
    got = {(r["i"], r["part"]): r["tokens"] for r in D.drop_listed(df, ["i", "part"], F.col("tokens"), table).collect()}
    assert got == {(i, p): [t for t in ts or [] if t not in listed] for i, p, ts in data}
    names = {"w1": "one", "the": "THE", "w3": "a"}
    pairs = [*names.items(), ("w3", "b"), ("w4", None), (None, "x")]
    table = spark.createDataFrame(pairs, "w string, n string")
    got = {(r["i"], r["part"]): r["tokens"] for r in D.replace_listed(df, ["i", "part"], F.col("tokens"), table).collect()}
    assert got == {(i, p): [names.get(t, t) for t in ts or []] for i, p, ts in data}


def test_small_dictionaries_shuffle_no_tokens(spark):
    df = spark.createDataFrame([(1, ["a", None, "the", "b"]), (1, ["the"]), (2, [])], "i int, t array<string>")
    table = spark.createDataFrame([("the", "x")], "w string, n string")
    for fn, want in ((D.drop_listed, ["a", None, "b"]), (D.replace_listed, ["a", None, "x", "b"])):
        got = fn(df.select("i", "t"), ["i"], F.col("t"), table.select("w") if fn is D.drop_listed else table)
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Generate" not in plan
        assert want in [r["tokens"] for r in got.collect()]


def test_a_million_entries_equal_the_literal_list(spark, rows):
    data, schema = rows
    df = spark.createDataFrame([r for r in data if r[0] is not None], schema)
    table = spark.range(1_000_000).select(F.concat(F.lit("w"), F.col("id") * 3).alias("w"))
    plan = D.drop_listed(df, ["i"], F.col("tokens"), table)
    listed = [f"w{i}" for i in range(0, 60, 3)]
    want = {r["i"]: r["t"] for r in df.select("i", I.drop_stopwords(F.coalesce("tokens", F.array().cast("array<string>")), listed).alias("t")).collect()}
    assert {r["i"]: r["tokens"] for r in plan.collect()} == want


def test_best_displays(spark):
    items = [(1, 0, "Onions"), (1, 1, "2 onions"), (2, 0, "onion, "), (0, 5, "3 onions"), (3, 0, "red wine"), (4, 0, ""), (4, 1, None)]
    df = spark.createDataFrame(items * 2, "r int, p int, item string").repartition(4)
    got = {r["name"]: tuple(r)[1:] for r in D.best_displays(df, "item", "r", "p").collect()}
    onion = I.normalize_item(F.lit("onions"))
    assert got[spark.range(1).select(onion).first()[0]] == ("3 onions", 8, 0, 5)
    assert got["red wine"] == ("red wine", 2, 3, 0)


@pytest.mark.parametrize("small", [1, 100_000])
@pytest.mark.parametrize("ids", [range(1000), range(-500, 500, 7), [5], [2**62 - i * 10**9 for i in range(500)] + [-(2**63), 2**63 - 1]])
def test_first_rows_by_selection(spark, monkeypatch, small, ids):
    monkeypatch.setattr(numbering, "_SMALL", small)
    df = spark.createDataFrame([(i,) for i in ids], "row_id bigint").repartition(3)
    for n in (1, 7, len(list(ids)), 5000):
        assert sorted(r[0] for r in numbering.first_n(df, n).collect()) == sorted(ids)[:n]


def test_first_rows_with_nulls_repeats_and_none(spark):
    df = spark.createDataFrame([(None,), (3,), (3,), (1,), (2,)], "row_id bigint")
    assert sorted((r[0] or 0) for r in numbering.first_n(df, 4).collect()) == [0, 1, 2, 3]
    assert numbering.first_n(df.limit(0), 3).count() == 0 and numbering.seeded_sample(df.limit(0), 3).count() == 0


def test_samples_equal_numbering(spark):
    df = spark.range(20_000).withColumnRenamed("id", "row_id")
    for n in (1, 100, 3000, 50_000):
        want = numbering.number_shuffled(df, 123).where(F.col("idx") < n).select("row_id")
        assert {r[0] for r in numbering.seeded_sample(df, n).collect()} == {r[0] for r in want.collect()}
    plan = numbering.seeded_sample(df, 100)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan
