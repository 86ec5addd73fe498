import hashlib
import random

from pyspark.sql import functions as F

from millrace.operators import batches as B
from millrace.operators import numbering as N
from millrace.operators.encode import at_least_two, attention_mask

SCHEMA = "row_id long, ids array<int>"


def test_shift_mask(spark):
    df = spark.createDataFrame([(1, [1, 5, 6, 2]), (2, [1, 2])], SCHEMA)
    got = {r["row_id"]: (r["x"], r["y"]) for r in B.shift_mask(B.assign_batches(df, 2)).collect()}
    assert got == {1: ([1, 5, 6], [5, 6, 2]), 2: ([1, 2, 0], [2, -100, -100])}
    one = spark.createDataFrame([(1, [1])], SCHEMA)
    r = B.shift_mask(B.assign_batches(one, 2)).first()
    assert (r["x"], r["y"]) == ([1], [-100])
    assert B.shift_mask(B.assign_batches(one.where("row_id < 0"), 2)).count() == 0


def test_padding(spark):
    df = spark.createDataFrame([(1, [1, 5, 2]), (2, [1])], SCHEMA)
    left = {r["row_id"]: (r["input_ids"], r["mask"]) for r in B.pad_batch(B.assign_batches(df, 2), left=True).collect()}
    assert left == {1: ([1, 5, 2], [1, 1, 1]), 2: ([0, 0, 1], [0, 0, 1])}
    fixed = B.pad_batch(B.assign_batches(df, 2), pad_to=2).orderBy("row_id").collect()
    assert [r["input_ids"] for r in fixed] == [[1, 5, 2], [1, 0]]
    assert df.select(attention_mask(F.col("ids"))).first()[0] == [1, 1, 1]
    assert [r[0] for r in df.select(at_least_two(F.col("ids"))).collect()] == [[1, 5, 2], [1, 0]]


def test_numbers(spark):
    """Dense and in order for clustered, sparse and negative ids."""
    rng = random.Random(2)
    ids = {(p << 33) + i for p in range(5) for i in range(200)}
    ids |= {rng.randrange(-(2**62), 2**62) for _ in range(500)} | set(range(2**20 - 50, 2**20 + 50))
    df = spark.createDataFrame([(i,) for i in ids], "row_id long").repartition(5)
    got = {r["row_id"]: r["idx"] for r in N.number_by_id(df).collect()}
    assert got == {v: i for i, v in enumerate(sorted(ids))}
    got = {r["row_id"]: r["idx"] for r in N.number_shuffled(df, 9).collect()}
    order = sorted(ids, key=lambda i: hashlib.md5(f"{i}#9".encode()).hexdigest())
    assert got == {v: i for i, v in enumerate(order)}


def test_epochs_differ(spark):
    df = spark.range(100).withColumnRenamed("id", "row_id")
    one, two = (
        {r["row_id"]: (r["batch_id"], r["pos"]) for r in B.assign_batches(df, 16, 42, e).collect()}
        for e in (1, 2)
    )
    assert one != two and set(one.values()) == set(two.values())
    assert max(b for b, _ in one.values()) == 6


def test_token_stats(spark):
    df = spark.createDataFrame([(1, [1] * 10), (2, [1] * 4), (3, [1] * 7)], SCHEMA)
    r = B.token_stats(df.withColumn("split", F.lit("a")), "split", 2, 8).first()
    assert (r["samples"], r["tokens"], r["approx_tokens"]) == (3, 7 + 3 + 6, 2 * 2 * 6)
    assert abs(r["truncated_share"] - 1 / 3) < 1e-9 and abs(r["pad_share"] - (1 - 19 / 24)) < 1e-9


def test_first_rows(spark):
    """The first rows by id and in seeded order."""
    df = spark.createDataFrame([(i * 7919 % 1000003,) for i in range(500)], "row_id long")
    ids = lambda out: sorted(r["row_id"] for r in out.collect())
    top = ids(N.first_n(df, 40)), ids(N.seeded_sample(df, 40, seed=5))
    assert top[0] == sorted(i * 7919 % 1000003 for i in range(500))[:40]
    want = sorted((i * 7919 % 1000003 for i in range(500)), key=lambda i: hashlib.md5(f"{i}#5".encode()).hexdigest())
    assert top[1] == sorted(want[:40])
    assert N.first_n(df, 0).count() == N.seeded_sample(df, 0).count() == 500


def test_loader(spark):
    from millrace.operators.bpe import Vocabulary
    from millrace.plans import loader

    vocab = Vocabulary(["a", "b", "ab"], [("a", "b")], lower=False, nfkc=False)
    texts = spark.createDataFrame([(1, "ab"), (2, "aba"), (3, "b")], "row_id long, text string")
    got = loader.encode_batch(texts, vocab, 2, left=True, pad_to=4).orderBy("row_id").collect()
    assert [r["input_ids"] for r in got] == [[0, 1, 10, 2], [1, 10, 8, 2], [0, 1, 9, 2]]
    assert [(r["batch_id"], r["pos"]) for r in got] == [(0, 0), (0, 1), (1, 0)]
    cached = texts.select("row_id", F.array(F.lit(1), F.lit(5), F.lit(2)).alias("ids"))
    assert loader.training_batches(cached, 2).count() == 3
    first = loader.validation_batches(cached, 2).orderBy("batch_id", "pos").first()
    assert (first["x"], first["y"]) == ([1, 5], [5, 2])


def test_wide_rows_that_follow_each_other_are_many_groups(spark):
    """20,000 ids in a row are numbered in groups of at most 4,096, and get the same numbers as by hand."""
    from millrace.operators import numbering

    assert 1 << numbering._LEVELS[0] <= 4096
    ids = [*range(-3, 20_000), 1 << 27, (1 << 27) + 5, 1 << 41, (1 << 62) + 1]
    df = spark.createDataFrame([(i,) for i in ids], "row_id bigint").repartition(3)
    got = {r["row_id"]: r["idx"] for r in numbering.number_by_id(df).collect()}
    assert got == {i: k for k, i in enumerate(ids)}
