import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.operators import heads as H
from millrace.operators import runs as R

SCHEMA = "run_id long, epoch int, loss double"


def stop_by_hand(losses, patience, delta):
    best, bad, out = float("inf"), 0, []
    for loss in losses:
        improved = loss < best - delta
        best, bad = (loss, 0) if improved else (best, bad + 1)
        out.append((improved, bad))
    stop = next((i + 1 for i, (_, b) in enumerate(out) if b >= patience), None)
    return out, stop


def test_golden(spark):
    log = spark.createDataFrame([(1, i + 1, float(x)) for i, x in enumerate([3, 2, 2.5, 2, 2.1, 1])], SCHEMA)
    rows = R.early_stop(log).orderBy("epoch").collect()
    assert [r["improved"] for r in rows] == [True, True, False, False, False, True]
    assert [r["bad_epochs"] for r in rows] == [0, 0, 1, 2, 3, 0]
    assert {r["stop_epoch"] for r in rows} == {5}
    best = R.best_epoch(R.early_stop(log)).first()
    assert (best["best_epoch"], best["best_loss"], best["last_epoch"]) == (2, 2.0, 5)


@pytest.mark.parametrize("delta", [0.0, 0.3])
def test_against_step_by_step(spark, delta):
    """One run far longer than a block, next to short ones."""
    rng = random.Random(6)
    runs = {1: [rng.uniform(0, 100) / (1 + i / 400) for i in range(5000)]}
    runs |= {k: [round(rng.uniform(0, 5), 1) for _ in range(rng.randint(1, 40))] for k in range(2, 30)}
    rows = [(k, i + 1, x) for k, xs in runs.items() for i, x in enumerate(xs)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got = {}
    for r in R.early_stop(df, 4, delta).collect():
        got.setdefault(r["run_id"], {})[r["epoch"]] = (r["improved"], r["bad_epochs"], r["stop_epoch"])
    for k, losses in runs.items():
        steps, stop = stop_by_hand(losses, 4, delta)
        assert [got[k][i + 1] for i in range(len(losses))] == [(a, b, stop) for a, b in steps]


@pytest.mark.parametrize("block_bits", [2, 10])
def test_hot_falling_run_and_null_run(spark, monkeypatch, block_bits):
    """A run that falls all the time, with blocks and parts of a few rows, beside one without an id."""
    monkeypatch.setattr(R, "_BLOCK_BITS", block_bits)
    rng = random.Random(8)
    runs = {7: [100 - i * 0.01 + rng.uniform(0, 0.02) for i in range(1500)], None: [5.0, 4.9, 4.0, 4.5, 3.2, 3.3]}
    runs[8] = [10 - 0.25 * i for i in range(30)]  # ties with delta
    rows = [(k, i + 1, x) for k, xs in runs.items() for i, x in enumerate(xs)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    for delta in (0.0, 0.25):
        got = {(r["run_id"], r["epoch"]): (r["improved"], r["bad_epochs"], r["stop_epoch"]) for r in R.early_stop(df, 30, delta).collect()}
        assert len(got) == len(rows)
        for k, losses in runs.items():
            steps, stop = stop_by_hand(losses, 30, delta)
            assert [got[k, i + 1] for i in range(len(losses))] == [(a, b, stop) for a, b in steps]


def test_steps_compose():
    """Any cut of a run into stretches gives the same improvements as going through it."""
    import pandas as pd

    rng = random.Random(5)
    for _ in range(200):
        losses = [round(rng.uniform(0, 3) - 0.05 * i, 1) for i in range(rng.randint(1, 25))]
        delta, start = rng.choice([0.1, 0.3, 1.0]), rng.choice([None, 2.0])
        cut = sorted(rng.sample(range(len(losses)), min(3, len(losses))))
        lowest, best, out = start, start, []
        for a, b in zip([0, *cut], [*cut, len(losses)]):
            rows, low = [], lowest
            for e in range(a, b):
                if low is None or losses[e] < low:
                    rows.append((1, 0, e, losses[e], low))
                    low = losses[e]
            if rows:
                table = pd.DataFrame(rows, columns=["run_id", "block", "epoch", "loss", "lowest"]).astype({"lowest": float})
                out.append(R._block_steps(delta)(table))
            lowest = low
        came, epoch = float("nan") if start is None else start, -1
        for e, x in enumerate(losses):
            if best is None or x < best - delta:
                best, epoch = x, e
        if not out:
            assert epoch == -1
            continue
        together = pd.concat([o.assign(block=k, part=0) for k, o in enumerate(out)])
        whole = R._steps(next(R._composed(delta)(together).itertuples()), delta)
        for steps in ([R._steps(next(o.itertuples()), delta) for o in out], [whole]):
            b, e = np.array([came]), np.array([-1])
            for s in steps:
                b, e = s.after(b, e)
            assert e[0] == epoch and (epoch < 0 or b[0] == best)


def test_sweep(spark):
    rows = [("f", p, v) for p, v in [("a", 3.0), ("a", 1.0), ("b", 2.0), ("c", 1.0), ("d", 9.0)]]
    df = spark.createDataFrame(rows, "family string, lr string, loss double")
    got = R.sweep_rank(df, ["lr"], "loss", ["family"], top=3).collect()
    assert sorted((r["lr"], r["rank"]) for r in got) == [("a", 1), ("b", 3), ("c", 1)]


def test_sweep_of_one_hot_family(spark):
    """All settings in one family, many ties, null families and losses, over several ranges."""
    rng = random.Random(2)
    rows = [("hot", i, float(rng.randrange(40) if i % 3 else 7)) for i in range(900)]
    rows += [(None, i, float(i % 4)) for i in range(30)] + [("cold", 0, None), ("cold", 1, 2.0), ("cold", 2, 2.0)]
    log = spark.createDataFrame(rows * 2, "family string, lr int, loss double").repartition(5)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = R.sweep_rank(log, ["lr"], "loss", ["family"]).collect()
        few = R.sweep_rank(log, ["lr"], "loss", ["family"], top=2).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    low = lambda x: float("-inf") if x is None else x
    want = {}
    for f, i, x in rows:
        want[f, i] = 1 + sum(low(y) < low(x) for g, _, y in rows if g == f)
    assert {(r["family"], r["lr"]): r["rank"] for r in got} == want and len(got) == len(rows)
    assert {(r["family"], r["lr"]) for r in few} == {k for k, n in want.items() if n <= 2}
    assert all(r["epochs"] == 2 for r in got)


def test_head_mass(spark):
    df = spark.createDataFrame([("g", i, w) for i, w in zip("abcd", [0.5, 0.3, 0.15, 0.05])], "g string, i string, w double")
    keep = lambda **o: sorted(r["i"] for r in H.head_mass(df, "g", "i", "w", **o).collect())
    assert keep(k=3, p=0.9) == ["a", "b"]
    assert keep(k=3, p=0.96, renorm=False) == ["a", "b", "c"]
    assert keep(k=3, p=0.1) == ["a"]
    assert keep(k=2, p=1.0) == ["a", "b"]
    shares = {r["i"]: r["share"] for r in H.head_mass(df, "g", "i", "w", k=3, p=0.9).collect()}
    assert shares["a"] == pytest.approx(0.625)
    with pytest.raises(ValueError):
        H.head_mass(df, "g", "i", "w", k=-1)


@pytest.mark.parametrize("p", [0.5, 0.9, 1.0])
def test_head_without_a_limit_of_a_hot_group(spark, p):
    """One group with most rows and many ties, a null group, over several ranges, step by step."""
    rng = random.Random(5)
    rows = [("hot", i, float(rng.randrange(1, 9))) for i in range(700)] + [(None, i, 1.0) for i in range(5)] + [("x", 0, 2.0)]
    df = spark.createDataFrame(rows, "g string, i int, w double").repartition(4)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {(r["g"], r["i"]): (r["place"], r["cum"], r["share"]) for r in H.head_mass(df, "g", "i", "w", k=0, p=p).collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    want = {}
    for g in ("hot", None, "x"):
        own = sorted((-w, i) for h, i, w in rows if h == g)
        total, cum, kept = -sum(w for w, _ in own), 0.0, []
        for place, (w, i) in enumerate(own, 1):
            cum -= w
            if p == 1.0 or cum / total <= p or place == 1:
                kept.append((place, cum / total, -w, i))
        left = sum(k[2] for k in kept)
        want |= {(g, i): pytest.approx((place, c, w / left)) for place, c, w, i in kept}
    assert got == want


def test_softmax(spark):
    df = spark.createDataFrame([("g", 1.0), ("g", 3.0), ("h", 1000.0)], "g string, s double")
    got = sorted(r["prob"] for r in H.group_softmax(df, "g", "s", 2.0).collect())
    assert got == pytest.approx([0.2689414, 0.7310586, 1.0])
    cold = sorted(r["prob"] for r in H.group_softmax(df, "g", "s", 0.0).collect())
    assert cold == pytest.approx([0.0, 1.0, 1.0])


def test_null_groups_and_no_cut(spark):
    rows = [("a", 1, 3.0), ("a", 2, 1.0), (None, 1, 2.0), (None, 2, 2.0)]
    df = spark.createDataFrame(rows, "g string, i int, w double")
    for renorm in (True, False):
        assert H.head_mass(df, "g", "i", "w", k=0, p=1.0, renorm=renorm).count() == 4
    assert sorted(round(r["prob"], 3) for r in H.group_softmax(df, "g", "w").collect()) == [0.119, 0.5, 0.5, 0.881]
    log = spark.createDataFrame([("f", i, float(i)) for i in range(150)], "family string, lr int, loss double")
    assert R.sweep_rank(log, ["lr"], "loss", ["family"]).count() == 150


def test_short_runs_cost_no_call_each(spark):
    """Many short runs: a task works on batches of them, and no group is handed to Python by itself."""
    rng = random.Random(12)
    runs = {k: [round(rng.uniform(0, 5), 1) for _ in range(6)] for k in range(3000)}
    df = spark.createDataFrame([(k, i + 1, x) for k, xs in runs.items() for i, x in enumerate(xs)], SCHEMA)
    lows = df.withColumn("lowest", F.lit(None).cast("double")).where("epoch = 1")
    plan = R._improvements(lows, 0.5)._jdf.queryExecution().executedPlan().toString()
    assert "InPandas" not in plan
    kept = {(r["run_id"], r["epoch"]) for r in R.early_stop(df, 4, 0.5).where("improved").collect()}
    want = {(k, i + 1) for k, xs in runs.items() for i, (new, _) in enumerate(stop_by_hand(xs, 4, 0.5)[0]) if new}
    assert kept == want
