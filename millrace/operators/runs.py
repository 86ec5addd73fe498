"""Training-run logs: early stopping, best epochs, sweeps."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce
from operator import and_

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.sources.shared import materialize

_BLOCK_BITS = 10


def joined(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on ``keys``, where null is a key like others."""
    renamed = right.select(*[F.col(k).alias(f"_{i}_{k}") if k in keys else F.col(k) for i, k in enumerate(right.columns)])
    pairs = [(k, f"_{i}_{k}") for i, k in enumerate(right.columns) if k in keys]
    same = reduce(and_, [F.col(a).eqNullSafe(F.col(b)) for a, b in pairs])
    return left.join(renamed, same, how).drop(*[b for _, b in pairs])


def running(
    df: DataFrame,
    keys: list[str],
    order: str,
    value: Column,
    fn: Callable,
    combine: Callable,
    out: str,
    inclusive: bool = True,
) -> DataFrame:
    """Add a running min, max or sum along a whole-number order, without one task per key.

    Rows are cut into blocks of 1,024 order values. Each block is scanned by itself and gets the
    result of all blocks before it, so even a key with a third of all rows is spread over many
    tasks; only one row per block is ever ordered per key. Null keys are keys like others.
    """
    df = df.withColumns({"_value": value, "_block": F.shiftright(order, _BLOCK_BITS)})
    blocks = df.groupBy(*keys, "_block").agg(fn("_value").alias("_all"))
    earlier = W.partitionBy(*keys).orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    starts = blocks.select(*keys, "_block", fn("_all").over(earlier).alias("_start"))
    inside = (
        W.partitionBy(*keys, "_block")
        .orderBy(order)
        .rowsBetween(W.unboundedPreceding, 0 if inclusive else -1)
    )
    here = df.withColumn("_here", fn("_value").over(inside))
    return (
        joined(here, starts, [*keys, "_block"])
        .withColumn(out, combine(F.col("_here"), F.col("_start")))
        .drop("_value", "_block", "_here", "_start")
    )


def number_in_time(df: DataFrame, key: str, time: str, tie: str, out: str) -> DataFrame:
    """Number the rows of a key from 1 on by (time, tie), one hour at a time. Null keys and times too."""
    df = df.withColumn("_hour", F.floor(F.unix_timestamp(time) / 3600).cast("bigint"))
    earlier = W.partitionBy(key).orderBy("_hour").rowsBetween(W.unboundedPreceding, -1)
    starts = (
        df.groupBy(key, "_hour")
        .agg(F.count("*").alias("_n"))
        .select(key, "_hour", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"))
    )
    place = F.row_number().over(W.partitionBy(key, "_hour").orderBy(time, tie))
    return (
        joined(df.withColumn("_place", place), starts, [key, "_hour"])
        .withColumn(out, F.col("_place") + F.col("_start"))
        .drop("_hour", "_place", "_start")
    )


def event_runs(events: DataFrame) -> DataFrame:
    """Events as stand-in run log: run_id = user, epoch = place in time, loss = value."""
    numbered = number_in_time(
        events.select("user_id", "ts", "event_id", "value"), "user_id", "ts", "event_id", "epoch"
    )
    return numbered.select(
        F.col("user_id").alias("run_id"), "epoch", F.col("value").alias("loss")
    )


# ---- early stopping -----------------------------------------------------------------------------


class Steps:
    """What a stretch of a run does to the best loss so far: a step function, composable.

    An epoch improves if its loss is below ``best - delta``. The first one that does in a stretch is
    among its record lows (``lows``, falling); from there on the stretch takes its course whatever
    came in. ``ends`` and ``epochs`` say for each low with which best loss, and improved last in which
    epoch, the stretch ends if that low is the first to improve.

    ``lowest`` is the lowest loss before the stretch (null: none). The best so far cannot be more than
    ``delta`` above it, so lows beyond the first one below ``lowest - delta`` are not needed.
    """

    def __init__(self, lows, ends, epochs, delta: float):
        self.lows, self.ends, self.epochs = np.asarray(lows, float), np.asarray(ends, float), np.asarray(epochs, np.int64)
        self.delta = delta

    def after(self, best: np.ndarray, epoch: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(best, epoch of the last improvement) behind the stretch, for those that come in (NaN: none)."""
        first = np.where(np.isnan(best), 0, np.searchsorted(-self.lows, -(best - self.delta), side="right"))
        moved = first < len(self.lows)
        first = np.minimum(first, len(self.lows) - 1)
        return np.where(moved, self.ends[first], best), np.where(moved, self.epochs[first], epoch)


def _needed(lows: np.ndarray, lowest: float | None, delta: float) -> int:
    """How many record lows can be the first to improve."""
    if lowest is None or np.isnan(lowest):
        return 1
    return min(len(lows), int(np.searchsorted(-lows, -(lowest - delta), side="right")) + 1)


def _next(lows: np.ndarray, delta: float) -> np.ndarray:
    """For every record low the next one that improves on it (their number: none)."""
    return np.searchsorted(-lows, -(lows - delta), side="right")


def _block_function(losses, epochs, lowest: float | None, delta: float) -> tuple[np.ndarray, ...]:
    """Record lows of one block, in order: (lows, ends, epochs) of its step function."""
    lows, epochs = np.asarray(losses, float), np.asarray(epochs, np.int64)
    last = np.arange(len(lows))
    follows = _next(lows, delta)
    for i in range(len(lows) - 1, -1, -1):
        if follows[i] < len(lows):
            last[i] = last[follows[i]]
    n = _needed(lows, lowest, delta)
    return lows[:n], lows[last[:n]], epochs[last[:n]]


def _parts_of(lows, ends, epochs, sizes, delta: float) -> Iterator[Steps]:
    """The step functions of stretches that lie behind each other, ``sizes`` lows each."""
    stops = np.cumsum(sizes)
    for start, stop in zip(stops - sizes, stops):
        yield Steps(lows[start:stop], ends[start:stop], epochs[start:stop], delta)


def _whole_function(lows, ends, epochs, sizes, lowest: float | None, delta: float) -> tuple[np.ndarray, ...]:
    """Up to 1,024 step functions into that of all of them."""
    n = _needed(np.asarray(lows, float), lowest, delta)
    all_ends, all_epochs = np.zeros(0), np.zeros(0, np.int64)
    for steps in _parts_of(lows, ends, epochs, sizes, delta):
        if len(all_ends):
            all_ends, all_epochs = steps.after(all_ends, all_epochs)
        all_ends, all_epochs = np.append(all_ends, steps.ends), np.append(all_epochs, steps.epochs)
    return lows[:n], all_ends[:n], all_epochs[:n]


def _coming(lows, ends, epochs, sizes, best: float, delta: float) -> list[float]:
    """The best loss that comes into each stretch; ``best`` comes into the first (NaN: none)."""
    came, epoch, out = np.array([best], float), np.zeros(1, np.int64), []
    for steps in _parts_of(lows, ends, epochs, sizes, delta):
        out.append(came[0])
        came, epoch = steps.after(came, epoch)
    return out


def _improving(losses, epochs, best: float, delta: float) -> np.ndarray:
    """The epochs of a block that improve, from the best loss that comes in (NaN: none)."""
    lows, kept = np.asarray(losses, float), []
    follows = _next(lows, delta)
    i = 0 if np.isnan(best) else int(np.searchsorted(-lows, -(best - delta), side="right"))
    while i < len(lows):
        kept.append(i)
        i = follows[i]
    return np.asarray(epochs, np.int64)[kept]


# A stretch as a table, one row a record low or a block.


def _block_steps(delta: float):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("epoch")
        one = rows.iloc[:1][["run_id", "block", "lowest"]].copy()
        found = _block_function(rows["loss"], rows["epoch"], rows["lowest"].iloc[0], delta)
        one["lows"], one["ends"], one["epochs"] = [[x] for x in found]
        return one

    return run


def _composed(delta: float):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("block")
        one = rows.iloc[:1][["run_id", "part", "lowest"]].copy()
        columns = [np.concatenate(rows[c].to_list()) for c in ("lows", "ends", "epochs")]
        found = _whole_function(*columns, rows["lows"].map(len), rows["lowest"].iloc[0], delta)
        one["lows"], one["ends"], one["epochs"] = [[x] for x in found]
        return one

    return run


def _steps(row, delta: float) -> Steps:
    return Steps(row.lows, row.ends, row.epochs, delta)


_FUNCTION = "lows array<double>, ends array<double>, epochs array<bigint>"


def _each(fn: Callable, delta: float, kind: str):
    """``fn`` for every row of a batch, a row being one stretch."""

    def columns(*args: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([fn(*row, delta) for row in zip(*args)], columns=["lows", "ends", "epochs"])

    def column(*args: pd.Series) -> pd.Series:
        return pd.Series([fn(*row, delta) for row in zip(*args)], dtype=object)

    return F.pandas_udf(columns if kind == _FUNCTION else column, kind)


def _stretches(rows: DataFrame, keys: list[str], place: str) -> DataFrame:
    """Step functions of the same ``keys`` side by side, in the order of ``place``."""
    each = F.struct(place, "lowest", "lows", "ends", "epochs")
    lists = rows.groupBy(*keys).agg(F.sort_array(F.collect_list(each)).alias("_all"))
    flat = {c: F.flatten(F.col(f"_all.{c}")).alias(c) for c in ("lows", "ends", "epochs")}
    sizes = F.transform("_all", lambda s: F.size(s["lows"])).alias("sizes")
    return lists.select(*keys, F.col(f"_all.{place}").alias(place), F.col("_all.lowest")[0].alias("lowest"), *flat.values(), sizes)


def _carried(stretches: DataFrame, keys: list[str], place: str, best: Column, delta: float) -> DataFrame:
    """(keys, place, best): the best loss that comes into each stretch."""
    came = _each(_coming, delta, "array<double>")("lows", "ends", "epochs", "sizes", best)
    pairs = stretches.select(*keys, F.arrays_zip(F.col(place).alias(place), came.alias("best")).alias("_pairs"))
    pairs = pairs.select(*keys, F.explode("_pairs").alias("_pair"))
    return pairs.select(*keys, F.col("_pair")[place].alias(place), F.col("_pair")["best"].alias("best"))


def _improvements(records: DataFrame, delta: float) -> DataFrame:
    """(run_id, epoch) of the improvements among record lows (run_id, epoch, loss, lowest).

    A block of 1,024 epochs becomes a step function, 1,024 blocks are composed into one, and the few
    that are left of a run are gone through in turn; then the best loss so far is carried down to the
    blocks again. No row holds more than 1,024 blocks or parts of a run, and a task works on many runs
    at once: short runs cost no call each. Null runs are a run.
    """
    none = F.lit(float("nan"))
    rows = records.withColumn("block", F.shiftright("epoch", _BLOCK_BITS)).groupBy("run_id", "block")
    rows = rows.agg(
        F.min_by("lowest", "epoch").alias("lowest"), F.sort_array(F.collect_list(F.struct("epoch", "loss"))).alias("_rows")
    ).select("run_id", "block", "lowest", F.col("_rows.loss").alias("loss"), F.col("_rows.epoch").alias("epoch"))
    made = _each(_block_function, delta, _FUNCTION)("loss", "epoch", "lowest")
    part = F.shiftright("block", _BLOCK_BITS).alias("part")
    blocks = materialize(rows.withColumn("_made", made).select("*", "_made.*", part).drop("_made"), "run-blocks")
    beside = _stretches(blocks, ["run_id", "part"], "block")
    whole = _each(_whole_function, delta, _FUNCTION)("lows", "ends", "epochs", "sizes", "lowest")
    parts = beside.select("run_id", "part", "lowest", whole.alias("_made")).select("run_id", "part", "lowest", "_made.*")
    into_parts = _carried(_stretches(parts, ["run_id"], "part"), ["run_id"], "part", none, delta)
    carried = joined(beside, into_parts, ["run_id", "part"])
    into_blocks = _carried(carried, ["run_id", "part"], "block", F.col("best"), delta).drop("part")
    last = joined(blocks.select("run_id", "block", "loss", "epoch"), into_blocks, ["run_id", "block"])
    kept = _each(_improving, delta, "array<bigint>")("loss", "epoch", "best")
    return last.select("run_id", F.explode(kept).alias("epoch"))


def early_stop(log: DataFrame, patience: int = 3, delta: float = 0.0) -> DataFrame:
    """Per epoch of (run_id, epoch, loss): improved, bad_epochs, and the run's stop_epoch (or null).

    An epoch improves if its loss is below the best so far by more than ``delta``; a run stops once
    ``patience`` epochs in a row did not. Epochs of a run are numbered without gaps. Rows without a
    run_id are one run.
    """
    log = log.select("run_id", F.col("epoch").cast("bigint").alias("epoch"), F.col("loss").cast("double").alias("loss"))
    log = running(
        log, ["run_id"], "epoch", F.col("loss"), F.min, F.least, "_best", inclusive=False
    )
    record = F.col("_best").isNull() | (F.col("loss") < F.col("_best"))
    if delta == 0:
        log = log.withColumn("improved", record)
    else:
        # only a record low can improve by more than delta
        log = materialize(log, "run-lows")
        lows = log.where(record).select("run_id", "epoch", "loss", F.col("_best").alias("lowest"))
        kept = _improvements(lows, delta).withColumn("improved", F.lit(True))
        log = joined(log, kept, ["run_id", "epoch"], "left").withColumn(
            "improved", F.coalesce("improved", F.lit(False))
        )
    # written down, so that the two passes below do not repeat the ones above
    log = materialize(log.drop("_best"), "improvements")
    log = running(
        log,
        ["run_id"],
        "epoch",
        F.when(F.col("improved"), F.col("epoch")),
        F.max,
        F.greatest,
        "_last",
    )
    log = log.withColumn("bad_epochs", F.col("epoch") - F.col("_last")).drop("_last")
    stops = log.groupBy("run_id").agg(
        F.min(F.when(F.col("bad_epochs") >= patience, F.col("epoch"))).alias("stop_epoch")
    )
    return joined(log, stops, ["run_id"])


def best_epoch(stopped: DataFrame) -> DataFrame:
    """Per run of :func:`early_stop`: last improvement, its loss, and the last epoch that ran."""
    ran = stopped.where(F.col("stop_epoch").isNull() | (F.col("epoch") <= F.col("stop_epoch")))
    return ran.groupBy("run_id").agg(
        F.max(F.when(F.col("improved"), F.col("epoch"))).alias("best_epoch"),
        F.min(F.when(F.col("improved"), F.col("loss"))).alias("best_loss"),
        F.max("epoch").alias("last_epoch"),
    )


def sweep_rank(
    log: DataFrame, params: list[str], loss: str, within: list[str], top: int = 0
) -> DataFrame:
    """Settings by lowest loss within each family of runs, with their rank; ``top`` ranks, 0: all.

    Equal losses share a rank. Distinct losses with their counts are dealt by ranges of (family, loss);
    a range is added up by itself and what lies before it in its family is carried over, one row a
    range and family. So neither a family with all settings nor a loss that most of them share is one
    task. Null families are one, and a null loss comes first.
    """
    best = log.groupBy(*within, *params).agg(
        F.min(loss).alias("best_loss"), F.count("*").alias("epochs")
    )
    key = [*within, "best_loss"]
    best = materialize(best, "sweep")
    values = best.groupBy(*key).agg(F.count("*").alias("_n"))
    dealt = materialize(
        values.repartitionByRange(*[F.col(c) for c in key]).withColumn("_part", F.spark_partition_id()), "sweep-ranges"
    )
    upto = lambda w: F.coalesce(F.sum("_n").over(w.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    parts = dealt.groupBy(*within, "_part").agg(F.sum("_n").alias("_n"))
    carried = parts.select(*within, "_part", upto(W.partitionBy(*within).orderBy("_part")).alias("_before"))
    inside = dealt.withColumn("_here", upto(W.partitionBy(*within, "_part").orderBy("best_loss")))
    ranks = joined(inside, carried, [*within, "_part"])
    ranks = ranks.select(*key, (F.col("_here") + F.col("_before") + 1).cast("int").alias("rank"))
    if top:
        ranks = ranks.where(F.col("rank") <= top)
    return joined(best, ranks, key)
