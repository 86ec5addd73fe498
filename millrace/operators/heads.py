"""The head of a weighted distribution, and softmax, per group."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.operators.runs import joined
from millrace.sources.shared import materialize


def head_mass(
    df: DataFrame,
    group: str,
    item: str,
    weight: str,
    k: int = 50,
    p: float = 0.9,
    renorm: bool = True,
) -> DataFrame:
    """(group, item, weight, place, cum, share) for the head of each group.

    The k heaviest items (0: all), then of those the ones whose cumulative share is at most p; the first item
    always stays. ``renorm`` takes shares of the k items, otherwise of the whole group. ``share`` is
    the weight among the items that are left.

    The first k of a group are found inside each task before any row moves, so the size of a group
    does not matter. With k = 0 the items are dealt by ranges of weight instead (see ``_places``).
    """
    if k < 0:
        raise ValueError("k must not be negative")
    if not k:
        return _whole_head(df, group, item, weight, p)
    ranked = W.partitionBy(group).orderBy(F.desc(weight), item)
    head = df.select(group, item, weight).withColumn("place", F.row_number().over(ranked))
    head = head.where(F.col("place") <= k)
    if renorm:
        head = head.withColumn("_all", F.sum(weight).over(W.partitionBy(group)))
    else:
        totals = df.groupBy(F.col(group).alias("_g")).agg(F.sum(weight).alias("_all"))
        head = head.join(totals, F.col(group).eqNullSafe(F.col("_g"))).drop("_g")
    running = W.partitionBy(group).orderBy("place").rowsBetween(W.unboundedPreceding, 0)
    head = head.withColumn("cum", F.sum(weight).over(running) / F.col("_all"))
    if 0.0 < p < 1.0:
        head = head.where((F.col("cum") <= p) | (F.col("place") == 1))
    return head.withColumn(
        "share", F.col(weight) / F.sum(weight).over(W.partitionBy(group))
    ).drop("_all")


def _places(df: DataFrame, group: str, item: str, weight: str) -> DataFrame:
    """Every item with its place and the weight up to it in its group, ``_all`` the group's weight.

    Items are dealt by ranges of (group, weight, item); a range is numbered and added up by itself, and
    the ranges before it are carried over, one row a range and group. A group with any share of the
    rows is spread.
    """
    order = [F.desc(weight), F.col(item)]
    dealt = df.select(group, item, weight).repartitionByRange(F.col(group), *order)
    dealt = materialize(dealt.withColumn("_part", F.spark_partition_id()), "head-ranges")
    inside = W.partitionBy(group, "_part").orderBy(*order)
    here = dealt.withColumns(
        {
            "_place": F.row_number().over(inside),
            "_cum": F.sum(weight).over(inside.rowsBetween(W.unboundedPreceding, 0)),
        }
    )
    parts = dealt.groupBy(group, "_part").agg(F.count("*").alias("_n"), F.sum(weight).alias("_w"))
    before = W.partitionBy(group).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    carried = parts.select(
        group,
        "_part",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_n"),
        F.coalesce(F.sum("_w").over(before), F.lit(0)).alias("_w"),
        F.sum("_w").over(W.partitionBy(group)).alias("_all"),
    )
    places = joined(here, carried, [group, "_part"])
    return places.select(
        group,
        item,
        weight,
        (F.col("_place") + F.col("_n")).cast("int").alias("place"),
        (F.col("_cum") + F.col("_w")).alias("_cum"),
        "_all",
    )


def _whole_head(df: DataFrame, group: str, item: str, weight: str, p: float) -> DataFrame:
    head = _places(df, group, item, weight).withColumn("cum", F.col("_cum") / F.col("_all"))
    if 0.0 < p < 1.0:
        head = head.where((F.col("cum") <= p) | (F.col("place") == 1))
    head = materialize(head.drop("_cum", "_all"), "head")
    left = head.groupBy(group).agg(F.sum(weight).alias("_left"))
    return joined(head, left, [group]).withColumn("share", F.col(weight) / F.col("_left")).drop("_left")


def group_softmax(
    df: DataFrame, group: str, score: str, temperature: float = 1.0, out: str = "prob"
) -> DataFrame:
    """Softmax of scores within each group at a temperature of at least 1e-6.

    Maximum and sum are plain aggregates joined back: a huge group is never sorted or held in one
    task, and AQE splits it in the join.
    """
    scaled = df.withColumn("_s", F.col(score) / max(1e-6, temperature))
    same = F.col(group).eqNullSafe(F.col("_g"))  # a null group is a group, too
    top = scaled.groupBy(F.col(group).alias("_g")).agg(F.max("_s").alias("_top"))
    risen = scaled.join(top, same).drop("_g").withColumn("_e", F.exp(F.col("_s") - F.col("_top")))
    sums = risen.groupBy(F.col(group).alias("_g")).agg(F.sum("_e").alias("_sum"))
    return (
        risen.join(sums, same)
        .drop("_g")
        .withColumn(out, F.col("_e") / F.col("_sum"))
        .drop("_s", "_top", "_e", "_sum")
    )
