"""Score (reference, hypothesis) pairs of a split."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import readable
from millrace.operators.numbering import first_n, seeded_sample
from millrace.operators.scores import metrics_row
from millrace.sources.files import write_metrics, write_predictions


def evaluate(
    pairs: DataFrame,
    split: str,
    limit: int = 0,
    shuffle: bool = False,
    seed: int = 123,
    out: str | None = None,
) -> DataFrame:
    """Metrics of ``row_id, ingredients, reference, hypothesis``; 0 as limit scores all pairs."""
    if shuffle:
        pairs = seeded_sample(pairs, limit, "row_id", seed)
    else:
        pairs = first_n(pairs, limit, "row_id")
    pairs = pairs.withColumn("hypothesis", readable(F.col("hypothesis"), fold=False))
    metrics = metrics_row(pairs, split, ["row_id"])
    if out:
        write_predictions(pairs, f"{out}/{split}/predictions", "overwrite")
        write_metrics(metrics, out, split)
    return metrics
