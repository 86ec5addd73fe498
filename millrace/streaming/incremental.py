"""Process files as they arrive. Both jobs take what is there and stop (``availableNow``)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.numbering import numbered_by_file, placed_in_files
from millrace.operators.words import word_counts
from millrace.plans.prepare import prepare_jsonl
from millrace.sources.files import PROCESSED, RAW_JSONL
from millrace.sources.shared import committed, materialize

COUNTS = "word string, n bigint"


def stream_prepare(
    spark: SparkSession,
    source: str,
    target: str,
    checkpoint: str,
    schema: str = "row_id bigint, " + RAW_JSONL,
    files_per_batch: int | None = None,
    **options,
) -> DataFrame:
    """New JSONL files -> processed rows by split. Same column functions as the batch job.

    Raw lines without ids (a ``schema`` without ``row_id``) are numbered as ``with_row_ids`` numbers
    files: by name and place, on from the lines of the batches before. A batch is written under its
    own id, with the number of its lines, so that one that is done again is the same.
    """
    reader = spark.readStream.schema(schema).option("mode", "FAILFAST")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    rows = reader.json(source)
    numbered = "row_id" in rows.columns
    if not numbered:
        rows = placed_in_files(rows)

    def store(batch_rows: DataFrame, batch: int) -> None:
        if not numbered:
            lines = committed(spark, f"{target}/lines", "batch=")
            before = [lines[k] for k in sorted(lines) if k < batch]
            seen = spark.read.parquet(*before).agg(F.sum("n")).first()[0] if before else 0
            raw = materialize(batch_rows.withColumn("_place", F.monotonically_increasing_id()), "stream-batch")
            raw.agg(F.count("*").alias("n")).write.mode("overwrite").parquet(f"{target}/lines/batch={batch}")
            batch_rows = numbered_by_file(raw, seen)
        out = prepare_jsonl(batch_rows, **options)
        out.write.mode("overwrite").partitionBy("split").json(f"{target}/rows/batch={batch}")

    query = (
        rows.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    done = committed(spark, f"{target}/rows", "batch=")
    if not done:
        return spark.createDataFrame([], PROCESSED)
    names = [c.split()[0] for c in PROCESSED.split(", ")]
    reader = spark.read.schema(PROCESSED).option("mode", "FAILFAST").option("basePath", f"{target}/rows")
    return reader.json([done[k] for k in sorted(done)]).select(*names)


def stream_word_counts(
    spark: SparkSession,
    source: str,
    schema: str,
    text_col: str,
    target: str,
    checkpoint: str,
    files_per_batch: int | None = None,
    compact: int = 16,
) -> DataFrame:
    """Counts of all words so far, from files that arrive.

    A batch counts its own rows and writes them as ``counts/batch=<id>``, so a batch that is done
    again after a loss writes the same table in the same place and nothing is counted twice. Every
    ``compact`` batches the tables are folded into ``base/upto=<id>``; what is read is the last
    finished base and the batches after it. No state is kept by the query, and a start that finds no
    new files gives the counts as they are.
    """
    reader = spark.readStream.schema(schema).option("mode", "FAILFAST")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)

    def store(rows: DataFrame, batch: int) -> None:
        word_counts(rows, F.col(text_col)).write.mode("overwrite").parquet(f"{target}/counts/batch={batch}")
        if compact and batch % compact == compact - 1:
            read_word_counts(spark, target, batch).write.mode("overwrite").parquet(f"{target}/base/upto={batch}")

    query = (
        reader.json(source)
        .writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return read_word_counts(spark, target)


def read_word_counts(spark: SparkSession, target: str, last: int | None = None) -> DataFrame:
    """The counts up to batch ``last`` (all): the last finished base before it and what came after."""
    batches = {k: p for k, p in committed(spark, f"{target}/counts", "batch=").items() if last is None or k <= last}
    # the base of the last batch itself is not trusted while that batch is being done (again)
    bases = {k: p for k, p in committed(spark, f"{target}/base", "upto=").items() if last is None or k < last}
    base = max(bases, default=-1)
    paths = [p for k, p in sorted(batches.items()) if k > base] + ([bases[base]] if bases else [])
    if not paths:
        return spark.createDataFrame([], COUNTS)
    return spark.read.schema(COUNTS).parquet(*paths).groupBy("word").agg(F.sum("n").alias("n"))
