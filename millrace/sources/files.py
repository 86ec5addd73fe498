"""CSV, JSONL and Parquet sources and sinks."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RAW_JSONL = "ingredients string, recipe string"
PROCESSED = "row_id bigint, title string, ingredients string, recipe string, split string"
RUN_LOG = (
    "epoch int, train_loss double, val_loss double, val_ppl double, lr double, "
    "epoch_time_sec double"
)
SPLITS = ("train", "val", "test")

_CSV = {"header": "true", "multiLine": "true", "quote": '"', "escape": '"', "encoding": "UTF-8"}


# ---- raw rows -----------------------------------------------------------------------------------


def read_recipes_csv(
    spark: SparkSession,
    path: str,
    title_col: str = "title",
    ing_col: str = "ingredients",
    rec_col: str = "directions",
    ner_col: str | None = "NER",
) -> DataFrame:
    """Raw rows of CSV files with a header; a column that is not there reads as ``""``.

    Files whose headers differ are an error. Quoted cells may hold line breaks, so one file is one task: turn large CSV files into Parquet
    once and go on from there.
    """
    raw = spark.read.options(**_CSV, enforceSchema="false").csv(path)

    def cell(name: str | None) -> Column:
        if name is None or name not in raw.columns:
            return F.lit("")
        return F.coalesce(F.col(f"`{name}`"), F.lit(""))

    return raw.select(
        cell(title_col).alias("title"),
        cell(ing_col).alias("ingredients"),
        cell(rec_col).alias("directions"),
        cell(ner_col).alias("ner"),
    )


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """What ``write_csv`` wrote."""
    return spark.read.schema(schema).options(**_CSV).csv(path)


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).options(
        header="true",
        quoteAll="true",
        quote='"',
        escape='"',
        ignoreLeadingWhiteSpace="false",
        ignoreTrailingWhiteSpace="false",
    ).csv(path)


def read_jsonl(spark: SparkSession, path: str, schema: str | T.StructType = RAW_JSONL) -> DataFrame:
    """JSON lines. An empty line is skipped, a broken one is an error."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


# ---- processed rows by split --------------------------------------------------------------------


def write_splits(df: DataFrame, path: str, mode: str = "errorifexists", ordered: bool = False) -> None:
    """One folder of JSON lines per split, and a manifest of the splits with their numbers of rows.

    ``row_id`` carries the order that files do not. With ``ordered``, rows are dealt by ranges of it, so
    that within a split the order of file names and of rows in them is the order of the input. The
    numbers are counted while the rows are written.
    """
    if ordered:
        df = df.repartitionByRange("row_id").sortWithinPartitions("row_id")
    spark, seen = df.sparkSession, Observation()
    counts = [F.coalesce(F.sum((F.col("split") == s).cast("bigint")), F.lit(0)).alias(s) for s in SPLITS]
    df.observe(seen, *counts).write.mode(mode).partitionBy("split").json(path)
    rows = [(s, n) for s, n in seen.get.items() if n]
    manifest = spark.createDataFrame(rows, "split string, rows bigint").coalesce(1)
    manifest.write.mode("append" if mode == "append" else "overwrite").parquet(f"{path}/_manifest")


def split_rows(spark: SparkSession, path: str) -> dict[str, int]:
    """The manifest: numbers of rows by split. No data is read."""
    rows = spark.read.schema("split string, rows bigint").parquet(f"{path}/_manifest")
    return {r["split"]: r["n"] for r in rows.groupBy("split").agg(F.sum("rows").alias("n")).collect()}


def read_splits(
    spark: SparkSession, path: str, splits: tuple[str, ...] = SPLITS, strict: bool = False
) -> DataFrame:
    """Rows of the named splits. ``strict`` makes a split without any row an error, by the manifest."""
    if strict:
        missing = [s for s in splits if s not in split_rows(spark, path)]
        if missing:
            raise FileNotFoundError(f"no rows for split(s) {missing} under {path}")
    return read_jsonl(spark, path, PROCESSED).where(F.col("split").isin(*splits))


# ---- encoded rows -------------------------------------------------------------------------------


def write_token_cache(
    df: DataFrame, path: str, max_len: int, pad_id: int, vocab_hash: str, mode: str = "overwrite"
) -> None:
    """Encoded rows (``row_id, ids, split``) with the settings they were made with."""
    df.select("row_id", "ids", "split").write.mode(mode).partitionBy("split").parquet(f"{path}/ids")
    meta = df.sparkSession.createDataFrame(
        [(max_len, pad_id, vocab_hash)], "max_len int, pad_id int, vocab_hash string"
    )
    meta.coalesce(1).write.mode(mode).parquet(f"{path}/meta")


def read_token_cache(
    spark: SparkSession, path: str, max_len: int, pad_id: int, vocab_hash: str
) -> DataFrame:
    """Encoded rows, refused if they were made with other settings."""
    made = spark.read.parquet(f"{path}/meta").first()
    want = (max_len, pad_id, vocab_hash)
    if (made["max_len"], made["pad_id"], made["vocab_hash"]) != want:
        raise ValueError(f"stale token cache at {path}: made with {tuple(made)}, asked for {want}")
    schema = "row_id bigint, ids array<int>, split string"
    return spark.read.schema(schema).parquet(f"{path}/ids").withColumns(
        {"max_len": F.lit(max_len), "pad_id": F.lit(pad_id)}
    )


# ---- results ------------------------------------------------------------------------------------


def write_predictions(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Predictions twice: as CSV and as JSON lines."""
    rows = df.select("ingredients", "reference", "hypothesis")
    write_csv(rows, f"{path}/csv", mode)
    rows.write.mode(mode).json(f"{path}/json")


def write_metrics(df: DataFrame, path: str, split: str, mode: str = "overwrite") -> None:
    """The one-row metrics table of a split."""
    df.coalesce(1).write.mode(mode).json(f"{path}/{split}/metrics")


# ---- run logs -----------------------------------------------------------------------------------


def append_run_log(df: DataFrame, root: str, run_id: str) -> None:
    """Add epochs to the log of one run."""
    df.write.mode("append").option("header", "true").csv(f"{root}/{run_id}")


def write_run_logs(logs: DataFrame, root: str, mode: str = "errorifexists") -> None:
    """Logs of many runs at once: ``run_id`` and the columns of ``RUN_LOG``, a folder a run."""
    names = [c.split()[0] for c in RUN_LOG.split(", ")]
    folder = F.concat(F.lit("run-"), F.col("run_id").cast("string")).alias("folder")
    logs.select(folder, *names).write.mode(mode).option("header", "true").partitionBy("folder").csv(root)


def read_run_logs(spark: SparkSession, root: str) -> DataFrame:
    """Logs of all runs under a folder; the run is named by the folder its log lies in."""
    logs = spark.read.schema(RUN_LOG).option("header", "true").csv(f"{root}/*/")
    name = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)
    # as ``write_run_logs`` names folders, or as they are
    return logs.select(F.regexp_replace(name, "^folder=run-", "").alias("run_id"), "*")


# ---- vocabulary ---------------------------------------------------------------------------------


def write_vocabulary(vocab, spark: SparkSession, path: str, mode: str = "overwrite") -> None:
    """Tables ``vocab``, ``merges`` and ``meta`` of a vocabulary."""
    for name, df in vocab.tables(spark).items():
        df.coalesce(1).write.mode(mode).parquet(f"{path}/{name}")


def read_vocabulary(spark: SparkSession, path: str):
    from millrace.operators.bpe import Vocabulary

    pieces = spark.read.parquet(f"{path}/vocab").where(~F.col("is_special"))
    meta = {r["key"]: r["value"] for r in spark.read.parquet(f"{path}/meta").collect()}
    merges = spark.read.parquet(f"{path}/merges").orderBy("rank").collect()
    tokens = [r["token"] for r in pieces.orderBy("id").collect()]
    return Vocabulary(
        pieces=tokens,
        merges=[(r["left"], r["right"]) for r in merges],
        lower=json.loads(meta["lower"]),
        nfkc=json.loads(meta["nfkc"]),
    )
