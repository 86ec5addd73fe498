"""The given tables, and the recipe-shaped view of the documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.sources.shared import spread


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def documents(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return spread(docs.select(*(columns or docs.columns)), "doc_id")


def recipes_view(spark: SparkSession, folder: str) -> DataFrame:
    """Documents read as recipes: title, ingredient cell, second cell, list of steps.

    The cells are made of whole texts: every line is a part of the first, every distinct word of the
    second, sorted. The title, which is a key, is the first sentence; every line is a step.
    """
    text = F.col("text")
    return documents(spark, folder, "doc_id", "text", "source", "lang").select(
        F.col("doc_id").alias("row_id"),
        "source",
        "lang",
        F.trim(F.split_part(text, F.lit("."), F.lit(1))).alias("title"),
        F.replace(text, F.lit("\n"), F.lit(", ")).alias("ingredients"),
        F.array_join(F.sort_array(F.array_distinct(F.split(F.lower(text), " "))), ", ").alias("ner"),
        F.split(text, "\n").alias("directions"),
    )
