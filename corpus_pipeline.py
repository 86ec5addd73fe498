"""A corpus pipeline of five stages over ``documents``; each works on what the one before kept.

Every stage takes (spark, docs, sf_dir) and returns a table; ``run`` writes each one to the shared
folder and reads it again. All but the last return the columns of ``docs``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import jaccard, line_quality, packing, pii, toxicity
from millrace.llm.queries import WORD_BPE
from millrace.llm.texts import ID, TEXT
from millrace.sources.shared import materialize
from millrace.sources.tables import table

TOXIC = 0.7  # score from which a document goes


def _with_text(docs: DataFrame, row: str, text: str) -> list[Column]:
    """The columns of ``docs`` out of the struct ``row``, the text (and its length) replaced."""
    new = {TEXT: F.col(text), "n_chars": F.char_length(text).cast("bigint")}
    kinds = dict(docs.dtypes)
    return [
        (new[c].cast(kinds[c]) if c in new else F.col(f"{row}.`{c}`")).alias(c) for c in docs.columns
    ]


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score ``TOXIC`` or more go; the model is learned from ``labels`` and ``docs``.

    Null and empty texts stay, null ids and repeated rows are judged like others, a score just at the
    limit goes. Texts are scored whole; an empty table stays empty.
    """
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score_toxicity(docs, model, keep=True)
    return scored.where(F.col("score") < TOXIC).select("doc.*")


def clean_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Failing lines go; so do documents that fail the base rules or lose too much text.

    Null and empty texts have no words and go. Repeated rows and null ids are judged one by one; texts
    are read whole; an empty table stays empty.
    """
    judged = line_quality.clean_lines(docs, keep=True)
    return judged.where("kept").select(*_with_text(docs, "doc", "clean_text"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every component of near copies the row with the smallest doc_id stays, a null one last.

    Near copies have a Jaccard of 0.8 or more over their 5-word shingles. Of rows that share a doc_id
    the one with the least hashes of its text comes first; rows that share both are one. Documents
    without words are copies of nothing and stay.
    """
    full = F.coalesce(F.col(TEXT).rlike(line_quality.WORD), F.lit(False))
    first = jaccard.first_rows(docs, n=5, part=80, whole=100)
    hashes = jaccard.text_hashes(F.col(f"doc.{TEXT}"))
    rows = docs.where(full).select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))
    id_key = lambda c: [F.col(c).isNull().alias("none"), F.coalesce(F.col(c).cast("string"), F.lit("")).alias("id")]
    key = ["none", "id", *jaccard.HASHES]
    # rows that share id and text are copies of one another; whole texts are moved only here, once
    rows = rows.select("doc", *id_key(f"doc.{ID}"), *hashes).groupBy(*key).agg(F.first("doc").alias("doc"))
    kept = rows.join(first.select(*id_key("id"), *jaccard.HASHES), key, "left_semi")
    return kept.select("doc.*").unionByName(docs.where(~full))


def redact_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Spans of personal data are replaced by their kind in brackets.

    All rows stay; a null text becomes an empty one. Equal rows are redacted alike; of spans that
    overlap the first, and the longest at a tie, names the place. An empty table stays empty.
    """
    return pii.find_pii(docs, keep=True).select(*_with_text(docs, "doc", "redacted"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of power-of-two length.

    Null and empty texts are one piece with the end id; rows of one id, null ids too, are documents of
    their own, ordered by text. An empty table gives no sequences.
    """
    return packing.pack(docs, WORD_BPE)


STAGES = [
    ("toxicity", remove_toxic),
    ("quality_rules", clean_lines),
    ("ngram_jaccard_join", drop_near_copies),
    ("pii", redact_pii),
    ("packing", pack),
]

ORACLE_SQL = None  # learned scores and tokenizers have no SQL; tests compare with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
