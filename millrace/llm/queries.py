"""One registered query for each operator of this folder, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import alignment, attribution, fingerprints, jaccard, line_quality, packing, pieces, pii
from millrace.llm import records, secret_scan, toxicity, vector_codes, wrappers
from millrace.llm.spans import in_order
from millrace.llm.texts import ID, joined_spans
from millrace.sources.shared import materialize, new_path
from millrace.sources.tables import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def _count(spans: str, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")


@query
def op1_power_of_two_packing(spark, d):
    pieces = packing.pack(table(spark, d, "documents"), WORD_BPE)
    return pieces.select(
        ID,
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
        "bucket",
        "bucket_index",
    )


@query
def op6_token_records(spark, d):
    out = new_path(spark, "token-records")
    records.write_records(table(spark, d, "documents"), out, WORD_BPE)
    rows = records.read_records(records.read_index(spark, out), out)
    return rows.select(ID, "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query
def op8_line_first_cleaning(spark, d):
    return line_quality.clean_lines(table(spark, d, "documents")).select(
        ID,
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
    )


@query
def op5_pii_boosting(spark, d):
    rows = pii.find_pii(table(spark, d, "documents"))
    kinds = [*pii.KINDS, *pii.LOOSE]
    return rows.select(
        ID,
        *[_count("base", k) for k in pii.KINDS],
        F.sha2(joined_spans(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        joined_spans(in_order(F.concat("base", "added"), kinds)).alias("spans"),
    )


@query
def op3_randomness_battery(spark, d):
    rows = secret_scan.find_secrets(table(spark, d, "documents"))
    return rows.select(
        ID,
        *[_count("base", k) for k in secret_scan.KINDS[:3]],
        F.sha2(joined_spans(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        joined_spans(in_order(F.concat("base", "added"), secret_scan.KINDS)).alias("spans"),
    )


@query
def op9_levenshtein_toxicity(spark, d):
    docs = table(spark, d, "documents")
    model = toxicity.train(docs, table(spark, d, "labels"))
    rows = toxicity.score_toxicity(docs, model)
    return rows.select(
        ID,
        toxicity.held_out().alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
    )


@query
def op10_shared_prefix_pieces(spark, d):
    """Whole texts encoded and decoded again."""
    encoded = pieces.encode_pieces(table(spark, d, "documents"), PIECE_BPE)
    return pieces.decode_pieces(encoded, PIECE_BPE).select(
        ID,
        (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
        (F.col("decoded") == F.col("text")).alias("same"),
    )


@query
def op2_offset_attribution(spark, d):
    """Tokens in every window of 1,000 characters; a token on a border goes where most of it lies."""
    sections = attribution.windows(F.col("text"), 1000)
    return attribution.section_tokens(table(spark, d, "documents"), sections, WORD_BPE)


@query
def op7_i_match(spark, d):
    docs = table(spark, d, "documents")
    terms = fingerprints.lexicon(docs)
    # digests travel as bytes, half as long as in hex
    own = fingerprints.fingerprints(docs, terms).withColumn("fingerprint", F.unhex("fingerprint"))
    own = own.dropDuplicates([ID, "h"])
    half = F.floor(F.col("n_chars") / 2).cast("int").alias("half")
    chain = fingerprints.chained(own.select(ID, "h", half, "fingerprint"), ["fingerprint"])
    chain = materialize(chain, "fingerprint-chain")
    edited = fingerprints.edited_texts(docs, chain)
    edited = edited.withColumn("edited_sha256", F.unhex(F.sha2(F.col("edited").cast("binary"), 256)))
    keep = [ID, "h", "n_chars", "edited_sha256"]
    edited = fingerprints.with_fingerprint(edited, "edited", "edited_fingerprint", terms, keep)
    edited = edited.withColumn("edited_fingerprint", F.unhex("edited_fingerprint"))
    near, text = fingerprints.likeness, lambda c: F.lower(F.hex(c))
    same = F.col(f"e.{ID}").eqNullSafe(F.col(f"c.{ID}")) & (F.col("e.h") == F.col("c.h"))
    return (
        edited.alias("e")
        .join(chain.alias("c"), same)
        .select(
            F.col(f"e.{ID}").alias(ID),
            "n_chars",
            text("edited_sha256").alias("edited_sha256"),
            text("fingerprint").alias("fingerprint"),
            text("edited_fingerprint").alias("edited_fingerprint"),
            F.col("next.fingerprint").alias("next"),
        )
        .withColumn("near_edited", near(F.col("fingerprint"), F.col("edited_fingerprint")))
        .withColumn("near_next", near(F.col("fingerprint"), text("next")))
        .drop("next"
        )
    )


@query
def op4_universe_partition(spark, d):
    return jaccard.jaccard_components(table(spark, d, "documents"))


@query
def op11_equal_average_codes(spark, d):
    rows, books = vector_codes.compress(table(spark, d, "embeddings"))
    return rows.select(
        "vec_id",
        F.lower(F.hex("code")).alias("code"),
        "error",
        "label_error",
        F.lit(vector_codes.digest(books)).alias("codebooks_sha256"),
    )


@query
def op12_galloping_alignment(spark, d):
    rows = alignment.align(table(spark, d, "documents"), BYTE_BPE, PIECE_BPE)
    digest = F.when(F.col("n_groups") > 0, F.sha2(F.col("groups").cast("binary"), 256)).otherwise("")
    rows = materialize(rows.withColumn("groups_sha256", digest).drop("groups"), "aligned-tokens")
    return alignment.weigh(rows, alignment.size_of(PIECE_BPE))


@query
def op13_wrapper_inference(spark, d):
    rows = wrappers.main_texts(table(spark, d, "pages"))
    return rows.withColumn("n_chars", F.char_length("text").cast("bigint"))


def _nearest(books: str) -> str:
    """Every part with its nearest entry: the least (distance, entry)."""
    gap = "list_sum(list_transform(list_zip(x, y), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    return f"""SELECT vec_id, label, p, any_value(x) AS x, min({{'d': CAST({gap} AS BIGINT), 'e': e}}) AS near
      FROM parts JOIN {books} USING (p) GROUP BY vec_id, label, p"""


def _means(assigned: str, books: str) -> str:
    """Entries replaced by the floor of their parts' mean (// rounds towards zero), unused ones kept."""
    floor = "CAST((s - ((s % n) + n) % n) // n AS BIGINT)"
    return f"""SELECT p, e, coalesce(m.y, {books}.y) AS y FROM {books} LEFT JOIN (
      SELECT p, e, list({floor} ORDER BY i) AS y FROM (
        SELECT p, near.e AS e, i, CAST(sum(x[i]) AS BIGINT) AS s, count(*) AS n
        FROM {assigned}, range(1, 1000) t(i) WHERE i <= len(x) GROUP BY p, near.e, i) GROUP BY p, e) m USING (p, e)"""


ORACLES["op11_equal_average_codes"] = f"""
WITH kept AS (
  SELECT vec_id, label,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS (
  SELECT vec_id, label, p, q[p * (len(q) // 16) + 1 : (p + 1) * (len(q) // 16)] AS x FROM kept, range(16) t(p)
), b0 AS (
  SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, x AS y FROM parts QUALIFY e < 64
), a0 AS ({_nearest("b0")}), b1 AS ({_means("a0", "b0")}
), a1 AS ({_nearest("b1")}), b2 AS ({_means("a1", "b1")}
), a2 AS ({_nearest("b2")}
), coded AS (
  SELECT vec_id, label, string_agg(printf('%02x', near.e), '' ORDER BY p) AS code,
    CAST(sum(near.d) AS BIGINT) AS error
  FROM a2 GROUP BY vec_id, label
), digest AS (
  SELECT sha256(string_agg(array_to_string(y, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM b2
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM coded, digest
"""
