"""I-Match fingerprints: distinct terms of a band of document frequencies, hashed over random sub-lexicons.

DataFrame operations only; the fingerprint is a column function of a text and a lexicon.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.functions.once import with_once
from millrace.llm.texts import ID, TEXT, id_text
from millrace.sources.shared import materialize

SPLIT = r"[^\p{L}\p{N}]+"
FAMILIES, LEVELS, STEP = 12, 5, 2  # sub-lexicons: in each family every level keeps a quarter of the one above
WIDE, NARROW = 8, 4  # hex digits of the hashes of whole texts, of sub-lexicons


def _hashes(text: Column) -> Column:
    """Hashes of all terms (an empty one may be among them; it is in no lexicon)."""
    return F.transform(F.split(text, SPLIT), lambda t: F.xxhash64(t))


def lexicon(docs: DataFrame, low: float = 0.002, high: float = 0.2) -> list[int]:
    """Hashes of the terms whose document frequency lies in the band from ``low`` to ``high``.

    Frequencies are counted over all documents, case kept. Terms that many documents share number at
    most (terms a document) / low, a bound that does not grow with the data; all are in the lexicon.
    Null and empty texts count as documents without terms, equal rows each count, long texts are read
    whole; an empty table has an empty lexicon. There are no ties: the band takes every term in it.
    """
    rows = id_text(docs)
    n = rows.count()
    terms = rows.select(F.explode(F.array_distinct(_hashes(F.col(TEXT)))).alias("term"))
    counts = terms.groupBy("term").agg(F.count("*").alias("n"))
    empty = F.xxhash64(F.lit(""))
    band = counts.where((F.col("n") >= max(2, low * n)) & (F.col("n") <= high * n) & (F.col("term") != empty))
    return [r["term"] for r in band.select("term").collect()]


def _member(terms: list[int]):
    """Whether a term is in the lexicon, looked up in the one short list its last bits name."""
    mask = (1 << (len(terms) // 2).bit_length()) - 1
    lists: list[list[int]] = [[] for _ in range(mask + 1)]
    for t in sorted(terms):
        lists[t & mask].append(t)
    table = F.from_json(F.lit(json.dumps(lists)), "array<array<bigint>>")
    return lambda t: F.array_contains(F.get(table, t.bitwiseAND(F.lit(mask)).cast("int")), t)


def with_fingerprint(df: DataFrame, text: str, name: str, terms: list[int], keep: list[str]) -> DataFrame:
    """``keep`` and the fingerprint of a text column.

    62 hashes in hex: of all terms of the text, of its lexicon terms, and shorter ones of those in each
    sub-lexicon (family by family, from large to small); a sub-lexicon without a term of the text gives
    zeros. Whatever a text's length, some level of every family holds one to three of its terms. Terms
    are distinct and sorted, so equal texts and texts of the same terms have equal hashes.
    """
    row = with_once(df, keep, _all=_hashes(F.col(text)))
    row = with_once(
        row,
        keep,
        _whole=F.xxhash64(F.sort_array(F.array_distinct("_all"))),
        _terms=F.sort_array(F.array_distinct(F.filter("_all", _member(terms)))),
    )
    # the first level of each family; what the others keep is among it
    families = {f"_f{k}": F.filter(F.transform("_terms", _salted(k)), _kept(1)) for k in range(FAMILIES)}
    row = with_once(row, [*keep, "_whole", "_terms"], **families)
    parts = [_hex(F.col("_whole"), WIDE), _digest(F.col("_terms"), WIDE)]
    for f in range(FAMILIES):
        parts.append(_digest(F.col(f"_f{f}"), NARROW))
        parts += [_digest(F.filter(f"_f{f}", _kept(level)), NARROW) for level in range(2, LEVELS + 1)]
    return row.select(*keep, F.concat_ws("", *parts).alias(name))


def _salted(k: int):
    return lambda t: F.xxhash64(t, F.lit(k))


def _kept(level: int):
    return lambda h: h.bitwiseAND(F.lit((1 << (STEP * level)) - 1)) == 0


def _hex(number: Column, width: int) -> Column:
    return F.right(F.lpad(F.lower(F.hex(number)), 16, "0"), F.lit(width))


def _digest(terms: Column, width: int) -> Column:
    return F.when(F.size(terms) > 0, _hex(F.xxhash64(terms), width)).otherwise("0" * width)


def likeness(a: Column, b: Column) -> Column:
    """Share of equal hashes among the lexicon hashes that either text has; 1 for equal fingerprints."""

    def cut(x: Column) -> Column:
        narrow = F.transform(
            F.sequence(F.lit(0), F.lit(FAMILIES * LEVELS - 1)),
            lambda i: F.substring(x, i * NARROW + 2 * WIDE + 1, F.lit(NARROW)),
        )
        return F.concat(F.array(F.substring(x, WIDE + 1, WIDE)), narrow)

    pairs = F.arrays_zip(cut(a).alias("a"), cut(b).alias("b"))
    none = lambda x: x.isin("0" * WIDE, "0" * NARROW)
    some = F.filter(pairs, lambda p: ~none(p["a"]) | ~none(p["b"]))
    equal = F.filter(some, lambda p: p["a"] == p["b"])
    return (
        F.when(a == b, 1.0).when(F.size(some) == 0, 0.0).otherwise(F.size(equal) / F.size(some))
    ).cast("double")


def chained(rows: DataFrame, carry: list[str]) -> DataFrame:
    """Rows (distinct by doc_id and h) with those of the row after in descending order, the last with the first.

    Rows are dealt by ranges; a window sees one range, and one row a range goes through the window
    over their borders and the broadcast (the bound is the number of tasks).
    """
    dealt = rows.repartitionByRange(F.desc(ID), "h").withColumn("part", F.spark_partition_id())
    dealt = materialize(dealt, "ranges")
    link = F.struct(F.col(ID).alias("id"), "h", *carry)
    order = [F.desc(ID), F.asc("h")]
    inner = dealt.withColumn("next", F.lead(link).over(W.partitionBy("part").orderBy(*order)))
    heads = dealt.withColumn("link", link).withColumn(
        "first", F.row_number().over(W.partitionBy("part").orderBy(*order))
    )
    heads = heads.where("first = 1").select("part", "link")
    ends = W.orderBy("part")
    heads = heads.select(
        "part",
        F.coalesce(
            F.lead("link").over(ends),
            F.first("link").over(ends.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)),
        ).alias("border"),
    )
    return (
        inner.join(F.broadcast(heads), "part")
        .withColumn("next", F.coalesce("next", "border"))
        .drop("part", "border")
    )


def edited_texts(docs: DataFrame, chain: DataFrame) -> DataFrame:
    """Documents with the second half of each text replaced by the beginning of the next text.

    A row is known by doc_id and ``h``, the hash of its text; ``chain`` has one row for each, with
    ``half`` and ``next``. Texts are dealt once by that key, and the beginnings once more.
    """
    rows = id_text(docs).withColumn("h", F.xxhash64(TEXT))
    here = lambda a, b: F.col(f"a.{ID}").eqNullSafe(b) & (F.col("a.h") == F.col(f"b.{a}"))
    heads = (
        rows.alias("a")
        .join(chain.select(ID, "h", "half", F.col("next.id").alias("id2"), F.col("next.h").alias("h2")).alias("b"), here("h2", F.col("b.id2")))
        .select(F.col(f"b.{ID}").alias(ID), F.col("b.h").alias("h"), F.expr("left(a.text, b.half)").alias("head"))
        .groupBy(ID, "h")
        .agg(F.first("head").alias("head"))
    )
    text, n = F.col(f"a.{TEXT}"), F.char_length(f"a.{TEXT}")
    kept = F.left(text, (n - F.floor(n / 2)).cast("int"))
    joined = rows.alias("a").join(heads.alias("b"), here("h", F.col(f"b.{ID}")))
    return joined.select(
        F.col(f"a.{ID}").alias(ID), F.col("a.h").alias("h"), n.cast("bigint").alias("n_chars"), F.concat(kept, F.col("b.head")).alias("edited")
    )


def fingerprints(docs: DataFrame, terms: list[int]) -> DataFrame:
    """``doc_id, h, n_chars, fingerprint`` of every row; ``h`` is the hash of its text.

    Null and empty texts, and texts without lexicon terms, have zeros for the lexicon and are told
    apart by the hash of all their terms. Equal texts have equal fingerprints; long ones are read whole.
    Null ids are ids like others, and an empty table gives no rows. No row is shuffled; extra columns
    are not read.
    """
    rows = id_text(docs).select(
        ID, TEXT, F.xxhash64(TEXT).alias("h"), F.char_length(TEXT).cast("bigint").alias("n_chars")
    )
    return with_fingerprint(rows, TEXT, "fingerprint", terms, [ID, "h", "n_chars"])
