"""Word lists and name dictionaries that are tables, of any size, and the best display of a name."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.items import has_quantity, normalize_item

BROADCAST_ROWS = 100_000  # of a dictionary that is sent to all tasks; larger ones are shuffled
SALTS = 16  # copies of a shuffled dictionary, so that a word with a third of all tokens meets it in many tasks


def _small(table: DataFrame) -> bool:
    """May the table be sent to all tasks? Its measured size decides."""
    return table.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS


def _in_rows(df: DataFrame, row: list[str], tokens: Column, change, out: str) -> DataFrame:
    """(``row``, ``out``): the lists changed where they are; no token leaves its row. ``change`` gives, of
    all tokens of a batch, what becomes of them and which stay."""

    def run(lists: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for each in lists:
            found, kept = change(each.flatten())
            ends = np.concatenate([[0], np.cumsum(each.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))])
            left = np.concatenate([[0], np.cumsum(kept.to_numpy(zero_copy_only=False))])
            yield pa.ListArray.from_arrays(pa.array(left[ends], pa.int32()), found.filter(kept))

    return df.select(*row, F.arrow_udf(run, "array<string>")(tokens).alias(out))


def _looked_up(tokens: DataFrame, table: DataFrame, word: str, row: list[str]) -> DataFrame:
    """``tokens`` left-joined with ``table`` on ``word``, both shuffled."""
    salted = table.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salt = F.pmod(F.xxhash64(*row, "_pos"), F.lit(SALTS)).cast("int")
    return tokens.withColumn("_salt", salt).join(salted, [word, "_salt"], "left").drop("_salt")


def _tokens(df: DataFrame, row: list[str], tokens: Column) -> DataFrame:
    return df.select(*row, F.posexplode(tokens).alias("_pos", "_word"))


def _rebuilt(tokens: DataFrame, rows: DataFrame, row: list[str], out: str) -> DataFrame:
    """The words of every row in order again; rows without any word keep an empty list."""
    lists = tokens.groupBy(*row).agg(F.sort_array(F.collect_list(F.struct("_pos", "_word"))).alias("_list"))
    key = lists.select(*[F.col(c).alias(f"_{i}") for i, c in enumerate(row)], "_list")
    same = [F.col(c).eqNullSafe(F.col(f"_{i}")) for i, c in enumerate(row)]
    words = F.coalesce(F.transform("_list", lambda t: t["_word"]), F.array().cast("array<string>"))
    return rows.select(*row).join(key, same, "left").select(*row, words.alias(out))


def drop_listed(df: DataFrame, row: list[str], tokens: Column, listed: DataFrame, out: str = "tokens") -> DataFrame:
    """(``row``, ``out``): the tokens of every row that are not in the one-column table ``listed``.

    ``row`` names columns that tell rows apart. Order and repeats stay; a null list is an empty one.
    A null in ``listed`` lists nothing, and a word listed twice is listed once.
    """
    words = listed.select(F.col(listed.columns[0]).alias("_word")).where("_word IS NOT NULL").distinct()
    if _small(words):
        known = pa.array([r["_word"] for r in words.collect()], pa.string())
        return _in_rows(df, row, tokens, lambda all_: (all_, pc.invert(pc.is_in(all_, value_set=known))), out)
    found = _looked_up(_tokens(df, row, tokens), words.withColumn("_listed", F.lit(True)), "_word", row)
    return _rebuilt(found.where(F.col("_listed").isNull()), df, row, out)


def replace_listed(df: DataFrame, row: list[str], tokens: Column, names: DataFrame, out: str = "tokens") -> DataFrame:
    """(``row``, ``out``): the tokens of every row, each by its name in the table (word, name).

    Words without a name stay. A word with several names takes the least one.
    """
    word, name = names.columns[:2]
    table = names.where(F.col(word).isNotNull() & F.col(name).isNotNull())
    table = table.groupBy(F.col(word).alias("_word")).agg(F.min(name).alias("_name"))
    if _small(table):
        pairs = table.collect()
        known, instead = (pa.array([r[c] for r in pairs], pa.string()) for c in ("_word", "_name"))

        def named(all_: pa.Array) -> tuple[pa.Array, pa.Array]:
            new = instead.take(pc.index_in(all_, value_set=known))
            return pc.coalesce(new, all_), pa.array(np.ones(len(all_), bool))

        return _in_rows(df, row, tokens, named, out)
    found = _looked_up(_tokens(df, row, tokens), table, "_word", row)
    return _rebuilt(found.withColumn("_word", F.coalesce("_name", "_word")).drop("_name"), df, row, out)


def best_displays(items: DataFrame, item: str, row: str, place: str) -> DataFrame:
    """One row per normalized name over all rows: ``name, item, n, first_row, first_place``.

    The item shown is the one with a quantity, then the longest, then the first by (row, place), and
    first is where the name was first seen. Equal items are counted once before they are normalized;
    the best of a name is a maximum, partly taken before the shuffle, so frequent names are no load.
    """
    first = F.struct(F.col(row).alias("row"), F.col(place).alias("place"))
    distinct = items.groupBy(F.col(item).alias("item")).agg(F.count("*").alias("n"), F.min(first).alias("first"))
    named = distinct.withColumn("name", normalize_item(F.col("item"))).where("name <> ''")
    rank = F.struct(
        (-has_quantity(F.col("item")).cast("int")).alias("poor"), (-F.length("item")).alias("short"), "first", "item"
    )
    best = named.groupBy("name").agg(F.min(rank).alias("best"), F.sum("n").alias("n"), F.min("first").alias("first"))
    return best.select(
        "name", F.col("best.item").alias("item"), "n", F.col("first.row").alias("first_row"), F.col("first.place").alias("first_place")
    )
