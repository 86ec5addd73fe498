"""One registered query per operator, over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import items as I
from millrace.functions import lists as L
from millrace.functions import rules
from millrace.functions import text as X
from millrace.functions.once import with_once
from millrace.functions.rules import PAD
from millrace.inputs import item_sql
from millrace.operators import batches as B
from millrace.operators import dictionaries, heads, numbering, runs, scores, splits
from millrace.operators import words as W
from millrace.operators.bpe import Vocabulary, pair_counts
from millrace.operators.cells import parse_list
from millrace.operators.encode import add_specials, at_least_two, decode, encode_corpus, truncate
from millrace.plans import loader, prepare, vocabulary
from millrace.sources import files
from millrace.sources.shared import new_path, spread
from millrace.sources.tables import documents, recipes_view, table
from millrace.streaming.incremental import stream_prepare, stream_word_counts

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

SEP = " ¦ "
VOCAB_SIZE = 160
MAX_LEN = 64
CACHE_LEN = 512  # of the reference
BATCH = 16


def query(fn, name: str | None = None):
    QUERIES[name or fn.__name__] = fn
    return fn


def named(name: str):
    """For queries whose name is also that of an operator used here."""
    return lambda fn: query(fn, name)


def joined(items: Column) -> Column:
    return F.array_join(items, SEP)


def ids_text(ids: Column) -> Column:
    return F.array_join(F.transform(ids, lambda i: i.cast("string")), " ")


# ---- inputs -------------------------------------------------------------------------------------


def _items(spark: SparkSession, d: str) -> DataFrame:
    """(row_id, item): an item phrase per part."""
    part = table(spark, d, "part").select("p_partkey", "p_name", "p_size")
    return spread(part, "p_partkey").select(
        F.col("p_partkey").alias("row_id"), F.expr(item_sql()).alias("item"), "p_name"
    )


def _cells(spark: SparkSession, d: str) -> DataFrame:
    """(row_id, items, second): list cells of the recipe view and of the parts (negative ids)."""
    recipes = recipes_view(spark, d).select(
        "row_id", F.col("ingredients").alias("items"), F.col("ner").alias("second")
    )
    parts = _items(spark, d).select(
        (-1 - F.col("row_id")).alias("row_id"),
        F.col("item").alias("items"),
        F.concat(F.lower("p_name"), F.lit(", butter; eggs")).alias("second"),
    )
    return recipes.unionByName(parts)


def _turns(spark: SparkSession, d: str) -> DataFrame:
    """(row_id, role, ids): conversation turns as byte ids, the encoding without any merge."""
    turns = spread(table(spark, d, "conversations"), "conv_id", "turn")
    digits = F.regexp_extract_all(F.hex(F.encode("text", "UTF-8")), F.lit("(..)"), F.lit(1))
    ids = F.transform(digits, lambda h: F.conv(h, 16, 10).cast("int") + 8)
    return turns.select(
        (F.shiftleft(F.col("conv_id").cast("bigint"), 32) + F.col("turn")).alias("row_id"), "role", ids.alias("ids")
    )


def _rows(spark: SparkSession, d: str) -> DataFrame:
    """Processed rows of the recipe view, ingredient cell taken as it is."""
    rows = with_once(
        recipes_view(spark, d),
        ["row_id", "title", "ingredients"],
        recipe=X.format_target(F.col("title"), F.col("directions")),
    )
    rows = prepare.drop_empty(rows, "ingredients", "recipe")
    return rows.withColumn("split", splits.hash_split(F.col("title")))


def _raw_jsonl(spark: SparkSession, d: str, parts: int) -> tuple[str, DataFrame]:
    """Documents written as raw JSON lines: (path, rows). At least ``parts`` files, more for a large table."""
    text = F.col("text")
    rows = documents(spark, d, "doc_id", "text").select(
        F.col("doc_id").alias("row_id"),
        F.replace(text, F.lit("\n"), F.lit(", ")).alias("ingredients"),
        text.alias("recipe"),
    )
    path = new_path(spark, "raw-jsonl")
    splits = table(spark, d, "documents").rdd.getNumPartitions()
    rows.repartition(max(parts, splits), "row_id").write.json(path)
    return path, rows


_VOCABULARIES: dict[tuple[str, str], Vocabulary] = {}


def _vocabulary(spark: SparkSession, d: str) -> Vocabulary:
    """Small vocabulary of all documents, learned once per session and folder."""
    key = (spark.sparkContext.applicationId, d)
    if key not in _VOCABULARIES:
        texts = documents(spark, d, "doc_id", "text")
        _VOCABULARIES[key] = vocabulary.build_vocabulary(
            texts, VOCAB_SIZE, lower=True, nfkc=True
        )
    return _VOCABULARIES[key]


# ---- A: sources and sinks -----------------------------------------------------------------------


@query
def src_csv_roundtrip(spark, d):
    text = F.col("text")
    rows = documents(spark, d, "doc_id", "text").select(
        F.trim(F.split_part(text, F.lit("."), F.lit(1))).alias("title"),
        F.replace(text, F.lit("\n"), F.lit(", ")).alias("ingredients"),
        text.alias("directions"),
    )
    path = new_path(spark, "raw-csv")
    files.write_csv(rows, path)
    return files.read_recipes_csv(spark, path)


@query
def src_jsonl_roundtrip(spark, d):
    path, _ = _raw_jsonl(spark, d, 4)
    return files.read_jsonl(spark, path)


@query
def sink_split_counts(spark, d):
    path, _ = _raw_jsonl(spark, d, 4)
    raw = files.read_jsonl(spark, path, "row_id bigint, " + files.RAW_JSONL)
    out = new_path(spark, "splits")
    files.write_splits(prepare.prepare_jsonl(raw), out)
    return (
        files.read_splits(spark, out, strict=True)
        .groupBy("split")
        .agg(F.count("*").alias("n"), F.sum(F.length("recipe")).alias("chars"))
    )


@query
def token_cache(spark, d):
    vocab = _vocabulary(spark, d)
    path = new_path(spark, "token-cache")
    vocabulary.cache_tokens(_rows(spark, d), vocab, path, CACHE_LEN)
    cached = files.read_token_cache(spark, path, CACHE_LEN, PAD, vocab.fingerprint())
    return cached.select("row_id", "split", "max_len", "pad_id", ids_text(F.col("ids")).alias("ids"))


@query
def prediction_sink(spark, d):
    """Predictions written as CSV and as JSON lines, read back from both."""
    path, kinds = new_path(spark, "predictions"), "ingredients string, reference string, hypothesis string"
    files.write_predictions(_pairs(spark, d).withColumn("ingredients", F.col("role")), path)
    csv = files.read_csv(spark, f"{path}/csv", kinds).withColumn("kind", F.lit("csv"))
    lines = files.read_jsonl(spark, f"{path}/json", kinds).withColumn("kind", F.lit("json"))
    return csv.unionByName(lines)


@query
def run_log_sink(spark, d):
    """Events as logs, a run for each type and day, written and read back."""
    events = table(spark, d, "events")
    run = F.concat_ws("-", "event_type", F.date_format("ts", "yyyyMMdd"))
    none = F.lit(None).cast("double")
    logs = events.select(
        run.alias("run_id"),
        F.col("event_id").cast("int").alias("epoch"),
        F.col("value").alias("train_loss"),
        (F.col("value") / 2).alias("val_loss"),
        none.alias("val_ppl"),
        none.alias("lr"),
        F.col("user_id").cast("double").alias("epoch_time_sec"),
    )
    root = new_path(spark, "run-logs")
    files.write_run_logs(logs, root)
    return files.read_run_logs(spark, root).select("run_id", "epoch", "train_loss", "val_loss", "val_ppl", "epoch_time_sec")


@query
def vocabulary_meta(spark, d):
    """A learned vocabulary written and read back: its size, flags and special tokens."""
    path = new_path(spark, "vocabulary")
    files.write_vocabulary(_vocabulary(spark, d), spark, path)
    again = files.read_vocabulary(spark, path)
    return again.tables(spark)["meta"]


# ---- B: rows ------------------------------------------------------------------------------------


@query
def clean_text(spark, d):
    pages = table(spark, d, "pages")
    lines = F.concat(F.lit("• "), F.col("url"), F.lit("\n*\t"), F.col("html"), F.lit(" "))
    rows = documents(spark, d, "doc_id", "text").select("doc_id", "text")
    rows = rows.unionByName(pages.select((-1 - F.col("page_id")).alias("doc_id"), lines.alias("text")))
    return rows.select("doc_id", X.clean(F.col("text")).alias("cleaned"))


@named("parse_list")
def _parse_list(spark, d):
    docs = documents(spark, d, "doc_id", "text")
    lines = F.to_json(F.split("text", "\n"))
    cells = F.create_map(F.lit("cell"), F.col("text"), F.lit("literal"), lines)
    rows = docs.select("doc_id", F.explode(cells).alias("kind", "cell"))
    rows = rows.select("doc_id", "kind", parse_list(F.col("cell")).alias("parts"))
    n = F.size("parts").cast("bigint")
    return rows.select("doc_id", "kind", n.alias("n"), joined(F.col("parts")).alias("parts"))



def _on_texts(name: str, fn: Callable[[Column], Column]) -> None:
    """Register a text -> text operator over whole documents and over the item phrases."""

    def run(spark, d):
        docs = documents(spark, d, "doc_id", "text").select(F.col("doc_id").alias("row_id"), "text")
        parts = _items(spark, d).select(
            (-1 - F.col("row_id")).alias("row_id"), F.col("item").alias("text")
        )
        return docs.unionByName(parts).select("row_id", fn(F.col("text")).alias("result"))

    QUERIES[name] = run


_on_texts("rewrite_rules", I.rewrite_rules)
_on_texts("split_alternatives", lambda c: joined(L.split_alternatives(c)))
_on_texts("strip_quantities", I.strip_quantities)
_on_texts("strip_units", I.strip_units)
_on_texts("collapse_ws", I.collapse_whitespace)
_on_texts("collapse_commas", X.collapse_commas)
_on_texts("stopword_drop", lambda c: F.array_join(I.drop_stopwords(F.split(F.lower(c), " ")), " "))
_on_texts("singularize", lambda c: F.array_join(F.transform(F.split(F.lower(c), " "), I.singularize), " "))
_on_texts("has_quantity", lambda c: I.has_quantity(c).cast("int"))
_on_texts("readable_text", X.readable)


@query
def stopword_drop_table(spark, d):
    """The descriptors as a table, over whole documents and the item phrases."""
    docs = documents(spark, d, "doc_id", "text").select(F.col("doc_id").alias("row_id"), "text")
    parts = _items(spark, d).select((-1 - F.col("row_id")).alias("row_id"), F.col("item").alias("text"))
    listed = spark.createDataFrame([(w,) for w in rules.DESCRIPTORS], "word string")
    rows = dictionaries.drop_listed(
        docs.unionByName(parts), ["row_id"], F.split(F.lower("text"), " "), listed
    )
    return rows.select("row_id", F.array_join("tokens", " ").alias("result"))


@query
def part_names_replaced(spark, d):
    """Words of the item phrases by a dictionary made of the table: a word's name is the least word of
    all parts that share its first four letters."""
    parts = _items(spark, d).select("row_id", F.split(F.lower("item"), " ").alias("words"))
    words = parts.select(F.explode("words").alias("word")).where("length(word) > 4").distinct()
    stem = words.groupBy(F.left("word", F.lit(4)).alias("stem")).agg(F.min("word").alias("name"))
    names = words.join(stem, F.left("word", F.lit(4)) == F.col("stem")).select("word", "name")
    rows = dictionaries.replace_listed(parts, ["row_id"], F.col("words"), names)
    return rows.select("row_id", F.array_join("tokens", " ").alias("result"))


@query
def dict_map(spark, d):
    """Spelling and alias lookup of every word, as counts per name."""
    words = _items(spark, d).select(F.explode(F.split(F.lower("item"), r"[ ,;.]+")).alias("w"))
    names = words.where("w <> ''").select(I.preferred_name(F.col("w")).alias("name"))
    return names.groupBy("name").agg(F.count("*").alias("n"))


@query
def normalize_item(spark, d):
    docs = recipes_view(spark, d).select(
        "row_id", F.posexplode(L.split_cell(F.col("ingredients"))).alias("pos", "item")
    )
    parts = _items(spark, d).select(
        (-1 - F.col("row_id")).alias("row_id"), F.lit(0).alias("pos"), "item"
    )
    rows = docs.unionByName(parts)
    return rows.select(
        "row_id", F.col("pos").cast("bigint").alias("pos"), I.normalize_item(F.col("item")).alias("name")
    )


@query
def format_target(spark, d):
    return recipes_view(spark, d).select(
        "row_id", X.format_target(F.col("title"), F.col("directions")).alias("recipe")
    )


@query
def title_line(spark, d):
    return _rows(spark, d).select("row_id", X.title_line(F.col("recipe")).alias("first_line"))


@query
def prompt_template(spark, d):
    scaffold = F.when(F.col("row_id") % 3 == 0, F.lit("title_then_steps")).otherwise(F.lit("title_step1"))
    ing = F.col("ingredients")
    return recipes_view(spark, d).select(
        "row_id",
        X.prompt(ing, scaffold).alias("prompt"),
        X.sample_text(ing, F.col("title")).alias("sample"),
    )


# ---- C: filters ---------------------------------------------------------------------------------


@query
def drop_empty(spark, d):
    """Item phrases whose canonical name is not empty."""
    items = with_once(_items(spark, d), ["row_id", "item"], name=I.normalize_item(F.col("item")))
    return prepare.drop_empty(items, "item", "name").select("row_id", "name")


@query
def first_n(spark, d):
    rows = prepare.drop_empty(recipes_view(spark, d), "title", "ingredients")
    return numbering.first_n(rows.select("row_id", "title"), 200)


# ---- D: lists -----------------------------------------------------------------------------------


@query
def expand_items(spark, d):
    return _cells(spark, d).select(
        "row_id", joined(L.expand_items(L.split_cell(F.col("items")))).alias("items")
    )


def _merge(mode: str):
    def run(spark, d):
        first = L.normalized_set(L.split_cell(F.col("items")))
        second = L.normalized_set(L.split_cell(F.col("second")))
        return _cells(spark, d).select(
            "row_id", F.array_join(L.merge_sets(first, second, mode), ", ").alias("merged")
        )

    return run


QUERIES["merge_union"] = _merge("union")
QUERIES["merge_intersection"] = _merge("intersection")
QUERIES["merge_second_only"] = _merge("ner_only")
QUERIES["merge_raw"] = _merge("raw")


@query
def dedup_best_display(spark, d):
    return _cells(spark, d).select("row_id", L.dedup_best_display(F.col("items")).alias("items"))


@query
def dedup_best_display_all(spark, d):
    """The best display of every name over all items of all rows."""
    items = _cells(spark, d).select("row_id", F.posexplode(L.split_cell(F.col("items"))).alias("pos", "item"))
    items = items.withColumn("pos", F.col("pos").cast("bigint"))
    return dictionaries.best_displays(items, "item", "row_id", "pos")


@query
def dedup_keep_first(spark, d):
    return _cells(spark, d).select("row_id", L.dedup_keep_first(F.col("items")).alias("items"))


@query
def build_input(spark, d):
    text = L.build_input(L.split_cell(F.col("items")), L.split_cell(F.col("second")))
    return _cells(spark, d).select("row_id", text.alias("ingredients"))


@query
def merge_keep_display(spark, d):
    text = L.merge_keep_display(L.split_cell(F.col("items")), L.split_cell(F.col("second")))
    return _cells(spark, d).select("row_id", text.alias("ingredients"))


@query
def prepared_rows(spark, d):
    """The whole way from raw cells to split rows."""
    raw = recipes_view(spark, d).select(
        "row_id", "title", "ingredients", F.array_join("directions", ";").alias("directions"), "ner"
    )
    return prepare.prepare_csv(raw).select("row_id", "title", "ingredients", "recipe", "split")


# ---- E: splits and order ------------------------------------------------------------------------


@query
def hash_split(spark, d):
    return recipes_view(spark, d).select(
        "row_id", splits.hash_split(F.col("title")).alias("split")
    )


@query
def split_counts(spark, d):
    return _rows(spark, d).groupBy("split").agg(
        F.count("*").alias("n"), F.round(F.avg(F.length("recipe")), 6).alias("avg_chars")
    )


@query
def split_leakage_audit(spark, d):
    """Titles that a split by row id would spread over several splits."""
    rows = recipes_view(spark, d).select(
        "title", splits.hash_split(F.col("row_id").cast("string")).alias("split")
    )
    return splits.split_leakage(rows, "title")


@query
def seeded_sample(spark, d):
    return numbering.seeded_sample(recipes_view(spark, d).select("row_id", "title"), 200, seed=123)


@query
def epoch_order(spark, d):
    rows = recipes_view(spark, d).select("row_id")
    return numbering.number_shuffled(rows, "42-1").select("row_id", F.col("idx").cast("bigint").alias("idx"))


@query
def dedup_exact(spark, d):
    rows = documents(spark, d, "doc_id", "text")
    return splits.lowest_ids(rows, "text", "doc_id")


@query
def dedup_exact_rows(spark, d):
    rows = documents(spark, d, "doc_id", "text", "lang")
    return splits.dedup_exact(rows, "text", "doc_id").select("doc_id", "lang", F.length("text").cast("bigint").alias("chars"))


# ---- F: vocabulary ------------------------------------------------------------------------------


@query
def corpus_text(spark, d):
    return vocabulary.corpus(_rows(spark, d), ("train", "val", "test"))


@query
def nfkc_lower(spark, d):
    """Documents with compatibility characters mixed in, normalized."""
    docs = documents(spark, d, "doc_id", "text")
    mixed = F.concat(F.lit("ﬁ ½ Ａ "), F.col("text"))
    return docs.select("doc_id", W.normalize_text(mixed).alias("text"))


@query
def pretokenize(spark, d):
    words = W.pretokenize(F.col("text"))
    return documents(spark, d, "doc_id", "text").select(
        "doc_id", F.size(words).cast("bigint").alias("n"), joined(words).alias("words")
    )


@query
def word_counts(spark, d):
    return W.word_counts(documents(spark, d, "doc_id", "text"), F.lower("text"))


@query
def byte_alphabet(spark, d):
    return W.byte_alphabet(word_counts(spark, d))


@query
def pair_counts_round1(spark, d):
    words = word_counts(spark, d).select(W.to_letters(F.col("word")).alias("syms"), "n")
    return pair_counts(words)


@query
def bpe_merges(spark, d):
    return _vocabulary(spark, d).tables(spark)["merges"]


@query
def vocab_table(spark, d):
    return _vocabulary(spark, d).tables(spark)["vocab"]


# ---- G: ids and batches -------------------------------------------------------------------------


@named("encode_corpus")
def _encode_corpus(spark, d):
    docs = documents(spark, d, "doc_id", "text")
    ids = encode_corpus(docs, "text", _vocabulary(spark, d))
    return ids.select("doc_id", F.size("ids").alias("n"), ids_text(F.col("ids")).alias("ids"))



@query
def decode_roundtrip(spark, d):
    vocab = _vocabulary(spark, d)
    docs = encode_corpus(documents(spark, d, "doc_id", "text"), "text", vocab)
    return docs.select("doc_id", decode(F.col("ids"), vocab).alias("text"))


@named("add_specials")
def _add_specials(spark, d):
    return _turns(spark, d).select("row_id", ids_text(add_specials(F.col("ids"))).alias("ids"))



@query
def truncate_ids(spark, d):
    return _turns(spark, d).select(
        "row_id", ids_text(truncate(add_specials(F.col("ids")), MAX_LEN)).alias("ids")
    )


def _batched(spark: SparkSession, d: str) -> DataFrame:
    rows = _turns(spark, d).select("row_id", add_specials(F.col("ids")).alias("ids"))
    return B.assign_batches(rows, BATCH)


def _padded(left: bool):
    def run(spark, d):
        return B.pad_batch(_batched(spark, d), left=left).select(
            "row_id",
            "batch_id",
            ids_text(F.col("input_ids")).alias("input_ids"),
            ids_text(F.col("mask")).alias("mask"),
        )

    return run


QUERIES["pad_batch"] = _padded(False)
QUERIES["pad_left"] = _padded(True)


@query
def shift_mask(spark, d):
    return B.shift_mask(_batched(spark, d)).select(
        "row_id", "batch_id", ids_text(F.col("x")).alias("x"), ids_text(F.col("y")).alias("y")
    )


@query
def assign_batches(spark, d):
    rows = _turns(spark, d).select("row_id")
    out = B.assign_batches(rows, BATCH, seed=42, epoch=2)
    return out.select("row_id", "batch_id", F.col("pos").cast("bigint").alias("pos"))


@query
def token_stats(spark, d):
    rows = _turns(spark, d).withColumn("ids", add_specials(F.col("ids")))
    stats = B.token_stats(rows, "role", BATCH, 256)
    return stats.withColumns(
        {c: F.round(c, 6) for c in ("truncated_share", "pad_share")}
    )


@query
def min_length(spark, d):
    """Byte ids of the sizes of parts, at least two of them."""
    digits = F.regexp_extract_all(F.hex(F.encode(F.col("p_size").cast("string"), "UTF-8")), F.lit("(..)"), F.lit(1))
    ids = F.transform(digits, lambda h: F.conv(h, 16, 10).cast("int") + 8)
    return table(spark, d, "part").select("p_partkey", ids_text(at_least_two(ids)).alias("ids"))


@query
def encode_batch(spark, d):
    """Whole documents encoded, cut to the reference's 512 ids and padded by batches."""
    texts = documents(spark, d, "doc_id", "text").withColumnRenamed("doc_id", "row_id")
    rows = loader.encode_batch(texts, _vocabulary(spark, d), BATCH, max_len=CACHE_LEN)
    return rows.select("row_id", "batch_id", "pos", ids_text(F.col("input_ids")).alias("ids"), F.size("mask").alias("width"))


# ---- H: evaluation and runs ---------------------------------------------------------------------


def _pairs(spark: SparkSession, d: str) -> DataFrame:
    turns = table(spark, d, "conversations")
    roles = turns.select("conv_id", "turn", "role")
    return scores.dialogue_pairs(turns).join(roles, ["conv_id", "turn"])


PAIR = ["conv_id", "turn"]


@query
def eval_pairs(spark, d):
    return _pairs(spark, d)


@query
def bleu_ngram_stats(spark, d):
    return scores.bleu_ngram_stats(_pairs(spark, d), PAIR)


@query
def corpus_bleu(spark, d):
    return scores.corpus_bleu(_pairs(spark, d), PAIR).select(F.round("bleu", 6).alias("bleu"))


@query
def corpus_bleu_by_group(spark, d):
    return scores.corpus_bleu(_pairs(spark, d), PAIR, ["role"]).select(
        "role", F.round("bleu", 6).alias("bleu")
    )


@query
def rouge_l(spark, d):
    f1 = scores.rouge_l(F.col("reference"), F.col("hypothesis"), use_stemmer=False)
    return spread(_pairs(spark, d), *PAIR).select(*PAIR, F.round(f1, 6).alias("rouge_l"))


@query
def rouge_l_stemmed(spark, d):
    f1 = scores.rouge_l(F.col("reference"), F.col("hypothesis"))
    return spread(_pairs(spark, d), *PAIR).select(*PAIR, F.round(f1, 6).alias("rouge_l"))


@query
def metrics_row(spark, d):
    m = scores.metrics_row(_pairs(spark, d), "val", PAIR, use_stemmer=False)
    return m.select(
        "split", "N", F.round("rougeL_f1", 6).alias("rougeL_f1"), F.round("bleu", 6).alias("bleu")
    )


@query
def perplexity(spark, d):
    losses = table(spark, d, "events").select(
        "event_type", "user_id", (F.col("value") / 10).alias("loss")
    )
    out = scores.perplexity(losses, ["event_type", "user_id"])
    return out.select(
        "event_type", "user_id", F.round("mean_loss", 6).alias("mean_loss"), F.round("ppl", 2).alias("ppl")
    )


def _log(spark: SparkSession, d: str) -> DataFrame:
    return runs.event_runs(table(spark, d, "events"))


@query
def early_stop(spark, d):
    return runs.early_stop(_log(spark, d)).withColumn("improved", F.col("improved").cast("int"))


@query
def best_epoch(spark, d):
    return runs.best_epoch(runs.early_stop(_log(spark, d), patience=5))


@query
def early_stop_delta(spark, d):
    """Best epochs where only a gain of more than 1.5 counts."""
    return runs.best_epoch(runs.early_stop(_log(spark, d), patience=8, delta=1.5))


@query
def sweep_rank(spark, d):
    log = table(spark, d, "events").select("event_type", "user_id", "value")
    return runs.sweep_rank(log, ["user_id"], "value", ["event_type"])


def _weights(spark: SparkSession, d: str) -> DataFrame:
    items = table(spark, d, "lineitem").select("l_suppkey", "l_partkey", "l_quantity")
    return items.groupBy("l_suppkey", "l_partkey").agg(F.sum("l_quantity").alias("weight"))


def _head(**options):
    def run(spark, d):
        head = heads.head_mass(_weights(spark, d), "l_suppkey", "l_partkey", "weight", **options)
        return head.select(
            "l_suppkey", "l_partkey", "weight", F.col("place").cast("bigint").alias("place"),
            F.round("cum", 9).alias("cum"), F.round("share", 9).alias("share"),
        )

    return run


QUERIES["head_mass"] = _head(k=20, p=0.6, renorm=True)
QUERIES["head_mass_raw"] = _head(k=20, p=0.05, renorm=False)
QUERIES["head_mass_all"] = _head(k=0, p=0.4)


@query
def group_softmax(spark, d):
    parts = table(spark, d, "part").select("p_brand", "p_partkey", "p_retailprice")
    out = heads.group_softmax(parts, "p_brand", "p_retailprice", temperature=50.0)
    return out.select("p_brand", "p_partkey", F.round("prob", 9).alias("prob"))


# ---- I: streams ---------------------------------------------------------------------------------


@query
def stream_preprocess(spark, d):
    path, _ = _raw_jsonl(spark, d, 6)
    rows = stream_prepare(
        spark, path, new_path(spark, "stream-out"), new_path(spark, "stream-checkpoint")
    )
    return rows.select("row_id", "ingredients", "recipe", "split")


@named("stream_word_counts")
def _stream_word_counts(spark, d):
    path, _ = _raw_jsonl(spark, d, 6)
    return stream_word_counts(
        spark, path, "row_id bigint, " + files.RAW_JSONL, "recipe",
        new_path(spark, "stream-out"), new_path(spark, "stream-checkpoint"),
    )

