"""Toxicity: a learned lexicon, found even misspelled, weighed by the window around each hit."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.once import with_once
from millrace.llm.automaton import EXACT, Automaton
from millrace.llm.texts import ID, TEXT, id_text, small, text_array
from millrace.sources.shared import materialize

# --- fixed values: cues in the window around a hit ---------------------------------------------------
WINDOW = 6  # words on either side
QUOTES = "\"“”„«»‘’"
REPORTS = frozenset(
    "said says say wrote writes called calls quoted quote quotes word term slur dit disait écrit sagte schrieb "
    "zitat dijo escribió cita".split()
)
ADDRESSES = frozenset("you your you're youre u du dich dein sie tu vous toi usted eres".split())
STEM_LENGTHS = range(4, 9)
NEAR_WEIGHT = 0.7  # of a misspelled hit against an exact one
ODDS = 2.5  # least log-odds of a term, toxic against clean: about twelve times as often

_WORD = re.compile(r"[^\W_]+")
_TOKEN = re.compile(r"\S+")


@dataclass
class Model:
    words: list[str] = field(default_factory=list)
    stems: list[str] = field(default_factory=list)
    known: list[str] = field(default_factory=list)  # near words that clean documents use
    weights: list[float] = field(default_factory=lambda: [-2.0, 0.0, 0.0, 0.0])


def hits_of(text: str, match) -> tuple[float, float]:
    """(abuse, quotation): weights of all hits, each split by its window.

    Quotation marks around a hit, or a report verb before it, speak for a quotation; a word of
    address or an exclamation speaks against.
    """
    tokens = _TOKEN.findall(text)
    abuse = quoted = 0.0
    for i, token in enumerate(tokens):
        kind = max((match(w) for w in _WORD.findall(token.lower())), default=0)
        if not kind:
            continue
        weight = 1.0 if kind == EXACT else NEAR_WEIGHT
        before, after = tokens[max(0, i - WINDOW) : i], tokens[i + 1 : i + 1 + WINDOW]
        opens = any(t[0] in QUOTES for t in [*before, token])
        closes = any(t.rstrip(".,;:!?")[-1:] in QUOTES for t in [token, *after] if t.rstrip(".,;:!?"))
        reports = any(t.lower().strip(".,;:!?\"") in REPORTS for t in before)
        address = any(t.lower().strip(".,;:!?\"") in ADDRESSES for t in before + after)
        shouts = "!" in token
        share = min(1.0, max(0.0, 0.6 * (opens and closes) + 0.4 * reports - 0.3 * address - 0.2 * shouts))
        abuse += weight * (1 - share)
        quoted += weight * share
    return abuse, quoted


def _inputs(abuse: np.ndarray, quoted: np.ndarray) -> np.ndarray:
    one = np.ones(len(abuse))
    return np.stack([one, 1 - np.exp(-abuse), np.log1p(abuse), np.log1p(quoted)], axis=1)


def _scorer(model: Model):
    """(abuse, quotation) of the texts of a batch; each distinct token meets the automaton once."""
    automaton = Automaton(model.words, model.stems)
    known = frozenset(model.known)

    def match(word: str) -> int:
        return 0 if word in known else automaton.match(word)

    def run(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        abuse, quoted = np.zeros(len(texts)), np.zeros(len(texts))
        split = pc.utf8_split_whitespace(texts)
        tokens = split.flatten().dictionary_encode()
        hit = np.zeros(len(tokens.dictionary), bool)
        for k, token in enumerate(tokens.dictionary.to_numpy(zero_copy_only=False)):
            low = token.lower()
            if low.isalpha():
                hit[k] = match(low) > 0
            else:
                hit[k] = any(match(w) for w in _WORD.findall(low))
        rows = np.flatnonzero(hit[tokens.indices.to_numpy()])
        bounds = split.offsets.to_numpy()
        for i in np.unique(np.searchsorted(bounds, rows, side="right") - 1):
            abuse[i], quoted[i] = hits_of(texts[int(i)].as_py(), match)
        return abuse, quoted

    return run


def _terms(words: Column) -> Column:
    """``word$`` for whole words and their beginnings of several lengths."""
    long = F.filter(words, lambda w: F.char_length(w) >= 3)
    whole = F.transform(long, lambda w: F.concat(w, F.lit("$")))
    return F.array_distinct(F.concat(whole, *[_stems(long, k) for k in STEM_LENGTHS]))


def _stems(words: Column, k: int) -> Column:
    return F.transform(F.filter(words, lambda w: F.char_length(w) > k), lambda w: F.left(w, F.lit(k)))


def _family(words: str) -> Column:
    """Two least hashes of the long words, which documents seldom share by chance; a text without long
    words is a family of its own."""
    long = F.filter(words, lambda w: F.char_length(w) >= 8)
    least = F.xxhash64(
        F.array_min(F.transform(long, lambda w: F.xxhash64(w))),
        F.array_min(F.transform(long, lambda w: F.crc32(w.cast("binary")))),
    )
    return F.when(F.size(long) > 0, least).otherwise(F.xxhash64(TEXT))


def _choose(support: dict[str, int]) -> tuple[list[str], list[str]]:
    """(words, stems): of terms that begin alike, the most frequent, made as long as it loses nothing.

    "lowe" and "lowei" with one support give "lowei"; longer terms below it add nothing.
    """
    words, stems, chosen = [], [], []
    for term in sorted(support, key=lambda t: (-support[t], t)):
        bare = term.rstrip("$")
        if any(bare.startswith(c) or c.startswith(bare) for c in chosen):
            continue
        alike = [t for t in support if t.startswith(bare) and support[t] >= 0.9 * support[term]]
        best = max([*alike, term], key=len)
        chosen.append(best.rstrip("$"))
        (words if best.endswith("$") else stems).append(best.rstrip("$"))
    return words, stems


def _fit(x: np.ndarray, y: np.ndarray, ridge: float = 0.3) -> np.ndarray:
    """Logistic regression by Newton steps; the intercept is not shrunk."""
    w, penalty = np.zeros(x.shape[1]), ridge * np.eye(x.shape[1])
    penalty[0, 0] = 1e-6
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty, x.T @ (y - p) - penalty @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def held_out(id_col: str = ID) -> Column:
    """The third of the documents whose labels are never used."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(
    docs: DataFrame, labels: DataFrame, positives: int = 4000, negatives: int = 8000
) -> Model:
    """Learn the lexicon and the weights from a bounded sample of labelled documents.

    The sample (at most ``positives`` + ``negatives`` documents, by hash of the id) leaves out the
    held-out third. Terms are whole words and word beginnings that more families of toxic documents
    use than chance allows, with log-odds of ``ODDS`` or more against clean ones: all of them, as many
    as the sample gives. Quoted uses in clean documents are left to the weights.

    Rows of ``labels`` without an id or a label are left out; of several labels of one id, or of equal
    texts, toxic counts. Null and empty texts teach that there is nothing to find; long texts are read
    whole. Without rows of both labels (an empty table, for instance) the model has no terms. Terms
    with equal support are taken in their own order.
    """
    kept = labels.select(F.col(ID), F.col("toxic").cast("int").alias("toxic")).where(
        F.col(ID).isNotNull() & F.col("toxic").isNotNull() & ~held_out()
    )
    kept = kept.groupBy(ID).agg(F.max("toxic").alias("toxic"))
    h = F.xxhash64(ID)
    some = [
        kept.where(F.col("toxic") == t).orderBy(h, ID).limit(n) for t, n in ((1, positives), (0, negatives))
    ]
    ids = F.broadcast(some[0].unionByName(some[1]))  # at most positives + negatives rows
    words = F.array_distinct(F.split(F.lower(TEXT), r"[^\p{L}\p{N}]+"))
    sample = id_text(docs).join(ids, ID).groupBy(TEXT).agg(F.min(ID).alias(ID), F.max("toxic").alias("toxic"))
    sample = with_once(sample, [ID, TEXT, "toxic"], words=words)
    sample = materialize(sample.withColumn("family", _family("words")), "toxicity-sample")
    sizes = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if len(sizes) < 2:
        return Model()
    # near copies count once: they agree in the least hashes of their words
    seen = sample.select("toxic", "family", F.explode(_terms(F.col("words"))).alias("term"))
    counts = seen.groupBy("term").agg(
        F.sum("toxic").alias("bad"),
        F.sum(1 - F.col("toxic")).alias("good"),
        F.count_distinct(F.when(F.col("toxic") == 1, F.col("family"))).alias("n"),
    )
    # so much oftener in toxic documents that chance would not do it to one of 100,000 terms (Chernoff;
    # for a term of toxic documents alone, share ** n)
    share = sizes[1] / (sizes[0] + sizes[1])
    least = max(3, math.ceil(math.log(1e-5) / math.log(share)))
    both = F.col("n") + F.col("good")
    chance = F.col("n") * F.log(F.col("n") / (both * share)) + F.when(
        F.col("good") > 0, F.col("good") * F.log(F.col("good") / (both * (1 - share)))
    ).otherwise(0.0)
    odds = lambda k, n: F.log((F.col(k) + 0.5) / (n - F.col(k) + 0.5))
    support = (
        counts.where((F.col("n") >= least) & (chance >= math.log(1e5)))
        .where(odds("bad", sizes[1]) - odds("good", sizes[0]) >= ODDS)
    )
    model = Model(*_choose({r["term"]: r["n"] for r in support.collect()}))

    good = sample.where("toxic = 0").select(F.explode("words").alias("word")).distinct()
    model.known = [r["word"] for r in _near_words(good, model).collect()]
    scored = _score_rows(sample.select(ID, TEXT, "toxic"), model, ["toxic"]).toPandas()
    x = _inputs(scored["abuse"].to_numpy(), scored["quoted"].to_numpy())
    model.weights = _fit(x, scored["toxic"].to_numpy(float)).tolist()
    return model


def _near_words(words: DataFrame, model: Model) -> DataFrame:
    """Words one error away from the lexicon (few: they are bounded by its size)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Automaton(model.words, model.stems)
        for batch in batches:
            found = [w for w in batch.column(0).to_pylist() if 0 < automaton.match(w or "") < EXACT]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.string())], names=["word"])

    return words.mapInArrow(run, "word string")


def _score_rows(rows: DataFrame, model: Model, carry: list[str]) -> DataFrame:
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in [ID, *carry])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = _scorer(model)
        w = np.array(model.weights)
        for batch in small(batches):
            abuse, quoted = score(text_array(batch.column(TEXT)))
            p = 1 / (1 + np.exp(-np.clip(_inputs(abuse, quoted) @ w, -30, 30)))
            names = [ID, *carry, "abuse", "quoted", "score"]
            columns = [batch.column(c) for c in names[:-3]]
            yield pa.RecordBatch.from_arrays([*columns, *map(pa.array, (abuse, quoted, p))], names=names)

    return rows.mapInArrow(run, f"{schema}, abuse double, quoted double, score double")


def score_toxicity(docs: DataFrame, model: Model, keep: bool = False) -> DataFrame:
    """``doc_id, abuse, quoted, score`` of every whole text, row by row.

    ``score`` (0 to 1) is higher the likelier a document is toxic. Null and empty texts have no hits
    and get the score of a document without hits; equal texts get equal scores, long ones are read
    whole, null ids are ids like others. An empty table gives no rows. No row is shuffled.
    Extra columns are not read; with ``keep`` the whole row comes along as ``doc``.
    """
    if not keep:
        return _score_rows(id_text(docs), model, [])
    # a text goes to Python and back once; the row is put together again from it and the other columns
    null = F.col(f"`{TEXT}`").isNull()
    rest = F.struct(null.alias("no_text"), *[F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(docs.columns) if c != TEXT])
    rows = docs.select(F.col(f"`{ID}`").alias(ID), F.coalesce(F.col(f"`{TEXT}`"), F.lit("")).alias(TEXT), rest.alias("rest"))
    whole = F.struct(
        *[
            (F.when(~F.col("rest.no_text"), F.col(TEXT)) if c == TEXT else F.col(f"rest.c{k}")).alias(c)
            for k, c in enumerate(docs.columns)
        ]
    )
    scored = _score_rows(rows, model, [TEXT, "rest"])
    return scored.select(ID, "abuse", "quoted", "score", whole.alias("doc"))
