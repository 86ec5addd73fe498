"""Corpus BLEU, ROUGE-L and perplexity."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.regex import sub
from millrace.operators.stem import stem

MAX_ORDER = 4
PIECE = 1 << 18  # tokens of an Arrow batch that are counted at once; a longer pair is a piece of its own

# --- fixed values: published "13a" tokenization ---------------------------------------------------
ENTITIES = [("&quot;", '"'), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">")]
PUNCTUATION = [
    (r"([\{-\~\[-\` -\&\(-\+\:-\@\/])", " $1 "),
    (r"([^0-9])([\.,])", "$1 $2 "),
    (r"([\.,])([^0-9])", " $1 $2"),
    (r"([0-9])(-)", "$1 $2 "),
]


def dialogue_pairs(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, reference, hypothesis): a turn and the one after it.

    Stands in for model output. Both sides are keyed by (conv_id, turn), so a long conversation
    does not end up in one task.
    """
    ref = turns.select("conv_id", "turn", F.col("text").alias("reference"))
    hyp = turns.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("hypothesis"))
    return ref.join(hyp, ["conv_id", "turn"])


# ---- BLEU ---------------------------------------------------------------------------------------


def tokenize_13a(text: Column) -> Column:
    text = sub(text, r"\s+\z", "")
    for old, new in [("<skipped>", ""), ("-\n", ""), ("\n", " "), *ENTITIES]:
        text = F.replace(text, F.lit(old), F.lit(new))
    text = F.concat(F.lit(" "), text, F.lit(" "))
    for pattern, replacement in PUNCTUATION:
        text = F.regexp_replace(text, pattern, replacement)
    return words(text)


def words(text: Column) -> Column:
    """Split at whitespace of any kind."""
    return F.filter(F.split(sub(text, r"\s+", " "), " "), lambda t: t != "")


def _numbered(ids: np.ndarray, text: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """N-grams one token longer: numbers that are equal just where the n-grams are, and their texts.

    ``ids`` numbers the n-grams in order, ``first`` the tokens that follow each (-1: none in its text).
    Pairs of numbers are sorted and numbered anew, so no two n-grams ever share one.
    """
    longer = first >= 0
    pairs = ids[longer] * (int(first.max(initial=0)) + 1) + first[longer]
    return np.unique(pairs, return_inverse=True)[1].astype(np.int64), text[longer]


def _clipped(hypotheses: pa.Array, references: pa.Array) -> np.ndarray:
    """Per pair of token lists and order: clipped matches, n-grams of the hypothesis and of the reference.

    The tokens of a whole batch are numbered once; n-grams are numbers throughout. Both sides of a
    pair are sorted together and meet there.
    """
    n = len(hypotheses)
    lists = [hypotheses, references]
    sizes = np.concatenate([pc.fill_null(pc.list_value_length(a), 0).to_numpy(zero_copy_only=False) for a in lists])
    tokens = pa.concat_arrays([a.flatten() for a in lists]).dictionary_encode().indices
    tokens = tokens.to_numpy(zero_copy_only=False).astype(np.int64)
    text = np.repeat(np.arange(2 * n), sizes)  # pair k is text k on the left and n + k on the right
    out = np.zeros((n, 3 * MAX_ORDER), np.int64)
    ids, place = tokens, np.arange(len(tokens))
    for order in range(MAX_ORDER):
        side = text >= n
        pair = np.where(side, text - n, text)
        for k, mine in ((1, ~side), (2, side)):
            out[:, k * MAX_ORDER + order] = np.bincount(pair[mine], minlength=n)
        if len(ids):
            code = pair * (int(ids.max()) + 1) + ids
            left, right = np.unique(code[~side], return_counts=True), np.unique(code[side], return_counts=True)
            _, i, j = np.intersect1d(left[0], right[0], assume_unique=True, return_indices=True)
            least = np.minimum(left[1][i], right[1][j])
            np.add.at(out[:, order], left[0][i] // (int(ids.max()) + 1), least)
        after = place + order + 1  # the token that makes an n-gram longer, if it is of the same text
        after_text = np.append(np.repeat(np.arange(2 * n), sizes), -1)[np.minimum(after, len(tokens))]
        follows = np.where(after_text == text, np.append(tokens, -1)[np.minimum(after, len(tokens))], -1)
        place = place[follows >= 0]
        ids, text = _numbered(ids, text, follows)
    return out


def _pieces(hypotheses: pa.Array, references: pa.Array) -> list[tuple[int, int]]:
    """(first pair, number of pairs) of pieces of a batch, each of ``PIECE`` tokens at most."""
    sizes = [pc.fill_null(pc.list_value_length(a), 0).to_numpy(zero_copy_only=False) for a in (hypotheses, references)]
    ends = np.cumsum(sizes[0].astype(np.int64) + sizes[1])
    out, first, done = [], 0, 0
    while first < len(ends):
        after = max(first + 1, int(np.searchsorted(ends, done + PIECE, side="right")))
        out.append((first, after - first))
        first, done = after, int(ends[after - 1])
    return out


def ngram_matches(hypothesis: Column, reference: Column) -> Column:
    """Twelve numbers a pair: by order 1 to 4 the clipped matches, then the n-grams of the hypothesis,
    then those of the reference. Counted inside the row, on Arrow batches; null texts have none."""

    def count(hypotheses: pa.Array, references: pa.Array) -> pa.Array:
        none = np.zeros((0, 3 * MAX_ORDER), np.int64)
        parts = [_clipped(hypotheses.slice(*p), references.slice(*p)) for p in _pieces(hypotheses, references)]
        rows = np.concatenate([none, *parts])
        ends = np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(rows.ravel()))

    return F.arrow_udf(count, "array<bigint>")(tokenize_13a(hypothesis), tokenize_13a(reference))


def _summed_matches(pairs: DataFrame, group_cols: list[str], reference: str, hypothesis: str, *more: Column) -> DataFrame:
    """By group: m1..m4 (matches), t1..t4 (of hypotheses), r1..r4 (of references), and ``more``."""
    numbers = pairs.withColumn("_n", ngram_matches(F.col(hypothesis), F.col(reference)))
    names = [f"{kind}{n}" for kind in "mtr" for n in range(1, MAX_ORDER + 1)]
    return numbers.groupBy(*group_cols).agg(*[F.sum(F.col("_n")[k]).alias(c) for k, c in enumerate(names)], *more)


def bleu_ngram_stats(
    pairs: DataFrame,
    id_cols: list[str],
    group_cols: list[str] | None = None,
    reference: str = "reference",
    hypothesis: str = "hypothesis",
) -> DataFrame:
    """Clipped matches and totals per n-gram order, and token totals, by group.

    A pair's n-grams are counted in its row and never become rows of their own; what is shuffled is
    one partial sum a task and group.
    """
    group_cols = group_cols or []
    sums = _summed_matches(pairs, group_cols, reference, hypothesis)
    rows = [
        F.struct(
            F.lit(n).alias("n"),
            F.col(f"m{n}").alias("matches"),
            F.col(f"t{n}").alias("total"),
            F.col(f"r{n}").alias("ref_total"),
        )
        for n in range(1, MAX_ORDER + 1)
    ]
    return sums.select(*group_cols, F.inline(F.array(*rows))).where("total + ref_total > 0")


def corpus_bleu(
    pairs: DataFrame,
    id_cols: list[str],
    group_cols: list[str] | None = None,
    reference: str = "reference",
    hypothesis: str = "hypothesis",
) -> DataFrame:
    """Corpus BLEU by group: brevity penalty, exponential smoothing, 0 where nothing matches."""
    group_cols = group_cols or []
    sums = _summed_matches(pairs, group_cols, reference, hypothesis)
    return sums.withColumn("ref_len", F.col("r1")).select(*group_cols, bleu_score().alias("bleu"))


def bleu_score() -> Column:
    """The closed form over columns m1..m4 (matches), t1..t4 (totals) and ref_len.

    The k-th order without a match counts as 1 / 2^k match.
    """
    orders = range(1, MAX_ORDER + 1)
    m, t = [F.col(f"m{n}") for n in orders], [F.col(f"t{n}") for n in orders]
    logs = F.lit(0.0)
    for i in range(MAX_ORDER):
        empty = sum(((m[j] == 0).cast("int") for j in range(i + 1)), F.lit(0))
        hits = F.when(m[i] > 0, m[i].cast("double")).otherwise(F.pow(F.lit(2.0), -empty))
        logs = logs + F.ln(hits / t[i])
    penalty = F.when(
        t[0] < F.col("ref_len"), F.exp(1 - F.col("ref_len") / t[0])
    ).otherwise(F.lit(1.0))
    none = (m[0] + m[1] + m[2] + m[3] == 0) | (t[3] == 0)
    return F.when(none, F.lit(0.0)).otherwise(100 * penalty * F.exp(logs / MAX_ORDER))


# ---- ROUGE-L ------------------------------------------------------------------------------------


def rouge_tokens(text: Column) -> Column:
    """Lower-cased runs of ASCII letters and digits, joined by one blank."""
    return F.trim(F.regexp_replace(F.lower(text), r"[^a-z0-9]+", " "))


def lcs_length(a: list, b: list) -> int:
    """Length of the longest common subsequence, one machine-word operation per 64 places."""
    places: dict = {}
    for i, token in enumerate(a):
        places[token] = places.get(token, 0) | (1 << i)
    full = (1 << len(a)) - 1
    row = full
    for token in b:
        if hit := row & places.get(token, 0):
            row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


def _rouge(stemmed: bool):
    def f1(references: pd.Series, hypotheses: pd.Series) -> pd.Series:
        known: dict[str, str] = {}

        def tokens(text: str | None) -> list[str]:
            out = (text or "").split()
            if stemmed:
                for t in out:
                    if t not in known:
                        known[t] = stem(t) if len(t) > 3 else t
                out = [known[t] for t in out]
            return out

        def score(ref: str | None, hyp: str | None) -> float:
            r, h = tokens(ref), tokens(hyp)
            common = lcs_length(r, h) if r and h else 0
            return 2.0 * common / (len(r) + len(h)) if common else 0.0

        return pd.Series([score(r, h) for r, h in zip(references, hypotheses)], dtype="float64")

    return f1


def rouge_l(reference: Column, hypothesis: Column, use_stemmer: bool = True) -> Column:
    """ROUGE-L F1 of one pair. Tokens are cut natively; the subsequence runs on Arrow batches."""
    f1 = F.pandas_udf(_rouge(use_stemmer), "double")
    return f1(rouge_tokens(reference), rouge_tokens(hypothesis))


def metrics_row(
    pairs: DataFrame, split: str, id_cols: list[str], use_stemmer: bool = True
) -> DataFrame:
    """One row: split, N, mean ROUGE-L F1 x 100, corpus BLEU, in one pass. No pairs give zeros."""
    rouge = rouge_l(F.col("reference"), F.col("hypothesis"), use_stemmer)
    sums = _summed_matches(
        pairs.withColumn("_rouge", rouge),
        [],
        "reference",
        "hypothesis",
        F.count("*").alias("N"),
        (100 * F.coalesce(F.avg("_rouge"), F.lit(0.0))).alias("rougeL_f1"),
    )
    bleu = F.coalesce(bleu_score(), F.lit(0.0))
    return sums.withColumn("ref_len", F.col("r1")).select(F.lit(split).alias("split"), "N", "rougeL_f1", bleu.alias("bleu"))


# ---- perplexity ---------------------------------------------------------------------------------


def perplexity(
    losses: DataFrame, group_cols: list[str], loss: str = "loss", tokens: str | None = None
) -> DataFrame:
    """Mean loss and exp(min(20, mean)) by group: the mean of batch means, or weighted by tokens."""
    if tokens is None:
        mean = F.avg(loss)
    else:
        mean = F.sum(F.col(loss) * F.col(tokens)) / F.sum(tokens)
    return (
        losses.groupBy(*group_cols)
        .agg(mean.alias("mean_loss"))
        .withColumn("ppl", F.exp(F.least(F.lit(20.0), F.col("mean_loss"))))
    )
