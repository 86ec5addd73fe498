"""Secrets: fixed formats, and a battery of randomness tests with false-discovery control."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.texts import ID, TEXT, id_text, id_type, raw, small, text_array
from millrace.sources.shared import materialize

# --- fixed values: the formats, and the encodings with their alphabets ------------------------------
KINDS = ["assign", "access", "hex", "random"]
ASSIGN = re.compile(
    r"(?ai)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")  # the runs of 32 and more; shorter ones would be dropped
CANDIDATE = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
_PART = re.compile(r"[^/]{16,}")
ENCODINGS = [
    ("digits", "0123456789"),
    ("hex", "0123456789abcdef"),
    ("HEX", "0123456789ABCDEF"),
    ("base32", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
    ("base36", "0123456789abcdefghijklmnopqrstuvwxyz"),
    ("BASE36", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    ("base62", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"),
    ("base64", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/-_"),
]
_SETS = [(frozenset(alphabet), {c: i for i, c in enumerate(alphabet)}) for _, alphabet in ENCODINGS]
_CASED = [("letters", "abcdefghijklmnopqrstuvwxyz"), ("LETTERS", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")]  # beside infer()
_SETS += [(frozenset(alphabet), {c: i for i, c in enumerate(alphabet)}) for _, alphabet in _CASED]
LEAST_BITS = 64  # a random token of fewer bits is no secret, and too short for the tests to tell
BINS = 1 << 30  # a level (hundredths of -log10 p) that no token reaches
# how identifiers go on: after a lower letter, a capital, a digit, another sign; to the same in turn
GRAMMAR = [
    [0.86, 0.06, 0.04, 0.04],
    [0.60, 0.30, 0.05, 0.05],
    [0.12, 0.08, 0.70, 0.10],
    [0.60, 0.20, 0.17, 0.03],
]
SIGNS = 6  # + / _ - = .
DRAWS, LOST = 2000, 0.005  # simulated tokens a table, and the share of random ones that each test may reject
SETTLED = 4096  # symbols from which on the tables are the same; only tables are shared, all symbols count


def _normal(z: float) -> float:
    """Two-sided tail of a standard normal."""
    return math.erfc(abs(z) / math.sqrt(2))


def _chi_squared(x: float, k: int) -> float:
    """Upper tail for ``k`` degrees of freedom (cube-root normal approximation)."""
    if k <= 0:
        return 1.0
    z = ((x / k) ** (1 / 3) - (1 - 2 / (9 * k))) / math.sqrt(2 / (9 * k))
    return 0.5 * math.erfc(z / math.sqrt(2))


def infer(token: str) -> int | None:
    """Index of the smallest alphabet that holds the token; words (letters of one case, or with a
    capital in front) are in none."""
    body = token.rstrip("=")
    if body.isalpha() and (body.islower() or body.isupper() or body[1:].islower()):
        return None
    symbols = set(body)
    for k, (letters, _) in enumerate(_SETS[: len(ENCODINGS)]):
        if symbols <= letters:
            return k
    return None


def alphabet_of(token: str) -> int:
    """As ``infer``; letters of one case (the first may be a capital) are over 26 letters."""
    encoding = infer(token)
    if encoding is None:
        encoding = len(ENCODINGS) + token.isupper()
    return encoding


# ---- the battery: is the token as random as its alphabet allows? --------------------------------------


def _statistics(v: np.ndarray, k: int) -> np.ndarray:
    """Of rows of n symbols below k: chi-squared of the counts, |z| of runs, |z| of serial correlation."""
    rows, n = v.shape
    counts = np.zeros((rows, k))
    np.add.at(counts, (np.repeat(np.arange(rows), n), v.ravel()), 1)
    chi = ((counts - n / k) ** 2).sum(axis=1) * k / n
    high = v >= k / 2
    a = high.sum(axis=1)
    mean = 2 * a * (n - a) / n + 1
    runs = 1 + (high[:, 1:] != high[:, :-1]).sum(axis=1)
    spread = np.sqrt(np.maximum((mean - 1) * (mean - 2) / (n - 1), 1e-9))
    z = np.where((a > 0) & (a < n), np.abs(runs - mean) / spread, np.inf)
    around = v - v.mean(axis=1, keepdims=True)
    total = (around**2).sum(axis=1)
    serial = np.abs((around[:, :-1] * around[:, 1:]).sum(axis=1)) / np.maximum(total, 1e-9) * math.sqrt(n)
    return np.stack([chi, z, np.where(total > 0, serial, np.inf)], axis=1)


@lru_cache(4096)
def critical(k: int, n: int) -> np.ndarray:
    """What the three statistics exceed in a share ``LOST`` of random tokens of n of k symbols.

    From seeded draws, as the usual approximations are off where a symbol is expected less than once.
    """
    draws = max(200, min(DRAWS, 400_000 // n))
    v = np.random.default_rng([k, n]).integers(0, k, (draws, n))
    return np.quantile(_statistics(v, k), 1 - LOST, axis=0)


def _limits(k: int, n: int) -> np.ndarray:
    """``critical`` for all n symbols. Above 128 it is interpolated between multiples of 128, so that long
    tokens share tables; above ``SETTLED`` the three laws are those of the limit and change no more."""
    if n <= 128 or n >= SETTLED:
        return critical(k, min(n, SETTLED))
    low, part = n // 128 * 128, n % 128 / 128
    return (1 - part) * critical(k, low) + part * critical(k, low + 128) if part else critical(k, low)


def looks_random(token: str, encoding: int) -> bool:
    """None of the three tests rejects that the symbols are uniform and independent."""
    place = _SETS[encoding][1]
    if encoding == len(ENCODINGS):
        token = token.lower()  # the first letter may be a capital
    v = np.array([[place[c] for c in token.rstrip("=")]])
    return bool((_statistics(v, len(place))[0] <= _limits(len(place), v.shape[1])).all())


# ---- the law of text: is the token anything but a random one? -----------------------------------------


def _letter_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How often a letter follows another, or begins a word (27th row), in words a batch has twice."""
    cells = np.zeros(27 * 27, np.int64)
    for batch in small(batches):
        words = pc.split_pattern_regex(pc.ascii_lower(text_array(batch.column(TEXT))), "[^a-z]+").flatten()
        found = words.value_counts()
        values, counts = found.field("values"), found.field("counts").to_numpy()
        kept = np.flatnonzero((counts > 1) & (pc.binary_length(values).to_numpy() > 1))
        data, off = raw(text_array(values.take(pa.array(kept))))
        sizes = np.diff(off)
        prev = np.append(26, data[:-1].astype(np.int64) - 97)
        prev[off[:-1][: len(sizes)]] = 26
        if len(data):
            cell = prev * 27 + (data.astype(np.int64) - 97)
            cells += np.bincount(cell, np.repeat(counts[kept], sizes), 27 * 27).astype(np.int64)
    yield pa.RecordBatch.from_pydict({"cell": np.flatnonzero(cells).astype(np.int32), "n": cells[cells > 0]})


class TextLaw:
    """The probability of a token as text: letters follow each other as in the words of the table, and
    words, digits and signs follow each other as in identifiers (``GRAMMAR``)."""

    def __init__(self, pairs: dict[int, int]):
        n = np.array([pairs.get(i, 0) for i in range(27 * 27)], float).reshape(27, 27)[:, :26] + 0.5
        self.letter = np.log(n / n.sum(axis=1, keepdims=True)).tolist()
        self.grammar = np.log(GRAMMAR).tolist()

    def evidence(self, token: str, encoding: int) -> float:
        """Log of how many times likelier the token is as a random one than as text.

        Under the law of text its exponential has mean one, so text exceeds e^x with a chance of
        e^-x at most: the exponential of its negative is a p value, valid at every length.
        """
        body = token.rstrip("=")
        if not any(c.islower() for c in body):
            body = body.swapcase()
        one_case = encoding >= len(ENCODINGS)  # its cases are given, only the letters tell
        grammar, letter = self.grammar, self.letter
        text, kind, last = 0.0, 3, 26
        for c in body:
            code = ord(c)
            if 97 <= code <= 122:
                now, x = 0, code - 97
            elif 65 <= code <= 90:
                now, x = 1, code - 65
            else:
                now, x = (2, 0) if 48 <= code <= 57 else (3, 0)
            if not one_case:
                text += grammar[kind][now]
            if now < 2:
                begins = kind > 1 or (kind == 0 and now == 1)
                text += letter[26 if begins else last][x]
                last = x
            else:
                text -= _LOG_10 if now == 2 else _LOG_SIGNS
            kind = now
        return -len(body) * math.log(len(_SETS[encoding][1])) - text


_LOG_10, _LOG_SIGNS = math.log(10), math.log(SIGNS)


def text_law(docs: DataFrame) -> TextLaw:
    """Learned from all documents; what reaches the driver are 27 x 27 sums."""
    parts = id_text(docs).select(TEXT).mapInArrow(_letter_pairs, "cell int, n bigint")
    return TextLaw({r["cell"]: r["n"] for r in parts.groupBy("cell").agg(F.sum("n").alias("n")).collect()})


def battery(token: str, encoding: int) -> float:
    """p value of "the token's symbols are uniform and independent", Bonferroni over three tests."""
    place = _SETS[encoding][1]
    v = np.array([place[c] for c in token.rstrip("=")])
    n, k = len(v), len(place)
    counts = np.bincount(v, minlength=k)
    p = [_chi_squared(float(((counts - n / k) ** 2).sum() * k / n), k - 1)]
    high = v >= k / 2
    a, b = int(high.sum()), int((~high).sum())
    if a and b:
        mean = 2 * a * b / n + 1
        var = (mean - 1) * (mean - 2) / (n - 1)
        if var > 0:
            p.append(_normal((1 + int((high[1:] != high[:-1]).sum()) - mean) / math.sqrt(var)))
    else:
        p.append(2.0 ** (1 - n))
    x, y = v[:-1] - v.mean(), v[1:] - v.mean()
    spread = float(((v - v.mean()) ** 2).sum())
    p.append(_normal(float((x * y).sum()) / spread * math.sqrt(n)) if spread else 0.0)
    return min(1.0, len(p) * min(p))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed formats, sorted."""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= 8]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def _tested(text: str, start: int, end: int, law: TextLaw) -> tuple[float, int, int, int, int] | None:
    """(evidence, start, end, encoding, symbols) of a piece of a text that is long enough to judge."""
    token = text[start:end]
    n = len(token.rstrip("="))
    if not n:
        return None
    encoding = alphabet_of(token)
    if n * math.log2(len(_SETS[encoding][1])) < LEAST_BITS:
        return None
    return law.evidence(token, encoding), start, end, encoding, n


def candidates(text: str, law: TextLaw) -> list[tuple[int, int, int, int]]:
    """(start, end, stratum, level) of tokens that could be random; stratum: encoding and length band.

    Of a token with slashes the parts between are judged, too, and the one that looks least like text
    stands for it; the evidence is divided by their number. The level is in hundredths of -log10 p;
    tokens in which the battery finds structure have none.
    """
    out = []
    for m in CANDIDATE.finditer(text):
        found = [_tested(text, m.start(), m.end(), law)]
        if "/" in m.group():
            found += [_tested(text, m.start() + p.start(), m.start() + p.end(), law) for p in _PART.finditer(m.group())]
        found = [f for f in found if f]
        if not found:
            continue
        best, start, end, encoding, n = max(found, key=lambda f: (f[0], f[2] - f[1]))
        evidence = best - math.log(len(found))
        level = max(0, int(evidence / _LOG_10 * 100))
        if level and not looks_random(text[start:end], encoding):
            level = 0
        out.append((start, end, encoding * 64 + n.bit_length(), level))
    return out


def thresholds(counts: list[tuple[int, int, int]], q: float) -> dict[int, int]:
    """Benjamini-Hochberg for each stratum: the level from which on a token is no text.

    ``counts`` has (stratum, level, number). A level stands for its largest p, so no more is rejected
    than with the exact values. Strata are encoding and length band, so long tokens, for which the
    evidence is strong, do not lend it to short ones.
    """
    out = {}
    for stratum in {c[0] for c in counts}:
        own = sorted(((b, n) for s, b, n in counts if s == stratum), reverse=True)
        total, seen, limit = sum(n for _, n in own), 0, BINS
        for level, n in own:
            seen += n
            if -level / 100 <= math.log10(q * seen / total):
                limit = level
        out[stratum] = limit
    return out


_LIST = "array<struct<start:int,kind:int,end:int>>"
_SCAN = f"base {_LIST}, found array<struct<start:int,end:int,stratum:int,level:int>>"


def _scan(law: TextLaw):
    base_type = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())]))
    found_type = pa.list_(
        pa.struct([(x, pa.int32()) for x in ("start", "end", "stratum", "level")])
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            base, found = [], []
            for text in text_array(batch.column(TEXT)).to_numpy(zero_copy_only=False):
                base.append([dict(zip(("start", "kind", "end"), s)) for s in base_spans(text)])
                found.append([dict(zip(("start", "end", "stratum", "level"), s)) for s in candidates(text, law)])
            yield pa.RecordBatch.from_arrays(
                [batch.column(ID), pa.array(base, base_type), pa.array(found, found_type)],
                names=[ID, "base", "found"],
            )

    return run


def find_secrets(docs: DataFrame, q: float = 0.01) -> DataFrame:
    """Secrets in whole texts: ``doc_id, base, added``, arrays of (kind, start, end) in code points.

    ``base`` has the fixed formats by start and kind. ``added`` has kind ``random``: tokens that are no
    text and look random. For every token of 64 bits or more the evidence against text is weighed (see
    ``TextLaw``), over all tokens of the table with one encoding and length band Benjamini-Hochberg
    at ``q`` bounds the share of text among those reported, and the battery (chi-squared, runs, serial
    correlation, with tables by alphabet and length) must find no structure in them. What overlaps a
    fixed format is left to it.

    Null and empty texts have no spans. Long texts are scanned whole. Rows are scanned one by one and
    equal rows get equal spans; null ids are ids like others; an empty table gives no rows, and a table
    with few words learns a law in which all letters are alike. Extra columns are not read.
    """
    rows = id_text(docs)
    law = text_law(docs)
    scanned = materialize(rows.mapInArrow(_scan(law), f"{ID} {id_type(rows)}, {_SCAN}"), "secrets")
    bins = scanned.select(F.explode("found").alias("f")).groupBy("f.stratum", "f.level").count()
    # one row for each encoding, band and level: at most hundredths of the longest token's evidence
    limits = thresholds([(r["stratum"], r["level"], r["count"]) for r in bins.collect()], q)
    limit = F.create_map(*[F.lit(x) for pair in {-1: BINS, **limits}.items() for x in pair])
    names = F.array(*[F.lit(k) for k in KINDS])
    random = F.filter(
        "found",
        lambda f: (f["level"] > 0)
        & (f["level"] >= F.element_at(limit, f["stratum"]))
        & ~F.exists("base", lambda b: (b["start"] < f["end"]) & (f["start"] < b["end"])),
    )
    return scanned.select(
        ID,
        F.transform(
            "base",
            lambda b: F.struct(
                F.get(names, b["kind"]).alias("kind"), b["start"].alias("start"), b["end"].alias("end")
            ),
        ).alias("base"),
        F.transform(
            random,
            lambda f: F.struct(
                F.lit("random").alias("kind"), f["start"].alias("start"), f["end"].alias("end")
            ),
        ).alias("added"),
    )
