"""Personal data: generators propose spans, boosted trees and calibrated thresholds choose among them.

DataFrame operations only. The strict formats (``BASE``) are always redacted; what the trees choose
beyond them comes from loose generators, and never overlaps a strict span.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.once import with_once
from millrace.llm.spans import SPAN, in_order, matches
from millrace.llm.texts import ID, TEXT, id_text, whole_rows
from millrace.sources.shared import materialize

# --- fixed values: the strict formats. Possessive loops match what plain ones do, without a stack;
# an email's name can only begin where a run of its characters does, or right after a match. --------
KINDS = ["email", "ip", "card", "phone"]
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"[0-9]++(?:\.[0-9]++){3}"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
# --- fixed values: the loose formats ---------------------------------------------------------------
LOOSE = {
    "number": r"[+(]?[0-9](?:[\x20().:/-]{0,2}+[0-9]){5,}+",
    "account": r"\b[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}+(?:\x20?[A-Z0-9]{1,3})?\b",
    "address": r"[\p{L}\p{N}._%+-]++\x20?(?:@|\(at\)|\[at\])\x20?[\p{L}\p{N}-]++(?:\x20?(?:\.|\(dot\)|\[dot\])\x20?[\p{L}\p{N}-]++)++",
}
CONTEXT = 24  # code points on either side
CUES = (
    r"(?i)\b(?:call|phone|tel|mobile|fax|mail|e-?mail|contact|reach|write to|card|visa|account|iban|ssn|"
    r"social security|ip|address|born|passport|licen[cs]e no)\b"
)
AT, DOT = r"\x20?(?:@|\(at\)|\[at\])\x20?", r"\x20?(?:\(dot\)|\[dot\])\x20?"
PLAIN_ADDRESS = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}$"
# the teacher of numbers without a strict format; the trees see neither it nor the formats' marks
TAUGHT_CUES = r"(?i)\b(?:call|phone|tel|mobile|fax|card|visa|ssn|social security|passport|licen[cs]e no)\b"
FEATURES = [
    "is_number", "is_account", "n_chars", "n_digits", "n_letters", "n_dots", "n_dashes", "n_blanks",
    "n_brackets", "n_colons", "n_groups", "longest_group", "small_groups", "cue_after",
    "letter_before", "letter_after", "sign_before",
]


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, r"[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether a text of digits passes the check sum."""
    values = F.transform(
        F.split(F.reverse(digits), ""),
        lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(
            F.when(c.cast("int") > 4, c.cast("int") * 2 - 9).otherwise(c.cast("int") * 2)
        ),
    )
    return F.aggregate(values, F.lit(0), lambda a, v: a + F.coalesce(v, F.lit(0))) % 10 == 0


def _mod97(account: Column) -> Column:
    """Whether an account passes the check sum of IBANs: the first four signs last, letters from 10 on."""
    bare = F.regexp_replace(account, r"\x20", "")
    turned = F.concat(F.substring(bare, 5, 64), F.left(bare, F.lit(4)))
    sign = lambda c: F.when(c.rlike("[0-9]"), c.cast("int")).otherwise(F.ascii(c) - 55)
    step = lambda a, v: (a * F.when(v > 9, 100).otherwise(10) + v) % 97
    return F.aggregate(F.transform(F.regexp_extract_all(turned, F.lit("[0-9A-Z]"), F.lit(0)), sign), F.lit(0), step) == 1


def _plain(address: Column) -> Column:
    """An address with its signs written out."""
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(address, AT, "@"), DOT, "."), r"\x20?\.\x20?", ".")


def _right(kind: Column, m: Column, before: Column, strict: Column) -> Column:
    """The teacher: check sums of accounts, addresses written out, strict formats and cues for numbers."""
    return (
        F.when(kind == "account", _mod97(m))
        .when(kind == "address", _plain(m).rlike(PLAIN_ADDRESS))
        .otherwise(strict | before.rlike(TAUGHT_CUES))
    )


def _sure(kind: Column, m: Column, before: Column) -> Column:
    """What needs no trees: accounts whose check sum is right, addresses written out, and numbers of 7 to
    15 digits behind a word that announces one."""
    announced = before.rlike(TAUGHT_CUES) & F.char_length(_digits(m)).between(7, 15)
    return F.when(kind == "number", announced).otherwise(_right(kind, m, before, F.lit(False)))


def _octets(text: Column) -> Column:
    """Every dotted part is at most 255."""
    parts = F.transform(F.split(text, r"\."), lambda p: F.regexp_replace(p, r"^0+(?=[0-9])", ""))
    return F.forall(parts, lambda p: (F.char_length(p) < 3) | ((F.char_length(p) == 3) & (p <= "255")))


def base_spans(text: Column) -> Column:
    """Strict spans, by kind as listed and then by start."""
    n = lambda m: F.char_length(_digits(m))
    found = [
        matches(text, EMAIL, "email", text.contains("@")),
        F.filter(
            matches(text, IP, "ip", text.rlike(r"[0-9]\.[0-9]")), lambda s: _octets(s["match"])
        ),
        F.filter(
            matches(text, CARD, "card", text.rlike(r"[0-9](?:[\x20-]?[0-9]){12}")),
            lambda s: F.when(n(s["match"]).between(13, 19), _luhn(_digits(s["match"]))).otherwise(False),
        ),
        F.filter(
            matches(text, PHONE, "phone", text.contains("+")), lambda s: n(s["match"]).between(9, 15)
        ),
    ]
    return F.when(text.rlike(r"[0-9@]"), F.concat(*found)).otherwise(F.array().cast(SPAN))


def loose_spans(text: Column) -> Column:
    """What the loose generators propose; they may overlap one another and strict spans."""
    gates = {
        "number": text.rlike(r"[0-9]"),
        "account": text.rlike(r"[A-Z]{2}[0-9]{2}"),
        "address": text.contains("@") | text.contains("(at)") | text.contains("[at]"),
    }
    return F.concat(*[matches(text, p, kind, gates[kind]) for kind, p in LOOSE.items()])


def _overlap(a: Column, b: Column) -> Column:
    return (a["start"] < b["end"]) & (b["start"] < a["end"])


def _features(kind: Column, m: Column, before: Column, after: Column) -> dict[str, Column]:
    """What the trees see: shape and surroundings, without a leading plus or how an address is written."""
    m = F.when(kind == "address", _plain(m)).otherwise(F.regexp_replace(m, r"^\+", ""))
    count = lambda p: F.char_length(m) - F.char_length(F.regexp_replace(m, p, ""))
    groups = F.filter(F.split(m, r"[^0-9]+"), lambda g: g != "")
    sizes = F.transform(groups, lambda g: F.char_length(g))
    last = F.right(before, F.lit(1))
    values = [
        kind == "number", kind == "account",
        F.char_length(m), count(r"[0-9]"), count(r"\p{L}"), count(r"\."), count("-"), count(" "),
        count(r"[()\[\]]"), count(":"), F.size(groups), F.coalesce(F.array_max(sizes), F.lit(0)),
        F.forall(groups, lambda g: F.char_length(g) <= 3),
        after.rlike(CUES), last.rlike(r"\p{L}"),
        F.left(after, F.lit(1)).rlike(r"[\p{L}]"), last.rlike(r"[#$%&*=]"),
    ]
    return {k: v.cast("double") for k, v in zip(FEATURES, values)}


def _choose(rows: DataFrame, sample: int, precision: float) -> DataFrame:
    """Loose candidates that are sure or that the trees choose: (row, kind, start, end).

    What ``_right`` says teaches. Trees are fitted on at most ``sample`` candidates (by hash); each
    kind's threshold is the lowest score from which on the held-out third of all candidates reaches
    ``precision``, one more wrong one being counted than was seen. Without candidates of both labels
    there is nothing to teach, and the sure ones are all.
    """
    text = F.col(TEXT)
    c = rows.select("row", "base", TEXT, F.explode("loose").alias("c"))
    before = F.substring(text, F.greatest(F.col("c.start") - CONTEXT + 1, F.lit(1)), F.least(F.lit(CONTEXT), F.col("c.start")))
    after = F.substring(text, F.col("c.end") + 1, F.lit(CONTEXT))
    strict = F.exists("base", lambda b: _overlap(b, F.col("c")))
    c = c.select(
        "row",
        F.col("c.kind").alias("kind"),
        F.col("c.start").alias("start"),
        F.col("c.end").alias("end"),
        F.col("c.match").alias("match"),
        before.alias("before"),
        after.alias("after"),
        strict.alias("strict"),
    )
    right = F.coalesce(_right(F.col("kind"), F.col("match"), F.col("before"), F.col("strict")), F.lit(False))
    sure = F.coalesce(_sure(F.col("kind"), F.col("match"), F.col("before")), F.lit(False))
    c = c.select(
        "row", "kind", "start", "end", "strict", sure.alias("sure"), right.cast("double").alias("label"),
        F.xxhash64("match", "before", "after", "row").alias("h"),
        *[v.alias(k) for k, v in _features(F.col("kind"), F.col("match"), F.col("before"), F.col("after")).items()],
    )
    c = materialize(VectorAssembler(inputCols=FEATURES, outputCol="x").transform(c).drop(*FEATURES), "pii-candidates")
    held = F.pmod("h", F.lit(3)) == 0
    taught = materialize(c.where(~held).orderBy("h", "row", "start", "kind").limit(sample), "pii-sample")
    spans = ["row", "kind", "start", "end"]
    if len(taught.select("label").distinct().collect()) < 2:
        return c.where(F.col("sure") & ~F.col("strict")).select(*spans)
    trees = GBTClassifier(
        featuresCol="x", labelCol="label", maxIter=8, maxDepth=3, stepSize=0.3, seed=1, maxBins=16
    ).fit(taught.coalesce(1))
    scored = trees.transform(c).withColumn("score", F.floor(vector_to_array("probability")[1] * 100) / 100)
    grid = (
        scored.where(held)
        .groupBy("kind", "score")
        .agg(F.sum("label").alias("right"), F.count("*").alias("n"))
        .collect()  # at most 101 rows a kind
    )
    limits = {}
    for kind in LOOSE:
        right = n = 0
        for r in sorted((r for r in grid if r["kind"] == kind), key=lambda r: -r["score"]):
            right, n = right + r["right"], n + r["n"]
            if right >= precision * (n + 1):
                limits[kind] = r["score"]
    passes = reduce(or_, [(F.col("kind") == k) & (F.col("score") >= v) for k, v in limits.items()], F.col("sure"))
    return scored.where(passes & ~F.col("strict")).select(*spans)


def find_pii(docs: DataFrame, sample: int = 20_000, precision: float = 0.95, keep: bool = False) -> DataFrame:
    """Spans of personal data: ``doc_id, base`` (strict, by kind and start), ``added, redacted``.

    ``base`` and ``added`` are arrays of (kind, start, end) in code points, end exclusive;
    ``redacted`` is the text with every span replaced by its kind in brackets. ``added`` overlaps
    no strict span; of chosen candidates that overlap, the first (longest at a tie) stays. Sure ones
    are added at every size of the table, others if trees can be taught.

    Null and empty texts have no spans; long ones are read whole. Rows are handled one by one, equal
    ones alike, null ids are ids like others, and an empty table gives no rows. Extra columns are not
    read; with ``keep`` the whole row comes along as ``doc``.
    """
    rows = whole_rows(docs) if keep else id_text(docs)
    carried = [c for c in rows.columns]
    text = F.col(TEXT)
    # rows are told apart by id and text; equal rows share their candidates
    row = F.struct(F.col(ID).alias("id"), F.xxhash64(text).alias("h"), F.crc32(text).alias("c"))
    some = text.rlike(r"[0-9@]|\(at\)|\[at\]")
    rows = with_once(rows, [*carried], row=row, base=base_spans(text), some=some)
    hits = rows.where("some").select("row", TEXT, "base").withColumn("loose", loose_spans(text))
    hits = hits.where(F.size("loose") > 0)
    chosen = _choose(hits, sample, precision)
    empty = F.array().cast("array<struct<start:int,end:int,kind:string>>")
    span = F.struct("start", F.negative("end").alias("neg"), "end", "kind")
    lists = chosen.groupBy("row").agg(F.sort_array(F.collect_set(span)).alias("list"))
    one = F.aggregate(
        "list",
        empty,
        lambda acc, s: F.when(
            (F.size(acc) > 0) & (F.element_at(acc, -1)["end"] > s["start"]), acc
        ).otherwise(F.concat(acc, F.array(F.struct(s["start"], s["end"], s["kind"])))),
    )
    lists = lists.select(F.col("row").alias("_row"), one.alias("extra"))
    same = reduce(lambda a, b: a & b, [F.col(f"row.{k}").eqNullSafe(F.col(f"_row.{k}")) for k in ("id", "h", "c")])
    rows = rows.join(lists, same, "left").withColumn("extra", F.coalesce("extra", empty))
    narrow = lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"))
    added = F.filter("extra", lambda s: ~F.exists("base", lambda b: _overlap(b, s)))
    out = [c for c in carried if c != TEXT]
    rows = rows.select(*out, TEXT, F.transform("base", narrow).alias("base"), F.transform(added, narrow).alias("added"))
    return rows.select(*out, "base", "added", redact(F.col(TEXT), F.concat("base", "added")).alias("redacted"))


def redact(text: Column, spans: Column) -> Column:
    """Replace spans by ``[KIND]``; of spans that overlap, the first (longest at a tie) names the place.

    The pieces between are cut out one by one and joined once.
    """
    ordered = F.array_sort(
        F.transform(
            spans,
            lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("neg"), s["kind"].alias("kind")),
        )
    )
    # the end of all spans up to each one; a span that starts before the end of the ones before joins them
    start = F.struct(F.lit(0).alias("end"), F.array().cast("array<string>").alias("parts"))
    done = F.aggregate(
        ordered,
        start,
        lambda acc, s: F.struct(
            F.greatest(acc["end"], -s["neg"]).alias("end"),
            F.when(s["start"] < acc["end"], acc["parts"])
            .otherwise(
                F.concat(
                    acc["parts"],
                    F.array(
                        F.substring(text, acc["end"] + 1, s["start"] - acc["end"]),
                        F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")),
                    ),
                )
            )
            .alias("parts"),
        ),
        lambda acc: F.concat(
            F.array_join(acc["parts"], ""), F.substring(text, acc["end"] + 1, F.char_length(text))
        ),
    )
    return F.when(F.size(spans) > 0, done).otherwise(text)
