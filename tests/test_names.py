"""The item rules in plain Python against the column functions, and where lists are worked on."""

import random
import re

from pyspark.sql import functions as F

from millrace.functions import items, names, rules
from millrace.functions import lists as L
from millrace.functions import text as X
from millrace.plans.prepare import prepare_csv

REWRITTEN = [*rules.BRANDS, *[t for p in rules.STUCK_PAIRS for t in p], *[wrong for wrong, _ in rules.MISREADINGS]]
ODD = [
    "½", "2½", "1 / 2", "3.5", "cu.p", "cu .p", "o..z", "2%", "(optional)", "(x", "a/b", "a | b", "or", "7-up", "ſugar", "taſte", "pık", "mİlk",
    "mİ", "Kg", "ΣΑΣ", "große", "é½", "٣", "²", "x https://a.b/c d", "• a", "\n- a", "*", "-", ".", "", " ", "\ta　b", "_x_", "!!", "campbell’x",
    "10x sugar", "10 × sugar", "10sugar", "LowFat", "White  Lily flour", "white velveeta lily x", "a  .b", "a\n.b", "a. . b.", "thes's",
]


def texts() -> list[str]:
    spelled = [s for t in [*rules.PHRASES, *REWRITTEN, rules.TEN_X[0]] for s in names.spellings(t)]
    spelled += [f"{a} {b}" for a, b in rules.STUCK_PAIRS]
    listed = [*rules.UNITS, *rules.DESCRIPTORS, *rules.SPELLING, *rules.ALIASES]
    rng = random.Random(3)
    every = spelled + listed + ODD
    mixed = [rng.choice([" ", "  ", ". ", " .", "-", "\n", "/", " or "]).join(rng.choices(every, k=rng.randint(2, 5))) for _ in range(1500)]
    found = [s.format(t, t) for t in every for s in ("{}", "{}s", "x{} {}", "2 {}", "{}’s", "({})")] + mixed
    return sorted({v for t in found for v in (t, t.title(), t.upper())})


def test_as_the_columns(apply):
    given = texts()
    assert [names.rewrite(t) for t in given] == apply(items.rewrite_always, given)
    assert [names.normalize(t) for t in given] == apply(lambda c: items.normalize_always(F.lower(c)), given)
    assert [names.has_quantity(t) for t in given] == apply(items.has_quantity, given)
    assert [names.clean(t) for t in given] == apply(X.clean, given)
    simple = [names.simple_name(t) for t in given]
    assert 0 < sum(n is None for n in simple) < len(given)


def test_displays_as_the_columns(apply):
    def shown(c):
        s = X.collapse_commas(F.replace(items.drop_parentheses(X.clean(items.rewrite_always(c))), F.lit(" ."), F.lit(".")))
        return items.strip_edges(F.replace(s, F.lit("."), F.lit("")))

    given = [t for t in texts() if "," not in t and ";" not in t]
    want = apply(shown, given)
    assert [names.display(t) for t in given] == want
    rich = dict(zip(want, apply(items.has_quantity, want)))
    rows = [(w, r) for t, w in zip(given, want) for r in names._displayed[t]]
    assert len(rows) > len(given) / 3
    assert all(text == w and score == (rich[w], len(w)) for w, (_, score, text) in rows)


def test_parts_can_be_rewritten_alone():
    assert not any(re.search("[,;]", t) for t in REWRITTEN)


def test_remembered_texts_are_bounded():
    table = names._Remembered(str.upper)
    assert [table[t] for t in ("a", "a", "b" * 100)] == ["A", "A", "B" * 100]
    assert list(table) == ["a"]
    for i in range(names._MEMO + 5):
        table[str(i)]
    assert len(table) <= names._MEMO


def test_pieces_hold_all_rows(spark, monkeypatch):
    """Batches taken apart give the rows of whole ones, nulls and empty lists too."""
    rows = [(i, None if i % 7 == 0 else [f"{j} cups salt{j % 3}" for j in range(i % 5)] + [None]) for i in range(300)]
    df = spark.createDataFrame(rows, "i int, v array<string>").coalesce(1)
    fn = lambda: [r["r"] for r in df.select("i", L.normalized_set(F.col("v")).alias("r")).orderBy("i").collect()]
    whole = fn()
    assert [None if v is None else list(dict.fromkeys(f"salt{j % 3}" for j in range(len(v) - 1))) for _, v in rows] == whole
    monkeypatch.setattr(L, "_PIECE", 64)
    assert fn() == whole


def interpreted(spark, col) -> int:
    df = spark.createDataFrame([(["a"], ["b"])], "a array<string>, b array<string>")
    return df.select(col)._jdf.queryExecution().optimizedPlan().toString().count("lambdafunction")


def test_displays_are_not_interpreted(spark):
    """No function is interpreted for every item of a list."""
    assert interpreted(spark, L.merge_keep_display(L.split_cell(F.col("a")[0]), F.col("b"))) == 0


def test_inputs_are_not_interpreted(spark):
    for mode in ("union", "intersection", "ner_only", "raw"):
        assert interpreted(spark, L.build_input(L.split_cell(F.col("a")[0]), F.col("b"), mode)) == 0


def test_merged_sets_have_no_blanks(spark):
    df = spark.createDataFrame([(["b", "", None, "a", "b"], ["", None, "c", "a"])], "a array<string>, b array<string>")
    for mode, want in {"union": "abc", "intersection": "a", "ner_only": "ac", "raw": "ab"}.items():
        assert df.select(L.merge_sets(F.col("a"), F.col("b"), mode)).first()[0] == list(want)


def test_rows_are_prepared_with_few_interpreted_functions(spark):
    """What is left reads cells and cleans steps; both sets of names are made by one Python process."""
    raw = spark.createDataFrame([(1, "t", "2 eggs, salt", "Mix; bake", "egg")], "row_id long, title string, ingredients string, directions string, ner string")
    rows = prepare_csv(raw)
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("lambdafunction") <= 10
    assert plan.count("ArrowEvalPython") == 3  # odd cells, sets, best displays
    assert rows.first()["ingredients"] == "eggs, salt"
