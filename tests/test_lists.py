import ast
import random

import pytest
from pyspark.sql import functions as F

from millrace.functions import lists as L
from millrace.operators.cells import parse_list

ITEMS = ["1 c. butter or margarine", "2 eggs", "1 c. sugar", "1/2 c. confectioners' sugar"]
SECOND = ["butter", "eggs", "sugar"]


@pytest.mark.parametrize(
    "mode,want",
    [
        ("union", "butter, eggs, margarine, powdered sugar"),
        ("intersection", "butter, eggs, sugar"),
        ("ner_only", "butter, eggs, sugar"),
        ("raw", "butter, eggs, margarine, powdered sugar"),
        ("anything", "butter, eggs, margarine, powdered sugar"),
    ],
)
def test_build_input(spark, mode, want):
    df = spark.createDataFrame([(ITEMS, SECOND)], "a array<string>, b array<string>")
    assert df.select(L.build_input(F.col("a"), F.col("b"), mode)).first()[0] == want


def test_union_commutes(spark):
    df = spark.createDataFrame([(ITEMS, SECOND)], "a array<string>, b array<string>")
    both = df.select(
        L.build_input(F.col("a"), F.col("b")).alias("x"), L.build_input(F.col("b"), F.col("a")).alias("y")
    ).first()
    assert both["x"] == both["y"]


def test_parse_list(apply):
    cells = {
        "['a', 'b ']": ["a", "b"], '["a","b"]': ["a", "b"], "[a, b]": ["[a", "b]"],
        "a; b,,c": ["a", "b", "c"], "": [], "[]": [], " [1, 'a', ''] ": ["1", "a"],
        "['a', 'b',]": ["a", "b"], "['a' 'b']": ["ab"], "[None, 'x']": ["None", "x"],
        r"['\x41', 'b']": ["A", "b"], r'["a\/b"]': [r"a\/b"], "[['a'], 'b']": ["['a']", "b"],
        "[true]": ["[true]"], "[-0, 1]": ["0", "1"], "['a, b', \"it's\"]": ["a, b", "it's"],
        r'["½ é"]': ["½ é"], "{'a': 1}": ["{'a': 1}"], "[1.50]": ["1.5"],
        r'["😀"]': None, None: [],
    }
    for cell in list(cells):
        if cells[cell] is None:
            cells[cell] = [str(x) for x in ast.literal_eval(cell)]
    cells.pop(r'["😀"]')  # lone surrogates cannot be stored as UTF-8 anyway
    assert apply(parse_list, list(cells)) == list(cells.values())


def test_long_literal(apply):
    """Long cells stay on the native path without running out of stack."""
    cell = "[" + ", ".join(f"'{'x' * 50}{i}'" for i in range(20_000)) + "]"
    got = apply(parse_list, [cell])[0]
    assert len(got) == 20_000
    assert apply(L.is_plain_literal, [cell]) == [True]


def test_split_alternatives(apply):
    texts = ["butter or margarine", "1/2 cup a/b", "1 / 2", "a | b OR c", " / ", "a or or b"]
    assert apply(L.split_alternatives, texts) == [
        ["butter", "margarine"], ["1/2 cup a", "b"], ["1", "2"], ["a", "b", "c"], [], ["a", "or b"],
    ]


def test_dedup(apply):
    assert apply(L.dedup_best_display, ["salt, 2 tsp salt, pepper", "b; a, 1 c a; bb", "", "cloves"]) == [
        "2 tsp salt, pepper", "b, 1 c a, bb", "", "",
    ]
    assert apply(L.dedup_keep_first, ["salt, 2 tsp salt, pepper", "cloves, x, ring"]) == [
        "salt, pepper", "cloves, x",
    ]


def test_dedup_against_brute_force(apply):
    rng = random.Random(5)
    names = ["salt", "2 salt", "cup of salt", "eggs", "egg", "pepper", "cloves", "1 g egg", "xs", "x"]
    texts = [", ".join(rng.choices(names, k=rng.randint(0, 12))) for _ in range(200)]
    key = dict(zip(names, apply(L.normalize_item, names)))
    rich = dict(zip(names, apply(L.has_quantity, names)))
    want = []
    for text in texts:
        best = {}
        for item in filter(None, text.split(", ")):
            k, score = key[item], (rich[item], len(item))
            if k and (k not in best or score > best[k][0]):
                best[k] = (score, item)
        want.append(", ".join(item for _, item in best.values()))
    got = apply(L.dedup_best_display, texts)
    assert got == want
    # one item per key is left, so keeping the first of each changes nothing
    assert apply(L.dedup_keep_first, got) == got


def test_long_list(apply):
    text = ", ".join(f"{i % 7} g item{i % 500}" for i in range(20_000))
    got = apply(L.dedup_best_display, [text])[0].split(", ")
    assert len(got) == 500


def test_merge_keep_display(spark):
    df = spark.createDataFrame([(ITEMS, [*SECOND, "basil; salt"])], "a array<string>, b array<string>")
    got = df.select(L.merge_keep_display(F.col("a"), F.col("b"))).first()[0]
    assert got == "1 c butter or margarine, 2 eggs, 1 c sugar, 1/2 c confectioners' sugar, basil, salt"
