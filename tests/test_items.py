import itertools
import re
import time

import pytest
from pyspark.sql import functions as F

from millrace.functions import items, rules
from millrace.functions.regex import matches

GOLDEN = {
    "2 cups chopped onions": "onion",
    "1 lb. lean ground beef": "lean beef",
    "1 pkg. cream cheese, softened": "cream cheese",
    "2% milk": "milk",
    "all-purpose flour": "all purpose flour",
    "7-Up": "up",
    "salt and pepper to taste": "salt pepper",
    "2 c. Campbell's soup": "soup",
    "Velveeta": "",
    "half and half": "",
    "2 eggs": "eggs",
    "chicken": "chicken breast",
    "chicken breast": "chicken breast",
    "confectioners' sugar": "powdered sugar",
    "powdered sugar": "sugar",
    "10x sugar": "sugar",
    "margerines": "margarine",
    "noodles": "noodles",
    "cloves": "",
    None: "",
}


def test_normalize_item(apply):
    assert apply(items.normalize_item, list(GOLDEN)) == list(GOLDEN.values())


def test_singularize(apply):
    words = "berries tomatoes onions apples olives radishes molasses glass asparagus gas is".split()
    want = "berry tomato onion appl olif radishe molasse glass asparagus ga is".split()
    assert apply(items.singularize, words) == want


def test_strip_quantities(apply):
    texts = ["2 1/2 cups", "2½ c", "x2", "2 ½", "1.5", "3 / 4 c"]
    assert apply(items.strip_quantities, texts) == ["  cups", "2½ c", "x2", " ", "", " c"]


def test_has_quantity(apply):
    assert apply(items.has_quantity, ["2 x", "cup", "cupx", "½", "a½", ""]) == [
        True, True, False, True, False, False,
    ]


def test_rewrites(apply):
    got = apply(
        items.rewrite_rules,
        ["Butter margarine", "vinegar  lemon juice", "White Lily flour", "creme de cocoa",
         "e tract", "Low  fat mi", "flounder pollack fillet", "white velveeta lily x"],
    )
    assert got == [
        "Butter or margarine", "vinegar or lemon juice", " flour", "creme de cacao",
        "extract", "lowfat mix", "flounder or pollack fillet", "x",
    ]


def test_guard_changes_nothing(apply):
    """The shortcut for texts without any rule word gives what the rules themselves give."""
    words = sorted(
        {w for t in rules.BRANDS for w in t.replace("[’']?s?", "'s").replace("(?:cker)?", "cker").split()}
        | {w for pair in rules.STUCK_PAIRS for t in pair for w in t.split()}
        | {"e", "tract", "etract", "creme", "de", "pcz", "mi", "MI", "low", "fat", "lowfat", "jello",
           "ſmucker", "mılk", "K", "plain"}
    )
    texts = [" ".join(p) for p in itertools.permutations(words, 2)]
    texts += [f"{a} {b} {c}" for a, b, c in zip(words, words[1:], words[2:])]
    assert apply(items.rewrite_rules, texts) == apply(items.rewrite_always, texts)


def test_not_idempotent(apply):
    once = apply(items.normalize_item, ["confectioners' sugar"])
    assert apply(items.normalize_item, once) == ["sugar"]


@pytest.mark.parametrize("name", ["SPELLING", "ALIASES"])
def test_dictionaries(apply, name):
    table = getattr(rules, name)
    got = apply(items.preferred_name, list(table))
    assert got == [rules.ALIASES.get(rules.SPELLING.get(k, k), rules.SPELLING.get(k, k)) for k in table]


def test_plain_words_take_all_steps_at_once(apply):
    """Every word of every rule, its plurals, with signs at its ends: as by all steps."""
    listed = [*rules.UNITS, *rules.DESCRIPTORS, *rules.PHRASES, *rules.BRANDS, *rules.SPELLING, *rules.ALIASES]
    listed += [t for pair in [*rules.STUCK_PAIRS, *rules.MISREADINGS] for t in pair]
    words = {w for t in listed for w in re.findall(r"[^\W\d_]+", t)} | set(listed) | set(items._NAMED)
    words |= {"berry", "glass", "us", "s", "es", "öl", "große", "naïves", "10x", "½", "a b", "ſugar", "pık", "Kelvin"}
    words = {v for w in words for v in (w, w + "s", w + "es", w[:-1] + "ies", w[:-1] + "ves")}
    shapes = ["{}", "{}.", "*{}", "{}%%%", "'{}'", "{}.%", "%{}.", "({})", "{}/", "{}-", "{}\n{}", "& {}", "&", "%", "", " "]
    texts = sorted({s.format(w, w) for w in words for s in shapes})
    texts += [t.upper() for t in texts]
    slow = apply(lambda c: items.normalize_always(F.lower(c)), texts)
    assert apply(items.normalize_item, texts) == slow
    number, unit = items._NUMBER, items._UNIT
    quantity = lambda c: matches(c, number) | matches(c, unit, ignore_case=True)
    assert apply(items.has_quantity, texts) == apply(quantity, texts)
    rewritten = apply(items.rewrite_always, texts)
    plain = apply(items.is_plain, texts)
    assert sum(plain) > len(texts) / 3
    assert all(not p or (r == t and not re.search(r"\s|[|/()]", t.strip())) for t, r, p in zip(texts, rewritten, plain))


def test_plain_words_need_no_pattern(spark):
    """A pass over plain words must cost little beside all steps."""
    rows = spark.range(200_000).select(F.concat(F.lit("wo"), F.translate(F.col("id").cast("string"), "0123456789", "abcdefghij")).alias("w"))
    rows = rows.coalesce(1).cache()

    def seconds(fn) -> float:
        times = []
        for _ in range(2):
            start = time.time()
            rows.select(fn(F.col("w"))).write.format("noop").mode("overwrite").save()
            times.append(time.time() - start)
        return min(times)

    assert seconds(items.normalize_item) < 0.7 * seconds(items.normalize_always)
