"""Components against all pairs, and the work that a passage common to many documents causes."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import jaccard


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def shingles(text, n):
    w = words_of(text)
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


def brute(rows, n, part):
    """{doc_id: (n_shingles, component_id)} by comparing all pairs that share a shingle."""
    sets = {i: shingles(t, n) for i, t in rows}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    holders = {}
    for i, s in sets.items():
        for x in s:
            holders.setdefault(x, []).append(i)
    pairs = {(a, b) for h in holders.values() for k, a in enumerate(h) for b in h[k + 1 :]}
    for a, b in pairs:
        both = len(sets[a] & sets[b])
        if 100 * both >= part * (len(sets[a]) + len(sets[b]) - both):
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), root(i)) for i in sets}


def found(docs, n, part):
    rows = jaccard.jaccard_components(docs, n=n, part=part).collect()
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows}


@pytest.mark.parametrize("n, part", [(3, 90), (5, 80)])
def test_table_equals_all_pairs(spark, n, part):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    assert found(docs.repartition(3), n, part) == brute([tuple(r) for r in docs.collect()], n, part)


@pytest.mark.parametrize("block", [3, 200])
@pytest.mark.parametrize("n, part", [(3, 90), (5, 80)])
def test_planted_families_equal_all_pairs(spark, monkeypatch, block, n, part):
    """Near copies of every degree, a passage that many share, short texts, words in capitals."""
    monkeypatch.setattr(jaccard, "BLOCK", block)
    rng = random.Random(n)
    word = lambda: rng.choice("abcdefgh") + str(rng.randrange(400))
    passage = [word() for _ in range(40)]
    rows = []
    for _ in range(12):
        base = [word() for _ in range(rng.choice([4, 20, 60, 90]))]
        for _ in range(6):
            copy = list(base)
            for _ in range(rng.randrange(0, 5)):
                copy[rng.randrange(len(copy))] = word()
            if rng.random() < 0.5:
                at = rng.randrange(len(copy))
                copy[at:at] = passage
            rows.append((len(rows), " ".join(w.upper() if rng.random() < 0.1 else w for w in copy)))
    rows += [(len(rows) + i, " ".join(passage + [word() for _ in range(30)])) for i in range(30)]
    rows += [(len(rows), "a"), (len(rows) + 1, "A "), (len(rows) + 2, "a b"), (len(rows) + 3, "\n"), (len(rows) + 4, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    assert found(docs, n, part) == brute(rows, n, part)


@pytest.mark.parametrize("n, part", [(3, 90), (5, 80)])
def test_a_common_passage_costs_no_pairs(spark, monkeypatch, n, part):
    """Documents of 90 words that share 50: pairs compared in families grow no faster than documents."""
    compared = []
    join = jaccard._join_families

    def counted(members, *rest):
        sizes = members.groupBy("pivot").agg(F.count("*").alias("n"))
        compared.append(sizes.agg(F.sum(F.col("n") * (F.col("n") - 1) / 2)).first()[0] or 0)
        return join(members, *rest)

    monkeypatch.setattr(jaccard, "_join_families", counted)
    monkeypatch.setattr(jaccard, "BLOCK", 20)
    rng = random.Random(1)
    passage = " ".join(f"p{i}" for i in range(50))
    for size in (1000, 4000):
        rows = [(i, f"{passage} {' '.join(f'w{rng.randrange(10**9)}' for _ in range(40))}") for i in range(size)]
        got = found(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4), n, part)
        assert all(c == i for i, (_, c) in got.items())
    assert compared[0] <= 10 * 1000 and compared[1] <= 10 * 4000


def test_exact_sets_for_any_width():
    texts = ["a b c d e f", "A b c d  e f", "b c d e f", "a b", "a b ", "b a", "", "f e d c b a f e d c b a"]
    for n in (1, 2, 3, 5, 9):
        sets = jaccard.exact_sets(texts, n)
        for x, s in zip(texts, sets):
            for y, r in zip(texts, sets):
                assert len({*s.tolist()} & {*r.tolist()}) == len(shingles(x, n) & shingles(y, n))


def test_parities_never_tell_linked_sets_apart():
    """Bits differ in no more places than sets in elements, whatever the sizes; strangers differ in many."""
    rng = np.random.default_rng(5)
    pool = rng.integers(0, 2**63, 200_000, dtype=np.uint64)
    for size in (1, 7, 63, 64, 65, 400, 3000, 70_000):
        for gone, new in ((0, 0), (0, 1), (size // 10, size // 9), (size // 2, 2 * size), (size, size)):
            a = np.unique(rng.choice(pool, size, replace=False))
            fresh = rng.integers(2**63, 2**64, new, dtype=np.uint64)
            b = np.unique(np.concatenate([rng.permutation(a)[gone:], fresh]))
            x, y = jaccard.parities(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)])).to_pylist()
            apart = len(np.setxor1d(a, b))
            least = jaccard.at_least_apart(x, y)
            assert least == jaccard.at_least_apart(y, x) <= apart
            if gone == new == size and 64 <= size <= 3000:
                assert least > jaccard.Threshold(80, 100).distance(2 * size)


@pytest.mark.parametrize("n, part", [(3, 90), (5, 80)])
def test_texts_move_once_and_only_where_a_link_is_open(spark, monkeypatch, n, part):
    """300 copies of one text, each changed at 12 places of 100, share rare shingles in twenties and are not
    linked; neither they nor strangers are sent to blocks with their texts, and two linked ones are found."""
    made = []
    keep = jaccard.materialize
    monkeypatch.setattr(jaccard, "materialize", lambda df, name: made.append((name, keep(df, name))) or made[-1][1])
    monkeypatch.setattr(jaccard, "BLOCK", 20)
    rng = random.Random(3)
    base = [f"w{rng.randrange(10**9)}" for _ in range(100)]
    rows = []
    for i in range(300):
        places = set(rng.sample(range(100), 12))
        rows.append((i, " ".join(f"x{k}" if k in places else w for k, w in enumerate(base))))
    rows += [(300 + i, " ".join(f"v{rng.randrange(10**9)}" for _ in range(100))) for i in range(100)]
    rows.append((400, rows[7][1] + " end"))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    assert found(docs, n, part) == brute(rows, n, part)
    counts = {name: df.count() for name, df in made}
    assert counts["families"] <= 100 and counts.get("met-texts", 401) < 350
    assert [name for name, _ in made].count("met-texts") == 1


def made_rows(monkeypatch):
    """{name: rows} of the tables that are written from now on."""
    made, keep = {}, jaccard.materialize

    def counted(df, name):
        out = keep(df, name)
        made[name] = made.get(name, 0) + out.count()
        return out

    monkeypatch.setattr(jaccard, "materialize", counted)
    return made


def test_large_family_is_joined_through_its_last_member(spark, monkeypatch):
    """Copies with 3 of 150 words changed are linked with their source alone, which is the last row; the work
    on families grows no faster than the copies."""
    monkeypatch.setattr(jaccard, "BLOCK", 20)
    made = made_rows(monkeypatch)
    rng = random.Random(8)
    base = [f"w{i}" for i in range(150)]
    work = []
    for size in (150, 600):
        rows = []
        for i in range(size):
            copy = list(base)
            for k, at in enumerate(rng.sample(range(150), 3)):
                copy[at] = f"x{i}-{k}"
            rows.append((i, " ".join(copy)))
        rows.append((size, " ".join(base)))
        made.clear()
        got = found(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(2, "doc_id"), 5, 80)
        assert {c for _, c in got.values()} == {0}
        work.append(sum(made.get(k, 0) for k in ("met-families", "sized-families", "cut-families", "families")) / size)
    assert work[1] <= 1.5 * work[0]


@pytest.mark.parametrize("n, part", [(3, 90), (5, 80)])
def test_large_families_of_many_components_equal_all_pairs(spark, monkeypatch, n, part):
    """Copies of an absent source, with few edits out of a common pool: links are chains; families are taken
    apart by rare shingles, their parts compared in blocks."""
    monkeypatch.setattr(jaccard, "BLOCK", 4)
    made = made_rows(monkeypatch)
    rng = random.Random(n)
    base = [f"w{i}" for i in range(110)]
    rows = []
    for i in range(160):
        copy = list(base)
        for _ in range(rng.randrange(1, 6)):
            copy[rng.randrange(110)] = f"x{rng.randrange(25)}"
        rows.append((i, " ".join(copy)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    want = brute(rows, n, part)
    assert found(docs, n, part) == want and len({c for _, c in want.values()}) > 1
    assert made["large-families"] and made["cut-families"] and made["families"]


def test_open_pairs_are_those_that_parities_leave_open():
    t, rng = jaccard.Threshold(80, 100), np.random.default_rng(3)
    pool = rng.integers(0, 2**63, 3000, dtype=np.uint64)
    sets = []
    for size in (50, 60, 62, 66, 70, 130, 1100):
        for edits in range(12):
            own = np.concatenate([pool[edits:size], rng.integers(2**63, 2**64, 2 * edits, dtype=np.uint64)])
            sets.append(np.unique(own))
    sizes = np.array([len(x) for x in sets])
    bits = jaccard.parities(np.concatenate(sets), np.concatenate([[0], np.cumsum(sizes)])).to_pylist()
    label = rng.integers(0, 3, len(sets))
    block = np.arange(len(sets)) % 2
    for b in (None, block):
        want = [
            any(
                label[i] != label[j]
                and (b is None or b[i] != b[j])
                and jaccard._may_link(t, int(sizes[i]), bits[i], int(sizes[j]), bits[j])
                for j in range(len(sets))
            )
            for i in range(len(sets))
        ]
        assert jaccard._open_pairs(label, sizes, bits, b, t).tolist() == want and 0 < sum(want) < len(want)


def test_blocks_bring_every_two_labels_together(spark):
    """Once in one pair of blocks; nodes of the main label are not sent to one another."""
    rows = [(1, i, 0 if i % 10 else i) for i in range(300)] + [(2, i, i) for i in range(45)] + [(3, i, i % 2) for i in range(9)]
    members = spark.createDataFrame(rows, "pivot bigint, node bigint, label bigint")
    sized = members.join(jaccard._work(members), "pivot")
    sent = jaccard._dealt(sized, F.lit(20)).select("pivot", "lo", "hi", "node", "label", "x").collect()
    met, groups = {}, {}
    for p, lo, hi, *row in sent:
        groups.setdefault((p, lo, hi), []).append(row)
    for (p, lo, hi), g in groups.items():
        for a, la, xa in g:
            for b, lb, xb in g:
                if a < b and la != lb and (lo == hi or xa != xb):
                    met[p, a, b] = met.get((p, a, b), 0) + 1
    by = {p: [r[1:] for r in rows if r[0] == p] for p in (1, 2, 3)}
    assert met == {(p, a, b): 1 for p, f in by.items() for a, x in f for b, y in f if a < b and x != y}
    assert sum(r[0] == 1 for r in sent) <= 300 * 4 and sum(r[0] == 3 for r in sent) == 9
