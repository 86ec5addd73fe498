"""Exact Jaccard join of word shingles: partition the universe, use the pigeonhole, verify.

Two sets of sizes a and b with Jaccard t = p / q or more differ in at most (q - p)(a + b) / (q + p)
elements, H. Sets are put into bands of like size; for a band the universe of shingles is hashed
into segments, and a set falls into one subset a segment. A segment has credit 1 (two sets agree on it) or
2 (their subsets differ by one element at most: each set also gives every subset with one element
deleted). If the credits add up to H + 1, two linked sets must meet in some segment. How many
segments of a band get credit 2, with fewer and larger segments in all, is decided by cost.

A band of larger sets has credit 1 alone and some more segments. A set with more filled segments than
elements in which a linked one may differ leaves its empty ones out: the other agrees in a filled one.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.llm.components import components
from millrace.llm.texts import ID, TEXT, gather, id_text, id_type, running, small, text_array
from millrace.sources.shared import materialize

WIDTH = 1.37  # of a band: largest size over smallest, about three times 1 / 0.9
CANDIDATE_COST = 1.0  # of a set met by chance, in signatures
BLOCK = 200  # nodes of a family's block
WIDE = 5  # blocks of nodes that are compared by parities at once
GROUP_WORDS = 1_500_000  # words of the texts that one verifying group holds
BITS = 1 << 6, 1 << 15  # least and most bits of a set's parities
HASHES = ["h1", "h2"]  # of a text; with the id they tell rows apart
MIX = np.array([0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB], np.uint64)


# ---- sets ---------------------------------------------------------------------------------------


def text_hashes(text: Column) -> list[Column]:
    """Two independent hashes of a text."""
    return [F.xxhash64(text).alias("h1"), F.xxhash64(F.lit(1), text).alias("h2")]


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit numbers; different ones stay different."""
    x = (x ^ (x >> np.uint64(30))) * MIX[1]
    x = (x ^ (x >> np.uint64(27))) * MIX[2]
    return x ^ (x >> np.uint64(31))


def _times(band: int, k: int) -> np.ndarray:
    """A constant for each band."""
    return np.array([band + 1], np.uint64) * MIX[k]


def shingle_sets(texts: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, offsets): the distinct n-word shingles of each text, sorted, as 64-bit hashes.

    A-Z count as a-z; words end at ASCII blanks. A text of fewer words has one shingle, all of them.
    """
    split = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    words = split.flatten().dictionary_encode()
    values = words.dictionary.to_numpy(zero_copy_only=False)
    digest = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in values), np.uint64, len(values))
    empty = np.fromiter((w == "" for w in values), bool, len(values))
    which = words.indices.to_numpy()
    full = ~empty[which]
    bounds = running(full.astype(np.int64))[split.offsets.to_numpy() - split.offsets[0].as_py()]
    h = digest[which[full]]
    counts = np.diff(bounds)
    sets, sizes = [], np.zeros(len(counts), np.int64)
    for i, (a, b) in enumerate(zip(bounds[:-1], bounds[1:])):
        width = min(n, b - a)
        if not width:
            continue
        x = np.full(b - a - width + 1, width, np.uint64)
        for k in range(width):
            x = mix(x * MIX[0] + h[a + k : b - width + 1 + k])
        own = np.unique(x)
        sets.append(own)
        sizes[i] = len(own)
    return (np.concatenate(sets) if sets else np.zeros(0, np.uint64)), running(sizes)


# ---- bands, and what a band's segments get --------------------------------------------------------


@dataclass(frozen=True)
class Threshold:
    """Jaccard of at least ``part / whole``, in whole numbers."""

    part: int = 90
    whole: int = 100

    def links(self, both: int, a: int, b: int) -> bool:
        return self.whole * both >= self.part * (a + b - both)

    def distance(self, total: int) -> int:
        """Largest symmetric difference of linked sets with ``total`` elements together."""
        return total * (self.whole - self.part) // (self.whole + self.part)

    def differ(self, size: int) -> int:
        """Largest symmetric difference of a set of ``size`` and a linked one."""
        return size * (self.whole - self.part) // self.part

    def partner(self, size: int) -> int:
        """Largest size of a linked set."""
        return size * self.whole // self.part


def bands(largest: int) -> list[int]:
    """Largest sizes of the bands, up to one that holds ``largest``."""
    tops = [9]
    while tops[-1] < largest:
        tops.append(max(tops[-1] + 1, int(tops[-1] * WIDTH)))
    return tops


def allocate(distance: int, size: int, sets: int) -> tuple[int, int]:
    """(segments, how many of them get credit 2) with the least cost for one set of ``size``.

    Credits add up to ``distance + 1``. A segment of expected size s costs one signature, and s more
    with credit 2; by chance a set meets about exp(-s) of the band's ``sets`` in a segment, so fewer
    and larger segments find fewer strangers.
    """
    best, least = (distance + 1, 0), math.inf
    for double in range(0, (distance + 1) // 2 + 1):
        segments = distance + 1 - double
        s = size / segments
        cost = segments + double * s + CANDIDATE_COST * segments * sets * math.exp(-s)
        if cost < least:
            best, least = (segments, double), cost
    return best


def plain_segments(distance: int, smallest: int, top: int, t: Threshold) -> int:
    """The least number of segments, over ``distance``, of which sets of a band fill enough to leave
    out empty ones, but for three deviations; 0 if there is none."""
    for m in range(distance + 1, top + 1):
        for n in (smallest, top):
            x = n / m
            sd = math.sqrt(max(0.0, m * math.exp(-x) * (1 - (1 + x) * math.exp(-x))))
            if m * (1 - math.exp(-x)) - 3 * sd < min(distance, t.differ(n)) + 1:
                break
        else:
            return m
    return 0


def signatures(
    hashes: np.ndarray, offsets: np.ndarray, band: int, segments: int, double: int, need: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """(signatures, set of each) of sets under one band's scheme.

    A subset's signature is the sum of its scrambled elements, scrambled with band and segment, so
    that a deletion is one subtraction. The first ``double`` segments also give deletions. A set that
    fills ``need`` segments or more gives no signature for empty ones.
    """
    n = len(offsets) - 1
    owner = np.repeat(np.arange(n), np.diff(offsets))
    segment = (mix(hashes + _times(band, 0)) % np.uint64(segments)).astype(np.int64)
    value = mix(hashes ^ MIX[1])
    cell = owner * segments + segment
    sums = np.zeros(n * segments, np.uint64)
    np.add.at(sums, cell, value)
    salt = mix(np.arange(segments, dtype=np.uint64) + _times(band, 2))
    out = [mix(sums + np.tile(salt, n))]
    of = [np.repeat(np.arange(n), segments)]
    if need is not None:
        full = np.bincount(cell, minlength=n * segments) > 0
        full |= np.repeat(full.reshape(n, segments).sum(axis=1) < need, segments)
        out, of = [out[0][full]], [of[0][full]]
    if double:
        some = segment < double
        out.append(mix(sums[cell[some]] - value[some] + salt[segment[some]]))
        of.append(owner[some])
    return np.concatenate(out), np.concatenate(of)


# ---- parities: what tells most strangers apart without their texts ----------------------------------


def parities(hashes: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """For every set the parities of how many elements fall on each of 2^k bits, about one an element.

    Two sets' parities differ in no more bits than the sets in elements, so bits tell strangers apart
    and lose no link. Halves laid over one another are the parities on half as many bits.
    """
    sizes = np.diff(offsets)
    room = np.clip(1 << np.ceil(np.log2(np.maximum(sizes, 1))).astype(np.int64), *BITS)
    starts = running(room)
    place = (mix(hashes ^ MIX[2]) & np.repeat(room - 1, sizes).astype(np.uint64)).astype(np.int64)
    odd = np.bincount(place + np.repeat(starts[:-1], sizes), minlength=int(starts[-1])) & 1
    data = np.packbits(odd.astype(np.uint8), bitorder="little")
    return pa.Array.from_buffers(
        pa.binary(), len(sizes), [None, pa.py_buffer((starts // 8).astype(np.int32)), pa.py_buffer(data)]
    )


def at_least_apart(x: bytes, y: bytes) -> int:
    """A number of elements in which the sets with these parities differ at least."""
    if len(x) < len(y):
        x, y = y, x
    a, m = int.from_bytes(x, "little"), 8 * len(x)
    while m > 8 * len(y):
        m //= 2
        a = (a >> m) ^ (a & ((1 << m) - 1))
    return (a ^ int.from_bytes(y, "little")).bit_count()


def _may_link(t: Threshold, a: int, x: bytes, b: int, y: bytes) -> bool:
    """Whether sizes and parities leave it open that two sets are linked."""
    most = t.distance(a + b)
    return abs(a - b) <= most and at_least_apart(x, y) <= most


def _folded(bits: list[bytes]) -> tuple[np.ndarray, dict[int, np.ndarray]]:
    """(bytes of each, {bytes: rows of numbers}): for each length all parities that have as much, laid over
    one another to that length; shorter ones are zeros."""
    lengths = np.array([len(x) for x in bits])
    out, at, rows = {}, 0, np.zeros(0)
    for size in sorted(set(lengths.tolist()), reverse=True):
        while at > size:
            at //= 2
            rows = rows[:, : rows.shape[1] // 2] ^ rows[:, rows.shape[1] // 2 :]
        if not at:
            rows = np.zeros((len(bits), size // 8), np.uint64)
        at = size
        own = lengths == size
        rows[own] = np.frombuffer(b"".join(x for x in bits if len(x) == size), np.uint64).reshape(-1, size // 8)
        out[size] = rows.copy()
    return lengths, out


def _open_pairs(label: np.ndarray, sizes: np.ndarray, bits: list[bytes], block: np.ndarray | None, t: Threshold) -> np.ndarray:
    """Which sets may link with one of another label (and block, if given)."""
    lengths, folded = _folded(bits)
    keep = np.zeros(len(label), bool)
    most = 2 * int(sizes.max(initial=0))
    most = np.array([t.distance(x) for x in range(most + 1)])
    classes = [(np.flatnonzero(lengths == size), size) for size in folded]
    main = np.unique(label, return_inverse=True)[1]
    main = main == np.bincount(main).argmax()
    for i in np.flatnonzero(~main):  # of two of different labels one is not of the main one
        far = most[sizes[i] + sizes]
        may = (label != label[i]) & (np.abs(sizes - sizes[i]) <= far)
        if block is not None:
            may &= block != block[i]
        for these, size in classes:
            these = these[may[these]]
            rows = folded[min(size, lengths[i])]
            apart = np.bitwise_count(rows[these] ^ rows[i]).sum(axis=1)
            may[these] = apart <= far[these]
        if may.any():
            keep[i] = True
            keep |= may
    return keep


def _work(members: DataFrame, *more: Column) -> DataFrame:
    """(pivot, n, main, rest) of families (pivot, node, label): nodes, the label that most of them have, and
    nodes of other labels."""
    counts = members.groupBy("pivot", "label").agg(F.count("*").alias("n"), *more)
    sums = [F.sum(c).alias(c) for c in counts.columns if c not in ("pivot", "label", "n")]
    return counts.groupBy("pivot").agg(
        F.sum("n").alias("n"), F.max_by("label", F.struct("n", "label")).alias("main"), *sums,
        (F.sum("n") - F.max("n")).alias("rest"), F.count("*").alias("labels"),
    )


def _dealt(members: DataFrame, size: Column) -> DataFrame:
    """``members`` with (x, lo, hi): families of ``n`` nodes, ``rest`` of them not of the label ``main``, in
    blocks of ``size`` nodes at most; ``x`` is a node's block, (lo, hi) two blocks that meet.

    Nodes of the main label are linked already and never meet one another. So a family of which all but
    a few are one component is sent about twice, not once for each of its blocks.
    """
    whole = F.col("n") <= size
    parts = F.greatest(F.lit(1), F.ceil(F.when(whole, F.lit(1)).otherwise(F.col("rest") / size))).cast("bigint")
    more = F.when(whole, F.lit(0)).otherwise(F.ceil((F.col("n") - F.col("rest")) / size)).cast("bigint")
    linked = ~whole & (F.col("label") == F.col("main"))
    cut = members.withColumn("parts", parts).withColumn("more", more).withColumn("linked", linked)
    hashed = F.xxhash64("node")
    x = F.when(F.col("linked"), F.col("parts") + F.pmod(hashed, F.greatest("more", F.lit(1)))).otherwise(F.pmod(hashed, F.col("parts")))
    meets = F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1 + F.when(F.col("linked"), 0).otherwise(F.col("more")))
    sent = cut.withColumn("x", x).select(*members.columns, "x", F.explode(meets).alias("y"))
    return sent.select(*members.columns, "x", F.least("x", "y").alias("lo"), F.greatest("x", "y").alias("hi"))


def _small_open(sized: DataFrame, t: Threshold) -> DataFrame:
    """(pivot, node, label, near): the members of families up to ``BLOCK`` that may link with one of another
    label. ``near`` says whether the pivot may be that one."""
    columns = ["pivot", "node", "label", "n_shingles", "bits"]

    def of_family(pivot: int, rows: list[tuple]) -> list[tuple]:
        keep, near = [False] * len(rows), [False] * len(rows)
        for i, (node, label, size, own) in enumerate(rows):
            for j in range(i):
                other = rows[j]
                if label == other[1] or (keep[i] and keep[j] and pivot not in (node, other[0])):
                    continue
                if _may_link(t, size, own, other[2], other[3]):
                    keep[i] = keep[j] = True
                    near[i] |= other[0] == pivot
                    near[j] |= node == pivot
        return [(pivot, r[0], r[1], x) for r, k, x in zip(rows, keep, near) if k]

    def small_ones(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows = None, []
        made = lambda found: pa.RecordBatch.from_arrays(
            [pa.array([f[k] for f in found], kind) for k, kind in enumerate([pa.int64()] * 3 + [pa.bool_()])],
            names=["pivot", "node", "label", "near"],
        )
        for batch in batches:
            found = []
            for pivot, *row in zip(*[batch.column(c).to_pylist() for c in columns]):
                if pivot != key:
                    found += of_family(key, rows)
                    key, rows = pivot, []
                rows.append(tuple(row))
            yield made(found)
        yield made(of_family(key, rows))

    return sized.select(*columns).repartition("pivot").sortWithinPartitions("pivot", "node").mapInArrow(
        small_ones, "pivot bigint, node bigint, label bigint, near boolean"
    )


def _near_members(families: DataFrame, nodes: DataFrame, t: Threshold) -> DataFrame:
    """(pivot, node, label, near): the members of families (pivot, node) that may link with another one,
    and whether with the pivot. In families above ``BLOCK`` all members stay."""
    sizes = families.groupBy("pivot").agg(F.count("*").alias("n"))
    bits = nodes.select("node", "n_shingles", "bits")
    families = families.withColumn("label", F.col("node"))
    few = families.join(sizes.where(F.col("n") <= BLOCK), "pivot").join(bits, "node")

    @F.pandas_udf("boolean")
    def near(a: pd.Series, x: pd.Series, b: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([_may_link(t, *p) for p in zip(a, x, b, y)], dtype=bool)

    heads = sizes.where(F.col("n") > BLOCK).join(bits.toDF("pivot", "b", "y"), "pivot")
    many = families.join(heads, "pivot").join(bits, "node")
    many = many.select("pivot", "node", "label", near("n_shingles", "bits", "b", "y") & (F.col("node") != F.col("pivot")))
    return _small_open(few, t).union(many)


def _open_members(members: DataFrame, nodes: DataFrame, t: Threshold) -> DataFrame:
    """(pivot, node, label): the members of families (pivot, node, label, n, main, rest) that may link with
    one of another label. The pivot only names a family; it need not be a node."""
    sized = members.join(nodes.select("node", "n_shingles", "bits"), "node")
    few = _small_open(sized.where(F.col("n") <= BLOCK), t).drop("near")
    many = _dealt(sized.where(F.col("n") > BLOCK), F.lit(WIDE * BLOCK))

    def of_blocks(rows: pd.DataFrame) -> pd.DataFrame:
        block = rows["x"].to_numpy() if rows["lo"].iloc[0] != rows["hi"].iloc[0] else None
        keep = _open_pairs(rows["label"].to_numpy(), rows["n_shingles"].to_numpy(), list(rows["bits"]), block, t)
        return rows.loc[keep, ["pivot", "node", "label"]]

    kept = many.groupBy("pivot", "lo", "hi").applyInPandas(of_blocks, "pivot bigint, node bigint, label bigint")
    return few.union(kept.distinct())


# ---- the join -------------------------------------------------------------------------------------


def _sets(rows: DataFrame, n: int, tops: list[int], schemes: list[tuple[int, int]], t: Threshold) -> DataFrame:
    """(row, doc_id, h1, h2, n_shingles, k1, k2, bits, sigs): ``row`` numbers the rows, (k1, k2) is a digest
    of the set, ``bits`` are its parities. Of equal sets in one task only the first has signatures."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        row, seen = TaskContext.get().partitionId() << 33, set()
        for batch in small(batches):
            hashes, offsets = shingle_sets(text_array(batch.column(TEXT)), n)
            sizes = np.diff(offsets)
            keys = np.zeros((len(sizes), 2), np.int64)
            fresh = np.zeros(len(sizes), bool)
            for i in np.flatnonzero(sizes):
                key = xxhash.xxh3_128_digest(hashes[offsets[i] : offsets[i + 1]].tobytes())
                keys[i] = np.frombuffer(key, np.int64)
                fresh[i] = key not in seen
                seen.add(key)
            sigs, of = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
            own = np.searchsorted(tops, sizes)
            for band, (segments, double) in enumerate(schemes):
                if not segments:
                    continue
                # sets of this band, and those below it that a set of this band may link with
                reach = sizes * t.whole // t.part > tops[band - 1] if band else np.zeros(len(sizes), bool)
                chosen = np.flatnonzero(fresh & ((own == band) | ((own == band - 1) & reach)))
                if not len(chosen):
                    continue
                flat = hashes[gather(offsets[chosen], sizes[chosen])]
                need = None if double else np.minimum(t.distance(2 * tops[band]), t.differ(sizes[chosen])) + 1
                s, o = signatures(flat, running(sizes[chosen]), band, segments, double, need)
                sigs.append(s)
                of.append(chosen[o])
            sig, owner = np.concatenate(sigs), np.concatenate(of)
            order = np.argsort(owner, kind="stable")
            lists = pa.ListArray.from_arrays(
                pa.array(running(np.bincount(owner, minlength=len(sizes))).astype(np.int32)),
                pa.array(sig[order].view(np.int64)),
            )
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.arange(row, row + len(sizes))),
                    *[batch.column(c) for c in (ID, *HASHES)],
                    pa.array(sizes),
                    pa.array(keys[:, 0]),
                    pa.array(keys[:, 1]),
                    parities(hashes, offsets),
                    lists,
                ],
                names=["row", ID, *HASHES, "n_shingles", "k1", "k2", "bits", "sigs"],
            )
            row += len(sizes)

    numbers = [*HASHES, "n_shingles", "k1", "k2"]
    schema = f"row bigint, {ID} {id_type(rows)}, {', '.join(f'{c} bigint' for c in numbers)}, bits binary, sigs array<bigint>"
    return rows.mapInArrow(run, schema)


def exact_sets(texts: list[str], n: int) -> list[np.ndarray]:
    """Distinct shingles of texts as numbers that are equal only for equal words.

    Shingles of one word more are numbered from those before, so the numbers stay small for any n.
    """
    number: dict[str, int] = {}
    words = [[number.setdefault(w, len(number)) for w in t.translate(_LOWER).split(" ") if w] for t in texts]
    sizes = np.array([len(w) for w in words], np.int64)
    flat, ends = np.array([x for w in words for x in w], np.int64), np.cumsum(sizes)
    stop = np.repeat(ends, sizes)
    at, ids = np.arange(len(flat)), flat
    for k in range(1, n):
        longer = at + k < stop[at]
        at = at[longer]
        ids = np.unique(ids[longer] * max(len(number), 1) + flat[at + k], return_inverse=True)[1].astype(np.int64)
    cuts = np.searchsorted(at, np.append(ends - sizes, len(flat)))
    short: dict[tuple, int] = {}  # texts of fewer words have one shingle, numbered behind the others
    first = int(ids.max(initial=-1)) + 1
    out = []
    for i, w in enumerate(words):
        if 0 < len(w) < n:
            out.append(np.array([first + short.setdefault(tuple(w), len(short))], np.int64))
        else:
            out.append(np.unique(ids[cuts[i] : cuts[i + 1]]))
    return out


_LOWER = {c: chr(c + 32) for c in range(65, 91)} | {c: " " for c in range(9, 14)}


def _texts(met: DataFrame, nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """(node, text) for the nodes of ``met``; rows of one id are told apart by hashes.

    The table's texts are moved here once. What follows reads only those that some other set may link with.
    """
    ids = nodes.join(met.select("node").distinct(), "node").select(F.col(ID).alias("id"), *HASHES, "node")
    rows = id_text(docs).select(ID, TEXT, *text_hashes(F.col(TEXT))).alias("d")
    same = [F.col(ID).eqNullSafe(F.col("id")), *[F.col(f"d.{h}") == F.col(f"n.{h}") for h in HASHES]]
    return materialize(rows.join(ids.alias("n"), same).select("node", TEXT), "met-texts")


def _numbered(rows: pd.DataFrame, n: int) -> tuple[dict[int, int], np.ndarray, np.ndarray]:
    """(place of each node, shingle numbers, offsets) of a group's texts."""
    rows = rows.drop_duplicates("node")  # rows with one id and text
    sets = exact_sets(list(rows[TEXT]), n)
    flat = np.unique(np.concatenate(sets), return_inverse=True)[1]
    return {v: i for i, v in enumerate(rows["node"])}, flat, running(np.array([len(x) for x in sets]))


def _verify_pairs(pairs: DataFrame, nodes: DataFrame, texts: DataFrame, n: int, t: Threshold) -> DataFrame:
    """Those of the pairs (a, b) whose texts' sets are linked; pairs of one b come in runs."""
    size = nodes.select(F.col("node").alias("a"), "n_shingles")
    total = pairs.join(size, "a").agg(F.sum("n_shingles")).first()[0]
    if not total:
        return pairs
    groups = int(-(-total // GROUP_WORDS)) * 2
    key = F.pmod(F.xxhash64("b", F.pmod(F.xxhash64("a"), F.lit(groups))), F.lit(groups)).cast("int")
    dealt = materialize(pairs.select("a", "b", key.alias("g")), "pairs")
    ends = F.explode(F.array("a", "b")).alias("node")
    texts = dealt.select(F.col("g").alias("group"), ends).distinct().join(texts, "node")

    def check(links: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        place, flat, at = _numbered(rows, n)
        sizes, keep = np.diff(at), np.zeros(len(links), bool)
        for i, (a, b) in enumerate(zip(links["a"].map(place), links["b"].map(place))):
            both = len(np.intersect1d(flat[at[a] : at[a + 1]], flat[at[b] : at[b + 1]], assume_unique=True))
            keep[i] = t.links(both, int(sizes[a]), int(sizes[b]))
        return links.loc[keep, ["a", "b"]]

    linked = dealt.groupBy("g").cogroup(texts.groupBy("group")).applyInPandas(check, "a bigint, b bigint")
    return materialize(linked, "linked")


def _by_rare_shingles(members: DataFrame, texts: DataFrame, n: int, t: Threshold) -> DataFrame:
    """Nodes (node, label) of large families taken apart: a family for each rare shingle, as far as needed.

    Two linked sets share a shingle among the ``size - ceil(size * part / whole) + 1`` first ones of
    each, in any one order of all shingles. Ordered from rare to frequent (among these sets), a passage
    that all share comes last and brings nobody together.
    """
    texts = members.select("node").join(texts, "node")

    def shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            hashes, offsets = shingle_sets(text_array(batch.column(TEXT)), n)
            sets = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(hashes.view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column("node"), sets], names=["node", "set"])

    sets = texts.select("node", TEXT).mapInArrow(shingles, "node bigint, set array<bigint>")
    sets = materialize(sets.dropDuplicates(["node"]), "family-shingles")
    items = sets.select("node", F.size("set").alias("size"), F.explode("set").alias("item"))
    counts = items.groupBy("item").agg(F.count("*").alias("n"))
    first = F.col("size") - F.ceil(F.col("size") * t.part / t.whole) + 1
    ranked = items.join(counts, "item").withColumn(
        "rank", F.row_number().over(W.partitionBy("node").orderBy("n", "item"))  # one set in a window
    )
    rare = ranked.where((F.col("rank") <= first) & (F.col("n") > 1)).select(F.col("item").alias("pivot"), "node")
    return materialize(rare.join(members, "node").select("pivot", "node", "label"), "rare-shingles")


def _join_families(
    members: DataFrame, nodes: DataFrame, texts: DataFrame, n: int, t: Threshold
) -> DataFrame:
    """Links across labels inside families (pivot, node, label), enough of them to connect what is linked.

    A family is dealt to blocks that meet two by two in one group, but for blocks of its main label: pairs
    are compared in the task, never made into rows. A group gives only links that join two of its parts,
    so its result is no larger than its members.
    """
    sized = members.join(nodes.select("node", "n_shingles"), "node")
    work = _work(sized, F.sum("n_shingles").alias("words"))
    size = F.least(F.lit(BLOCK), F.greatest(F.lit(1), F.floor(F.col("n") * GROUP_WORDS / (2 * F.col("words")))))
    sent = _dealt(sized.join(work, "pivot"), size)
    sent = materialize(sent.select("pivot", "node", "label", "n_shingles", "x", "lo", "hi"), "families")
    total = sent.agg(F.sum("n_shingles")).first()[0]
    if not total:
        return members.select(F.col("node").alias("a"), F.col("node").alias("b"))
    groups = int(-(-total // GROUP_WORDS)) * 2
    dealt = sent.withColumn("g", F.pmod(F.xxhash64("pivot", "lo", "hi"), F.lit(groups)).cast("int"))
    need = dealt.select(F.col("g").alias("group"), (F.col("node") + 0).alias("node")).distinct()
    texts = need.join(texts, "node")

    def check(families: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        place, flat, at = _numbered(rows, n)
        sizes, mark = np.diff(at), np.zeros(int(flat.max(initial=-1)) + 1, bool)
        links = []
        for (_, lo, hi), family in families.groupby(["pivot", "lo", "hi"], sort=False):
            node, label = family["node"].to_numpy(), family["label"].to_numpy().copy()
            block = family["x"].to_numpy()
            if (label == label[0]).all():
                continue
            own = np.array([place[v] for v in node])
            lengths = sizes[own]
            items = flat[gather(at[own], lengths)]
            starts = running(lengths)[:-1]
            for i in range(len(node)):
                mine = items[starts[i] : starts[i] + lengths[i]]
                mark[mine] = True
                both = np.add.reduceat(mark[items].astype(np.int64), starts)
                mark[mine] = False
                near = t.whole * both >= t.part * (lengths[i] + lengths - both)
                if lo != hi:
                    near &= block != block[i]
                for j in np.flatnonzero(near & (label != label[i])):
                    if label[j] != label[i]:
                        links.append((node[i], node[j]))
                        label[label == label[j]] = label[i]
        return pd.DataFrame(links, columns=["a", "b"], dtype="int64")

    linked = dealt.groupBy("g").cogroup(texts.groupBy("group")).applyInPandas(check, "a bigint, b bigint")
    return materialize(linked, "linked")


def jaccard_components(docs: DataFrame, n: int = 3, part: int = 90, whole: int = 100) -> DataFrame:
    """``doc_id, n_shingles, component_id``, one row per document.

    Two documents are linked if the sets of their n-word shingles have Jaccard ``part / whole`` or
    more. ``component_id`` is the smallest doc_id that links lead to. Equal sets are one node; only
    different ones are compared. Each member of a bucket of equal signatures is first verified against
    one that meets most others; then, in buckets that still hold several components, members of
    different ones, inside tasks. A bucket with more than ``WIDE * BLOCK`` members outside its main
    component, of a passage that many share for instance, is first taken apart by the rare shingles that
    linked sets must share. So a group of many near copies costs a pair a member where they are linked, documents with one common passage do
    not meet, no pairs of a group are made into rows, and no link is lost. Long texts are read whole.

    Null and empty texts, or texts without a word, have 0 shingles and are their own component, by
    their own id. Rows that share a doc_id are nodes of their own and each gives a row. A null id is
    never the smallest unless all are null. An empty table gives no rows; extra columns are not read.
    """
    light, parts = _parts(docs, n, Threshold(part, whole))
    named = parts.select("k1", "k2", "component_id")
    return light.join(named, ["k1", "k2"], "left").select(
        ID, "n_shingles", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col(ID)).alias("component_id")
    )


def first_rows(docs: DataFrame, n: int = 3, part: int = 90, whole: int = 100) -> DataFrame:
    """``id, h1, h2`` of one row for each component of texts with words: the least by id, then by
    the text's hashes. A null id comes last. Rows equal in all three are one."""
    parts = _parts(docs, n, Threshold(part, whole))[1]
    return parts.groupBy("label").agg(F.min("first").alias("first")).select("first.id", *[f"first.{h}" for h in HASHES])


def _parts(docs: DataFrame, n: int, t: Threshold) -> tuple[DataFrame, DataFrame]:
    """The rows (row, doc_id, n_shingles, k1, k2), and (k1, k2, label, first, component_id) of every set
    that is not empty; ``first`` is its least row."""
    rows = id_text(docs).select(ID, TEXT, *text_hashes(F.col(TEXT)))
    # how many sets a band has, from the numbers of words: enough to choose schemes by cost
    words = F.size(F.split(TEXT, r"[\x20\x09-\x0D]+"))
    level = F.floor(F.log(F.greatest(words, F.lit(1)).cast("double")) / F.log(F.lit(WIDTH))).cast("int")
    counts = {r["level"]: r["n"] for r in rows.groupBy(level.alias("level")).agg(F.count("*").alias("n")).collect()}
    largest = int(WIDTH ** (max(counts, default=0) + 1)) + 1
    tops = bands(largest)
    schemes = []
    for band, top in enumerate(tops):
        h = t.distance(2 * top)
        below = tops[band - 1] if band else 0
        near = range(int(math.log(below + 1) / math.log(WIDTH)) - 1, int(math.log(top) / math.log(WIDTH)) + 2)
        plain = plain_segments(h, (below + 1) * t.part // t.whole, top, t) if h else 0
        by_cost = allocate(h, (below + 1 + top) // 2, sum(counts.get(k, 0) for k in near)) if h else (0, 0)
        schemes.append((plain, 0) if plain else by_cost)

    sets = materialize(_sets(rows, n, tops, schemes, t), "shingle-sets")
    light = sets.select("row", ID, *HASHES, "n_shingles", "k1", "k2")
    filled = light.where("n_shingles > 0")
    classes = materialize(
        sets.where("n_shingles > 0").groupBy("k1", "k2").agg(
            F.min("row").alias("node"),
            *[F.min_by(c, "row").alias(c) for c in (ID, *HASHES, "bits")],
            F.min(F.struct(F.col(ID).isNull().alias("none"), F.col(ID).alias("id"), *HASHES)).alias("first"),
            F.min(ID).alias("least"),
            F.first("n_shingles").alias("n_shingles"),
        ),
        "classes",
    )
    node_of = filled.join(classes.select("k1", "k2", "node"), ["k1", "k2"]).select("row", "node")

    # buckets: (sig, node), signatures that at least two nodes have
    sigs = sets.select(F.explode("sigs").alias("sig"), "row")
    by_sig = W.partitionBy("sig")
    shared = sigs.withColumn("n", F.count("*").over(by_sig)).where("n > 1").select("sig", "row", "n")
    shared = materialize(shared, "shared-signatures")
    # the pivot of a bucket is the member that meets most others in all of its own: of near copies the one
    # that is like most, so that few pivots stand for many buckets (equal sets have equal weights)
    weights = node_of.join(shared.groupBy("row").agg(F.sum("n").alias("weight")), "row")
    buckets = shared.select("sig", "row").join(weights, "row").select("sig", "node", "weight").distinct()
    head = F.max_by("node", F.struct("weight", -F.col("node"))).alias("pivot")
    heads = buckets.groupBy("sig").agg(head, F.min("node").alias("lo"), F.max("node").alias("hi")).where("lo < hi")
    buckets = materialize(buckets.select("sig", "node").join(heads.select("sig", "pivot"), "sig"), "buckets")

    families = materialize(buckets.select("pivot", "node").distinct(), "met-families")
    met = materialize(_near_members(families, classes, t), "met-members")
    texts = _texts(met, classes, docs)

    # a node is first compared with the pivot that most nodes are near to
    near = met.where("near").select("pivot", "node")
    hubs = near.groupBy("pivot").agg(F.struct(F.count("*"), -F.col("pivot")).alias("hub"))
    first = near.join(hubs, "pivot").groupBy("node").agg(F.max_by("pivot", "hub").alias("b"))
    links = _verify_pairs(first.select(F.col("node").alias("a"), "b"), classes, texts, n, t)
    found = components(links)
    labelled = buckets.join(met.select("pivot", "node"), ["pivot", "node"]).join(found, "node", "left")
    labelled = labelled.withColumn("label", F.coalesce("label", "node"))
    mixed = labelled.groupBy("sig").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo < hi")
    members = labelled.join(mixed.select("sig"), "sig").select("pivot", "node", "label").distinct()
    members = materialize(members, "open-families")
    columns = ["pivot", "node", "label", "n", "main", "rest"]
    members = materialize(members.join(_work(members), "pivot").select(*columns), "sized-families")
    many = F.col("rest") > WIDE * BLOCK
    large = materialize(members.where(many).select("node", "label").distinct(), "large-families")
    if not large.isEmpty():
        cut = _by_rare_shingles(large, texts, n, t)
        cut = cut.join(_work(cut).where("labels > 1"), "pivot").select(*columns)
        members = materialize(members.where(~many).unionByName(cut), "cut-families")
    members = materialize(_open_members(members, classes, t), "open-members")
    links = links.union(_join_families(members, classes, texts, n, t))
    found = components(links)

    labelled = classes.join(found, "node", "left").select("k1", "k2", "least", "first", F.coalesce("label", "node").alias("label"))
    smallest = labelled.groupBy("label").agg(F.min("least").alias("component_id"))
    return light, labelled.join(smallest, "label")
