"""Product codes of vectors: a codebook for each part, nearest entries by equal-average search."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.sources.shared import materialize

VEC, VECTOR, LABEL = "vec_id", "embedding", "label"
SCALE = 256  # a component x counts as floor(SCALE * x)
_REACH = 1 << 29  # integer components times the width of a part stay below: squares then fit 64 bits
_SLICE = 1 << 20  # components a task works on at once


class EqualAverage:
    """Nearest entry of one codebook (entries x width, integers), ties to the lower index.

    Entries are sorted by component sum. A query starts where its own sum would stand and goes
    outward on both sides. By the Cauchy-Schwarz inequality an entry is at least gap^2 / width away,
    where gap is the difference of the sums: once that strictly exceeds the best distance so far, a
    side is closed. Equal distances are still looked at, so that the lower index wins.
    """

    def __init__(self, entries: np.ndarray):
        sums = entries.sum(axis=1)
        self.index = np.lexsort((np.arange(len(sums)), sums))
        self.sums, self.entries = sums[self.index], entries[self.index]

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index, squared distance) for every row of ``x``."""
        n, width = self.entries.shape
        sums = x.sum(axis=1)
        right = np.searchsorted(self.sums, sums)
        first = np.minimum(right, n - 1)
        best, at = self._distance(x, first), self.index[first]
        for step, side in ((1, right), (-1, right - 1)):
            self._expand(x, sums, side, step, best, at, width)
        return at, best

    def _distance(self, x: np.ndarray, places: np.ndarray) -> np.ndarray:
        gap = x - self.entries[places]
        return np.einsum("ij,ij->i", gap, gap)

    def _expand(self, x, sums, places, step, best, at, width) -> None:
        """Walk one side for all queries at once; those whose side is closed drop out."""
        rows = np.arange(len(x))
        while True:
            inside = (places >= 0) & (places < len(self.sums))
            rows, places = rows[inside], places[inside]
            gap = self.sums[places] - sums[rows]
            still = -(-(gap * gap) // width) <= best[rows]  # gap^2 / width <= best, in integers
            rows, places = rows[still], places[still]
            if not len(rows):
                return
            found, index = self._distance(x[rows], places), self.index[places]
            better = (found < best[rows]) | ((found == best[rows]) & (index < at[rows]))
            best[rows[better]], at[rows[better]] = found[better], index[better]
            places = places + step


def _in_order(rows: DataFrame) -> DataFrame:
    return rows.orderBy(F.col(VEC).asc_nulls_last(), VECTOR)


def usable(vectors: DataFrame, parts: int = 16) -> tuple[DataFrame, int]:
    """(rows with a vector that can be coded: ``vec_id, embedding, label``; its dimension).

    Left out are null vectors, vectors with a null, NaN or infinite component, vectors whose length
    is not that of the table (the length of the usable vector with the smallest id, a multiple of
    ``parts``), and vectors with a component so large that squared distances of a part would not fit
    64 bits (2^21 / width of a part). An empty table has dimension 0.
    """
    rows = vectors.select(*[F.col(f"`{c}`").alias(c) for c in (VEC, VECTOR, LABEL)])
    size = F.size(VECTOR)
    good = F.forall(VECTOR, lambda x: F.coalesce(F.abs(x) < F.lit(_REACH / SCALE) / (size / parts), F.lit(False)))
    # NaN is larger than any number in Spark's order, so it fails the comparison like infinity does
    rows = rows.where((size > 0) & (size % parts == 0) & good)
    first = _in_order(rows).limit(1).select(size.alias("n")).collect()
    dimension = first[0]["n"] if first else 0
    return rows.where(size == dimension), dimension


def _integers(column: pa.Array, dimension: int) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.floor(values * SCALE).astype(np.int64).reshape(-1, dimension)


def _assigned(batches: Iterator[pa.RecordBatch], books: np.ndarray):
    """(batch slice, integer vectors, entry of every part, distance of every part)."""
    parts, _, width = books.shape
    search = [EqualAverage(book) for book in books]
    step = max(1, _SLICE // (parts * width))
    for batch in batches:
        for start in range(0, batch.num_rows, step):
            piece = batch.slice(start, step)
            x = _integers(piece.column(VECTOR), parts * width).reshape(-1, parts, width)
            found = [search[p].nearest(np.ascontiguousarray(x[:, p])) for p in range(parts)]
            yield piece, x, np.stack([f[0] for f in found], 1), np.stack([f[1] for f in found], 1)


def _refined(rows: DataFrame, books: np.ndarray) -> np.ndarray:
    """Every entry replaced by the floor of the mean of its parts; unused entries stay.

    A task adds up its own parts, so at most parts x entries rows of each leave it, and as many reach
    the driver.
    """
    parts, entries, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((parts * entries, width), np.int64), np.zeros(parts * entries, np.int64)
        for _, x, at, _ in _assigned(batches, books):
            cell = (at + np.arange(parts) * entries).ravel()
            np.add.at(sums, cell, x.reshape(-1, width))
            counts += np.bincount(cell, minlength=parts * entries)
        cells = np.flatnonzero(counts)
        yield pa.RecordBatch.from_pydict(
            {"cell": cells, "n": counts[cells], **{f"s{i}": sums[cells, i] for i in range(width)}}
        )

    names = [f"s{i}" for i in range(width)]
    schema = ", ".join(f"{c} bigint" for c in ["cell", "n", *names])
    part = rows.select(VECTOR).mapInArrow(run, schema)
    means = part.groupBy("cell").agg(*[F.sum(c).alias(c) for c in ["n", *names]]).collect()
    out = books.copy().reshape(parts * entries, width)
    for row in means:
        out[row["cell"]] = [row[c] // row["n"] for c in names]
    return out.reshape(books.shape)


def fit(rows: DataFrame, dimension: int, parts: int = 16, entries: int = 64, rounds: int = 2) -> np.ndarray:
    """Codebooks (parts x entries x width) of ``usable`` rows.

    They begin as the parts of the vectors with the ``entries`` smallest ids (repeated ids by their
    vectors, null ids last; fewer where the table has fewer) and are refined ``rounds`` times by all
    vectors. What the driver holds is bounded by the codebooks.
    """
    first = _in_order(rows).limit(entries).select(VECTOR).collect()
    start = np.array([r[VECTOR] for r in first], np.float64).reshape(len(first), dimension)
    start = np.floor(start * SCALE).astype(np.int64).reshape(len(first), parts, dimension // parts)
    books = np.ascontiguousarray(start.transpose(1, 0, 2))
    for _ in range(rounds):
        books = _refined(rows, books)
    return books


def encode(rows: DataFrame, books: np.ndarray) -> DataFrame:
    """``vec_id, label, code`` (binary, a byte a part: the index of its entry) and ``error`` (long)."""
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, _, at, error in _assigned(batches, books):
            code = pa.array([row.tobytes() for row in at.astype(np.uint8)], pa.binary())
            columns = [piece.column(VEC), piece.column(LABEL), code, pa.array(error.sum(axis=1))]
            yield pa.RecordBatch.from_arrays(columns, names=[VEC, LABEL, "code", "error"])

    schema = f"{VEC} {kinds[VEC]}, {LABEL} {kinds[LABEL]}, code binary, error bigint"
    return rows.mapInArrow(run, schema)


def digest(books: np.ndarray) -> str:
    """SHA-256 of all components by part, entry and position, as decimals with commas between."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def compress(
    vectors: DataFrame, parts: int = 16, entries: int = 64, rounds: int = 2
) -> tuple[DataFrame, np.ndarray]:
    """(``vec_id, label, code, error, label_error``, codebooks) of a table ``vec_id, embedding, label``.

    Vectors that ``usable`` leaves out have no row. Repeated rows are rows of their own; null ids and
    labels are kept, and null labels are one label. ``label_error`` is the sum of ``error`` over a
    label: one partial sum a task and label is shuffled. An empty table gives no rows and empty
    codebooks. Extra columns are not read. A vector is read ``rounds`` + 1 times and never shuffled.
    """
    if entries > 256:
        raise ValueError("a code has one byte a part: at most 256 entries")
    rows, dimension = usable(vectors, parts)
    books = fit(rows, dimension, parts, entries, rounds) if dimension else np.zeros((parts, 0, 0), np.int64)
    if not dimension:
        none = rows.select(VEC, LABEL, F.lit(b"").alias("code"), F.lit(0).cast("bigint").alias("error"))
        return none.withColumn("label_error", F.col("error")).limit(0), books
    coded = materialize(encode(rows, books), "vector-codes")
    sums = coded.groupBy(F.col(LABEL).alias("_label")).agg(F.sum("error").alias("label_error"))
    return coded.join(sums, F.col(LABEL).eqNullSafe(F.col("_label"))).drop("_label"), books
