"""Token ids as length-delimited binary records, with a separate index of their offsets.

A record is: length of the ids in bytes (unsigned 64-bit), masked CRC-32C of the length, the ids,
masked CRC-32C of the ids; all little-endian. Ids take 16 bits (a zero follows an odd number of
them) if the vocabulary has no higher one, else 32; the index has the ``width`` in bytes. Shards hold records in ascending doc_id
order; the index (Parquet) has a row for each record: shard, offset, length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from millrace.llm.crc32c import crc32c, masked
from millrace.llm.ordered import encoded_in_order, total, with_base
from millrace.llm.texts import ID, binary_array, gather, running

_FRAME = 4  # words around a payload: length (2), its checksum, the payload's checksum


def _narrow(ids: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """16-bit ids, two in a word; every row starts with a word."""
    n = np.diff(offsets)
    at = running((n + 1) // 2)
    halves = np.zeros(2 * int(at[-1]), "<u2")
    halves[gather(2 * at[:-1], n)] = ids
    return halves.view("<u4"), at


def frame(ids: np.ndarray, offsets: np.ndarray, width: int = 4) -> tuple[np.ndarray, np.ndarray]:
    """(words of all records, their offsets in words)."""
    size = np.diff(offsets) * width
    if width == 2:
        ids, offsets = _narrow(ids, offsets)
    n = np.diff(offsets)
    at = running(n + _FRAME)
    out = np.zeros(int(at[-1]), np.uint32)
    head = np.zeros((len(n), 2), np.uint32)
    head[:, 0], head[:, 1] = size & 0xFFFFFFFF, size >> 32
    out[at[:-1]], out[at[:-1] + 1] = head[:, 0], head[:, 1]
    out[at[:-1] + 2] = masked(crc32c(head.ravel(), np.arange(len(n) + 1) * 2))
    out[gather(at[:-1] + 3, n)] = ids
    out[at[1:] - 1] = masked(crc32c(ids, offsets))
    return out, at


def unframe(words: np.ndarray, at: np.ndarray, width: int = 4) -> tuple[np.ndarray, np.ndarray]:
    """Payloads of records that lie one after the other; raises where a length or checksum is off."""
    n = np.diff(at) - _FRAME
    head = np.stack([words[at[:-1]], words[at[:-1] + 1]], axis=1)
    told = head[:, 0].astype(np.int64) | (head[:, 1].astype(np.int64) << 32)
    ids, offsets = words[gather(at[:-1] + 3, n)], running(n)
    if ((told + 3) // 4 != n).any() or (told % width).any() or (
        words[at[:-1] + 2] != masked(crc32c(head.ravel(), np.arange(len(n) + 1) * 2))
    ).any():
        raise ValueError("a record's length is damaged")
    if (words[at[1:] - 1] != masked(crc32c(ids, offsets))).any():
        raise ValueError("a record's data are damaged")
    if width == 2:
        n = told // 2
        ids = ids.view("<u2")[gather(2 * offsets[:-1], n)].astype(np.uint32)
        offsets = running(n)
    return ids, offsets


def _open(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri)


class _Shards:
    """A task's shards, one open at a time; called with a batch, gives its index columns."""

    def __init__(self, out: str, part: int, attempt: int, limit: int, width: int):
        self.files, self.base = _open(f"{out}/records")
        self.files.create_dir(self.base, recursive=True)
        self.prefix, self.limit = f"part-{part:05d}-{attempt}", limit
        self.shard, self.size, self.stream, self.width = -1, limit, None, width

    def __call__(self, ids: np.ndarray, offsets: np.ndarray) -> list[pa.Array]:
        if self.size >= self.limit:
            self.close()
            self.shard, self.size = self.shard + 1, 0
            self.name = f"{self.prefix}-{self.shard:04d}.rec"
            self.stream = self.files.open_output_stream(f"{self.base}/{self.name}")
        words, at = frame(ids, offsets, self.width)
        self.stream.write(pa.py_buffer(words.astype("<u4")))
        where = at[:-1] * 4 + self.size
        self.size += int(at[-1]) * 4
        n = len(at) - 1
        width = pa.array(np.full(n, self.width, np.int32))
        return [pa.array([self.name] * n), pa.array(where), pa.array(np.diff(at) * 4), width]

    def close(self) -> None:
        if self.stream is not None:
            self.stream.close()


def write_records(
    docs: DataFrame, out: str, path: str, end_id: int = 1, shard_bytes: int = 128 << 20
) -> None:
    """Encode whole texts and write shards to ``out/records`` and the index to ``out/index``.

    ``out`` must be a folder that all executors reach. A task's shards carry its attempt in their
    names and count only through the index rows that Spark commits: what a lost attempt wrote is
    never read. Null texts count as empty (only the end id), long ones are encoded whole; rows of one id
    are ordered by text, null ids come first. An empty table gives an empty index.
    """

    highest = max(end_id, *Tokenizer.from_file(path).get_vocab(with_added_tokens=True).values())
    width = 2 if highest < 1 << 16 else 4

    def emit(part: int) -> _Shards:
        return _Shards(out, part, TaskContext.get().taskAttemptId(), shard_bytes, width)

    columns = "shard string, at bigint, bytes bigint, width int"
    encoded_in_order(docs, path, end_id, emit, columns).write.parquet(f"{out}/index")


def read_index(spark: SparkSession, out: str) -> DataFrame:
    """doc_id, shard, at, bytes, start (ids of all documents before it) and n_tokens."""
    index = with_base(spark.read.parquet(f"{out}/index"), 1)
    return index.select(
        ID, "shard", "at", "bytes", "width", total(0).alias("start"), F.col("own")[0].alias("n_tokens")
    )


def read_records(index: DataFrame, out: str, task_bytes: int = 64 << 20) -> DataFrame:
    """Read the records that ``index`` names, in any order, checking lengths and checksums.

    Rows are dealt by place, so that a task reads runs of records; ``ids`` is added as binary.
    """
    size = index.agg(F.sum("bytes")).first()[0] or 0
    tasks = max(index.sparkSession.sparkContext.defaultParallelism, -(-size // task_bytes))
    keep = [c for c in index.columns]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in index.schema) + ", ids binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = _open(f"{out}/records")
        name, source = None, None
        for batch in batches:
            shards = batch.column("shard").to_pylist()
            at = batch.column("at").to_numpy()
            n = batch.column("bytes").to_numpy()
            width = batch.column("width")[0].as_py() if batch.num_rows else 4
            i = 0
            while i < len(shards):
                j = i + 1
                while j < len(shards) and shards[j] == shards[i] and at[j] == at[j - 1] + n[j - 1]:
                    j += 1
                if shards[i] != name:
                    name, source = shards[i], files.open_input_file(f"{base}/{shards[i]}")
                data = source.read_at(int(n[i:j].sum()), int(at[i]))
                ids, offsets = unframe(np.frombuffer(data, "<u4"), running(n[i:j] // 4), width)
                part = batch.slice(i, j - i)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, binary_array(ids, offsets)], names=[*keep, "ids"]
                )
                i = j

    dealt = index.repartitionByRange(tasks, "shard", "at").sortWithinPartitions("shard", "at")
    return dealt.mapInArrow(run, schema)
