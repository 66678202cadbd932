"""Chunks of documents that ask buckets of keys and get answers: a hash join in blocks of packed arrays.

Documents are stored once as chunks of some megabytes, one row each. A chunk turns its keys into one packed
block for each bucket; a bucket gets one block from each chunk, holds keys that lie together by hash, and sends
one block back to each. So what is shuffled are arrays and no rows for single keys, equal keys of a chunk are
one before they are shuffled, and no task holds more than a chunk or a bucket, whatever key is frequent.
The number of buckets follows the bytes of the input.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyshelf.llm.common import give_back, mix, stored, text_groups

CHUNK_BYTES = 16 << 20
BUCKET_BYTES = 8 << 20
LEAST_BUCKETS = 32
NO_ID = np.iinfo(np.int64).max

CHUNKS = pa.schema([("chunk", pa.int64()), ("n_bytes", pa.int64()), ("data", pa.binary())])
BLOCKS = pa.schema([("chunk", pa.int64()), ("bucket", pa.int64()), ("kind", pa.int32()), ("data", pa.binary())])
BLOCKS_DDL = "chunk long, bucket long, kind int, data binary"


class Chunk:
    """Documents of a chunk: ids (NO_ID: null, after all others), flags, what is carried with each, and UTF-8 bytes
    in a row with their ends."""

    def __init__(self, data: bytes) -> None:
        raw = zstandard.ZstdDecompressor().decompress(data)
        n = int.from_bytes(raw[:8], "little")
        self.ids = np.frombuffer(raw, np.int64, n, 8)
        self.ends = np.frombuffer(raw, np.int64, n, 8 + 8 * n)
        self.flags = np.frombuffer(raw, np.uint8, n, 8 + 16 * n)
        size = int.from_bytes(raw[8 + 17 * n : 16 + 17 * n], "little")
        self._carried = raw[16 + 17 * n : 16 + 17 * n + size]
        self.data = memoryview(raw)[16 + 17 * n + size :]

    @property
    def carried(self) -> list[str]:
        return json.loads(self._carried)

    @property
    def starts(self) -> np.ndarray:
        return np.concatenate([[0], self.ends[:-1]]).astype(np.int64)

    def texts(self) -> Iterator[bytes]:
        start = 0
        for end in self.ends.tolist():
            yield bytes(self.data[start:end])
            start = end


def _packer(limit: int, body: Callable[[list[bytes]], bytes]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        compress = zstandard.ZstdCompressor(level=3).compress
        for k, group in enumerate(text_groups(batches, limit)):
            texts = [t.encode("utf-8", "surrogatepass") for t in group["text"].to_pylist()]
            ids = np.array([NO_ID if x is None else x for x in group["doc_id"].to_pylist()], np.int64)
            ends = np.cumsum([len(t) for t in texts], dtype=np.int64)
            flags = np.array(group["flag"].to_pylist(), np.uint8)
            carried = json.dumps(group["carry"].to_pylist()).encode()
            sizes = len(ids).to_bytes(8, "little"), len(carried).to_bytes(8, "little")
            head = [sizes[0], ids.tobytes(), ends.tobytes(), flags.tobytes(), sizes[1], carried]
            whole = b"".join([*head, body(texts)])
            packed, n_bytes = compress(whole), int(ends[-1])
            del group, texts, head, whole
            give_back()
            yield pa.RecordBatch.from_pylist(
                [{"chunk": (task << 32) + k, "n_bytes": n_bytes, "data": packed}], schema=CHUNKS
            )

    return run


def to_chunks(
    docs: DataFrame,
    flag: Column | None = None,
    limit: int = CHUNK_BYTES,
    carry: Column | None = None,
    body: Callable[[list[bytes]], bytes] = b"".join,
) -> DataFrame:
    """Chunks of doc_id and text, and of a small number and a string that go with each document; stored.

    A chunk holds its texts in a row, or what `body` makes of them.
    """
    rows = docs.select(
        "doc_id",
        "text",
        (F.lit(0) if flag is None else F.coalesce(flag, F.lit(0))).cast("int").alias("flag"),
        (F.lit("") if carry is None else carry).alias("carry"),
    )
    return stored(rows.mapInArrow(_packer(limit, body), "chunk long, n_bytes long, data binary"), "chunks")


def bucket_count(chunks: DataFrame, bucket_bytes: int = BUCKET_BYTES) -> int:
    total = chunks.agg(F.sum("n_bytes").alias("n")).collect()[0]["n"] or 0
    return max(LEAST_BUCKETS, total // bucket_bytes)


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    return (mix(keys ^ np.uint64(0x5851F42D4C957F2D)) % np.uint64(buckets)).astype(np.int64)


def by_bucket(buckets: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """An order that puts the same bucket together and keeps the order in it, and each bucket's end."""
    # Numbers of two bytes are sorted by radix.
    order = np.argsort(buckets.astype(np.uint16) if count < 1 << 16 else buckets, kind="stable")
    return order, np.cumsum(np.bincount(buckets, minlength=count))


Blocks = Iterator[tuple[int, bytes]]


def _batch(chunk: int, blocks: Blocks, kind: int) -> Iterator[pa.RecordBatch]:
    for bucket, data in blocks:
        yield pa.RecordBatch.from_arrays(
            [pa.array([chunk]), pa.array([bucket]), pa.array([kind], pa.int32()), pa.array([data], pa.binary())],
            schema=BLOCKS,
        )


def ask(chunks: DataFrame, question: Callable[[Chunk], Blocks], kind: int = 0) -> DataFrame:
    """Blocks for buckets from each chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield from _batch(row["chunk"], question(Chunk(row["data"])), kind)
                give_back()

    return chunks.mapInArrow(run, BLOCKS_DDL)


def answer(blocks: DataFrame, merge: Callable[[list[bytes]], list[bytes]], kind: int = 0) -> DataFrame:
    """One block back to each chunk from each bucket; `merge` gets all blocks of a bucket, in the chunks' order."""

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("chunk")
        data = merge(rows["data"].to_pylist())
        return pa.Table.from_arrays(
            [
                rows["chunk"].combine_chunks(),
                rows["bucket"].combine_chunks(),
                pa.array([kind] * len(data), pa.int32()),
                pa.array(data, pa.binary()),
            ],
            schema=BLOCKS,
        )

    return blocks.groupBy("bucket").applyInArrow(run, BLOCKS_DDL)


STATE_DDL = "bucket long, data binary, sums array<double>"
STATE = pa.schema([("bucket", pa.int64()), ("data", pa.binary()), ("sums", pa.list_(pa.float64()))])


def gather(blocks: DataFrame, merge: Callable[[list[bytes]], tuple[bytes, list[float]]]) -> DataFrame:
    """A state for each bucket from all its blocks, in the chunks' order, with sums for the driver to add up."""

    def run(rows: pa.Table) -> pa.Table:
        data, sums = merge(rows.sort_by("chunk")["data"].to_pylist())
        return pa.Table.from_pylist([{"bucket": rows["bucket"][0].as_py(), "data": data, "sums": sums}], schema=STATE)

    return blocks.groupBy("bucket").applyInArrow(run, STATE_DDL)


def update(
    state: DataFrame, blocks: DataFrame, merge: Callable[[bytes, list[bytes]], tuple[bytes, list[float]]]
) -> DataFrame:
    """The next state of each bucket from its state and its new blocks."""

    def run(mine: pa.Table, rows: pa.Table) -> pa.Table:
        row = mine.to_pylist()[0]
        data, sums = merge(row["data"], rows.sort_by("chunk")["data"].to_pylist())
        return pa.Table.from_pylist([{"bucket": row["bucket"], "data": data, "sums": sums}], schema=STATE)

    return state.groupBy("bucket").cogroup(blocks.groupBy("bucket")).applyInArrow(run, STATE_DDL)


def serve(state: DataFrame, blocks: DataFrame, reply: Callable[[bytes | None, bytes], bytes], kind: int) -> DataFrame:
    """One block back to each chunk from the state of each bucket that it asks; None where a bucket has no state."""

    def run(mine: pa.Table, rows: pa.Table) -> pa.Table:
        held = mine["data"][0].as_py() if mine.num_rows else None
        data = [reply(held, block) for block in rows["data"].to_pylist()]
        return pa.Table.from_arrays(
            [
                rows["chunk"].combine_chunks(),
                rows["bucket"].combine_chunks(),
                pa.array([kind] * len(data), pa.int32()),
                pa.array(data, pa.binary()),
            ],
            schema=BLOCKS,
        )

    return state.groupBy("bucket").cogroup(blocks.groupBy("bucket")).applyInArrow(run, BLOCKS_DDL)


def sums_of(state: DataFrame) -> list[float]:
    """The sums over all buckets: a few numbers, however many buckets there are."""
    rows = state.select(F.posexplode("sums").alias("k", "x")).groupBy("k").agg(F.sum("x").alias("x")).orderBy("k")
    return [r["x"] for r in rows.collect()]


def range_bucket(keys: np.ndarray, bits: int, buckets: int) -> np.ndarray:
    """Buckets by equal ranges of hashed keys, so that the keys of a bucket lie close together."""
    return (((keys >> np.uint64(bits - 32)) * np.uint64(buckets)) >> np.uint64(32)).astype(np.int64)


def with_answers(
    chunks: DataFrame, answers: DataFrame, use: Callable[[int, Chunk, dict[int, dict[int, bytes]]], pa.Table], ddl: str
) -> DataFrame:
    """Each chunk with its answers, by kind and bucket."""

    def run(mine: pa.Table, blocks: pa.Table) -> pa.Table:
        got: dict[int, dict[int, bytes]] = {}
        for kind, bucket, data in zip(*(blocks[c].to_pylist() for c in ("kind", "bucket", "data")), strict=True):
            got.setdefault(kind, {})[bucket] = data
        row = mine.to_pylist()[0]
        give_back()
        return use(row["chunk"], Chunk(row["data"]), got)

    return chunks.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(run, ddl)


def blocks_table(chunk: int, blocks: Blocks, kind: int = 0) -> pa.Table:
    """What `use` returns if it asks again."""
    return pa.Table.from_batches(list(_batch(chunk, blocks, kind)), schema=BLOCKS)
