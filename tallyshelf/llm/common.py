"""Helpers that several text operators share: tables, shared scratch data, packed arrays and hashes."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import zipfile
from collections import defaultdict
from collections.abc import Iterator, Sequence
from itertools import count
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyshelf.session import remove_path, scratch_path

#: What separates words in every operator of this package: ASCII white space, as bytes.split() has it.
SPACES = "\x20\x09-\x0D"
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def ship_code(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, as `--py-files` would."""
    context = spark.sparkContext
    if getattr(context, "_tallyshelf_sent", None) == context.applicationId:
        return
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="run-")) / "tallyshelf.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    context.addPyFile(str(archive))
    context._tallyshelf_sent = context.applicationId


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """The frame, written once to the shared scratch folder: later jobs read files and not its lineage."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._stored_path = path
    return out


def discard(*frames: DataFrame) -> None:
    """Remove stored frames before the end of the process, once all that was made of them is stored too."""
    for frame in frames:
        remove_path(frame.sparkSession, frame._stored_path)


def release(spark: SparkSession) -> None:
    """Let Spark see which shuffles nobody can read any more; it deletes their files."""
    gc.collect()
    spark._jvm.System.gc()


def give_back() -> None:
    """Return freed memory of a Python worker to the system, where the C library can: workers live on from task to task."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def id_and_text(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Just the two columns an operator reads, so that no other column can clash; null text is empty."""
    return docs.select(
        F.col(id_column).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_column), F.lit("")).alias("text"),
    )


def sample_by_hash(rows: DataFrame, key: str, n: int, *order: str) -> DataFrame:
    """The n rows with the least hashes of a key. The bound is found on hashes alone, so few other rows are moved."""
    hashed = rows.withColumn("_hash", F.xxhash64(key))
    bound = hashed.select("_hash").orderBy("_hash").limit(n).agg(F.max("_hash").alias("b")).collect()[0]["b"]
    if bound is None:
        return rows.limit(0)
    return hashed.filter(F.col("_hash") <= bound).orderBy("_hash", *order).limit(n).drop("_hash")


def split_of(id_column: str, divisor: int):
    """Remainder by which documents are held out: crc32 of the id as text."""
    return F.crc32(F.col(id_column).cast("string").cast("binary")) % divisor


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as bytes, each split into planes of equal-valued byte places so that they compress well."""
    parts = []
    for a in arrays:
        a = np.ascontiguousarray(a)
        planes = a.view(np.uint8).reshape(len(a), a.itemsize).T.tobytes() if len(a) else b""
        parts.append(f"{a.dtype.str}:{len(a)};".encode() + planes)
    heads = b"".join(len(p).to_bytes(8, "little") for p in parts)
    return zstandard.ZstdCompressor(level=1).compress(bytes([len(parts)]) + heads + b"".join(parts))


def unpack(data: bytes) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(data)
    n, at, out = raw[0], 1 + 8 * raw[0], []
    for k in range(n):
        size = int.from_bytes(raw[1 + 8 * k : 9 + 8 * k], "little")
        part = raw[at : at + size]
        at += size
        head, _, planes = part.partition(b";")
        kind, _, length = head.decode().partition(":")
        dtype = np.dtype(kind)
        a = np.frombuffer(planes, np.uint8).reshape(dtype.itemsize, int(length)).T
        out.append(np.ascontiguousarray(a).reshape(-1).view(dtype) if int(length) else np.empty(0, dtype))
    return out


def pack_sorted(keys: np.ndarray) -> np.ndarray:
    """Sorted unsigned keys as gaps, whose high bytes are zero."""
    return np.diff(keys, prepend=keys.dtype.type(0)) if len(keys) else keys


def unpack_sorted(gaps: np.ndarray) -> np.ndarray:
    return np.cumsum(gaps, dtype=gaps.dtype)


def numbering(start: int = 0) -> defaultdict:
    """A dictionary that numbers what is looked up in it, in the order it is first seen."""
    return defaultdict(count(start).__next__)


def numbered(numbers: defaultdict, words: Sequence) -> np.ndarray:
    return np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))


def mix(keys: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = keys.astype(np.uint64)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def text_groups(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.Table]:
    """Rows in groups of about `limit` bytes of the column `text`; a longer text is a group of its own."""
    kept: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        start, ends = 0, None
        text = batch.column(batch.schema.get_field_index("text"))
        ends = np.cumsum(np.asarray(pc.binary_length(text.cast(pa.large_string())).fill_null(0)))
        while start < batch.num_rows:
            before = int(ends[start - 1]) if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + limit - size, side="right")))
            kept.append(batch.slice(start, stop - start))
            size += int(ends[stop - 1]) - before
            start = stop
            if size >= limit or start < batch.num_rows:
                yield pa.Table.from_batches(kept)
                kept, size = [], 0
    if kept:
        yield pa.Table.from_batches(kept)
