"""Rows to numbered envelopes and back."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyshelf import fixed_values as fixed
from tallyshelf.functions import envelope as env
from tallyshelf.operators.joins import BROADCAST_ROWS

# `monotonically_increasing_id` holds the partition in the upper bits and a row count in the rest.
_ROW_BITS = 33
# Partitions summed up by one task in `_rows_before`.
_BLOCK_BITS = 10
# Rows of a staged file. Tasks that put envelopes together read whole files: large ones would leave few tasks.
_FILE_ROWS = 50_000


def _part() -> Column:
    return F.shiftright("position", _ROW_BITS)


def _rows_before(counts: DataFrame) -> DataFrame:
    """(part, before): rows in all earlier partitions, from (part, n), summed in two levels."""
    in_block = Window.partitionBy("block").orderBy("part")
    blocked = counts.withColumn("block", F.shiftright("part", _BLOCK_BITS))
    # One row per 1024 partitions: the only window over everything stays small.
    earlier_blocks = blocked.groupBy("block").agg(F.sum("n").alias("block_n"))
    earlier_blocks = earlier_blocks.select(
        "block", (F.sum("block_n").over(Window.orderBy("block")) - F.col("block_n")).alias("block_before")
    )
    within = blocked.withColumn("before", F.sum("n").over(in_block) - F.col("n"))
    return within.join(earlier_blocks, "block").select(
        "part", (F.col("before") + F.col("block_before")).alias("before")
    )


def _numbered(df: DataFrame, staging: str) -> tuple[DataFrame, bool]:
    """(number, row) as `number_rows` gives it, and whether a task has its rows in the order in which they are stored."""
    spark = df.sparkSession
    placed = df.select(F.monotonically_increasing_id().alias("position"), F.struct("*").alias("row"))
    placed.write.options(compression="zstd", maxRecordsPerFile=_FILE_ROWS).parquet(staging)
    schema = T.StructType([T.StructField("position", T.LongType()), T.StructField("row", df.schema)])
    staged = spark.read.schema(schema).parquet(staging)

    counts = staged.groupBy(_part().alias("part")).agg(F.count("*").alias("n"))
    # Two longs per task of the staging job; None where there are no rows.
    before = _rows_before(counts)
    parts = before.count()
    if parts == 0:
        return staged.select(F.lit(0).cast("long").alias("number"), "row"), True
    few = parts <= BROADCAST_ROWS
    in_part = F.col("position").bitwiseAND((1 << _ROW_BITS) - 1)
    numbered = staged.join(F.broadcast(before) if few else before, _part() == F.col("part")).select(
        (F.col("before") + in_part + 1).alias("number"), "row"
    )
    return numbered, few


def number_rows(df: DataFrame, staging: str) -> DataFrame:
    """(number, row): rows numbered from 1 without gaps, in the frame's own order.

    The rows are written to `staging` with their position first. Positions then are data: counting
    and numbering see the same ones whatever happens to the executors or the input in between.
    """
    return _numbered(df, staging)[0]


def _packer(size: int, as_text: bool = False) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(number, row) to envelopes that lie in the task as a whole, by slices of its Arrow batches.

    They have (batch_id, rows), or (batch_id, n_rows, value) where a row is JSON text that ends with a comma. What runs
    in the tasks is all in here, as executors need not have this package.
    """

    def envelopes(done: list[tuple[int, list[tuple[int, pa.Array]]]]) -> pa.RecordBatch:
        lists = [[rows for _, rows in sorted(pieces, key=lambda piece: piece[0])] for _, pieces in done]
        rows = pa.concat_arrays([piece for pieces in lists for piece in pieces])
        ends = np.cumsum([0, *(sum(map(len, pieces)) for pieces in lists)])
        ids = pa.array([batch_id for batch_id, _ in done], pa.int64()).cast(pa.int32())
        if as_text:
            sizes = pa.array(np.diff(ends), pa.int32())
            return pa.RecordBatch.from_arrays([ids, sizes, texts(done, rows, ends)], names=["batch_id", "n_rows", "value"])
        item = pa.field("element", rows.type, nullable=False)
        packed = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), rows, type=pa.list_(item))
        return pa.RecordBatch.from_arrays([ids, packed], names=["batch_id", "rows"])

    def texts(done: list, rows: pa.Array, ends: np.ndarray) -> pa.Array:
        # The rows of an envelope are one run of bytes.
        rows = rows.cast(pa.large_string())
        _, offsets, data = rows.buffers()
        at = np.frombuffer(offsets, np.int64)[rows.offset : rows.offset + len(rows) + 1][ends].tolist()
        data = memoryview(data)
        values = [
            b"".join([b'{"batch_id":%d,"rows":[' % batch_id, data[a : b - 1], b"]}"])
            for (batch_id, _), (a, b) in zip(done, pairwise(at), strict=True)
        ]
        return pa.array(values, pa.binary()).cast(pa.string())

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Rows of an envelope follow each other but for a place or two, where a stored file or the Arrow batch ends.
        begun: dict[int, list[tuple[int, pa.Array]]] = {}
        held: dict[int, int] = {}
        for batch in batches:
            numbers, rows = batch.column(0).to_numpy(), batch.column(1)
            if not len(numbers):
                continue
            ids = (numbers - 1) // size + 1
            cuts = np.flatnonzero((np.diff(numbers) != 1) | (np.diff(ids) != 0)) + 1
            done = []
            for a, b in pairwise([0, *cuts.tolist(), len(numbers)]):
                batch_id = int(ids[a])
                begun.setdefault(batch_id, []).append((int(numbers[a]), rows.slice(a, b - a)))
                held[batch_id] = held.get(batch_id, 0) + b - a
                if held[batch_id] == size:
                    done.append((batch_id, begun.pop(batch_id)))
                    del held[batch_id]
            if done:
                yield envelopes(done)
        # Only the last envelope of all may be short.
        if len(begun) > 1 or any(min(first for first, _ in p) != (k - 1) * size + 1 for k, p in begun.items()):
            raise ValueError("the stored rows are dealt to other tasks than when their envelopes were looked up")
        if begun:
            yield envelopes(list(begun.items()))

    return pack


def _gathered(numbered: DataFrame, row: Column) -> DataFrame:
    """(batch_id, rows) of (number, row, batch_id), the rows brought together by a shuffle."""
    # Dealt out by batch first, so that lists are built once and not merged from the map tasks' parts.
    entries = F.collect_list(F.struct("number", row.alias("row")))
    return (
        numbered.repartition("batch_id")
        .groupBy("batch_id")
        .agg(F.array_sort(entries).alias("entries"))
        .select("batch_id", F.transform("entries", lambda entry: entry["row"]).alias("rows"))
    )


def _dealt(df: DataFrame, staging: str, size: int) -> tuple[DataFrame | None, DataFrame]:
    """(number, row, batch_id) of envelopes that tasks hold as a whole, None where rows are in no order, and of the others.

    The others begin in one task and end in another.
    """
    numbered, in_order = _numbered(df, staging)
    first = F.col("number") - 1
    numbered = numbered.withColumn("batch_id", ((first - first % size) / size + 1).cast("int"))
    if not in_order:
        return None, numbered
    task = F.spark_partition_id()
    tasks = numbered.select("batch_id", task.alias("task")).groupBy("batch_id").agg(F.min("task").alias("a"), F.max("task").alias("b"))
    # No more than one for each staged file.
    cut = F.broadcast(tasks.filter("a < b").select("batch_id"))
    return numbered.join(cut, "batch_id", "left_anti"), numbered.join(cut, "batch_id", "left_semi")


def pack_envelopes(df: DataFrame, staging: str, size: int = fixed.ENVELOPE_ROWS) -> DataFrame:
    """(batch_id, rows): consecutive rows in envelopes of `size`, numbered from 1; the last may be short.

    An envelope is put together in the task that reads its rows from `staging`. Only the rows of those that begin in one
    task and end in another are shuffled, one envelope or so for each staged file.
    """
    whole, cut = _dealt(df, staging, size)
    schema = T.StructType([
        T.StructField("batch_id", T.IntegerType()),
        T.StructField("rows", T.ArrayType(df.schema, containsNull=False)),
    ])
    gathered = _gathered(cut, F.col("row"))
    if whole is None:
        return gathered
    return whole.select("number", "row").mapInArrow(_packer(size), schema).unionByName(gathered)


def pack_messages(df: DataFrame, staging: str, size: int = fixed.ENVELOPE_ROWS) -> DataFrame:
    """(batch_id, n_rows, value): the envelopes of `pack_envelopes` as the JSON text that `to_messages` makes of them.

    Rows become text before they are put together, so that an envelope is a run of bytes and no list of rows.
    """
    whole, cut = _dealt(df, staging, size)
    text = env.row_json("row")
    value = F.concat(F.lit('{"batch_id":'), F.col("batch_id").cast("string"), F.lit(',"rows":['), F.array_join("rows", ","), F.lit("]}"))
    gathered = _gathered(cut, text).select("batch_id", F.size("rows").alias("n_rows"), value.alias("value"))
    if whole is None:
        return gathered
    rows = whole.select("number", F.concat(text, F.lit(",")).alias("row"))
    return rows.mapInArrow(_packer(size, as_text=True), "batch_id int, n_rows int, value string").unionByName(gathered)


def to_messages(envelopes: DataFrame) -> DataFrame:
    """(key, value) text messages."""
    return envelopes.select(env.batch_key().alias("key"), env.envelope_json().alias("value"))


def parse_messages(messages: DataFrame, row_schema: T.StructType) -> DataFrame:
    """Messages with `parsed` and `usable` added."""
    parsed = messages.withColumn("parsed", env.parse_envelope("value", row_schema))
    return parsed.withColumn("usable", env.is_usable("parsed"))


def usable_envelopes(parsed: DataFrame, *others: str) -> DataFrame:
    """(batch_id, rows, others) of the usable messages; envelopes without rows are empty."""
    return parsed.filter("usable").select(
        F.col("parsed.batch_id").alias("batch_id"), env.envelope_rows("parsed").alias("rows"), *others
    )


def unpack_envelopes(envelopes: DataFrame) -> DataFrame:
    """One line per row, with the batch it came in."""
    return envelopes.select("batch_id", F.explode("rows").alias("row")).select("batch_id", "row.*")
