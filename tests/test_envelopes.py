from __future__ import annotations

import json
import subprocess
import sys
from contextlib import contextmanager

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyshelf.functions.envelope import batch_file, batch_key
from tallyshelf.operators import envelopes as envelopes_module
from tallyshelf.operators.envelopes import (
    number_rows,
    pack_envelopes,
    pack_messages,
    parse_messages,
    to_messages,
    unpack_envelopes,
    usable_envelopes,
)
from tallyshelf.plans.publish import publish_feed
from tallyshelf.session import scratch_folder, scratch_path
from tallyshelf.sources.files import read_row_feed
from tallyshelf.sources.topic import Topic

ROW = T.StructType().add("sku_id", "string").add("units_sold", "integer")


@pytest.mark.parametrize("rows, size, sizes", [
    (0, 10, []), (1, 10, [1]), (9, 10, [9]), (10, 10, [10]), (11, 10, [10, 1]), (35, 10, [10, 10, 10, 5]),
])
def test_envelope_sizes(spark, rows, size, sizes):
    envelopes = pack_envelopes(spark.range(rows, numPartitions=3), scratch_path(spark, "t"), size)
    found = sorted((r.batch_id, len(r.rows)) for r in envelopes.collect())
    assert found == list(enumerate(sizes, start=1))


def test_rows_keep_their_order_across_many_partitions(spark):
    # More partitions than one block of partial sums holds, most of them empty, some of uneven size.
    df = spark.range(5000, numPartitions=2500).filter(F.col("id") % 7 != 3)
    numbered = number_rows(df, scratch_path(spark, "t")).select("number", "row.id").orderBy("number").collect()
    wanted = [i for i in range(5000) if i % 7 != 3]
    assert [tuple(r) for r in numbered] == list(enumerate(wanted, start=1))


def test_rows_in_an_envelope_are_in_order(spark):
    envelopes = pack_envelopes(spark.range(250, numPartitions=7), scratch_path(spark, "t"), 100)
    ids = [r.id for e in envelopes.orderBy("batch_id").collect() for r in e.rows]
    assert ids == list(range(250))


def test_rows_of_a_split_file_keep_their_order(spark, tmp_path):
    (tmp_path / "feed.csv").write_text("sku_id\n" + "".join(f"k{i}\n" for i in range(5000)))
    before = {n: spark.conf.get(n) for n in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    for name in before:
        spark.conf.set(name, "1000b")
    try:
        feed = read_row_feed(spark, f"{tmp_path}/feed.csv")
        assert feed.rdd.getNumPartitions() > 10
        numbered = number_rows(feed, scratch_path(spark, "t"))
        found = [r.sku_id for r in numbered.select("number", "row.*").orderBy("number").collect()]
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert found == [f"k{i}" for i in range(5000)]


def test_copies_of_one_row_fill_envelopes_evenly(spark):
    df = spark.range(3000, numPartitions=4).select(F.when(F.col("id") % 3 > 0, F.col("id")).otherwise(0).alias("id"))
    envelopes = pack_envelopes(df, scratch_path(spark, "t"), 100)
    assert {len(r.rows) for r in envelopes.collect()} == {100} and envelopes.count() == 30


def test_keys_are_padded_and_never_cut(spark):
    df = spark.createDataFrame([(7,), (123456,)], "batch_id int").select(batch_key(), batch_file())
    assert [tuple(r) for r in df.collect()] == [("batch-00007", "batch_00007"), ("batch-123456", "batch_123456")]


def test_message_text(spark):
    rows = spark.createDataFrame([("k", None)], "sku_id string, units_sold string")
    message = to_messages(pack_envelopes(rows, scratch_path(spark, "t"))).first()
    assert message.key == "batch-00001"
    assert json.loads(message.value) == {"batch_id": 1, "rows": [{"sku_id": "k", "units_sold": None}]}


MESSAGES = [
    ('{"batch_id":1,"rows":[{"sku_id":"x","units_sold":3,"odd":1}]}', 1, [("x", "3")]),
    ('{"batch_id":2}', 2, []),
    ('{"batch_id":3,"rows":null}', 3, []),
    ('{"batch_id":4,"rows":[{}]}', 4, [(None, None)]),
    ('{"rows":[{"sku_id":"x"}]}', None, None),
    ('{"batch_id":"abc","rows":[]}', None, None),
    ('{"batch_id":5,"rows":"oops"}', None, None),
    ('{"batch_id":6,"rows":[{"sku_id":"x"', None, None),
    ("no json", None, None),
    ("[1]", None, None),
    ("", None, None),
    (None, None, None),
]


@pytest.mark.parametrize("text, batch_id, rows", MESSAGES)
def test_parsing(spark, text, batch_id, rows):
    parsed = parse_messages(spark.createDataFrame([(text,)], "value string"), ROW)
    assert parsed.first().usable is (batch_id is not None)
    found = [(e.batch_id, [tuple(r) for r in e.rows]) for e in usable_envelopes(parsed).collect()]
    assert found == ([] if batch_id is None else [(batch_id, rows)])
    lines = [tuple(r) for r in unpack_envelopes(usable_envelopes(parsed)).collect()]
    assert lines == [(batch_id, *row) for row in rows or []]


def test_publishing_a_feed_leaves_no_staging_behind(spark, tmp_path):
    (tmp_path / "feed.csv").write_text("sku_id,units_sold\n" + "".join(f"k{i},{i}\n" for i in range(25)))
    topic = Topic(f"{tmp_path}/topic")
    publish_feed(spark, f"{tmp_path}/feed.csv", topic, size=10)
    messages = spark.read.schema("key string, value string").json(topic.name).collect()
    values = sorted((json.loads(m.value) for m in messages), key=lambda v: v["batch_id"])
    assert [(v["batch_id"], len(v["rows"])) for v in values] == [(1, 10), (2, 10), (3, 5)]
    assert [r["sku_id"] for v in values for r in v["rows"]] == [f"k{i}" for i in range(25)]
    with scratch_folder(spark, "t") as path:
        spark.range(1).write.parquet(path)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)


def test_rows_reach_their_envelopes_without_a_shuffle(spark):
    """Only envelopes that begin in one task and end in another go through an exchange."""
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = spark.range(10_000, numPartitions=3).select(F.col("id").cast("string").alias("sku_id"), F.lit(None).cast("int").alias("n"))
        envelopes = pack_envelopes(df, scratch_path(spark, "t"), 100)
        found = {r.batch_id: [row.sku_id for row in r.rows] for r in envelopes.collect()}
        plan = envelopes._jdf.queryExecution().executedPlan()
        sent = []

        def walk(node):
            names = [node.output().apply(k).name() for k in range(node.output().size())]
            if node.nodeName() == "Exchange" and "row" in names:
                sent.append(node.metrics().apply("shuffleRecordsWritten").value())
            for k in range(node.children().size()):
                walk(node.children().apply(k))

        walk(plan)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    assert found == {b + 1: [str(i) for i in range(100 * b, 100 * b + 100)] for b in range(100)}
    # Three tasks: two places where an envelope may be cut.
    assert len(sent) == 1 and sent[0] <= 200


def test_envelopes_of_files_that_are_read_in_pieces(spark):
    """Tasks read a stored file from several places, and small files in an order of their own."""
    before = {n: spark.conf.get(n) for n in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for name, value in zip(before, ("3000b", "1b"), strict=True):
            spark.conf.set(name, value)
        df = spark.range(4321, numPartitions=9).filter("id % 5 != 2 or id > 3000").select(F.repeat(F.col("id").cast("string"), 3).alias("k"), "id")
        envelopes = pack_envelopes(df, scratch_path(spark, "t"), 70).orderBy("batch_id").collect()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    wanted = [i for i in range(4321) if i % 5 != 2 or i > 3000]
    assert [e.batch_id for e in envelopes] == list(range(1, -(-len(wanted) // 70) + 1))
    assert {len(e.rows) for e in envelopes[:-1]} == {70}
    assert [row.id for e in envelopes for row in e.rows] == wanted
    assert all(row.k == str(row.id) * 3 for e in envelopes for row in e.rows)


@contextmanager
def small_tasks(spark):
    """Every stored file is read by a task of its own."""
    before = {n: spark.conf.get(n) for n in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for name in before:
            spark.conf.set(name, "3000b")
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


@pytest.mark.parametrize("few", [1_000_000, 0])
def test_messages_are_the_text_of_the_envelopes(spark, monkeypatch, few):
    """With and without envelopes that tasks hold whole; nulls, quotes and letters beyond ASCII stay what they are."""
    monkeypatch.setattr(envelopes_module, "BROADCAST_ROWS", few)
    rows = spark.range(1234, numPartitions=3).select(
        F.col("id").cast("string").alias("a"),
        F.when(F.col("id") % 3 == 0, F.concat(F.lit('é "x", {}],\n\\ 𝄞 '), F.col("id").cast("string"))).alias("b"),
        F.lit(None).cast("string").alias("c"),
    )
    with small_tasks(spark):
        wanted = to_messages(pack_envelopes(rows, scratch_path(spark, "t"), 100)).collect()
        found = pack_messages(rows, scratch_path(spark, "t"), 100)
        found = found.select(batch_key().alias("key"), "value", "n_rows").collect()
    assert sorted((r.key, r.value) for r in found) == sorted((r.key, r.value) for r in wanted)
    assert sorted(r.n_rows for r in found) == [34] + [100] * 12
    assert pack_messages(rows.limit(0), scratch_path(spark, "t"), 100).collect() == []


@pytest.mark.parametrize("as_text", [False, True])
def test_tasks_pack_without_this_package(as_text):
    """A process that cannot import it gets along with what is sent to it."""
    run = (
        "import pickle, sys\nimport pyarrow as pa\n"
        "pack = pickle.loads(sys.stdin.buffer.read())\n"
        "rows = pa.RecordBatch.from_arrays([pa.array([1, 2, 3]), pa.array(['a,', 'b,', 'c,'])], names=['number', 'row'])\n"
        "print(sum(b.num_rows for b in pack(iter([rows]))))\n"
    )
    sent = cloudpickle.dumps(envelopes_module._packer(2, as_text))
    done = subprocess.run([sys.executable, "-I", "-c", run], input=sent, capture_output=True, cwd="/", timeout=60)
    assert done.stdout.strip() == b"2", done.stderr.decode()
