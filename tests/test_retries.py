"""Staging and landing with tasks that fail on their first attempt, in a session that retries them."""

from __future__ import annotations

import subprocess
import sys
from pathlib import Path

SCRIPT = '''
import json, sys
from pyspark import TaskContext
from tallyshelf.operators.envelopes import pack_envelopes, to_messages
from tallyshelf.schemas import T, as_text
from tallyshelf.session import get_spark_session, scratch_path
from tallyshelf.streaming.landing import Landing, land_messages, landed_batches, read_landed

folder = sys.argv[1]
spark = get_spark_session("retries", hive=False, options={
    "spark.master": "local[4,3]", "spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "4",
})
spark.sparkContext.setLogLevel("OFF")


def flaky(frames):
    task = TaskContext.get()
    for number, frame in enumerate(frames):
        yield frame
    # Fails after its rows were handed on, so that a half-written file is left behind.
    if task.attemptNumber() == 0 and task.partitionId() % 2 == 0:
        raise RuntimeError("lost")


def unreliable(df):
    return df.mapInPandas(flaky, df.schema)


rows = unreliable(spark.range(1000, numPartitions=7).selectExpr("cast(id as string) as sku_id"))
envelopes = pack_envelopes(rows, scratch_path(spark, "retries"), 100)
packed = [r.sku_id for e in envelopes.orderBy("batch_id").collect() for r in e.rows]
assert packed == [str(i) for i in range(1000)], packed[:20]

messages = unreliable(to_messages(envelopes).repartition(6).selectExpr("key", "value", "key as arrival"))
landing = Landing(f"{folder}/landed", T.StructType().add("sku_id", "string"))
land_messages(messages, 0, landing)
assert sorted(int(r.sku_id) for r in read_landed(spark, landing).collect()) == list(range(1000))
assert {r.n_rows for r in landed_batches(spark, landing).collect()} == {100}
print("held")
'''


def test_lost_tasks_change_nothing(tmp_path):
    root = Path(__file__).resolve().parents[1]
    done = subprocess.run(
        [sys.executable, "-c", SCRIPT, str(tmp_path)], cwd=root, capture_output=True, text=True, timeout=300
    )
    assert done.stdout.strip().endswith("held"), done.stderr[-3000:]
