"""Sessions, object-store settings, shared scratch space and planned sizes."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from functools import cache

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"
INITIAL_TASKS_SETTING = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def get_spark_session(
    app_name: str = "retail_sales",
    hive: bool = True,
    options: Mapping[str, str] | None = None,
    shuffle_tasks: int | None = None,
) -> SparkSession:
    """A session in UTC with adaptive execution, on the Hive catalog unless `hive` is off.

    `shuffle_tasks` is how many parts a shuffle is written in before adaptive execution merges those
    that turn out small. It cannot split a plain aggregation's parts, so the number should suit the
    largest input: its compressed bytes by what a task can hold.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # HotSpot does not compile longer methods; a stage that has one runs faster in smaller pieces.
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
    )
    if shuffle_tasks:
        builder = builder.config(INITIAL_TASKS_SETTING, str(shuffle_tasks))
    for name, value in (options or {}).items():
        builder = builder.config(name, value)
    if hive:
        builder = builder.enableHiveSupport()
    return builder.getOrCreate()


def s3a_options(environ: Mapping[str, str] = os.environ) -> dict[str, str]:
    """Session options for s3a paths that the connector's default providers don't find by themselves.

    The standard variables, temporary credentials included, are left to these providers. A region is
    only set if one is given. Keys under their short names are passed on as a fixed pair.
    """
    options = {}
    if region := environ.get("AWS_REGION") or environ.get("AWS_DEFAULT_REGION"):
        options["spark.hadoop.fs.s3a.endpoint.region"] = region
    short = [environ.get(name) for name in ("AWS_ACCESS_KEY", "AWS_SECRET_KEY")]
    if all(short) and not environ.get("AWS_ACCESS_KEY_ID"):
        for name, value in zip(("access.key", "secret.key"), short, strict=True):
            options[f"spark.hadoop.fs.s3a.{name}"] = value
    return options


def scratch_root(spark: SparkSession) -> str:
    """The shared folder the cluster names; only a local session may fall back to its own disk."""
    root = spark.conf.get(CHECKPOINT_SETTING, None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"{CHECKPOINT_SETTING} must name a folder that all executors share")
    return _own_root()


@cache
def _own_root() -> str:
    """One folder for all scratch data of a local session, removed when the process ends."""
    folder = tempfile.mkdtemp(prefix="run-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def remove_path(spark: SparkSession, path: str) -> None:
    """Remove a file or folder on any file system, if it is there."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop_path, True)


_RUN = f"run-{uuid.uuid4().hex}"
_run_folders: dict[str, SparkSession] = {}


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused folder name in the shared scratch space, in this process' own folder there."""
    folder = f"{scratch_root(spark)}/{_RUN}"
    _run_folders[folder] = spark
    return f"{folder}/{label}-{uuid.uuid4().hex}"


@atexit.register
def _remove_run_folders() -> None:
    """At the end of the process, as frames that were returned may still read their scratch data."""
    for folder, spark in _run_folders.items():
        if spark.sparkContext._jsc is not None:
            remove_path(spark, folder)


@contextmanager
def scratch_folder(spark: SparkSession, label: str) -> Iterator[str]:
    """A scratch folder that is removed again once the job that staged data in it is done."""
    path = scratch_path(spark, label)
    try:
        yield path
    finally:
        remove_path(spark, path)


def planned_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of all that a frame reads: the sum over its scans, whatever joins them."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(str(leaves.apply(k).stats().sizeInBytes())) for k in range(leaves.size()))
