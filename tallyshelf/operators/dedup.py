"""Duplicates: whole rows, one row per key, and the newest version per key.

Everything here aggregates before it shuffles, so a key or a group of copies that holds a large
part of the rows arrives at its reducer as one row per map task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyshelf.operators.joins import BROADCAST_BYTES, BROADCAST_ROWS, broadcast_if_small, broadcast_rows_if_few
from tallyshelf.session import scratch_path

FINGERPRINT = "_fingerprint"
_SCAN_STEPS = {"Project", "Filter", "Generate", "CollectMetrics", "Union"}


def distinct_rows(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def with_fingerprint(df: DataFrame, name: str = FINGERPRINT) -> DataFrame:
    """Adds a hash of the whole row. Equal rows have equal hashes; zero's sign makes no difference, as in comparisons."""
    values = [
        F.col(f"`{f.name}`") + F.lit(0.0).cast(f.dataType) if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ]
    return df.withColumn(name, F.xxhash64(*values))


def distinct_by_fingerprint(df: DataFrame, name: str = FINGERPRINT, limit: int = BROADCAST_ROWS) -> DataFrame:
    """The distinct rows of a stored frame with a fingerprint, which goes.

    Fingerprints alone are shuffled first, as one number a row. Only rows whose fingerprint occurs several times can
    have copies: they are compared whole, so different rows with one fingerprint both stay. All others are passed on
    without a shuffle. Where more than `limit` fingerprints occur several times, all rows are compared.
    """
    repeated = df.groupBy(name).agg(F.count("*").alias("_n")).filter(F.col("_n") > 1).select(name)
    n = repeated.count()
    if n > limit:
        return distinct_rows(df.drop(name))
    if n == 0:
        return df.drop(name)
    repeated = F.broadcast(repeated)
    alone = df.join(repeated, name, "left_anti").drop(name)
    return alone.unionByName(distinct_rows(df.join(repeated, name, "left_semi").drop(name)))


def _is_columnar_scan(df: DataFrame) -> bool:
    """Whether a frame is filters and expressions over Parquet or ORC files, which gives the same rows when read again."""

    def cheap(node) -> bool:
        children = [node.children().apply(k) for k in range(node.children().size())]
        if not children:
            return node.toString().strip().endswith((" parquet", " orc"))
        return node.nodeName() in _SCAN_STEPS and all(map(cheap, children))

    plan = df._jdf.queryExecution().optimizedPlan()
    return plan.deterministic() and cheap(plan)


def distinct_by_rescan(df: DataFrame, limit: int = BROADCAST_BYTES, observed: DataFrame | None = None) -> DataFrame:
    """The distinct rows; a scan of columnar files with its filters is read again rather than shuffled.

    As `distinct_by_fingerprint`, but nothing is stored save the fingerprints that occur several times, which are looked
    up when this is called. The frame is read then, and twice by the result: once for the rows that are alone and once
    for the few that are compared whole. All rows are shuffled if these fingerprints are measured to be more than `limit`
    bytes, or if the frame is more than such a scan. `observed` has the same rows and is read once, first of all.
    """
    observed = observed or df
    if not _is_columnar_scan(df):
        return distinct_rows(observed)
    # Grouping makes both zeros one; rows that are alone must not differ in that.
    zeros = {
        f.name: F.col(f"`{f.name}`") + F.lit(0.0).cast(f.dataType)
        for f in df.schema.fields
        if isinstance(f.dataType, (T.DoubleType, T.FloatType))
    }
    first, marked = (with_fingerprint(rows.withColumns(zeros) if zeros else rows) for rows in (observed, df))
    path = scratch_path(df.sparkSession, "repeated")
    found = first.groupBy(FINGERPRINT).agg(F.count("*").alias("_n")).filter(F.col("_n") > 1).select(FINGERPRINT)
    found.write.parquet(path)
    repeated = df.sparkSession.read.schema(found.schema).parquet(path)
    few = broadcast_if_small(repeated, limit)
    if few is repeated:
        return distinct_rows(df)
    several, alone = (marked.join(few, FINGERPRINT, how).drop(FINGERPRINT) for how in ("left_semi", "left_anti"))
    return distinct_rows(several).unionByName(alone)


def one_per_key(df: DataFrame, key: str) -> DataFrame:
    """One row per key: the smallest in the order of the other columns, nulls first.

    Taking the minimum of a struct keeps a row that exists and, unlike an arbitrary survivor, does
    not depend on how the input is partitioned.
    """
    others = [name for name in df.columns if name.lower() != key.lower()]
    if not others:
        return df.dropDuplicates()
    kept = df.groupBy(key).agg(F.min(F.struct(*[F.col(f"`{name}`") for name in others])).alias("_kept"))
    return kept.select(*[
        F.col(f"`{name}`") if name.lower() == key.lower() else F.col("_kept")[name].alias(name)
        for name in df.columns
    ])


def count_copies(df: DataFrame, copies: str = "copies") -> DataFrame:
    """The distinct rows, each with the number of times it occurs."""
    return df.groupBy(*[F.col(f"`{name}`") for name in df.columns]).agg(F.count("*").alias(copies))


def newest_per_key(
    df: DataFrame, key: str, version: Sequence[str], versions: DataFrame | None = None
) -> DataFrame:
    """Rows of the newest version of each key; every row of that version is kept.

    `version` names the columns that order versions, the first one first. They are looked up in
    `versions`, a slim frame with one row per key and version, or in `df` itself. Only keys with
    several versions matter, and these are few as a rule, so the wide rows are not shuffled unless
    there are many such keys.
    """
    found = F.struct(*version)
    repeated = (
        (df if versions is None else versions)
        .groupBy(F.col(key).alias("_key"))
        .agg(F.max(found).alias("_newest"), F.min(found).alias("_oldest"))
        .filter(F.col("_oldest") < F.col("_newest"))
        .select("_key", "_newest")
    )
    repeated = broadcast_rows_if_few(repeated)
    if repeated is None:
        return df
    return df.join(repeated, (F.col(key) == F.col("_key")) & (found < F.col("_newest")), "left_anti")
