"""Joins of facts whose keys are skewed with a dimension that is too big to broadcast, split by heavy keys.

A frequent-items sketch, one pass that merges small summaries of the key column, says which keys hold more than a share
of all rows: their number is bounded by that share. Rows of heavy keys stay where they are and meet a broadcast of just
these keys' dimension rows; the others have no hot key any more and are joined by their key. Facts that are joined more
than once can be stored so (`save_split`): the others bucketed by key, so that later joins shuffle the dimension only.

The sketch decides on the way of a row, not on the result: a key that it misjudges is joined the other way.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyshelf.operators.joins import BROADCAST_BYTES, READ_RATIO, measured_bytes
from tallyshelf.session import planned_bytes

# A key is heavy from a thousandth of all rows on. The sketch errs by less than that with so many counters.
HEAVY_SHARE = 0.001
COUNTERS_PER_KEY = 8
BUCKETS = 2000


def heavy_keys(facts: DataFrame, key: str, share: float = HEAVY_SHARE) -> list:
    """Keys with about `share` of all rows or more, at most 1 / share; null is none."""
    most = int(1 / share)
    keys = facts.select(F.col(key).alias("k")).filter(F.col("k").isNotNull())
    sketch = keys.agg(F.expr(f"approx_top_k(k, {most}, {most * COUNTERS_PER_KEY})").alias("top"), F.count("*").alias("n"))
    found = sketch.first()
    return sorted(item["item"] for item in found["top"] or [] if item["count"] >= share * found["n"])


@dataclass(frozen=True)
class SplitFacts:
    """Facts by whether their key is heavy; null keys may be in neither."""

    key: str
    keys: tuple
    heavy: DataFrame
    rest: DataFrame


def split_facts(facts: DataFrame, key: str, share: float = HEAVY_SHARE) -> SplitFacts:
    """The split as two filters of one frame, which reads it twice."""
    keys = tuple(heavy_keys(facts, key, share))
    is_heavy = F.col(key).isin(*keys)
    return SplitFacts(key, keys, facts.filter(is_heavy), facts.filter(~is_heavy))


def save_split(
    facts: DataFrame, key: str, table: str, buckets: int = BUCKETS, share: float = HEAVY_SHARE
) -> SplitFacts:
    """Store facts as tables `TABLE_heavy`, without a shuffle, and `TABLE_rest`, bucketed by key and sorted in buckets.

    The tables must not exist. Rows with a null key match nothing and are not stored.
    """
    split = split_facts(facts, key, share)
    split.heavy.write.format("parquet").saveAsTable(f"{table}_heavy")
    rest = split.rest.repartition(buckets, key)
    rest.write.format("parquet").bucketBy(buckets, key).sortBy(key).saveAsTable(f"{table}_rest")
    return read_split(facts.sparkSession, key, split.keys, table)


def read_split(spark: SparkSession, key: str, keys: tuple, table: str) -> SplitFacts:
    return SplitFacts(key, keys, spark.table(f"{table}_heavy"), spark.table(f"{table}_rest"))


def join_split(facts: SplitFacts, dimension: DataFrame, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Inner join by the key; columns as a join by name gives them.

    The heavy keys' dimension rows are broadcast if they are measured to fit; a dimension that has too many rows for
    them is left to the skew join of adaptive execution there.
    """
    rest = facts.rest.join(dimension, facts.key)
    if not facts.keys:
        return rest
    chosen = dimension.filter(F.col(facts.key).isin(*facts.keys))
    if measured_bytes(chosen) <= broadcast_bytes:
        chosen = F.broadcast(chosen)
    return facts.heavy.join(chosen, facts.key).unionByName(rest)


def split_join(
    facts: DataFrame,
    dimension: DataFrame,
    key: str,
    broadcast_bytes: int = BROADCAST_BYTES,
    share: float = HEAVY_SHARE,
) -> DataFrame:
    """Facts with their dimension rows, split by the facts' heavy keys."""
    return join_split(split_facts(facts, key, share), dimension, broadcast_bytes)


def join_sources_split(
    sales: SplitFacts, products: DataFrame, stores: DataFrame, broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """As join_sources, of sales that are split by product. Stores too big to broadcast are joined split as well.

    That second split asks for the heavy stores among the sales' two parts before they are joined with products.
    """
    if planned_bytes(stores) <= READ_RATIO * broadcast_bytes and measured_bytes(stores) <= broadcast_bytes:
        return join_split(sales, products, broadcast_bytes).join(F.broadcast(stores), "store_id")
    keys = tuple(heavy_keys(sales.heavy.select("store_id").unionByName(sales.rest.select("store_id")), "store_id"))
    joined = join_split(sales, products, broadcast_bytes)
    is_heavy = F.col("store_id").isin(*keys)
    return join_split(SplitFacts("store_id", keys, joined.filter(is_heavy), joined.filter(~is_heavy)), stores, broadcast_bytes)
