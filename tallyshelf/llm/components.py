"""Connected components of links between text keys, by alternating stars in rounds of joins."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyshelf.llm.common import stored

LINKS_IN_A_PART = 1_000_000


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links each node of a part to the least node that the part's links join it with."""
    root: dict = {}

    def find(node):
        while (up := root.setdefault(node, node)) != node:
            root[node] = node = root.setdefault(up, up)
        return node

    names = None
    for batch in batches:
        names = names or batch.schema
        for u, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            a, b = find(u), find(v)
            if a != b:
                root[max(a, b)] = min(a, b)
    if names is not None:
        pairs = [(node, find(node)) for node in list(root)]
        pairs = [(u, v) for u, v in pairs if u != v]
        yield pa.RecordBatch.from_arrays(
            [pa.array([p[k] for p in pairs], names.field(k).type) for k in (0, 1)], schema=names
        )


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's least neighbour."""
    both = links.select("u", "v").unionAll(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the least of these."""
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    moved = links.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionAll(least.select("u", F.col("m").alias("v"))).filter("u > v").distinct()


def _sum(links: DataFrame) -> tuple:
    row = links.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("h")).collect()[0]
    return row["n"], row["h"]


def components(links: DataFrame) -> DataFrame:
    """node and root (the least key of its component) for links (a, b); nodes without links don't come.

    Parts of LINKS_IN_A_PART links are joined up within a task first. Each round after that is stored, so a
    lost executor costs a round at most, and their number grows with the logarithm of the number of parts that a
    component is spread over. Least neighbours are taken before the shuffle, so a hot node is no hot task.
    """
    given = stored(
        links.filter("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links"
    )
    # Long chains become stars where one part holds them; parts have a bounded number of links.
    parts = given.count() // LINKS_IN_A_PART + 1
    kinds = {f.name: f.dataType.simpleString() for f in given.schema.fields}
    now = stored(given.repartition(parts).mapInArrow(_contract, ", ".join(f"{n} {t}" for n, t in kinds.items())), "links")
    before = _sum(now)
    while True:
        now = stored(_small_star(_large_star(now)), "links")
        after = _sum(now)
        if after == before:
            break
        before = after
    roots = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionAll(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
