"""The star join, and broadcasts behind a check of their size.

A dimension that is too big to broadcast is joined by sort-merge; a hot key there is left to the
skew join of adaptive execution, which splits the key's sales rows over several tasks.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyshelf.session import planned_bytes

BROADCAST_BYTES = 256 * 1024 * 1024
BROADCAST_ROWS = 1_000_000
# Files that are read for a dimension may be so many times its broadcast limit, as it drops rows and columns.
READ_RATIO = 4


def measured_bytes(df: DataFrame) -> int:
    """Size of the rows as a hash relation would hold them: fixed slots plus text lengths."""
    slots = 16 + 16 * len(df.columns)
    text = [
        F.coalesce(F.octet_length(F.col(f"`{f.name}`")), F.lit(0))
        for f in df.schema.fields
        if isinstance(f.dataType, (T.StringType, T.BinaryType))
    ]
    size = F.sum(reduce(add, text, F.lit(slots)).cast("long"))
    return df.agg(size.alias("bytes")).first()["bytes"] or 0


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast if the frame is measured to fit in `limit` bytes, else leave it alone.

    A frame that reads more than `READ_RATIO` limits is not measured, so a huge one is not scanned.
    """
    if planned_bytes(df) > READ_RATIO * limit or measured_bytes(df) > limit:
        return df
    return F.broadcast(df)


def broadcast_rows_if_few(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame | None:
    """None for an empty frame of slim rows; a broadcast for up to `limit` rows; else the frame."""
    rows = df.count()
    if rows == 0:
        return None
    return F.broadcast(df) if rows <= limit else df


def join_sources(
    sales: DataFrame, products: DataFrame, stores: DataFrame, broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Sales with their product and store; sales without either are left out.

    A dimension is broadcast if it is measured to be small, which runs it once to look.
    """
    products, stores = (broadcast_if_small(df, broadcast_bytes) for df in (products, stores))
    return sales.join(products, "sku_id").join(stores, "store_id")
