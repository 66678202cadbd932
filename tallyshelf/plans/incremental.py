"""The curated table brought up to date: only dates that something changed for are joined and written again.

The table is partitioned by date. Beside it a state table keeps a fingerprint per date of the clean sales, and one per
product and per store over the columns that reach the result. A refresh compares these with the clean tables as they are.
A date is written again if its sales changed, or if it has sales of a product or store that came, went or changed. So
sales are read slim as a whole, and in full for those dates only.

The state is replaced last. A refresh that fails is simply run again: it finds the same changes and writes the same dates.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyshelf import fixed_values as fixed
from tallyshelf.operators.joins import BROADCAST_BYTES, broadcast_rows_if_few
from tallyshelf.plans.clean import CleanTables
from tallyshelf.plans.overview import retail_sales_overview
from tallyshelf.session import scratch_folder
from tallyshelf.sinks.versions import replace_table

_OVERWRITE_SETTING = "spark.sql.sources.partitionOverwriteMode"
_DATE, _PRODUCT, _STORE = "date", "product", "store"
#: Rows without a date are a partition too; no date reads like this.
_NO_DATE = ""


@dataclass(frozen=True)
class Refresh:
    """What a refresh found and did: changed dates and keys, dates written again, and those left without rows."""

    changed: int
    written: int
    emptied: int


def _date_text(column: str = "date") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(_NO_DATE))


def _hash(df: DataFrame, columns: list[str]) -> Column:
    """Of the columns and of which of them are null."""
    present = F.concat_ws("", *[F.col(f"`{c}`").isNotNull().cast("int").cast("string") for c in columns])
    return F.xxhash64(present, *[F.col(f"`{c}`") for c in columns])


def fingerprints(sales: DataFrame, products: DataFrame, stores: DataFrame) -> DataFrame:
    """(kind, key, n, h1, h2): rows and hashes per date, product and store. Aggregated before it is shuffled."""
    kinds = [
        (_DATE, sales, _date_text(), sales.columns),
        (_PRODUCT, products, F.col("sku_id"), [c for c in products.columns if c in fixed.OVERVIEW_COLUMNS]),
        (_STORE, stores, F.col("store_id"), [c for c in stores.columns if c in fixed.OVERVIEW_COLUMNS]),
    ]
    found = [
        df.select(F.lit(kind).alias("kind"), key.alias("key"), _hash(df, columns).alias("h"))
        .groupBy("kind", "key")
        # Two sums, so that changes of several rows do not cancel each other.
        .agg(
            F.count("*").alias("n"),
            F.bit_xor("h").alias("h1"),
            F.sum(F.xxhash64("h").bitwiseAND(0xFFFFFFFF)).alias("h2"),
        )
        for kind, df, key, columns in kinds
    ]
    return reduce(DataFrame.unionByName, found)


def changed_keys(old: DataFrame, new: DataFrame) -> DataFrame:
    """(kind, key) of what came, went or changed."""
    was = old.select("kind", "key", F.struct("n", "h1", "h2").alias("was"))
    now = new.select("kind", "key", F.struct("n", "h1", "h2").alias("now"))
    both = was.join(now, ["kind", "key"], "full_outer")
    return both.filter(~F.col("was").eqNullSafe(F.col("now"))).select("kind", "key")


def affected_dates(changed: DataFrame, sales: DataFrame) -> DataFrame:
    """(key) of all dates to write again: changed ones and those with sales of changed products and stores."""
    dates = [changed.filter(F.col("kind") == _DATE).select("key")]
    for kind, column in ((_PRODUCT, "sku_id"), (_STORE, "store_id")):
        keys = broadcast_rows_if_few(changed.filter(F.col("kind") == kind).select(F.col("key").alias(column)))
        if keys is not None:
            slim = sales.select(column, _date_text().alias("key"))
            dates.append(slim.join(keys, column, "left_semi").select("key"))
    return reduce(DataFrame.unionByName, dates).distinct()


def _by_date(sales: DataFrame, products: DataFrame, stores: DataFrame, broadcast_bytes: int) -> DataFrame:
    """The curated rows, dealt out by date: before they are joined and widened, where no join shuffles them again."""
    overview = retail_sales_overview(sales.hint("rebalance", "date"), products, stores, broadcast_bytes)
    plan = overview._jdf.queryExecution().executedPlan().toString()
    if "SortMergeJoin" in plan or "ShuffledHashJoin" in plan:
        return retail_sales_overview(sales, products, stores, broadcast_bytes).hint("rebalance", "date")
    return overview


@contextmanager
def _only_written_partitions(spark: SparkSession) -> Iterator[None]:
    """While this holds, overwriting replaces the partitions that rows are written to and no others."""
    before = spark.conf.get(_OVERWRITE_SETTING)
    spark.conf.set(_OVERWRITE_SETTING, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(_OVERWRITE_SETTING, before)


def _drop_partition(spark: SparkSession, table: str, date: str) -> None:
    value = "null" if date == _NO_DATE else f"'{date}'"
    spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION (date = {value})")


def refresh_overview(
    spark: SparkSession,
    clean: CleanTables = CleanTables(),
    table: str = fixed.OVERVIEW_TABLE,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> Refresh:
    """Bring the curated table up to date with the clean tables; the first time builds all of it.

    The table is a plain one, partitioned by date, and not a view of versions. Its state is in `<table>__state`.
    """
    state_table = f"{table}__state"
    exists = spark.catalog.tableExists(table)
    if exists and spark.catalog.getTable(table).tableType == "VIEW":
        raise ValueError(f"{table} is replaced as a whole; drop it before it is refreshed by date")
    sales, products, stores = (spark.table(name) for name in (clean.sales, clean.products, clean.stores))
    with scratch_folder(spark, "refresh") as folder:

        def staged(df: DataFrame, name: str) -> DataFrame:
            df.write.parquet(f"{folder}/{name}")
            return spark.read.schema(df.schema).parquet(f"{folder}/{name}")

        new = staged(fingerprints(sales, products, stores), "fingerprints")
        if not (exists and spark.catalog.tableExists(state_table)):
            overview = _by_date(sales, products, stores, broadcast_bytes)
            overview.write.mode("overwrite").partitionBy("date").saveAsTable(table)
            replace_table(new, state_table)
            dates = new.filter(F.col("kind") == _DATE).count()
            return Refresh(new.count(), dates, 0)

        changed = staged(changed_keys(spark.table(state_table), new), "changed")
        n_changed = changed.count()
        if not n_changed:
            return Refresh(0, 0, 0)
        dates = staged(affected_dates(changed, sales), "dates")
        few = broadcast_rows_if_few(dates)
        written = emptied = 0
        if few is not None:
            part = sales.withColumn("_key", _date_text()).join(few, F.col("_key") == F.col("key"), "left_semi").drop("_key")
            # Written once, in place; the dates it has are told by the keys of its rows.
            filled = retail_sales_overview(part, products, stores, broadcast_bytes).select(_date_text().alias("key"))
            filled = staged(filled.distinct(), "filled")
            part = _by_date(part, products, stores, broadcast_bytes)
            with _only_written_partitions(spark):
                columns = spark.table(table).columns
                part.select(*columns).write.insertInto(table, overwrite=True)
            # One value per date of a table that is partitioned by date.
            empty = [r["key"] for r in dates.join(filled, "key", "left_anti").collect()]
            for date in empty:
                _drop_partition(spark, table, date)
            written, emptied = dates.count() - len(empty), len(empty)
        replace_table(new, state_table)
        return Refresh(n_changed, written, emptied)
