"""One query per operator over the test tables: `(spark, sf_dir) -> DataFrame`.

Queries that need files, tables or a topic write them from the test tables to the shared scratch
folder first. Dates are rendered as ISO text, so that both engines' clients show the same value.
"""

from __future__ import annotations

import atexit
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyshelf import fixed_values as fixed
from tallyshelf.checks.feeds import raw_products, raw_sales, raw_stores, sales_text, table
from tallyshelf.functions import labels, money
from tallyshelf.functions.casting import to_date
from tallyshelf.functions.envelope import envelope_rows
from tallyshelf.operators.accounting import REJECTIONS_DDL, RESCUED, coerce_rescued, rejections
from tallyshelf.operators.columns import coerce_columns, nan_to_null
from tallyshelf.operators.dedup import (
    count_copies,
    distinct_by_fingerprint,
    distinct_by_rescan,
    distinct_rows,
    one_per_key,
    with_fingerprint,
)
from tallyshelf.operators.envelopes import (
    pack_envelopes,
    parse_messages,
    to_messages,
    unpack_envelopes,
    usable_envelopes,
)
from tallyshelf.operators.filters import has_keys, inside, not_negative, positive, zero_fill
from tallyshelf.operators.joins import join_sources
from tallyshelf.operators.reports import preview, row_counts, union_rows
from tallyshelf.operators.split_join import join_sources_split, save_split
from tallyshelf.plans.clean import (
    CleanTables,
    clean_products,
    clean_sales,
    clean_sales_staged,
    clean_stores,
    normalize_products,
    normalize_sales,
    normalize_stores,
    product_rules,
    sales_rules,
    save_clean_tables,
    store_rules,
)
from tallyshelf.plans.dimensions import append_products, append_stores, load_products, load_stores, product_rows
from tallyshelf.plans.incremental import refresh_overview
from tallyshelf.plans.overview import apply_transformations, retail_sales_overview, save_overview
from tallyshelf.plans.publish import publish_rows
from tallyshelf.plans.stages import Settings, run_stages
from tallyshelf.schemas import SALES_SCHEMA, PRODUCTS_SCHEMA
from tallyshelf.session import remove_path, scratch_root
from tallyshelf.sinks.csv_files import export_csv
from tallyshelf.sinks.tables import save_table
from tallyshelf.sinks.topic import write_topic
from tallyshelf.sinks.versions import replace_table
from tallyshelf.sources.files import read_row_feed, read_sales_data, read_store_csv
from tallyshelf.sources.tables import read_hive_table
from tallyshelf.sources.topic import Topic, read_topic
from tallyshelf.sources.warehouse import Warehouse, plan_predicates
from tallyshelf.streaming.landing import (
    Landing,
    compact,
    land,
    landed_batches,
    landing_gaps,
    landing_totals,
    read_landed,
    read_landed_text,
    read_quarantine,
    snapshot,
    write_batch_files,
)

Query = Callable[[SparkSession, str], DataFrame]


def _dates_as_text(df: DataFrame) -> DataFrame:
    return df.withColumns({
        f.name: F.col(f.name).cast("string") for f in df.schema.fields if isinstance(f.dataType, T.DateType)
    })


def _counted(df: DataFrame, *columns: str) -> DataFrame:
    return df.groupBy(*columns).agg(F.count("*").alias("n"))


def _database(spark: SparkSession) -> str:
    """A database of its own in the scratch space, dropped when the process ends."""
    name = f"check_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{scratch_path(spark, name)}'")
    _DATABASES.append((spark, name))
    return name


# One scratch folder for all queries of a process, and the databases in it.
_RUN = f"checks-{uuid.uuid4().hex}"
_FOLDERS: dict[str, SparkSession] = {}
_DATABASES: list[tuple[SparkSession, str]] = []


def scratch_path(spark: SparkSession, label: str) -> str:
    folder = f"{scratch_root(spark)}/{_RUN}"
    _FOLDERS[folder] = spark
    return f"{folder}/{label}-{uuid.uuid4().hex}"


@atexit.register
def _clean_up() -> None:
    """At the end of the process, as queries return frames that still read their scratch data."""
    for spark, name in _DATABASES:
        if spark.sparkContext._jsc is not None:
            spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")
    for folder, spark in _FOLDERS.items():
        if spark.sparkContext._jsc is not None:
            remove_path(spark, folder)


# Whole jobs


def q_clean_products(spark: SparkSession, sf: str) -> DataFrame:
    return clean_products(raw_products(spark, sf))


def q_clean_stores(spark: SparkSession, sf: str) -> DataFrame:
    return clean_stores(raw_stores(spark, sf))


def q_clean_sales(spark: SparkSession, sf: str) -> DataFrame:
    return _dates_as_text(clean_sales(raw_sales(spark, sf)))


def _joined(spark: SparkSession, sf: str) -> DataFrame:
    return join_sources(
        clean_sales(raw_sales(spark, sf)), clean_products(raw_products(spark, sf)), clean_stores(raw_stores(spark, sf))
    )


def q_join_sources(spark: SparkSession, sf: str) -> DataFrame:
    return _dates_as_text(_joined(spark, sf))


def q_join_sources_split(spark: SparkSession, sf: str) -> DataFrame:
    """A third of all sales on one product, and products above the bound for broadcasts."""
    sku = F.when(F.col("lead_time_days") % 3 == 0, "SKU-2").otherwise(F.col("sku_id"))
    sales = clean_sales(raw_sales(spark, sf)).withColumn("sku_id", sku)
    split = save_split(sales, "sku_id", f"{_database(spark)}.sales", buckets=8, share=0.1)
    joined = join_sources_split(split, q_clean_products(spark, sf), q_clean_stores(spark, sf), broadcast_bytes=10_000)
    return _dates_as_text(joined)


def q_enriched(spark: SparkSession, sf: str) -> DataFrame:
    return _dates_as_text(apply_transformations(_joined(spark, sf)))


def _overview(spark: SparkSession, sf: str) -> DataFrame:
    return retail_sales_overview(
        clean_sales(raw_sales(spark, sf)), clean_products(raw_products(spark, sf)), clean_stores(raw_stores(spark, sf))
    )


def q_retail_sales_overview(spark: SparkSession, sf: str) -> DataFrame:
    return _dates_as_text(_overview(spark, sf))


# Normalising and typing


def q_normalize_keys(spark: SparkSession, sf: str) -> DataFrame:
    return _counted(normalize_sales(raw_sales(spark, sf)), "store_id", "sku_id", "supplier_id")


def q_trim_text(spark: SparkSession, sf: str) -> DataFrame:
    return _counted(normalize_products(raw_products(spark, sf)), "sku_name", "brand")


def q_initcap_category(spark: SparkSession, sf: str) -> DataFrame:
    return _counted(normalize_products(raw_products(spark, sf)), "category", "subcategory")


def q_round_price(spark: SparkSession, sf: str) -> DataFrame:
    return normalize_products(raw_products(spark, sf)).select("sku_id", "list_price")


def q_parse_date(spark: SparkSession, sf: str) -> DataFrame:
    dated = raw_sales(spark, sf).select(F.col("date").alias("text"), to_date("date").alias("date"))
    return _dates_as_text(_counted(dated, "text", "date"))


def q_coerce_types(spark: SparkSession, sf: str) -> DataFrame:
    return coerce_columns(sales_text(spark, sf), SALES_SCHEMA)


def q_coerce_decimal_text(spark: SparkSession, sf: str) -> DataFrame:
    text = table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.col("l_extendedprice").cast("string").alias("whole"),
        F.col("l_returnflag").alias("no_number"),
        F.col("l_discount").cast("string").alias("share"),
    )
    schema = T.StructType().add("whole", "integer").add("no_number", "integer").add("share", "double")
    return coerce_columns(text, schema)


# Filters


def q_filter_keys(spark: SparkSession, sf: str) -> DataFrame:
    sales = normalize_sales(raw_sales(spark, sf)).filter(has_keys(*fixed.SALES_KEYS))
    return _dates_as_text(sales.select(*fixed.SALES_KEYS, "units_sold"))


def q_filter_product_key(spark: SparkSession, sf: str) -> DataFrame:
    return normalize_products(raw_products(spark, sf)).filter(has_keys("sku_id")).select("sku_id", "sku_name")


def q_filter_price(spark: SparkSession, sf: str) -> DataFrame:
    return normalize_products(raw_products(spark, sf)).filter(positive("list_price"))


def q_filter_geo(spark: SparkSession, sf: str) -> DataFrame:
    stores = normalize_stores(raw_stores(spark, sf))
    return stores.filter(inside("latitude", fixed.LATITUDE_RANGE) & inside("longitude", fixed.LONGITUDE_RANGE))


def q_filter_store_key(spark: SparkSession, sf: str) -> DataFrame:
    return normalize_stores(raw_stores(spark, sf)).filter(has_keys("store_id")).select("store_id", "country")


def q_filter_nonneg(spark: SparkSession, sf: str) -> DataFrame:
    sales = normalize_sales(raw_sales(spark, sf)).filter(not_negative(*fixed.SALES_MEASURES))
    return sales.select("store_id", "sku_id", *fixed.SALES_MEASURES)


def q_fill_after_filter(spark: SparkSession, sf: str) -> DataFrame:
    line = F.col("l_linenumber")
    amount = F.when(line == 3, float("nan")).when(line != 5, F.col("l_extendedprice")).alias("amount")
    amounts = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", amount)
    return zero_fill(amounts.filter(not_negative("amount")), "amount")


def q_rejections(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of each feed that each rule keeps out, counted by one pass over the feed."""
    return union_rows(
        rejections(normalize_products(raw_products(spark, sf)), "products", product_rules()),
        rejections(normalize_stores(raw_stores(spark, sf)), "stores", store_rules()),
        rejections(normalize_sales(raw_sales(spark, sf)), "sales", sales_rules()),
    )


def q_clean_report(spark: SparkSession, sf: str) -> DataFrame:
    """The same counts as observed while the clean tables are written, with the tables' rows."""
    database = _database(spark)
    tables = CleanTables(f"{database}.products", f"{database}.stores", f"{database}.sales")
    done = save_clean_tables(spark, raw_products(spark, sf), raw_stores(spark, sf), raw_sales(spark, sf), tables)
    rows = [*done.rejected, *((t.split(".")[1], "written", v.n_rows) for t, v in done.versions.items())]
    return spark.createDataFrame(rows, REJECTIONS_DDL)


def q_coerce_rescued(spark: SparkSession, sf: str) -> DataFrame:
    """Text that fits no integer column, whole and in part, with the rows' numbers."""
    text = table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.col("l_returnflag").alias("flag"),
        F.when(F.col("l_linenumber") == 3, "3e2x").otherwise(F.col("l_quantity").cast("string")).alias("amount"),
        F.when(F.col("l_linenumber") != 2, F.col("l_linestatus")).alias("status"),
    )
    schema = T.StructType().add("flag", "integer").add("amount", "double").add("status", "integer")
    rescued = coerce_rescued(text, schema).select(F.explode(RESCUED).alias("name", "text"))
    return _counted(rescued, "name", "text")


# Duplicates


def q_dedup_products(spark: SparkSession, sf: str) -> DataFrame:
    return one_per_key(normalize_products(raw_products(spark, sf)), "sku_id")


def q_dedup_stores(spark: SparkSession, sf: str) -> DataFrame:
    """Every store a second time in another city."""
    stores = normalize_stores(raw_stores(spark, sf))
    return one_per_key(stores.unionByName(_moved(stores)), "store_id")


def _moved(stores: DataFrame) -> DataFrame:
    return stores.withColumn("city", F.concat(F.lit("A"), "city"))


def q_dedup_sales(spark: SparkSession, sf: str) -> DataFrame:
    return _dates_as_text(distinct_by_rescan(normalize_sales(raw_sales(spark, sf))))


def q_dedup_sales_staged(spark: SparkSession, sf: str) -> DataFrame:
    """As dedup_sales, but only rows whose fingerprint occurs several times are shuffled."""
    path = scratch_path(spark, "sales")
    staged = with_fingerprint(normalize_sales(raw_sales(spark, sf)))
    staged.write.parquet(path)
    return _dates_as_text(distinct_by_fingerprint(spark.read.schema(staged.schema).parquet(path)))


def q_clean_sales_staged(spark: SparkSession, sf: str) -> DataFrame:
    return _dates_as_text(clean_sales_staged(raw_sales(spark, sf), scratch_path(spark, "sales")))


def q_distinct_fetch(spark: SparkSession, sf: str) -> DataFrame:
    stores = raw_stores(spark, sf)
    return count_copies(stores.unionByName(stores))


# Labels and measures


def q_season(spark: SparkSession, sf: str) -> DataFrame:
    sales = raw_sales(spark, sf).select("temperature", "rain_mm", labels.season().alias("season"))
    return _counted(sales, *sales.columns)


def q_weekday_name(spark: SparkSession, sf: str) -> DataFrame:
    sales = raw_sales(spark, sf).select("weekday", labels.weekday_name().alias("weekday_name"))
    return _counted(sales, *sales.columns)


def q_discount_band(spark: SparkSession, sf: str) -> DataFrame:
    sales = raw_sales(spark, sf).select("discount_pct", labels.discount_band().alias("discount_band"))
    return _counted(sales, *sales.columns)


def q_inventory_risk(spark: SparkSession, sf: str) -> DataFrame:
    inputs = ("stock_out_flag", "stock_on_hand", "units_sold", "lead_time_days")
    sales = raw_sales(spark, sf).select(*inputs, labels.inventory_risk().alias("inventory_risk"))
    return _counted(sales, *sales.columns)


def q_discount_amount(spark: SparkSession, sf: str) -> DataFrame:
    return raw_sales(spark, sf).select("gross_sales", "net_sales", money.discount_amount().alias("discount_amount"))


def q_total_cost(spark: SparkSession, sf: str) -> DataFrame:
    return raw_sales(spark, sf).select("purchase_cost", "units_sold", money.total_cost().alias("total_cost"))


def q_profit_amount(spark: SparkSession, sf: str) -> DataFrame:
    costed = raw_sales(spark, sf).withColumn("total_cost", money.total_cost())
    return costed.select("net_sales", "purchase_cost", "units_sold", money.profit_amount().alias("profit_amount"))


def q_revenue_per_unit(spark: SparkSession, sf: str) -> DataFrame:
    return raw_sales(spark, sf).select("net_sales", "units_sold", money.revenue_per_unit().alias("revenue_per_unit"))


# Sources and sinks, read back

# Whole feeds as text are several times their tables' size; compressed, as feeds are kept, they are not.
_GZIP = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}


def q_json_scan(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "json")
    sales_text(spark, sf).write.options(**_GZIP).json(path)
    return read_sales_data(spark, f"{path}/*.json.gz", SALES_SCHEMA)


def q_json_scan_inferred(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "json")
    sales_text(spark, sf).withColumn("note", F.lit("x")).write.options(**_GZIP).json(path)
    return read_sales_data(spark, f"{path}/*.json.gz", SALES_SCHEMA, infer=True)


def q_parquet_scan(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "parquet")
    raw_sales(spark, sf).drop("margin_pct").withColumn("note", F.lit("x")).write.parquet(path)
    return read_sales_data(spark, path, SALES_SCHEMA, "parquet")


def q_catalog_read(spark: SparkSession, sf: str) -> DataFrame:
    name = f"{_database(spark)}.products"
    priced = raw_products(spark, sf).withColumns({"list_price": F.col("list_price").cast("string"), "extra": F.lit(1)})
    priced.write.saveAsTable(name)
    return read_hive_table(spark, name, PRODUCTS_SCHEMA)


def _stores_csv(spark: SparkSession, sf: str) -> str:
    """Every store row twice, columns in another order than declared."""
    path = scratch_path(spark, "stores")
    stores = raw_stores(spark, sf)
    stores.unionByName(stores).select(*reversed(stores.columns)).write.option("header", True).option(
        "ignoreLeadingWhiteSpace", False
    ).option("ignoreTrailingWhiteSpace", False).csv(path)
    return path


def q_store_csv(spark: SparkSession, sf: str) -> DataFrame:
    return distinct_rows(read_store_csv(spark, _stores_csv(spark, sf)))


def _sales_csv(spark: SparkSession, sf: str) -> str:
    path = scratch_path(spark, "feed")
    sales_text(spark, sf).write.options(**_GZIP).option("header", True).option("ignoreLeadingWhiteSpace", False).option(
        "ignoreTrailingWhiteSpace", False
    ).csv(path)
    return path


def q_row_feed(spark: SparkSession, sf: str) -> DataFrame:
    feed = coerce_columns(read_row_feed(spark, _sales_csv(spark, sf)), SALES_SCHEMA)
    return _counted(feed, *feed.columns)


def _broken_lines(column: str) -> Column:
    """Text with quotes, a comma and line breaks in every third row."""
    return F.when(F.col("number") % 3 == 0, F.concat(F.lit('say "'), F.col(column), F.lit('",\nthen\nstop')))


def q_row_feed_line_breaks(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "feed")
    parts = table(spark, sf, "part").select(F.col("p_partkey").alias("number"), "p_name", "p_brand")
    text = parts.select(
        F.col("number").cast("string").alias("number"),
        F.coalesce(_broken_lines("p_name"), "p_name").alias("name"),
        F.col("p_brand").alias("brand"),
    )
    text.write.options(header=True, quoteAll=True, escape='"').csv(path)
    return read_row_feed(spark, path, multi_line=True)


def q_store_csv_line_breaks(spark: SparkSession, sf: str) -> DataFrame:
    """Stores whose city has two lines, columns in another order than declared."""
    path = scratch_path(spark, "stores")
    stores = raw_stores(spark, sf).withColumn("number", F.regexp_extract("store_id", r"(\d+)", 1).cast("int"))
    stores = stores.withColumn("city", F.coalesce(_broken_lines("city"), "city")).drop("number")
    keep_blanks = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    stores.select(*reversed(stores.columns)).write.options(header=True, quoteAll=True, escape='"', nullValue="", emptyValue="", **keep_blanks).csv(path)
    return read_store_csv(spark, path, multi_line=True)


def q_table_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    database = _database(spark)
    tables = CleanTables(f"{database}.products", f"{database}.stores", f"{database}.sales")
    save_clean_tables(spark, raw_products(spark, sf), raw_stores(spark, sf), raw_sales(spark, sf), tables)
    save_overview(spark, tables, f"{database}.overview")
    return _dates_as_text(spark.table(f"{database}.overview"))


def q_overview_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """Built from other feeds, then refreshed with the right ones: sales, products and stores that came, went and changed."""
    database = _database(spark)
    tables = CleanTables(f"{database}.products", f"{database}.stores", f"{database}.sales")
    products, stores, sales = raw_products(spark, sf), raw_stores(spark, sf), raw_sales(spark, sf)
    number = F.regexp_extract("sku_id", r"(\d+)", 1).cast("int")
    other_products = products.filter(F.coalesce(number % 19 != 3, F.lit(True))).withColumn(
        "brand", F.when(number % 23 == 1, "other").otherwise(F.col("brand"))
    )
    other_stores = stores.withColumn("channel", F.when(F.col("store_id").endswith("7 "), "other").otherwise(F.col("channel")))
    later = F.when(F.col("month") == 5, F.concat(F.lit("2"), F.substring("date", 2, 99)))
    other_sales = sales.filter(F.col("month") != 3).withColumn("date", F.coalesce(later, "date"))
    save_clean_tables(spark, other_products, other_stores, other_sales, tables)
    refresh_overview(spark, tables, f"{database}.overview")
    save_clean_tables(spark, products, stores, sales, tables)
    refresh_overview(spark, tables, f"{database}.overview")
    return _dates_as_text(spark.table(f"{database}.overview").select(*fixed.OVERVIEW_COLUMNS))


def q_replaced_table(spark: SparkSession, sf: str) -> DataFrame:
    """A table that is replaced twice, and a third time by a write that fails in the middle."""
    name = f"{_database(spark)}.products"
    products = raw_products(spark, sf)
    replace_table(products, name)
    replace_table(clean_products(products), name)
    torn = F.when(F.col("sku_name") == "dup", F.raise_error(F.lit("torn"))).otherwise(F.col("brand"))
    try:
        replace_table(products.withColumn("brand", torn), name)
    except Exception as error:
        if "torn" not in str(error):
            raise
    return spark.table(name)


def q_partitioned_table(spark: SparkSession, sf: str) -> DataFrame:
    saved = save_table(_overview(spark, sf), f"{_database(spark)}.overview", partition_by=["country"])
    return saved.groupBy("country").agg(F.count("*").alias("n"), F.countDistinct("sku_id").alias("n_skus"))


def q_csv_parallel_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "export")
    curated = _overview(spark, sf)
    export_csv(curated, path, compression="gzip")
    return _dates_as_text(spark.read.option("header", True).schema(curated.schema).csv(path))


def q_preview_ordered(spark: SparkSession, sf: str) -> DataFrame:
    columns = ("date", "store_id", "sku_id", "year", "month")
    return preview(raw_sales(spark, sf), 5, columns, order_by=columns)


# Dimension loads


def q_dimension_append(spark: SparkSession, sf: str) -> DataFrame:
    name = f"{_database(spark)}.stores"
    stores = raw_stores(spark, sf)
    append_stores(spark, stores.unionByName(stores), name)
    append_stores(spark, stores, name)
    return _counted(spark.table(name), *stores.columns)


def q_dimension_append_unseen(spark: SparkSession, sf: str) -> DataFrame:
    """The same stores twice in one load and in a second one, then all but some of them with others."""
    name = f"{_database(spark)}.stores"
    stores = raw_stores(spark, sf)
    for load in (stores.unionByName(stores), stores, stores.filter("country is not null").unionByName(_moved(stores))):
        append_stores(spark, load, name, unseen_only=True)
    return _counted(spark.table(name), *stores.columns)


def q_load_stores(spark: SparkSession, sf: str) -> DataFrame:
    name = f"{_database(spark)}.stores"
    load_stores(spark, _stores_csv(spark, sf), name)
    return spark.table(name)


def _warehouse_rows(spark: SparkSession, sf: str) -> DataFrame:
    products = raw_products(spark, sf)
    return products.select(*[F.col(c).alias(c.upper()) for c in products.columns], F.lit("x").alias("LOADED_BY"))


def q_load_products(spark: SparkSession, sf: str) -> DataFrame:
    """From files, as a JDBC read needs a database."""
    name, path = f"{_database(spark)}.products", scratch_path(spark, "warehouse")
    _warehouse_rows(spark, sf).write.parquet(path)
    load_products(spark, Warehouse("products", provider="parquet", properties={"path": path}), name)
    return spark.table(name)


def q_warehouse_splits(spark: SparkSession, sf: str) -> DataFrame:
    """Rows that each of eight planned splits reads of a column in which half of the rows are near each other."""
    view = f"prices_{uuid.uuid4().hex}"
    price = F.when(F.col("l_linenumber") != 7, F.col("l_extendedprice") * F.when(F.col("l_orderkey") % 2 == 0, 1).otherwise(1000))
    table(spark, sf, "lineitem").select(price.alias("price")).createTempView(view)
    predicates = plan_predicates(Warehouse(view, plan_by="price", splits=8), spark.sql)
    parts = [spark.table(view).filter(p).agg(F.count("*").alias("n_rows")).withColumn("split", F.lit(k)) for k, p in enumerate(predicates)]
    return union_rows(*parts)


def q_upper_to_lower_columns(spark: SparkSession, sf: str) -> DataFrame:
    return product_rows(_warehouse_rows(spark, sf))


def q_nan_to_null(spark: SparkSession, sf: str) -> DataFrame:
    price = F.when(F.col("p_partkey") % 7 == 0, float("nan")).otherwise(F.col("p_retailprice"))
    return nan_to_null(table(spark, sf, "part").select("p_partkey", price.alias("list_price")))


def q_union_all(spark: SparkSession, sf: str) -> DataFrame:
    products = raw_products(spark, sf)
    return union_rows(products, products)


# Counts


def q_row_counts(spark: SparkSession, sf: str) -> DataFrame:
    return row_counts({
        "raw_products": raw_products(spark, sf),
        "raw_stores": raw_stores(spark, sf),
        "raw_sales": raw_sales(spark, sf),
        "clean_products": q_clean_products(spark, sf),
        "clean_stores": q_clean_stores(spark, sf),
        "clean_sales": q_clean_sales(spark, sf),
        "overview": _overview(spark, sf),
    })


# Envelopes and landing


def _envelopes(spark: SparkSession, sf: str) -> DataFrame:
    return pack_envelopes(sales_text(spark, sf), scratch_path(spark, "envelopes"))


def q_envelope_sizes(spark: SparkSession, sf: str) -> DataFrame:
    return _envelopes(spark, sf).select("batch_id", F.size("rows").alias("n_rows"))


def q_batch_key(spark: SparkSession, sf: str) -> DataFrame:
    parsed = parse_messages(to_messages(_envelopes(spark, sf)), SALES_SCHEMA)
    return usable_envelopes(parsed, "key").select("key", "batch_id", F.size("rows").alias("n_rows"))


def q_envelope_explode(spark: SparkSession, sf: str) -> DataFrame:
    parsed = parse_messages(to_messages(_envelopes(spark, sf)), SALES_SCHEMA)
    return coerce_columns(unpack_envelopes(usable_envelopes(parsed)).drop("batch_id"), SALES_SCHEMA)


def q_envelope_edges(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.col("o_orderkey") % 4
    value = (
        F.when(kind == 0, F.format_string('{"batch_id": %d, "rows": [{"sku_id": "a"}]}', "o_orderkey"))
        .when(kind == 1, F.format_string('{"batch_id": %d}', "o_orderkey"))
        .when(kind == 2, F.lit('{"rows": []}'))
        .otherwise(F.format_string("no json %d", "o_orderkey"))
    )
    parsed = parse_messages(table(spark, sf, "orders").select(value.alias("value")), SALES_SCHEMA)
    edges = parsed.select(
        F.col("parsed.batch_id").alias("batch_id"), "usable", F.size(envelope_rows("parsed")).alias("n_rows")
    )
    return _counted(edges, *edges.columns)


def _topic_and_landing(spark: SparkSession, file_format: str = "json") -> tuple[Topic, Landing]:
    path = scratch_path(spark, "landing")
    compression = "gzip" if file_format == "json" else "zstd"
    # What is landed is not read from the topic again: its files go with the next micro-batch.
    topic = Topic(f"{path}/topic", options={"cleanSource": "delete"})
    return topic, Landing(f"{path}/landed", SALES_SCHEMA, file_format, compression)


def _landed(spark: SparkSession, sf: str, file_format: str = "json") -> tuple[Topic, Landing]:
    topic, landing = _topic_and_landing(spark, file_format)
    publish_rows(spark, sales_text(spark, sf), topic)
    land(read_topic(spark, topic), landing)
    return topic, landing


def q_landed_rows(spark: SparkSession, sf: str) -> DataFrame:
    return read_landed(spark, _landed(spark, sf)[1])


def q_landed_parquet_rows(spark: SparkSession, sf: str) -> DataFrame:
    return read_landed(spark, _landed(spark, sf, "parquet")[1])


def q_landed_batch_counts(spark: SparkSession, sf: str) -> DataFrame:
    return landed_batches(spark, _landed(spark, sf)[1])


def q_landing_totals(spark: SparkSession, sf: str) -> DataFrame:
    return landing_totals(spark, _landed(spark, sf)[1])


def q_redelivered_rows(spark: SparkSession, sf: str) -> DataFrame:
    """All batches are sent twice and then once more with other content: the last one counts."""
    topic, landing = _landed(spark, sf)
    sales = raw_sales(spark, sf).withColumn("promo_flag", F.col("promo_flag") + 1)
    publish_rows(spark, sales_text(spark, sf), topic)
    land(read_topic(spark, topic), landing)
    publish_rows(spark, sales.select(*[F.col(c).cast("string") for c in sales.columns]), topic)
    land(read_topic(spark, topic), landing)
    return read_landed(spark, landing)


def q_compacted_rows(spark: SparkSession, sf: str) -> DataFrame:
    """The same feed three times, then compacted."""
    topic, landing = _landed(spark, sf)
    for _ in range(2):
        publish_rows(spark, sales_text(spark, sf), topic)
        land(read_topic(spark, topic), landing)
    compact(spark, landing)
    return read_landed(spark, landing)


def q_snapshot_rows(spark: SparkSession, sf: str) -> DataFrame:
    """A reader's snapshot, read after other content was landed and compacted."""
    topic, landing = _landed(spark, sf)
    before = snapshot(spark, landing)
    sales = raw_sales(spark, sf).withColumn("promo_flag", F.col("promo_flag") + 1)
    publish_rows(spark, sales.select(*[F.col(c).cast("string") for c in sales.columns]), topic)
    land(read_topic(spark, topic), landing)
    compact(spark, landing, grace_seconds=3600)
    return read_landed(spark, landing, before)


def q_landing_gaps(spark: SparkSession, sf: str) -> DataFrame:
    """Every second five batches are never sent, and of the others all but each fifth once more after a compaction."""
    topic, landing = _topic_and_landing(spark)
    messages = to_messages(_envelopes(spark, sf))
    number = F.regexp_extract("key", r"(\d+)$", 1).cast("int")
    sent = F.floor(number / 5) % 2 == 0
    for chosen in (sent, sent & (number % 5 != 0)):
        write_topic(messages.filter(chosen), topic)
        land(read_topic(spark, topic), landing)
        compact(spark, landing)
    return landing_gaps(spark, landing)


def q_resent_empty(spark: SparkSession, sf: str) -> DataFrame:
    """Every second batch is sent again without rows: the manifest and the rows agree on that."""
    topic, landing = _landed(spark, sf)
    batches = landed_batches(spark, landing).filter(F.col("batch_id") % 2 == 0).select("batch_id")
    write_topic(to_messages(batches.withColumn("rows", F.array().cast("array<string>"))), topic)
    land(read_topic(spark, topic), landing)
    lines = read_landed_text(spark, landing).groupBy("batch_id").agg(F.count("*").alias("n_lines"))
    return landed_batches(spark, landing).join(lines, "batch_id", "left").fillna(0, ["n_lines"])


def q_quarantined_messages(spark: SparkSession, sf: str) -> DataFrame:
    topic, landing = _topic_and_landing(spark)
    kind = F.col("o_orderkey") % 3
    value = (
        F.when(kind == 0, F.format_string('{"batch_id": %d, "rows": [{"sku_id": "a"}]}', "o_orderkey"))
        .when(kind == 1, F.lit('{"rows": [{"sku_id": "a"}]}'))
        .otherwise(F.format_string('{"batch_id": %d, "rows": "torn', "o_orderkey"))
    )
    key = F.format_string("order-%d", "o_orderkey")
    write_topic(table(spark, sf, "orders").select(key.alias("key"), value.alias("value")), topic)
    land(read_topic(spark, topic), landing)
    return read_quarantine(spark, landing)


def q_batch_files(spark: SparkSession, sf: str) -> DataFrame:
    _, landing = _landed(spark, sf)
    path = scratch_path(spark, "batches")
    write_batch_files(spark, landing, path, compression="gzip")
    return spark.read.schema("sku_id string, batch string").json(path).groupBy("batch").agg(F.count("*").alias("n_rows"))


def q_staged_flow(spark: SparkSession, sf: str) -> DataFrame:
    """Publish, land, clean, overview and export in one go; the exported CSV read back."""
    database = _database(spark)
    topic, landing = _topic_and_landing(spark)
    settings = Settings(
        feed=_sales_csv(spark, sf),
        topic=topic,
        landing=landing,
        export=scratch_path(spark, "export"),
        product_table=f"{database}.products_details",
        store_table=f"{database}.store_locations",
        clean=CleanTables(f"{database}.clean_products", f"{database}.clean_stores", f"{database}.clean_sales"),
        overview_table=f"{database}.retail_sales_overview",
    )
    append_products(spark, _warehouse_rows(spark, sf), settings.product_table)
    append_stores(spark, raw_stores(spark, sf), settings.store_table)
    run_stages(spark, settings)
    schema = spark.table(settings.overview_table).schema
    return _dates_as_text(spark.read.option("header", True).schema(schema).csv(settings.export))


def queries() -> dict[str, Query]:
    return {name.removeprefix("q_"): query for name, query in globals().items() if name.startswith("q_")}
