from __future__ import annotations

from datetime import date, datetime, timedelta
from decimal import Decimal
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from tallyshelf import fixed_values as fixed
from tallyshelf.operators.columns import coerce_columns, lower_case_names, nan_to_null
from tallyshelf.operators.reports import preview, require_schema, require_values, row_counts, schema_text
from tallyshelf.schemas import PRODUCTS_SCHEMA, SALES_SCHEMA, STORES_SCHEMA, as_text
from tallyshelf.sources.files import read_row_feed, read_sales_data, read_store_csv
from tallyshelf.sources.tables import read_hive_table
from tallyshelf.sources.topic import Topic
from tallyshelf.sources.warehouse import Warehouse, cuts_sql, plan_predicates, read_warehouse_table, split_predicates

INTEGER_TEXTS = [
    "3.7", "5", "x", "", "-2.9", "1e3", "1.5e3", "5d", "5.5f", ".5", " 5 ", "+7", "3000000000", "NaN", "Infinity", "-",
    "1.", "-.5", "1.x", "1.2.3", "\t4\n", " -3.9 ", "007", "2147483647.9", "-2147483648.9", "2147483648.5", None,
]


def test_integer_text_is_read_as_a_lenient_cast_would(spark):
    df = spark.createDataFrame([(i, text) for i, text in enumerate(INTEGER_TEXTS)], "i int, a string")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        wanted = [r.a for r in df.select("i", F.col("a").cast("int").alias("a")).orderBy("i").collect()]
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")
    coerced = coerce_columns(df, T.StructType().add("a", "integer"))
    assert [r.a for r in coerced.orderBy("i").collect()] == wanted


def test_a_lone_dot_is_no_integer(spark):
    assert coerce_columns(spark.createDataFrame([(".",)], "a string"), T.StructType().add("a", "integer")).first() == (None,)


def test_coercion_keeps_order_and_other_columns(spark):
    df = spark.createDataFrame([("1", "x", "2.5")], "a string, other string, b string")
    coerced = coerce_columns(df, T.StructType().add("b", "double").add("a", "integer"))
    assert coerced.columns == ["a", "other", "b"]
    assert coerced.first() == (1, "x", 2.5)


def test_coercion_finds_columns_in_any_case(spark):
    df = spark.createDataFrame([("1",)], "A string")
    assert coerce_columns(df, T.StructType().add("a", "integer")).first() == (1,)


def test_a_missing_declared_column_is_an_error(spark):
    with pytest.raises(AnalysisException):
        coerce_columns(spark.range(1), PRODUCTS_SCHEMA)


def write_lines(folder, name, *lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n")


def test_json_wildcard(spark, tmp_path):
    write_lines(tmp_path / "landed", "a.json", '{"sku_id": "k", "units_sold": "3.7", "odd": 1}')
    write_lines(tmp_path / "landed", "b.json", '{"sku_id": "m", "units_sold": "x"}', '{"sku_id": "n", "units_sold": 4}')
    write_lines(tmp_path / "landed", "c.txt", '{"sku_id": "no"}')
    df = read_sales_data(spark, f"{tmp_path}/landed/*.json", SALES_SCHEMA)
    assert df.schema == SALES_SCHEMA
    assert {r.sku_id: r.units_sold for r in df.collect()} == {"k": 3, "m": None, "n": 4}


def test_inferred_json_keeps_other_columns_and_misses_none(spark, tmp_path):
    schema = T.StructType().add("sku_id", "string").add("units_sold", "integer")
    write_lines(tmp_path / "in", "a.json", '{"sku_id": "k", "units_sold": "3", "odd": 1}')
    assert read_sales_data(spark, f"{tmp_path}/in", schema, infer=True).first().asDict() == {
        "odd": "1", "sku_id": "k", "units_sold": 3,
    }
    with pytest.raises(AnalysisException):
        read_sales_data(spark, f"{tmp_path}/in", SALES_SCHEMA, infer=True)


def test_parquet_is_read_as_declared(spark, tmp_path):
    path = f"{tmp_path}/p"
    spark.createDataFrame([("k", "x")], "sku_id string, odd string").write.parquet(path)
    row = read_sales_data(spark, path, SALES_SCHEMA, "parquet").first()
    assert row.sku_id == "k" and row.units_sold is None and "odd" not in row.asDict()


def test_other_formats_are_refused(spark):
    with pytest.raises(ValueError, match="not 'orc'"):
        read_sales_data(spark, "anywhere", SALES_SCHEMA, "orc")


def test_catalog_table_is_cast(spark):
    spark.sql("drop table if exists some_products")
    text = spark.createDataFrame([("k", "n", "c", "s", "b", "1.5", 7)], [*fixed.PRODUCTS, "extra"])
    text.write.saveAsTable("some_products")
    df = read_hive_table(spark, "some_products", PRODUCTS_SCHEMA)
    assert df.first() == ("k", "n", "c", "s", "b", 1.5, 7)


def test_store_csv_goes_by_column_names(spark, tmp_path):
    write_lines(
        tmp_path / "s", "a.csv", "longitude,city,store_id,country,channel,latitude,manager",
        '2.5,"A, ""B"" town",s1,Chile,web,1.5,x', ",c2,s2,,web,bad,y",
    )
    rows = sorted(read_store_csv(spark, f"{tmp_path}/s").collect())
    assert rows[0] == ("s1", "Chile", 'A, "B" town', "web", 1.5, 2.5)
    assert rows[1] == ("s2", None, "c2", "web", None, None)
    assert read_store_csv(spark, f"{tmp_path}/s").schema == STORES_SCHEMA


def failed(frame) -> str:
    with pytest.raises(Exception) as caught:
        frame().collect()
    return str(caught.value)


def test_files_with_other_headers_are_an_error(spark, tmp_path):
    write_lines(tmp_path / "s", "a.csv", "store_id,country,city,channel,latitude,longitude", "s1,Chile,c,web,1,2")
    write_lines(tmp_path / "s", "b.csv", "country,store_id,city,channel,latitude,longitude", "Peru,s2,c,web,1,2")
    write_lines(tmp_path / "f", "a.csv", "sku_id,units_sold", "k,3")
    write_lines(tmp_path / "f", "b.csv", "units_sold,sku_id", "3,k")
    for read in (lambda: read_store_csv(spark, f"{tmp_path}/s"), lambda: read_row_feed(spark, f"{tmp_path}/f")):
        assert "header" in failed(read).lower()
    write_lines(tmp_path / "f", "b.csv", "sku_id,units_sold", "m,4")
    assert sorted(map(tuple, read_row_feed(spark, f"{tmp_path}/f").collect())) == [("k", "3"), ("m", "4")]


def test_line_breaks_in_values(spark, tmp_path):
    write_lines(tmp_path / "f", "a.csv", "sku_id,name,units_sold", '"a', 'b",x,3', "k,y,4")
    assert "alformed" in failed(lambda: read_row_feed(spark, f"{tmp_path}/f"))
    rows = read_row_feed(spark, f"{tmp_path}/f", multi_line=True).collect()
    assert sorted(map(tuple, rows)) == [("a\nb", "x", "3"), ("k", "y", "4")]
    header = "store_id,country,city,channel,latitude,longitude"
    write_lines(tmp_path / "s", "a.csv", header, 's1,Chile,"two', 'lines",web,1,2')
    assert "alformed" in failed(lambda: read_store_csv(spark, f"{tmp_path}/s"))
    assert "alformed" in failed(lambda: read_store_csv(spark, f"{tmp_path}/s").select("store_id"))
    assert read_store_csv(spark, f"{tmp_path}/s", multi_line=True).first() == ("s1", "Chile", "two\nlines", "web", 1.0, 2.0)


def test_row_feed_is_text_and_has_no_nulls(spark, tmp_path):
    write_lines(tmp_path / "f", "a.csv", "sku_id,units_sold", " k ,3", ",4", "m,")
    rows = [tuple(r) for r in read_row_feed(spark, f"{tmp_path}/f").collect()]
    assert rows == [(" k ", "3"), ("", "4"), ("m", "")]


def test_row_feed_as_a_stream(spark, tmp_path):
    write_lines(tmp_path / "f", "a.csv", "sku_id,units_sold", "k,3")
    write_lines(tmp_path / "f", "b.csv", "sku_id,units_sold", "m,")
    schema = T.StructType().add("sku_id", "string").add("units_sold", "integer")
    with pytest.raises(ValueError):
        read_row_feed(spark, f"{tmp_path}/f", files_per_trigger=1)
    stream = read_row_feed(spark, f"{tmp_path}/f", schema, files_per_trigger=1)
    out = stream.writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/c")
    out.trigger(availableNow=True).start(f"{tmp_path}/out").awaitTermination()
    assert sorted(map(tuple, spark.read.parquet(f"{tmp_path}/out").collect())) == [("k", "3"), ("m", "")]


def test_warehouse_options():
    split = Warehouse("t", "jdbc:x", split_column="n", bounds=(1, 99), splits=8, properties={"user": "u"})
    assert split.options() == {
        "dbtable": "t", "url": "jdbc:x", "user": "u", "fetchsize": "10000", "partitionColumn": "n",
        "lowerBound": "1", "upperBound": "99", "numPartitions": "8",
    }
    connector = Warehouse("t", provider="snowflake", properties={"sfURL": "x"})
    assert connector.options() == {"dbtable": "t", "sfURL": "x"}


def test_warehouse_predicates_are_tasks():
    asked = {}

    class Reader:
        def jdbc(self, url, table, **others):
            asked.update(url=url, table=table, **others)

    source = Warehouse("t", "jdbc:x", predicates=["n < 5", "n >= 5"], properties={"user": "u"})
    read_warehouse_table(SimpleNamespace(read=Reader()), source)
    assert asked == {
        "url": "jdbc:x", "table": "t", "predicates": ["n < 5", "n >= 5"],
        "properties": {"user": "u", "fetchsize": "10000"},
    }


def planned_sizes(spark, values, kind, splits=8):
    """Rows that each predicate gets, where every row has to be got once."""
    df = spark.createDataFrame([(k, v) for k, v in enumerate(values)], f"id int, c {kind}")
    df.createOrReplaceTempView("planned")
    predicates = plan_predicates(Warehouse("planned", plan_by="c", splits=splits), spark.sql)
    got = [{r.id for r in df.filter(p).collect()} for p in predicates]
    assert sum(map(len, got)) == len(values) == len(set().union(*got))
    return [len(g) for g in got]


@pytest.mark.parametrize("kind, make", [
    ("double", lambda k: 1.1 ** k), ("long", lambda k: k * k * k), ("decimal(30,3)", lambda k: Decimal(k) ** 3),
    ("string", lambda k: f"it's {k:03}"), ("date", lambda k: date(2000, 1, 1) + timedelta(days=k * k)),
    ("timestamp", lambda k: datetime(2000, 1, 1) + timedelta(seconds=k**3)),
])
def test_planned_splits_of_a_skewed_column(spark, kind, make):
    nulls, *sizes = planned_sizes(spark, [make(k) for k in range(160)] + [None] * 5, kind)
    assert nulls == 5 and len(sizes) == 8 and max(sizes) <= 2 * min(sizes)


def test_planned_splits_of_few_values(spark):
    assert planned_sizes(spark, [None, None], "int") == [2, 0]
    assert planned_sizes(spark, [], "int") == [0, 0]
    assert planned_sizes(spark, [7] * 20, "int") == [0, 20]
    # One value is never cut, so all equal parts may start with it.
    assert planned_sizes(spark, [1] * 80 + [2, 3, 4], "int") == [0, 83]
    assert planned_sizes(spark, [1] * 40 + list(range(2, 42)), "int") == [0, 40, 10, 10, 10, 10]
    assert planned_sizes(spark, [3, 1, 2], "int", splits=50) == [0, 1, 1, 1]
    with pytest.raises(ValueError, match="does not split"):
        split_predicates("c", [True, False])


def test_a_planned_read_asks_the_warehouse_first():
    asked = []

    class Reader:
        def format(self, name):
            return self

        def options(self, **options):
            asked.append(options)
            return self

        def load(self):
            return SimpleNamespace(collect=lambda: [(1,), (5,), (9,)])

        def jdbc(self, url, table, predicates, properties):
            asked.append(predicates)

    source = Warehouse("t", "jdbc:x", plan_by="n", splits=3, properties={"user": "u"})
    read_warehouse_table(SimpleNamespace(read=Reader()), source)
    assert asked[0]["dbtable"].startswith("(SELECT MIN(value)") and asked[0]["url"] == "jdbc:x"
    assert asked[1] == ["n IS NULL", "n < 5", "n >= 5 AND n < 9", "n >= 9"]


def test_warehouse_connector_reads_any_provider(spark, tmp_path):
    spark.range(3).write.parquet(f"{tmp_path}/w")
    source = Warehouse("unused", provider="parquet", properties={"path": f"{tmp_path}/w"})
    assert read_warehouse_table(spark, source).count() == 3


def test_topic_options():
    kafka = Topic("sales", "host:9092", {"kafka.security.protocol": "SSL"})
    assert kafka.read_options() == {
        "kafka.bootstrap.servers": "host:9092", "subscribe": "sales", "startingOffsets": "earliest",
        "maxOffsetsPerTrigger": "500000", "minPartitions": "501", "kafka.security.protocol": "SSL",
    }
    assert kafka.write_options() == {
        "kafka.bootstrap.servers": "host:9092", "topic": "sales", "kafka.acks": "all", "kafka.security.protocol": "SSL",
    }
    folder = Topic("/topic", per_trigger=3)
    assert folder.read_options()["maxFilesPerTrigger"] == "3" and folder.write_options() == {}


def test_names_and_missing_values(spark):
    df = spark.createDataFrame([(1.0, float("nan"), "NaN"), (None, 2.0, None)], "A double, B float, C string")
    cleaned = nan_to_null(lower_case_names(df))
    assert cleaned.columns == ["a", "b", "c"]
    assert [tuple(r) for r in cleaned.collect()] == [(1.0, None, "NaN"), (None, 2.0, None)]


def test_reports(spark):
    df = spark.createDataFrame([(2, "b"), (1, None)], "n int, t string")
    assert {r.dataset: r.n_rows for r in row_counts({"x": df, "y": df.limit(0)}).collect()} == {"x": 2, "y": 0}
    assert [r.n for r in preview(df, 1, ("n",), order_by=("n",)).collect()] == [1]
    assert preview(df, 5).count() == 2
    assert schema_text(df) == "n: int\nt: string"
    assert require_schema(df, df.schema) is df
    with pytest.raises(ValueError):
        require_schema(df, as_text(df.schema))


def test_required_values_are_searched_beyond_the_first_rows(spark):
    late = F.when(F.col("id") == 99, F.col("id")).alias("late")
    df = spark.range(100, numPartitions=5).select(late, F.lit(None).alias("never"))
    assert require_values(df, ("late",)) is df
    with pytest.raises(ValueError, match="never"):
        require_values(df, ("late", "never"))
    require_values(df.limit(0), ("never",))


@pytest.mark.parametrize("splits", [1, 3, 8, 50])
def test_cuts_are_those_of_ntile_from_counted_values(spark, splits):
    values = [None, None, *[n % 7 for n in range(40)], *range(100, 129), *[500] * 31]
    spark.createDataFrame([(v,) for v in values], "v int").createOrReplaceTempView("cut_values")
    for table in ("cut_values", "(SELECT v FROM cut_values WHERE v < 3) few", "(SELECT v FROM cut_values WHERE v = 110) one"):
        cuts = spark.sql(cuts_sql(table, "v", splits))
        parts = f"SELECT v, NTILE({splits}) OVER (ORDER BY v) AS part FROM {table} WHERE v IS NOT NULL"
        wanted = spark.sql(f"SELECT DISTINCT MIN(v) FROM ({parts}) GROUP BY part")
        assert sorted(r[0] for r in cuts.collect()) == sorted(r[0] for r in wanted.collect())
        plan = cuts._jdf.queryExecution().optimizedPlan().toString()
        assert "Aggregate" in plan[plan.index("Window") :], "only counted values are put in order"
    spark.catalog.dropTempView("cut_values")
