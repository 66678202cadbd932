from __future__ import annotations

import glob

import pytest

from tallyshelf import __main__ as command
from tallyshelf.__main__ import _parser, _settings, main
from tallyshelf.checks import feeds
from tallyshelf.plans.dimensions import append_products, append_stores

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture
def database(spark):
    """The default tables, in a catalog of their own."""
    spark.sql("create database if not exists stages")
    spark.sql("use stages")
    yield spark
    spark.sql("use default")
    spark.sql("drop database stages cascade")


def test_missing_paths_are_named(capsys):
    with pytest.raises(SystemExit):
        main(["land", "--topic", "t"])
    assert "land needs --landing" in capsys.readouterr().err


def test_all_stages_from_the_command_line(database, tmp_path, capsys):
    spark = database
    append_products(spark, feeds.raw_products(spark, SF_DIR))
    append_stores(spark, feeds.raw_stores(spark, SF_DIR))
    text = feeds.sales_text(spark, SF_DIR)
    text.write.options(header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(f"{tmp_path}/feed")
    paths = [f"--{name}={tmp_path}/{name}" for name in ("feed", "topic", "landing", "export")]

    main(["all", "--no-hive", *paths])
    clean, curated = spark.table("clean_sales").count(), spark.table("retail_sales_overview").count()
    assert 0 < curated <= clean < text.count()
    told = capsys.readouterr().out
    assert "publish: 7 batches, " in told and f"land: 7 batches, {text.count()} rows" in told
    assert f"clean: clean_sales {clean} rows" in told and f"export: {curated} rows exported" in told
    assert f"overview: retail_sales_overview {curated} rows" in told
    assert glob.glob(f"{tmp_path}/export/part-*.csv")

    # Publishing and landing again adds nothing: the batches carry the same numbers.
    main(["publish", "--no-hive", *paths])
    main(["land", "--no-hive", *paths])
    main(["clean", "--no-hive", *paths])
    assert f"land: 7 batches, {text.count()} rows" in capsys.readouterr().out
    main(["compact", "--no-hive", *paths])
    assert f"compact: 7 batches, {text.count()} rows" in capsys.readouterr().out
    assert spark.table("clean_sales").count() == clean

    main(["overview", "--no-hive", *paths, "--partition-by", "country"])
    main(["export", "--no-hive", *paths])
    exported = spark.read.option("header", True).csv(f"{tmp_path}/export")
    assert exported.count() == curated and exported.columns[:2] == ["date", "weekday_name"]


def test_a_run_id_separates_folders():
    args = _parser().parse_args(["all", "--topic=t", "--landing=l", "--run-id=r7"])
    assert (_settings(args).topic.name, _settings(args).landing.path) == ("t/r7", "l/r7")
    args = _parser().parse_args(["all", "--topic=t", "--landing=l", "--run-id=r7", "--servers=h:1"])
    assert (_settings(args).topic.name, _settings(args).landing.path) == ("t", "l/r7")


def test_warehouse_splits_and_topic_settings_from_the_command_line(monkeypatch):
    seen = {}
    monkeypatch.setattr(command, "load_products", lambda spark, warehouse: seen.update(warehouse.options()))
    monkeypatch.setattr(command, "get_spark_session", lambda name, hive, options, tasks: seen.update(s3=options, tasks=tasks))
    monkeypatch.setattr(command, "s3a_options", lambda: {"s3a": "on"})
    main([
        "load-products", "--warehouse-table=t", "--warehouse-url=jdbc:x", "--warehouse-split=n",
        "--warehouse-bounds", "1", "99", "--warehouse-splits=8", "--shuffle-tasks=9",
    ])
    assert (seen["partitionColumn"], seen["lowerBound"], seen["upperBound"], seen["numPartitions"]) == ("n", "1", "99", "8")
    assert seen["s3"] is None and seen["tasks"] == 9
    monkeypatch.setattr(command, "run", lambda spark, args: None)
    main(["land", "--topic=s3a://b/t", "--landing=/l"])
    assert seen["s3"] == {"s3a": "on"}


def test_store_load_from_the_command_line(database, tmp_path, capsys):
    (tmp_path / "s.csv").write_text("store_id,country,city,channel,latitude,longitude\ns1,c,t,w,1,2\ns1,c,t,w,1,2\n")
    main(["load-stores", "--no-hive", f"--store-csv={tmp_path}/s.csv"])
    assert "2 rows read, 1 duplicates, 1 appended" in capsys.readouterr().out


def test_product_load_from_the_command_line(database, tmp_path):
    products = feeds.raw_products(database, SF_DIR)
    products.toDF(*[c.upper() for c in products.columns]).write.parquet(f"{tmp_path}/w")
    main([
        "load-products", "--no-hive", "--warehouse-table=unused", "--warehouse-provider=parquet",
        "--warehouse-option", f"path={tmp_path}/w",
    ])
    assert database.table("products_details").count() == products.count()
