"""Times the headline jobs on one node and prints one JSON line.

The raw feeds are derived from the test tables once, untimed, and put where each job finds its input
in production: a CSV feed, a topic, landed JSON lines, catalog tables. Every job then runs whole,
from its files to its files; nothing is cached between jobs.
"""

from __future__ import annotations

import json
import os
import tempfile
import time
from pathlib import Path

from tallyshelf.checks.feeds import raw_products, raw_stores, sales_text
from tallyshelf.plans.clean import clean_products, clean_sales, clean_stores
from tallyshelf.plans.dimensions import append_stores, load_products
from tallyshelf.plans.overview import retail_sales_overview
from tallyshelf.plans.stages import STAGES, Settings
from tallyshelf.schemas import SALES_SCHEMA
from tallyshelf.session import get_spark_session
from tallyshelf.sources.files import read_sales_data
from tallyshelf.sources.topic import Topic
from tallyshelf.sources.warehouse import Warehouse
from tallyshelf.streaming.landing import Landing


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return round(time.perf_counter() - start, 3)


def to_nowhere(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 1))
    folder = tempfile.mkdtemp(prefix="run-")
    spark = get_spark_session(
        "bench",
        hive=False,
        options={
            "spark.master": f"local[{cpus}]",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
            "spark.sql.shuffle.partitions": cpus,
            "spark.sql.warehouse.dir": f"{folder}/warehouse",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    feed, lines = f"{folder}/feed", f"{folder}/lines"
    keep_blanks = {"header": True, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    sales = sales_text(spark, sf_dir).repartition(int(cpus))
    sales.write.options(**keep_blanks).csv(feed)
    sales.write.json(lines)
    products = raw_products(spark, sf_dir)
    products.toDF(*[c.upper() for c in products.columns]).write.parquet(f"{folder}/warehouse-rows")
    warehouse = Warehouse("products", provider="parquet", properties={"path": f"{folder}/warehouse-rows"})
    settings = Settings(
        feed=feed,
        topic=Topic(f"{folder}/topic"),
        landing=Landing(f"{folder}/landed"),
        export=f"{folder}/export",
    )

    def landed_sales():
        return read_sales_data(spark, f"{lines}/*.json", SALES_SCHEMA)

    def overview():
        products, stores = spark.table(settings.product_table), spark.table(settings.store_table)
        return retail_sales_overview(clean_sales(landed_sales()), clean_products(products), clean_stores(stores))

    seconds = {
        "load_products": timed(lambda: load_products(spark, warehouse, settings.product_table)),
        "load_stores": timed(lambda: append_stores(spark, raw_stores(spark, sf_dir), settings.store_table)),
        "json_scan": timed(lambda: to_nowhere(landed_sales())),
        "clean_products": timed(lambda: to_nowhere(clean_products(spark.table(settings.product_table)))),
        "clean_stores": timed(lambda: to_nowhere(clean_stores(spark.table(settings.store_table)))),
        "clean_sales": timed(lambda: to_nowhere(clean_sales(landed_sales()))),
        "retail_sales_overview": timed(lambda: to_nowhere(overview())),
    }
    for name, stage in STAGES.items():
        seconds[f"stage_{name}"] = timed(lambda: stage(spark, settings))

    spark.stop()
    print(json.dumps({
        "metric": "headline_jobs_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": Path(sf_dir).name.removeprefix("sf"),
        "cpus": int(cpus),
    }))


if __name__ == "__main__":
    main()
