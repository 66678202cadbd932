"""Command line: `spark-submit` or `python -m tallyshelf STAGE`, one stage or all of them in order."""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import SparkSession

from tallyshelf.plans.dimensions import load_products, load_stores
from tallyshelf.plans.stages import STAGES, UPKEEP, Settings, report, run_stages
from tallyshelf.session import get_spark_session, s3a_options
from tallyshelf.sources.topic import Topic
from tallyshelf.sources.warehouse import Warehouse
from tallyshelf.streaming.landing import Landing

# Paths each stage cannot do without.
NEEDED = {
    "publish": ("feed", "topic"),
    "land": ("topic", "landing"),
    "compact": ("landing",),
    "clean": ("landing",),
    "overview": (),
    "export": ("export",),
    "all": ("feed", "topic", "landing", "export"),
    "load-stores": ("store_csv",),
    "load-products": ("warehouse_table",),
}


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="tallyshelf", description=__doc__)
    parser.add_argument("stage", choices=NEEDED)
    parser.add_argument("--feed", default="", help="headered CSV of sales rows")
    parser.add_argument("--topic", default="", help="topic name, or a folder without --servers")
    parser.add_argument("--servers", default="", help="Kafka bootstrap servers")
    parser.add_argument("--landing", default="", help="landing folder")
    parser.add_argument("--landing-format", default="parquet", choices=["parquet", "json"])
    parser.add_argument("--run-id", default="", help="subfolder of the topic and landing folders, for an unrelated feed")
    parser.add_argument("--per-trigger", type=int, help="messages (Kafka) or files per micro-batch")
    parser.add_argument("--export", default="", help="target of the CSV export")
    parser.add_argument("--multi-line", action="store_true", help="CSV values may have line breaks; their lines are stored first")
    parser.add_argument("--partition-by", nargs="*", default=[], help="columns to partition the curated table by")
    parser.add_argument("--grace-seconds", type=float, default=86_400, help="how long compaction leaves replaced folders to readers")
    parser.add_argument("--stage-sales", action="store_true", help="store valid sales first and shuffle only those that may have copies")
    parser.add_argument("--store-csv", default="", help="headered CSV of stores")
    parser.add_argument("--unseen-only", action="store_true", help="load no row that the dimension table has already")
    parser.add_argument("--warehouse-table", default="")
    parser.add_argument("--warehouse-url", default="")
    parser.add_argument("--warehouse-provider", default="jdbc")
    parser.add_argument("--warehouse-option", nargs="*", default=[], metavar="NAME=VALUE")
    parser.add_argument("--warehouse-predicate", nargs="*", default=[], help="one condition per task")
    parser.add_argument("--warehouse-split", default="", metavar="COLUMN", help="numeric column to read in parallel by")
    parser.add_argument("--warehouse-bounds", nargs=2, type=int, default=[0, 0], metavar=("LOW", "HIGH"))
    parser.add_argument("--warehouse-plan-by", default="", metavar="COLUMN", help="column that the warehouse is asked to split evenly")
    parser.add_argument("--warehouse-splits", type=int, default=1, help="tasks that read the warehouse table")
    parser.add_argument("--shuffle-tasks", type=int, default=2000, help="parts a shuffle is written in, merged by size")
    parser.add_argument("--hive", action=argparse.BooleanOptionalAction, default=True, help="use the Hive catalog")
    return parser


def _settings(args: argparse.Namespace) -> Settings:
    run = f"/{args.run_id}" if args.run_id else ""
    return Settings(
        feed=args.feed,
        topic=Topic(args.topic if args.servers else args.topic + run, args.servers, per_trigger=args.per_trigger),
        landing=Landing(args.landing + run, file_format=args.landing_format),
        export=args.export,
        multi_line=args.multi_line,
        partition_by=tuple(args.partition_by),
        grace_seconds=args.grace_seconds,
        stage_sales=args.stage_sales,
    )


def run(spark: SparkSession, args: argparse.Namespace) -> None:
    rerun = {"unseen_only": True} if args.unseen_only else {}
    if args.stage == "load-stores":
        loaded = load_stores(spark, args.store_csv, multi_line=args.multi_line, **rerun)
        print(f"{loaded.read} rows read, {loaded.duplicates} duplicates, {loaded.appended} appended")
    elif args.stage == "load-products":
        warehouse = Warehouse(
            args.warehouse_table,
            args.warehouse_url,
            args.warehouse_provider,
            dict(option.split("=", 1) for option in args.warehouse_option),
            args.warehouse_predicate,
            args.warehouse_split,
            tuple(args.warehouse_bounds),
            args.warehouse_splits,
            plan_by=args.warehouse_plan_by,
        )
        load_products(spark, warehouse, **rerun)
    elif args.stage == "all":
        run_stages(spark, _settings(args))
    else:
        print(report(args.stage, (STAGES | UPKEEP)[args.stage](spark, _settings(args))))


def main(argv: Sequence[str] | None = None) -> None:
    parser = _parser()
    args = parser.parse_args(argv)
    missing = [name for name in NEEDED[args.stage] if not getattr(args, name)]
    if missing:
        parser.error(f"{args.stage} needs " + ", ".join("--" + name.replace("_", "-") for name in missing))
    paths = (args.feed, args.topic, args.landing, args.export, args.store_csv)
    options = s3a_options() if any(path.startswith("s3a:") for path in paths) else None
    run(get_spark_session("tallyshelf", args.hive, options, args.shuffle_tasks), args)


if __name__ == "__main__":
    main()
