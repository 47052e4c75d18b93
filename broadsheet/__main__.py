"""Batch and streaming jobs for ``spark-submit`` or ``python -m broadsheet``.

    train      labelled documents -> language profiles
    extract    pages -> bronze           clean      bronze -> silver
    aggregate  silver -> gold            run        the three above, in this order
    publish    arriving pages -> messages, every minute
    follow     arriving bronze -> silver, every minute
    count      arriving bronze -> articles per day, every minute
"""

from __future__ import annotations

import argparse
import json
from collections.abc import Callable
from contextlib import nullcontext

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from broadsheet.functions.language import load_model
from broadsheet.operators.profiles import train_profiles
from broadsheet.plans import medallion
from broadsheet.session import build_session
from broadsheet.sources import readers
from broadsheet.sources.writers import FileWarehouse, JdbcWarehouse
from broadsheet.streaming import flows
from broadsheet.streaming.progress import CycleLog

NEEDS = {
    "train": ("labelled", "profiles"),
    "extract": ("pages", "bronze"),
    "clean": ("bronze", "silver", "profiles"),
    "aggregate": ("silver",),
    "run": ("pages", "bronze", "silver", "profiles"),
    "publish": ("pages", "checkpoint"),
    "follow": ("bronze", "silver", "profiles", "checkpoint"),
    "count": ("bronze", "gold", "checkpoint"),
}


def _arguments(argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="broadsheet", description=__doc__, formatter_class=argparse.RawTextHelpFormatter)
    parser.add_argument("job", choices=list(NEEDS))
    parser.add_argument("--labelled", help="Parquet of labelled text: text, lang")
    parser.add_argument("--profiles", help="Parquet of language profiles")
    parser.add_argument("--pages", help="Parquet of pages: page_id, url, html")
    parser.add_argument("--bronze")
    parser.add_argument("--silver")
    parser.add_argument("--gold", help="folder of the gold tables, unless --jdbc is given")
    parser.add_argument("--jdbc", help="address of the database of the gold tables")
    parser.add_argument("--jdbc-properties", help="JSON file with user, password, driver")
    parser.add_argument("--messages", help="folder for published messages, unless --kafka is given")
    parser.add_argument("--kafka", help="JSON file of Kafka sink options")
    parser.add_argument("--checkpoint", help="folder for the progress of a stream")
    parser.add_argument("--quarantine", help="folder for bronze lines that are no records")
    parser.add_argument("--letters", help="folder for pages that gave no message: unreadable ones, hosts without a rule")
    parser.add_argument("--cycles", help="folder for what the cycles of a stream did")
    parser.add_argument("--files-per-cycle", type=int, help="so many files of a backlog in one cycle of a stream")
    parser.add_argument("--once", action="store_true", help="a stream works off what has arrived and ends")
    args = parser.parse_args(argv)
    missing = [f"--{name}" for name in NEEDS[args.job] if getattr(args, name) is None]
    if args.job in ("aggregate", "run") and not (args.gold or args.jdbc):
        missing.append("--gold or --jdbc")
    if args.job == "publish" and not (args.messages or args.kafka):
        missing.append("--messages or --kafka")
    if missing:
        parser.error(f"{args.job} needs {', '.join(missing)}")
    return args


def _json_file(path: str | None) -> dict | None:
    if path is None:
        return None
    with open(path, encoding="utf-8") as file:
        return json.load(file)


def _follow(spark: SparkSession, args: argparse.Namespace, start: Callable[[], StreamingQuery]) -> bool | None:
    """Run a stream to its end, with its cycles stored if there is a folder for them."""
    with CycleLog(spark, args.cycles) if args.cycles else nullcontext():
        return start().awaitTermination()


def main(argv: list[str] | None = None) -> object:
    args = _arguments(argv)
    spark = build_session(f"broadsheet-{args.job}")
    if args.jdbc:
        warehouse = JdbcWarehouse(args.jdbc, _json_file(args.jdbc_properties) or {})
    else:
        warehouse = FileWarehouse(args.gold)
    if args.job == "train":
        train_profiles(spark.read.parquet(args.labelled)).write.mode("overwrite").parquet(args.profiles)
        return None
    if args.job == "extract":
        return medallion.run_extract(readers.read_pages(spark, args.pages), args.bronze)
    if args.job == "aggregate":
        return medallion.run_aggregate(spark, args.silver, warehouse)
    if args.job == "publish":
        pages, kafka = readers.stream_pages(spark, args.pages, args.files_per_cycle), _json_file(args.kafka)
        if args.letters:
            return _follow(spark, args, lambda: flows.start_ingest(
                pages, args.checkpoint, args.letters, args.messages, kafka, once=args.once
            ))
        articles = flows.ingest(pages)
        return _follow(spark, args, lambda: flows.start_publishing(articles, args.checkpoint, args.messages, kafka, args.once))
    if args.job == "count":
        articles = readers.stream_bronze(spark, args.bronze, args.files_per_cycle)
        table = warehouse.path("gold_articles_per_day")
        return _follow(spark, args, lambda: flows.start_daily_counts(articles, table, args.checkpoint, once=args.once))
    profiles = spark.read.parquet(args.profiles)
    if args.job == "clean":
        return medallion.run_clean(spark, args.bronze, args.silver, load_model(profiles), args.quarantine)
    if args.job == "follow":
        articles, model = readers.stream_bronze(spark, args.bronze, args.files_per_cycle), load_model(profiles)
        return _follow(spark, args, lambda: flows.start_cleaning(articles, model, args.silver, args.checkpoint, args.once))
    lake = medallion.Lake(args.bronze, args.silver, warehouse, args.quarantine)
    return medallion.run(spark, readers.read_pages(spark, args.pages), profiles, lake)


if __name__ == "__main__":
    print(main())
