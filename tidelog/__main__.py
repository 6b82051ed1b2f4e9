"""Command line: ``spark-submit tidelog/__main__.py`` or ``python -m tidelog`` with a sub-command.

batch    topics to Bronze, Silver and Gold, with the quality gate before publication
refresh  what is new in the topics to Bronze and on to standing Silver and Gold views
gate     the expectation suites of one layer or all, over finished tables
smoke    row counts of the Gold tables
stream   order changes to one-minute revenue windows
bronze   change records of one topic appended to a folder, exactly once
rates    exchange-rate payload files to the events topic
"""

from __future__ import annotations

import argparse
import datetime
import sys

from pyspark.sql import SparkSession

from tidelog.operators.rates import currency_list, rates_to_events, sorted_events
from tidelog.plans.medallion import contract_tables, run_batch, run_refresh
from tidelog.quality.gate import gate_summary, is_green, run_gate, smoke_checks, suite_summary
from tidelog.quality.suites import LAYERS
from tidelog.rules import QUOTED_CURRENCIES
from tidelog.session import build_session
from tidelog.sources.topics import Topic, to_messages, write_messages
from tidelog.streaming.jobs import start_bronze, start_order_revenue

ENTITIES = ("orders", "customers", "order_items", "events")


def _topic(args: argparse.Namespace, name: str) -> Topic:
    if args.servers:
        return Topic(name, servers=args.servers)
    return Topic(name, path=f"{args.topics}/{name}")


def _batch(spark: SparkSession, args: argparse.Namespace) -> int:
    names = dict(zip(ENTITIES, args.names.split(",")))
    outcome = run_batch(
        spark,
        {entity: _topic(args, name) for entity, name in names.items()},
        args.root,
        args.run_id,
        args.as_of,
        deletes=args.deletes,
        publish_as=dict(pair.split("=", 1) for pair in args.publish),
    )
    for table, rows in outcome.rows.items():
        print(f"{table}: {rows} rows")
    print("gate green" if outcome.green else f"gate red, see {outcome.results}")
    return 0 if outcome.green else 1


def _refresh(spark: SparkSession, args: argparse.Namespace) -> int:
    names = dict(zip(ENTITIES, args.names.split(",")))
    topics = {entity: _topic(args, name) for entity, name in names.items()}
    views, rows = run_refresh(spark, topics, args.root)
    for table, count in rows.items():
        print(f"{table}: {count} rows")
    print(f"views at version {views.version()}")
    return 0


def _gate(spark: SparkSession, args: argparse.Namespace) -> int:
    layers = tuple(LAYERS) if args.layer == "all" else (args.layer,)
    results = run_gate(contract_tables(spark, args.root, args.run_id), layers)
    path = f"{args.root}/versions/{args.run_id}/quality-{args.layer}"
    results.write.mode("overwrite").parquet(path)
    landed = spark.read.parquet(path)
    suite_summary(landed).show(truncate=False)
    gate_summary(landed).show()
    return 0 if is_green(landed) else 1


def _smoke(spark: SparkSession, args: argparse.Namespace) -> int:
    tables = contract_tables(spark, args.root, args.run_id)
    rows = smoke_checks({name: tables[name] for name in LAYERS["gold"]}).collect()
    for row in rows:
        print(f"{'PASS' if row.success else 'FAIL'} {row.check} (value={row.value})")
    return 0 if all(row.success for row in rows) else 1


def _stream(spark: SparkSession, args: argparse.Namespace) -> int:
    if args.state_partitions:
        spark.conf.set("spark.sql.shuffle.partitions", args.state_partitions)
    query = start_order_revenue(
        spark,
        _topic(args, args.source),
        _topic(args, args.sink),
        args.checkpoint,
        args.per_trigger,
        args.once,
    )
    query.awaitTermination()
    return 0


def _bronze(spark: SparkSession, args: argparse.Namespace) -> int:
    topic = _topic(args, args.source)
    start_bronze(spark, topic, args.path, args.checkpoint, once=args.once).awaitTermination()
    return 0


def _rates(spark: SparkSession, args: argparse.Namespace) -> int:
    payloads = spark.read.text(args.payloads, wholetext=True).withColumnRenamed("value", "payload")
    events = rates_to_events(payloads, currency_list(args.currencies))
    if events.isEmpty():
        print("no matching currencies", file=sys.stderr)
        return 1
    if args.dry_run:
        sorted_events(events).show(truncate=False)
    else:
        write_messages(to_messages(events, "currency", args.topic), _topic(args, args.topic))
    return 0


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="tidelog", description=__doc__.splitlines()[0])
    commands = top.add_subparsers(dest="command", required=True)
    today = datetime.datetime.now(datetime.timezone.utc)

    def command(name: str, run, topics: bool) -> argparse.ArgumentParser:
        sub = commands.add_parser(name)
        sub.set_defaults(run=run)
        if topics:
            place = sub.add_mutually_exclusive_group(required=True)
            place.add_argument("--servers", help="Kafka brokers")
            place.add_argument("--topics", help="folder with one sub-folder per topic")
        return sub

    batch = command("batch", _batch, True)
    batch.add_argument("--root", required=True)
    batch.add_argument("--run-id", default=today.strftime("%Y%m%dT%H%M%S"))
    batch.add_argument("--as-of", default=today.date().isoformat())
    batch.add_argument(
        "--publish", nargs="*", default=[], metavar="TABLE=VIEW",
        help="views to move to the new version when the gate is green",
    )
    batch.add_argument("--deletes", choices=("apply", "ignore"), default="apply")
    refresh = command("refresh", _refresh, True)
    refresh.add_argument("--root", required=True)
    for sub in (batch, refresh):
        sub.add_argument(
            "--names", default="cdc.orders,cdc.customers,cdc.order_items,raw.events",
            help="topic names of " + ", ".join(ENTITIES),
        )
    for name, run in (("gate", _gate), ("smoke", _smoke)):
        sub = command(name, run, False)
        sub.add_argument("--root", required=True)
        sub.add_argument("--run-id", required=True)
        if name == "gate":
            sub.add_argument("--layer", choices=(*LAYERS, "all"), default="all")
    stream = command("stream", _stream, True)
    stream.add_argument("--source", default="cdc.orders")
    stream.add_argument("--sink", default="gold.order-revenue-1m")
    stream.add_argument("--checkpoint", required=True)
    stream.add_argument("--per-trigger", type=int)
    stream.add_argument("--state-partitions", type=int, help="fixed at the first start of a checkpoint")
    stream.add_argument("--once", action="store_true")
    bronze = command("bronze", _bronze, True)
    bronze.add_argument("--source", default="cdc.orders")
    bronze.add_argument("--path", required=True)
    bronze.add_argument("--checkpoint", required=True)
    bronze.add_argument("--once", action="store_true")
    rates = command("rates", _rates, True)
    rates.add_argument("--payloads", required=True, help="folder of JSON payload files")
    rates.add_argument("--currencies", default=",".join(QUOTED_CURRENCIES))
    rates.add_argument("--topic", default="raw.events")
    rates.add_argument("--dry-run", action="store_true")
    return top


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    return args.run(build_session(f"tidelog {args.command}"), args)


if __name__ == "__main__":
    sys.exit(main())
