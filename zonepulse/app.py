"""Run the live job: ``python -m zonepulse.app --root ... --checkpoints ... --restaurants ...``.

Connection strings are read from ZONEPULSE_ORDERS_CONNECTION and ZONEPULSE_COURIERS_CONNECTION,
those of a database from ZONEPULSE_DATABASE_USER and ZONEPULSE_DATABASE_PASSWORD.
The Kafka connector (and spark-avro for Avro messages, a JDBC driver for a database) must be on the
class path.
"""

from __future__ import annotations

import argparse
import importlib
import os
from urllib.parse import urlsplit

from zonepulse.config import DEFAULTS, MetricConfig
from zonepulse.model import RESTAURANT_SLA_BY_RESTAURANT
from zonepulse.session import STREAMING_CONF, build_session
from zonepulse.sinks.database import Database
from zonepulse.sources import kafka
from zonepulse.sources.files import read_restaurants
from zonepulse.streaming.pipeline import Pipeline
from zonepulse.streaming.supervisor import supervise


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(description=__doc__)
    p.add_argument("--root", required=True, help="folder of archives and metric tables")
    p.add_argument("--checkpoints", required=True, help="folder of the query checkpoints")
    p.add_argument("--restaurants", required=True, help="Parquet table of the restaurants")
    p.add_argument("--orders-topic", default="orders")
    p.add_argument("--couriers-topic", default="couriers")
    p.add_argument("--wire", choices=("avro", "json"), default="avro")
    p.add_argument("--config", help="JSON file with metric settings")
    p.add_argument("--interval", default="30 seconds", help="time between micro-batches")
    p.add_argument("--max-offsets", type=int, default=1_000_000,
                   help="messages per feed and micro-batch, so that a restart catches up in steps")
    p.add_argument("--max-files", type=int, default=1000,
                   help="files that a query takes from another one's folder per micro-batch")
    p.add_argument("--keep-batches", type=int, default=2880,
                   help="micro-batches listed between the queries; older ones wait aside for readers that are down")
    p.add_argument("--trust-producer-flag", action="store_true",
                   help="drop only copies that the producer marked, not by event id")
    p.add_argument("--database", help="JDBC address; metrics are upserted there")
    p.add_argument("--database-module", help="DB-API module that connects to it, e.g. psycopg2")
    p.add_argument("--sla-by-restaurant", action="store_true",
                   help="the database's restaurant_sla has no zone in its key; the last zone stays")
    p.add_argument("--metric-archive", help="folder for a dated archive of all changed metric rows")
    p.add_argument("--state-partitions", type=int, default=64,
                   help="partitions of all state; fixed by the first start")
    return p.parse_args(argv)


def database(args: argparse.Namespace) -> Database | None:
    """The database sink that the arguments ask for."""
    if not args.database:
        return None
    if not args.database_module:
        raise SystemExit("--database needs --database-module")
    module = importlib.import_module(args.database_module)
    user = os.environ["ZONEPULSE_DATABASE_USER"]
    password = os.environ["ZONEPULSE_DATABASE_PASSWORD"]
    address = urlsplit(args.database.removeprefix("jdbc:"))

    def connect():
        return module.connect(host=address.hostname, port=address.port,
                              dbname=address.path.lstrip("/"), user=user, password=password)

    contracts = {t.name: t for t in [RESTAURANT_SLA_BY_RESTAURANT] if args.sla_by_restaurant}
    return Database(args.database, {"user": user, "password": password}, connect, contracts=contracts)


def main(argv: list[str] | None = None) -> None:
    args = arguments(argv)
    spark = build_session(conf={
        **STREAMING_CONF, "spark.sql.shuffle.partitions": str(args.state_partitions)})
    topics = {"orders": args.orders_topic, "couriers": args.couriers_topic}

    def messages(feed: str):
        options = kafka.reader_options(
            topics[feed], os.environ[f"ZONEPULSE_{feed.upper()}_CONNECTION"],
            max_offsets_per_trigger=args.max_offsets)
        return kafka.read_topic(spark, options)

    cfg = MetricConfig.from_json(args.config) if args.config else DEFAULTS
    job = Pipeline(spark, messages, read_restaurants(spark, args.restaurants), args.root,
                   args.checkpoints, args.wire, cfg, interval=args.interval,
                   by_key=not args.trust_producer_flag, keep_batches=args.keep_batches,
                   max_files=args.max_files, database=database(args),
                   metric_archive=args.metric_archive)
    supervise(spark.streams, job.starters())


if __name__ == "__main__":
    main()
