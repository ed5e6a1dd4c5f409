"""Command line for the recurring jobs: ``python -m tidemark <job> ...``.

Each call runs one round.  The database password is read from the environment
variable that ``--password-var`` names.
"""

from __future__ import annotations

import argparse
import os
import time
from datetime import datetime, timezone

from tidemark.plans import jobs
from tidemark.plans.results import JOBS
from tidemark.session import build_session
from tidemark.sinks.publish import CatalogTarget, ConnectorTarget, FileTarget
from tidemark.sources.connectors import JdbcTable, KafkaTopic, read_since, read_stream
from tidemark.sources.files import read_text


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="tidemark", description=__doc__)
    commands = parser.add_subparsers(dest="job", required=True)

    def command(name: str, *arguments: str) -> argparse.ArgumentParser:
        sub = commands.add_parser(name)
        for argument in arguments:
            sub.add_argument(argument)
        return sub

    def database(sub: argparse.ArgumentParser, required: bool = True) -> None:
        for option in ("--url", "--user", "--password-var"):
            sub.add_argument(option, required=required)

    prepare = command("prepare", "archive", "landing")
    land = command("land", "warehouse", "landing")
    land.add_argument("--option", nargs="*", default=[], metavar="NAME=VALUE", help="options of the file reader, such as maxFilesPerTrigger=100")
    catch_up = command("catch-up", "warehouse", "archives", "landing")
    catch_up.add_argument("-n", type=int, default=24, help="archives that a round takes up")
    for sub in (prepare, catch_up):
        sub.add_argument("--partitions", type=int, help="tasks that the lines of an archive are dealt over")
    command("split", "warehouse")
    collect = command("collect", "warehouse")
    collect.add_argument("kind", choices=("users", "repos", "follows"))
    collect.add_argument("documents", help="folder of JSON lines, a document each")
    command("refresh", "warehouse", "output")
    command("missing", "warehouse", "output")
    sync = command("sync", "warehouse", "table", "load_id")
    database(sync)
    sync.add_argument("--partition", nargs=4, metavar=("COLUMN", "LOW", "HIGH", "TASKS"), help="read the table by ranges of a column")
    analyse = command("analyse", "warehouse", "output")
    analyse.add_argument("--jobs", nargs="*", default=list(JOBS), choices=list(JOBS))
    analyse.add_argument("--target", choices=("files", "catalog", "database"), default="files",
                         help="output is a folder, a database of the catalog, or a prefix of table names in the database at --url")
    analyse.add_argument("--replace", action="store_true", help="keep only the newest result in the database")
    database(analyse, required=False)
    live = command("live", "servers", "topic", "table", "checkpoint")
    live.add_argument("--every", default="1 minute")
    database(live)
    return parser


def _table(args: argparse.Namespace, table: str | None = None) -> JdbcTable:
    ranges = getattr(args, "partition", None)
    partition = (*ranges[:3], int(ranges[3])) if ranges else None
    return JdbcTable(args.url, table or args.table, args.user, os.environ[args.password_var], partition=partition)


def _targets(args: argparse.Namespace):
    if args.target == "catalog":
        return lambda name: [CatalogTarget(f"{args.output}.{name}")]
    if args.target == "database":
        return lambda name: [ConnectorTarget(_table(args, f"{args.output}{name}"), "overwrite" if args.replace else "append")]
    return lambda name: [FileTarget(f"{args.output}/{name}")]


def main(argv: list[str] | None = None) -> None:
    args = _parser().parse_args(argv)
    spark = build_session(f"tidemark-{args.job}")
    now = datetime.now(timezone.utc).replace(tzinfo=None)
    if args.job == "prepare":
        jobs.prepare(spark, args.archive, args.landing, args.partitions)
    elif args.job == "live":
        log = read_stream(spark, KafkaTopic(args.servers, args.topic))
        jobs.live(log, ConnectorTarget(_table(args)), args.checkpoint, args.every).awaitTermination()
    else:
        _on_warehouse(args, jobs.Warehouse(spark, args.warehouse), now)


def _on_warehouse(args: argparse.Namespace, house: jobs.Warehouse, now: datetime) -> None:
    spark = house.spark
    if args.job == "land":
        jobs.land(house, args.landing, **dict(o.split("=", 1) for o in args.option))
    elif args.job == "split":
        jobs.split_landed(house, time.time())
    elif args.job == "catch-up":
        jobs.catch_up(house, args.archives, args.landing, args.n, time.time(), args.partitions)
    elif args.job == "collect":
        jobs.collect(house, args.kind, read_text(spark, args.documents).withColumnRenamed("value", "doc"))
    elif args.job == "refresh":
        FileTarget(args.output, "json", mode="overwrite").write(jobs.to_refresh(house))
    elif args.job == "missing":
        FileTarget(args.output, "json", mode="overwrite").write(jobs.hours_without_events(house))
    elif args.job == "sync":
        source = _table(args)
        jobs.sync_dimension(house, args.table, lambda mark: read_since(spark, source, mark), args.load_id)
    else:
        jobs.analyse(house.inputs(), _targets(args), now, args.jobs)


if __name__ == "__main__":
    main()
