"""Command line: init, run, inspect, filter, prepare, export."""

from __future__ import annotations

import argparse
import logging
import os
import signal

from pyspark.sql import SparkSession

from .plans import config, jobs

LOG = logging.getLogger("siltworks")


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="siltworks", description=__doc__)
    sub = p.add_subparsers(dest="command", required=True)
    c = sub.add_parser("init", help="write a plan with defaults")
    c.add_argument("--name", default="my-dataset")
    c.add_argument("--query")
    c.add_argument("--output", default="plan.me")
    c = sub.add_parser("run", help="curate the plan's repositories into a dataset")
    c.add_argument("plan")
    c.add_argument("--archives", help="glob of archives (owner__repo.tar.gz or .zip); without it they are fetched")
    c.add_argument("--fixture", help="folder of API responses to use instead of the network")
    c.add_argument("--output", default="output")
    c.add_argument("--resume", action="store_true", help="go on from what an earlier run into the output completed")
    c.add_argument("--package", action="store_true", help="make a .zip of the output, too")
    c = sub.add_parser("inspect", help="report on a dataset")
    c.add_argument("dataset")
    c = sub.add_parser("filter", help="keep code and documentation")
    c.add_argument("dataset")
    c.add_argument("--output", default="filtered")
    c.add_argument("--debug-mode", action="store_true", help="keep tests and fixtures")
    c.add_argument("--split-docs", action="store_true")
    c.add_argument("--passthrough", action="store_true", help="copy side files unchanged")
    c = sub.add_parser("prepare", help="extract training examples")
    c.add_argument("dataset")
    c.add_argument("--output", default="prepared")
    c.add_argument("--mode", choices=["explain", "debug", "all"], default="all")
    c.add_argument("--max-file-size-kb", type=int, default=50)
    c.add_argument("--max-examples", type=int)
    c = sub.add_parser("export", help="write training records")
    c.add_argument("prepared")
    c.add_argument("--output", default="exported")
    c.add_argument("--format", choices=["messages", "instruction"], default="messages")
    c.add_argument("--name", default="dataset")
    c.add_argument("--license")
    return p


def main(argv: list[str] | None = None) -> int:
    a = parser().parse_args(argv)
    logging.basicConfig(level=logging.INFO, format="%(levelname)s %(message)s")
    config.load_env()
    if a.command == "init":
        if issues := config.wizard_issues({"name": a.name}):
            LOG.error("\n".join(issues))
            return 2
        search = config.Discovery(search=config.Search(a.query)) if a.query else None
        with open(a.output, "w", encoding="utf-8") as f:
            f.write(config.dump_plan(config.Plan(name=a.name, discovery=search)))
        return 0
    spark = SparkSession.builder.appName("siltworks").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    spark.addTag("siltworks")
    signal.signal(signal.SIGTERM, lambda *_: spark.interruptTag("siltworks"))
    if a.command == "run":
        plan = config.parse_plan(a.plan)
        repos = jobs.candidates(spark, plan, a.fixture, os.environ.get(plan.token_env))
        files = jobs.files_of_archives(spark, a.archives or jobs.fetched(spark, repos, f"{a.output}/_archives"), repos)
        repos = jobs.with_licenses(spark, repos, files, a.fixture, os.environ.get(plan.token_env))
        LOG.info("%s", jobs.run(spark, plan, repos, files, a.output, a.resume, a.package))
    elif a.command == "inspect":
        for name, df in jobs.inspect(spark, a.dataset).items():
            LOG.info("%s", name)
            df.show(truncate=False)
    elif a.command == "filter":
        jobs.filter_dataset(spark, a.dataset, a.output, a.debug_mode, a.split_docs, a.passthrough).show()
    elif a.command == "prepare":
        LOG.info("%s", jobs.prepare(spark, a.dataset, a.output, a.mode, a.max_file_size_kb, a.max_examples))
    else:
        LOG.info("%s", jobs.export(spark, a.prepared, a.output, a.format, a.name, a.license))
    return 0
