"""Command line of the jobs, for ``spark-submit`` or ``python -m rivulet``.

    python -m rivulet storage --rich kafka:rich --updates kafka:updates --alarms kafka:alarms \\
        --option kafka.bootstrap.servers=broker:9092 --database plant --latest
"""

from __future__ import annotations

import argparse

from rivulet.session import build_session
from rivulet.sources.topics import Topic
from rivulet.streaming import jobs

# Per job: its function, its topics, and its flags.
JOBS = {
    "enrichment": (
        jobs.run_enrichment,
        ("raw", "updates", "rich"),
        ("latest", "initialize", "from_archive", "cold_start", "wait_for_watermark"),
    ),
    "storage": (jobs.run_storage, ("rich", "updates", "alarms"), ("latest", "fresh")),
    "neighbor": (jobs.run_neighbor, ("rich", "alarms"), ("latest",)),
    "forecast": (jobs.run_forecast, ("rich", "alarms"), ("latest", "refire")),
    "passthrough": (jobs.run_passthrough, ("raw", "rich"), ("seed", "fresh")),
}
WITH_DATABASE = ("enrichment", "storage", "passthrough")


def parser() -> argparse.ArgumentParser:
    root = argparse.ArgumentParser(prog="rivulet", description=__doc__.splitlines()[0])
    commands = root.add_subparsers(dest="job", required=True)
    for name, (function, topics, flags) in JOBS.items():
        command = commands.add_parser(name, help=function.__doc__.splitlines()[0])
        for topic in topics:
            command.add_argument(f"--{topic}", required=True, metavar="FORMAT:NAME")
        command.add_argument("--option", action="append", default=[], metavar="KEY=VALUE", help="for every topic")
        if name in WITH_DATABASE:
            command.add_argument("--database", required=True)
        for flag in flags:
            command.add_argument(f"--{flag.replace('_', '-')}", action="store_true")
        command.add_argument("--checkpoint", help="default: a folder under spark.checkpoint.dir")
        command.add_argument(
            "--interval",
            default=f"{jobs.CHECKPOINT_INTERVAL_MS} milliseconds",
            help="time between micro-batches, each of which is a checkpoint",
        )
        command.add_argument("--available-now", action="store_true", help="stop when all input is handled")
    return root


def arguments(argv: list[str] | None = None) -> tuple[str, dict]:
    """Job name and keyword arguments for its function."""
    found = vars(parser().parse_args(argv))
    job = found.pop("job")
    options = dict(pair.split("=", 1) for pair in found.pop("option"))
    for topic in JOBS[job][1]:
        kind, _, name = found[topic].partition(":")
        found[topic] = Topic(kind, name, options)
    return job, found


def main(argv: list[str] | None = None) -> None:
    job, options = arguments(argv)
    spark = build_session(app=f"rivulet-{job}")
    queries = JOBS[job][0](spark, **options)
    if options["available_now"]:
        for query in queries:
            query.awaitTermination()
    else:
        spark.streams.awaitAnyTermination()


if __name__ == "__main__":
    main()
