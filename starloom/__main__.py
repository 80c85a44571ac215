"""Command line: create the tables, fill and check them, or compare the two layouts.

    python -m starloom create   --db music
    python -m starloom etl      --db music --events DIR --songs DIR --paths FILE
    python -m starloom run      (create, then etl)
    python -m starloom figures  (run; rows, NULLs and overlong texts as loaded)
    python -m starloom diagnose --events DIR --paths FILE
    python -m starloom keys     --db music
    python -m starloom answers  --db music
    python -m starloom tickets  --db music --files GLOB
    python -m starloom compare  --files DIR --runs 5

The session's settings come from spark-defaults.conf. Tables outlive the process
only with a catalog that does.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from starloom import plans, schemas, sources
from starloom.plans import comparison, etl


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="starloom")
    commands = parser.add_subparsers(dest="command", required=True)

    def command(name: str, *needed: str) -> argparse.ArgumentParser:
        out = commands.add_parser(name)
        for option in needed:
            out.add_argument(f"--{option}", required=True)
        return out

    command("create", "db").add_argument("--location")
    for name in ("etl", "run", "figures"):
        load = command(name, "db", "events", "songs", "paths")
        load.add_argument("--location")
        load.add_argument("--multi-line-songs", action="store_true")
        load.add_argument("--refuse-overlong", action="store_true")
        load.add_argument("--merge-latest", action="store_true")
    command("diagnose", "events", "paths")
    command("keys", "db")
    command("answers", "db").add_argument("--top", type=int, default=10)
    command("tickets", "db", "files").add_argument("--repartition", type=int)
    compare = command("compare", "files")
    compare.add_argument("--trailing-sep", action="store_true")
    compare.add_argument("--runs", type=int, default=0)
    return parser.parse_args(argv)


def _config(args: argparse.Namespace) -> etl.RunConfig:
    return etl.RunConfig(
        db=args.db,
        events=args.events,
        songs=args.songs,
        json_paths=args.paths,
        location=args.location,
        append=args.command == "etl",
        multi_line_songs=args.multi_line_songs,
        refuse_overlong=args.refuse_overlong,
        merge_latest=args.merge_latest,
    )


def main(argv: list[str] | None = None) -> None:
    args = arguments(argv)
    spark = SparkSession.builder.appName("starloom").getOrCreate()
    if args.command == "compare":
        comparison.load_both(spark, args.files, trailing_sep=args.trailing_sep).show(truncate=False)
        comparison.compare(spark).show(truncate=False)
        if args.runs:
            comparison.evidence(spark, args.runs).show(truncate=False)
    elif args.command == "create":
        sources.use(spark, args.db, args.location)
        sources.reset(spark, args.db)
    elif args.command == "figures":
        plans.run_counted(spark, _config(args)).show(1000, truncate=False)
    elif args.command == "diagnose":
        paths = sources.load_json_paths(spark, args.paths)
        events = schemas.widen_ids(schemas.EVENTS)
        sources.bad_json_lines(spark, args.events, paths, events).show(1000, truncate=False)
    elif args.command == "keys":
        plans.offending_keys(spark, args.db).show(1000, truncate=False)
    elif args.command == "answers":
        fact, songs, times = (spark.table(f"{args.db}.{t}") for t in ("songplay", "songs", "time"))
        plans.most_played(fact, songs, args.top).show(args.top, truncate=False)
        plans.plays_by_hour(fact, times).show(24)
    elif args.command == "tickets":
        sources.use(spark, args.db)
        loaded = plans.load_tickets(spark, args.db, args.files, repartition=args.repartition)
        plans.row_counts({"sporting_event_ticket": loaded}).show(truncate=False)
    else:
        etl.run(spark, _config(args)).show(truncate=False)


if __name__ == "__main__":
    main()
