"""Command line of the jobs.

    python -m gridmill.plans.run ingest   <day files> <table>
    python -m gridmill.plans.run stream   <servers> <table folder> <checkpoint folder>
    python -m gridmill.plans.run fanout   <servers> <tables folder> <checkpoint folder>
    python -m gridmill.plans.run route    <servers> <tables folder> <checkpoint folder>
    python -m gridmill.plans.run forecast <readings> <registry>
    python -m gridmill.plans.run season   <readings> <registry> <season> <year>
    python -m gridmill.plans.run score    <rows> <registry> <model> <output> --keep id --parquet
    python -m gridmill.plans.run report   <readings>

On a cluster: spark-submit --py-files gridmill.zip gridmill/plans/run.py ingest ...
Readings are a table name, a Parquet folder with `--parquet`, or headerless CSV with `--csv`.
"""

import argparse

from gridmill import fixed, schemas
from gridmill.operators import reports
from gridmill.plans import jobs
from gridmill.session import build_session
from gridmill.sources.messages import stream_topic
from gridmill.sources.readings import read_csv_readings
from gridmill.streaming.jobs import fan_out, ingest_readings, route_topics


def load_readings(spark, source, kind="table"):
    if kind == "csv":
        return read_csv_readings(spark, source)
    return spark.read.parquet(source) if kind == "parquet" else spark.table(source)


def stream_job(spark, args):
    """The query of a stream command; without a trigger every job keeps its own."""
    topic = args.topic or (None if args.pattern else {
        "stream": fixed.READINGS_TOPIC, "fanout": fixed.READINGS_TOPIC, "route": None}[args.command])
    pattern = args.pattern or (fixed.SENSOR_TOPIC_PATTERN if topic is None else None)
    messages = stream_topic(spark, args.servers, topic, pattern, args.starting, args.per_trigger)
    options = {"available_now": args.available_now}
    if args.trigger:
        options["trigger"] = args.trigger
    if args.command == "stream":
        return ingest_readings(messages, args.table, args.checkpoint, args.late_by, **options)
    if args.command == "fanout":
        return fan_out(messages, args.table, args.checkpoint, **options)
    return route_topics(messages, args.table, args.checkpoint, schemas.HOUSE, **options)


def parser():
    top = argparse.ArgumentParser(prog="gridmill")
    commands = top.add_subparsers(dest="command", required=True)

    def command(name, *arguments, csv=False, parquet=False):
        sub = commands.add_parser(name)
        for argument in arguments:
            sub.add_argument(argument)
        if csv or parquet:
            kinds = sub.add_mutually_exclusive_group()
            for kind in ("csv", "parquet") if csv else ("parquet",):
                kinds.add_argument(f"--{kind}", dest="kind", action="store_const", const=kind, default="table")
        return sub

    command("ingest", "folder", "table").add_argument("--days", type=int, nargs="*")
    for name in ("stream", "fanout", "route"):
        stream = command(name, "servers", "table", "checkpoint")
        source = stream.add_mutually_exclusive_group()
        source.add_argument("--topic")
        source.add_argument("--pattern")
        stream.add_argument("--starting", default="earliest")
        stream.add_argument("--per-trigger", type=int)
        when = stream.add_mutually_exclusive_group()
        when.add_argument("--trigger")
        when.add_argument("--available-now", action="store_true")
        if name == "stream":
            stream.add_argument("--late-by")
    command("forecast", "readings", "registry", csv=True)
    season = command("season", "readings", "registry", "season", "year", csv=True)
    season.add_argument("--min-rows", type=int, default=fixed.MIN_TRAINING_ROWS)
    score = command("score", "rows", "registry", "model", "output", parquet=True)
    score.add_argument("--keep", nargs="+", required=True)
    command("report", "readings", csv=True)
    return top


def main(arguments=None, spark=None):
    args = parser().parse_args(arguments)
    spark = spark or build_session(f"gridmill {args.command}")
    if args.command == "ingest":
        result = jobs.ingest_day_files(spark, args.folder, args.table, args.days).first().asDict()
    elif args.command in ("stream", "fanout", "route"):
        result = stream_job(spark, args).awaitTermination()
    elif args.command == "forecast":
        readings = load_readings(spark, args.readings, args.kind)
        result = jobs.train_forecast(spark, readings, args.registry)[1]
    elif args.command == "season":
        readings = load_readings(spark, args.readings, args.kind)
        result = jobs.train_seasonal(
            spark, readings, args.season, int(args.year), args.registry, args.min_rows
        )
    elif args.command == "score":
        rows = load_readings(spark, args.rows, args.kind)
        jobs.score_table(spark, rows, args.registry, args.model, args.keep, args.output)
        result = args.output
    else:
        readings = load_readings(spark, args.readings, args.kind)
        result = [row.asDict() for row in reports.coverage(readings, "full_timestamp").collect()]
    print(result)
    return result


if __name__ == "__main__":
    main()
