"""Command line: the batch run, the alerts on its stream, and lookups in its view."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame

from entigrid.operators.name_index import indexed_search
from entigrid.operators.quality import merged_profile
from entigrid.operators.view import party_listing, party_lookup
from entigrid.plans.pipeline import Outputs, run
from entigrid.session import build_session
from entigrid.sources.bucketed import read_bucketed
from entigrid.streaming.alerts import start_alerts
from entigrid.streaming.publish import read_kafka_stream, read_stream


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="entigrid", description=__doc__)
    commands = parser.add_subparsers(dest="command", required=True)

    batch = commands.add_parser("run", help="run every stage over a folder of party files")
    batch.add_argument("--data-dir", required=True, help="folder with *.csv and *.json")
    batch.add_argument("--output", required=True, help="new folder for the results")
    batch.add_argument("--fingerprint", choices=["sha256", "blake3"], default="blake3")
    batch.add_argument("--strict-lei", action="store_true", help="classify by LEI checksum")
    batch.add_argument("--json-lines", action="store_true", help="all JSON files hold a record per line")
    batch.add_argument("--rules", help="JSON document or folder of rule versions")

    batch.add_argument("--sketches", action="store_true", help="leave distinct-value sketches for the profile command")

    profile = commands.add_parser("profile", help="print the field profile over several runs, distinct values estimated")
    profile.add_argument("--results", required=True, nargs="+", help="output folders of runs with --sketches")

    alerts = commands.add_parser("alerts", help="route the published parties and raise alerts")
    source = alerts.add_mutually_exclusive_group(required=True)
    source.add_argument("--stream", help="folder that a run has published to")
    source.add_argument("--kafka", help="bootstrap servers; needs the Kafka package")
    alerts.add_argument("--topic", default="parties")
    alerts.add_argument("--output", required=True, help="folder for all routed records")
    alerts.add_argument("--alerts", required=True, help="folder for the alerts")
    alerts.add_argument("--position", required=True, help="folder of the durable position")
    alerts.add_argument("--interval", help="go on, with a batch as often; else stop after what is there")
    alerts.add_argument("--rules", help="JSON document or folder of rule versions, read for every batch")

    for name, wanted in (("party", "id"), ("search", "name"), ("list", None)):
        lookup = commands.add_parser(name, help="print parties of a run's view as JSON lines")
        lookup.add_argument("--results", required=True, help="output folder of a run")
        if wanted:
            lookup.add_argument(f"--{wanted}", required=True)
    return parser


def _print(found: DataFrame) -> None:
    for line in found.toJSON().toLocalIterator():
        print(line)


def main(arguments: list[str] | None = None) -> None:
    given = sys.argv[1:] if arguments is None else arguments
    # the batch run is what is meant without a command
    options = _parser().parse_args(["run", *given] if given and given[0].startswith("--") else given)
    spark = build_session()
    if options.command == "run":
        lei_flag = "lei_valid" if options.strict_lei else "lei_format_valid"
        run(
            spark, options.data_dir, options.output, options.fingerprint, lei_flag,
            json_lines=options.json_lines or None, rules=options.rules, sketches=options.sketches,
        )
    elif options.command == "profile":
        _print(merged_profile(spark.read.parquet(*(Outputs(folder).path("profile_sketches") for folder in options.results))).orderBy("field_name"))
    elif options.command == "alerts":
        records = read_kafka_stream(spark, options.kafka, options.topic) if options.kafka else read_stream(spark, options.stream)
        start_alerts(records, options.output, options.position, options.interval, options.alerts, options.rules).awaitTermination()
    else:
        results = Outputs(options.results)
        view = read_bucketed(spark, results.path("parties"))
        if options.command == "party":
            _print(party_lookup(view, options.id))
        elif options.command == "search":
            _print(indexed_search(view, results.path("name_index"), options.name))
        else:
            _print(party_listing(view))


if __name__ == "__main__":
    main()
