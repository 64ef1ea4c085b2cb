"""Run one job: ``spark-submit ... -m pmweave`` or ``python -m pmweave --help``."""

from __future__ import annotations

import argparse
import uuid

from pyspark.sql import DataFrame

from pmweave.plans import ericsson, nokia
from pmweave.session import build_session
from pmweave.sources import load_catalog, load_settings, read_counter_catalog, read_pm_files, read_pm_sequence
from pmweave.streaming import land_batches, stream_pm_files

JOBS = {"ericsson": ericsson.run, "nokia": nokia.run}


def arguments(argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="pmweave")
    parser.add_argument("vendor", choices=sorted(JOBS))
    parser.add_argument("technology", nargs="?", choices=["LTE", "UMTS"], help="by default the one that the catalog names, else LTE")
    parser.add_argument("--input", required=True, help="SequenceFile, or folder of plain or gzip XML")
    parser.add_argument("--catalog", required=True, help="counter definitions with [General] and [Table]")
    parser.add_argument("--out", required=True)
    parser.add_argument("--format", choices=["sequence", "files", "stream"], default="sequence")
    parser.add_argument("--glob", default="*.xml*", help="file name pattern, for files and stream")
    parser.add_argument("--run-id", default=None, help="same id for a repeated run; a new one by default")
    parser.add_argument("--checkpoint", help="offsets of a stream")
    parser.add_argument("--archive", help="where a stream moves processed files")
    parser.add_argument("--quarantine", help="where a stream notes files that make the job fail; <out>/_quarantine by default")
    parser.add_argument("--max-files", type=int, help="files per batch of a stream")
    return parser.parse_args(argv)


def main(argv: list[str] | None = None) -> None:
    args = arguments(argv)
    spark = build_session(f"pmweave-{args.vendor}")
    catalog = load_catalog(read_counter_catalog(spark, args.catalog, args.vendor))
    settings = load_settings(spark, args.catalog)
    technology = args.technology or settings.technology
    if settings.technology_named and technology != settings.technology:
        raise SystemExit(f"the catalog is for {settings.technology}, not {technology}")
    run_id = args.run_id or str(uuid.uuid4())

    def job(files: DataFrame, out: str) -> None:
        JOBS[args.vendor](spark, files, catalog, settings, technology, out, run_id)

    if args.format == "stream":
        if not args.checkpoint:
            raise SystemExit("a stream needs --checkpoint")
        stream = stream_pm_files(spark, args.input, args.glob, args.archive, args.max_files)
        quarantine = args.quarantine or f"{args.out}/_quarantine"
        land_batches(stream, args.checkpoint, lambda files, batch: job(files, f"{args.out}/{batch}"), quarantine).awaitTermination()
    elif args.format == "files":
        job(read_pm_files(spark, args.input, args.glob), args.out)
    else:
        job(read_pm_sequence(spark, args.input), args.out)


if __name__ == "__main__":
    main()
