"""Validate a CSV and store the results; to be run with spark-submit.

    spark-submit jobs/validate_csv.py --input s3a://bucket/input.csv --output s3a://bucket/results \\
        --config rules.json --keys order_id --run-id 20240908080000 --param since=2024-09-07

By default every offending row is stored too, below ``<output>-violations``.
A run that is repeated under its id takes the place of what it stored before.
The keys of an object store come from AWS_ACCESS_KEY_ID and
AWS_SECRET_ACCESS_KEY, never from the command line, where others could read
them.  ``--config`` may lie wherever Spark can read.  ``rules.json`` holds ``[{"expectation_type": ..., "kwargs": {...}, "meta": {...}}, ...]``.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from assayer import run_validation, suite_statistics  # noqa: E402
from assayer.sources import ObjectStore, build_session, read_csv, read_results, write_results, write_violations  # noqa: E402


def arguments(given: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    parser.add_argument("--input", required=True)
    parser.add_argument("--output", required=True, help="folder of the results dataset")
    parser.add_argument("--violations", help="folder for the offending rows; <output>-violations unless given")
    parser.add_argument("--config", required=True, help="JSON file with the rules")
    parser.add_argument("--name", default="default", help="name of the suite")
    parser.add_argument("--keys", nargs="*", default=[])
    parser.add_argument("--schema", help="schema of the CSV; without it types are inferred")
    parser.add_argument("--multi-line", action="store_true")
    parser.add_argument("--run-id")
    parser.add_argument("--result-format", default="COMPLETE")
    parser.add_argument("--param", action="append", default=[], metavar="NAME=VALUE")
    parser.add_argument("--endpoint-url", help="object store; the keys come from the environment")
    return parser.parse_args(given)


def main(given: list[str] | None = None) -> bool:
    """Run the job; true if every rule passed."""
    args = arguments(given)
    store = None
    if args.endpoint_url:
        keys = [os.environ.get(name, "") for name in ("AWS_ACCESS_KEY_ID", "AWS_SECRET_ACCESS_KEY")]
        store = ObjectStore(args.endpoint_url, *keys)
    spark = build_session("validate_csv", store)
    config = json.loads(spark.read.text(args.config, wholetext=True).first().value)
    run_time = dt.datetime.now(dt.timezone.utc)
    run_id = args.run_id or run_time.strftime("%Y%m%d%H%M%S")
    violations = args.violations or args.output.rstrip("/") + "-violations"
    outcome = run_validation(
        spark,
        lambda session: read_csv(session, args.input, args.schema, args.multi_line),
        config,
        lambda results: write_results(results, args.output),
        write_rows=lambda rows: write_violations(rows, violations, run_id),
        name=args.name,
        keys=args.keys,
        result_format=args.result_format,
        params=dict(p.split("=", 1) for p in args.param),
        run_id=run_id,
        run_time=run_time,
    )
    # The stored results are a few rows; asking the outcome would scan the input again.
    stored = read_results(spark, args.output, outcome.run_id)
    return bool(suite_statistics(stored).first().success)


if __name__ == "__main__":
    sys.exit(0 if main() else 1)
