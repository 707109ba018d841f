"""Command line: ``python -m demandcast run ...`` / ``python -m demandcast lookup ...``.

run     lands the CSVs and runs the weekly pipeline (optionally raking the
        panel to margins given as a JSON file ``{"margin": {"category": n}}``)
lookup  prints the forecast rows of one series as JSON (at most --horizon rows)
"""

from __future__ import annotations

import argparse
import json
import os
import sys

from demandcast.schemas import DEFAULT_HORIZON_WEEKS


SALT_VARIABLE = "HASH_SALT"  # fixed value: existing deployments set it


def read_salt(path: str | None, default: bool) -> str:
    """The salt of a file, else of the environment, else the published one if
    asked for; never an argument, which a process list would show."""
    from demandcast.functions.hashing import DEFAULT_SALT

    if path:
        with open(path) as fh:
            salt = fh.read().rstrip("\n")
    else:
        salt = os.environ.get(SALT_VARIABLE, "")
    if salt:
        return salt
    if default:
        return DEFAULT_SALT
    raise ValueError(f"no salt: set ${SALT_VARIABLE}, pass --salt_file, or ask for --default_salt")


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="demandcast")
    sub = parser.add_subparsers(dest="command", required=True)

    run = sub.add_parser("run", help="ingest CSVs and run the weekly pipeline")
    run.add_argument("--credit_csv", required=True)
    run.add_argument("--panel_csv", required=True)
    run.add_argument("--demo_csv")
    run.add_argument("--landing_dir", required=True)
    run.add_argument("--feature_dir", required=True)
    run.add_argument("--marginals_json")
    run.add_argument("--horizon", type=int, default=DEFAULT_HORIZON_WEEKS)
    run.add_argument("--no_regression", action="store_true")
    run.add_argument("--naive_without_history", action="store_true", help="serve the naive slot alone when history is short")
    run.add_argument("--salt_file", help=f"file holding the hashing salt (else ${SALT_VARIABLE})")
    run.add_argument("--default_salt", action="store_true", help="hash with the published default salt")

    look = sub.add_parser("lookup", help="forecast rows of one series")
    look.add_argument("--feature_dir", required=True)
    look.add_argument("--sku", required=True)
    look.add_argument("--region", required=True)
    look.add_argument("--horizon", type=int, default=DEFAULT_HORIZON_WEEKS)

    args = parser.parse_args(argv)

    salt = None
    if args.command == "run":
        try:
            salt = read_salt(args.salt_file, args.default_salt)
        except ValueError as err:
            parser.error(str(err))

    from demandcast.session import get_session

    spark = get_session()
    if args.command == "run":
        from demandcast.plans.pipeline import run_pipeline

        marginals = None
        if args.marginals_json:
            with open(args.marginals_json) as fh:
                marginals = json.load(fh)
        result = run_pipeline(
            spark, args.credit_csv, args.panel_csv, args.landing_dir, args.feature_dir,
            marginals=marginals, horizon=args.horizon, demo_csv=args.demo_csv,
            use_regression=not args.no_regression, salt=salt,
            without_history="naive" if args.naive_without_history else "fail",
        )
        summary = {"artefacts": result.paths, "skipped": result.skipped}
        if result.rake is not None:
            summary["raking"] = {
                "iterations": result.rake.iterations,
                "max_change": result.rake.max_change,
                "converged": result.rake.converged,
            }
        print(json.dumps(summary, indent=2))
        return 0

    from demandcast.operators.lookup import SeriesNotFoundError, forecast_records
    from demandcast.sources.files import load_forecast_for_serving

    try:
        forecasts = load_forecast_for_serving(spark, args.feature_dir)
        print(json.dumps(forecast_records(forecasts, args.sku, args.region, args.horizon), indent=2))
    except (FileNotFoundError, SeriesNotFoundError) as err:
        print(str(err), file=sys.stderr)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
