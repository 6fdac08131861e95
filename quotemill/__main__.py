"""Command line for the jobs: ``python -m quotemill <job> --root … [--day …]``."""

from __future__ import annotations

import argparse
import json

from .plans import daily, modelling, monitoring
from .session import build_session


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="quotemill")
    parser.add_argument("job", choices=["run-day", "backfill", "check", "train", "evaluate", "score", "monitor"])
    parser.add_argument("--root", required=True, help="folder of the stored tables")
    parser.add_argument("--snapshots", help="folder of the raw snapshots (run-day)")
    parser.add_argument("--day", default="", help="YYYY-MM-DD, blank for today in UTC")
    parser.add_argument("--json-lines", action="store_true", help="snapshot files hold one object per line")
    parser.add_argument("--max-rmse", type=float, default=10.0)
    parser.add_argument("--max-mape", type=float, default=15.0)
    return parser


def main(argv: list[str] | None = None) -> None:
    args = _parser().parse_args(argv)
    spark = build_session("quotemill")
    if args.job == "run-day":
        result = daily.run_day(spark, args.root, args.snapshots, args.day, not args.json_lines).loads
    elif args.job == "backfill":
        result = {**daily.build_silver(spark, args.root, None).loads, **daily.build_gold(spark, args.root, None).loads}
    elif args.job == "check":
        result = [r.asDict() for r in daily.check_layers(spark, args.root).collect()]
    elif args.job == "train":
        result = modelling.train(spark, args.root)
    elif args.job == "evaluate":
        result = modelling.evaluate(spark, args.root, args.max_rmse, args.max_mape)
    elif args.job == "score":
        result = modelling.score_day(spark, args.root, args.day)
    else:
        result = {
            "drift": monitoring.monitor_drift(spark, args.root, args.day),
            "performance": monitoring.monitor_performance(spark, args.root, args.day),
        }
    print(json.dumps(result, default=str, ensure_ascii=False))


if __name__ == "__main__":
    main()
