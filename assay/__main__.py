"""Command line: ``python -m assay --source PATH --project NAME [--begin D --end D] ...``

Prints the run statistics and failed rules as JSON lines; exit code 1 when the
gate fails (more failed rules than ``--failures-allowed``).
"""

from __future__ import annotations

import argparse
import json
import sys

from .errors import CheckpointFailed
from .plans.checkpoint import CheckpointRun
from .plans.pipeline import run_daily
from .session import build_session
from .sources.downloads import read_downloads


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="assay", description=__doc__)
    src = ap.add_mutually_exclusive_group(required=True)
    src.add_argument("--source", help="nested downloads table (files)")
    src.add_argument("--table", help="nested downloads table (catalog name)")
    ap.add_argument("--format", default="parquet")
    ap.add_argument("--project", required=True)
    ap.add_argument("--begin", help="ISO date; default yesterday (UTC)")
    ap.add_argument("--end", help="ISO date; default = begin")
    ap.add_argument("--suite-store")
    ap.add_argument("--suite-name", default="downloads_batch")
    ap.add_argument("--reuse-suite", action="store_true", help="load the stored suite instead of rebuilding it")
    ap.add_argument("--target", help="publish the batch here (partitioned by project and dt) if it passes")
    ap.add_argument("--per-day", action="store_true", help="gate and publish each day on its own")
    ap.add_argument("--history")
    ap.add_argument("--samples")
    ap.add_argument("--failures-allowed", type=int, default=0)
    ap.add_argument("--end-exclusive", action="store_true")
    ap.add_argument("--master")
    args = ap.parse_args(argv)

    spark = build_session(args.master)
    source = read_downloads(spark, args.source, args.format, table=args.table)
    try:
        out = run_daily(source, args.project, args.begin, args.end, suite_store=args.suite_store,
                        suite_name=args.suite_name, overwrite_suite=not args.reuse_suite,
                        target=args.target, history_path=args.history, samples_path=args.samples,
                        failures_allowed=args.failures_allowed, end_exclusive=args.end_exclusive,
                        per_day=args.per_day)
    except CheckpointFailed as exc:
        for failure in exc.failures:  # list the failed rules, then report the gate
            print(json.dumps({"failed_rule": failure}, default=str))
        print(json.dumps({"status": "failed", "message": str(exc)}))
        return 1
    run = out if isinstance(out, CheckpointRun) else out.run
    for failure in (run.failed_expectations or []) if run else []:  # failures within the allowance
        print(json.dumps({"failed_rule": failure.asDict()}, default=str))
    if isinstance(out, CheckpointRun):
        print(json.dumps({"status": "passed", "run_name": out.run_name, **out.stats}))
    else:
        stats = out.run.stats if out.run else {}
        print(json.dumps({"status": "published", "target": out.target,
                          "days": [d.isoformat() for d in out.published_days], **stats}))
    return 0


if __name__ == "__main__":
    sys.exit(main())
