"""The whole daily job: extract -> suite -> checkpoint -> results -> gate -> publish.

Job parameters are plain arguments (project, ISO dates; default: yesterday in UTC).
Results and failure samples are written before the gate raises.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame

from ..functions import params as P
from ..operators.extract import extract_batch
from .checkpoint import CheckpointRun, run_checkpoint
from .publish import PublishReport, publish_by_day, publish_if_valid
from .suite import DEFAULT_SUITE_NAME, Suite, default_suite, load_suite, save_suite


def suite_for(batch: DataFrame, begin, end, suite_store: str | None = None,
              suite_name: str = DEFAULT_SUITE_NAME, overwrite_suite: bool = True,
              end_exclusive: bool = False) -> Suite:
    """New default suite (saved if a store is given), or the stored one (must exist)."""
    spark = batch.sparkSession
    if overwrite_suite:
        suite = default_suite(batch.columns, begin, end, name=suite_name, end_exclusive=end_exclusive)
        if suite_store:
            save_suite(spark, suite, suite_store)
        return suite
    if not suite_store:
        raise P.BadParameter("overwrite_suite=False needs a suite_store to load from")
    return load_suite(spark, suite_store, suite_name)


def run_daily(source: DataFrame, project: str, begin: str | dt.date | None = None,
              end: str | dt.date | None = None, *, suite_store: str | None = None,
              suite_name: str = DEFAULT_SUITE_NAME, overwrite_suite: bool = True,
              target: str | None = None, history_path: str | None = None,
              samples_path: str | None = None, failures_allowed: int = 0,
              end_exclusive: bool = False, per_day: bool = False,
              staging_root: str | None = None) -> CheckpointRun | PublishReport:
    """Validate one project's batch and (with ``target``) publish it if it passes.

    Raises ``CheckpointFailed`` when more rules fail than ``failures_allowed``.
    """
    begin = P.parse_date(begin) if begin else P.default_query_date()
    end = P.parse_date(end) if end else begin
    batch = extract_batch(source, project, begin, end)
    suite = suite_for(batch, begin, end, suite_store, suite_name, overwrite_suite, end_exclusive)
    params = P.timestamp_params(begin, end, end_exclusive)
    if target and per_day:
        return publish_by_day(batch, suite, target, begin, end, failures_allowed, params,
                              history_path, staging_root, samples_path=samples_path, project=project)
    if target:
        return publish_if_valid(batch, suite, target, params, failures_allowed, history_path,
                                staging_root, data_dt=end, samples_path=samples_path, project=project)
    run = run_checkpoint(batch, suite, params, data_dt=end, history_path=history_path, project=project)
    if run.stats["failed"] > failures_allowed and samples_path:
        run.write_unexpected_values(samples_path)
    run.check_results(failures_allowed)
    return run
