"""assay - validated batches on Spark.

extract (nested source -> flat batch) -> validate (declarative column rules,
fused into a few distributed passes) -> gate -> publish (by ``dt`` partition).
"""

from .errors import (
    AssayError,
    BadParameter,
    CheckpointFailed,
    SchemaDriftError,
    SessionConfigError,
    SuiteNotFound,
)
from .functions.rules import Rule
from .operators.extract import BATCH_COLUMNS, extract_batch, extract_batch_sql, flatten
from .operators.profile import profile_columns
from .plans.by_day import validate_by_day
from .plans.checkpoint import (
    CheckpointRun,
    failed_expectations,
    gate_status,
    read_history,
    run_summaries,
    run_checkpoint,
    run_stats,
    validate,
)
from .plans.pipeline import run_daily
from .plans.publish import publish_by_day, publish_if_valid, publish_projects, publishable_rows, read_published
from .plans.suite import Suite, default_suite, load_suite, save_suite, suite_from_json, suite_to_json
from .session import build_session

__all__ = [
    "AssayError", "BadParameter", "BATCH_COLUMNS", "CheckpointFailed", "CheckpointRun", "Rule",
    "SchemaDriftError", "SessionConfigError", "Suite", "SuiteNotFound", "build_session",
    "default_suite", "extract_batch", "extract_batch_sql", "failed_expectations", "flatten",
    "gate_status", "load_suite", "profile_columns", "publish_by_day", "publish_if_valid", "publish_projects", "read_published",
    "publishable_rows", "read_history", "run_checkpoint", "run_daily", "run_summaries", "run_stats",
    "save_suite", "suite_from_json", "suite_to_json", "validate", "validate_by_day",
]
