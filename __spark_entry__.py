"""

Every query of the batch pipeline reads the driver's ``events`` table, derives the
nested downloads table from it (``assay.sources.downloads_from_events``, with rows
of no project and of no day) and runs one operator over the whole derived table.
Rule queries validate every project's batch in one pass (keys ``project``), or
every daily batch (keys ``project, dt``) where the rule depends on the day; only
the extract / filter queries select a project or a date range, because that is
what they do.

The oracle SQL is independent: its derivation, rules, thresholds, codes and bounds
are written out below as literals and nothing of it comes from the package.

Columns of rule results: rule_id, rule_type, column_name, mostly, element_count,
missing_count, unexpected_count, observed_value, n_modes, success (ratios are left
out of the compared output: counts and booleans only).
"""

from __future__ import annotations

import os
import sys
import tempfile
import uuid
from collections.abc import Callable

_HERE = os.path.dirname(os.path.abspath(__file__))
if _HERE not in sys.path:
    sys.path.insert(0, _HERE)

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from assay.functions import params as P  # noqa: E402
from assay.functions import rules as R  # noqa: E402
from assay.operators.extract import BATCH_COLUMNS, date_filter, extract_batch, extract_batch_sql, flatten  # noqa: E402
from assay.operators.modes import mode_results, tied_modes  # noqa: E402
from assay.operators.profile import profile_columns  # noqa: E402
from assay.operators.samples import top_values, unexpected_values  # noqa: E402
from assay.plans.by_day import validate_by_day  # noqa: E402
from assay.plans.checkpoint import failed_expectations, gate_status, read_history, run_stats, run_summaries, validate  # noqa: E402
from assay.plans.history import append_results, compact_history  # noqa: E402
from assay.plans.publish import publish_by_day, publish_projects, publishable_rows, read_published  # noqa: E402
from assay.plans.suite import Suite, default_suite  # noqa: E402
from assay.plans.state import results_from_state, update_state  # noqa: E402
from assay.session import checkpoint_root, ensure_checkpoint_dir  # noqa: E402
from assay.sources.countries import country_dim  # noqa: E402
from assay.sources.downloads import downloads_from_events  # noqa: E402
from assay.sources.tables import read_table  # noqa: E402

# The training-data operators are optional: their folders may be absent.  Only their
# own absence is tolerated, an import that fails inside them is an error.
try:
    import assay.llm.registry as _llm
except ModuleNotFoundError as missing:
    if missing.name not in ("assay.llm", "assay.llm.registry"):
        raise
    _llm = None
try:
    import corpus_pipeline as _pipeline
except ModuleNotFoundError as missing:
    if missing.name != "corpus_pipeline" and not (_llm is None and str(missing.name).startswith("assay.llm")):
        raise
    _pipeline = None

SMOKE_DIR = "/root/testdata/sf0.001"

RULE_OUT = ["rule_id", "rule_type", "column_name", "mostly", "element_count", "missing_count",
            "unexpected_count", "observed_value", "n_modes", "success"]

#: Run-time bounds of the time rule where a project's whole batch is checked (a rule argument, not a row filter).
BOUNDS = ("2024-01-01", "2024-01-30")
CLICK = ("click", "2024-01-01", "2024-01-30")
VIEW = ("view", "2024-01-01", "2024-01-30")
PUBLISH_FAILURES_ALLOWED = 4
TOP_K = 3
PROJECT = ["project"]
DAILY = ["project", "dt"]


# --------------------------------------------------------------------------
# Spark side
# --------------------------------------------------------------------------

def _source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return downloads_from_events(read_table(spark, sf_dir, "events"), null_keys=True)


def _batch(spark: SparkSession, sf_dir: str, spec) -> DataFrame:
    project, begin, end = spec
    return extract_batch(_source(spark, sf_dir), project, begin, end)


def _all_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every project's batch: all flat rows plus their ``project`` key."""
    return flatten(_source(spark, sf_dir), F.col("file.project").alias("project"))


def _days(batches: DataFrame) -> tuple:
    """First and last day of the data."""
    r = batches.agg(F.min("dt").alias("a"), F.max("dt").alias("b")).first()
    return r.a, r.b


def _suite(keep: Callable[[R.Rule], bool] | None = None, begin=BOUNDS[0], end=BOUNDS[1]) -> Suite:
    suite = default_suite(list(BATCH_COLUMNS), begin, end)
    if keep is not None:
        suite = Suite(suite.name, [r for r in suite.rules if keep(r)], suite.params)
    return suite


def _rule_query(keep: Callable[[R.Rule], bool], daily: bool):
    """Rules of one kind on every project's batch (daily: every project x day batch)."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        keys = DAILY if daily else PROJECT
        params = P.day_params("dt") if daily else None
        return validate(_all_batches(spark, sf_dir), _suite(keep), params, group_cols=keys).select(*keys, *RULE_OUT)
    return run


def _is_strict_not_null(r: R.Rule) -> bool:
    return r.kind == R.NOT_NULL and r.mostly == 1.0


def _is_mostly_not_null(r: R.Rule) -> bool:
    return r.kind == R.NOT_NULL and r.mostly < 1.0


def _kind(kind: str) -> Callable[[R.Rule], bool]:
    return lambda r: r.kind == kind


def q_scan_flatten(spark, sf_dir):
    return flatten(_source(spark, sf_dir))


def q_extract_batch(spark, sf_dir):
    return _batch(spark, sf_dir, CLICK)


def q_extract_batch_sql(spark, sf_dir):
    project, begin, end = VIEW
    return extract_batch_sql(spark, _source(spark, sf_dir), project, begin, end)


def q_filter_project(spark, sf_dir):
    src = _source(spark, sf_dir)
    return flatten(src.where(F.col("file.project") == F.lit("signup")))


def q_filter_date_range(spark, sf_dir):
    src = _source(spark, sf_dir)
    return flatten(src.where(date_filter(src, "2024-01-01", "2024-01-04")))


def q_flatten_null_parent(spark, sf_dir):
    src = _source(spark, sf_dir)
    flat = flatten(src, F.col("details").isNull().alias("details_is_null"))
    nested = ["python_version", "installer_name", "installer_version", "distro_name",
              "distro_version", "system_name", "system_version"]
    return flat.groupBy("details_is_null").agg(
        F.count(F.lit(1)).alias("n_rows"), *[F.count(c).alias(f"nn_{c}") for c in nested])


def q_coalesce_version(spark, sf_dir):
    return flatten(_source(spark, sf_dir)).groupBy("python_version").agg(F.count(F.lit(1)).alias("n_rows"))


def q_derive_dt(spark, sf_dir):
    return flatten(_source(spark, sf_dir)).groupBy("dt").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min("download_time").alias("first_time"),
        F.max("download_time").alias("last_time"))


def q_profile_columns(spark, sf_dir):
    return profile_columns(flatten(_source(spark, sf_dir)))


def q_expect_between_param_override(spark, sf_dir):
    """Suite stored with stale (previous-day) bounds; the run's own bounds win."""
    suite = _suite(_kind(R.BETWEEN), "2023-12-31", "2023-12-31")
    run_params = P.timestamp_params(*BOUNDS)
    return validate(_all_batches(spark, sf_dir), suite, run_params, group_cols=PROJECT).select(*PROJECT, *RULE_OUT)


def q_expect_in_set_broadcast(spark, sf_dir):
    """Country set as a dimension DataFrame: value counts anti-joined to it."""
    rule = R.Rule(R.IN_SET, "country_code", 0.99, {"value_set": country_dim(spark)})
    return validate(_all_batches(spark, sf_dir), Suite("in_set_dim", [rule]), group_cols=DAILY) \
        .select(*DAILY, *RULE_OUT)


def q_expect_in_set_codes(spark, sf_dir):
    """All two-letter codes against the country set, the literal and the table form."""
    i = F.col("event_id")
    letter = lambda x: F.char(65 + x % 26)
    pairs = read_table(spark, sf_dir, "events").select(
        F.concat(letter(i), letter(F.floor(i / 26))).alias("code"), (i % 10).alias("part"))
    literal = R.Rule(R.IN_SET, "code", 0.3, dict(_suite(_kind(R.IN_SET)).rules[0].kwargs))
    in_table = R.Rule(R.IN_SET, "code", 0.3, {"value_set": country_dim(spark)})
    both = [validate(pairs, Suite(form, [rule]), group_cols=["part"]).withColumn("form", F.lit(form))
            for form, rule in (("list", literal), ("table", in_table))]
    return both[0].unionByName(both[1]).select("form", "part", *RULE_OUT)


def q_expect_type_mismatch(spark, sf_dir):
    """Type rules that fail, beside ones that pass."""
    rules = [R.Rule(R.OF_TYPE, c, kwargs={"type_": t}) for c, t in
             (("download_time", "Timestamp"), ("country_code", "Timestamp"), ("dt", "int64"), ("pkg_version", "string"))]
    return validate(_all_batches(spark, sf_dir), Suite("types", rules), group_cols=PROJECT).select(*PROJECT, *RULE_OUT)


def q_typed_rules(spark, sf_dir):
    """Bounds and members of another type than the column: whole numbers, doubles, dates with a time."""
    events = read_table(spark, sf_dir, "events").select(
        "event_type", (F.col("event_id") % 5).cast("int").alias("small"), F.floor("value").cast("double").alias("whole"),
        F.to_date("ts").alias("day"), F.col("value").alias("value"))
    rules = [
        R.Rule(R.BETWEEN, "small", 0.5, {"min_value": 1.5}),
        R.Rule(R.BETWEEN, "small", 0.5, {"max_value": 3.0, "strict_max": True}),
        R.Rule(R.BETWEEN, "day", 0.5, {"min_value": "2024-01-04T12:00:00"}),
        R.Rule(R.BETWEEN, "value", 0.5, {"max_value": 100}),
        R.Rule(R.IN_SET, "whole", 0.1, {"value_set": list(range(0, 400, 2))}),
        R.Rule(R.MODE_IN_SET, "whole", kwargs={"value_set": list(range(1000))}),
    ]
    return validate(events, Suite("typed", rules), group_cols=["event_type"]).select("event_type", *RULE_OUT)


def _tie_rules():
    return [(1, R.Rule(R.MODE_IN_SET, "distro_name", kwargs={"value_set": ["Ubuntu"]})),
            (2, R.Rule(R.MODE_IN_SET, "part", kwargs={"value_set": [7]}))]


def _ties(spark, sf_dir):
    """Two names and fifty numbers that tie (on the test tables, whose row counts are multiples of 50)."""
    i = F.col("event_id")
    return read_table(spark, sf_dir, "events").select(
        F.when(i % 2 == 0, "Ubuntu").otherwise("Debian").alias("distro_name"), (i % 50).alias("part"))


def q_most_common_ties(spark, sf_dir):
    return mode_results(_ties(spark, sf_dir), _tie_rules()).select(*RULE_OUT)


def q_tied_modes(spark, sf_dir):
    return tied_modes(_ties(spark, sf_dir), _tie_rules())


def _project_results(spark, sf_dir):
    return validate(_all_batches(spark, sf_dir), _suite(), group_cols=PROJECT)


def q_validate_suite(spark, sf_dir):
    return _project_results(spark, sf_dir).select(*PROJECT, *RULE_OUT)


def q_run_stats(spark, sf_dir):
    return run_stats(_project_results(spark, sf_dir), PROJECT)


def q_failed_expectations(spark, sf_dir):
    return failed_expectations(_project_results(spark, sf_dir)).select(*PROJECT, *RULE_OUT)


def q_gate_status(spark, sf_dir):
    return gate_status(run_stats(_project_results(spark, sf_dir), PROJECT), failures_allowed=0)


def q_unexpected_values(spark, sf_dir):
    """Failure listing: every unexpected value of each project's failed row-level rules."""
    suite = _suite()
    failed = failed_expectations(_project_results(spark, sf_dir)).select(
        F.col("project").alias("f_project"), F.col("rule_id").alias("f_rule"))
    ids = {r.f_rule for r in failed.select("f_rule").distinct().collect()}  # rules that failed somewhere: at most 20
    values = unexpected_values(_all_batches(spark, sf_dir), [(i, r) for i, r in suite.numbered() if i in ids],
                               P.merge_params(suite.params, None), group_cols=PROJECT)
    same = F.col("project").eqNullSafe(F.col("f_project")) & (F.col("rule_id") == F.col("f_rule"))
    return values.join(failed, same, "left_semi")  # failed (project, rule) pairs: at most projects x rules rows


def q_unexpected_samples(spark, sf_dir):
    """The most frequent of them per project and rule."""
    return top_values(q_unexpected_values(spark, sf_dir), TOP_K, PROJECT).withColumnRenamed("rank", "sample_rank")


def q_validate_by_day(spark, sf_dir):
    batches = _all_batches(spark, sf_dir)
    return validate_by_day(batches, _suite(), *_days(batches), by=PROJECT).select(*DAILY, *RULE_OUT)


def q_expect_in_set_tables(spark, sf_dir):
    """Several rules with a value table, beside mode rules: one value count for all of them."""
    allowed = lambda *values: spark.createDataFrame([(v,) for v in values], "allowed string")
    rules = [R.Rule(R.IN_SET, "country_code", 0.99, {"value_set": country_dim(spark)}),
             R.Rule(R.IN_SET, "file_type", 0.8, {"value_set": allowed("bdist_wheel", None)}),
             R.Rule(R.IN_SET, "distro_name", 0.4, {"value_set": allowed("Ubuntu", "Ubuntu", "Arch")}),
             R.Rule(R.IN_SET, "pkg_version", 0.1, {"value_set": _source(spark, sf_dir).where("country_code = 'US'").select("file.version")})]
    rules += _suite(_kind(R.MODE_IN_SET)).rules
    return validate(_all_batches(spark, sf_dir), Suite("tables", rules), group_cols=DAILY).select(*DAILY, *RULE_OUT)


def q_validate_two_scans(spark, sf_dir):
    """The 20-rule suite on every project's batch from a fused aggregate and a value count (two scans)."""
    return validate(_all_batches(spark, sf_dir), _suite(), group_cols=PROJECT, one_scan=False).select(*PROJECT, *RULE_OUT)


def q_incremental_backfill(spark, sf_dir):
    """Days validated as they come in (some twice), merged to each project's results over all days."""
    batches, suite = _all_batches(spark, sf_dir), _suite()
    begin, end = _days(batches)
    path = _scratch(spark, "state")
    middle = begin + (end - begin) / 2
    update_state(batches, suite, path, begin, middle)
    update_state(batches, suite, path, begin, end, again=[middle])
    return results_from_state(spark, path, suite, batches.schema, begin, end).select(*PROJECT, *RULE_OUT)


def _scratch(spark, name: str) -> str:
    """A fresh folder below the shared one."""
    if spark.sparkContext.master.startswith("local["):  # a session without a shared folder; on a cluster it is an error
        ensure_checkpoint_dir(spark, os.path.join(tempfile.gettempdir(), "assay-checkpoints"))
    return f"{checkpoint_root(spark)}/assay-{name}-{uuid.uuid4().hex}"


def q_publish_if_valid(spark, sf_dir):
    """All projects published to a new target, and read back from there."""
    batches, target = _all_batches(spark, sf_dir), _scratch(spark, "target")
    publish_projects(batches, _suite(), target, *_days(batches), failures_allowed=PUBLISH_FAILURES_ALLOWED)
    return read_published(spark, target, schema=batches.schema).select(*PROJECT, *BATCH_COLUMNS)


def q_publishable_rows(spark, sf_dir):
    """The same rows without a target."""
    _scratch(spark, "staging")
    batches = _all_batches(spark, sf_dir)
    return publishable_rows(batches, _suite(), *_days(batches), failures_allowed=PUBLISH_FAILURES_ALLOWED) \
        .select(*PROJECT, *BATCH_COLUMNS)


def q_publish_again(spark, sf_dir):
    """One project published by day into a target that holds all others: its failing days stay, other projects' rows too."""
    batches, target = _all_batches(spark, sf_dir), _scratch(spark, "target")
    begin, end = _days(batches)
    publish_projects(batches, _suite(), target, begin, end, failures_allowed=len(_suite().rules))
    mine = batches.where("project = 'view' AND dt IS NOT NULL").withColumn("country_code", F.lit("US")).drop("project")
    publish_by_day(mine, _suite(), target, begin, end, failures_allowed=PUBLISH_FAILURES_ALLOWED, raise_on_failure=False, project="view")
    return read_published(spark, target).groupBy("project", "dt", "country_code").agg(F.count(F.lit(1)).alias("n"))


def q_result_history(spark, sf_dir):
    """Daily runs appended to a history, compacted, and read back: one row per run."""
    batches, suite = _all_batches(spark, sf_dir), _suite()
    path = _scratch(spark, "history")
    results = validate_by_day(batches, suite, *_days(batches), by=PROJECT)
    for half in (0, 1):     # two writers, each with some days
        append_results(results.where(F.pmod(F.coalesce(F.dayofmonth("dt"), F.lit(0)), F.lit(2)) == half), suite.name, path)
    compact_history(spark, path)
    return run_summaries(read_history(spark, path)).select("project", F.col("data_dt").alias("dt"), "evaluated", "failed", "passed", "success")


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: the full 20-rule suite on every project's batch of sf0.001, in one pass."""
    return q_validate_suite(spark, SMOKE_DIR)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "scan_flatten": q_scan_flatten,
        "extract_batch": q_extract_batch,
        "extract_batch_sql": q_extract_batch_sql,
        "filter_project": q_filter_project,
        "filter_date_range": q_filter_date_range,
        "flatten_null_parent": q_flatten_null_parent,
        "coalesce_version": q_coalesce_version,
        "derive_dt": q_derive_dt,
        "profile_columns": q_profile_columns,
        "expect_not_null": _rule_query(_is_strict_not_null, daily=False),
        "expect_mostly_not_null": _rule_query(_is_mostly_not_null, daily=False),
        "expect_type": _rule_query(_kind(R.OF_TYPE), daily=False),
        "expect_between": _rule_query(_kind(R.BETWEEN), daily=True),
        "expect_between_param_override": q_expect_between_param_override,
        "expect_in_set": _rule_query(_kind(R.IN_SET), daily=True),
        "expect_in_set_broadcast": q_expect_in_set_broadcast,
        "expect_in_set_codes": q_expect_in_set_codes,
        "expect_in_set_tables": q_expect_in_set_tables,
        "expect_type_mismatch": q_expect_type_mismatch,
        "typed_rules": q_typed_rules,
        "expect_most_common_in_set": _rule_query(_kind(R.MODE_IN_SET), daily=True),
        "most_common_ties": q_most_common_ties,
        "tied_modes": q_tied_modes,
        "expect_regex": _rule_query(_kind(R.MATCH_REGEX), daily=False),
        "validate_suite": q_validate_suite,
        "validate_two_scans": q_validate_two_scans,
        "incremental_backfill": q_incremental_backfill,
        "run_stats": q_run_stats,
        "failed_expectations": q_failed_expectations,
        "gate_status": q_gate_status,
        "unexpected_values": q_unexpected_values,
        "unexpected_samples": q_unexpected_samples,
        "validate_by_day": q_validate_by_day,
        "publish_if_valid": q_publish_if_valid,
        "publishable_rows": q_publishable_rows,
        "publish_again": q_publish_again,
        "result_history": q_result_history,
        **(_llm.QUERIES if _llm else {}),
        **({"pipeline": _pipeline.run} if _pipeline else {}),
    }


# --------------------------------------------------------------------------
# DuckDB oracle
# --------------------------------------------------------------------------

# Flat downloads rows straight from events.
DOWNLOADS_SQL = """
SELECT
  CASE WHEN event_id % 97 <> 0 THEN event_type END AS project,
  CASE WHEN event_id % 101 <> 0 THEN ts END AS download_time,
  CASE WHEN event_id % 200 = 0 THEN 'QQ' WHEN event_id % 100 = 50 THEN NULL
       WHEN event_id % 3 = 0 THEN 'US' ELSE 'DE' END AS country_code,
  CASE WHEN event_id % 4 = 0 THEN 'sdist' ELSE 'bdist_wheel' END AS file_type,
  CAST(event_id % 3 AS VARCHAR) || '.' || CAST(event_id % 120 AS VARCHAR) || '.'
    || CAST(event_id % 10 AS VARCHAR) AS pkg_version,
  CASE WHEN event_id % 50 = 0 THEN NULL WHEN event_id % 5 <> 0 THEN '3.10'
       WHEN event_id % 25 <> 0 THEN '3.9' END AS python_version,
  CASE WHEN event_id % 50 = 0 OR event_id % 6 = 0 THEN NULL ELSE 'pip' END AS installer_name,
  CASE WHEN event_id % 50 = 0 OR event_id % 6 = 0 THEN NULL ELSE '23.0' END AS installer_version,
  CASE WHEN event_id % 50 = 0 THEN NULL WHEN event_id % 2 = 0 THEN 'Ubuntu' ELSE 'Debian' END AS distro_name,
  CASE WHEN event_id % 50 = 0 THEN NULL ELSE '22.04' END AS distro_version,
  CASE WHEN event_id % 50 = 0 THEN NULL ELSE 'Linux' END AS system_name,
  CASE WHEN event_id % 50 = 0 THEN NULL ELSE '5.4' END AS system_version,
  CASE WHEN event_id % 101 <> 0 THEN CAST(ts AS DATE) END AS dt,
  event_id % 50 = 0 AS details_is_null
FROM events
"""

FLAT = ("download_time, country_code, file_type, pkg_version, python_version, installer_name, installer_version, "
        "distro_name, distro_version, system_name, system_version, dt")
ALL_BATCHES_SQL = f"SELECT project, {FLAT} FROM ({DOWNLOADS_SQL}) d"

# Country codes, rule kinds, and the 20 rules as (kind, column, mostly, argument).
CODES = """

AD AE AF AG AI AL AM AN AO AQ AR AS AT AU AW AZ BA BB BD BE BF BG BH BI BJ BM BN BO BR BS BT BU BV BW BY BZ CA
CC CF CG CH CI CK CL CM CN CO CR CS CU CV CX CY CZ DD DE DJ DK DM DO DZ EC EE EG EH ER ES ET FI FJ FK FM FO FR
FX GA GB GD GE GF GH GI GL GM GN GP GQ GR GS GT GU GW GY HK HM HN HR HT HU ID IE IL IN IO IQ IR IS IT JM JO JP
KE KG KH KI KM KN KP KR KW KY KZ LA LB LC LI LK LR LS LT LU LV LY MA MC MD MG MH ML MM MN MO MP MQ MR MS MT MU
MV MW MX MY MZ NA NC NE NF NG NI NL NO NP NR NT NU NZ OM PA PE PF PG PH PK PL PM PN PR PT PW PY QA RE RO RU RW
SA SB SC SD SE SG SH SI SJ SK SL SM SN SO SR ST SU SV SY SZ TC TD TF TG TH TJ TK TM TN TO TP TR TT TV TW TZ UA
UG UM US UY UZ VA VC VE VG VI VN VU WF WS YD YE YT YU ZA ZM ZR ZW ZZ
""".split()
O_NULL = "expect_column_values_to_not_be_null"
O_TYPE = "expect_column_values_to_be_of_type"
O_BETWEEN = "expect_column_values_to_be_between"
O_SET = "expect_column_values_to_be_in_set"
O_MODE = "expect_column_most_common_value_to_be_in_set"
O_REGEX = "expect_column_values_to_match_regex"
RUN_BOUNDS = "{c} >= TIMESTAMP '2024-01-01 00:00:00' AND {c} <= TIMESTAMP '2024-01-30 23:59:59'"
DAY_BOUNDS = "{c} >= CAST(b.dt AS TIMESTAMP) AND {c} <= CAST(b.dt AS TIMESTAMP) + INTERVAL 86399 SECOND"
O_RULES = [
    (O_NULL, "download_time", 1.0, None),
    (O_NULL, "country_code", 1.0, None),
    (O_NULL, "file_type", 1.0, None),
    (O_NULL, "pkg_version", 1.0, None),
    (O_NULL, "dt", 1.0, None),
    (O_NULL, "python_version", 0.95, None),
    (O_NULL, "installer_name", 0.95, None),
    (O_NULL, "installer_version", 0.95, None),
    (O_NULL, "distro_name", 0.95, None),
    (O_NULL, "distro_version", 0.95, None),
    (O_NULL, "system_name", 0.95, None),
    (O_NULL, "system_version", 0.95, None),
    (O_TYPE, "download_time", 1.0, ("timestamp_ntz", True)),
    (O_BETWEEN, "download_time", 1.0, RUN_BOUNDS),
    (O_SET, "country_code", 0.99, [f"'{c}'" for c in CODES]),
    (O_MODE, "file_type", 1.0, ["'bdist_wheel'"]),
    (O_MODE, "installer_name", 1.0, ["'pip'"]),
    (O_MODE, "distro_name", 1.0, ["'Ubuntu'"]),
    (O_MODE, "system_name", 1.0, ["'Linux'"]),
    (O_REGEX, "pkg_version", 0.95, r"^(\d{1}\.\d{1,2}\.\d{1,2}$)"),
]


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _batch_sql(project: str) -> str:
    return (f"SELECT {FLAT} FROM ({DOWNLOADS_SQL}) d WHERE project = '{project}' "
            f"AND dt BETWEEN DATE '2024-01-01' AND DATE '2024-01-30'")


def _broken_sql(rule, c: str) -> str:
    """TRUE where a non-null value breaks a row-level rule."""
    kind, _, _, arg = rule
    if kind == O_NULL:
        return f"{c} IS NULL"
    if kind == O_BETWEEN:
        return f"NOT ({arg.format(c=c)})"
    if kind == O_SET:
        return f"{c} NOT IN ({', '.join(arg)})"
    return f"NOT regexp_matches({c}, {_q(arg)})"


def _same(a: str, b: str, keys) -> str:
    return " AND ".join(f"{a}.{k} IS NOT DISTINCT FROM {b}.{k}" for k in keys) or "TRUE"


def _results_sql(rules, batch_sql: str, keys=(), spine_sql: str | None = None) -> str:
    """One results row per (group, rule).  Groups are those of the batch, or the rows of ``spine_sql`` (from ``kb``)."""
    keys = list(keys)
    by = f" GROUP BY {', '.join(keys)}" if keys else ""
    head = "".join(f"{k}, " for k in keys)
    columns = list(dict.fromkeys(r[1] for r in rules))
    aggs = ["count(*) AS m_n"] + [f"count(*) - count({c}) AS m_null_{i}" for i, c in enumerate(columns)]
    for i, r in enumerate(rules, start=1):
        if r[0] in (O_BETWEEN, O_SET, O_REGEX):
            aggs.append(f"count(*) FILTER (WHERE {_broken_sql(r, 'b.' + r[1])}) AS m_bad_{i}")
    ctes = [f"kb AS ({batch_sql})", f"m AS (SELECT {head}{', '.join(aggs)} FROM kb b{by})"]
    if spine_sql:
        names = [a.rsplit(" AS ", 1)[1] for a in aggs]
        ctes += [f"spine AS ({spine_sql})",
                 f"agg AS (SELECT {', '.join('s.' + k for k in keys)}, {', '.join(f'coalesce(m.{n}, 0) AS {n}' for n in names)} "
                 f"FROM spine s LEFT JOIN m ON {_same('s', 'm', keys)})"]
    else:
        ctes.append("agg AS (SELECT * FROM m)")
    rows = []
    for i, (kind, c, mostly, arg) in enumerate(rules, start=1):
        null = f"a.m_null_{columns.index(c)}"
        parts = {"missing": null, "bad": "CAST(NULL AS BIGINT)", "seen": "CAST(NULL AS VARCHAR)",
                 "modes": "CAST(NULL AS BIGINT)", "join": ""}
        if kind == O_NULL:
            parts |= {"bad": null, "ok": f"a.m_n = 0 OR CAST(a.m_n - {null} AS DOUBLE) / a.m_n >= {mostly}"}
        elif kind == O_TYPE:
            parts |= {"missing": "CAST(NULL AS BIGINT)", "seen": f"'{arg[0]}'", "ok": str(arg[1]).upper()}
        elif kind == O_MODE:
            ctes += [
                f"vc_{i} AS (SELECT {head}{c} AS v, count(*) AS n FROM kb WHERE {c} IS NOT NULL GROUP BY {head}{c})",
                f"top_{i} AS (SELECT {head}max(n) AS top_n FROM vc_{i}{by})",
                f"ms_{i} AS (SELECT {''.join(f'v.{k}, ' for k in keys)}count(*) AS n_modes, min({arg_text(c, 'v.v')}) AS seen, "
                f"count(*) FILTER (WHERE v.v IN ({', '.join(arg)})) AS n_in FROM vc_{i} v JOIN top_{i} t "
                f"ON v.n = t.top_n AND {_same('v', 't', keys)}{' GROUP BY ' + ', '.join('v.' + k for k in keys) if keys else ''})"]
            parts |= {"seen": "ms.seen", "modes": "coalesce(ms.n_modes, 0)", "ok": "coalesce(ms.n_modes = 1 AND ms.n_in = 1, FALSE)",
                      "join": f" LEFT JOIN ms_{i} ms ON {_same('a', 'ms', keys)}"}
        else:
            held = f"(a.m_n - {null})"
            parts |= {"bad": f"a.m_bad_{i}", "ok": f"{held} = 0 OR CAST({held} - a.m_bad_{i} AS DOUBLE) / {held} >= {mostly}"}
        rows.append(
            f"SELECT {''.join(f'a.{k}, ' for k in keys)}CAST({i} AS INTEGER) AS rule_id, '{kind}' AS rule_type, "
            f"'{c}' AS column_name, CAST({mostly} AS DOUBLE) AS mostly, a.m_n AS element_count, {parts['missing']} AS missing_count, "
            f"{parts['bad']} AS unexpected_count, {parts['seen']} AS observed_value, {parts['modes']} AS n_modes, "
            f"({parts['ok']}) AS success FROM agg a{parts['join']}")
    return f"WITH {', '.join(ctes)} SELECT * FROM ({' UNION ALL '.join(rows)}) r"


def arg_text(column: str, value: str) -> str:
    """A mode's value as Spark writes it: doubles that are whole keep one decimal."""
    return f"CAST({value} AS DECIMAL(18, 1))::VARCHAR" if column == "whole" else f"CAST({value} AS VARCHAR)"


def _kinds(*kinds, mostly=None):
    return [r for r in O_RULES if r[0] in kinds and (mostly is None or (r[2] < 1) == mostly)]


def _per_day(rules):
    return [(k, c, m, DAY_BOUNDS if k == O_BETWEEN else a) for k, c, m, a in rules]


DAY_SPINE_SQL = """
SELECT p.project, d.dt FROM (SELECT DISTINCT project FROM kb) p,
  (SELECT CAST(unnest(generate_series(min(dt), max(dt), INTERVAL 1 DAY)) AS DATE) AS dt FROM kb) d
UNION ALL SELECT DISTINCT project, dt FROM kb WHERE dt IS NULL
"""
CODE_PAIRS_SQL = ("SELECT chr(CAST(65 + event_id % 26 AS INTEGER)) || chr(CAST(65 + (event_id // 26) % 26 AS INTEGER)) AS code, "
                  "event_id % 10 AS part FROM events")
TIES_SQL = ("SELECT CASE WHEN event_id % 2 = 0 THEN 'Ubuntu' ELSE 'Debian' END AS distro_name, "
            "event_id % 50 AS part FROM events")
TYPED_SQL = ("SELECT event_type, CAST(event_id % 5 AS INTEGER) AS small, floor(value) AS whole, CAST(ts AS DATE) AS day, "
             "value FROM events")
TYPED_RULES = [
    (O_BETWEEN, "small", 0.5, "{c} >= 1.5"),
    (O_BETWEEN, "small", 0.5, "{c} < 3"),
    (O_BETWEEN, "day", 0.5, "CAST({c} AS TIMESTAMP) >= TIMESTAMP '2024-01-04 12:00:00'"),
    (O_BETWEEN, "value", 0.5, "{c} <= 100"),
    (O_SET, "whole", 0.1, [str(n) for n in range(0, 400, 2)]),
    (O_MODE, "whole", 1.0, [str(n) for n in range(1000)]),
]
TABLE_RULES = [
    (O_SET, "country_code", 0.99, [f"'{c}'" for c in CODES]),
    (O_SET, "file_type", 0.8, ["'bdist_wheel'"]),
    (O_SET, "distro_name", 0.4, ["'Ubuntu'", "'Arch'"]),
    (O_SET, "pkg_version", 0.1, [f"SELECT pkg_version FROM ({DOWNLOADS_SQL}) u WHERE country_code = 'US'"]),
    *[r for r in O_RULES if r[0] == O_MODE],
]
TIE_RULES = [(O_MODE, "distro_name", 1.0, ["'Ubuntu'"]), (O_MODE, "part", 1.0, ["7"])]
TYPE_RULES = [(O_TYPE, "download_time", 1.0, ("timestamp_ntz", True)), (O_TYPE, "country_code", 1.0, ("string", False)),
              (O_TYPE, "dt", 1.0, ("date", False)), (O_TYPE, "pkg_version", 1.0, ("string", True))]


def _values_sql() -> str:
    """Every unexpected value of the failed row-level rules, per project."""
    row_rules = [(i, r) for i, r in enumerate(O_RULES, start=1) if r[0] not in (O_TYPE, O_MODE)]
    hits = " UNION ALL ".join(
        f"SELECT project, CAST({i} AS INTEGER) AS rule_id, '{r[1]}' AS column_name, CAST({r[1]} AS VARCHAR) AS value "
        f"FROM batch b WHERE {_broken_sql(r, r[1])}" for i, r in row_rules)
    return (f"WITH batch AS ({ALL_BATCHES_SQL}), hits AS ({hits}), res AS ({_results_sql(O_RULES, ALL_BATCHES_SQL, PROJECT)}) "
            f"SELECT h.project, h.rule_id, h.column_name, h.value, count(*) AS n FROM hits h "
            f"WHERE EXISTS (SELECT 1 FROM res f WHERE NOT f.success AND f.rule_id = h.rule_id "
            f"AND f.project IS NOT DISTINCT FROM h.project) GROUP BY h.project, h.rule_id, h.column_name, h.value")


def _stats_sql() -> str:
    return (f"SELECT project, count(*) AS evaluated, count(*) FILTER (WHERE NOT success) AS failed, "
            f"count(*) FILTER (WHERE success) AS passed FROM ({_results_sql(O_RULES, ALL_BATCHES_SQL, PROJECT)}) r GROUP BY project")


def oracle_sql() -> dict[str, str]:
    extra = dict(_llm.ORACLE_SQL) if _llm else {}
    if _pipeline and _pipeline.ORACLE_SQL:
        extra["pipeline"] = _pipeline.ORACLE_SQL
    return {**_batch_oracle_sql(), **extra}


def _batch_oracle_sql() -> dict[str, str]:
    nested = ["python_version", "installer_name", "installer_version", "distro_name",
              "distro_version", "system_name", "system_version"]
    flat_all = f"SELECT {FLAT} FROM ({DOWNLOADS_SQL}) d"
    types = {"download_time": "timestamp_ntz", "dt": "date"}
    profile_rows = " UNION ALL ".join(
        f"SELECT CAST({i + 1} AS INTEGER) AS position, '{c}' AS column_name, "
        f"'{types.get(c, 'string')}' AS data_type, count({c}) AS non_null, count(*) AS row_count FROM flat"
        for i, c in enumerate(FLAT.split(", ")))
    by_project = lambda rules: _results_sql(rules, ALL_BATCHES_SQL, PROJECT)
    daily = lambda rules: _results_sql(_per_day(rules), ALL_BATCHES_SQL, DAILY)
    by_day = _results_sql(_per_day(O_RULES), ALL_BATCHES_SQL, DAILY, DAY_SPINE_SQL)
    codes = _results_sql([(O_SET, "code", 0.3, [f"'{c}'" for c in CODES])], CODE_PAIRS_SQL, ["part"])
    published = (f"WITH res AS ({by_day}), good AS (SELECT project, dt FROM res GROUP BY project, dt "
                 f"HAVING count(*) FILTER (WHERE NOT success) <= 4) SELECT project, {FLAT} FROM ({ALL_BATCHES_SQL}) b WHERE EXISTS "
                 f"(SELECT 1 FROM good g WHERE {_same('g', 'b', DAILY)})")
    tied = " UNION ALL ".join(
        f"SELECT CAST({i} AS INTEGER) AS rule_id, '{c}' AS column_name, CAST(v AS VARCHAR) AS value, n FROM "
        f"(SELECT {c} AS v, count(*) AS n, max(count(*)) OVER () AS top_n FROM t GROUP BY {c}) x WHERE n = top_n"
        for i, (_, c, _, _) in enumerate(TIE_RULES, start=1))
    return {
        "scan_flatten": flat_all,
        "extract_batch": _batch_sql("click"),
        "extract_batch_sql": _batch_sql("view"),
        "filter_project": f"SELECT {FLAT} FROM ({DOWNLOADS_SQL}) d WHERE project = 'signup'",
        "filter_date_range": f"SELECT {FLAT} FROM ({DOWNLOADS_SQL}) d "
                             f"WHERE dt BETWEEN DATE '2024-01-01' AND DATE '2024-01-04'",
        "flatten_null_parent": f"SELECT details_is_null, count(*) AS n_rows, "
                               + ", ".join(f"count({c}) AS nn_{c}" for c in nested)
                               + f" FROM ({DOWNLOADS_SQL}) d GROUP BY details_is_null",
        "coalesce_version": f"SELECT python_version, count(*) AS n_rows FROM ({DOWNLOADS_SQL}) d "
                            f"GROUP BY python_version",
        "derive_dt": f"SELECT dt, count(*) AS n_rows, min(download_time) AS first_time, "
                     f"max(download_time) AS last_time FROM ({DOWNLOADS_SQL}) d GROUP BY dt",
        "profile_columns": f"WITH flat AS ({flat_all}) {profile_rows}",
        "expect_not_null": by_project(_kinds(O_NULL, mostly=False)),
        "expect_mostly_not_null": by_project(_kinds(O_NULL, mostly=True)),
        "expect_type": by_project(_kinds(O_TYPE)),
        "expect_type_mismatch": by_project(TYPE_RULES),
        "expect_between": daily(_kinds(O_BETWEEN)),
        "expect_between_param_override": by_project(_kinds(O_BETWEEN)),
        "expect_in_set": daily(_kinds(O_SET)),
        "expect_in_set_broadcast": daily(_kinds(O_SET)),
        "expect_in_set_tables": _results_sql(TABLE_RULES, ALL_BATCHES_SQL, DAILY),
        "expect_in_set_codes": f"SELECT f.form, r.* FROM ({codes}) r, (VALUES ('list'), ('table')) f(form)",
        "expect_most_common_in_set": daily(_kinds(O_MODE)),
        "most_common_ties": _results_sql(TIE_RULES, TIES_SQL),
        "tied_modes": f"WITH t AS ({TIES_SQL}) {tied}",
        "typed_rules": _results_sql(TYPED_RULES, TYPED_SQL, ["event_type"]),
        "expect_regex": by_project(_kinds(O_REGEX)),
        "validate_suite": by_project(O_RULES),
        "validate_two_scans": by_project(O_RULES),
        "incremental_backfill": _results_sql(_per_day(O_RULES), f"SELECT * FROM ({ALL_BATCHES_SQL}) x WHERE dt IS NOT NULL", PROJECT),
        "run_stats": _stats_sql(),
        "failed_expectations": f"SELECT * FROM ({by_project(O_RULES)}) r WHERE NOT success",
        "gate_status": f"SELECT *, CAST(0 AS INTEGER) AS failures_allowed, failed <= 0 AS gate_passed "
                       f"FROM ({_stats_sql()}) s",
        "unexpected_values": _values_sql(),
        "unexpected_samples": f"SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY project, rule_id "
                              f"ORDER BY n DESC, value ASC NULLS FIRST) AS INTEGER) AS sample_rank FROM ({_values_sql()}) v) k "
                              f"WHERE sample_rank <= 3",
        "validate_by_day": by_day,
        "publish_if_valid": published,
        "publishable_rows": published,
        "publish_again": f"WITH mine AS (SELECT project, {FLAT.replace('country_code', "'US' AS country_code")} FROM ({ALL_BATCHES_SQL}) x "
                         f"WHERE project = 'view' AND dt IS NOT NULL), "
                         f"res AS ({_results_sql(_per_day(O_RULES), 'SELECT * FROM mine', DAILY)}), good AS (SELECT project, dt FROM res "
                         f"GROUP BY project, dt HAVING count(*) FILTER (WHERE NOT success) <= 4), now AS ("
                         f"SELECT * FROM ({ALL_BATCHES_SQL}) b WHERE NOT EXISTS (SELECT 1 FROM good g WHERE {_same('g', 'b', DAILY)}) "
                         f"UNION ALL SELECT * FROM mine m WHERE EXISTS (SELECT 1 FROM good g WHERE {_same('g', 'm', DAILY)})) "
                         f"SELECT project, dt, country_code, count(*) AS n FROM now GROUP BY project, dt, country_code",
        "result_history": f"SELECT project, dt, count(*) AS evaluated, count(*) FILTER (WHERE NOT success) AS failed, "
                          f"count(*) FILTER (WHERE success) AS passed, count(*) FILTER (WHERE NOT success) = 0 AS success "
                          f"FROM ({by_day}) r GROUP BY project, dt",
    }
