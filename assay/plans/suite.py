"""Rule suites: the default suite of a batch, and storing / loading suites.

A stored suite is a Parquet table partitioned by ``suite_name``; saving a suite
overwrites only its own partition (dynamic partition overwrite), so other
suites stay as they are.
"""

from __future__ import annotations

import dataclasses
import datetime as dt
import json
from collections.abc import Iterable, Sequence

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from ..errors import SuiteNotFound
from ..functions import params as P
from ..functions import rules as R
from ..sources.countries import country_codes

# --- Fixed values of the default suite (must equal the reference's) -------
NOT_NULL_COLUMNS = ("download_time", "country_code", "file_type", "pkg_version", "dt")
MOSTLY_NOT_NULL = 0.95
TIME_COLUMNS = ("download_time",)
TIME_TYPE_NAME = "Timestamp"
COUNTRY_COLUMN = "country_code"
COUNTRY_MOSTLY = 0.99
TOP_VALUES = {
    "file_type": "bdist_wheel",
    "installer_name": "pip",
    "distro_name": "Ubuntu",
    "system_name": "Linux",
}
VERSION_COLUMN = "pkg_version"
VERSION_REGEX = r"^(\d{1}\.\d{1,2}\.\d{1,2}$)"
VERSION_MOSTLY = 0.95
# ---------------------------------------------------------------------------

DEFAULT_SUITE_NAME = "downloads_batch"


@dataclasses.dataclass
class Suite:
    name: str
    rules: list[R.Rule] = dataclasses.field(default_factory=list)
    params: dict = dataclasses.field(default_factory=dict)

    def add(self, rule: R.Rule) -> "Suite":
        """Add a rule; a rule with the same (kind, column) is replaced in place."""
        for i, old in enumerate(self.rules):
            if old.key == rule.key:
                self.rules[i] = rule
                return self
        self.rules.append(rule)
        return self

    def set_param(self, name: str, value) -> "Suite":
        self.params[name] = value
        return self

    def numbered(self) -> list[tuple[int, R.Rule]]:
        """(rule_id, rule), rule ids 1..n in suite order."""
        return list(enumerate(self.rules, start=1))


def default_suite(columns: Sequence[str], begin: str | dt.date | None = None,
                  end: str | dt.date | None = None, name: str = DEFAULT_SUITE_NAME,
                  value_set: Iterable | None = None, end_exclusive: bool = False) -> Suite:
    """The 20-rule suite of a downloads batch, derived from the batch's columns.

    Columns not in the strict not-null list get the 95% not-null rule, so a new
    column is covered automatically.  ``begin``/``end`` give the stored defaults
    of ``min_ts``/``max_ts``; run-time parameters override them.
    """
    suite = Suite(name)
    for c in NOT_NULL_COLUMNS:
        suite.add(R.Rule(R.NOT_NULL, c))
    for c in [c for c in columns if c not in NOT_NULL_COLUMNS]:
        suite.add(R.Rule(R.NOT_NULL, c, MOSTLY_NOT_NULL))
    for c in TIME_COLUMNS:
        suite.add(R.Rule(R.OF_TYPE, c, kwargs={"type_": TIME_TYPE_NAME}))
    if begin is not None and end is not None:
        for k, v in P.timestamp_params(begin, end, end_exclusive).items():
            suite.set_param(k, v)
    suite.add(R.Rule(R.BETWEEN, "download_time", kwargs={
        "min_value": {P.PARAM_KEY: "min_ts"},
        "max_value": {P.PARAM_KEY: "max_ts"},
        **({"strict_max": True} if end_exclusive else {}),
    }))
    codes = list(value_set) if value_set is not None else list(country_codes())
    suite.add(R.Rule(R.IN_SET, COUNTRY_COLUMN, COUNTRY_MOSTLY, {"value_set": codes}))
    for c, v in TOP_VALUES.items():
        suite.add(R.Rule(R.MODE_IN_SET, c, kwargs={"value_set": [v]}))
    suite.add(R.Rule(R.MATCH_REGEX, VERSION_COLUMN, VERSION_MOSTLY, {"regex": VERSION_REGEX}))
    return suite


def suite_to_json(suite: Suite) -> str:
    """The suite as a JSON document: name, expectations (type + kwargs), evaluation parameters."""
    expectations = []
    for r in suite.rules:
        kwargs = {"column": r.column, **json.loads(r.kwargs_json())}
        if r.mostly != 1.0:
            kwargs["mostly"] = r.mostly
        expectations.append({"expectation_type": r.kind, "kwargs": kwargs})
    params = {k: P.to_json_value(v) for k, v in suite.params.items()}
    return json.dumps({"expectation_suite_name": suite.name, "expectations": expectations,
                       "evaluation_parameters": params}, indent=1, sort_keys=True)


def suite_from_json(text: str, name: str | None = None) -> Suite:
    """Read a suite document (the JSON the validation library stores, or ``suite_to_json``'s).

    Each expectation needs a supported ``expectation_type`` and a ``column`` kwarg;
    anything else is an error, so no rule is dropped silently.
    """
    doc = json.loads(text)
    suite = Suite(name or doc.get("expectation_suite_name") or DEFAULT_SUITE_NAME)
    for e in doc.get("expectations", []):
        kwargs = dict(e.get("kwargs") or {})
        column = kwargs.pop("column", None)
        if column is None:
            raise P.BadParameter(f"expectation without a column: {e}")
        mostly = kwargs.pop("mostly", None)
        kwargs.pop("result_format", None)
        suite.add(R.Rule(e.get("expectation_type"), column, mostly, kwargs))
    for k, v in (doc.get("evaluation_parameters") or {}).items():
        suite.set_param(k, v)
    return suite


SUITE_SCHEMA = T.StructType([
    T.StructField("entry", T.StringType(), False),       # 'rule' | 'param' | 'suite'
    T.StructField("position", T.IntegerType(), False),
    T.StructField("rule_type", T.StringType(), True),
    T.StructField("column_name", T.StringType(), True),
    T.StructField("mostly", T.DoubleType(), True),
    T.StructField("payload", T.StringType(), True),       # rule kwargs / parameter as JSON
    T.StructField("suite_name", T.StringType(), False),
])


def suite_rows(suite: Suite) -> list[tuple]:
    rows = [("suite", 0, None, None, None, None, suite.name)]
    rows += [("rule", i, r.kind, r.column, r.mostly, r.kwargs_json(), suite.name) for i, r in suite.numbered()]
    rows += [("param", 0, None, k, None, json.dumps(P.to_json_value(v)), suite.name)
             for k, v in sorted(suite.params.items())]
    return rows


def save_suite(spark: SparkSession, suite: Suite, path: str) -> None:
    """Store a suite, replacing any earlier suite of that name (only its partition)."""
    df = spark.createDataFrame(suite_rows(suite), SUITE_SCHEMA)
    (df.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("suite_name").parquet(path))


def load_suite(spark: SparkSession, path: str, name: str) -> Suite:
    """Load a stored suite by name; a missing suite raises ``SuiteNotFound``."""
    try:  # one suite's rows: bounded by its rule count (partition-pruned read)
        rows = (spark.read.schema(SUITE_SCHEMA).parquet(path)
                .where(F.col("suite_name") == F.lit(name)).collect())
    except AnalysisException as exc:
        raise SuiteNotFound(f"no suite store at {path}") from exc
    rows.sort(key=lambda r: (r.entry, r.position))
    if not rows:
        raise SuiteNotFound(f"suite {name!r} is not stored at {path}")
    suite = Suite(name)
    for row in rows:
        if row.entry == "rule":
            suite.rules.append(R.Rule.from_json(row.rule_type, row.column_name, row.mostly, row.payload))
        elif row.entry == "param":
            suite.params[row.column_name] = json.loads(row.payload)
    return suite
