"""The full suite on random small batches against a plain-Python brute force."""

import datetime as dt
import re
from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from assay import default_suite, validate
from assay.functions import rules as R
from assay.functions.params import timestamp_params
from assay.operators.extract import BATCH_COLUMNS
from helpers import batch_rows

BEGIN, END = "2024-01-01", "2024-01-03"
LO, HI = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 3, 23, 59, 59)

maybe = lambda s: st.one_of(st.none(), s)
row = st.fixed_dictionaries({
    "download_time": maybe(st.datetimes(dt.datetime(2023, 12, 31, 20), dt.datetime(2024, 1, 4, 4))),
    "country_code": maybe(st.sampled_from(["US", "DE", "NA", "QQ", "us", "ZZ"])),
    "file_type": maybe(st.sampled_from(["bdist_wheel", "sdist"])),
    "pkg_version": maybe(st.sampled_from(["1.2.3", "0.16.13", "0.16", "10.1.1", "1.2.345", "1.2.3rc1"])),
    "python_version": maybe(st.sampled_from(["3.10", "3.9"])),
    "installer_name": maybe(st.sampled_from(["pip", "uv", "poetry"])),
    "installer_version": maybe(st.just("23.0")),
    "distro_name": maybe(st.sampled_from(["Ubuntu", "Debian"])),
    "distro_version": maybe(st.just("22.04")),
    "system_name": maybe(st.sampled_from(["Linux", "Darwin"])),
    "system_version": maybe(st.just("5.4")),
    "dt": maybe(st.dates(dt.date(2024, 1, 1), dt.date(2024, 1, 3))),
})


def brute(rule: R.Rule, values: list):
    n = len(values)
    nonnull = [v for v in values if v is not None]
    nulls = n - len(nonnull)
    if rule.kind == R.NOT_NULL:
        return nulls, n == 0 or (n - nulls) / n >= rule.mostly
    if rule.kind == R.OF_TYPE:
        return None, True
    if rule.kind == R.MODE_IN_SET:
        counts = Counter(nonnull)
        top = max(counts.values(), default=0)
        modes = sorted(v for v, c in counts.items() if c == top)
        return None, len(modes) == 1 and modes[0] in rule.kwargs["value_set"]
    if rule.kind == R.BETWEEN:
        bad = sum(not (LO <= v <= HI) for v in nonnull)
    elif rule.kind == R.IN_SET:
        bad = sum(v not in rule.kwargs["value_set"] for v in nonnull)
    else:
        bad = sum(re.search(rule.kwargs["regex"], v, flags=re.ASCII) is None for v in nonnull)
    return bad, not nonnull or (len(nonnull) - bad) / len(nonnull) >= rule.mostly


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(row, max_size=40))
def test_suite_equals_brute_force(spark, rows):
    batch = batch_rows(spark, rows)
    suite = default_suite(list(BATCH_COLUMNS), BEGIN, END)
    got = {r.rule_id: r for r in validate(batch, suite, timestamp_params(BEGIN, END)).collect()}
    for rid, rule in suite.numbered():
        values = [r[rule.column] for r in rows]
        unexpected, success = brute(rule, values)
        r = got[rid]
        assert r.element_count == len(rows)
        assert r.success is success, (rule.kind, rule.column, values)
        if unexpected is not None:
            assert r.unexpected_count == unexpected, (rule.kind, rule.column)
