import datetime as dt

import pytest

from assay import BadParameter, Rule, Suite, default_suite, run_checkpoint, validate
from assay.functions import rules as R
from assay.functions.params import timestamp_params
from assay.functions.types import type_matches
from assay.plans.suite import VERSION_REGEX
from assay.sources.countries import country_codes
from helpers import batch_rows, good_row


def _one(spark, rule, values, column=None, **kw):
    column = column or rule.column
    df = spark.createDataFrame([(v,) for v in values], f"`{column}` string")
    return validate(df, Suite("t", [rule]), kw.get("params")).collect()[0]


def test_empty_batch(spark):
    batch = batch_rows(spark, [])
    suite = default_suite(batch.columns, "2024-01-01", "2024-01-01")
    rows = run_checkpoint(batch, suite).rows
    failed = {(r.rule_type, r.column_name) for r in rows if not r.success}
    assert failed == {(R.MODE_IN_SET, c) for c in ("file_type", "installer_name", "distro_name", "system_name")}
    assert all(r.element_count == 0 for r in rows)


def test_all_null_column(spark):
    rows = [{**good_row(i), "country_code": None, "pkg_version": None, "download_time": None} for i in range(3)]
    batch = batch_rows(spark, rows)
    suite = Suite("t", [
        Rule(R.NOT_NULL, "country_code"), Rule(R.NOT_NULL, "pkg_version", 0.95),
        Rule(R.IN_SET, "country_code", 0.99, {"value_set": ["US"]}),
        Rule(R.MATCH_REGEX, "pkg_version", 0.95, {"regex": VERSION_REGEX}),
        Rule(R.BETWEEN, "download_time", kwargs={"min_value": "2024-01-01T00:00:00", "max_value": "2024-01-02T00:00:00"}),
        Rule(R.MODE_IN_SET, "country_code", kwargs={"value_set": ["US"]}),
    ])
    res = {(r.rule_type, r.column_name): r.success for r in validate(batch, suite).collect()}
    assert res[(R.NOT_NULL, "country_code")] is False
    assert res[(R.NOT_NULL, "pkg_version")] is False
    assert res[(R.IN_SET, "country_code")] is True
    assert res[(R.MATCH_REGEX, "pkg_version")] is True
    assert res[(R.BETWEEN, "download_time")] is True
    assert res[(R.MODE_IN_SET, "country_code")] is False


@pytest.mark.parametrize("good,total,mostly,ok", [(19, 20, 0.95, True), (99, 100, 0.99, True),
                                                  (18, 20, 0.95, False), (20, 20, 1.0, True)])
def test_tolerance(spark, good, total, mostly, ok):
    values = ["1.2.3"] * good + ["bad"] * (total - good)
    r = _one(spark, Rule(R.MATCH_REGEX, "v", mostly, {"regex": VERSION_REGEX}), values)
    assert r.success is ok and r.unexpected_count == total - good
    nn = _one(spark, Rule(R.NOT_NULL, "v", mostly), ["x"] * good + [None] * (total - good))
    assert nn.success is ok and nn.missing_count == total - good


def test_between_inclusive_bounds(spark):
    rows = [{**good_row(), "download_time": dt.datetime(2024, 1, 1)},
            {**good_row(), "download_time": dt.datetime(2024, 1, 4, 23, 59, 59)}]
    batch = batch_rows(spark, rows)
    rule = Rule(R.BETWEEN, "download_time", kwargs={"min_value": {"$PARAMETER": "min_ts"},
                                                     "max_value": {"$PARAMETER": "max_ts"}})
    r = validate(batch, Suite("t", [rule]), timestamp_params("2024-01-01", "2024-01-04")).collect()[0]
    assert r.success and r.unexpected_count == 0
    late = batch_rows(spark, [{**good_row(), "download_time": dt.datetime(2024, 1, 4, 23, 59, 59, 407119)}])
    r = validate(late, Suite("t", [rule]), timestamp_params("2024-01-01", "2024-01-04")).collect()[0]
    assert not r.success and r.unexpected_count == 1
    strict = Rule(R.BETWEEN, "download_time", kwargs={**rule.kwargs, "strict_max": True})
    r = validate(late, Suite("t", [strict]), timestamp_params("2024-01-01", "2024-01-04", end_exclusive=True)).collect()[0]
    assert r.success


@pytest.mark.parametrize("version,match", [("0.16.13", True), ("1.2.3", True), ("0.16", False),
                                           ("10.1.1", False), ("1.2.345", False), ("1.2.3rc1", False)])
def test_version_regex(spark, version, match):
    r = _one(spark, Rule(R.MATCH_REGEX, "v", 1.0, {"regex": VERSION_REGEX}), [version])
    assert r.success is match


def test_country_codes(spark):
    codes = country_codes()
    assert len(codes) == 245
    assert {"US", "DE", "NA", "BU", "SU", "ZZ", "YU"} <= set(codes)
    assert not {"QQ", "RS", "ME", "CD", "us"} & set(codes)
    rule = Rule(R.IN_SET, "c", 1.0, {"value_set": list(codes)})
    assert _one(spark, rule, ["NA"]).success is True  # Namibia, not a null marker
    assert _one(spark, rule, ["us"]).success is False  # case-sensitive


def test_in_set_dimension_equals_literal(spark):
    from assay.sources.countries import country_dim
    values = ["US", "DE", "QQ", None, "us", "NA"]
    lit = _one(spark, Rule(R.IN_SET, "c", 0.99, {"value_set": list(country_codes())}), values)
    dim = _one(spark, Rule(R.IN_SET, "c", 0.99, {"value_set": country_dim(spark)}), values)
    assert (lit.unexpected_count, lit.missing_count, lit.success) == (dim.unexpected_count, dim.missing_count, dim.success) == (2, 1, False)


def test_in_set_dimension_is_preaggregated(spark):
    dim = spark.createDataFrame([(c,) for c in country_codes()], "code string")
    df = spark.createDataFrame([(v,) for v in ["US"] * 50 + ["QQ"] * 3 + [None]], "c string")
    rule = Rule(R.IN_SET, "c", 0.9, {"value_set": dim})
    r = validate(df, Suite("d", [rule])).collect()[0]
    assert (r.unexpected_count, r.missing_count, r.element_count, r.success) == (3, 1, 54, True)


def test_mode_tie(spark, source01):
    from pyspark.sql import functions as F
    from assay.operators.modes import mode_results
    ev = spark.read.parquet("/root/testdata/sf0.01/events.parquet")
    distro = ev.select(F.when(F.col("event_id") % 2 == 0, "Ubuntu").otherwise("Debian").alias("distro_name"))
    r = mode_results(distro, [(1, Rule(R.MODE_IN_SET, "distro_name", kwargs={"value_set": ["Ubuntu"]}))]).collect()[0]
    assert (r.observed_value, r.n_modes, r.success) == ("Debian", 2, False)


def test_all_tied_modes_count(spark):
    from assay.operators.modes import mode_results, tied_modes
    df = spark.range(1000).selectExpr("CAST(id AS STRING) AS c")  # every value is a mode
    rules = [(1, Rule(R.MODE_IN_SET, "c", kwargs={"value_set": ["0"]}))]
    r = mode_results(df, rules).collect()[0]
    assert (r.success, r.n_modes, r.observed_value) == (False, 1000, "0")
    assert tied_modes(df, rules).count() == 1000


def test_bounds_are_not_narrowed_to_the_column(spark):
    whole = spark.createDataFrame([(v,) for v in [1, 2, 3]], "x int")
    count = lambda df, c, **kw: validate(df, Suite("b", [Rule(R.BETWEEN, c, kwargs=kw)])).collect()[0].unexpected_count
    assert count(whole, "x", min_value=2.5) == 2 and count(whole, "x", max_value=2.5) == 1
    assert count(whole, "x", min_value=2.0) == 1
    big = spark.createDataFrame([(2 ** 53 + 1,), (2 ** 53,)], "x long")
    assert count(big, "x", max_value=2 ** 53) == 1
    day = spark.createDataFrame([(dt.date(2024, 1, 4),), (dt.date(2024, 1, 5),)], "d date")
    assert count(day, "d", min_value=dt.datetime(2024, 1, 4, 12)) == 1
    assert count(day, "d", min_value="2024-01-04") == 0
    with pytest.raises(BadParameter):
        count(whole, "x", min_value=float("nan"))


def test_mode_members_are_compared_by_type(spark):
    mode = lambda df, c, s: validate(df, Suite("m", [Rule(R.MODE_IN_SET, c, kwargs={"value_set": s})])).collect()[0]
    assert mode(spark.createDataFrame([(5.0,), (5.0,), (1.0,)], "x double"), "x", [5]).success
    assert mode(spark.createDataFrame([(1e20,), (1e20,), (1.0,)], "x double"), "x", [1e20]).success
    when = dt.datetime(2024, 1, 4, 12, 0, 0, 500000)
    df = spark.createDataFrame([(when,), (when,)], "x timestamp_ntz")
    assert mode(df, "x", [when]).success and not mode(df, "x", [when.replace(microsecond=0)]).success


def test_type_rule(spark):
    batch = batch_rows(spark, [good_row()])
    r = validate(batch, Suite("t", [Rule(R.OF_TYPE, "download_time", kwargs={"type_": "Timestamp"})])).collect()[0]
    assert r.success and r.observed_value == "timestamp_ntz"
    r = validate(batch, Suite("t", [Rule(R.OF_TYPE, "country_code", kwargs={"type_": "Timestamp"})])).collect()[0]
    assert not r.success
    from pyspark.sql import types as T
    assert type_matches(T.TimestampType(), "Timestamp") and type_matches(T.StringType(), "str")
    with pytest.raises(BadParameter):
        type_matches(T.StringType(), "NoSuchType")


def test_rule_arguments_checked():
    with pytest.raises(BadParameter):
        Rule("expect_something_else", "c")
    with pytest.raises(BadParameter):
        Rule(R.NOT_NULL, "c", 1.5)


def test_counts_add_up(spark, source01):
    from assay import extract_batch
    batch = extract_batch(source01, "click", "2024-01-01", "2024-01-30")
    suite = default_suite(batch.columns, "2024-01-01", "2024-01-30")
    for r in validate(batch, suite).collect():
        if r.rule_type in (R.BETWEEN, R.IN_SET, R.MATCH_REGEX):
            assert 0 <= r.unexpected_count <= r.element_count - r.missing_count
        if r.rule_type == R.NOT_NULL:
            assert r.unexpected_count == r.missing_count


def test_parameters_with_offsets_parse_to_utc(spark):
    # stored parameters are ISO text with an offset; 02:00+02:00 is midnight UTC
    rows = [{**good_row(), "download_time": dt.datetime(2024, 1, 1, 0, 0)}]
    batch = batch_rows(spark, rows)
    rule = Rule(R.BETWEEN, "download_time", kwargs={"min_value": {"$PARAMETER": "min_ts"},
                                                     "max_value": {"$PARAMETER": "max_ts"}})
    ok = validate(batch, Suite("t", [rule], {"min_ts": "2024-01-01T02:00:00+02:00",
                                             "max_ts": "2024-01-01T00:00:00Z"})).collect()[0]
    late = validate(batch, Suite("t", [rule], {"min_ts": "2024-01-01T02:00:01+02:00",
                                               "max_ts": "2024-01-02T00:00:00+00:00"})).collect()[0]
    assert ok.success and not late.success
    with pytest.raises(BadParameter):
        validate(batch, Suite("t", [rule], {"min_ts": "yesterday", "max_ts": "2024-01-02T00:00:00"}))
    with pytest.raises(BadParameter):
        validate(batch, Suite("t", [rule], {"min_ts": "2024-01-01T00:00:00"}))  # max_ts missing


def test_numeric_rules(spark):
    df = spark.createDataFrame([(v,) for v in [1, 2, 2, 3, 5, None]], "x int")
    between = Rule(R.BETWEEN, "x", kwargs={"min_value": 1, "max_value": 3})
    strict = Rule(R.BETWEEN, "x", kwargs={"min_value": 1, "max_value": 3, "strict_min": True})
    in_set = Rule(R.IN_SET, "x", kwargs={"value_set": [1, 2, 3]})
    mode = Rule(R.MODE_IN_SET, "x", kwargs={"value_set": [2]})
    res = {r.rule_id: r for r in validate(df, Suite("n", [between, strict, in_set, mode])).collect()}
    assert (res[1].unexpected_count, res[2].unexpected_count, res[3].unexpected_count) == (1, 2, 1)
    assert res[4].success and res[4].observed_value == "2"
    flags = spark.createDataFrame([(True,), (True,), (False,)], "b boolean")
    r = validate(flags, Suite("b", [Rule(R.MODE_IN_SET, "b", kwargs={"value_set": [True]})])).collect()[0]
    assert r.success and r.observed_value == "true"


def test_rule_on_missing_column_fails_early(spark):
    from assay import SchemaDriftError
    batch = batch_rows(spark, [good_row()])
    with pytest.raises(SchemaDriftError):
        validate(batch, Suite("t", [Rule(R.NOT_NULL, "no_such_column")]))


def test_value_set_with_none(spark):
    r = _one(spark, Rule(R.IN_SET, "c", 1.0, {"value_set": ["US", None]}), ["US", "DE", None])
    assert (r.unexpected_count, r.missing_count, r.success) == (1, 1, False)
    m = _one(spark, Rule(R.MODE_IN_SET, "c", kwargs={"value_set": [None, "US"]}), ["US", "US", None, None, None])
    assert m.success and m.observed_value == "US"
    empty = _one(spark, Rule(R.IN_SET, "c", 1.0, {"value_set": [None]}), ["US", None])
    assert empty.unexpected_count == 1


def test_regex_on_numbers_matches_their_text(spark):
    df = spark.createDataFrame([(v,) for v in [12, 7, 123, None]], "x int")
    r = validate(df, Suite("n", [Rule(R.MATCH_REGEX, "x", 1.0, {"regex": r"^\d{1,2}$"})])).collect()[0]
    assert (r.unexpected_count, r.missing_count) == (1, 1)
