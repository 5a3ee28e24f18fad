"""Small frames for rule unit tests."""

import datetime as dt

from pyspark.sql import types as T

from assay.operators.extract import BATCH_COLUMNS

BATCH_SCHEMA = T.StructType(
    [T.StructField("download_time", T.TimestampNTZType())]
    + [T.StructField(c, T.StringType()) for c in BATCH_COLUMNS[1:-1]]
    + [T.StructField("dt", T.DateType())]
)


def batch_rows(spark, rows):
    """Flat batch from dicts; missing columns are NULL."""
    data = [tuple(r.get(c) for c in BATCH_COLUMNS) for r in rows]
    return spark.createDataFrame(data, BATCH_SCHEMA)


def good_row(i=0, day=dt.date(2024, 1, 2)):
    return {
        "download_time": dt.datetime.combine(day, dt.time(12, 0, i % 60)),
        "country_code": "US",
        "file_type": "bdist_wheel",
        "pkg_version": "1.2.3",
        "python_version": "3.10",
        "installer_name": "pip",
        "installer_version": "23.0",
        "distro_name": "Ubuntu",
        "distro_version": "22.04",
        "system_name": "Linux",
        "system_version": "5.4",
        "dt": day,
    }


def by_column(rows, kind):
    return {r.column_name: r for r in rows if r.rule_type == kind}
