"""Session settings the results depend on.

Dates are derived from instants in UTC (``date(timestamp)`` of the source
query), so every job checks that the session zone is UTC before it turns a
zone-aware timestamp into a date.
"""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

from .errors import SessionConfigError

UTC_ZONES = {"UTC", "Etc/UTC", "GMT", "Etc/GMT", "Z", "+00:00", "Zulu", "UCT", "Etc/UCT"}

# Settings for a job at scale: AQE re-plans shuffles at run time (coalesces
# tiny partitions, splits skewed ones) and the session zone is UTC.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(master: str | None = None, app_name: str = "assay",
                  shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Get or create a session with the settings above (used by tests, bench, CLI)."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    # getOrCreate may return an existing session: apply what can be set at run time.
    for k, v in conf.items():
        if k.startswith("spark.sql.") and spark.conf.isModifiable(k):
            spark.conf.set(k, v)
    return spark


def require_utc(spark: SparkSession) -> None:
    """Raise unless the session time zone is UTC (hard point: dates are UTC days)."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in UTC_ZONES:
        raise SessionConfigError(
            f"spark.sql.session.timeZone is {zone!r}; dates of instants are UTC days, "
            "set it to 'UTC'"
        )


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for staged batches: the cluster's ``spark.checkpoint.dir``.

    Raises if the session names none; tests set one with ``ensure_checkpoint_dir``.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        try:  # set through SparkContext.setCheckpointDir (classic sessions only)
            root = spark.sparkContext.getCheckpointDir()
        except Exception:  # noqa: BLE001 - e.g. a Connect session has no SparkContext
            root = None
    if not root:
        raise SessionConfigError(
            "no spark.checkpoint.dir set: name a shared folder for staged batches"
        )
    return root.rstrip("/")


def ensure_checkpoint_dir(spark: SparkSession, fallback: str) -> str:
    """Set ``fallback`` as checkpoint dir only where the session has none (tests)."""
    if not (spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()):
        os.makedirs(fallback, exist_ok=True)
        spark.sparkContext.setCheckpointDir(fallback)
    return checkpoint_root(spark)
