"""Scale probe: a larger, deliberately skewed source; throughput and task skew.

Usage: python tools/scale_probe.py [replicas] [sf_dir]

The nested downloads table is derived from ``events`` and replicated ``replicas``
times with a generator (``explode(sequence)``, no join).  Skew is built in: every
third replica is re-labelled project ``click`` and moved to 2024-01-02, so one
project holds about half the rows and one day about a third.  The table is
written once to a fresh scratch folder, then every project's batch and every
(project, day) batch are validated.  Per stage, the event log gives the task
count and the max / median task time: a hot key shows up as max >> median.
"""

from __future__ import annotations

import glob
import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from assay import build_session, default_suite, flatten, validate, validate_by_day  # noqa: E402
from assay.operators.extract import BATCH_COLUMNS, date_filter  # noqa: E402
from assay.operators.samples import unexpected_values  # noqa: E402
from assay.functions.params import merge_params  # noqa: E402
from assay.sources import downloads_from_events, read_downloads, read_table  # noqa: E402


def skewed_source(spark, sf_dir: str, replicas: int):
    ev = read_table(spark, sf_dir, "events")
    rep = ev.select("*", F.explode(F.sequence(F.lit(0), F.lit(replicas - 1))).alias("rep"))
    hot = F.col("rep") % 3 == 0
    rep = rep.select(
        (F.col("event_id") + F.col("rep") * F.lit(10_000_000)).alias("event_id"),
        F.when(hot, F.lit("2024-01-02").cast("timestamp_ntz")
               + (F.col("ts") - F.date_trunc("day", F.col("ts")))).otherwise(F.col("ts")).alias("ts"),
        F.when(hot, F.lit("click")).otherwise(F.col("event_type")).alias("event_type"),
    )
    return downloads_from_events(rep)


def stage_skew(event_dir: str) -> dict:
    tasks, names, groups = {}, {}, {}
    for path in sorted(glob.glob(os.path.join(event_dir, "**", "*"), recursive=True)):
        if os.path.isdir(path):
            continue
        with open(path, encoding="utf-8") as fh:
            for line in fh:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    g = (ev.get("Properties") or {}).get("spark.jobGroup.id")
                    for sid in ev.get("Stage IDs", []):
                        groups[sid] = g
                elif kind == "SparkListenerStageSubmitted":
                    info = ev["Stage Info"]
                    names[info["Stage ID"]] = info["Stage Name"].split(" at ")[0]
                elif kind == "SparkListenerTaskEnd":
                    info = ev["Task Info"]
                    tasks.setdefault(ev["Stage ID"], []).append(info["Finish Time"] - info["Launch Time"])
    out = {}
    for sid, durs in tasks.items():
        g = groups.get(sid)
        if not g or len(durs) < 2:
            continue
        med = statistics.median(durs)
        out.setdefault(g, []).append({"stage": sid, "tasks": len(durs), "max_ms": max(durs),
                                      "median_ms": med, "max_over_median": round(max(durs) / max(med, 1), 1)})
    return out


def main(argv):
    replicas = int(argv[1]) if len(argv) > 1 else 60
    sf_dir = argv[2] if len(argv) > 2 else "/root/testdata/sf0.1"
    scratch = tempfile.mkdtemp(prefix="assay-scale-")
    event_dir = os.path.join(scratch, "events")
    os.makedirs(event_dir)
    spark = build_session("local[8]", app_name="assay-scale", shuffle_partitions=64,
                          extra={"spark.driver.memory": "16g", "spark.eventLog.enabled": "true",
                                 "spark.eventLog.dir": f"file://{event_dir}", "spark.eventLog.compress": "false",
                                 "spark.sql.files.maxPartitionBytes": str(16 * 1024 * 1024)})
    spark.sparkContext.setLogLevel("ERROR")
    path = os.path.join(scratch, "downloads")
    t0 = time.perf_counter()
    # many files, as a real source has (the generator alone would make one or two)
    skewed_source(spark, sf_dir, replicas).repartition(64).write.parquet(path)
    write_s = time.perf_counter() - t0

    src = read_downloads(spark, path)
    batches = flatten(src.where(date_filter(src, "2024-01-01", "2024-01-30")), F.col("file.project").alias("project"))
    suite = default_suite(list(BATCH_COLUMNS), "2024-01-01", "2024-01-30")
    rows = src.count()
    shares = {r.project: r.n for r in batches.groupBy("project").agg(F.count("*").alias("n")).collect()}
    days = {str(r.dt): r.n for r in batches.groupBy("dt").agg(F.count("*").alias("n")).collect()}

    timings, cold = {}, {}
    for name, job in {
        "all_projects": lambda: validate(batches, suite, group_cols=["project"]).collect(),
        "all_project_days": lambda: validate_by_day(batches, suite, "2024-01-01", "2024-01-30",
                                                    by=["project"]).collect(),
        "values_by_project": lambda: unexpected_values(batches, suite.numbered(), merge_params(suite.params, None),
                                                        group_cols=["project"]).write.format("noop").mode("overwrite").save(),
    }.items():
        t = time.perf_counter()
        job()  # first run: code generation, file listing
        cold[name] = round(time.perf_counter() - t, 2)
        spark.sparkContext.setJobGroup(name, name)
        t = time.perf_counter()
        job()
        timings[name] = round(time.perf_counter() - t, 2)
    spark.stop()
    skew = stage_skew(event_dir)
    print(json.dumps({
        "rows": rows, "write_s": round(write_s, 1),
        "hot_project_share": round(max(shares.values()) / rows, 3),
        "hot_day_share": round(max(days.values()) / rows, 3),
        "seconds": timings,
        "cold_seconds": cold,
        "rows_per_s": {k: int(rows / v) for k, v in timings.items()},
        "worst_stage_skew": {g: max(v, key=lambda s: s["max_over_median"]) for g, v in skew.items()},
    }, indent=1))


if __name__ == "__main__":
    main(sys.argv)
