"""Skew check: run the hot-key-sensitive operators on a batch where one key holds a third or
more of all rows, with Spark's event log written to a scratch folder, and report per stage the
largest task's shuffle-read records against the median task.

usage: python tools/skew_check.py [sf_dir]
"""

from __future__ import annotations

import glob
import json
import os
import statistics
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from metricyard.operators import enrich, marts, merge  # noqa: E402
from metricyard.plans.catalog import lineitem_long  # noqa: E402
from metricyard.session import build_session  # noqa: E402


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    logdir = tempfile.mkdtemp(prefix="skew-eventlog-", dir="/tmp")
    spark = build_session("local[8]", shuffle_partitions=32,
                          extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": logdir,
                                 "spark.eventLog.compress": "false",
                                 # force shuffle joins so the salted join is measured as a shuffle
                                 "spark.sql.autoBroadcastJoinThreshold": "-1",
                                 "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                                 "spark.sql.adaptive.skewJoin.enabled": "false",
                                 "spark.driver.memory": "8g",
                                 # keep AQE from hiding the plan's own behaviour behind coalescing
                                 "spark.sql.adaptive.coalescePartitions.enabled": "false"})
    long = lineitem_long(spark, sf_dir)
    # returnflag 'N' holds about half of all rows: the hot Application / project
    rows = long.select(F.col("l_returnflag").alias("Application"), F.lit("lab").alias("Investigator_Folder"),
                       F.col("l_orderkey").cast("string").alias("Sample_Name"),
                       F.col("l_linenumber").cast("string").alias("row_no"), "name", "value")
    jobs = {}

    def run(label, df):
        spark.sparkContext.setJobGroup(label, label)
        df.write.format("noop").mode("overwrite").save()
        jobs[label] = True

    key = ["Application", "Sample_Name", "row_no", "name", "value"]
    target = rows.filter(F.col("name") == "l_tax")
    run("M1 append-if-absent", merge.new_rows_if_absent(target, rows, key))
    run("A1 distinct samples", marts.app_index([(rows, "Sample_Name")]))
    lanes = spark.range(8).select(F.lit("N").alias("Application"), F.col("id").cast("string").alias("Lane"))
    run("J5 lanes x samples (salted)", enrich.lanes_x_samples(rows, lanes, ["Application"],
                                                               salt_from=["Sample_Name", "row_no", "name"]))
    from metricyard.operators import sinks
    spark.sparkContext.setJobGroup("K5 clustered write", "K5 clustered write")
    jobs["K5 clustered write"] = True
    hot = rows.select("*", F.lit("2024-01-01").alias("Release_Date"), F.col("Application").alias("Project_ID"),
                      F.lit("run").alias("Project_run_type"))
    sinks.write_clustered(hot, f"{logdir}/clustered", mode="overwrite")
    spark.stop()

    events = []
    for f in glob.glob(os.path.join(logdir, "**", "*"), recursive=True):
        if os.path.isdir(f) or "appstatus" in os.path.basename(f):
            continue
        with open(f) as fh:
            events += [json.loads(line) for line in fh if line.strip()]
    group_of_job, stage_job = {}, {}
    for e in events:
        if e["Event"] == "SparkListenerJobStart":
            group_of_job[e["Job ID"]] = (e.get("Properties") or {}).get("spark.jobGroup.id")
            for s in e["Stage IDs"]:
                stage_job[s] = e["Job ID"]
    per_stage: dict[int, list[int]] = {}
    for e in events:
        if e["Event"] == "SparkListenerTaskEnd" and e.get("Task Metrics"):
            m = e["Task Metrics"]
            n = m.get("Shuffle Read Metrics", {}).get("Total Records Read", 0)
            per_stage.setdefault(e["Stage ID"], []).append(n)
    print(f"{'job':32s} {'stage':>5s} {'tasks':>5s} {'max rows':>10s} {'median':>10s} {'max/total':>9s}")
    for s, vals in sorted(per_stage.items()):
        if sum(vals) == 0:
            continue
        label = group_of_job.get(stage_job.get(s))
        print(f"{str(label):32s} {s:5d} {len(vals):5d} {max(vals):10d} {int(statistics.median(vals)):10d} "
              f"{max(vals) / sum(vals):9.2f}")


if __name__ == "__main__":
    main()
