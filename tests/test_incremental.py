"""Scope, ledger, retention, unchanged-file detection and small readers."""
import json
import os

from conftest import write
from pyspark.sql import functions as F

from metricyard.functions import fixed
from metricyard.operators import incremental, merge, sinks
from metricyard.sources import delimited, files


def test_unchanged_files(spark, tmpdir_path):
    d = os.path.join(tmpdir_path, "seq")
    write(os.path.join(d, "a", "SequencingMetrics.csv"), "x\n1\n")
    write(os.path.join(d, "b", "SequencingMetrics.csv"), "x\n2\n")
    h1 = sinks.content_hash(spark, d)
    last = h1.collect()
    write(os.path.join(d, "b", "SequencingMetrics.csv"), "x\n3\n")
    h2 = sinks.content_hash(spark, d)
    changed = merge.changed_since(h2, spark.createDataFrame(last, h1.schema)).collect()
    assert [r["path"].split("/")[-2] for r in changed] == ["b"]


def test_scope_reset_retention(spark):
    apps = spark.createDataFrame([("rnaseq",), ("wgs",), ("chic",)], "application string")
    tracker = spark.createDataFrame([("rnaseq", "2024-01-01", "2023-12-20"), ("wgs", "2024-01-09", "2024-01-08")],
                                    "application string, last_archive_scan string, last_reset string") \
        .select("application", F.to_date("last_archive_scan").alias("last_archive_scan"),
                F.to_date("last_reset").alias("last_reset"))
    present = spark.createDataFrame([("wgs",)], "application string")
    scope = {r["application"]: r["scope"] for r in incremental.scan_scope(
        apps, tracker, present, present, F.to_date(F.lit("2024-01-10"))).collect()}
    assert scope == {"rnaseq": "archive", "wgs": "active", "chic": "all"}
    reset = {r["application"]: r["reset"] for r in incremental.reset_due(tracker, F.to_date(F.lit("2024-01-10"))).collect()}
    assert reset == {"rnaseq": True, "wgs": False}
    snaps = spark.createDataFrame([("20240101",), ("20240108",)], "d string").select(F.to_date("d", "yyyyMMdd").alias("d"))
    exp = {str(r["d"]): r["expired"] for r in incremental.retention(snaps, "d", 5, today="2024-01-10").collect()}
    assert exp == {"2024-01-01": True, "2024-01-08": False}
    assert incremental.first_run_scope(spark.createDataFrame([], "project_dir string")) == "all"


def test_ledger_exact_match(spark):
    ledger = spark.createDataFrame([("/q/p1",)], "project_dir string")
    found = spark.createDataFrame([("/q/p1",), ("/q/p10",), ("/q/p1/",)], "project_dir string")
    found = found.select(incremental.normalize_dir("project_dir").alias("project_dir")).distinct()
    new = {r["project_dir"] for r in incremental.new_projects(found, ledger).collect()}
    assert new == {"/q/p10"}                                  # L-2: /q/p1 does not hide /q/p10


def test_settings_by_application_and_long_csv(spark, tmpdir_path):
    for name, app in (("r1", "PacBio"), ("r2", "pacbio"), ("r3", "ONT")):
        write(os.path.join(tmpdir_path, name, ".settings.json"), json.dumps({"application": app}))
    dirs = spark.createDataFrame([(os.path.join(tmpdir_path, n),) for n in ("r1", "r2", "r3", "r4")], "project_dir string")
    found = files.settings_by_application(files.read_settings(dirs), "PacBio").collect()
    assert sorted(r["project_dir"].split("/")[-2] for r in found) == ["r1", "r2"]
    write(os.path.join(tmpdir_path, "long.csv"), "labA,p1,1.50,x\nlabA,p1,3,y\n")
    df = delimited.read_long_csv(spark, os.path.join(tmpdir_path, "long.csv"), ["a", "b", "value", "c"])
    assert [r["value"] for r in df.collect()] == ["1.50", "3"]   # L-7: text kept as written


def test_sequencing_import(spark, tmpdir_path):
    from metricyard.plans import runs
    hdr = ",".join(n for n, _ in fixed.SEQUENCING_SCHEMA) + "\n"
    body = ("1,2024,P1,CT,I1,R1,g1,wgs,/f/1,NovaSeq,10,20,30,/d/1,2,\n"          # NULL length (L-3)
            "1,2024,P1,CT,I1,R1,g1,wgs,/f/1,NovaSeq,10,20,30,/d/1,2,\n"          # repeated row
            "2,2024,P2,CT,I1,R2,g1,wgs,/f/2,NovaSeq,abc,20,30,/d/2,2,5.5\n"      # word in a number
            "3,2024,P3,CT,I1,R3,g1,wgs,/f/3,NovaSeq,10,20,30,/d/3,2,5.5,extra\n" # extra field
            "3,2024,P3,CT,I1,R3,g1,wgs,/f/3,NovaSeq,10,20,30,/d/3,2,,extra\n"    # extra, last one empty
            "4,2024,P4,CT,I1,R4,g1,wgs\n")                                       # short row
    csv = os.path.join(tmpdir_path, "SequencingMetrics.csv")
    write(csv, hdr + body)
    wh = os.path.join(tmpdir_path, "wh")
    first = runs.run_sequencing_import(spark, csv, wh, run_date="2024-01-01")
    assert first["new"] == 2 and first["before"] == 0 and first["sample_size"] == 2
    again = runs.run_sequencing_import(spark, csv, wh, run_date="2024-01-02")
    assert again["skipped"]                                   # M7: unchanged file
    write(csv, hdr + body + "5,2024,P5,CT,I1,R5,g1,wgs,/f/5,NovaSeq,1,2,3,/d/5,1,1.0\n")
    third = runs.run_sequencing_import(spark, csv, wh, run_date="2024-01-03")
    assert third["new"] == 1 and third["before"] == 2         # NULL-keyed row not re-added
    t = spark.read.parquet(os.path.join(wh, "sequencing_metrics"))
    assert t.count() == 3 and dict(t.dtypes)["Reads"] == "bigint"
