"""Rows that a run cannot store land in the reject table with a reason; counters come from the writes; the view lasts."""
import os

from conftest import write
from pyspark.sql import functions as F

from metricyard.functions import fixed
from metricyard.operators import sinks
from metricyard.operators.quarantine import observed_write
from metricyard.plans import runs
from test_short_read import make_project, settings

REPORT = ('GT_QC_Sample_ID,Sample_Name,SPECIES,Reads_Total,%>=Q30\ns1,n1,human,"1,234",91.5\ns2,n2,marmoset,7,90.0,,\n'
          's3,n3,human,5,1,stray\n,n4,human,5,1\n')


def test_run_sets_bad_rows_aside(spark, tmpdir_path):
    roots, wh = os.path.join(tmpdir_path, "roots"), os.path.join(tmpdir_path, "wh")
    make_project(roots, "labA", "p1", settings=settings(), report=REPORT)
    make_project(roots, "labB", "p2", settings=settings(application="some other"))
    out = runs.run_collector(spark, [roots], "rnaseq", wh, "2024-03-06")
    bad = sorted((r["source"].rsplit("/", 1)[1], r["reason"], r["line"]) for r in spark.read.parquet(f"{wh}/rejected_rows").collect())
    assert bad == [("p1_QCreport.rnaseq.csv", "more cells than columns", "s3,n3,human,5,1,stray"),
                   ("p1_QCreport.rnaseq.csv", "sample id or name missing", "5,1"),
                   ("rnaseq", "application of another pipeline", "some other")]
    t = spark.read.parquet(f"{wh}/qc_illumina_metrics")
    assert out["rejected"] == 2 and out["added"] == t.count()
    species = {r["Sample_Name"]: r["Species"] for r in t.select("Sample_Name", "Species").distinct().collect()}
    assert species == {"n1": "Homo sapiens", "n2": "Callithrix jacchus"}                  # the column's name in any case
    runs.build_marts(spark, wh, "2024-03-06")
    view = spark.newSession().sql("SELECT Source, Investigator_Folder FROM unified_qc_view")    # of the catalog, not of a session
    assert [tuple(r) for r in view.collect()] == [("qc_illumina_metrics", "labA")]
    make_project(roots, "labC", "p3", settings=settings(projectId="p3", deliveryFolder="/x/labC/p3/"))
    runs.run_collector(spark, [roots], "rnaseq", wh, "2024-03-07")
    fresh = spark.newSession().table("unified_qc_view")
    assert {r["Investigator_Folder"] for r in fresh.collect()} == {"labA", "labC"}        # without build_marts


def test_import_keeps_bad_lines_and_counts_while_writing(spark, tmpdir_path):
    names = [n for n, _ in fixed.SEQUENCING_SCHEMA]
    good = ["1", "2024", "P1", "s", "i", "r", "g", "a", "/p", "pl", "10", "20", "30", "/d", "2", "1.5"]
    lines = [",".join(names), ",".join(good), ",".join(["2", *good[1:]]), ",".join([*good, "x"]),
             ",".join([*good[:10], "many", *good[11:]]), ",".join(good[:12])]
    path, wh = os.path.join(tmpdir_path, "SequencingMetrics.csv"), os.path.join(tmpdir_path, "wh")
    write(path, "\n".join(lines) + "\n")
    out = runs.run_sequencing_import(spark, path, wh, "2024-03-06")
    assert out == {"skipped": False, "before": 0, "after": 3, "new": 3, "sample_size": 1, "rejected": 2}
    bad = sorted((r["reason"], r["line"]) for r in spark.read.parquet(f"{wh}/rejected_rows").collect())
    assert bad == [(f"{names[10]} is not bigint", lines[4]), ("extra fields", lines[3])]


def test_counts_are_those_of_the_write(spark, tmpdir_path):
    """A range partitioning reads its input twice; the counter stands above it and counts once."""
    df = spark.range(1000).selectExpr("'a' AS Application", "CAST(id AS STRING) AS Release_Date", "'f' AS Investigator_Folder",
                                      "'p' AS Project_ID", "'r' AS Project_run_type")
    path = os.path.join(tmpdir_path, "t")
    seen = observed_write(df, lambda d, mark: sinks.write_clustered(d, path, mark=mark), most=F.max(F.col("Release_Date").cast("int")))
    assert seen == {"rows": 1000, "most": 999} and spark.read.parquet(path).count() == 1000
    assert observed_write(df.limit(0), lambda d, mark: mark(d).write.mode("append").parquet(path)) == {"rows": 0}
