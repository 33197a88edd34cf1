"""End-to-end runs into a warehouse folder: append twice, ledger, rollups, publish gate."""
import os

from test_long_read import pacbio_project
from test_short_read import make_project, settings

from metricyard.plans import runs


def test_short_read_run_is_idempotent(spark, tmpdir_path):
    roots = os.path.join(tmpdir_path, "roots")
    wh = os.path.join(tmpdir_path, "warehouse")
    make_project(roots, "labA", "p1", settings=settings())
    make_project(roots, "labB", "p2", settings=settings(projectId="p2", deliveryFolder="labB/p2"), report=None)
    first = runs.run_collector(spark, [roots], "rnaseq", wh, run_date="2024-03-06")
    assert first["added"] > 0 and first["projects_recorded"] == 1 and first["projects_failed"] == 1
    second = runs.run_collector(spark, [roots], "rnaseq", wh, run_date="2024-03-07")
    assert second["added"] == 0 and second["projects_recorded"] == 0   # p1 in the ledger; p2 retried
    marts1 = runs.build_marts(spark, wh, run_date="2024-03-07")
    assert marts1["delta"]["publish"] and marts1["delta"]["delta_rows"] == first["added"]
    marts2 = runs.build_marts(spark, wh, run_date="2024-03-08")
    assert not marts2["delta"]["publish"]                               # nothing changed since the snapshot
    idx = spark.read.parquet(os.path.join(wh, "qc_app_index", "run_date=2024-03-08")).collect()
    assert [(r["Application"], r["Investigator_Folder"], r["Sample_Count"]) for r in idx] == [("rnaseq", "labA", 2)]


def test_pacbio_run_evolves_schema(spark, tmpdir_path):
    roots = os.path.join(tmpdir_path, "roots")
    wh = os.path.join(tmpdir_path, "warehouse")
    pacbio_project(roots)
    out = runs.run_collector(spark, [roots], "PacBio", wh, run_date="2024-05-02")
    assert out["added"] > 0
    t = spark.read.option("mergeSchema", True).parquet(os.path.join(wh, "qc_pacbio_metrics"))
    assert {"Sample_Name", "Plate_Number", "Movie_Time_hours", "Mean_QV"} <= set(t.columns)
    again = runs.run_collector(spark, [roots], "PacBio", wh, run_date="2024-05-03")
    assert again["added"] == 0


def test_watch_reports_stream(spark, tmpdir_path):
    from metricyard.streaming import jobs
    roots = os.path.join(tmpdir_path, "roots")
    wh = os.path.join(tmpdir_path, "warehouse")
    make_project(roots, "labA", "p1", settings=settings())
    ck = os.path.join(jobs.scratch_dir(spark, "watch-reports"), "ckpt")
    jobs.watch_reports(spark, roots, "rnaseq", wh, ck).awaitTermination()
    n1 = spark.read.parquet(os.path.join(wh, "qc_illumina_metrics")).count()
    assert n1 > 0
    make_project(roots, "labA", "p9", settings=settings(projectId="p9", deliveryFolder="/x/labA/p9/"))
    jobs.watch_reports(spark, roots, "rnaseq", wh, ck).awaitTermination()
    t = spark.read.parquet(os.path.join(wh, "qc_illumina_metrics"))
    assert t.count() == 2 * n1 and {r["Project_ID"] for r in t.select("Project_ID").distinct().collect()} == {"p1", "p9"}


def test_collector_scope_routing_and_retry(spark, tmpdir_path):
    """First run, active run, archive run, reset; a wrong application is left out."""
    active, archive, wh = (os.path.join(tmpdir_path, n) for n in ("active", "archive", "wh"))
    make_project(active, "labA", "p1", settings=settings())
    make_project(active, "labB", "wrong", settings=settings(projectId="w", application="WGBS"))
    make_project(active, "labB", "broken", settings=settings(projectId="b"), report=None)
    make_project(archive, "labC", "old", settings=settings(projectId="old", deliveryFolder="/x/labC/old/"))

    def run(day):
        return runs.run_collector(spark, [active], "rnaseq", wh, run_date=day, archive_roots=[archive])

    first = run("2024-03-01")
    assert first["scope"] == "all" and not first["reset"]
    assert (first["found"], first["eligible"], first["projects_recorded"]) == (4, 3, 2)
    assert first["failed"] == {"report missing": 1}
    retry = spark.read.parquet(os.path.join(wh, "retry_projects")).collect()
    assert [(r["reason"], r["run_date"]) for r in retry] == [("report missing", "2024-03-01")]
    unmatched = spark.read.parquet(os.path.join(wh, "species_unmatched")).collect()
    assert {r["run_date"] for r in unmatched} <= {"2024-03-01"}
    make_project(archive, "labC", "old2", settings=settings(projectId="old2", deliveryFolder="/x/labC/old2/"))
    second = run("2024-03-02")
    assert second["scope"] == "active" and second["added"] == 0                # the archive is not read
    third = run("2024-03-07")
    assert third["scope"] == "archive" and third["added"] > 0 and third["projects_recorded"] == 1
    fourth = run("2024-03-12")                                                 # 11 days after the first run
    assert fourth["reset"] and fourth["added"] == 0 and fourth["projects_recorded"] == 0


def test_pacbio_found_by_settings(spark, tmpdir_path):
    """A folder whose settings say PacBio is collected from its application folder."""
    roots, wh = os.path.join(tmpdir_path, "roots"), os.path.join(tmpdir_path, "wh")
    pacbio_project(roots)
    out = runs.run_collector(spark, [roots], "PacBio", wh, run_date="2024-05-02")
    assert out["added"] > 0 and out["projects_recorded"] >= 1


def test_status_updates_last(spark, tmpdir_path):
    """U1 + M1: two updates in a row hold, only touched partitions change, and a new collection keeps them."""
    from metricyard.operators import merge, sinks
    path = os.path.join(tmpdir_path, "t")
    rows = [("rnaseq", "r1", "s1", "Delivered"), ("rnaseq", "r2", "s2", "Delivered"), ("wgs", "r2", "s3", "Delivered"),
            ("wgs", "r3", "s4", "Delivered"), (None, "r2", "s5", "Delivered")]
    df = spark.createDataFrame(rows, "Application string, Project_run_type string, Sample_Name string, ProjStatus string")
    df.write.partitionBy("Application").parquet(path)
    export = os.path.join(tmpdir_path, "x.tsv")
    assert runs.run_status_update(spark, path, "r1", export) == 1
    assert runs.run_status_update(spark, path, "r2", export, samples_inline="s2,s5") == 2
    assert runs.run_status_update(spark, path, "r2", export, samples_inline="s2") == 0
    live = {r["Sample_Name"]: r["ProjStatus"] for r in spark.read.parquet(path).collect()}
    assert live == {"s1": "Undelivered", "s2": "Undelivered", "s3": "Delivered", "s4": "Delivered", "s5": "Undelivered"}
    new = merge.new_rows_if_absent(spark.read.parquet(path), df, ["Application", "Project_run_type", "Sample_Name"])
    assert new.count() == 0                                # the key leaves the status out
    sinks.append_rows(new.select("Project_run_type", "Sample_Name", "ProjStatus", "Application"), path, ["Application"])
    assert spark.read.parquet(path).where("ProjStatus = 'Undelivered'").count() == 3


def test_publish_counts_sequencing_rows(spark, tmpdir_path):
    """A3 + K6: new sequencing rows alone publish, both tables are kept, and the view is stored."""
    roots, wh = os.path.join(tmpdir_path, "roots"), os.path.join(tmpdir_path, "wh")
    make_project(roots, "labA", "p1", settings=settings())
    runs.run_collector(spark, [roots], "rnaseq", wh, run_date="2024-03-06")
    assert runs.build_marts(spark, wh, "2024-03-07")["delta"]["publish"]
    assert not runs.build_marts(spark, wh, "2024-03-08")["delta"]["publish"]
    seq = spark.createDataFrame([(None,) * len(runs.SEQUENCING_DDL.split(", "))], runs.SEQUENCING_DDL)
    seq.write.parquet(os.path.join(wh, "sequencing_metrics"))
    out = runs.build_marts(spark, wh, "2024-03-20")
    assert out["delta"]["publish"] and out["delta"]["delta_seq_rows"] == 1 and out["delta"]["delta_rows"] == 0
    assert [p.rsplit("=", 1)[1] for p in out["expired"]] == ["20240307", "20240307"]
    view = spark.read.parquet(os.path.join(wh, "unified_qc_view")).collect()
    assert [r["Source"] for r in view] == ["qc_illumina_metrics"]


def test_listing_keeps_files_beside_folders(spark, tmpdir_path):
    from conftest import write

    from metricyard.sources import files
    write(os.path.join(tmpdir_path, "r", "top_QCreport.rnaseq.csv"), "a\n")
    write(os.path.join(tmpdir_path, "r", "package", "a.csv"), "a\n")
    names = sorted(r["path"].rsplit("/r/", 1)[1] for r in files.list_files(spark, [os.path.join(tmpdir_path, "r")]).collect())
    assert names == ["package/a.csv", "top_QCreport.rnaseq.csv"]


def test_bodies_are_read_by_many_tasks(spark, tmpdir_path):
    from metricyard.sources import files
    paths = spark.createDataFrame([(f"{tmpdir_path}/p{i}",) for i in range(500)], "project_dir string")
    assert files.read_settings(paths).rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_registry_survives_batch_then_stream(spark, tmpdir_path):
    """T1 + U3: batch runs, streams and new checkpoints follow each other without losing a group."""
    from conftest import write

    from metricyard.streaming import jobs
    src, root = os.path.join(tmpdir_path, "in"), os.path.join(tmpdir_path, "reg")
    write(os.path.join(src, "a.metrics.txt"), "Investigator_Folder,X\nlabA,1\n")
    for _ in range(3):
        runs.run_groups(spark, src, root)
    write(os.path.join(src, "b.metrics.txt"), "X,Investigator_Folder\n1,labB\n")
    for check in ("c1", "c2"):                                             # a second checkpoint starts at batch 0 again
        q = jobs.watch_groups(jobs.metrics_file_stream(spark, src), root, os.path.join(tmpdir_path, check))
        q.awaitTermination()
    reg = runs.run_registry_update(spark, root, "labC", add="x@y")
    assert {r["grp"] for r in reg.collect()} == {"labA", "labB", "labC"}


def test_quoted_cells_and_bad_rows(spark, tmpdir_path):
    """A quoted delimiter stays in its cell, the first header line counts. S12: extra fields are bad
    whatever the last declared field holds."""
    from conftest import write

    from metricyard.sources import delimited
    src = os.path.join(tmpdir_path, "in")
    write(os.path.join(src, "a.metrics.txt"), 'Name,Investigator_Folder\n"Doe, J",labQ\n"A ""B"", C",labR\nAn,Investigator_Folder,x\n')
    vals = delimited.column_values_sniffed(delimited.read_metric_files(spark, src), "Investigator_Folder")
    assert {r["value"] for r in vals.collect()} == {"Investigator_Folder", "labQ", "labR"}
    write(os.path.join(tmpdir_path, "t.csv"), 'a,b,c\n1,2,,4\n1,2\n1,"x,y",3\n1,2,3,4\n')
    t = delimited.read_typed_csv(spark, os.path.join(tmpdir_path, "t.csv"), [("a", "int"), ("b", "string"), ("c", "int")])
    assert sorted(tuple(r) for r in t.collect()) == sorted([(1, "2", None), (1, "x,y", 3)], key=str)


def test_session_keeps_what_is_set(spark):
    from metricyard.session import build_session
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "static")
    try:
        build_session()
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", before)


def test_measured_broadcast_check(spark):
    """A side of few but long values does not pass for small."""
    from pyspark.sql import functions as F

    from metricyard.operators import joins
    wide = spark.range(20).select(F.repeat(F.lit("x"), 1_000_000).alias("k"))
    assert not joins.fits_broadcast(wide) and joins.fits_broadcast(spark.range(20).select("id"))
