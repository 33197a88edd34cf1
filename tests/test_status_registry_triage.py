"""Status update, group registry (batch and file stream), log triage and manifests on files."""
import os

from conftest import write
from pyspark.sql import functions as F

from metricyard.functions import fixed
from metricyard.operators import registry, triage
from metricyard.plans import runs
from metricyard.sources import delimited, files
from metricyard.streaming import jobs


def test_status_update(spark, tmpdir_path):
    rows = [("labA", "p1", "run1", "Delivered", "s1"), ("labA", "p1", "run1", "Delivered", "s2"),
            ("labA", "p1", "run1", "Undelivered", "s3"), ("labA", "p1", "run2", "Delivered", "s1")]
    t = spark.createDataFrame(rows, "Investigator_Folder string, Project_ID string, Project_run_type string, "
                                    "ProjStatus string, Sample_Name string")
    path = os.path.join(tmpdir_path, "tbl")
    t.write.parquet(path)
    write(os.path.join(tmpdir_path, "samples.txt"), " s1\n\ns3 \ns1\n")
    n = runs.run_status_update(spark, path, "run1", os.path.join(tmpdir_path, "export"),
                               samples_file=os.path.join(tmpdir_path, "samples.txt"))
    assert n == 1
    out = {(r["Project_run_type"], r["Sample_Name"]): r["ProjStatus"]
           for r in spark.read.parquet(path).collect()}
    assert out == {("run1", "s1"): "Undelivered", ("run1", "s2"): "Delivered",
                   ("run1", "s3"): "Undelivered", ("run2", "s1"): "Delivered"}
    exported = spark.read.option("header", True).option("sep", "\t").csv(os.path.join(tmpdir_path, "export"))
    assert exported.count() == 2                       # run1 rows of listed samples, any status
    # zero matches: nothing written
    assert runs.run_status_update(spark, path, "run1", os.path.join(tmpdir_path, "e2"),
                                  samples_inline="s1,s3") == 0
    assert not os.path.exists(os.path.join(tmpdir_path, "e2"))


def test_registry_batch_ops(spark):
    reg = spark.createDataFrame([], registry.REGISTRY_SCHEMA)
    groups = spark.createDataFrame([(" labA ",), ("",), ("Investigator_Folder",), ("labB",)], "Investigator_Folder string")
    reg = registry.register_groups(reg, registry.distinct_groups(groups))
    adds = spark.createDataFrame([("labA", "a@x", 1), ("labA", "b@x", 2), ("labA", "a@x", 3), ("labC", "c@x", 1)],
                                 "grp string, user string, pos bigint")
    reg = registry.add_users(reg, adds)
    reg = registry.remove_users(reg, spark.createDataFrame([("labA", "a@x"), ("labZ", "q@x")], "grp string, user string"))
    out = {r["grp"]: r["users_text"] for r in registry.export_registry(reg).collect()}
    assert out == {"labA": "b@x", "labB": "", "labC": "c@x"}
    reg = registry.remove_users(reg, spark.createDataFrame([("labA", "b@x")], "grp string, user string"))
    out = {r["grp"]: r["users_text"] for r in registry.export_registry(reg).collect()}
    assert out["labA"] == ""                           # the group stays with an empty list


def test_sniffed_metrics_and_stream(spark, tmpdir_path):
    src = os.path.join(tmpdir_path, "in")
    write(os.path.join(src, "a.metrics.txt"), "Sample\tInvestigator_Folder\tX\ns1\tlabA\t1\ns2\t labB \t2\n")
    write(os.path.join(src, "b.metrics.txt"), "Investigator_Folder,Y\nlabC,1\n,2\nlabA,3\n")
    write(os.path.join(src, "c.metrics.txt"), "Other\nz\n")                      # no such column: skipped
    lines = delimited.read_metric_files(spark, src)
    vals = delimited.column_values_sniffed(lines, "Investigator_Folder").withColumnRenamed("value", "Investigator_Folder")
    assert {r["grp"] for r in registry.distinct_groups(vals).collect()} == {"labA", "labB", "labC"}
    root = jobs.scratch_dir(spark, "test-watch")
    q = jobs.watch_groups(jobs.metrics_file_stream(spark, src), f"{root}/registry", f"{root}/ckpt")
    q.awaitTermination()
    assert {r["grp"] for r in jobs.current_registry(spark, f"{root}/registry").collect()} == {"labA", "labB", "labC"}
    write(os.path.join(src, "d.metrics.txt"), "Investigator_Folder\nlabD\n")  # a newly landed file
    q = jobs.watch_groups(jobs.metrics_file_stream(spark, src), f"{root}/registry", f"{root}/ckpt")
    q.awaitTermination()
    assert {r["grp"] for r in jobs.current_registry(spark, f"{root}/registry").collect()} == {"labA", "labB", "labC", "labD"}


def test_log_triage_from_files(spark, tmpdir_path):
    d = os.path.join(tmpdir_path, "logs")
    platform_rule = fixed.LOG_RULES[0][1]
    write(os.path.join(d, "P1_QCreport.basic.log"), f"start\nProgram aborted\n{platform_rule}\n")
    write(os.path.join(d, "P1_QCreport.rnaseq.gather.log"),
          "x\n!!!WARNING!!!\nsample s1 failed\n## end\nERROR: Could not locate output from QC pipeline\n")
    write(os.path.join(d, "P2_QCreport.rnaseq.package.log"), "ok\n")
    write(os.path.join(d, "P3_QCreport.basic.gather.log"), "basic_QC job(s) failed\nPlease proceed to report result\n")
    lines = files.read_logs(spark, d)
    cls = {(r["project"], r["pipeline"], r["stage"]): r["error_class"] for r in triage.classify_logs(lines).collect()}
    assert cls[("P1", "basic", "run")] == platform_rule                      # first rule, not first line
    assert cls[("P1", "rnaseq", "gather")] == "!!!WARNING!!!"
    assert cls[("P2", "rnaseq", "package")] is None
    first = {r["project"]: r["error_class"] for r in triage.first_error(triage.classify_logs(lines)).collect()}
    assert first == {"P1": platform_rule}
    st = {r["project"]: r["status"] for r in triage.stage_status(lines).collect()}
    assert st["P3"] == "failed"
    # L3: the block after the warning marker up to '##'
    from metricyard.operators import ordered
    texts = spark.read.text(os.path.join(d, "P1_QCreport.rnaseq.gather.log"), wholetext=True).select(
        F.lit("f").alias("file"), F.col("value").alias("text"))
    block = triage.report_block(ordered.number_lines(texts, "text", ["file"]), ["file"], start_marker="!!!WARNING!!!")
    assert [r["line"] for r in block.orderBy("line_no").collect()] == ["sample s1 failed"]


def test_manifest_and_required_inputs(spark):
    paths = ["/q/p1/fastqs/S1_R1_001.fastq.gz", "/q/p1/fastqs/S1_R2_001.fastq.gz",
             "/q/p1/fastqs/Undetermined_S0_R1_001.fastq.gz", "/q/p1/fastqs/Undetermined_S0_I1_001.fastq.gz",
             "/q/p1/fastqs/readme.txt", "/q/p1/.settings.json"]
    df = spark.createDataFrame([(p, "/q/p1") for p in paths], "path string, project_dir string")
    m = {r["tag"]: (r["fastq_total"], r["undetermined_total"]) for r in triage.manifest_counts(df).collect()}
    assert m == {"R1_": (2, 1), "R2_": (1, 0), "I1_": (1, 1), "all": (4, 2)}   # real Undetermined counts (L-11)
    projects = spark.createDataFrame([("/q/p1",), ("/q/p2",)], "project_dir string")
    found = spark.createDataFrame([("/q/p1", "{}"), ("/q/p2", None)], "project_dir string, json string")
    visible = df.where(~F.col("path").endswith(".settings.json"))              # listings hold no dot-files
    miss = {r["project_dir"]: r["missing"] for r in triage.required_inputs_missing(projects, visible, found).collect()}
    assert miss == {"/q/p1": ["Stats.json.unprocessed"], "/q/p2": [".settings.json", "fastqs", "Stats.json.unprocessed"]}


def test_group_runs(spark, tmpdir_path):
    src = os.path.join(tmpdir_path, "in")
    write(os.path.join(src, "a.metrics.txt"), "Investigator_Folder,X\nlabA,1\nlabB,2\n")
    root = os.path.join(tmpdir_path, "registry")
    out = runs.run_groups(spark, src, root, export_path=os.path.join(tmpdir_path, "groups.json"))
    assert {r["grp"] for r in out.collect()} == {"labA", "labB"}
    write(os.path.join(tmpdir_path, "emails.txt"), " c@x \n\nd@x\n")
    reg = runs.run_registry_update(spark, root, "labA", add="a@x, b@x,", add_file=os.path.join(tmpdir_path, "emails.txt"))
    users = {r["grp"]: r["users"] for r in registry.export_registry(reg).collect()}
    assert users["labA"] == ["a@x", "b@x", "c@x", "d@x"] and users["labB"] == []
    reg = runs.run_registry_update(spark, root, "labA", remove="b@x")
    users = {r["grp"]: r["users"] for r in registry.export_registry(reg).collect()}
    assert users["labA"] == ["a@x", "c@x", "d@x"]


def test_stream_groups_equal_batch(spark, tmpdir_path):
    """SURVEY §5: the stream over files landed in any order gives the batch registry."""
    src = os.path.join(tmpdir_path, "in")
    files_text = {"b.metrics.txt": "Investigator_Folder\tQ\nlabZ\t1\n labY \t2\n",
                  "a.metrics.txt": "Investigator_Folder,Q\nlabX,1\nlabZ,2\n",
                  "c.metrics.txt": "Q,Investigator_Folder\n1,labW\n"}
    root = jobs.scratch_dir(spark, "order")
    for name in ("c.metrics.txt", "a.metrics.txt", "b.metrics.txt"):        # landed one by one
        write(os.path.join(src, name), files_text[name])
        jobs.watch_groups(jobs.metrics_file_stream(spark, src), f"{root}/reg", f"{root}/ckpt").awaitTermination()
    streamed = {r["grp"] for r in jobs.current_registry(spark, f"{root}/reg").collect()}
    batch = {r["grp"] for r in runs.run_groups(spark, src, os.path.join(tmpdir_path, "breg")).collect()}
    assert streamed == batch == {"labW", "labX", "labY", "labZ"}


def test_logs_are_listed_and_read_by_tasks(spark, tmpdir_path, monkeypatch):
    d = os.path.join(tmpdir_path, "logs")
    long = "".join(f"line {i}\n" for i in range(500))
    texts = {"P1_QCreport.basic.log": "start\nReport @ x\nn 1\r\n\nm\rk\n##\nafter", "sub/P1_QCreport.basic.log": long, "P2_QCreport.rnaseq.package.log": "",
             ".P3_QCreport.basic.log": "no", "_hidden/P3_QCreport.basic.log": "no", "P3_QCreport.basic.txt": "no", "k=1/_P=4_QCreport.basic.log": "x"}
    for name, text in texts.items():
        os.makedirs(os.path.dirname(os.path.join(d, name)), exist_ok=True)
        with open(os.path.join(d, name), "w", newline="") as fh:
            fh.write(text)
    plain = spark.read.option("pathGlobFilter", "*_QCreport.*.log").option("recursiveFileLookup", "true").text(d).select(
        F.col("_metadata.file_path").alias("path"), "value")
    want = sorted(tuple(r) for r in plain.collect())
    assert len(want) == 509
    for size in (64 << 20, 97, 1):
        monkeypatch.setattr(files, "RANGE", size)
        lines = files.read_logs(spark, d)
        got = lines.orderBy("path", "line_no").collect()
        assert sorted((r["path"], r["line"]) for r in got) == want
        assert [r["line"] for r in got if "/sub/" in r["path"]] == long.splitlines()
    block = triage.report_block(lines, ["path", "project", "pipeline", "stage"]).orderBy("line_no").collect()
    assert [(r["project"], r["pipeline"], r["stage"], r["line"]) for r in block] == [("P1", "basic", "run", x) for x in ("n 1", "m", "k")]
    assert "FileScan text" not in lines._jdf.queryExecution().toString()       # no listing on the driver, no task for a few small files
